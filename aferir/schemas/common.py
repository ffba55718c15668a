"""Columns that several tables share."""

YEARS_WITHOUT_EXAM = (2020,)
EXAM_YEARS = tuple(y for y in range(2004, 2024) if y not in YEARS_WITHOUT_EXAM)
