"""Helpers of the library's own tests."""


def rows(df):
    """Rows as dictionaries, in a stable order."""
    return sorted((r.asDict() for r in df.collect()), key=lambda d: str(sorted(d.items())))
