"""Scalar and conditional functions of the cleaning rules."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
NULL_TOKENS = ("", "NA", "N/A", "nan")
NO_GRADE = "SC"
CEBAS_YES = ("Sim", "SIM", "sim", "1")
CEBAS_NO = ("-", "Não", "NÃO", "não", "0", "")
UNKNOWN_COURSE = -1


def strip_text(c: Column) -> Column:
    """Trim every kind of Unicode white space (tabs and no-break spaces too) from both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def strip_quotes(c: Column) -> Column:
    """Trim blanks and double quotes from both ends."""
    return F.btrim(c, F.lit('" '))


def drop_null_tokens(c: Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """Texts that stand for "no value" become null."""
    return F.when(~c.isin(*tokens), c)


def only_digits(c: Column) -> Column:
    """True when the whole text is ASCII digits; a trailing newline does not pass."""
    return c.rlike(r"^[0-9]+\z")


def decode(c: Column, labels: Mapping) -> Column:
    """Label of a code; codes without a label give null."""
    pairs = [F.lit(x) for item in labels.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), c)


def network_of_category(category: Column) -> Column:
    """1 (public) for administrative categories up to 3, otherwise 2 (private), null included."""
    return F.when(category <= 3, F.lit(1)).otherwise(F.lit(2))


def cebas_flag(c: Column) -> Column:
    """``X`` is true, ``-`` is false, anything else unknown."""
    return F.when(c == "X", F.lit(True)).when(c == "-", F.lit(False))


def cebas_code(c: Column) -> Column:
    """1 / 0 by membership in the yes and no texts, anything else null."""
    return F.when(c.isin(*CEBAS_YES), F.lit(1)).when(c.isin(*CEBAS_NO), F.lit(0))


def _filled(text: Column) -> Column:
    return text.isNotNull() & (text != "") & (text != "None")


def no_grade_flag(band: Column, remark: Column | None = None) -> Column:
    """Band says ``SC``, or the band is empty and a remark explains why.

    Three-valued on purpose: a null band without remark leaves the flag null.
    """
    band = strip_text(band.cast("string"))
    flag = band == NO_GRADE
    if remark is None:
        return flag
    empty = band.isNull() | (band == "") | (band == "None")
    return flag | (empty & _filled(strip_text(remark.cast("string"))))


def fallback_no_grade_flag(band: Column | None, remark: Column | None) -> Column:
    """Flag for cleaned tables that never stored one: band missing or remark filled."""
    missing = band.isNull() if band is not None else F.lit(False)
    noted = _filled(strip_text(remark.cast("string"))) if remark is not None else F.lit(False)
    return missing | noted


def hide_when(flag: Column, c: Column) -> Column:
    """Null where the flag is true; a null flag leaves the value."""
    return F.when(flag, F.lit(None)).otherwise(c)


def repair_outlier(raw: Column, continuous: Column, band: Column, flag: Column) -> Column:
    """Score 0.0 where a raw grade in band 1 was published without its continuous score."""
    missing = raw.isNotNull() & continuous.isNull() & (band == 1) & ~flag
    return F.when(missing, F.lit(0.0)).otherwise(continuous)


def ratio(part: Column, whole: Column) -> Column:
    """Division that gives null, not an error, on a zero denominator."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def round_half_even(c: Column, digits: int = 1) -> Column:
    return F.bround(c, digits)


def abs_diff(a: Column, b: Column) -> Column:
    return F.abs(a - b)


def first_filled(*columns: Column) -> Column:
    return F.coalesce(*columns)


def fill(c: Column, value) -> Column:
    return F.coalesce(c, F.lit(value))


def typed_null(ddl: str) -> Column:
    return F.lit(None).cast(ddl)


def fold_header(c: Column) -> Column:
    """Header text without case, accents, footnote asterisks, dash variants or extra blanks."""
    plain = F.translate(F.lower(c), "áàâãäéêèíîóôõöúüç–—", "aaaaaeeeiioooouuc--")
    plain = F.regexp_replace(plain, r"[\p{M}*]", "")
    return F.trim(F.regexp_replace(plain, r"(?U)\s+", " "))
