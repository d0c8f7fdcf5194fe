"""Numbers out of text. Everything is ``try_``: bad input gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digits and separators are kept. Superscript digits are kept too, so that "12 m³"
# fails the final cast instead of reading as 12.
_NOISE = r"[^0-9⁰¹²³⁴⁵⁶⁷⁸⁹,.\-]"
# one separator and three characters after it, with digits or minus signs before it
_THOUSANDS = r"^[0-9-]*[0-9][0-9-]*[,.].{3}$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: Column | str) -> Column:
    """A decimal literal as a number. Java's own forms (``2024d``, ``2024f``, hexadecimal) and booleans are not numbers."""
    text = _col(c).cast("string")
    return F.when(~text.rlike(r"(?i)[0-9.][df]\s*$|x"), text.try_cast("double"))


def parse_decimal_text(c: Column | str) -> Column:
    """Decimal number in either locale: ``1.234,56`` and ``1,234.56`` are the same value."""
    s = F.regexp_replace(_col(c).cast("string"), _NOISE, "")
    no_commas = F.regexp_replace(s, ",", "")
    no_dots = F.regexp_replace(s, r"\.", "")
    comma_as_point = F.regexp_replace(no_dots, ",", ".")
    has_comma, has_dot = s.contains(","), s.contains(".")
    normal = (
        F.when(has_comma & has_dot, F.when(s.rlike(r",[^.]*$"), comma_as_point).otherwise(no_commas))
        .when(has_comma, F.when(s.rlike(r",.*,") | s.rlike(_THOUSANDS), no_commas).otherwise(comma_as_point))
        .when(has_dot, F.when(s.rlike(r"\..*\.") | s.rlike(_THOUSANDS), no_dots).otherwise(s))
        .otherwise(s)
    )
    return normal.try_cast("double")


def parse_number(c: Column | str, dtype: str) -> Column:
    """Numeric columns pass through; text goes through the locale rules."""
    if dtype in ("tinyint", "smallint", "int", "bigint", "float", "double") or dtype.startswith("decimal"):
        return _col(c).cast("double")
    if dtype == "boolean":
        return F.lit(None).cast("double")
    return parse_decimal_text(c)


def parse_int(c: Column | str) -> Column:
    """Whole number read through a float, truncated toward zero."""
    number = to_double(c)
    return F.when(~F.isnan(number), number).try_cast("int")


def currency_to_double(c: Column | str) -> Column:
    """Pound amounts, also where the sign was decoded as two characters."""
    return to_double(F.regexp_replace(_col(c), r"[Â£,\s]", ""))


def price_from_parts(whole: Column | str, fraction: Column | str) -> Column:
    clean = [F.regexp_replace(_col(c), r"[.,\s]", "") for c in (whole, fraction)]
    return to_double(F.concat(clean[0], F.lit("."), clean[1]))


def digits_only(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), "[^0-9]", "")


def nan_to_null(c: Column | str) -> Column:
    col = _col(c)
    return F.when(~F.isnan(col), col)
