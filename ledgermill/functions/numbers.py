"""Number parsing and null-aware arithmetic, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

DASHES = ["-", "–", "—"]
NIL_WORDS = DASHES + [".", "nil", "Nil", "NIL"]


def tagged_number(raw: Column, scale: Column, sign: Column) -> Column:
    """Value of a tagged fact: separators dropped, shifted by ``scale``, negated by ``sign``.

    Anything that is not a plain number gives null, as does a scale that is not an integer.
    """
    # Factors rather than nested branches: the raw text is parsed once per row.
    bare = F.regexp_replace(raw, r"[,\s\u00a0\u2000-\u200a\u202f\u205f\u3000\ufeff]", "")
    number = F.regexp_extract(bare, r"^([+-]?[0-9]*[.]?[0-9]+)$", 1).try_cast("double")
    shift = F.when(scale.isNull() | (F.trim(scale) == ""), F.lit(1.0)).otherwise(
        F.pow(F.lit(10.0), scale.try_cast("int")))
    return number * shift * F.when(sign == "-", F.lit(-1.0)).otherwise(F.lit(1.0))


def scale_or_decimals(scale: Column, decimals: Column) -> Column:
    """Explicit scale, else the shift implied by a negative ``decimals``, else 0."""
    implied = decimals.try_cast("int")
    return F.coalesce(
        F.when(F.trim(scale) != "", scale.try_cast("int")),
        F.when(implied < 0, -implied),
        F.lit(0),
    )


def is_number_text(text: Column) -> Column:
    """Does a printed token look like a number (at least 80% number characters)?"""
    s = F.trim(text)
    kept = F.length(F.regexp_replace(s, r"[^0-9(),.\-–— £$]", ""))
    return F.coalesce(
        s.isin(NIL_WORDS) | (s.rlike("[0-9]") & (kept / F.length(s) >= 0.8)), F.lit(False))


def printed_number(text: Column) -> Column:
    """Integer value of a printed token; dash is 0, an opening bracket is a minus.

    Commas and full stops are both taken as thousand separators.
    """
    s = F.trim(text)
    bare = F.translate(s, "() £$", "")
    digits = F.translate(bare, ",.", "")
    whole = F.when(digits.rlike("^-?[0-9]+$"), digits.try_cast("bigint"))
    fraction = F.translate(bare, ",", "").try_cast("double")
    value = F.coalesce(whole, fraction.try_cast("bigint"))
    return F.when(bare.isin(DASHES + ["", "."]), F.lit(0).cast("bigint")).otherwise(
        F.when(s.startswith("("), -value).otherwise(value))


def safe_div(numerator: Column, denominator: Column) -> Column:
    """Quotient, null when either side is null or the denominator is zero."""
    return F.try_divide(numerator, denominator)


def non_null_count(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in cols])


def sum_required(*cols: Column) -> Column:
    """Sum, null unless every input is present."""
    return reduce(lambda a, b: a + b, cols)


def sum_components(cols: list[Column], min_components: int = 2) -> Column:
    """Sum of the present inputs, null unless at least ``min_components`` are present."""
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in cols])
    return F.when(non_null_count(cols) >= min_components, total)


def sum_with_optional(required: list[Column], optional: list[Column],
                      min_optional: int = 0) -> Column:
    """Required inputs (all needed) plus whichever optional inputs are present."""
    extra = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in optional])
    total = sum_required(*required) + extra
    return F.when(non_null_count(optional) >= min_optional, total)


def money(value: Column) -> Column:
    """Display form of an amount in pounds: sign, then thousands-separated whole units."""
    return F.concat(F.lit("£"), F.format_number(value, 0))


def percent(value: Column) -> Column:
    return F.format_string("%.1f%%", value * 100)
