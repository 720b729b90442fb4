"""Scalar Column helpers (all JVM-side built-ins, codegen-friendly).

Parity rules (see README): ratios are rounded through DECIMAL so that ties are
decided on the decimal value in every engine; division never raises (NULL on a
zero divisor); day-of-week is 0..6 with Sunday = 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def snap(x, scale: int = 6) -> Column:
    """Double snapped to `scale` decimals (hides summation-order noise)."""
    return c(x).cast(f"decimal(38,{scale})").cast("double")


MONEY_SCALE = 10_000


def money_units(x) -> Column:
    """Money as an exact integer count of ten-thousandths (DECIMAL(18,4) scaled)."""
    return F.round(c(x) * MONEY_SCALE).cast("bigint")


def money_sum(x) -> Column:
    """Exact sum of 4-decimal values, as double."""
    return F.sum(money_units(x)).cast("double") / float(MONEY_SCALE)


def money_avg(x) -> Column:
    """Average of 4-decimal values from an exact integer sum: the same bits in
    every engine and for every partitioning (a double sum is order-dependent)."""
    return F.sum(money_units(x)).cast("double") / F.count(c(x)).cast("double") / float(MONEY_SCALE)


def round_half_up(x, digits: int) -> Column:
    """round() decided on the decimal value: cast to decimal(38,6) first."""
    return F.round(c(x).cast("decimal(38,6)"), digits).cast("double")


def safe_div(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (the reference's nullif guard)."""
    return F.try_divide(c(num).cast("double"), F.nullif(c(den).cast("double"), F.lit(0.0)))


def pct(num, den, digits: int = 2) -> Column:
    """round(num / nullif(den, 0) * 100, digits)."""
    return round_half_up(safe_div(num, den) * 100, digits)


def dow_sunday0(d) -> Column:
    return F.dayofweek(c(d)) - 1


def first_of(arr) -> Column:
    """1-based ``arr[1]`` with NULL when empty or NULL."""
    return F.get(c(arr), 0)


def strip_leading_zeros(x) -> Column:
    return F.regexp_replace(F.trim(F.coalesce(c(x), F.lit(""))), r"^0+", "")


def digits_only(x) -> Column:
    return F.regexp_replace(c(x), r"\D", "")


def clean_barcode(x) -> Column:
    """Digits only when the cleaned code has a barcode length (8/13/14), else the raw value."""
    d = digits_only(x)
    return F.when(c(x).isNull(), None).when(F.length(d).isin(8, 13, 14), d).otherwise(c(x))


def valid_barcode_length(x) -> Column:
    return F.length(c(x)).isin(8, 13, 14)


def force_https(x) -> Column:
    return F.regexp_replace(c(x), r"^http://", "https://")


def blank(x) -> Column:
    return c(x).isNull() | (F.trim(c(x)) == "")


def parse_price_text(x) -> Column:
    """'R$ 1.234,56' -> 1234.56 ; '12.99' -> 12.99 ; junk -> NULL.

    A comma marks the decimal part (thousands dots are dropped); without a comma
    the dot is the decimal separator.
    """
    s = F.regexp_replace(c(x), r"[^0-9,.]", "")
    with_comma = F.regexp_replace(F.regexp_replace(s, r"\.", ""), ",", ".")
    txt = F.when(F.instr(s, ",") > 0, with_comma).otherwise(s)
    return F.nullif(txt, F.lit("")).try_cast("double")


def nullif_blank(x) -> Column:
    return F.nullif(F.trim(c(x)), F.lit(""))
