"""Numeric column expressions: ANSI-safe coercion, guarded ratios and exact decimal sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


NOISE_SCALE = 8


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double_or_null(c: str | Column) -> Column:
    """A finite number, or null: text that is no number, "NaN" and infinities are none."""
    number = _col(c).try_cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)


def to_double_or_zero(c: str | Column) -> Column:
    """:func:`to_double_or_null` with 0.0 for what is no number."""
    return F.coalesce(to_double_or_null(c), F.lit(0.0))


def ratio_or_null(num: str | Column, den: str | Column) -> Column:
    """num / den, null when den is 0 or null (SQL ``x / NULLIF(y, 0)``)."""
    return F.try_divide(_col(num), _col(den))


def ratio_or_zero(num: str | Column, den: str | Column) -> Column:
    return F.coalesce(F.try_divide(_col(num), _col(den)), F.lit(0.0))


def round_half_up(c: str | Column, scale: int = 2) -> Column:
    """Spark's ``round``: half away from zero on the decimal text of the value (1.005 → 1.01).

    The value is brought to ``NOISE_SCALE`` places first, which takes off what binary division
    leaves (269638.41 / 6 is 44939.734999999993 and rounds to 44939.74).
    """
    return F.round(F.round(_col(c), NOISE_SCALE), scale)


def exact_sum(c: str | Column, scale: int = 6) -> Column:
    """Sum of a measure (money, kWh) that does not depend on row order, as a double.

    Values are summed as decimals with ``scale`` places, more than the measures carry, so
    nothing is rounded before the total; partial sums merge exactly whatever the partitioning.
    """
    return F.sum(_col(c).cast(f"decimal(24,{scale})")).cast("double")


def exact_avg(c: str | Column, scale: int = 12) -> Column:
    """Mean that does not depend on row order: an exact sum over the count, null without values."""
    return exact_sum(c, scale) / F.nullif(F.count(_col(c)), F.lit(0))
