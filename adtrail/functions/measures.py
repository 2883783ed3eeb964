"""Ratios, rounding and money columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(15,2)"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def half_up(value: Column, digits: int) -> Column:
    """Round half up on the decimal value, so 1.025 becomes 1.03 as in NUMERIC."""
    return F.round(value.cast("decimal(38,10)"), digits).cast("double")


def _quotient(num: Column, den: Column, scale: float) -> Column:
    out = num.cast("double") / den.cast("double")
    return out if scale == 1 else out * F.lit(float(scale))


def safe_div(num, den, scale: float = 1, digits: int | None = None) -> Column:
    """num/den*scale, and 0 where the denominator is not positive."""
    num, den = as_column(num), as_column(den)
    out = F.when(den > 0, _quotient(num, den, scale)).otherwise(F.lit(0.0))
    return out if digits is None else half_up(out, digits)


def ratio(num, den, scale: float = 1, digits: int | None = None) -> Column:
    """num/den*scale, and null where the denominator is 0 or null."""
    num, den = as_column(num), as_column(den)
    out = F.when(den != 0, _quotient(num, den, scale))
    return out if digits is None else half_up(out, digits)


def mean(value) -> Column:
    """Average taken as sum / count, exact for decimals up to the last division."""
    value = as_column(value)
    return _quotient(F.sum(value), F.count(value), 1)


def total(value) -> Column:
    """Sum that is 0, not null, over an empty or all-null group."""
    return F.coalesce(F.sum(as_column(value)), F.lit(0))


def share(condition: Column, digits: int = 2) -> Column:
    """Percentage of the group's rows that meet the condition."""
    return ratio(F.count_if(condition), F.count(F.lit(1)), 100, digits)


def unit_price(discounted, original) -> Column:
    """Discounted price, or the original one where no discount is stored (null or 0)."""
    discounted, original = as_column(discounted), as_column(original)
    return F.coalesce(F.nullif(discounted, F.lit(0)), original, F.lit(0)).cast(MONEY)


def to_number(value) -> Column:
    """Numeric coercion: unreadable text counts as 0."""
    return F.coalesce(as_column(value).try_cast("double"), F.lit(0.0))


def price_check(actual, price, units) -> Column:
    """'Matches' when price x units equals the value, else what differs."""
    actual, price, units = map(as_column, (actual, price, units))
    expected = price * units
    same = price.isNull() | (F.abs(actual - expected) < F.lit(1e-6))
    return F.when(same, "Matches").otherwise(
        F.format_string(
            "Mismatch (Actual: %.2f, Expected: %.2f)", actual.cast("double"), expected.cast("double")
        )
    )
