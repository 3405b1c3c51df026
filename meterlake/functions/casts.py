"""Casts that never fail a job: a value that does not fit becomes a stated default."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def safe_whole(c: Column, default: int | None = None) -> Column:
    """A non-negative whole number from text or a double; anything else gives the default.

    Decided numerically, so that ``1`` and ``1.0`` are both whole.
    """
    number = c.try_cast("double")
    whole = F.when((number >= 0) & (number == F.floor(number)), number.try_cast("bigint"))
    return whole if default is None else F.coalesce(whole, F.lit(default).cast("bigint"))


def safe_cents(c: Column, default: int = 0) -> Column:
    """A number as whole hundredths, halves away from zero; anything else gives the default."""
    number = c.try_cast("double")
    nearest = (number * 100 + F.signum(number) * 0.5).try_cast("bigint")
    return F.coalesce(nearest, F.lit(default).cast("bigint"))


def safe_amount(c: Column, default: float = 0.0) -> Column:
    """A number rounded to hundredths; anything else gives the default."""
    return safe_cents(c, round(default * 100)) / F.lit(100.0)


def cast_if_present(df: DataFrame, columns: list[str], to: str) -> DataFrame:
    """Cast those of the listed columns that exist."""
    have = {c.lower() for c in df.columns}
    return df.withColumns({c: F.col(c).try_cast(to) for c in columns if c.lower() in have})
