"""Order-independent sums, averages and rounding.

Sums of doubles depend on the order in which partitions arrive. Amounts are therefore
summed as whole ten-thousandths, and divided once at the end. A sum has two limbs, the units above and below 2^24, each a
BIGINT: the aggregate stays in code-generated long arithmetic, and neither 10^11 rows of a group nor a few corrupt amounts
of up to 10^20 overflow it. The limbs meet in a DECIMAL, once per group.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = 4
SCALE = 10**DIGITS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def scaled(c: Column | str, scale: int = SCALE) -> Column:
    """A decimal amount held in a double, as a whole number of ``1/scale`` units, halves away from zero."""
    units = _col(c) * F.lit(float(scale))
    return F.when(units < 0, -F.floor(F.lit(0.5) - units)).otherwise(F.floor(units + F.lit(0.5)))


def cents(c: Column | str) -> Column:
    return scaled(c, 100)


LIMB_BITS = 24
LIMB = 1 << LIMB_BITS
WIDE = "decimal(38,0)"


def _joined(high: Column, low: Column) -> Column:
    return (F.sum(high).cast("decimal(28,0)") * F.lit(LIMB).cast("decimal(10,0)") + F.sum(low).cast("decimal(28,0)")).cast(WIDE)


def units_sum(c: Column | str, scale: int = SCALE) -> Column:
    """Exact sum of amounts held in doubles, as a whole number of ``1/scale`` units, each rounded half away from zero."""
    units = _col(c) * F.lit(float(scale))
    size = F.abs(units)
    high = F.floor(size / F.lit(float(LIMB)))
    low = F.floor(size - high.cast("double") * F.lit(float(LIMB)) + F.lit(0.5))
    return _joined(F.when(units < 0, -high).otherwise(high), F.when(units < 0, -low).otherwise(low))


def long_sum(c: Column | str) -> Column:
    """Exact sum of whole numbers that cannot overflow."""
    value = _col(c).cast("bigint")
    return _joined(F.shiftright(value, LIMB_BITS), value.bitwiseAND(F.lit(LIMB - 1).cast("bigint")))


def exact_sum(c: Column | str) -> Column:
    return units_sum(c).cast("double") / F.lit(float(SCALE))


def exact_avg(c: Column | str) -> Column:
    column = _col(c)
    return F.try_divide(units_sum(column).cast("double"), F.count(column) * F.lit(float(SCALE)))


def round_ratio(num: Column, den: Column, digits: int) -> Column:
    """Half-away-from-zero rounding of a quotient of whole numbers, NULL when ``den`` is 0.

    For aggregated values: the division runs in DECIMAL, so no double tie is misjudged.
    """
    quotient = F.try_divide(num.cast("decimal(28,0)"), den.cast("decimal(20,0)"))
    return F.round(quotient, digits).cast("double")


def rounded_sum(c: Column | str, digits: int = 2) -> Column:
    return round_ratio(units_sum(c), F.lit(SCALE), digits)


def rounded_avg(c: Column | str, digits: int = 2) -> Column:
    column = _col(c)
    return round_ratio(units_sum(column), F.count(column) * F.lit(SCALE), digits)


def round_half_away(num: Column, den: Column) -> Column:
    """Nearest whole number to ``num / den`` for BIGINT ``num`` and positive ``den``, per row."""
    doubled = F.abs(num) * 2 + den
    return F.signum(num.cast("double")).cast("bigint") * F.call_function("div", doubled, den * 2)


def mean_cents(total: Column, n: Column) -> Column:
    """Mean of whole hundredths, rounded to hundredths, as an amount; NULL without rows."""
    return F.when(n > 0, round_half_away(total, n)) / F.lit(100.0)
