"""Numeric helpers shared by reports and the oracle-facing queries."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column, so sums taken in another order compare equal."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def ratio(num: Column, den: Column) -> Column:
    """num / den as a double, NULL when den is 0 or NULL (ANSI division would raise, SURVEY H11)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def round_report(c: Column, digits: int) -> Column:
    """Python's ``round(x, digits)`` of a double: the nearest decimal to the exact binary value, halves to even.

    ``bround`` rounds the shortest decimal text, which differs just beside a tie (2.675 is a bit less than it
    looks). So near a tie the exact value is compared with it in integers: |x| = (m + (r1 + r2) / 2^32) / 2^30
    with integers m, r1 and a rest r2 < 1 for the part of |x| after the point, all exact in doubles and longs."""
    if not 0 <= digits <= 6:
        raise ValueError("0 to 6 digits")
    scale, x = 10 ** digits, F.abs(c)
    safe = F.when(x < 1e9, x)
    whole = F.floor(safe)
    part = safe - whole
    k = F.floor(part * scale)  # near a tie the product is far from an integer, so rounding can't move it over one
    scaled = part * float(1 << 30)
    m = F.floor(scaled)
    rest = (scaled - m) * float(1 << 32)
    r1 = F.floor(rest)
    off = m * (2 * scale) - (k * 2 + 1) * (1 << 30)  # (part - tie) * 2 * scale * 2^30, without the rest
    near = F.abs(off) <= 2 * scale
    side = F.when(near, off * (1 << 32) + r1 * (2 * scale))
    up = (side > 0) | ((side == 0) & ((rest > r1) | ((whole * scale + k) % 2 == 1)))
    decided = (whole * scale + k + up.cast("long")).cast("double") / float(scale)
    return F.when(near, F.when(c < 0, -decided).otherwise(decided)).otherwise(F.bround(c, digits))
