"""splitmix64 finaliser of a key as Column arithmetic.

Spark has no unsigned 64-bit type and ANSI mode raises on a wrapping bigint multiply, so the 64-bit
state is kept in two bigint columns holding 32-bit lanes (hi, lo). Every partial product stays below
2^50, so nothing overflows and no Python runs on the row path. Each step is its own projection so that
a lane computed once is not re-derived by the next step.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

M32 = 0xFFFFFFFF
M64 = (1 << 64) - 1

# splitmix64's increment (multiplied by the seed) and its two finaliser multipliers,
# and the shifts of its three xor-shift steps.
GOLDEN = 0x9E3779B97F4A7C15
MIX1 = 0xBF58476D1CE4E5B9
MIX2 = 0x94D049BB133111EB
SHIFTS = (30, 27, 31)


def _lanes(value: int) -> tuple[int, int]:
    return (value >> 32) & M32, value & M32


def _low32_mul(u: Column, k: int) -> Column:
    """(u * k) mod 2^32 for 0 <= u, k < 2^32."""
    return ((u * F.lit(k & 0xFFFF)) + F.shiftleft((u * F.lit(k >> 16)).bitwiseAND(0xFFFF), 16)).bitwiseAND(M32)


def _add(hi: Column, lo: Column, c: int) -> tuple[Column, Column]:
    ch, cl = _lanes(c)
    s = lo + F.lit(cl)
    return (hi + F.lit(ch) + F.shiftrightunsigned(s, 32)).bitwiseAND(M32), s.bitwiseAND(M32)


def _mul(hi: Column, lo: Column, c: int) -> tuple[Column, Column]:
    ch, cl = _lanes(c)
    a = lo * F.lit(cl >> 16)
    t = lo * F.lit(cl & 0xFFFF) + F.shiftleft(a.bitwiseAND(0xFFFF), 16)
    carry = F.shiftrightunsigned(t, 32) + F.shiftrightunsigned(a, 16)
    return (carry + _low32_mul(hi, cl) + _low32_mul(lo, ch)).bitwiseAND(M32), t.bitwiseAND(M32)


def _xorshift(hi: Column, lo: Column, k: int) -> tuple[Column, Column]:
    low_part = F.shiftrightunsigned(lo, k).bitwiseOR(F.shiftleft(hi, 32 - k).bitwiseAND(M32))
    return hi.bitwiseXOR(F.shiftrightunsigned(hi, k)), lo.bitwiseXOR(low_part)


def with_unit_hash(df: DataFrame, key: str, seed: int, out: str = "u") -> DataFrame:
    """Adds ``out`` in [0, 1): splitmix64(key + seed * GOLDEN) >> 11, divided by 2^53."""
    k = F.col(key).cast("long")
    step = df.withColumns({"_h": F.shiftrightunsigned(k, 32).bitwiseAND(M32), "_l": k.bitwiseAND(M32)})

    def apply(frame: DataFrame, fn, arg) -> DataFrame:
        hi, lo = fn(F.col("_h"), F.col("_l"), arg)
        return frame.withColumns({"_h": hi, "_l": lo})

    step = apply(step, _add, (seed * GOLDEN) & M64)
    step = apply(step, _xorshift, SHIFTS[0])
    step = apply(step, _mul, MIX1)
    step = apply(step, _xorshift, SHIFTS[1])
    step = apply(step, _mul, MIX2)
    step = apply(step, _xorshift, SHIFTS[2])
    top53 = F.shiftleft(F.col("_h"), 21).bitwiseOR(F.shiftrightunsigned(F.col("_l"), 11))
    # ``u`` leaves through a one-element explode: a filter on it cannot be pushed below the generator,
    # so Catalyst never substitutes the six steps into one predicate (10^4 nodes, beyond codegen).
    return (step.withColumn(out, F.explode(F.array(top53.cast("double") / float(1 << 53))))
            .drop("_h", "_l"))


def unit_hash_reference(key: int, seed: int) -> float:
    """The same function in Python integers, for tests."""
    x = (key + seed * GOLDEN) & M64
    x ^= x >> SHIFTS[0]
    x = (x * MIX1) & M64
    x ^= x >> SHIFTS[1]
    x = (x * MIX2) & M64
    x ^= x >> SHIFTS[2]
    return (x >> 11) / float(1 << 53)
