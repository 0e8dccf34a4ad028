"""Mixing sources to target weights: Sainte-Lague apportionment of equal-token blocks.

Every source's documents are laid end to end in a seeded order and cut into blocks of equal token count (to a word).
The mix has ``total / block`` seats; each seat goes to the source with the highest quotient
target / (2 seats + 1), up to two per block; targets are counted in the source's own blocks. The method is house-monotone, so the first i/S of the seats is
itself an apportionment: shard i takes what that adds, an integer quota per shard and source. Which
blocks fill a source's seats follows a seeded permutation i -> (a i + c) mod n of its blocks, walked once and,
beyond n seats, a second time: exactly the quota, no ranking of blocks, at most two copies of any.

A source whose target is less than ``LEAST`` blocks belongs to a tier of sources with a block half as large, or a quarter,
and so on (down to one word), whose seats are apportioned among them. So every source comes within a few ``LEAST``-ths of its target
(or a few words), however large the other sources are.

Targets are water-filled: every source gets weight x level, but at most twice its size; the level solves for the total.

Scale: positions on a source's line are running sums in two steps, inside sqrt(n) hash buckets and over the
bucket sums, so a source with a third of all rows never meets in one task. The driver sees one row per source
(``MAX_SOURCES``, checked) and works out quotas; the largest block is the total over ``SEATS``, so its seats don't grow; a source of a finer tier has at most 2 ``LEAST`` seats.

Defined results: further columns may have any name, for inner columns take names that the table does not have; null texts and keys count as size 0 and as a key like any other; the null source is a source,
last in order; repeated rows are separate documents; an empty table gives an empty result; if all sizes are
zero, nothing is taken. A reread of the same rows gives the same mix: order and selection are hashes of
key and text, and equal rows are interchangeable.
"""
from __future__ import annotations

import heapq
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, stored, table

WEIGHTS, SHARE, REPEAT = (5, 2, 1), 1.5, 2
SEATS, LEAST, SHARDS, SEED, MAX_SOURCES = 1 << 18, 256, 16, 31, 100_000
WORD = r"[^\x20\x09-\x0D]+"


def size_column(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[float], share: float = SHARE, repeat: float = REPEAT) -> list[float]:
    """weight x level for each source, at most ``repeat`` times its size; in sum ``share`` of all sizes."""
    total, out = share * sum(sizes), [0.0] * len(sizes)
    left = sum(weights)
    for i in sorted(range(len(sizes)), key=lambda i: repeat * sizes[i] / weights[i]):  # those that fill up first
        out[i] = float(min(repeat * sizes[i], total * weights[i] / left))
        total -= out[i]
        left -= weights[i]
    return out


def apportion(shares: Sequence[float], limits: Sequence[int], houses: Sequence[int]) -> list[list[int]]:
    """Seats of each source for each house size (increasing): highest quotients share / (2 seats + 1), ties to the first source."""
    seats, out = [0] * len(shares), []
    total = sum(shares)
    for house in houses:
        given = sum(seats)
        if house > given and total > 0:
            # each source has surely reached this many seats (a divisor a bit above the final one), the rest one by one
            divisor = total / house * (1 + 2 * len(shares) / house)
            seats = [max(s, min(limit, math.floor(x / divisor + 0.5) - 1)) for s, x, limit in zip(seats, shares, limits)]
        queue = [(-x / (2 * s + 1), i) for i, (x, s, limit) in enumerate(zip(shares, seats, limits)) if s < limit and x > 0]
        heapq.heapify(queue)
        for _ in range(house - sum(seats)):
            if not queue:
                break
            _, i = heapq.heappop(queue)
            seats[i] += 1
            if seats[i] < limits[i]:
                heapq.heappush(queue, (-shares[i] / (2 * seats[i] + 1), i))
        out.append(list(seats))
    return out


def _stride(n: int) -> int:
    """A multiplier near the golden section of n and coprime to it: its multiples spread evenly over the blocks."""
    a = max(1, round(n * 0.6180339887498949))
    while math.gcd(a, n) != 1:
        a += 1
    return a


def quotas(sizes: dict, seats: int = SEATS, shards: int = SHARDS, seed: int = SEED) -> list[dict]:
    """For each source (by code point, null last) its target, blocks, permutation and seats up to each shard's end.

    The first ``more`` blocks of a source have ``words`` + 1 words, the others ``words``.
    """
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    total = [sizes[s][0] for s in names]
    want = targets(total, [WEIGHTS[i % len(WEIGHTS)] for i in range(len(names))])
    largest = max(1, math.floor(sum(want)) // seats)
    tiers: dict[int, list[int]] = {}
    for i, w in enumerate(want):
        block = largest
        while block > 1 and w < LEAST * block:
            block //= 2
        tiers.setdefault(block, []).append(i)
    blocks, ends = [1] * len(names), [[0] * shards for _ in names]
    for block, own in tiers.items():
        for i in own:
            blocks[i] = max(1, round(total[i] / block))
        shares = [want[i] * blocks[i] / max(1, total[i]) for i in own]  # in the source's own blocks
        house = round(sum(shares))
        found = apportion(shares, [REPEAT * blocks[i] if total[i] else 0 for i in own], [house * (j + 1) // shards for j in range(shards)])
        for k, i in enumerate(own):
            ends[i] = [e[k] for e in found]
    return [{"source": s, "number": i, "source_size": total[i], "target": want[i], "blocks": blocks[i], "words": total[i] // blocks[i], "more": total[i] % blocks[i],
             "stride": _stride(blocks[i]), "start": seed * 7919 % blocks[i], "buckets": max(1, math.isqrt(sizes[s][1])), "ends": ends[i]} for i, s in enumerate(names)]


def mixed(spark: SparkSession, documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
          keep: Sequence[str] | None = None, seats: int = SEATS, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``documents`` (its columns ``keep``; default: all) with size, source_size, target, taken, and pieces: (shard, first
    word, words) of every copy taken. Columns that aren't kept take no part in the shuffle."""
    names = list(documents.columns if keep is None else keep)
    size, src, order, more, bucket, at, pieces, s, b, off = (
        free_name(documents.columns, n) for n in ("_size", "_source", "_order", "_more", "_bucket", "_at", "_pieces", "_s", "_b", "_off"))
    hashed = lambda s: F.xxhash64(F.lit(s), F.col(key), F.col(text))  # noqa: E731  rows with both hashes equal are equal, so interchangeable
    sized = documents.withColumns({size: size_column(F.col(text)), order: hashed(seed), more: hashed(seed + 1)})
    sized = stored(spark, sized.select(*dict.fromkeys([*names, source, size, order, more])), "sized")
    rows = sized.groupBy(source).agg(F.sum(size).alias("t"), F.count(F.lit(1)).alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    plan = quotas({r[0]: (r["t"], r["n"]) for r in rows}, seats, shards, seed)
    p = free_name(documents.columns, "_plan")
    fields = [("source", T.StringType()), ("number", T.LongType()), ("source_size", T.LongType()), ("target", T.DoubleType()), ("blocks", T.LongType()), ("words", T.LongType()), ("more", T.LongType()), ("stride", T.LongType()),
              ("start", T.LongType()), ("buckets", T.LongType()), ("ends", T.ArrayType(T.LongType()))]
    planned = spark.createDataFrame([tuple(x[f] for f, _ in fields) for x in plan], T.StructType([T.StructField(f, t) for f, t in fields]))
    planned = planned.select(F.col("source").alias(s), F.col("number").alias(src), F.struct(*[f for f, _ in fields[2:]]).alias(p))
    on_line = (sized.join(F.broadcast(planned), F.col(source).eqNullSafe(F.col(s))).drop(s)  # one small row per source
               .withColumn(bucket, F.pmod(F.col(order), F.col(f"{p}.buckets"))))
    sums = on_line.groupBy(src, bucket).agg(F.sum(size).alias(off))
    before = Window.partitionBy(src).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col(src).alias(s), F.col(bucket).alias(b), F.coalesce(F.sum(off).over(before), F.lit(0)).alias(off))
    inside = Window.partitionBy(src, bucket).orderBy(order, more).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lined = (on_line.withColumn(at, F.sum(size).over(inside) - F.col(size))
             .join(offsets, (F.col(src) == F.col(s)) & (F.col(bucket) == F.col(b)))  # on the window's own partitioning
             .withColumn(at, F.col(at) + F.col(off)))
    n, q = F.col(f"{p}.blocks"), F.element_at(F.col(f"{p}.ends"), -1)

    words, more_words = F.col(f"{p}.words"), F.col(f"{p}.more")
    begin = lambda i: i * words + F.least(i, more_words)  # noqa: E731  where block i begins

    def block_of(x: Column) -> Column:
        longer = more_words * (words + 1)  # words in blocks that have one more
        return F.when(x < longer, F.floor(x / (words + 1))).otherwise(more_words + F.floor((x - longer) / words))

    def pieces_of(i: Column) -> Column:
        first = F.greatest(F.col(at), begin(i))
        length = F.least(F.col(at) + F.col(size), begin(i + 1)) - first
        slot = F.pmod(i * F.col(f"{p}.stride") + F.col(f"{p}.start"), n)
        piece = lambda x: F.when(x < q, F.struct(F.size(F.filter(F.col(f"{p}.ends"), lambda e: e <= x)).alias("shard"),
                                                 (first - F.col(at)).alias("first"), length.alias("words")))
        return F.array_compact(F.array(*[piece(slot + r * n) for r in range(REPEAT)]))

    covered = F.when(F.col(size) > 0, F.sequence(block_of(F.col(at)), block_of(F.col(at) + F.col(size) - 1))).otherwise(F.array().cast("array<bigint>"))
    out = lined.withColumn(pieces, F.flatten(F.transform(covered, pieces_of)))
    own = (F.col(size), F.col(f"{p}.source_size"), F.col(f"{p}.target"), F.aggregate(pieces, F.lit(0).cast("long"), lambda a, x: a + x["words"]), F.col(pieces))
    return out.select(*names, *[c.alias(n) for c, n in zip(own, mix_columns(names))])


def mix_columns(names: Sequence[str]) -> list[str]:
    """What the mix's own columns are called beside columns ``names``: underscores are appended to a name that is taken."""
    return [free_name(names, c) for c in ("size", "source_size", "target", "taken", "pieces")]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixed(spark, table(spark, sf_dir, "documents").select("doc_id", "source", "text"), keep=["doc_id"])
    return mix.drop("pieces")
