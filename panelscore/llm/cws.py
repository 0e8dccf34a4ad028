"""Document fingerprints: consistent weighted sampling of term frequencies, on built-in functions only.

For every word of a text with frequency w and every sample k, hashes of (word, k) give r, c ~ Gamma(2, 1) and
b ~ U(0, 1); t = floor(ln w / r + b), ln a = ln c - r (t - b + 1); the sample is the (word, t) with the least a.
Two texts draw the same sample with a probability equal to their generalised Jaccard similarity
(sum of the smaller over sum of the larger frequencies), so the share of equal samples estimates it. A gamma variate
is -ln(u1 u2); each hash gives three uniforms of 21 bits; the least ``a`` is found on its logarithm in steps of
2^-23, ties going to the smaller hash.

Words are ``[^\\x20\\x09-\\x0D]+`` of the lower-cased text. Their frequencies are counted inside the row (sorted word
hashes, run lengths); samples are minimised by a partial aggregate whose rows are one per text and task, so
words never cross the network.

The next document (descending key) is found in blocks of keys: one shuffle brings every block together with its
text, ``lead`` gives the next text inside a block, and the first text of the next non-empty block is joined by block number on
the same partitioning. No window holds more than a block.

Defined results: further columns may have any name, for inner columns take names that the table does not have; a null text is empty; an empty text's fingerprint is all zeros (likeness 1 to another empty one);
a null key comes last, in order of text hash; repeated rows follow each other in any order, being equal; one row alone is its own next;
an empty table gives an empty result.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ordered import with_global_rank
from .common import stored, table

SAMPLES, TOGETHER, SEED = 32, 4, 6
BLOCK_BITS = 6  # 64 consecutive keys a block
SEPARATORS = r"[\x20\x09-\x0D]+"


def terms(text: Column) -> Column:
    """Array of (hash, frequency) of the distinct words of a text."""
    hashes = F.sort_array(F.transform(F.filter(F.split(F.lower(text), SEPARATORS), lambda w: w != ""), lambda w: F.xxhash64(w)))
    # a one-element array binds the sorted hashes to a name, so that they are computed once
    return F.flatten(F.transform(F.array(hashes), lambda a: F.transform(F.array(_starts(a)), lambda s: F.transform(
        s, lambda x, i: F.struct(F.get(a, x).alias("term"), (F.coalesce(F.get(s, i + 1), F.size(a)) - x).alias("tf"))))))[0]


def _starts(a: Column) -> Column:
    """Where the runs of equal values begin in a sorted array."""
    positions = F.when(F.size(a) > 0, F.sequence(F.lit(0), F.size(a) - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(positions, lambda i: (i == 0) | (F.get(a, i) != F.get(a, i - 1)))


def _uniform(h: Column, third: int) -> Column:
    return (F.shiftrightunsigned(h, 21 * third).bitwiseAND(0x1FFFFF) + 0.5) / float(1 << 21)


def with_codes(rows: DataFrame) -> DataFrame:
    """``rows`` (term, ln_tf, g) with ``_c0`` ... ``_c3`` for the samples 4 g ... 4 g + 3: the logarithm of a in the high
    bits, the hash of (term, t) in the low ones. One named step after the other, so that each is computed once."""
    for j in range(TOGETHER):
        c = {n: f"_{n}{j}" for n in ("h", "i", "r", "b", "t", "a", "c")}
        rows = (rows.withColumn(c["h"], F.xxhash64(F.lit(SEED), "term", F.col("g") * TOGETHER + j))
                .withColumn(c["i"], F.xxhash64(c["h"]))
                .withColumn(c["r"], -F.ln(_uniform(F.col(c["h"]), 0) * _uniform(F.col(c["h"]), 1)))
                .withColumn(c["b"], _uniform(F.col(c["i"]), 1))
                .withColumn(c["t"], F.floor(F.col("ln_tf") / F.col(c["r"]) + F.col(c["b"])))
                .withColumn(c["a"], F.ln(-F.ln(_uniform(F.col(c["h"]), 2) * _uniform(F.col(c["i"]), 0))) - F.col(c["r"]) * (F.col(c["t"]) - F.col(c["b"]) + 1))
                .withColumn(c["c"], F.shiftleft(F.floor((F.col(c["a"]) + 128) * (1 << 23)), 32).bitwiseOR(F.xxhash64(c["h"], c["t"]).bitwiseAND(0xFFFFFFFF))))
    return rows


def fingerprints(rows: DataFrame, keys: list[str], texts: list[str], samples: int = SAMPLES) -> DataFrame:
    """For each row (its ``keys`` are unique): an array column of samples for each of its text columns, named like the text.

    ``samples`` is a multiple of ``TOGETHER``: so many are drawn in one step, the rest in further rows."""
    groups = samples // TOGETHER
    each = rows.select(*keys, F.posexplode(F.array(*[terms(F.col(t)) for t in texts])).alias("_which", "_terms"))
    words = each.select(*keys, "_which", F.explode_outer("_terms").alias("_x")).select(*keys, "_which", "_x.term", F.ln("_x.tf").alias("ln_tf"))
    drawn = with_codes(words.select("*", F.explode(F.array(*[F.lit(g) for g in range(groups)])).alias("g")))
    least = drawn.groupBy(*keys, "_which", "g").agg(*[F.min(f"_c{j}").alias(f"_c{j}") for j in range(TOGETHER)])
    at = [(w, g, j) for w in range(len(texts)) for g in range(groups) for j in range(TOGETHER)]
    slots = least.groupBy(*keys).agg(*[F.min(F.when((F.col("_which") == w) & (F.col("g") == g), F.col(f"_c{j}"))).alias(f"_s{w}_{g}_{j}") for w, g, j in at])
    return slots.select(*keys, *[F.array(*[F.coalesce(F.col(f"_s{w}_{g}_{j}").bitwiseAND(0xFFFFFFFF), F.lit(0)) for v, g, j in at if v == w]).alias(t)
                                 for w, t in enumerate(texts)])


def likeness(a: Column, b: Column) -> Column:
    """The share of equal samples."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x) / F.size(a)


def hexadecimal(samples: Column) -> Column:
    return F.array_join(F.transform(samples, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def with_next(documents: DataFrame, key: str, text: str) -> DataFrame:
    """(k, text, next_text) with the row's place (none, block, place) and its successor's (next_none, next_block, next_place)."""
    body = F.coalesce(F.col(text), F.lit(""))
    base = documents.select(F.col(key).alias("k"), body.alias("text"))
    none = F.col("k").isNull().cast("int")
    block = F.when(F.col("k").isNull(), F.shiftright(F.xxhash64("text"), 52)).otherwise(F.shiftright(F.col("k").cast("long"), BLOCK_BITS))
    base = base.withColumns({"none": none, "block": block})
    # one row per block of keys: their order, and for each the block after it
    ranked = with_global_rank(base.select("none", (-F.col("block")).alias("minus")).distinct(), ["none", "minus"], out="at")
    ranked = ranked.select("none", (-F.col("minus")).alias("block"), "at")
    last = ranked.agg(F.max("at")).first()[0] or 0
    after = ranked.select(F.col("none").alias("next_none"), F.col("block").alias("next_block"), F.when(F.col("at") == 1, F.lit(last)).otherwise(F.col("at") - 1).alias("at"))
    order = Window.partitionBy("none", "block").orderBy(F.desc("k"), F.desc(F.xxhash64("text")))
    placed = base.withColumns({"place": F.row_number().over(order), "inside": F.lead("text").over(order)})
    first = placed.where("place = 1").select(F.col("none").alias("next_none"), F.col("block").alias("next_block"), F.col("text").alias("after_text"))
    onward = ranked.join(after, "at").join(first, ["next_none", "next_block"]).drop("at")
    end = F.col("inside").isNull()
    return placed.join(onward, ["none", "block"]).select(
        "k", "text", F.coalesce("inside", "after_text").alias("next_text"), "none", "block", "place",
        F.when(end, F.col("next_none")).otherwise(F.col("none")).alias("next_none"), F.when(end, F.col("next_block")).otherwise(F.col("block")).alias("next_block"),
        F.when(end, 1).otherwise(F.col("place") + 1).alias("next_place"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_next(table(spark, sf_dir, "documents"), "doc_id", "text")
    half = F.floor(F.length("text") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substr("text", F.lit(1), F.length("text") - half), F.substr("next_text", F.lit(1), half)))
    place = ["none", "block", "place"]
    prints = fingerprints(rows, place, ["text", "edited"]).withColumnsRenamed({"text": "own", "edited": "other"})
    meta = rows.select(*place, "next_none", "next_block", "next_place", F.col("k").alias("doc_id"), F.length("text").cast("long").alias("n_chars"),
                       F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"))
    # one job brings a row's texts, samples and place together; the samples of the next row come from what it wrote
    prints = stored(spark, meta.join(prints, place), "fingerprints")
    following = prints.select(F.col("none").alias("next_none"), F.col("block").alias("next_block"), F.col("place").alias("next_place"), F.col("own").alias("following"))
    return (prints.join(following, ["next_none", "next_block", "next_place"])
            .select("doc_id", "n_chars", "edited_sha256", hexadecimal(F.col("own")).alias("fingerprint"), hexadecimal(F.col("other")).alias("edited_fingerprint"),
                    likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("following")).alias("near_next")))
