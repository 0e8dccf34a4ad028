"""SimHash near-duplicates: fingerprints of word shingles, exact linking by tiles, connected components.

A fingerprint bit is 1 if it is set in over half of the XXH64 hashes (seed 42) of the document's shingles,
repeats included. Fingerprints at ``radius`` or fewer differing bits are linked; a group is a component.

Linking compares tiles of distinct fingerprints with numpy exclusive-or and bit counts. The 64 bits are cut into
``PARTS`` parts; a cell holds the fingerprints with the same population count in each part. Two fingerprints
differ in at least as many bits as their parts' population counts differ in sum, so tile pairs of cells that
differ by more than the radius are skipped: an exact filter. Cells are cut into tiles of about ``TILE``
fingerprints by hash, so a hot cell becomes many tile pairs, spread over tasks. A task returns a spanning
forest of each tile pair's links, at most one link per fingerprint, never all pairs of a group.

Components are found by large-star and small-star rounds over those links, each round a written table.
Equal fingerprints are one node throughout, so a third of all rows as exact copies is one row here.

Work: the method compares all pairs of neighbouring cells, so it stays quadratic in distinct fingerprints, at
under 2 % of all pairs for evenly spread bits; tile pairs are independent tasks.

Defined results: further columns may have any name, for inner columns take names that the table does not have; null or empty texts have fingerprint zero and are linked like any other; texts of fewer words
than a shingle hash their whole word sequence; repeated rows share a group; the group id is the smallest
non-null doc_id of the group (null if it has none); an empty table gives an empty result.
"""
from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, free_name, stored, table, words

SHINGLE, RADIUS, SEED = 3, 2, 42
PARTS, TILE = 4, 1024
WIDTH = 64 // PARTS
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_LANES = (np.arange(8, dtype=np.int64) * 256)[None, :]


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text, unsigned."""
    w = words(text)
    if not w:
        return 0
    if len(w) < shingle:
        parts = [b" ".join(w)]
    else:
        parts = map(b" ".join, zip(*(w[i:] for i in range(shingle))))
    h = np.fromiter(map(xxhash.xxh64_intdigest, parts, itertools.repeat(SEED)), np.uint64)
    # how often each byte value occurs in each of the 8 byte lanes, then how often each bit is set
    lanes = np.bincount((h.view(np.uint8).reshape(-1, 8) + _LANES).ravel(), minlength=2048).reshape(8, 256)
    over = (lanes @ _BITS * 2 > len(h)).ravel()
    return int(np.packbits(over, bitorder="little").view(np.uint64)[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint of a text column as a signed long."""
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t, shingle) for t in texts.to_pylist()], np.uint64).view(np.int64))

    return F.arrow_udf(of, "long")(text.cast("binary"))


def links_within(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two tiles (or inside one): every linked fingerprint and the first of its component here."""
    near = np.bitwise_count(a[:, None] ^ b[None, :]) <= radius
    if same:
        near = np.triu(near, 1)
    u, v = np.nonzero(near)  # at most TILE x TILE places
    if not len(u):
        return a[:0], a[:0]
    nodes = a if same else np.concatenate([a, b])
    if not same:
        v += len(a)
    own = np.arange(len(nodes))
    label = own
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    rest = label != own
    return nodes[rest], nodes[label[rest]]


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (u, v) that connect every two fingerprints of ``nodes`` (fp, distinct) at most ``radius`` bits apart."""
    mask = (1 << WIDTH) - 1
    counts = [F.bit_count(F.shiftrightunsigned("fp", WIDTH * p).bitwiseAND(mask)) for p in range(PARTS)]
    cell = lambda part: sum((c * (WIDTH + 1) ** p for p, c in enumerate(part)), F.lit(0))
    placed = nodes.select("fp", cell(counts).cast("int").alias("cell"))
    # one row per cell: at most (WIDTH + 1) ** PARTS = 83,521
    sizes = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("tiles"))
    tiles = stored(nodes.sparkSession, placed.join(F.broadcast(sizes), "cell")
                   .withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")))
                   .groupBy("cell", "tile").agg(F.collect_list("fp").alias("fps")), "tiles")  # about TILE values at most
    steps = [s for s in itertools.product(range(-radius, radius + 1), repeat=PARTS) if sum(map(abs, s)) <= radius and s >= (0,) * PARTS]
    digits = [F.floor(F.col("cell") / (WIDTH + 1) ** p) % (WIDTH + 1) for p in range(PARTS)]
    there = F.array(*[F.when(_all(*[(digits[p] + d).between(0, WIDTH) for p, d in enumerate(s) if d]), F.col("cell") + sum(d * (WIDTH + 1) ** p for p, d in enumerate(s)))
                      for s in steps])
    # each tile meets its partner tiles by their numbers, so a cell of many tiles is as many join keys
    left = tiles.select(F.col("cell").alias("c0"), F.col("tile").alias("t0"), F.col("fps").alias("a"), F.explode(F.array_compact(there)).alias("cell"))
    first = F.when(F.col("c0") == F.col("cell"), F.col("t0")).otherwise(F.lit(0).cast("long"))
    left = left.join(F.broadcast(sizes), "cell").select("c0", "t0", "a", "cell", F.explode(F.sequence(first, F.col("tiles") - 1)).alias("tile"))
    pairs = left.join(tiles, ["cell", "tile"]).select("a", F.col("fps").alias("b"), ((F.col("c0") == F.col("cell")) & (F.col("t0") == F.col("tile"))).alias("same"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            flat = []
            for k in (0, 1):
                values, at = batch.column(k).flatten().to_numpy(zero_copy_only=False).view(np.uint64), batch.column(k).offsets.to_numpy()
                flat.append((values, at - at[0]))
            for r, same in enumerate(batch.column(2).to_pylist()):
                a, b = (v[o[r]:o[r + 1]] for v, o in flat)
                found.append(links_within(a, b, same, radius))
            u, v = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.uint64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    return pairs.mapInArrow(compare, "u long, v long").distinct()


def _all(*conditions: Column) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): large-star and small-star rounds until the links are stars."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.union(e.select("v", "u")).toDF("u", "v")
        if not large:
            both = both.where(F.col("v") < F.col("u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        kept = both.where(F.col("v") > F.col("u")) if large else both
        out = kept.join(low, "u").select("v", "m")
        if not large:
            out = out.union(low.select(F.col("u").alias("v"), "m"))
        return out.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()

    def digest(e: DataFrame):
        r = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        return tuple(r)

    edges = stored(spark, edges, "links")
    seen = digest(edges)
    while seen[0]:
        edges = stored(spark, star(star(edges, True), False), "stars")
        now = digest(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def member_groups(spark: SparkSession, prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, root, component_id) for every distinct fingerprint of ``prints`` (k, fp)."""
    nodes = stored(spark, prints.groupBy("fp").agg(F.min("k").alias("least")), "nodes")
    roots = components(spark, links(nodes.select("fp"), radius))
    member = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = member.groupBy("root").agg(F.min("least").alias("component_id"))
    return stored(spark, member.join(ids, "root").select("fp", "root", "component_id"), "members")


def grouped(spark: SparkSession, documents: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> tuple[DataFrame, DataFrame]:
    """(k, fp) of every row of ``documents``, and (fp, root, component_id) of every distinct fingerprint."""
    bounded_batches(spark)
    prints = stored(spark, documents.select(F.col(key).alias("k"), fingerprint_column(F.col(text), shingle).alias("fp")), "prints")
    return prints, member_groups(spark, prints, radius)


def deduplicated(spark: SparkSession, documents: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``documents`` with one row of each group: that with the smallest key (nulls last), of equal keys one by a hash of the row.

    Rows are written once with their fingerprint and a row number; the winners are a minimum per group over (key, hash, number), combined
    inside the tasks first, so no window or task holds a group of copies.
    """
    names = documents.columns
    fp, row = (free_name(names, n) for n in ("_fp", "_row"))
    bounded_batches(spark)
    held = stored(spark, documents.withColumn(fp, fingerprint_column(F.col(text), shingle)).withColumn(row, F.monotonically_increasing_id()), "fingerprinted")
    prints = held.select(F.col(key).alias("k"), F.col(fp).alias("fp"), F.xxhash64(*names).alias("h"), F.col(row).alias("row"))
    members = member_groups(spark, prints.select("k", "fp"), radius)
    first = F.min(F.struct(F.col("k").isNull().alias("none"), "k", "h", "row"))
    winners = (prints.groupBy("fp").agg(first.alias("w")).join(members.select("fp", "root"), "fp")
               .groupBy("root").agg(F.min("w").alias("w")).select(F.col("w.row").alias(row)))
    # a shuffle join at every size: the winners are nearly as many as the rows
    return held.join(stored(spark, winners, "winners").hint("merge"), row, "left_semi").select(*names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints, members = grouped(spark, table(spark, sf_dir, "documents"))
    return (prints.join(members, "fp")
            .select(F.col("k").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))
