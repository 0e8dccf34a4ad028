"""Language-model scoring: a log-bilinear model trained with noise-contrastive estimation in numpy.

The model predicts a token's class from the classes of the two tokens before it:
``s(c | a, b) = (Q1[a] + Q2[b]) . R[c] + bias[c]``. The ``OWN`` most frequent tokens are classes of their own; every
other token belongs to one of ``SHARED`` classes by a hash of its last three bytes, and within a class has its
smoothed share of the class's count: (n + 0.1) / (class count + 0.1 (class types + 1)). So the probabilities of all
known tokens, and of one unknown token per shared class, sum to one.

Training: noise-contrastive estimation on all training tokens. Every task runs over its documents from the same
parameters; the tasks' results are averaged by tokens (``ROUNDS`` rounds). What reaches the driver is a fixed number of
parameter blocks. Token counts are a distributed aggregate over all training texts.

Scoring: normalised class log-probabilities for all pairs of contexts come from batched matrix products
(log sum over c of exp(A1[a, c]) exp(A2[b, c]) is one product), so a token costs three look-ups. The
``LOCAL`` most frequent tokens are broadcast with their counts (a bounded size); a document's other tokens meet
their counts in a join on the token and come back as one sum per document.

Scale: nothing that grows with the corpus is broadcast or collected; a token outside ``LOCAL`` has at most a
1/``LOCAL`` share of all tokens, so no join key is hot. A row's number is fixed once the scored rows are written.

Defined results: further columns may have any name, for inner columns take names that the table does not have; null and empty texts are the end token alone; rows without a doc_id are held out; repeated rows
are scored one by one; without training rows every count is 0 and the base probability of a token is 1.
"""
from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, in_fold, stored, table, words

OWN, SHARED, LOCAL = 1024, 1024, 1 << 17
LOCAL_BYTES, MOST_WORD = 16 << 20, 1024
CLASSES = OWN + SHARED
DIM, NOISE, BATCH, RATE, ROUNDS, SEED = 16, 16, 2048, 0.15, 1, 4
SUMS, FLUSH = 32, 400_000
END = b"\n"  # no word can be this
ALPHA = 0.1


def shared_class(token: bytes) -> int:
    return OWN + zlib.crc32(token[-3:]) % SHARED


def token_counts(texts: DataFrame) -> DataFrame:
    """(token, n) over the column ``t`` of ``texts``, the end token of each text included."""
    def one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def flushed():
            return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], ["token", "n"])

        for b in batches:
            for t in b.column(0).to_pylist():
                found.update(words(t))
                found[END] += 1
                if len(found) > FLUSH:
                    yield flushed()
                    found.clear()
        yield flushed()

    return texts.mapInArrow(one_task, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, limit: int, most_bytes: int = LOCAL_BYTES) -> list[tuple[bytes, int]]:
    """At most ``limit`` tokens of at most ``most_bytes`` bytes in all: END if it occurs, then the most frequent down to a count found from a
    histogram (16 bins for each doubling); of the first bin that does not fit whole, the share with the smallest hashes."""
    level = F.floor(F.log2("n") * 16).cast("long")
    size = F.octet_length("token").cast("long")
    below, kept, held, share = -1, 0, 0, 0.0
    for r in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("k"), F.sum(size).alias("size")).orderBy(F.desc("level")).collect():  # under 1024 bins
        if kept + r["k"] > limit or held + r["size"] > most_bytes:
            below = r["level"]
            share = 0.9 * min((limit - kept) / r["k"], (most_bytes - held) / max(1, r["size"]))  # hashes spread: a tenth is left for chance
            break
        kept, held = kept + r["k"], held + r["size"]
    cells = 1 << 40
    part = (level == below) & (F.pmod(F.xxhash64(F.lit(SEED), "token"), F.lit(cells)) < int(cells * share)) & (size <= MOST_WORD)
    found = counts.where((level > below) | part | (F.col("token") == F.lit(END))).toArrow()
    return sorted(zip(found["token"].to_pylist(), found["n"].to_pylist()), key=lambda x: (-x[1], x[0]))


def vocabulary_of(top: list[tuple[bytes, int]], totals: dict[int, tuple[int, int]], tokens: int, types: int) -> SimpleNamespace:
    """The broadcast part: the ``LOCAL`` most frequent tokens with their counts, and the classes' totals.

    totals: (tokens, types) of all tokens by shared class; the tokens with a class of their own are taken out here.
    """
    names = [t for t, _ in top]
    own = [t for t in names if t != END][:OWN - 1]
    n = np.array([c for _, c in top], np.float64)
    number = {END: 0} | {t: i + 1 for i, t in enumerate(own)}
    classes = np.array([number[t] if t in number else shared_class(t) for t in names], np.int64)
    class_n, class_types = np.zeros(CLASSES), np.zeros(CLASSES)
    for c, (m, k) in totals.items():
        class_n[c], class_types[c] = m, k
    for t, c in top:
        if t in number:
            s = shared_class(t)
            class_n[s] -= c
            class_types[s] -= 1
            class_n[number[t]] = c
    smooth = np.log10(class_n + ALPHA * (class_types + 1))
    log_n = np.log10(n + ALPHA)
    return SimpleNamespace(names=names, classes=classes, smooth=smooth, log_n=log_n, within=np.where(classes < OWN, 0.0, log_n - smooth[classes]),
                           base=math.log10(tokens + ALPHA * (types + 1)), noise=(class_n + 1.0) / (class_n + 1.0).sum())


def numbered(v: SimpleNamespace) -> dict[bytes, int]:
    return {t: i for i, t in enumerate(v.names)}


def text_classes(v: SimpleNamespace, ws: list[bytes], ids: np.ndarray) -> np.ndarray:
    """The classes of a text's words after two starts, and the end; ids: the words' numbers in the vocabulary, -1 for others."""
    out = np.zeros(len(ws) + 3, np.int64)
    known = ids >= 0
    out[2:-1][known] = v.classes[ids[known]]
    for i in np.flatnonzero(~known):
        out[i + 2] = shared_class(ws[i])
    return out


def first_parameters() -> dict[str, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return {k: rng.normal(0, 0.1, (CLASSES, DIM)).astype(np.float32) for k in ("q1", "q2", "r")}


def nce_step(p: dict, acc: dict, rng: np.random.Generator, log_noise: np.ndarray, noise_cdf: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> None:
    """One minibatch: data tokens ``c`` after ``a`` (one before) and ``b`` (two before) against shared noise tokens."""
    n = np.searchsorted(noise_cdf, rng.random(NOISE)).clip(0, CLASSES - 1)
    h = p["q1"][a] + p["q2"][b]
    rc, rn = p["r"][c], p["r"][n]
    shift = math.log(NOISE)
    true = np.einsum("ij,ij->i", h, rc) + p["bias"][c] - log_noise[c] - shift
    false = h @ rn.T + (p["bias"][n] - log_noise[n] - shift)
    up = 1.0 / (1.0 + np.exp(np.clip(true, -30, 30)))
    down = -1.0 / (1.0 + np.exp(np.clip(-false, -30, 30)))
    back = up[:, None] * rc + down @ rn
    grads = (("q1", a, back), ("q2", b, back), ("r", np.concatenate([c, n]), np.concatenate([up[:, None] * h, down.T @ h])))
    for name, rows, g in grads:
        order = np.argsort(rows, kind="stable")
        sorted_rows = rows[order]
        first = np.flatnonzero(np.concatenate([[True], sorted_rows[1:] != sorted_rows[:-1]]))
        at, total = sorted_rows[first], np.add.reduceat(g[order], first, axis=0)
        acc[name][at] += (total * total).mean(1)
        p[name][at] += RATE * total / np.sqrt(acc[name][at])[:, None]
    at = np.concatenate([c, n])
    total = np.bincount(at, np.concatenate([up, down.sum(0)]), CLASSES).astype(np.float32)
    acc["bias"] += total * total
    p["bias"] += 0.3 * RATE * total / np.sqrt(acc["bias"])


def train(spark: SparkSession, texts: DataFrame, vocabulary, parameters: dict) -> dict[str, np.ndarray]:
    """One round: NCE over every text in each task from ``parameters``, then the mean of the results by tokens."""
    names = ("q1", "q2", "r", "bias")
    shapes = {k: parameters[k].shape for k in names}
    shared = spark.sparkContext.broadcast(parameters)  # a fixed size

    def pack(p: dict, weight: float) -> pa.RecordBatch:
        flat = np.concatenate([p[k].ravel() for k in names]).astype(np.float32)
        return pa.RecordBatch.from_arrays([pa.array([weight]), pa.array([flat.tobytes()], pa.binary())], ["weight", "flat"])

    def one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary.value
        index = numbered(v)
        p = {k: x.copy() for k, x in shared.value.items()}
        acc = {k: np.full(CLASSES, 1e-3, np.float32) for k in names}
        rng, log_noise, cdf, seen = np.random.default_rng(SEED), np.log(v.noise).astype(np.float32), np.cumsum(v.noise), 0
        for batch in batches:
            a, b, c, n = [], [], [], 0
            column = batch.column(0)
            for i in range(len(column)):
                ws = words(column[i].as_py())
                ids = np.fromiter(map(index.get, ws, itertools.repeat(-1)), np.int64, len(ws))
                line = text_classes(v, ws, ids)
                a.append(line[1:-1])
                b.append(line[:-2])
                c.append(line[2:])
                n += len(c[-1])
                if n >= 64 * BATCH or i + 1 == len(column):
                    x, y, z = (np.concatenate(k) for k in (a, b, c))
                    order = rng.permutation(n)
                    for s in range(0, n, BATCH):
                        o = order[s:s + BATCH]
                        nce_step(p, acc, rng, log_noise, cdf, x[o], y[o], z[o])
                    seen += n
                    a, b, c, n = [], [], [], 0
        if seen:
            yield pack(p, float(seen))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weight = None, 0.0
        for batch in batches:
            for w, flat in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = np.frombuffer(flat, np.float32) * np.float32(w)
                total, weight = x if total is None else total + x, weight + w
        if weight:
            yield pa.RecordBatch.from_arrays([pa.array([weight]), pa.array([(total / np.float32(weight)).tobytes()], pa.binary())], ["weight", "flat"])

    schema = "weight double, flat binary"
    rows = texts.mapInArrow(one_task, schema).repartition(SUMS).mapInArrow(added, schema).collect()  # SUMS blocks at most
    if not rows:
        return parameters
    weight = sum(r["weight"] for r in rows)
    flat = sum(np.frombuffer(bytes(r["flat"]), np.float32) * np.float32(r["weight"] / weight) for r in sorted(rows, key=lambda r: (r["weight"], bytes(r["flat"]))))
    out, at = {}, 0
    for k in names:
        size = math.prod(shapes[k])
        out[k] = flat[at:at + size].reshape(shapes[k])
        at += size
    return out


def log_tables(p: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A1 (with the bias), A2 and the log normaliser by context pair: log10 P(c | a, b) = A1[a, c] + A2[b, c] - Z[a, b]."""
    a1, a2 = p["q1"] @ p["r"].T + p["bias"], p["q2"] @ p["r"].T
    m1, m2 = a1.max(1, keepdims=True), a2.max(1, keepdims=True)
    z = np.log(np.maximum(np.exp(a1 - m1) @ np.exp(a2 - m2).T, 1e-37)) + m1 + m2.T
    scale = np.float32(1 / math.log(10))
    return (a1 * scale).astype(np.float32), (a2 * scale).astype(np.float32), (z * scale).astype(np.float32)


ROW = pa.struct([("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("lm", pa.float64()),
                 ("tail", pa.list_(pa.struct([("token", pa.binary()), ("tf", pa.int32())])))])
SQL_ROW = "struct<n_tokens:long,known:long,base:double,lm:double,tail:array<struct<token:binary,tf:int>>>"


def scored(spark: SparkSession, documents: DataFrame, learn: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, learn, n_tokens, n_known, train_tokens, base_score, score) for every row of ``documents``."""
    bounded_batches(spark)
    texts = documents.where(learn).select(F.col(text).cast("binary").alias("t"))
    counts = stored(spark, token_counts(texts), "counts")
    shared = F.crc32(F.substring("token", -3, 3)) % SHARED + OWN
    totals = counts.groupBy(shared.cast("int").alias("c")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).collect()  # SHARED rows
    tokens, types = sum(r["n"] for r in totals), sum(r["k"] for r in totals)
    v = vocabulary_of(most_frequent(counts, LOCAL), {r["c"]: (r["n"], r["k"]) for r in totals}, tokens, types)
    vocabulary = spark.sparkContext.broadcast(v)
    parameters = first_parameters() | {"bias": np.log(v.noise).astype(np.float32)}
    for _ in range(ROUNDS):
        parameters = train(spark, texts, vocabulary, parameters)
    tables = spark.sparkContext.broadcast(log_tables(parameters))  # a fixed size

    numbers: dict[bytes, int] = {}  # a task's own, kept from batch to batch

    def local(column: pa.Array) -> pa.Array:
        v, (a1, a2, z) = vocabulary.value, tables.value
        if not numbers:
            numbers.update(numbered(v))
        index, out = numbers, []
        end = index.get(END)
        for i in range(len(column)):
            ws = words(column[i].as_py())
            ids = np.fromiter(map(index.get, ws, itertools.repeat(-1)), np.int64, len(ws))
            line = text_classes(v, ws, ids)
            a, b, c = line[1:-1], line[:-2], line[2:]
            known = ids[ids >= 0]
            lm = float((a1[a, c].astype(np.float64) + a2[b, c] - z[a, b]).sum()) + float(v.within[known].sum())
            tail = Counter(ws[j] for j in np.flatnonzero(ids < 0))
            rare = line[2:-1][ids < 0]
            lm -= float(v.smooth[rare].sum())
            base = float(v.log_n[known].sum()) + (float(v.log_n[end]) if end is not None else math.log10(ALPHA)) - (len(ws) + 1) * v.base
            out.append({"n_tokens": len(ws) + 1, "known": len(known) + (end is not None), "base": base, "lm": lm,
                        "tail": [{"token": t, "tf": n} for t, n in tail.items()]})
        return pa.array(out, ROW)

    rows = stored(spark, documents.select(F.col(key).alias("k"), learn.alias("learn"), F.monotonically_increasing_id().alias("row"),
                                          F.arrow_udf(local, SQL_ROW)(F.col(text).cast("binary")).alias("s")).select("k", "learn", "row", "s.*"), "scored")
    tail = rows.select("row", F.explode("tail").alias("x")).select("row", "x.*").join(counts, "token", "left")
    sums = tail.groupBy("row").agg(F.sum(F.when(F.col("n").isNotNull(), F.col("tf")).otherwise(0)).alias("tail_known"),
                                   F.sum(F.col("tf") * F.log10(F.coalesce("n", F.lit(0)) + ALPHA)).alias("tail_log"))
    extra = lambda c: F.coalesce(c, F.lit(0))
    return rows.drop("tail").join(sums, "row", "left").select(
        F.col("k").alias(key), "learn", "n_tokens", (F.col("known") + extra("tail_known")).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + extra("tail_log")).alias("base_score"), (F.col("lm") + extra("tail_log")).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = in_fold(F.col("doc_id"), 10, 0)
    return scored(spark, docs, ~held_out).withColumn("held_out", ~F.col("learn")).drop("learn")
