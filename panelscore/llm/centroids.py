"""Language identification: nearest centroid over normalised TF-IDF n-gram vectors.

A text's vector counts its hashed byte bigrams and trigrams (lower-cased, ASCII punctuation as spaces, one space
between words), as log(1 + count) times inverse document frequency, scaled to length 1. Each language has several centroids (spherical k-means), compared by
cosine; a text farther from its nearest centroid than that centroid's radius is rejected.

Document frequencies cover every training row (a distributed sum of one row per feature); the centroids are
clustered on the driver from a seeded sample of about ``TRAIN_ROWS`` distinct texts with an equal share per language. The sample
takes a language's texts with the smallest hashes, at least one, so no language is lost and a text's copies come once.

Defined results: further columns may have any name, for inner columns take names that the table does not have; a null text, or one without a letter, is ``und`` with score 0; repeated rows are judged one
by one; with nothing to learn from every text is ``und``. Ties go to the first language by code point.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER_WORDS, bounded_batches, in_fold, table

DIM, PER_LANGUAGE_CENTROIDS, TRAIN_ROWS, MAX_LANGUAGES, SEED = 4096, 4, 3000, 1000, 5
SLACK = 1.25  # a centroid's radius over the largest distance of its own training texts
CHUNK = 256


def counts(text: bytes | None) -> np.ndarray:
    lowered = (text or b"").decode("utf-8", "ignore").lower().encode().translate(LOWER_WORDS)
    b = np.frombuffer(b" ".join(lowered.split()), np.uint8).astype(np.uint32)
    two = b[:-1] << 8 | b[1:]
    three = two[:-1] << 8 | b[2:] if len(b) > 2 else two[:0]
    codes = np.concatenate([two | 1 << 24, three])
    return np.bincount((codes * np.uint32(2654435761)) >> 20, minlength=DIM)


def unit(logs: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = logs * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each feature occurs, and how many texts there are. One row per feature and task is shuffled."""
    def one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(DIM + 1, np.int64)
        for b in batches:
            for t in b.column(0).to_pylist():
                found[:DIM] += counts(t) > 0
                found[DIM] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIM + 1, dtype=np.int32)), pa.array(found)], ["feature", "n"])

    rows = texts.mapInArrow(one_task, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(DIM + 1, np.int64)
    for r in rows:
        found[r["feature"]] = r["n"]
    return found[:DIM], int(found[DIM])


def clusters(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means, seeded farthest first from the mean's nearest row."""
    center = x.mean(0)
    chosen = [int(np.argmax(x @ center))]
    near = x @ x[chosen[0]]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[chosen[-1]])
    c = x[chosen]
    for _ in range(rounds):
        own = np.argmax(x @ c.T, 1)
        c = np.stack([x[own == j].mean(0) if (own == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def fit(documents: DataFrame, learn: Column, text: str = "text", lang: str = "lang", train_rows: int = TRAIN_ROWS, seed: int = SEED) -> dict | None:
    """The model from the rows with a text and a language that satisfy ``learn``; None if there are none."""
    bounded_batches(documents.sparkSession)
    usable = documents.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & learn).select(F.col(text).cast("binary").alias("t"), F.col(lang).alias("l"))
    # each distinct text of a language at its place by hash: copies count once, and every language has a first place
    cells = 1 << 40
    placed = usable.withColumn("place", F.pmod(F.xxhash64(F.lit(seed), "t"), F.lit(cells)))
    sizes = placed.select("l", "place").distinct().groupBy("l").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("low")).limit(MAX_LANGUAGES + 1).collect()
    if not sizes:
        return None
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    df, n = document_frequencies(usable.select("t"))
    idf = np.log((1 + n) / (1 + df)).astype(np.float32) + 1
    each = max(1, train_rows // len(sizes))
    below = F.create_map(*[x for r in sizes for x in (F.lit(r["l"]), F.lit(max(r["low"] + 1, min(cells, cells * each // r["n"]))))])
    picked = placed.where(F.col("place") < below[F.col("l")]).groupBy("l", "place").agg(F.first("t").alias("t"))  # about ``train_rows`` texts

    def logs(texts: pa.Array) -> pa.Array:
        return pa.array([np.log1p(counts(t)).astype(np.float32).tobytes() for t in texts.to_pylist()], pa.binary())

    rows = picked.select("l", F.arrow_udf(logs, "binary")("t").alias("x")).toArrow().to_pydict()
    order = sorted(range(len(rows["l"])), key=lambda i: (rows["l"][i], rows["x"][i]))
    langs = np.array([rows["l"][i] for i in order], object)
    if not len(langs):
        return None
    x = unit(np.stack([np.frombuffer(rows["x"][i], np.float32) for i in order]), idf)
    found = {l: clusters(x[langs == l], PER_LANGUAGE_CENTROIDS) for l in sorted(set(langs))}
    centers = np.concatenate(list(found.values())).astype(np.float32)
    names = np.array([l for l, c in found.items() for _ in c], object)
    best = np.where(langs[:, None] == names[None, :], x @ centers.T, -1.0)
    own = best.argmax(1)
    far = 1 - best.max(1)
    radii = np.array([SLACK * max(far[own == j], default=1.0) for j in range(len(names))])
    return {"idf": idf, "names": names, "centers": centers, "radii": radii}


def has_letter(text: bytes) -> bool:
    return any(map(str.isalpha, text.decode("utf-8", "ignore")))


def identify(spark: SparkSession, model: dict | None):
    """A function of a text column: struct of the nearest language, its cosine and whether it is rejected as too far."""
    bounded_batches(spark)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])
    shared = spark.sparkContext.broadcast(model)  # a fixed size per language

    def predict(text: pa.Array) -> pa.Array:
        m, out = shared.value, []
        texts = text.to_pylist()
        for start in range(0, len(texts), CHUNK):
            part = texts[start:start + CHUNK]
            known = [m is not None and t is not None and has_letter(t) for t in part]
            if not any(known):
                out += [{"lang": "und", "score": 0.0, "rejected": True}] * len(part)
                continue
            logs = np.stack([np.log1p(counts(t)).astype(np.float32) for t in part])
            cosine = unit(logs, m["idf"]) @ m["centers"].T
            best = cosine.argmax(1)
            for k, j, c in zip(known, best, cosine.max(1)):
                score = float(min(1.0, max(0.0, c)))
                out.append({"lang": m["names"][j], "score": score, "rejected": bool(1 - c > m["radii"][j])} if k else {"lang": "und", "score": 0.0, "rejected": True})
        return pa.array(out, kind)

    udf = F.arrow_udf(predict, "struct<lang:string,score:double,rejected:boolean>")
    return lambda text: udf(text.cast("binary"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = in_fold(F.col("doc_id"), 5, 0)
    model = fit(docs, ~held_out)
    rows = docs.select("doc_id", held_out.alias("held_out"), identify(spark, model)(F.col("text")).alias("_m"))
    return rows.select("doc_id", "held_out", F.col("_m.lang").alias("lang_pred"), F.col("_m.score").alias("score"), F.col("_m.rejected").alias("rejected"))
