"""Toxicity severity: cumulative-link (proportional odds) regression on sparse text features.

Features are hashed words and their beginnings of ``PREFIXES`` bytes (A-Z lower-cased, ASCII punctuation removed), each
counted once in a text; through the beginnings, inflected and compound forms share what their stem says. One weight vector is shared by all ordered thresholds: P(grade >= j) = sigmoid(w.x - theta_j), theta increasing.
The outputs are these probabilities, the expected severity (their sum) and the decision P(grade >= 1) >= ``TOXIC_AT``:
somewhat under a half, since toxic rows are few in the training sample and their probabilities are drawn towards it.

``labels.toxic`` marks documents 0 or 1 only, so grades are derived in the training sample: clean rows are
grade 0; toxic rows are grade 2 if they hold at least the median number of marker words (words at least
``MARKER_RATIO`` times as frequent in toxic as in clean rows), else grade 1. ``fit_numpy`` takes any grades.

The model is fitted on the driver from a bounded seeded sample of the labelled rows (``train_rows``) by
proximal gradient steps with an L1 penalty, so that only telling words keep a weight. Scoring covers every row.

Defined results: further columns may have any name, for inner columns take names that the table does not have; null and empty texts have no features and get the thresholds' probabilities; repeated rows are
scored one by one; without labelled rows nothing is toxic; a key with several labels counts as toxic if one says so.
"""
from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER_WORDS, arrays, bounded_batches, in_fold, labelled_sample, release_memory, table

BUCKETS, TRAIN_ROWS, SEED = 1 << 20, 6000, 11
ROUNDS, RATE, L1, MIN_ROWS = 150, 0.3, 0.04, 5
PREFIXES = (4, 5, 6)
MARKER_RATIO = 10.0
CACHE_WORDS = 100_000
TOXIC_AT = 0.4


def distinct_words(text: bytes | None) -> set[bytes]:
    return set(text.translate(LOWER_WORDS).split()) if text else set()


def buckets(word: bytes) -> list[int]:
    """The features of a word: itself and its beginnings."""
    return [zlib.crc32(word) % BUCKETS] + [zlib.crc32(word[:n], n) % BUCKETS for n in PREFIXES if len(word) > n]


def _buckets(text: pa.Array) -> pa.Array:
    return pa.array([np.array(sorted({b for w in distinct_words(t) for b in buckets(w)}), np.int32).tobytes() for t in text.to_pylist()], pa.binary())


def grades(ids: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Grades 0, 1, 2 from toxic marks, by the number of marker words."""
    bad = [i for i, t in zip(ids, toxic) if t]
    if not bad:
        return np.zeros(len(ids), np.int64)
    clean = [i for i, t in zip(ids, toxic) if not t]
    count = lambda rows: np.bincount(np.concatenate(rows) if rows else np.zeros(0, np.int64), minlength=BUCKETS)
    in_bad, in_clean = count(bad), count(clean)
    marker = (in_bad >= MIN_ROWS) & (in_bad / len(bad) >= MARKER_RATIO * (in_clean + 1) / (len(clean) + 1))
    held = np.array([marker[i].sum() for i in ids])
    return np.where(toxic == 0, 0, np.where(held >= np.median(held[toxic == 1]), 2, 1))


def fit_numpy(ids: list[np.ndarray], grade: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and the ``levels - 1`` increasing thresholds that fit the grades."""
    n, at = len(grade), np.concatenate(ids)
    row = np.repeat(np.arange(n, dtype=np.int32), [len(i) for i in ids])
    often = np.bincount(at, minlength=BUCKETS)
    keep = often[at] >= MIN_ROWS  # what a few rows hold says nothing about others
    used = np.flatnonzero(often >= MIN_ROWS)
    place = np.zeros(BUCKETS, np.int32)
    place[used] = np.arange(len(used))
    at, row = place[at[keep]], row[keep]
    w, acc = np.zeros(len(used)), np.full(len(used), 1e-12)
    above = np.array([(grade >= j).sum() for j in range(1, levels)])
    theta = -np.log((above + 0.5) / (n - above + 0.5))
    theta_acc = np.full(levels - 1, 1e-12)
    penalty = L1 / np.sqrt(n)  # as the noise of a mean over n rows
    for _ in range(ROUNDS):
        s = np.bincount(row, w[at], n)
        f = 1.0 / (1.0 + np.exp(-np.clip(s[:, None] - theta, -50, 50)))
        f = np.hstack([np.ones((n, 1)), f, np.zeros((n, 1))])
        low, high = f[np.arange(n), grade], f[np.arange(n), grade + 1]
        p = np.maximum(low - high, 1e-12)
        g = -np.bincount(at, (1.0 - low - high)[row], len(used)) / n
        acc += g * g
        step = RATE / np.sqrt(acc)
        w -= step * g
        w = np.sign(w) * np.maximum(np.abs(w) - step * penalty, 0)
        slope = np.zeros((n, levels + 1))
        slope[np.arange(n), grade] -= low * (1 - low) / p
        slope[np.arange(n), grade + 1] += high * (1 - high) / p
        gt = -slope[:, 1:levels].sum(0) / n
        theta_acc += gt * gt
        theta = np.sort(theta - RATE * gt / np.sqrt(theta_acc))
    weights = np.zeros(BUCKETS)
    weights[used] = w
    return weights, theta


def fit(documents: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", key: str = "doc_id", text: str = "text",
        train_rows: int = TRAIN_ROWS, seed: int = SEED) -> tuple[dict[int, float], np.ndarray]:
    """The buckets with a weight and the thresholds, from about ``train_rows`` labelled rows that satisfy ``learn``."""
    bounded_batches(documents.sparkSession)
    marks = (labels.where(F.col(label).isin(0, 1) & learn).groupBy(F.col(key).alias("_k"))
             .agg(F.max(label).cast("int").alias("_y")))
    rows = (labelled_sample(documents.sparkSession, documents, marks, train_rows, seed, key, text)
            .select("_y", F.arrow_udf(_buckets, "binary")("_t").alias("_ids")).toArrow())
    found, marked = arrays(rows["_ids"], np.int32), rows["_y"].to_numpy()
    order = sorted(range(len(found)), key=lambda i: (marked[i], found[i].tobytes()))
    toxic, ids = np.array([marked[i] for i in order], np.int64), [found[i] for i in order]
    if not toxic.any():
        return {}, np.array([30.0, 31.0])
    w, theta = fit_numpy(ids, grades(ids, toxic), 3)
    del rows, found, ids
    release_memory()
    return {int(i): float(w[i]) for i in np.flatnonzero(w)}, theta


def severity(spark: SparkSession, model: tuple[dict[int, float], np.ndarray]):
    """A function of a text column: struct of p_any = P(grade >= 1) and the expected severity."""
    shared = spark.sparkContext.broadcast(model)  # at most the words of the bounded sample

    class Known(dict):
        def __missing__(self, word):
            weights = shared.value[0]
            self[word] = found = tuple(b for b in buckets(word) if b in weights)
            return found

    bounded_batches(spark)
    known = Known()  # a task's own, kept from batch to batch

    def score(text: pa.Array) -> pa.Array:
        (weights, theta), out = shared.value, []
        for t in text.to_pylist():
            if len(known) > CACHE_WORDS:
                known.clear()
            s = math.fsum(map(weights.__getitem__, set().union(*map(known.__getitem__, distinct_words(t)))))
            above = [1.0 / (1.0 + math.exp(max(-700.0, min(700.0, x - s)))) for x in theta]
            out.append({"p_any": above[0], "severity": sum(above)})
        return pa.array(out, pa.struct([("p_any", pa.float64()), ("severity", pa.float64())]))

    udf = F.arrow_udf(score, "struct<p_any:double,severity:double>")
    return lambda text: udf(text.cast("binary"))


def graded(spark: SparkSession, documents: DataFrame, labels: DataFrame, out: str = "toxicity") -> DataFrame:
    """``documents`` with a struct column ``out`` (p_any, severity), learned from the rows outside the held-out fold."""
    model = fit(documents, labels, ~in_fold(F.col("doc_id"), 4, 2))
    return documents.withColumn(out, severity(spark, model)(F.col("text")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = graded(spark, docs, table(spark, sf_dir, "labels")).select("doc_id", "toxicity.*")
    return rows.select("doc_id", in_fold(F.col("doc_id"), 4, 2).alias("held_out"), "p_any", F.col("severity").alias("expected_severity"),
                       (F.col("p_any") >= TOXIC_AT).cast("int").alias("toxic_predicted"))
