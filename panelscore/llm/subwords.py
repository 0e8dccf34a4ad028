"""Quality classifier: supervised subword embeddings.

A word is the mean of the learned vectors of its hashed word and character n-grams, a document the mean
of its words, and a softmax layer gives the classes. Vectors and layer are trained together by
minibatch stochastic gradient descent in numpy (step sizes scaled per weight by past gradients). Letters keep their case:
shouting is a mark of quality. So is saying a word again and again: each word that equals the one before it adds the
token ``REPEATED``. The mean is taken over ``NEUTRAL`` zero words more, so that a few odd words don't condemn a short text.

Training reads a bounded, seeded sample of the labelled rows (``train_rows``, a parameter): executors turn
each text into (feature, weight) pairs, and the pairs of the sample (at most ``FIT_BYTES``) reach the driver, which fits the model.
Scoring covers every row: the layer is folded into the vectors, so that a word has one number (its share of
the logit), kept in a bounded cache per task, and a document is the mean of its words' numbers - the same
value as averaging vectors first, since both are linear.

A word is a run of bytes other than spaces, of any length: in text without spaces a sentence or the whole text is one word, and
all its n-grams count. Words are worked through in parts of about ``PART_BYTES`` bytes, which bounds memory, not words.

Defined results: further columns may have any name, for inner columns take names that the table does not have; null and empty texts have the zero vector and get the layer's bias; repeated rows are scored
alike, one by one; with no labelled rows every score is 0.5; with one class, that class's smoothed share.
"""
from __future__ import annotations

import math
import operator
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrays, bounded_batches, in_fold, labelled_sample, release_memory, stored, table

BUCKETS, DIM, MIN_N, MAX_N = 1 << 17, 12, 3, 5
TRAIN_ROWS, EPOCHS, BATCH, RATE, SEED = 4000, 6, 64, 0.25, 20
CACHE_WORDS, CACHE_BYTES, CHUNK, PART_BYTES = 100_000, 16 << 20, 32, 1 << 18
THRESHOLD = 0.7
FIT_BYTES = 256 << 20
REPEATED, NEUTRAL = b"\t=", 6  # no word holds a tab


def tokens(text: bytes | None) -> tuple[list[bytes], int]:
    """The words of a text, and how often a word equals the one before it."""
    ws = text.split() if text else []
    return ws, sum(map(operator.eq, ws, ws[1:]))


def parts(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hash buckets, number of their word) of the words, in parts: the word itself and the byte n-grams of ``<word>``.

    A word longer than ``PART_BYTES`` has parts of its own, cut from its beginning, so no word's parts depend on the others.
    """
    held, size = [], 0
    for i, w in enumerate(words):
        if held and size + len(w) > PART_BYTES:
            yield _part(words, held)
            held, size = [], 0
        if len(w) <= PART_BYTES:
            held.append(i)
            size += len(w) + 2
            continue
        yield np.array([zlib.crc32(w) % BUCKETS]), np.array([i])
        marked = b"<" + w + b">"
        for at in range(0, len(marked), PART_BYTES):
            line = np.frombuffer(marked[at:at + PART_BYTES + MAX_N - 1], np.uint8).astype(np.uint32)
            for k in range(MIN_N, MAX_N + 1):
                ids = _ngrams(line, np.arange(max(0, min(PART_BYTES, len(line) - k + 1))), k)
                if len(ids):
                    yield ids, np.full(len(ids), i)
    if held:
        yield _part(words, held)


def _ngrams(line: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The buckets of the n-grams of ``k`` bytes that begin at the places ``at``."""
    h = np.full(len(at), k, np.uint32)
    for j in range(k):
        h = h * np.uint32(0x01000193) ^ line[at + j]
    return ((h * np.uint32(2654435761)) >> np.uint32(7)).astype(np.int64) % BUCKETS


def _part(words: list[bytes], held: list[int]) -> tuple[np.ndarray, np.ndarray]:
    marked = [b"<" + words[i] + b">" for i in held]
    n = np.array([len(m) for m in marked])
    line = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint32)
    word = np.repeat(held, n)
    left = np.repeat(np.cumsum(n), n) - np.arange(len(line))  # bytes from here to the end of the word
    ids, owner = [np.fromiter((zlib.crc32(words[i]) % BUCKETS for i in held), np.int64, len(held))], [np.array(held)]
    for k in range(MIN_N, MAX_N + 1):
        at = np.flatnonzero(left >= k)
        ids.append(_ngrams(line, at, k))
        owner.append(word[at])
    return np.concatenate(ids), np.concatenate(owner)


def counted_features(words: list[bytes]) -> np.ndarray:
    """How many features each word has."""
    n = np.fromiter(map(len, words), np.int64, len(words)) + 2
    return 1 + sum(np.maximum(n - k + 1, 0) for k in range(MIN_N, MAX_N + 1))


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the words, one word after the other, and how many each word has."""
    ids, owner = (np.concatenate(x) for x in zip(*parts(words)))
    order = np.argsort(owner, kind="stable")
    return ids[order], np.bincount(owner, minlength=len(words))


def word_shares(words: list[bytes], share: np.ndarray) -> np.ndarray:
    """The mean of ``share`` over each word's features."""
    total = np.zeros(len(words))
    for ids, owner in parts(words):
        first = owner[0]  # a part's words follow each other
        found = np.bincount(owner - first, share[ids])
        total[first:first + len(found)] += found
    return total / counted_features(words)


def _merged(pieces: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets and the sums of their weights."""
    ids, at = np.unique(np.concatenate([i for i, _ in pieces]), return_inverse=True)
    return ids, np.bincount(at, np.concatenate([w for _, w in pieces]))


def _document_features(text: pa.Array) -> pa.Array:
    """A document's features: distinct bucket ids and their weights (the mean over tokens of the mean over a token's features)."""
    out = []
    for t in text.to_pylist():
        ws, again = tokens(t)
        if not ws:
            out.append({"ids": b"", "weights": b""})
            continue
        found = Counter(ws)
        found[REPEATED] = again
        names = list(found)
        each = np.fromiter(found.values(), float, len(found)) / counted_features(names) / (found.total() + NEUTRAL)
        pieces = []
        for ids, owner in parts(names):
            ids, at = np.unique(ids, return_inverse=True)
            pieces.append((ids, np.bincount(at, each[owner])))
            if len(pieces) == 32:
                pieces = [_merged(pieces)]
        ids, weights = _merged(pieces)
        out.append({"ids": ids.astype(np.int32).tobytes(), "weights": weights.astype(np.float32).tobytes()})
    return pa.array(out, pa.struct([("ids", pa.binary()), ("weights", pa.binary())]))


def fit_numpy(ids: list[np.ndarray], weights: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, seed: int = SEED):
    """Vectors (bucket x dim), layer (dim x classes) and bias by minibatch SGD on the cross-entropy."""
    rng = np.random.default_rng(seed)
    classes = 2
    vectors = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    layer = rng.normal(0, 0.1, (DIM, classes)).astype(np.float32)
    share = (np.bincount(y, minlength=classes) + 1.0) / (len(y) + classes)
    bias = np.log(share).astype(np.float32)
    gv, gl, gb = np.full(BUCKETS, 1e-6, np.float32), np.full(layer.shape, 1e-6, np.float32), np.full(classes, 1e-6, np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for start in range(0, len(y), BATCH):
            rows = order[start:start + BATCH]
            n = [len(ids[r]) for r in rows]
            if not sum(n):
                continue
            at, w, doc = np.concatenate([ids[r] for r in rows]), np.concatenate([weights[r] for r in rows]), np.repeat(np.arange(len(rows)), n)
            part = vectors[at] * w[:, None]
            mean = np.stack([np.bincount(doc, part[:, d], len(rows)) for d in range(DIM)], 1).astype(np.float32)
            logits = mean @ layer + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            p /= len(rows)
            back = p @ layer.T
            grad_layer, grad_bias = mean.T @ p, p.sum(0)
            touched, inverse = np.unique(at, return_inverse=True)
            grad = np.stack([np.bincount(inverse, w * back[doc, d], len(touched)) for d in range(DIM)], 1).astype(np.float32)
            gv[touched] += (grad * grad).mean(1)
            vectors[touched] -= RATE * grad / np.sqrt(gv[touched])[:, None]
            gl += grad_layer ** 2
            layer -= RATE * grad_layer / np.sqrt(gl)
            gb += grad_bias ** 2
            bias -= 0.1 * RATE * grad_bias / np.sqrt(gb)
    return vectors, layer, bias


def fit(documents: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", key: str = "doc_id", text: str = "text",
        train_rows: int = TRAIN_ROWS, seed: int = SEED) -> tuple[np.ndarray, float]:
    """Fit on about ``train_rows`` labelled rows that satisfy ``learn`` (a condition on the key).

    A key with several labels counts with the lowest. Returns what scoring needs: each bucket's share of the
    logit of class 1 against class 0, and the bias.
    """
    bounded_batches(documents.sparkSession)
    marks = (labels.where(F.col(label).isin(0, 1) & learn).groupBy(F.col(key).alias("_k"))
             .agg(F.min(label).cast("int").alias("_y")))
    spark = documents.sparkSession
    found = stored(spark, labelled_sample(spark, documents, marks, train_rows, seed, key, text)
                   .select("_y", F.xxhash64(F.lit(seed), "_k", "_t").alias("_o"), F.arrow_udf(_document_features, "struct<ids:binary,weights:binary>")("_t").alias("_f"))
                   .select("_y", "_o", "_f.*"), "features")
    last, held = None, 0
    for r in found.select("_o", (F.octet_length("ids") + F.octet_length("weights")).alias("size")).orderBy("_o").collect():  # about ``train_rows`` numbers
        held += r["size"]
        if held > FIT_BYTES and last is not None:
            break
        last = r["_o"]
    rows = found.where(F.col("_o") <= last).toArrow() if last is not None else ()
    if not len(rows):
        return np.zeros(BUCKETS, np.float32), 0.0
    order = np.lexsort((rows["_y"].to_numpy(), rows["_o"].to_numpy()))
    y = rows["_y"].to_numpy()[order].astype(np.int64)
    ids, weights = ([found[i] for i in order] for found in (arrays(rows["ids"], np.int32), arrays(rows["weights"], np.float32)))
    vectors, layer, bias = fit_numpy(ids, weights, y, seed=seed)
    del rows, ids, weights
    release_memory()
    return vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0])


def probability(spark: SparkSession, model: tuple[np.ndarray, float]):
    """A function of a text column: the probability of class 1."""
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # BUCKETS floats, a fixed size
    known: dict[bytes, float] = {}  # a task's own, kept from batch to batch
    held = [0]  # bytes of the words in it

    def score(text: pa.Array) -> pa.Array:
        share, bias = shared.value

        out, texts = [], text.to_pylist()
        for start in range(0, len(texts), CHUNK):
            part = [tokens(t) for t in texts[start:start + CHUNK]]
            if len(known) > CACHE_WORDS or held[0] > CACHE_BYTES:
                known.clear()
                held[0] = 0
            new = list({REPEATED}.union(*(ws for ws, _ in part)).difference(known))
            if new:
                known.update(zip(new, word_shares(new, share).tolist()))
                held[0] += sum(map(len, new))
            for ws, again in part:
                z = bias + (math.fsum(map(known.__getitem__, ws)) + again * known[REPEATED]) / (len(ws) + again + NEUTRAL)
                out.append(1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, z)))))
        return pa.array(out, pa.float64())

    udf = F.arrow_udf(score, "double")
    return lambda text: udf(text.cast("binary"))


def scored(spark: SparkSession, documents: DataFrame, labels: DataFrame, score: str = "score") -> DataFrame:
    """``documents`` with the probability of quality 1, learned from the rows outside the held-out fold."""
    model = fit(documents, labels, ~in_fold(F.col("doc_id"), 4, 2))
    return documents.withColumn(score, probability(spark, model)(F.col("text")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (scored(spark, docs, table(spark, sf_dir, "labels"))
            .select("doc_id", in_fold(F.col("doc_id"), 4, 2).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))
