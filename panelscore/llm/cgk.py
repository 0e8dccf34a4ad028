"""Benchmark decontamination: CGK embeddings, bit-sampling LSH over item-sized windows, exact edit verification.

Symbols are words (A-Z lower-cased, ASCII punctuation removed). The CGK random walk reads a window: at step j it
stands at position p, outputs the word there, and moves on by one if a random bit of (j, word) is set. Two
windows at a small edit distance walk in step again soon after each edit, so their outputs differ in few
places: edit distance becomes Hamming distance. A table samples ``SAMPLED`` places of the output as its key;
equal keys make a candidate. ``WALKS`` walks with ``TABLES`` tables each give the recall: over 0.9 for items of 10 to 130 words with all allowed
edits, spread, at random, in one run at the head, middle, tail or anywhere (measured in the tests).

Windows: an item of n words gets the length class L, the largest of a doubling series with 1.75 L <= n + 1.
Documents are walked from every (L/2)-th word only, items from every word that begins a whole window, so every document window that lies in
a copy meets the item's own window at the same place: several in one copy. Long items have windows of half that length too, so that edits that
stand together leave some window alone.
Walks of different classes share their steps.

Candidates that begin near each other are one passage, verified exactly: the least number of word insertions, deletions and substitutions that turn the
item into some stretch of the passage must be at most ``1 - SIMILARITY`` of the item's words.

Items are the query set: they are cut into blocks of at most ``BLOCK_ITEMS`` by hash, each block's key tables are
broadcast (a bounded size), and every row is searched once per block, row by row: no shuffle, no join.

Defined results: further columns may have any name, for inner columns take names that the table does not have; null and empty texts match nothing; an item without words matches nothing; items of less than
1 / (1 - SIMILARITY) words must occur unchanged; an item without an id, or with one that is no number, has id -1; repeated items and rows are matched one by one; an empty table of
items finds nothing.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER_WORDS, bounded_batches, free_name, table

SIMILARITY = 0.8
WALKS, TABLES, SAMPLED, SEED = 5, 6, 3, 17
BLOCK_ITEMS, BLOCK_WORDS = 4096, 1 << 20
CHUNK_WORDS = 1 << 17
FILTER_BITS, HITS = 18, 1 << 20
HALVED = 32
TEXT_END, ITEM_END = np.uint64(1 << 33), np.uint64(1 << 34)  # what follows a document and an item: no word, and not the same


def symbols(text: bytes | None) -> np.ndarray:
    w = text.translate(LOWER_WORDS).split() if text else []
    return np.fromiter(map(zlib.crc32, w), np.uint64, len(w))


def window_length(n: int) -> int:
    """The length class of an item of n words: the largest of 1, 2, 4, ... with 1.75 L <= n + 1."""
    length = 1
    while 7 * length <= 2 * (n + 1):
        length *= 2
    return length


def classes(n: int) -> list[int]:
    """The length classes under which an item of n words is indexed: its own, and half of it for long items."""
    length = window_length(n)
    return [length, length // 2] if length >= HALVED else [length]


def allowed(n: int) -> int:
    """The most edits of a match with an item of n words."""
    return int(n * (1 - SIMILARITY) + 1e-9)


def stride(length: int) -> int:
    return max(1, length // 2)


def steps(length: int) -> int:
    """Steps of the walk: it moves half a word a step on average, and shall seldom leave the window."""
    return max(1, length * 7 // 4)


def mixed(s: np.ndarray, walk: int) -> np.ndarray:
    """Each symbol's 64 random bits for a walk (a 64-bit finaliser; wrapping multiplication)."""
    x = s + np.uint64(((walk + 1) * 0x9E3779B97F4A7C15 + SEED) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def samples(length: int) -> list[list[list[tuple[int, np.uint64]]]]:
    """For each walk and table: the sampled steps and an odd multiplier for each."""
    out = []
    for walk in range(WALKS):
        rng = np.random.default_rng([SEED, length, walk])
        k = min(SAMPLED, steps(length))
        parts = np.linspace(0, steps(length), k + 1).astype(int)  # one step from each part of the walk, so that the samples see different words
        out.append([[(int(rng.integers(a, b)), np.uint64(int(rng.integers(1, 1 << 62)) * 2 + 1)) for a, b in zip(parts, parts[1:])] for _ in range(TABLES)])
    return out


def keys(s: np.ndarray, starts: dict[int, np.ndarray], plan: dict[int, list]) -> Iterable[tuple[int, int, np.ndarray]]:
    """(length, table number, keys) of the windows of ``s`` (padded at its end) that begin at ``starts[length]``.

    Starts of a longer class are among those of the shorter ones, so the classes share the walk as long as both last.
    """
    lengths = sorted(starts)
    for walk in range(WALKS):
        bits = mixed(s, walk)
        at = starts[lengths[0]].copy()
        own = {n: [np.zeros(len(starts[n]), np.uint64) for _ in range(TABLES)] for n in lengths}
        wanted = {n: [[(t, c) for t in range(TABLES) for i, c in plan[n][walk][t] if i == j] for j in range(steps(n))] for n in lengths}
        live, j = list(lengths), 0
        # where each longer class's starts stand among those of the class that leads the walk
        place = {n: np.searchsorted(starts[lengths[0]], starts[n]) for n in lengths}
        while live:
            g = bits[at]
            for n in live:
                for t, c in wanted[n][j]:
                    own[n][t] += (g if n == live[0] else g[place[n]]) * c
            at += (g >> np.uint64(j & 63)).astype(np.int64) & 1
            j += 1
            while live and j == steps(live[0]):
                n = live.pop(0)
                if live:
                    keep = place[live[0]]
                    at = at[keep]
                    place = {m: np.searchsorted(starts[live[0]], starts[m]) for m in live}
        for n in lengths:
            for t in range(TABLES):
                yield n, walk * TABLES + t, own[n][t]


def places(item: np.ndarray) -> dict[int, int]:
    """For each word of an item the bits of its places."""
    where: dict[int, int] = {}
    for i, x in enumerate(item.tolist()):
        where[x] = where.get(x, 0) | 1 << i
    return where


def least_edits(item: np.ndarray, passage: np.ndarray, limit: int, where: dict[int, int] | None = None) -> tuple[int, int]:
    """Least edits between the item and any stretch of the passage, and the end of the first best stretch; (limit + 1, -1) if more.

    Bit-parallel dynamic programming (one machine operation per word of the passage and item). ``where``: the item's places, if known.
    """
    m = len(item)
    where = places(item) if where is None else where
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = (m, 0) if m <= limit else (limit + 1, -1)  # the empty stretch
    for i, x in enumerate(passage.tolist()):
        eq = where.get(x, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        rise, fall = down | (full & ~(diagonal | up)), up & diagonal
        score += 1 if rise & top else -1 if fall & top else 0
        rise, fall = (rise << 1) & full, (fall << 1) & full
        up, down = fall | (full & ~(diagonal | rise)), rise & diagonal
        if score < best:
            best, end = score, i + 1
    return best, end


class Index:
    """Key tables of a block of items, for one task."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.ids = [i for i, _ in items]
        self.items = [symbols(t) for _, t in items]
        self.where = [places(t) for t in self.items]
        self.lengths = sorted({c for s in self.items if len(s) for c in classes(len(s))})
        self.plan = {n: samples(n) for n in self.lengths}
        found: dict[tuple[int, int], tuple] = {}
        for n in self.lengths:
            own = [i for i, s in enumerate(self.items) if len(s) and n in classes(len(s))]
            pad = np.full(2 * n + 2, ITEM_END)
            offset = np.cumsum([0] + [len(self.items[i]) + len(pad) for i in own])
            start = [np.arange(max(1, len(self.items[i]) - n + 1)) for i in own]
            at = np.concatenate([o + x for o, x in zip(offset, start)])
            number = np.repeat(own, [len(x) for x in start])
            line = np.concatenate([x for i in own for x in (self.items[i], pad)])
            for length, t, k in keys(line, {n: at}, self.plan):
                found[length, t] = k, number, np.concatenate(start)
        self.tables = {}
        for at, (k, number, start) in found.items():
            order = np.argsort(k, kind="stable")
            mask = np.zeros(1 << FILTER_BITS, bool)
            mask[k >> np.uint64(64 - FILTER_BITS)] = True
            self.tables[at] = k[order], number[order], start[order], mask

    def limit(self, number: int) -> int:
        return allowed(len(self.items[number]))

    def candidates(self, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Where each document begins on the line of all words, and rows (item, document, where the item would begin on the line)."""
        longest = self.lengths[-1]
        pad = np.full(2 * longest + 2, TEXT_END)
        offset = np.cumsum([0] + [len(d) + len(pad) for d in docs])
        s = np.concatenate([x for d in docs for x in (d, pad)])
        starts = {n: np.concatenate([np.arange(o, o + len(d), stride(n)) for o, d in zip(offset, docs)]) for n in self.lengths}
        found = [np.zeros((0, 3), np.int64)]
        for n, t, k in keys(s, starts, self.plan):
            sorted_keys, number, start, mask = self.tables[n, t]
            maybe = np.flatnonzero(mask[k >> np.uint64(64 - FILTER_BITS)])
            low, high = (np.searchsorted(sorted_keys, k[maybe], side) for side in ("left", "right"))
            ends = np.concatenate([[0], np.cumsum(high - low)])
            a = 0
            while a < len(maybe):  # at most HITS hits at a time (or those of one window): texts that repeat a word have very many
                b = max(a + 1, int(np.searchsorted(ends, ends[a] + HITS, "right")) - 1)
                times = high[a:b] - low[a:b]
                at = np.repeat(low[a:b] - (ends[a:b] - ends[a]), times) + np.arange(times.sum())  # low, low + 1, ... high - 1 of every hit
                window = np.repeat(starts[n][maybe[a:b]], times)
                rows = np.stack([number[at], np.searchsorted(offset, window, "right") - 1, window - start[at]], 1)
                found.append(np.unique(rows, axis=0) if len(rows) > 1000 else rows)
                a = b
        out = np.unique(np.concatenate(found), axis=0)
        return offset, out[self._share_words(s, out)]

    def _share_words(self, s: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """Which candidates (item, document, begin) have enough words of the item near them: without that many, more edits than allowed are needed."""
        keep = np.zeros(len(candidates), bool)
        cuts = np.flatnonzero(np.diff(candidates[:, 0], prepend=-1)).tolist() + [len(candidates)]
        for a, b in zip(cuts, cuts[1:]):
            number = candidates[a, 0]
            n, limit, own = len(self.items[number]), self.limit(number), np.unique(self.items[number])
            for c in range(a, b, 4096):
                begin = candidates[c:min(c + 4096, b), 2]
                near = s[np.clip(begin[:, None] + np.arange(-limit, n + 2 * limit), 0, len(s) - 1)]
                keep[c:c + len(begin)] = np.isin(near, own).sum(1) >= n - limit
        return keep

    def matches(self, docs: list[np.ndarray]) -> list[list[dict]]:
        """For each document its items: the least edits, and the words of the document where the passage begins and ends."""
        found: list[dict[int, dict]] = [{} for _ in docs]
        if not self.lengths:
            return [[] for _ in docs]
        offset, near = self.candidates(docs)
        if not len(near):
            return [[] for _ in docs]
        # candidates of an item and document that begin near each other are one passage
        limits = np.array([self.limit(i) for i in range(len(self.items))])[near[:, 0]]
        first = np.flatnonzero(np.concatenate([[True], (np.diff(near[:, 0]) != 0) | (np.diff(near[:, 1]) != 0) | (np.diff(near[:, 2]) > limits[1:])]))
        last = np.append(first[1:], len(near)) - 1
        for (number, doc, at), end_at in zip(near[first].tolist(), near[last, 2].tolist()):
            item, limit, shift = self.items[number], self.limit(number), int(offset[doc])
            best = found[doc].get(number)
            if best and best["edits"] == 0:
                continue
            lo, hi = max(0, at - shift - limit), min(len(docs[doc]), end_at - shift + len(item) + 2 * limit)
            edits, end = least_edits(item, docs[doc][lo:hi], limit, self.where[number])
            if edits > limit or best and best["edits"] <= edits:
                continue
            tail = docs[doc][lo:lo + end][::-1]
            _, back = least_edits(item[::-1], tail, edits)  # the same stretch read backwards gives its beginning
            found[doc][number] = {"item_id": self.ids[number], "edits": edits, "item_words": len(item), "first_word": lo + end - back, "end_word": lo + end}
        return [[f[k] for k in sorted(f)] for f in found]


KIND = pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int32()), ("item_words", pa.int32()), ("first_word", pa.int32()), ("end_word", pa.int32())]))
SQL_KIND = "array<struct<item_id:long,edits:int,item_words:int,first_word:int,end_word:int>>"


def _search(spark: SparkSession, items: list[tuple[int, bytes]]):
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(items)  # at most BLOCK_ITEMS items
    built: list[Index] = []  # a task's own, kept from batch to batch

    def search(text: pa.Array) -> pa.Array:
        if not built:
            built.append(Index(shared.value))
        index, out, docs, n = built[0], [], [], 0
        for i in range(len(text)):
            docs.append(symbols(text[i].as_py()))
            n += len(docs[-1])
            if n >= CHUNK_WORDS or i + 1 == len(text):
                out += index.matches(docs)
                docs, n = [], 0
        return pa.array(out, KIND)

    return F.arrow_udf(search, SQL_KIND)


def matched(spark: SparkSession, documents: DataFrame, benchmark: DataFrame, text: str = "text", out: str = "matches") -> DataFrame:
    """``documents`` with an array column ``out`` of the benchmark items each text holds."""
    rows = benchmark.select(F.col("item_id").try_cast("long").alias("item_id"), F.col("text").cast("binary").alias("t")).where("t is not null")
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("t")).alias("b")).first()
    blocks = max(1, -(-total["n"] // (BLOCK_ITEMS // 2)), -(-(total["b"] or 0) // (BLOCK_WORDS * 4)))
    found: list[Column] = []
    for i in range(blocks):  # blocks of the query set, each of a bounded size
        block = rows.where(F.pmod(F.xxhash64("item_id", "t"), F.lit(blocks)) == i).collect()
        block = sorted((r["item_id"] if r["item_id"] is not None else -1, bytes(r["t"])) for r in block)
        found.append(_search(spark, block)(F.col(text).cast("binary")))
    return documents.withColumn(out, F.flatten(F.array(*found)) if len(found) > 1 else found[0])


def decontaminated(spark: SparkSession, documents: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` without the rows whose text holds a benchmark item."""
    names = documents.columns
    m = free_name(names, "_matches")
    return matched(spark, documents, benchmark, text, m).where(F.size(m) == 0).select(*names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = matched(spark, table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return (docs.select("doc_id", F.explode("matches").alias("m"))
            .select("doc_id", "m.*").withColumn("similarity", 1 - F.col("edits") / F.col("item_words")))
