"""Cross-tokenizer alignment: where the tokens of two tokenizers end together, and which of them overlap.

Tokenizer A (byte-level BPE) encodes a space and the text, B (sentencepiece BPE, which adds that space itself) the text. The
byte offsets at which a token of each ends cut both token rows into groups; A and B tokens whose byte ranges overlap are linked.

Fragments form a monoid. A byte range of a text, however it is cut, yields a :class:`Fragment` of the tokens that end in it: an open
prefix up to the first common end, the closed groups behind it, and an open suffix after the last common end (without any
common end all is prefix). :func:`compose` joins two neighbouring fragments: the left one's suffix and the right one's prefix become
one closed group. It is associative, so a tree of tasks may compose any neighbours first. Texts over ``CHUNK`` bytes are cut at
every CHUNK bytes, wherever that falls in a word; each chunk is tokenised in a task of its own, from the last
safe place (a space behind a word) before it to the first one after it, and ``FAN`` neighbours are composed a round until one
fragment of the text is left. Where no safe place lies within ``REACH`` bytes (text without spaces) the cut is left out.

The groups of an id pair's links are counted over the corpus, the highest count of each B id found, and both joined back to every document's
links: the most frequent pairs (at most ``HEAD``, by a threshold on their count) inside the tasks from a broadcast, all others by
a shuffle join, so that no pair of common words is a hot key.

Defined results: texts that are null or empty, or whose joined A or B bytes differ from space and text, have no tokens: zeros and an
empty ``groups_sha256``. Very long texts are aligned whole, in chunks; of one document only its group string and the distinct pairs of its links
meet in one task. Every row is aligned for itself, so repeated rows and null or repeated keys keep their rows, and their links count
each time. Ties of an id's highest count all count as best. An empty table gives an empty result. Only key and text are read, so
further columns may have any name; the key is returned as ``doc_id``. Invalid UTF-8 has no tokens.
"""
from __future__ import annotations

import functools
import gc
import hashlib
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, stored, table
from .tokenizing import UNITS_KEPT, byte_bpe, byte_bpe_entries, pieces_respect_units, pretokens, sentence_pieces, sentences, spelled, splits_at_units, units

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
CHUNK, REACH, FAN = 1 << 16, 1 << 12, 16
HEAD = 1 << 19
_NONE = np.zeros((3, 0), np.int64)
_FEW = np.zeros(0, np.int64)


class Pair:
    """Two tokenizers. A token row is an array [3, tokens] of starts, ends and ids, by byte offsets in space + text."""

    def __init__(self, a: str, b: str):
        self.a, self.b = byte_bpe(a, True), sentences(b)
        self.bytes_a, self.bytes_b = byte_bpe_entries(a), sentence_pieces(b)
        self.size_a, self.size_b = (np.array([len(x) for x in e], np.int64) for e in (self.bytes_a, self.bytes_b))
        self.by_unit = splits_at_units(self.a) and pieces_respect_units(self.b)
        self.space = self.b.piece_to_id("▁")
        n = max(len(self.bytes_a), len(self.bytes_b))
        #: an id as text with the separator behind it: , within, | after the A ids, ; after the B ids of a group
        self.written = np.array([f"{i}{s}".encode() for i in range(n) for s in ",|;"], object)
        if not {bytes([b]) for b in range(256)} <= set(self.bytes_a):
            raise ValueError("A has to be a byte-level BPE with all bytes")  # so its tokens are the text's bytes
        #: ids of units and pre-tokens seen, as 32-bit numbers in bytes; None for a unit whose B tokens are not its bytes
        self.known_a: dict[str, bytes] = {}
        self.known_b: dict[str, bytes | None] = {}
        self.merged: dict[str, bytes] = {}

    def _merge(self, pretoken: str) -> bytes:
        ids = array("i", [t.id for t in self.a.model.tokenize(spelled(pretoken))]).tobytes()
        self.merged[pretoken] = ids
        return ids

    def _learn(self, new: list[str]) -> None:
        merged, entries = self.merged, self.bytes_b
        for unit, b in zip(new, self.b.encode([u[1:] if u[0] == " " else u for u in new], num_threads=1)):
            if unit == " ":
                b = [self.space]
            elif unit[0] != " " and b and b[0] == self.space:  # the space that B adds stands alone before a line end
                b = b[1:]
            self.known_a[unit] = b"".join([merged.get(p) or self._merge(p) for p in pretokens(self.a, unit, True)])
            self.known_b[unit] = array("i", b).tobytes() if b"".join([entries[i] for i in b]) == unit.encode() else None

    def cut(self, texts: list[str]) -> list[list[str] | None]:
        """The units of each text (None: it has to be encoded whole); their ids are known from now on to the next call."""
        parts = [units(t) if self.by_unit else None for t in texts]
        every = set().union(*(p for p in parts if p))
        new = every - self.known_b.keys()
        if len(self.known_b) + len(new) > UNITS_KEPT:
            self.known_a, self.known_b, self.merged = {}, {}, {}
            new = every
        if new:
            self._learn(list(new))
        return parts

    def ids(self, text: str, parts: list[str] | None) -> tuple[np.ndarray, np.ndarray] | None:
        """The A and B ids of ``text``, which begins with a space; None if the B bytes are not those of the text."""
        if parts is None:
            a, b = self.a.encode(text, add_special_tokens=False).ids, self.b.encode(text[1:])
            return (np.array(a, np.int64), np.array(b, np.int64)) if b"".join([self.bytes_b[i] for i in b]) == text.encode() else None
        rows_b = list(map(self.known_b.__getitem__, parts))
        if None in rows_b:
            return None
        return tuple(np.frombuffer(b"".join(r), np.int32).astype(np.int64) for r in (map(self.known_a.__getitem__, parts), rows_b))

    def token_rows(self, text: str, parts: list[str] | None, at: int) -> tuple[np.ndarray, np.ndarray] | None:
        """The token rows of ``text``, which begins at byte ``at`` of its document."""
        ids = self.ids(text, parts)
        if ids is None:
            return None
        out = []
        for row, size in zip(ids, (self.size_a, self.size_b)):
            size = size[row]
            end = at + np.cumsum(size)
            out.append(np.stack([end - size, end, row]))
        return tuple(out)


@functools.lru_cache(maxsize=2)
def pair_of(a: str, b: str) -> Pair:
    """One per process: later tasks find the units that earlier ones encoded."""
    pair = Pair(a, b)
    gc.collect()
    gc.freeze()  # what is loaded by now stays: no need to walk it again and again
    return pair


class Groups(NamedTuple):
    """Closed groups in a row: counts, their text with a ; behind each, and how often which ids are linked (a << 32 | b)."""
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    text: bytes = b""
    keys: np.ndarray = _FEW
    counts: np.ndarray = _FEW


class Fragment(NamedTuple):
    """The tokens that end in a byte range. ``cut``: it has a common end; else all tokens are in the head."""
    good: bool
    cut: bool
    head_a: np.ndarray = _NONE
    head_b: np.ndarray = _NONE
    closed: Groups = Groups()
    tail_a: np.ndarray = _NONE
    tail_b: np.ndarray = _NONE


BAD = Fragment(False, False)


def _ends(row: np.ndarray, base: int, size: int) -> np.ndarray:
    """By offset from ``base``: whether a token of the row ends there."""
    out = np.zeros(size, bool)
    out[row[1] - base] = True
    return out


def closed(pair: Pair, a: np.ndarray, b: np.ndarray) -> Groups:
    """The groups of token rows that begin together and end together."""
    if not a.shape[1]:
        return Groups()
    base = a[0, 0]
    size = a[1, -1] - base + 1
    (start, end, ids), ids_b = a, b[2]
    start, end = start - base, end - base
    in_b = _ends(b, base, size)
    last_a, last_b = in_b[end], _ends(a, base, size)[b[1] - base]  # the last tokens of their groups
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    to_a, to_b = np.nonzero(last_a)[0] + 1, np.append(0, np.nonzero(last_b)[0] + 1)  # A tokens to each group's end, B tokens to its beginning
    # each id with its separator, at its place: a group's A ids, then its B ids
    order = np.empty(len(ids) + len(ids_b), np.int64)
    order[np.arange(len(ids)) + to_b[group_a]] = ids * 3 + last_a
    order[np.arange(len(ids_b)) + to_a[group_b]] = ids_b * 3 + 2 * last_b
    ended = np.cumsum(in_b)  # B tokens that end at or before an offset
    first = ended[start]
    n = ended[end - 1] - first + 1
    total = int(n.sum())
    partner = np.arange(total) - np.repeat(np.cumsum(n) - n - first, n)
    keys, counts = np.unique(np.repeat(ids, n) << 32 | ids_b[partner], return_counts=True)
    return Groups(len(ids), len(ids_b), len(to_a), total, b"".join(pair.written[order].tolist()), keys, counts)


def together(x: Groups, y: Groups) -> Groups:
    if not x.n_groups or not y.n_groups:
        return x if x.n_groups else y
    keys, at = np.unique(np.concatenate([x.keys, y.keys]), return_inverse=True)
    counts = np.bincount(at, np.concatenate([x.counts, y.counts]), len(keys)).astype(np.int64)
    return Groups(x.n_a + y.n_a, x.n_b + y.n_b, x.n_groups + y.n_groups, x.n_links + y.n_links, x.text + y.text, keys, counts)


def fragment(pair: Pair, a: np.ndarray, b: np.ndarray) -> Fragment:
    """The fragment of the tokens that end in a range."""
    if not (a.shape[1] and b.shape[1]):
        return Fragment(True, False, a, b)
    base = min(a[0, 0], b[0, 0])
    size = max(a[1, -1], b[1, -1]) - base + 1
    common = [np.nonzero(_ends(other, base, size)[row[1] - base])[0] + 1 for row, other in ((a, b), (b, a))]
    if not len(common[0]):
        return Fragment(True, False, a, b)
    (a0, a1), (b0, b1) = (c[[0, -1]] for c in common)
    return Fragment(True, True, a[:, :a0], b[:, :b0], closed(pair, a[:, a0:a1], b[:, b0:b1]), a[:, a1:], b[:, b1:])


def compose(pair: Pair, x: Fragment, y: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges."""
    if not (x.good and y.good):
        return BAD
    joined = lambda u, v: np.concatenate([u, v], axis=1)
    if not x.cut:
        return y._replace(head_a=joined(x.head_a, y.head_a), head_b=joined(x.head_b, y.head_b))
    open_a, open_b = joined(x.tail_a, y.head_a), joined(x.tail_b, y.head_b)
    if not y.cut:
        return x._replace(tail_a=open_a, tail_b=open_b)
    return Fragment(True, True, x.head_a, x.head_b, together(together(x.closed, closed(pair, open_a, open_b)), y.closed), y.tail_a, y.tail_b)


def whole(pair: Pair, x: Fragment) -> Groups:
    """The groups of a whole text: its prefix begins at the text's start and so is a group too; nothing is behind its last common end."""
    return together(closed(pair, x.head_a, x.head_b), x.closed) if x.good and x.cut else Groups()


# ---------------------------------------------------------------- chunks

def _safe(raw: bytes, at: int) -> bool:
    """True if byte ``at`` is a space behind a character that is no white space."""
    first = at - 1
    while first > 0 and raw[first] & 0xC0 == 0x80:
        first -= 1
    return not raw[first:at].decode("utf-8", "replace").isspace()


def chunk_places(raw: bytes, chunk: int = CHUNK, reach: int = REACH) -> list[tuple[int, int, int, int]]:
    """(start, end, from, to) of each chunk of ``raw`` (a space and a text): the tokens that end in (start, end] are its own, the
    bytes from ``from`` to ``to`` are what has to be tokenised for them."""
    borders = [(0, 0, 0)]
    for at in range(chunk, len(raw), chunk):
        before = raw.rfind(b" ", max(1, at - reach), at)
        while before > 0 and not _safe(raw, before):
            before = raw.rfind(b" ", max(1, at - reach), before)
        after = raw.find(b" ", at, at + reach)
        while after > 0 and not _safe(raw, after):
            after = raw.find(b" ", after + 1, at + reach)
        if before > 0 and after > 0:
            borders.append((at, before, after))
    borders.append((len(raw), len(raw), len(raw)))
    return [(s, e, begin, to) for (s, begin, _), (e, _, to) in zip(borders, borders[1:])]


_CHUNKS = "array<struct<start:bigint,stop:bigint,at:bigint,raw:binary>>"


def _chunks(chunk: int, reach: int):
    def cut(texts: pa.Array) -> pa.Array:
        out = []
        for value in texts:
            raw = b" " + value.as_py()
            out.append([{"start": s, "stop": e, "at": at, "raw": raw[at:to]} for s, e, at, to in chunk_places(raw, chunk, reach)])
        return pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("at", pa.int64()), ("raw", pa.binary())])))

    return F.arrow_udf(cut, _CHUNKS)


def chunk_fragments(pair: Pair, chunks: list[tuple[bytes, int, int, int]]) -> Iterator[Fragment]:
    """The fragment of each chunk (raw, start, stop, at): the tokens of ``raw``, from byte ``at`` on, that end in (start, stop]."""
    texts: list[str | None] = []
    for raw, *_ in chunks:
        try:
            texts.append(raw.decode())
        except UnicodeDecodeError:
            texts.append(None)
    parts = pair.cut([t for t in texts if t is not None])[::-1]
    for text, (_, start, stop, at) in zip(texts, chunks):
        rows = None if text is None else pair.token_rows(text, parts.pop(), at)
        yield BAD if rows is None else fragment(pair, *(r[:, slice(*np.searchsorted(r[1], (start, stop), "right"))] for r in rows))


# ---------------------------------------------------------------- tables

_GROUPS = [("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("text", pa.binary()), ("keys", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))]
_OPEN = [(n, pa.list_(pa.int64())) for n in ("head_a", "head_b", "tail_a", "tail_b")]
_FRAGMENT = pa.struct([("good", pa.bool_()), ("cut", pa.bool_()), *_OPEN, *_GROUPS])
_FRAGMENT_SQL = ("struct<good:boolean,cut:boolean,head_a:array<bigint>,head_b:array<bigint>,tail_a:array<bigint>,tail_b:array<bigint>,"
                 "n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,text:binary,keys:array<bigint>,counts:array<bigint>>")
_ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, keys array<long>, counts array<long>"


def _packed(f: Fragment) -> dict:
    return ({"good": f.good, "cut": f.cut} | {n: getattr(f, n).ravel() for n, _ in _OPEN} | f.closed._asdict())


def _unpacked(r: dict) -> Fragment:
    heads = {n: np.array(r[n], np.int64).reshape(3, -1) for n, _ in _OPEN}
    c = Groups(*(r[n] for n, _ in _GROUPS[:5]), np.array(r["keys"], np.int64), np.array(r["counts"], np.int64))
    return Fragment(r["good"], r["cut"], heads["head_a"], heads["head_b"], c, heads["tail_a"], heads["tail_b"])


def _results(keys: pa.Array, groups: list[Groups]) -> pa.RecordBatch:
    lists = []
    for field in ("keys", "counts"):
        values = [getattr(g, field) for g in groups]
        ends = np.cumsum([0, *map(len, values)])
        lists.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(values) if values else _FEW)))
    sha = [hashlib.sha256(g.text[:-1]).hexdigest() if g.n_groups else "" for g in groups]
    counts = [pa.array([getattr(g, n) for g in groups], pa.int64()) for n, _ in _GROUPS[:4]]
    return pa.RecordBatch.from_arrays([keys, *counts, pa.array(sha, pa.string()), *lists], ["k", *[n for n, _ in _GROUPS[:4]], "groups_sha256", "keys", "counts"])


def _short(a: str, b: str):
    """(k, text) of texts that are one chunk to their groups."""
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(a, b)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = chunk_fragments(pair, [(b" " + t, 0, len(t) + 1, 0) for t in texts if t])
            yield _results(batch.column(0), [whole(pair, next(found)) if t else Groups() for t in texts])

    return align


def _fragments(a: str, b: str):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(a, b)
        for batch in batches:
            row, no, *rest = batch.columns
            for i, f in enumerate(chunk_fragments(pair, list(zip(*(c.to_pylist() for c in rest))))):  # one by one: a fragment may be large
                yield pa.RecordBatch.from_arrays([row.slice(i, 1), no.slice(i, 1), pa.array([_packed(f)], _FRAGMENT)], ["row", "no", "f"])

    return align


def _composed(a: str, b: str):
    """(row, no, fs: neighbouring fragments in order) to their composition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(a, b)
        for batch in batches:
            for i, fs in enumerate(batch.column(2)):
                f = functools.reduce(functools.partial(compose, pair), [_unpacked(x["f"]) for x in fs.as_py()])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([_packed(f)], _FRAGMENT)], ["row", "no", "f"])

    return run


def _finished(a: str, b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(a, b)
        for batch in batches:
            for i, f in enumerate(batch.column(1)):
                yield _results(batch.column(0).slice(i, 1), [whole(pair, _unpacked(f.as_py()))])

    return run


def aligned(spark: SparkSession, documents: DataFrame, key: str = "doc_id", text: str = "text", a: str = A, b: str = B, chunk: int = CHUNK, reach: int = REACH, fan: int = FAN) -> DataFrame:
    """(row, k, n_a, n_b, n_groups, n_links, groups_sha256, keys, counts) of every document, written once: ``keys`` are its linked id
    pairs (a << 32 | b) and ``counts`` their links in the document."""
    bounded_batches(spark)
    texts = documents.select(F.col(key).alias("k"), F.col(text).cast("binary").alias("text"))
    is_long = F.coalesce(F.octet_length("text") >= chunk, F.lit(False))
    kind = f"k {texts.schema['k'].dataType.simpleString()}"
    short = texts.where(~is_long).mapInArrow(_short(a, b), f"{kind}, {_ALIGNED}")
    # the chunks of long texts, written once so that a row keeps its number, and dealt to tasks one by one
    chunks = stored(spark, texts.where(is_long).withColumn("row", F.monotonically_increasing_id()).select("row", "k", F.posexplode(_chunks(chunk, reach)("text")).alias("no", "c"))
                    .select("row", "k", F.col("no").cast("long").alias("no"), "c.*"), "chunks")
    most = chunks.agg(F.max("no")).first()[0]
    if most is None:
        result = short
    else:
        parts = chunks.select("row", "no", "raw", "start", "stop", "at").repartition("row", "no").mapInArrow(_fragments(a, b), f"row long, no long, f {_FRAGMENT_SQL}")
        while most:
            near = parts.groupBy("row", F.floor(F.col("no") / fan).alias("no")).agg(F.sort_array(F.collect_list(F.struct("no", "f"))).alias("fs"))  # at most ``fan`` fragments
            parts = near.mapInArrow(_composed(a, b), f"row long, no long, f {_FRAGMENT_SQL}")
            most //= fan
        long = parts.select("row", "f").mapInArrow(_finished(a, b), f"k long, {_ALIGNED}").withColumnRenamed("k", "row")
        result = short.unionByName(chunks.where("no = 0").select("row", "k").join(long, "row").drop("row"))
    return stored(spark, result.select(F.monotonically_increasing_id().alias("row"), "*"), "aligned")


def pair_counts(documents: DataFrame) -> DataFrame:
    """(pair, n) of every linked id pair: its links corpus-wide."""
    return documents.select(F.explode(F.arrays_zip("keys", "counts")).alias("p")).groupBy(F.col("p.keys").alias("pair")).agg(F.sum("p.counts").alias("n"))


def with_best(pairs: DataFrame) -> DataFrame:
    """(pair, n, best): best if no pair with its B id has more."""
    b = F.col("pair").bitwiseAND((1 << 32) - 1)
    most = pairs.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return pairs.withColumn("b", b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def frequent(pairs: DataFrame, most: int = HEAD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The most frequent pairs in order, with count and whether best: all with 2^k links at least, for the smallest k that keeps the bound."""
    level = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    low, n = None, 0
    for r in sorted(pairs.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):  # at most 63 levels
        n += r["n"]
        if n > most:
            break
        low = r["level"]
    if low is None:
        return _FEW, _FEW, np.zeros(0, bool)
    t = pairs.where(F.col("n") >= (1 << low)).toArrow()
    order = np.argsort(t["pair"].to_numpy())
    return tuple(t[c].to_numpy()[order] for c in ("pair", "n", "best"))


def alignment(spark: SparkSession, documents: DataFrame, key: str = "doc_id", text: str = "text", a: str = A, b: str = B, chunk: int = CHUNK, reach: int = REACH, fan: int = FAN,
              head: int = HEAD) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``documents``."""
    docs = aligned(spark, documents, key, text, a, b, chunk, reach, fan)
    pairs = stored(spark, with_best(stored(spark, pair_counts(docs), "pair-counts")), "pairs")
    common = spark.sparkContext.broadcast(frequent(pairs, head))
    kind = docs.schema["k"].dataType.simpleString()
    plain = ["row", "k", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = common.value
        for batch in batches:
            keys, counts = (batch.column(i) for i in (7, 8))
            at = keys.offsets.to_numpy() - keys.offsets[0].as_py()
            k, c = (x.flatten().to_numpy(zero_copy_only=False) for x in (keys, counts))
            place = np.searchsorted(pair, k)
            there = np.zeros(len(k), bool)
            inside = place < len(pair)
            there[inside] = pair[place[inside]] == k[inside]
            place[~there] = 0
            sums = [np.where(there, x[place] * c, 0) if len(pair) else np.zeros(len(k), np.int64) for x in (best, n)]
            total = [np.diff(np.concatenate([[0], np.cumsum(s, dtype=np.int64)])[at]) for s in sums]
            left = np.concatenate([[0], np.cumsum(~there)])[at].astype(np.int32)
            rest = [pa.ListArray.from_arrays(pa.array(left), pa.array(x[~there])) for x in (k, c)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], *map(pa.array, total), *rest], [*plain, "n_best", "count_sum", "keys", "counts"])

    schema = f"row long, k {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, keys array<long>, counts array<long>"
    summed = stored(spark, docs.select(*plain, "keys", "counts").mapInArrow(known, schema), "summed")
    common.destroy()
    rest = (summed.select("row", F.explode(F.arrays_zip("keys", "counts")).alias("p")).select("row", F.col("p.keys").alias("pair"), F.col("p.counts").alias("c"))
            .join(pairs, "pair").groupBy("row").agg(F.sum(F.col("c") * F.col("best").cast("long")).alias("more_best"), F.sum(F.col("c") * F.col("n")).alias("more_sum")))
    more = lambda c: F.coalesce(c, F.lit(0))
    return (summed.drop("keys", "counts").join(rest, "row", "left")
            .select(F.col("k").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + more("more_best")).alias("n_best"),
                    (F.col("count_sum") + more("more_sum")).alias("count_sum"), "groups_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(spark, table(spark, sf_dir, "documents"))
