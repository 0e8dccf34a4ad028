"""Token counts: the pieces of each distinct pre-token are counted once, joined to every document's pre-token frequencies and summed.

1. Every text is cut into pre-tokens as the tokenizer's pre-tokenizer does; the distinct ones and the number of their uses
   are gathered by task, then over all tasks.
2. Each distinct pre-token goes through the tokenizer's merges once; its number of pieces is kept, no ids.
3. A document's tokens are the sum over its pre-tokens of frequency x pieces. Pre-tokens in many rows ("the" is in
   nearly all) would be hot join keys, so the most widespread ones (at most ``HEAD`` strings and ``HEAD_BYTES`` bytes,
   by a threshold on their rows) are joined inside the tasks from a broadcast; all others by a shuffle join of (row,
   pre-token, frequency). Both sums are exact, whatever the threshold.

Special tokens' strings inside a text are one token each, as by the library's default, and cut the text. Nothing is truncated.

Defined results: null and empty texts have 0 bytes and 0 tokens; very long texts are counted whole, and in a task no more than one batch
of texts and about ``DISTINCT`` units are held; every row is counted for itself, so repeated rows and null or repeated keys
keep their rows; an empty table gives an empty result; only key and text are read, so further columns may have any name
(the key is returned as ``doc_id``). Invalid UTF-8 is read as U+FFFD.
"""
from __future__ import annotations

import functools
import gc
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, stored, table
from .tokenizing import UNITS_KEPT, byte_bpe, has_odd_space, pretokens, spelled, splits_at_units, units

TOKENIZER, LIMIT = "byte_bpe_50k.json", 1024
HEAD, HEAD_BYTES, HEAD_STRING = 1 << 18, 8 << 20, 4096
DISTINCT, DISTINCT_BYTES = 300_000, 32 << 20


class Splitter:
    """Pre-tokens of texts. Byte-level BPEs only: a pre-token is looked up by its text and merged in its byte-level spelling."""

    def __init__(self, name: str):
        self.tokenizer = byte_bpe(name, False)
        if not splits_at_units(self.tokenizer):
            raise ValueError("only byte-level BPE files without normaliser are supported")
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(a.lstrip or a.rstrip or a.single_word for a in added):
            raise ValueError("added tokens that take white space or whole words only are not supported")
        self.specials = [a.content for a in added]
        self.known: dict[str, list[str]] = {}

    def segments(self, text: str) -> tuple[list[str], int]:
        """The text between special tokens' strings (the leftmost, then the longest, counts), and the number of those."""
        if not any(s in text for s in self.specials):
            return [text], 0
        out, at, found = [], 0, 0
        while True:
            first = min(((p, -len(s), s) for s in self.specials if (p := text.find(s, at)) >= 0), default=None)
            if first is None:
                return [*out, text[at:]], found
            out.append(text[at:first[0]])
            at, found = first[0] + len(first[2]), found + 1

    def units(self, text: str) -> tuple[list[str], int]:
        """The units of a text, whose pre-tokens in a row are the text's (a segment that can't be cut is one unit), and its special tokens."""
        segments, special = self.segments(text)
        if len(segments) == 1:
            parts = units(text)
            return ([text] if parts is None else parts), special
        parts = []
        for segment in segments:
            parts += units(segment) or [segment]
        return parts, special

    def parts(self, text: str) -> tuple[list[str], list[str], int]:
        """A text's units and its special tokens, with most units as what follows a space: (units, parts whose units are those of a space and
        the part, number of special tokens). Texts without runs of white space that go on behind a space or with one are cut at spaces alone."""
        segments, special = self.segments(text)
        if len(segments) > 1 or "  " in text or "\n " in text or has_odd_space(text):
            return self.units(text)[0], [], special
        first, *rest = text.split(" ")
        return (units(first) or []) if first else [], rest, special

    def pretokens(self, unit: str) -> list[str]:
        cut = self.known.get(unit)
        if cut is None:
            cut = pretokens(self.tokenizer, unit, True)
            if len(unit) < 64:
                if len(self.known) >= UNITS_KEPT:
                    self.known.clear()
                self.known[unit] = cut
        return cut


@functools.lru_cache(maxsize=2)
def splitter_of(name: str) -> Splitter:
    """One per process: later tasks find the units that earlier ones cut."""
    out = Splitter(name)
    gc.collect()
    gc.freeze()  # what is loaded by now stays: no need to walk it again and again
    return out


def _texts(column: pa.Array) -> list[str]:
    return [raw.decode("utf-8", "replace") if raw else "" for raw in column.to_pylist()]


def _spaced(part: str) -> list[str]:
    """The units of a space and a part."""
    return units(f" {part}") or [] if "\n" in part else [f" {part}"]


class Pieces(dict):
    """By unit (``spaced``: by part behind a space) the pieces of its most used pre-tokens, found when first asked for; plus ``RARE`` where it has
    others, which ``others`` holds."""

    RARE = 1 << 40

    def __init__(self, splitter: Splitter, counts: dict[str, int], spaced: bool):
        super().__init__()
        self.splitter, self.counts, self.spaced = splitter, counts, spaced
        self.others: dict[str, list[str]] = {}

    def __missing__(self, part: str) -> int:
        n, rare = 0, []
        for unit in _spaced(part) if self.spaced else (part,):
            for p in self.splitter.pretokens(unit):
                pieces = self.counts.get(p)
                if pieces is None:
                    rare.append(p)
                else:
                    n += pieces
        if rare:
            self.others[part] = rare
            n += self.RARE
        self[part] = n
        return n

    def bounded(self) -> None:
        if len(self) > UNITS_KEPT:
            self.clear()
            self.others.clear()

    def of(self, parts: list[str], rest: list[str]) -> int:
        """The pieces of the parts' most used pre-tokens; the others are added to ``rest``."""
        n = sum(map(self.__getitem__, parts))
        if n >= self.RARE:
            rest.extend(chain.from_iterable(map(self.others.__getitem__, filter(self.others.__contains__, parts))))
        return n % self.RARE


def pretoken_uses(texts: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(pretoken, uses): every distinct pre-token of the binary column ``text`` and how often it occurs."""
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, uses, spaced = splitter_of(tokenizer), Counter(), Counter()
        for batch in batches:
            for text in _texts(batch.column(0)):
                whole, parts, _ = splitter.parts(text)
                uses.update(whole)
                spaced.update(parts)
            if len(uses) + len(spaced) >= DISTINCT or sum(map(len, uses)) + sum(map(len, spaced)) >= DISTINCT_BYTES:
                yield from _pretokens(splitter, uses, spaced)
                uses, spaced = Counter(), Counter()
        yield from _pretokens(splitter, uses, spaced)

    return texts.select("text").mapInArrow(gather, "pretoken string, uses long").groupBy("pretoken").agg(F.sum("uses").alias("uses"))


def _pretokens(splitter: Splitter, uses: dict[str, int], spaced: dict[str, int], step: int = 20_000) -> Iterator[pa.RecordBatch]:
    """(pretoken, uses) of units, and of parts behind a space, and how often they occur."""
    seen: dict[str, int] = {}
    for unit, n in chain(uses.items(), ((u, n) for part, n in spaced.items() for u in _spaced(part))):
        for p in splitter.pretokens(unit):
            seen[p] = seen.get(p, 0) + n
    names, counts = list(seen), list(seen.values())
    for i in range(0, len(names), step):
        yield pa.RecordBatch.from_arrays([pa.array(names[i:i + step], pa.string()), pa.array(counts[i:i + step], pa.int64())], ["pretoken", "uses"])


def piece_counts(pretokens: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(pretoken, uses, pieces): the number of pieces the merges leave of each pre-token."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = byte_bpe(tokenizer, False).model
        for batch in batches:
            pieces = [len(model.tokenize(spelled(p))) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(pieces, pa.int64())], ["pretoken", "uses", "pieces"])

    return pretokens.select("pretoken", "uses").mapInArrow(count, "pretoken string, uses long, pieces long")


def most_used(pieces: DataFrame, most: int = HEAD, most_bytes: int = HEAD_BYTES) -> dict[str, int]:
    """Pieces of the most used pre-tokens: all with at least 2^k uses, for the smallest k that keeps the bounds."""
    short = pieces.where(F.octet_length("pretoken") <= HEAD_STRING)
    level = F.floor(F.log2(F.col("uses").cast("double"))).cast("int")
    levels = sorted(short.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("pretoken")).alias("size")).collect(), reverse=True)
    low, n, size = None, 0, 0
    for r in levels:  # at most 63 levels
        n, size = n + r["n"], size + r["size"]
        if n > most or size > most_bytes:
            break
        low = r["level"]
    if low is None:
        return {}
    return {r["pretoken"]: r["pieces"] for r in short.where(F.col("uses") >= (1 << low)).select("pretoken", "pieces").toLocalIterator()}


def token_counts(spark: SparkSession, documents: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, limit: int = LIMIT,
                 head: int = HEAD) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``documents``."""
    bounded_batches(spark)
    texts = documents.select(F.col(key).alias("k"), F.col(text).cast("binary").alias("text"))
    pieces = stored(spark, piece_counts(pretoken_uses(texts, tokenizer), tokenizer), "pieces")
    common = spark.sparkContext.broadcast(most_used(pieces, head))

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, counts = splitter_of(tokenizer), common.value
        by_unit, by_part = Pieces(splitter, counts, False), Pieces(splitter, counts, True)
        for batch in batches:
            by_unit.bounded()
            by_part.bounded()
            sums, names, freqs, ends = [], [], [], [0]
            for text in _texts(batch.column(1)):
                whole, parts, special = splitter.parts(text)
                others: list[str] = []
                sums.append(by_unit.of(whole, others) + by_part.of(parts, others) + special)
                if others:
                    rest = Counter(others)
                    names += rest.keys()
                    freqs += rest.values()
                ends.append(len(names))
            rest = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(freqs, pa.int64())], ["pretoken", "f"]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sums, pa.int64()), rest], ["k", "n_bytes", "known", "rest"])

    kind = texts.schema["k"].dataType.simpleString()
    sized = texts.select("k", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    counted = sized.mapInArrow(known, f"k {kind}, n_bytes long, known long, rest array<struct<pretoken:string,f:bigint>>")
    # written once, so that a row keeps its number
    counted = stored(spark, counted.select("*", F.monotonically_increasing_id().alias("row")), "counted")
    common.destroy()
    rare = (counted.select("row", F.explode("rest").alias("r")).select("row", "r.pretoken", "r.f")
            .join(pieces.select("pretoken", "pieces"), "pretoken").groupBy("row").agg(F.sum(F.col("f") * F.col("pieces")).alias("more")))
    n = F.col("known") + F.coalesce("more", F.lit(0))
    return (counted.select("row", "k", "n_bytes", "known").join(rare, "row", "left")
            .select(F.col("k").alias("doc_id"), "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark, table(spark, sf_dir, "documents"))
