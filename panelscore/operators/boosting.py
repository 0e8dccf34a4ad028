"""Boosted trees on distributed tables: leaf-wise trees with L2 (M6), symmetric trees (M7), resumable early stopping (M8),
the model as a node table (M9, M10).

Spark ML's trees grow by level, without regularised leaves, and a fit cannot be continued. Here a fit keeps two written tables,
training and validation rows in blocks: each row's feature bins, a byte each, and its margin (the sum of the trees so far). Rounds
come in spells of ``SPELL``: after it the rows are written anew with their margins, so patience costs no refit, and a fit that is stopped goes on from its
last spell. Inside a spell the newest trees are applied on the fly, in every pass: a symmetric tree is six comparisons a row. Leaf-wise trees are dearer, and
the training rows are written anew after ``PENDING`` of them.

Sums that do not depend on the partitioning. Gradients and hessians are whole numbers of 2^-24 and are added as whole numbers, so a tree is the
same bit by bit however rows are spread or retried, and SQL can recompute it.

Leaf-wise growth (best gain first) in few jobs. A leaf's best split depends on its rows alone, so what best-first growth picks is settled afterwards, on the
splits known so far (``best_first``). Leaves of over ``whole`` rows are split by histogram passes, all of them in one pass: each task adds up its rows' gradients by
(leaf, feature, bin), sums of tasks are merged in groups of ``MERGE``, and a leaf's best split comes back to the driver. Leaves of at
most ``whole`` rows go to one task each, in blocks of rows, which grows the whole subtree; ``whole`` grows with the rows up to ``MOST_WHOLE``, so the
number of passes hardly does. A split that could only come after ``leaves`` - 1 better ones is not searched: it
is bounded by the smallest gain above it.

Symmetric growth. Every level is one histogram pass; the split is the one whose gains, summed over all leaves, are largest.

Few rows. A fit to the models' own limits has thousands of rounds, and a round of few rows is mostly the time of its jobs. Where the caller allows it (``alone``), a fit of
at most so many training rows, and validation rows, runs ``STRETCH`` rounds in one task that holds all rows, by the same sums: the trees, the metric and the rounds are the same.

Borders are quantiles from a mergeable sketch (``percentile_approx``), all features in one aggregate. NULL and NaN rank above all numbers. Python
runs where numpy adds up or walks trees, in Arrow batches; the driver holds borders and trees only.
"""
from __future__ import annotations

import functools
import heapq
import json
import math
import operator
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, replace
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..functions.splitmix import GOLDEN, M64, MIX1, MIX2, SHIFTS
from ..session import work_path
from ..sources import io
from .ordered import running_totals

UNIT = 1 << 24
SPELL = 10
#: leaf-wise trees that the passes over the training rows apply on the fly
PENDING = 3
#: rows that one task grows a subtree of: a share of the training rows, between these bounds (about 30 bytes a row)
WHOLE, MOST_WHOLE, WHOLE_SHARE = 1 << 16, 1 << 21, 8
#: the fit's tables hold ``BLOCK`` rows in each of theirs, since handing rows to Python costs by their number; a pass works on ``CHUNK`` rows at a time
BLOCK, CHUNK = 256, 1 << 15
_ROWS = "h binary, y binary, bins binary, margin binary"
#: the passes read about 700,000 rows a task, several tasks a core, and hand Python about 130,000 at a time (the default, 10,000 blocks, is a task's whole input)
_READING = {"spark.sql.files.maxPartitionBytes": str(32 << 20), "spark.sql.execution.arrow.maxRecordsPerBatch": "512"}
MERGE = 64
#: rows that a fit may hold in one task (about 150 bytes a row), and the rounds it makes of them between two writes
ALONE, STRETCH = 1 << 18, 100
ACCURACY = 20_000
LEAST_GAIN = 1e-9
#: the sampling of a round's rows and features starts from this seed plus the round
ROUND_SEED = 1000


@dataclass(frozen=True)
class Settings:
    """``rate`` learning rate, ``l2`` on leaf values, ``borders`` a feature; ``leaves`` and ``least_rows`` for leaf-wise trees, ``depth`` for symmetric ones;
    ``features`` and ``rows`` shares drawn each round; ``average``: the first margin is that of the training rows' mean, else 0."""
    rate: float
    l2: float
    rounds: int
    patience: int
    borders: int
    symmetric: bool = False
    leaves: int = 128
    least_rows: int = 1
    depth: int = 6
    features: float = 1.0
    rows: float = 1.0
    average: bool = True


# The reference's settings of its two boosted models (borders of the first: its library's default number of bins).
PRIMARY = Settings(rate=0.03, l2=5.0, rounds=3000, patience=150, borders=255, leaves=128, least_rows=300, features=0.6, rows=0.8)
COMPARISON = Settings(rate=0.05, l2=6.0, rounds=1500, patience=100, borders=128, symmetric=True, depth=6, average=False)


class Tree(NamedTuple):
    """Nodes in arrays; node 0 is the root. A leaf has feature -1. Rows with a bin up to ``bin`` go left."""
    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    rows: np.ndarray

    def leaves_of(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row of bins."""
        levels = self.levels()
        if levels is not None:
            at = np.zeros(len(bins), np.int64)
            for f, b in levels:
                at += at
                at += bins[:, f] > b
            return at + ((1 << len(levels)) - 1)
        at, columns, open_nodes = np.zeros(len(bins), np.int64), {}, [(0, np.arange(len(bins)))]
        while open_nodes:  # a node at a time: a row costs its own depth
            node, rows = open_nodes.pop()
            f = int(self.feature[node])
            if f < 0:
                at[rows] = node
            elif len(rows):
                if f not in columns:
                    columns[f] = np.ascontiguousarray(bins[:, f])
                goes_left = columns[f].take(rows) <= self.bin[node]
                open_nodes += [(int(self.left[node]), rows[goes_left]), (int(self.right[node]), rows[~goes_left])]
        return at

    def levels(self) -> list[tuple[int, int]] | None:
        """(feature, bin) by level, if all nodes of a level split alike and are numbered level by level; else None."""
        depth = len(self.feature).bit_length() - 1
        inner = (1 << depth) - 1
        numbers = np.arange(inner)
        if len(self.feature) != 2 * inner + 1 or (self.feature[inner:] >= 0).any() or (self.left[:inner] != 2 * numbers + 1).any() or (self.right[:inner] != 2 * numbers + 2).any():
            return None
        found = []
        for level in range(depth):
            here = slice((1 << level) - 1, (2 << level) - 1)
            f, b = int(self.feature[here.start]), int(self.bin[here.start])
            if f < 0 or (self.feature[here] != f).any() or (self.bin[here] != b).any():
                return None
            found.append((f, b))
        return found


class Split(NamedTuple):
    """The best split of a leaf; sums are whole numbers of 1 / UNIT: (gradient, hessian, rows) of both sides."""
    gain: float
    feature: int
    bin: int
    left: tuple[int, int, int]
    right: tuple[int, int, int]


# ---------------------------------------------------------------- bins

def quantile_borders(df: DataFrame, features: Sequence[str], count: int) -> list[np.ndarray]:
    """At most ``count`` borders a feature: its quantiles at i / (count + 1)."""
    return shared_borders(df, features, [count])[count]


def shared_borders(df: DataFrame, features: Sequence[str], counts: Sequence[int]) -> dict[int, list[np.ndarray]]:
    """``quantile_borders`` for each of ``counts``. One aggregate; each feature's sketches are merged on their own, and all counts read the same sketch."""
    probs = sorted({i / (count + 1) for count in counts for i in range(1, count + 1)})
    value = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    values = df.select(F.posexplode(F.array(*[value(c) for c in features])).alias("i", "v"))
    found = dict(map(tuple, values.groupBy("i").agg(F.percentile_approx("v", probs, ACCURACY)).collect()))  # one row a feature
    place = {p: at for at, p in enumerate(probs)}
    pick = lambda values, count: [values[place[i / (count + 1)]] for i in range(1, count + 1)] if values else []
    return {count: [np.unique(np.array(pick(found.get(i), count), float)) for i in range(len(features))] for count in counts}


def binned(batch_columns: Sequence[pa.Array], borders: Sequence[np.ndarray]) -> np.ndarray:
    """The bin of each value: the number of borders at or below it (missing values: all)."""
    out = np.empty((len(batch_columns[0]) if batch_columns else 0, len(borders)), np.uint8)
    for i, (c, b) in enumerate(zip(batch_columns, borders)):
        out[:, i] = np.searchsorted(b, c.cast(pa.float64()).to_numpy(zero_copy_only=False), "right")
    return out


def _as_blocks(h: np.ndarray, y: np.ndarray, bins: np.ndarray, margin: np.ndarray) -> pa.RecordBatch:
    """Rows as blocks of ``BLOCK``: in each column the bytes of the block's values."""
    ends = np.minimum(np.arange(math.ceil(len(h) / BLOCK) + 1) * BLOCK, len(h))
    columns = []
    for x, kind in ((h, np.int64), (y, np.float64), (bins, np.uint8), (margin, np.float64)):
        x = np.ascontiguousarray(x, kind)
        size = x.itemsize * (x.shape[1] if x.ndim > 1 else 1)
        columns.append(pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * size).astype(np.int32)), pa.py_buffer(x)]))
    return pa.RecordBatch.from_arrays(columns, ["h", "y", "bins", "margin"])


def _values(column: pa.Array, kind: type) -> np.ndarray:
    """The values of a column of blocks in a row, without a copy."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].view(kind)


def _from_blocks(batches: Iterator[pa.RecordBatch], rows: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(h, y, bins, margin) of at most ``rows`` rows at a time."""
    for batch in batches:
        for i in range(0, len(batch), rows // BLOCK):
            part = batch.slice(i, rows // BLOCK)
            h, y, bins, margin = (_values(part.column(j), kind) for j, kind in enumerate((np.int64, np.float64, np.uint8, np.float64)))
            yield h, y, bins.reshape(len(h), -1), margin


def _chunks(batches: Iterator[pa.RecordBatch], rows: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at least ``rows`` rows, but for the last."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= rows:
            yield pa.concat_batches(held)
            held, n = [], 0
    if n:
        yield pa.concat_batches(held)


def _rows_table(df: DataFrame, features: Sequence[str], borders: list[np.ndarray], key: str, label: str, base: float) -> DataFrame:
    """(h: the key as a number, y, bins, margin), in blocks."""
    h = F.col(key).cast("long") if isinstance(df.schema[key].dataType, IntegralType) else F.xxhash64(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _chunks(batches):
            h, y = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            yield _as_blocks(h, y, binned(b.columns[2:], borders), np.full(len(b), base))

    return df.select(h.alias("h"), F.col(label).cast("int").alias("y"), *features).mapInArrow(run, _ROWS)


def unit_hash(keys: np.ndarray, seed: int) -> np.ndarray:
    """``functions.splitmix`` on an array: a number in [0, 1) a key."""
    x = keys.astype(np.int64).view(np.uint64) + np.uint64((seed * GOLDEN) & M64)
    x ^= x >> np.uint64(SHIFTS[0])
    x *= np.uint64(MIX1)
    x ^= x >> np.uint64(SHIFTS[1])
    x *= np.uint64(MIX2)
    x ^= x >> np.uint64(SHIFTS[2])
    return (x >> np.uint64(11)).astype(float) / float(1 << 53)


def feature_sample(n: int, share: float, number: int) -> list[int]:
    """The features round ``number`` may split on: those with the smallest hashes of their position."""
    order = np.argsort(unit_hash(np.arange(n), ROUND_SEED + number), kind="stable")
    return sorted(order[:max(1, math.ceil(share * n))].tolist())


# ---------------------------------------------------------------- sums

def whole_units(x: np.ndarray) -> np.ndarray:
    return np.floor(x * UNIT + 0.5).astype(np.int64)


def probability(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-margin))


class Round(NamedTuple):
    """What a pass over the training rows needs: the trees since the margins were written, the round and its samples."""
    pending: tuple[Tree, ...]
    number: int
    width: int
    features: tuple[int, ...]
    settings: Settings

    def rows(self, h: np.ndarray, y: np.ndarray, bins: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bins, gradients and hessians of the rows drawn."""
        if self.settings.rows < 1:
            drawn = np.nonzero(unit_hash(h, ROUND_SEED + self.number) < self.settings.rows)[0]
            bins, y, margin = bins[drawn], y[drawn], margin[drawn]
        margin = raised(margin, bins, self.pending)
        p = probability(margin)
        return bins, whole_units(p - y), whole_units(p * (1 - p))


def raised(margin: np.ndarray, bins: np.ndarray, trees: Sequence[Tree]) -> np.ndarray:
    for t in trees:
        margin = margin + t.value[t.leaves_of(bins)]
    return margin


def histograms(columns: Sequence[np.ndarray], g: np.ndarray, h: np.ndarray, place: np.ndarray | None, places: int, width: int) -> np.ndarray:
    """Sums (gradient, hessian, rows) by place, feature and bin, as whole numbers [3, places, features, width]. ``columns``: the bins by feature."""
    out = np.empty((3, places, len(columns), width), np.int64)
    first, g, h = None if place is None else place * width, g.astype(float, copy=False), h.astype(float, copy=False)
    for i, column in enumerate(columns):  # one feature at a time: no copies of the sums' terms
        at = column.astype(np.int64) if first is None else first + column
        for j, terms in enumerate((g, h, None)):
            out[j, :, i] = np.bincount(at, terms, places * width).reshape(places, width)  # whole numbers below 2^53: exact
    return out


def gain_table(hist: np.ndarray, settings: Settings) -> np.ndarray:
    """Regularised gain of every (leaf, feature, bin) of [3, leaves, features, width]; -inf where a side has too few rows."""
    left = np.cumsum(hist, axis=3)
    total = left[..., -1:]
    value = lambda s: (s[0] / UNIT) * (s[0] / UNIT) / (s[1] / UNIT + settings.l2)
    right = total - left
    with np.errstate(invalid="ignore", divide="ignore"):
        gain = value(left) + value(right) - value(total)
    enough = (left[2] >= max(1, settings.least_rows)) & (right[2] >= max(1, settings.least_rows))
    return np.where(enough, gain, -np.inf)


def best_split(hist: np.ndarray, features: Sequence[int], settings: Settings) -> Split | None:
    """The best split of one leaf's sums [3, features, width]; of equal gains the first feature, then the lowest bin."""
    gain = gain_table(hist[:, None], settings)[0]
    f, b = np.unravel_index(np.argmax(gain), gain.shape)
    if not gain[f, b] > LEAST_GAIN:
        return None
    left = hist[:, f, :b + 1].sum(axis=1)
    right = hist[:, f].sum(axis=1) - left
    return Split(float(gain[f, b]), features[f], int(b), tuple(left.tolist()), tuple(right.tolist()))


# ---------------------------------------------------------------- leaf-wise trees

class Grown:
    """The splits known of a tree under construction. Node 0 is the root; a node without a split is a leaf so far."""

    def __init__(self):
        self.splits: list[Split | None] = [None]
        self.children: list[tuple[int, int] | None] = [None]
        self.sums: list[tuple[int, int, int] | None] = [None]
        self.bound: list[float] = [math.inf]

    def split(self, node: int, s: Split) -> tuple[int, int]:
        first = len(self.splits)
        self.splits[node], self.children[node] = s, (first, first + 1)
        if self.sums[node] is None:
            self.sums[node] = tuple(map(operator.add, s.left, s.right))
        for side in (s.left, s.right):
            self.splits.append(None)
            self.children.append(None)
            self.sums.append(side)
            self.bound.append(min(self.bound[node], s.gain))
        return first, first + 1

    def least(self, leaves: int) -> float:
        """The gain bound that a further split must reach to be among the first ``leaves`` - 1."""
        reached = sorted((min(b, s.gain) for b, s in zip(self.bound, self.splits) if s), reverse=True)
        return reached[leaves - 2] if 0 < leaves - 1 <= len(reached) else 0.0

    def tree(self, settings: Settings) -> Tree:
        """Best-first growth over the known splits: the open leaf with the largest gain is split next."""
        order, heap = {0: 0}, [(-self.splits[0].gain, 0)] if self.splits[0] else []
        chosen = 0
        rows = []
        while heap and chosen < settings.leaves - 1:
            _, node = heapq.heappop(heap)
            chosen += 1
            rows.append(node)
            for child in self.children[node]:
                order[child] = len(order)
                if self.splits[child]:
                    heapq.heappush(heap, (-self.splits[child].gain, child))
        n, inner = len(order), set(rows)
        t = Tree(np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n), np.zeros(n, np.int64))
        for node, at in order.items():
            total = self.sums[node] or (0, 0, 0)
            t.rows[at] = total[2]
            if node in inner:
                s, (left, right) = self.splits[node], self.children[node]
                t.feature[at], t.bin[at], t.left[at], t.right[at], t.gain[at] = s.feature, s.bin, order[left], order[right], s.gain
            else:
                t.value[at] = leaf_value(total, settings)
        return t


def leaf_value(sums: Sequence[int], settings: Settings) -> float:
    g, h = sums[0] / UNIT, sums[1] / UNIT
    return -settings.rate * g / (h + settings.l2) if h + settings.l2 > 0 else 0.0


def grown_here(bins: np.ndarray, g: np.ndarray, h: np.ndarray, features: Sequence[int], width: int, settings: Settings, least: float = 0.0) -> Grown:
    """Best-first growth over rows in memory, to at most ``settings.leaves`` leaves; splits that cannot reach the gain ``least`` are left out."""
    out = Grown()
    out.sums[0] = (int(g.sum(dtype=np.int64)), int(h.sum(dtype=np.int64)), len(g))
    columns, place = np.ascontiguousarray(bins[:, list(features)].T), {f: i for i, f in enumerate(features)}
    heap: list = []

    def counted(part: tuple[np.ndarray, ...]) -> np.ndarray:
        return histograms(*part, None, 1, width)[:, 0]

    def consider(node: int, part: tuple[np.ndarray, ...], sums: np.ndarray) -> None:
        s = best_split(sums, features, settings)
        if s and min(out.bound[node], s.gain) >= least:
            heapq.heappush(heap, (-s.gain, node, part, sums, s))

    every = (columns, g.astype(float), h.astype(float))
    consider(0, every, counted(every))
    del every
    chosen, worth = 0, 2 * max(1, settings.least_rows)
    while heap and chosen < settings.leaves - 1:
        _, node, part, sums, s = heapq.heappop(heap)
        chosen += 1
        children = out.split(node, s)
        if chosen == settings.leaves - 1 or max(s.left[2], s.right[2]) < worth:
            continue
        goes_left = part[0][place[s.feature]] <= s.bin
        sides = [tuple(x.take(rows, axis=-1) for x in part) for rows in (np.flatnonzero(goes_left), np.flatnonzero(~goes_left))]
        small = int(s.right[2] < s.left[2])
        own = counted(sides[small])
        of = [own, sums - own] if small == 0 else [sums - own, own]
        for child, side, total in zip(children, sides, of):
            if len(side[1]) >= worth:
                consider(child, side, total)
    return out


_SPLITS = "leaf long, node long, child long, gain double, feature long, bin long, lg long, lh long, ln long, rg long, rh long, rn long"
_SPLIT_NAMES = [c.split()[0] for c in _SPLITS.split(", ")]


def _split_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in _SPLIT_NAMES]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.float64() if n == "gain" else pa.int64()) for n, c in zip(_SPLIT_NAMES, cols)], _SPLIT_NAMES)


def _read_split(r) -> Split:
    return Split(r["gain"], r["feature"], r["bin"], (r["lg"], r["lh"], r["ln"]), (r["rg"], r["rh"], r["rn"]))


def merged(sums: DataFrame, by: str, tasks: int, finish, schema: str) -> DataFrame:
    """Adds up the tasks' sums (``by``, task, sums: binary of whole numbers) in groups of at most ``MERGE``, then applies ``finish``(by, total)."""
    def total(t: pa.Table) -> np.ndarray:
        return functools.reduce(np.add, (np.frombuffer(v.as_buffer(), np.int64) for v in t.column("sums")))

    def add(key: tuple, t: pa.Table) -> pa.Table:
        return pa.table([pa.array([key[0].as_py()]), pa.array([key[1].as_py()]), pa.array([total(t).tobytes()], pa.binary())], [by, "task", "sums"])

    while tasks > MERGE:
        sums = sums.withColumn("part", F.floor(F.col("task") / MERGE)).groupBy(by, "part").applyInArrow(add, f"{by} long, task long, sums binary")
        tasks = math.ceil(tasks / MERGE)
    return sums.groupBy(by).applyInArrow(lambda key, t: pa.Table.from_batches([finish(key[0].as_py(), total(t))]), schema)


def _partial(grown: Grown) -> Tree:
    """The tree so far, with every leaf's node number as its value."""
    n = len(grown.splits)
    t = Tree(np.full(n, -1), *[np.zeros(n, np.int64) for _ in range(3)], np.arange(n, dtype=float), np.zeros(n), np.zeros(n, np.int64))
    for i, (s, c) in enumerate(zip(grown.splits, grown.children)):
        if s:
            t.feature[i], t.bin[i], t.left[i], t.right[i] = s.feature, s.bin, *c
    return t


def leafwise_tree(train: DataFrame, n: int, now: Round, bins: int, whole: int, tasks: int) -> Tree:
    """One tree: histogram passes while a leaf has over ``whole`` rows, then the subtrees of all others in a task each. ``n``: training rows,
    read by ``tasks`` tasks."""
    settings, features = now.settings, now.features
    grown, open_leaves = Grown(), [0]
    size = lambda leaf: n if grown.sums[leaf] is None else grown.sums[leaf][2]
    while True:
        least = grown.least(settings.leaves)
        open_leaves = [i for i in open_leaves if grown.bound[i] >= least and size(i) >= 2 * max(1, settings.least_rows)]
        large = [i for i in open_leaves if size(i) > whole]
        if not large:
            break
        shape, so_far = (3, len(features), bins), _partial(grown)

        def count(batches: Iterator[pa.RecordBatch], large=tuple(large), so_far=so_far) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext
            place = np.full(len(so_far.feature), -1)
            place[list(large)] = np.arange(len(large))
            sums = np.zeros((3, len(large), len(features), bins), np.int64)
            for rows in _from_blocks(batches):
                b, g, h = now.rows(*rows)
                at = place[so_far.leaves_of(b)]
                keep = np.flatnonzero(at >= 0)
                if len(keep) < len(at):
                    b, g, h, at = b[keep], g[keep], h[keep], at[keep]
                sums += histograms([b[:, f] for f in features], g, h, at, len(large), bins)
            yield pa.RecordBatch.from_arrays([pa.array(large, pa.int64()), pa.array([TaskContext.get().partitionId()] * len(large), pa.int64()),
                                              pa.array([sums[:, i].tobytes() for i in range(len(large))], pa.binary())], ["leaf", "task", "sums"])

        def choose(leaf: int, total: np.ndarray, shape=shape) -> pa.RecordBatch:
            s = best_split(total.reshape(shape), features, settings)
            none = total.reshape(shape)[:, 0].sum(axis=1).tolist()
            return _split_batch([(leaf, 0, 1, s.gain, s.feature, s.bin, *s.left, *s.right) if s else (leaf, -1, 0, 0.0, 0, 0, *none, 0, 0, 0)])

        found = sorted(merged(train.mapInArrow(count, "leaf long, task long, sums binary"), "leaf", tasks, choose, _SPLITS).collect(), key=lambda r: r["leaf"])  # one row a leaf
        open_leaves = [i for i in open_leaves if i not in large]
        for r in found:
            if r["node"] < 0:
                grown.sums[r["leaf"]] = (r["lg"], r["lh"], r["ln"])
            else:
                open_leaves += grown.split(r["leaf"], _read_split(r))
    if open_leaves:
        so_far = _partial(grown)

        def deal(batches: Iterator[pa.RecordBatch], leaves=tuple(open_leaves)) -> Iterator[pa.RecordBatch]:
            for rows in _from_blocks(batches, 4 * CHUNK):
                b, g, h = now.rows(*rows)
                at = so_far.leaves_of(b)
                keep = np.flatnonzero(np.isin(at, leaves))
                keep = keep[np.argsort(at[keep], kind="stable")]
                found, starts = np.unique(at[keep], return_index=True)
                parts = [keep[i:j] for i, j in zip(starts, [*starts[1:], len(keep)])]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), *[pa.array([x[p].astype(kind, copy=False).tobytes() for p in parts], pa.binary()) for x, kind in ((b, np.uint8), (g, np.int64), (h, np.int32))]],
                                                 ["leaf", "bins", "g", "h"])

        def subtree(key: tuple, t: pa.Table) -> pa.Table:  # at most ``whole`` rows, in blocks
            b, g, h = (np.concatenate([np.frombuffer(v.as_buffer(), kind) for v in t.column(c)]) for c, kind in (("bins", np.uint8), ("g", np.int64), ("h", np.int32)))
            part = grown_here(b.reshape(len(g), now.width), g, h, features, bins, settings, least)
            leaf = key[0].as_py()
            rows = [(leaf, i, part.children[i][0], s.gain, s.feature, s.bin, *s.left, *s.right) for i, s in enumerate(part.splits) if s]
            return pa.Table.from_batches([_split_batch(rows or [(leaf, -1, 0, 0.0, 0, 0, *part.sums[0], 0, 0, 0)])])

        parts = train.mapInArrow(deal, "leaf long, bins binary, g binary, h binary").groupBy("leaf").applyInArrow(subtree, _SPLITS)
        # at most 2 x leaves subtrees of leaves - 1 splits each; a subtree numbers its nodes as they are made, parents first
        names: dict[tuple[int, int], int] = {}
        for r in sorted(parts.collect(), key=lambda r: (r["leaf"], r["child"])):
            if r["node"] < 0:
                grown.sums[r["leaf"]] = (r["lg"], r["lh"], r["ln"])
                continue
            node = r["leaf"] if r["node"] == 0 else names[r["leaf"], r["node"]]
            names[r["leaf"], r["child"]], names[r["leaf"], r["child"] + 1] = grown.split(node, _read_split(r))
    return grown.tree(settings)


# ---------------------------------------------------------------- symmetric trees

def symmetric_tree(train: DataFrame, now: Round, bins: int, tasks: int, group: int = 4) -> Tree:
    """One tree of ``settings.depth`` levels at most; leaf number: one bit a level, 1 to the right, the first level's highest."""
    settings, features = now.settings, now.features
    levels: list[tuple[int, int, float]] = []
    sums = np.zeros((3, 1), np.int64)
    blocks = [features[i:i + group] for i in range(0, len(features), group)]
    for depth in range(settings.depth):
        leaves = 1 << depth

        def count(batches: Iterator[pa.RecordBatch], levels=tuple(levels), leaves=leaves) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext
            total = np.zeros((3, leaves, len(features), bins), np.int64)
            for rows in _from_blocks(batches):
                b, g, h = now.rows(*rows)
                total += histograms([b[:, f] for f in features], g, h, _symmetric_leaf(b, levels), leaves, bins)
            cut = [np.ascontiguousarray(total[:, :, i * group:(i + 1) * group]).tobytes() for i in range(len(blocks))]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int64()), pa.array([TaskContext.get().partitionId()] * len(blocks), pa.int64()), pa.array(cut, pa.binary())], ["block", "task", "sums"])

        def choose(block: int, total: np.ndarray, leaves=leaves) -> pa.RecordBatch:
            hist = total.reshape(3, leaves, len(blocks[block]), bins)
            gain = _symmetric_gains(hist, settings)
            f, b = np.unravel_index(np.argmax(gain), gain.shape)
            left = hist[:, :, f, :b + 1].sum(axis=2)
            both = np.stack([left, hist[:, :, f].sum(axis=2) - left], axis=2)  # [3, leaves, side]
            return pa.RecordBatch.from_arrays([pa.array([float(gain[f, b])]), pa.array([int(blocks[block][f])], pa.int64()), pa.array([int(b)], pa.int64()), pa.array([both.tobytes()], pa.binary())], ["gain", "feature", "bin", "sums"])

        best = merged(train.mapInArrow(count, "block long, task long, sums binary"), "block", tasks, choose, "gain double, feature long, bin long, sums binary").collect()
        best.sort(key=lambda r: (-r["gain"], r["feature"]))
        sides = np.frombuffer(best[0]["sums"], np.int64).reshape(3, 2 * leaves) if best else sums
        if not best or not best[0]["gain"] > LEAST_GAIN:
            if not levels and best:
                sums = sides.sum(axis=1, keepdims=True)
            break
        levels.append((best[0]["feature"], best[0]["bin"], best[0]["gain"]))
        sums = sides
    return _symmetric_nodes(levels, sums, settings)


def symmetric_here(bins: np.ndarray, g: np.ndarray, h: np.ndarray, features: Sequence[int], width: int, settings: Settings) -> Tree:
    """``symmetric_tree`` over rows in memory: of two children the smaller one is added up, the other is what is left of their parent."""
    columns, g, h = np.ascontiguousarray(bins.T), g.astype(float), h.astype(float)
    levels: list[tuple[int, int, float]] = []
    sums, at, hist = np.array([[g.sum()], [h.sum()], [len(g)]]).astype(np.int64), np.zeros(len(g), np.int64), None
    for depth in range(settings.depth):
        leaves = 1 << depth
        if depth == 0:
            hist = histograms([columns[f] for f in features], g, h, None, 1, width)
        else:
            small = (sums[2, 1::2] < sums[2, ::2]).astype(np.int64)  # by parent: the side with fewer rows
            rows = np.flatnonzero((at & 1) == small[at >> 1])
            own = histograms([columns[f].take(rows) for f in features], g.take(rows), h.take(rows), at.take(rows) >> 1, leaves >> 1, width)
            both = np.empty((3, leaves, len(features), width), np.int64)
            parents = np.arange(leaves >> 1)
            both[:, 2 * parents + small], both[:, 2 * parents + 1 - small] = own, hist - own
            hist = both
        gain = _symmetric_gains(hist, settings)
        f, b = np.unravel_index(np.argmax(gain), gain.shape)
        if not gain[f, b] > LEAST_GAIN:
            break
        left = hist[:, :, f, :b + 1].sum(axis=2)
        sums = np.stack([left, hist[:, :, f].sum(axis=2) - left], axis=2).reshape(3, 2 * leaves)
        levels.append((features[f], int(b), float(gain[f, b])))
        at = 2 * at + (columns[features[f]] > b)
    return _symmetric_nodes(levels, sums, settings)


def _symmetric_leaf(bins: np.ndarray, levels: Sequence[tuple]) -> np.ndarray:
    at = np.zeros(len(bins), np.int64)
    for f, b, *_ in levels:
        at = 2 * at + (bins[:, f] > b)
    return at


def _symmetric_gains(hist: np.ndarray, settings: Settings) -> np.ndarray:
    """Gain of (feature, bin) summed over the leaves; a leaf that a split leaves whole adds nothing."""
    left = np.cumsum(hist, axis=3)
    total = left[..., -1:]
    value = lambda s: (s[0] / UNIT) * (s[0] / UNIT) / (s[1] / UNIT + settings.l2)
    gains = value(left) + value(total - left) - value(total)
    out = np.zeros(gains.shape[1:])
    for leaf in gains:  # one after the other, so the order of adding is fixed
        out = out + leaf
    return out


def _symmetric_nodes(levels: Sequence[tuple], sums: np.ndarray, settings: Settings) -> Tree:
    depth = len(levels)
    n = (2 << depth) - 1
    inner = (1 << depth) - 1
    t = Tree(np.full(n, -1), *[np.zeros(n, np.int64) for _ in range(3)], np.zeros(n), np.zeros(n), np.zeros(n, np.int64))
    for i in range(inner):
        f, b, gain = levels[(i + 1).bit_length() - 1]
        first = i + 1 == 1 << ((i + 1).bit_length() - 1)
        t.feature[i], t.bin[i], t.left[i], t.right[i], t.gain[i] = f, b, 2 * i + 1, 2 * i + 2, gain if first else 0.0  # a level's gain counts once
    for leaf in range(1 << depth):
        t.value[inner + leaf], t.rows[inner + leaf] = leaf_value(sums[:, leaf], settings), sums[2, leaf]
    for i in reversed(range(inner)):
        t.rows[i] = t.rows[2 * i + 1] + t.rows[2 * i + 2]
    return t


# ---------------------------------------------------------------- the model

@dataclass(frozen=True)
class Boosted:
    """A fitted model: the trees kept (up to the best round), and the validation metric of every round that was trained."""
    features: tuple[str, ...]
    borders: tuple[tuple[float, ...], ...]
    base: float
    trees: tuple[Tree, ...]
    trained: int
    history: tuple[float, ...]
    metric: str
    settings: Settings

    @property
    def rounds(self) -> int:
        return len(self.trees)


_NODES = "tree int, node int, feature string, bin int, threshold double, left int, right int, value double, gain double, rows long"


def _node_columns(trees: Sequence[Tree], first: int = 0) -> dict[str, np.ndarray]:
    """All nodes of the trees in columns; the first tree has the number ``first``."""
    sizes = np.array([len(t.feature) for t in trees], np.int64)
    every = {name: np.concatenate([np.zeros(0, kind), *(getattr(t, name) for t in trees)]) for name, kind in zip(Tree._fields, (np.int64,) * 4 + (float,) * 2 + (np.int64,))}
    starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
    return {"tree": np.repeat(np.arange(first, first + len(sizes)), sizes), "node": np.arange(sizes.sum()) - starts, **every}


def node_table(spark: SparkSession, model: Boosted, first: int = 0) -> DataFrame:
    """The model as rows: a value below ``threshold`` goes to node ``left``, others and missing ones to ``right``; leaves have no feature."""
    c = _node_columns(model.trees, first)
    leaf = c["feature"] < 0
    ends = np.cumsum([0, *(len(b) for b in model.borders)])
    flat = np.concatenate([np.zeros(0), *(np.array(b, float) for b in model.borders)])
    threshold = np.zeros(len(leaf))
    threshold[~leaf] = flat[ends[c["feature"][~leaf]] + c["bin"][~leaf]]
    names = pa.array(model.features, pa.string()).take(pa.array(c["feature"], pa.int64(), mask=leaf))
    split = lambda x, kind: pa.array(x, kind, mask=leaf)
    columns = [pa.array(c["tree"], pa.int32()), pa.array(c["node"], pa.int32()), names, split(c["bin"], pa.int32()), split(threshold, pa.float64()), split(c["left"], pa.int32()), split(c["right"], pa.int32()),
               pa.array(c["value"], pa.float64(), mask=~leaf), split(c["gain"], pa.float64()), pa.array(c["rows"], pa.int64())]
    if not len(leaf):
        return spark.createDataFrame([], _NODES)
    return spark.createDataFrame(pa.table(columns, [x.split()[0] for x in _NODES.split(", ")]), _NODES)


def _trees(nodes: pa.Table, features: Sequence[str]) -> tuple[Tree, ...]:
    """The trees of a node table, in the order of their numbers."""
    nodes = nodes.sort_by([("tree", "ascending"), ("node", "ascending")])
    place = {f: i for i, f in enumerate(features)}
    plain = lambda c, kind, none: nodes.column(c).fill_null(none).to_numpy().astype(kind)
    feature = np.array([-1 if f is None else place[f] for f in nodes.column("feature").to_pylist()], np.int64)
    columns = [feature, *(plain(c, np.int64, 0) for c in ("bin", "left", "right")), *(plain(c, float, 0.0) for c in ("value", "gain")), plain("rows", np.int64, 0)]
    starts = np.flatnonzero(plain("node", np.int64, 0) == 0)
    return tuple(Tree(*(x[i:j].copy() for x in columns)) for i, j in zip(starts, [*starts[1:], len(feature)]))


def _save_rest(spark: SparkSession, model: Boosted, path: str) -> None:
    meta = {"features": model.features, "borders": model.borders, "base": model.base, "trained": model.trained, "history": model.history, "metric": model.metric, "settings": asdict(model.settings)}
    spark.createDataFrame([(json.dumps(meta),)], "model string").coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")


def save(spark: SparkSession, model: Boosted, path: str) -> None:
    """The node table and one row of everything else, the feature order included."""
    node_table(spark, model).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    _save_rest(spark, model, path)


def load(spark: SparkSession, path: str, nodes: Sequence[str] | None = None) -> Boosted:
    """``nodes``: where the node table's parts are, if not under ``path``."""
    m = json.loads(spark.read.parquet(f"{path}/meta").first()["model"])
    parts = [f"{path}/nodes"] if nodes is None else nodes
    trees = _trees(spark.read.schema(_NODES).parquet(*parts).toArrow(), m["features"]) if parts else ()
    return Boosted(tuple(m["features"]), tuple(map(tuple, m["borders"])), m["base"], trees, m["trained"], tuple(m["history"]), m["metric"], Settings(**m["settings"]))


def score(model: Boosted, df: DataFrame, key: str = "id", label: str | None = "flag", out: str = "y_score") -> DataFrame:
    """P(label = 1) per row, in the model's feature order; with a label the result is a prediction table (id, y_true, y_score)."""
    borders = [np.array(b) for b in model.borders]
    keep = [F.col(key).alias("_key"), *([F.col(label).alias("_label")] if label else [])]
    kinds = df.select(*keep).schema
    names, first = [*kinds.names, "_score"], len(keep)

    base, trees = model.base, tuple(t._replace(gain=None, rows=None) for t in model.trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _chunks(batches):  # a tree's nodes cost a batch the same, however few its rows
            bins = binned(b.columns[first:], borders)
            margin = raised(np.full(len(b), base), bins, trees)
            yield pa.RecordBatch.from_arrays([*b.columns[:first], pa.array(probability(margin))], names)

    scored = df.select(*keep, *model.features).mapInArrow(run, kinds.add("_score", "double"))
    return scored.select(F.col("_key").alias(key), *([F.col("_label").alias("y_true")] if label else []), F.col("_score").alias(out))


def feature_importance(spark: SparkSession, model: Boosted, top: int | None = 30) -> DataFrame:
    """Total gain per feature, as a share of all gain, descending; features without a split have 0."""
    nodes = node_table(spark, model).where(F.col("feature").isNotNull())
    gains = nodes.groupBy("feature").agg(F.sum("gain").alias("gain"), F.count(F.lit(1)).alias("splits"))
    every = spark.createDataFrame([(f,) for f in model.features], "feature string")
    shared = every.join(gains, "feature", "left").select("feature", F.coalesce("gain", F.lit(0.0)).alias("gain"), F.coalesce("splits", F.lit(0)).alias("splits"))
    total = shared.select(F.sum("gain")).scalar()
    ranked = shared.select("feature", F.coalesce(F.try_divide("gain", total), F.lit(0.0)).alias("importance"), "gain", "splits").orderBy(F.desc("importance"), "feature")
    return ranked.limit(top) if top else ranked


# ---------------------------------------------------------------- fitting

def best_iteration(values: Sequence[float], patience: int, higher: bool) -> tuple[int, bool]:
    """The number of rounds with the best value before ``patience`` rounds pass without a new best one, and whether they did."""
    best = 0
    for i, v in enumerate(values):
        if v > values[best] if higher else v < values[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def staged_metric(valid: DataFrame, trees: Sequence[Tree], metric: str) -> list[float]:
    """The validation metric after each of ``trees`` (rows hold the margins before the first)."""
    k = len(trees)

    def stages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
        for _, y, bins, margin in _from_blocks(batches):
            out = []
            for t in trees:
                margin = margin + t.value[t.leaves_of(bins)]
                out.append(margin)
            yield y, out

    if metric == "logloss":
        def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for y, margins in stages(batches):
                sums = [float(np.logaddexp(0.0, np.where(y == 1, -m, m)).sum()) for m in margins]
                yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(sums), pa.array([len(y)] * k, pa.int64())], ["stage", "loss", "n"])

        rows = valid.mapInArrow(losses, "stage int, loss double, n long").groupBy("stage").agg((F.sum("loss") / F.sum("n")).alias("m")).orderBy("stage").collect()
        return [r["m"] for r in rows]
    if metric != "auc":
        raise ValueError(f"unknown metric {metric!r}")

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for y, margins in stages(batches):
            for i, m in enumerate(margins):
                v, at = np.unique(m, return_inverse=True)
                pos = np.bincount(at, y, len(v)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), i, np.int32)), pa.array(v), pa.array(pos), pa.array(np.bincount(at, minlength=len(v)) - pos)], ["stage", "margin", "pos", "neg"])

    points = valid.mapInArrow(counts, "stage int, margin double, pos long, neg long").groupBy("stage", "margin").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    # all stages in one global order; each stage has the same number of positives
    run = running_totals(points.select(F.struct("stage", "margin").alias("at"), "pos", "neg"), "at", ["pos"], descending=False)
    per = run.groupBy(F.col("at.stage").alias("stage")).agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"), F.max("cum_pos").alias("last"),
                                                             F.sum((F.col("neg") * (F.col("cum_pos") * 2 - F.col("pos"))).cast("decimal(38,0)")).alias("below")).orderBy("stage").collect()
    out = []
    for r in per:
        p, n, before = r["p"], r["n"], r["last"] - r["p"]
        lower = int(r["below"]) - 2 * before * n  # twice the positives at or under the negatives, ties half
        out.append((2 * p * n - lower) / (2 * p * n) if p and n else math.nan)
    return out


def _auc_here(y: np.ndarray, margin: np.ndarray) -> float:
    """As ``staged_metric``, of rows in memory: whole numbers up to the last division."""
    _, at = np.unique(margin, return_inverse=True)
    pos = np.bincount(at, y).astype(np.int64)
    neg = np.bincount(at) - pos
    p, n = int(pos.sum()), int(neg.sum())
    lower = int((neg * (2 * np.cumsum(pos) - pos)).sum())
    return (2 * p * n - lower) / (2 * p * n) if p and n else math.nan


_GROWN = "number int, metric double, " + ", ".join(f"{f} array<{'double' if f in ('value', 'gain') else 'long'}>" for f in Tree._fields)


def stretch_here(train: DataFrame, valid: DataFrame, first: int, last: int, history: Sequence[float], width: int, bins: int, settings: Settings, metric: str) -> tuple[list[Tree], list[float]]:
    """The trees of the rounds ``first`` to ``last`` - 1, fewer if patience ends a spell before, and the validation metric after each (none without validation rows); all in one task
    that holds the rows of both tables."""
    both = train.withColumn("valid", F.lit(False)).unionByName(valid.withColumn("valid", F.lit(True))).coalesce(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[bool, list[tuple]] = {False: [], True: []}
        for batch in batches:
            for side in (False, True):
                rows = batch.filter(batch.column(4) if side else pa.compute.invert(batch.column(4)))
                parts[side] += [tuple(x.copy() for x in found) for found in _from_blocks([rows])]
        if not parts[False]:
            return
        h, y, cells, margin = (np.concatenate(x) for x in zip(*parts[False]))
        tested = [np.concatenate(x) for x in zip(*parts[True])]
        if np.isnan(y).any() or tested and np.isnan(tested[1]).any():
            raise ValueError("a row without a label")
        known = list(history)
        for number in range(first, last):
            if tested and (number - first) % SPELL == 0 and known and best_iteration(known, settings.patience, metric == "auc")[1]:
                return
            features = tuple(feature_sample(width, settings.features, number))
            b, g, hess = Round((), number, width, features, settings).rows(h, y, cells, margin)
            tree = symmetric_here(b, g, hess, features, bins, settings) if settings.symmetric else grown_here(b, g, hess, features, bins, settings).tree(settings)
            margin = raised(margin, cells, (tree,))
            value = math.nan
            if tested:
                tested[3] = raised(tested[3], tested[2], (tree,))
                value = _auc_here(tested[1], tested[3]) if metric == "auc" else float(np.logaddexp(0.0, np.where(tested[1] == 1, -tested[3], tested[3])).mean())
                known.append(value)
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([value]), *[pa.array([x.tolist()], pa.list_(pa.float64() if f in ("value", "gain") else pa.int64())) for f, x in zip(Tree._fields, tree)]],
                                             ["number", "metric", *Tree._fields])

    if metric not in ("auc", "logloss"):
        raise ValueError(f"unknown metric {metric!r}")
    rows = both.mapInArrow(run, _GROWN).toArrow().sort_by("number")  # at most ``STRETCH`` trees
    trees = [Tree(*(rows.column(f)[i].values.to_numpy() for f in Tree._fields)) for i in range(len(rows))]
    return trees, rows.column("metric").to_pylist()


class _State:
    """The written state of a fit: ``<path>/spell-<k>`` holds the rows with their margins and the model so far but for its trees, written last; ``<path>/trees-<k>`` the
    trees of that spell alone, so a spell's write does not grow with the rounds before it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def at(self, spell: int) -> str:
        return f"{self.path}/spell-{spell}"

    def last(self) -> int | None:
        done = [int(n.removeprefix("spell-")) for n in io.folders(self.spark, self.path) if n.startswith("spell-") and io.exists(self.spark, f"{self.path}/{n}/model/meta/_SUCCESS")]
        return max(done, default=None)

    def write(self, spell: int, train: DataFrame, valid: DataFrame, model: Boosted, new: Sequence[Tree] = ()) -> tuple[DataFrame, DataFrame]:
        """``new``: the trees of this spell, the last ones of the model."""
        here = self.at(spell)
        for name, df in (("train", train), ("valid", valid)):
            df.write.mode("overwrite").parquet(f"{here}/{name}")
        if new:
            node_table(self.spark, replace(model, trees=tuple(new)), len(model.trees) - len(new)).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/trees-{spell}")
        _save_rest(self.spark, model, f"{here}/model")
        if spell:
            io.remove(self.spark, self.at(spell - 1))
        return self.rows(spell)

    def model(self, spell: int) -> Boosted:
        return load(self.spark, f"{self.at(spell)}/model", [f"{self.path}/trees-{k}" for k in range(1, spell + 1)])

    def write_train(self, spell: int, trees: int, train: DataFrame) -> DataFrame:
        """The training rows inside a spell, after ``trees`` of its trees (a fit that is stopped starts at the spell again)."""
        here = f"{self.at(spell)}/train-{trees}"
        train.write.mode("overwrite").parquet(here)
        for name in io.folders(self.spark, self.at(spell)):
            if name.startswith("train-") and name != f"train-{trees}":
                io.remove(self.spark, f"{self.at(spell)}/{name}")
        return self.spark.read.schema(_ROWS).parquet(here)

    def rows(self, spell: int) -> tuple[DataFrame, DataFrame]:
        return tuple(self.spark.read.schema(_ROWS).parquet(f"{self.at(spell)}/{n}") for n in ("train", "valid"))


def _with_margins(rows: DataFrame, trees: Sequence[Tree]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, y, bins, margin in _from_blocks(batches):
            yield _as_blocks(h, y, bins, raised(margin, bins, trees))

    return rows.mapInArrow(run, _ROWS)


def fit(features: Sequence[str], train: DataFrame, valid: DataFrame, key: str = "id", label: str = "flag", settings: Settings = PRIMARY, rounds: int | None = None, patience: int | None = None,
        metric: str = "auc", state: str | None = None, whole: int | None = None, borders: list[np.ndarray] | None = None, alone: int = 0) -> Boosted:
    """M6 / M7 with M8: boost on ``train``, measure ``metric`` (auc or logloss) on ``valid`` after every round, stop when ``patience`` rounds bring
    no better one, keep the trees up to the best. ``rounds`` and ``patience`` default to the settings' own; ``borders``: those of ``train``, if they are known.

    ``alone``: at most so many training rows, and validation rows, are boosted in one task, ``STRETCH`` rounds at a time.

    ``state``: a folder for the fit's tables (default: a new one under the shared work folder). If it holds a spell of an earlier
    fit with the same settings and features, the fit goes on from there; trees are never fitted twice. With no validation rows all rounds are kept."""
    spark = train.sparkSession
    settings = replace(settings, rounds=settings.rounds if rounds is None else rounds, patience=settings.patience if patience is None else patience)
    store = _State(spark, state or work_path(spark, "boosting"))
    spell, width, bins = store.last(), len(features), settings.borders + 1
    if spell is None:
        borders = quantile_borders(train, features, settings.borders) if borders is None else borders
        base = 0.0
        if settings.average:
            mean = train.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0
            base = math.log(mean / (1 - mean)) if 0 < mean < 1 else 0.0
        model = Boosted(tuple(features), tuple(tuple(b.tolist()) for b in borders), base, (), 0, (), metric, settings)
        spell = 0
        train_rows, valid_rows = store.write(0, _rows_table(train, features, borders, key, label, base), _rows_table(valid, features, borders, key, label, base), model)
    else:
        model = store.model(spell)
        if (model.features, replace(model.settings, rounds=0, patience=0), model.metric) != (tuple(features), replace(settings, rounds=0, patience=0), metric):
            raise ValueError(f"{store.path} holds a fit of other features, settings or metric")
        train_rows, valid_rows = store.rows(spell)
    n, tested = ((rows.select(F.sum(F.octet_length("y"))).first()[0] or 0) // 8 for rows in (train_rows, valid_rows))
    here = 0 < n <= alone and tested <= alone
    whole = max(WHOLE, min(MOST_WHOLE, n // WHOLE_SHARE)) if whole is None else whole
    trees, history = list(model.trees), list(model.history)
    validated = tested > 0
    best, spent = best_iteration(history, settings.patience, metric == "auc") if history else (len(trees), False)
    with io.settings(spark, _READING):
        while n and not spent and len(trees) < settings.rounds:
            new: list[Tree] = []
            rows, written = train_rows, 0  # the training rows with the margins of so many of the new trees
            last = min(settings.rounds, len(trees) + (STRETCH if here else SPELL))
            if here:
                new, values = stretch_here(rows, valid_rows, len(trees), last, history, width, bins, settings, metric)
            else:
                tasks = rows.rdd.getNumPartitions()
            for number in range(len(trees), last if not here else 0):
                now = Round(tuple(new[written:]), number, width, tuple(feature_sample(width, settings.features, number)), settings)
                new.append(symmetric_tree(rows, now, bins, tasks) if settings.symmetric else leafwise_tree(rows, n, now, bins, whole, tasks))
                if not settings.symmetric and len(new) - written == PENDING and number + 1 < last:
                    rows, written = store.write_train(spell, len(new), _with_margins(rows, new[written:])), len(new)
                    tasks = rows.rdd.getNumPartitions()
            if validated:
                history += values if here else staged_metric(valid_rows, new, metric)
            trees += new
            best, spent = best_iteration(history, settings.patience, metric == "auc") if validated else (len(trees), False)
            model = replace(model, trees=tuple(trees), trained=len(trees), history=tuple(history), settings=settings)
            spell += 1
            train_rows, valid_rows = store.write(spell, _with_margins(rows, new[written:]), _with_margins(valid_rows, new), model, new)
    return replace(model, trees=tuple(trees[:best]), trained=len(trees), history=tuple(history), settings=settings)
