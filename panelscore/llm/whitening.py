"""Embedding whitening with MLlib's distributed block matrices.

Entries become whole numbers x = floor(``scale`` * c). The fit list holds every distinct x vector once. Tasks pack it into blocks
of at most ``block_rows`` rows, a table with one row per block, so that no row of the matrix is shuffled on its own.

1. The blocks, centred by the exact means S / n, are a tall ``BlockMatrix`` of one block column. Its transpose times itself is the
   scatter; the middle dimension of that product is split over tasks (``numMidDimSplits``), else one task would get all blocks.
2. The covariance (divisor n) is decomposed on the driver by ``numpy.linalg.eigh``: a matrix of dimensions x dimensions.
3. The same blocks, laid out as a square grid, times a block diagonal of the whitening matrix project every row. The grid is
   what lets MLlib's grid partitioner use all tasks; a tall matrix would get the square root of their number.
4. Projected blocks meet their x vectors by block number. Input rows find their vector's result by an equi-join on x; a vector with over
   ``HOT`` copies and a thousandth of all rows (so at most 1,000 such vectors) is broadcast, so copies are no hot key.

Scale: the driver holds the scatter matrix and, inside MLlib, the coordinates of the blocks. MLlib's products shuffle the
centred blocks as doubles: twice for the scatter, once for the projection.

Defined results: rows whose vector is null or holds null, NaN or infinite entries are dropped; shorter vectors are filled up with x = 0 to the longest
one's dimensions, empty ones too; repeated rows and null or repeated keys keep their rows, and copies of a vector count once in the fit; entries beyond
a long's range take its limits. ``deviation`` is null where it does not fit a long. Equal eigenvalues (ties) may have any orthogonal
components, the same for all rows; of the two signs a component has that with its largest entry positive. A component without variance (eigenvalue zero
to double precision) has no whitened value: null; ``explained`` is null if there is no variance at all, ``identity_error`` if no component has any. An empty
table, or none but dropped rows or empty vectors, gives an empty result. Only key and vector are read, so further columns may have any name; the key is
returned as ``vec_id``.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, stored, table

SCALE, COMPONENTS = 256, 4
BLOCK_BYTES, BLOCK_ROWS = 4 << 20, 4096
BLOCKS_A_TASK = 8
HOT = 100_000

_VALUES = pa.list_(pa.float64())
#: Spark's own layout of a matrix value
_MATRIX = pa.struct([("type", pa.int8()), ("numRows", pa.int32()), ("numCols", pa.int32()), ("colPtrs", pa.list_(pa.int32())), ("rowIndices", pa.list_(pa.int32())), ("values", _VALUES),
                     ("isTransposed", pa.bool_())])
_PLACE = pa.struct([("i", pa.int64()), ("j", pa.int64())])
_BLOCK_SCHEMA = T.StructType([T.StructField("place", T.StructType([T.StructField("i", T.LongType()), T.StructField("j", T.LongType())])), T.StructField("m", MatrixUDT())])


def vectors_of(df: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(k, x) of the rows that remain."""
    v = F.col(vector).cast("array<double>")
    fine = F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return df.select(F.col(key).alias("k"), v.alias("v")).where(fine).select("k", F.transform("v", lambda c: F.floor(c * scale)).alias("x"))


def _packed(dims: int, rows: int):
    """(x, copies) to blocks (task, no, n, x: the rows as 64-bit whole numbers, copies)."""
    def block(no: int, x: np.ndarray, copies: np.ndarray) -> pa.RecordBatch:
        from pyspark import TaskContext
        return pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([no], pa.int64()), pa.array([len(x)], pa.int64()),
                                           pa.array([x.tobytes()], pa.binary()), pa.array([copies.tobytes()], pa.binary())], ["task", "no", "n", "x", "copies"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no, held, waiting = 0, 0, []
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            copies = batch.column(1).to_numpy(zero_copy_only=False)
            waiting.append((x, copies))
            held += len(x)
            while held >= rows:
                x, copies = (np.concatenate([w[k] for w in waiting]) for k in (0, 1))
                yield block(no, x[:rows], copies[:rows])
                no, held, waiting = no + 1, held - rows, [(x[rows:], copies[rows:])]
        if held:
            yield block(no, *(np.concatenate([w[k] for w in waiting]) for k in (0, 1)))

    return pack


def fit_blocks(spark: SparkSession, vectors: DataFrame, dims: int, rows: int) -> DataFrame:
    """The fit list as blocks (block: 0, 1, ...; n, x, copies), written once."""
    distinct = vectors.groupBy("x").agg(F.count(F.lit(1)).alias("copies"))
    packed = stored(spark, distinct.mapInArrow(_packed(dims, rows), "task long, no long, n long, x binary, copies binary"), "fit-blocks")
    # one row per task
    before, offsets = 0, []
    for r in packed.groupBy("task").agg(F.count(F.lit(1)).alias("blocks")).orderBy("task").collect():
        offsets.append((r["task"], before))
        before += r["blocks"]
    first = spark.createDataFrame(offsets, "task long, first long")
    return packed.join(F.broadcast(first), "task").select((F.col("first") + F.col("no")).alias("block"), "n", "x", "copies")


def column_sums(blocks: DataFrame, dims: int) -> tuple[int, list[int]]:
    """n and the exact sums S: halves of 32 bits are summed in a block, so nothing overflows."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = np.frombuffer(raw.as_buffer(), np.int64).reshape(-1, dims)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(np.full(dims, n)), pa.array((x >> 32).sum(axis=0)), pa.array((x & 0xFFFFFFFF).sum(axis=0))], ["dim", "n", "high", "low"])

    wide = lambda c: F.sum(F.col(c).cast("decimal(20,0)")).alias(c)
    rows = blocks.select("n", "x").mapInArrow(add, "dim long, n long, high long, low long").groupBy("dim").agg(F.sum("n").alias("n"), wide("high"), wide("low")).orderBy("dim").collect()
    return (rows[0]["n"] if rows else 0), [(int(r["high"]) << 32) + int(r["low"]) for r in rows]


def _mean(sums: list[int], n: int) -> np.ndarray:
    return np.array([s / n for s in sums])  # a quotient of whole numbers, rounded once


def centred(spark: SparkSession, blocks: DataFrame, dims: int, rows: int, mean: np.ndarray, across: int, down: int) -> BlockMatrix:
    """The centred rows as a block matrix; block b lies at (b div across, b mod across). Short blocks are filled up with rows of zeros."""
    def centre(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = np.frombuffer(raw.as_buffer(), np.int64).reshape(-1, dims)
                full = np.zeros((rows, dims))
                full[:len(x)] = x - mean
                values = pa.ListArray.from_arrays(pa.array([0, rows * dims], pa.int32()), pa.array(full.ravel()))
                none = pa.nulls(1, pa.list_(pa.int32()))
                matrix = pa.StructArray.from_arrays([pa.array([1], pa.int8()), pa.array([rows], pa.int32()), pa.array([dims], pa.int32()), none, none, values, pa.array([True])], fields=list(_MATRIX))
                place = pa.StructArray.from_arrays([pa.array([b // across]), pa.array([b % across])], fields=list(_PLACE))
                yield pa.RecordBatch.from_arrays([place, matrix], ["place", "m"])

    frame = blocks.select("block", "x").mapInArrow(centre, _BLOCK_SCHEMA)
    java = callMLlibFunc("createBlockMatrix", frame, rows, dims, rows * down, dims * across)
    return BlockMatrix(java, rows, dims)


def scatter(tall: BlockMatrix, blocks: int) -> np.ndarray:
    """The transpose times the matrix, the middle dimension split over tasks."""
    other = tall._java_matrix_wrapper._java_model
    java = tall.transpose()._java_matrix_wrapper.call("multiply", other, max(1, math.ceil(blocks / BLOCKS_A_TASK)))
    return BlockMatrix(java, tall.colsPerBlock, tall.colsPerBlock).toLocalMatrix().toArray()


class Whitening(NamedTuple):
    """What is learnt: n, S, the first components' eigenvalues with the trace, and the matrix that projects centred rows."""
    n: int
    sums: list[int]
    values: np.ndarray
    trace: float
    matrix: np.ndarray
    alive: np.ndarray


def decomposed(n: int, sums: list[int], scattered: np.ndarray, components: int) -> Whitening:
    cov = (scattered + scattered.T) / (2 * n)
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))] < 0, -1, 1)
    values, vectors = np.maximum(values[:components], 0), vectors[:, :components]
    alive = values > len(cov) * np.finfo(float).eps * max(values[0], 0)
    matrix = np.where(alive, vectors / np.sqrt(np.where(alive, values, 1)), 0)
    return Whitening(n, sums, values, float(np.trace(cov)), matrix, alive)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact; None where it does not fit a long.

    Whole numbers wrap around modulo 2^64, so a sum below 2^63 comes out right whatever its parts do; a float tells which
    sums are below, and doubtful ones are added up as Python numbers."""
    size = (n * x.astype(float) - np.array([float(s) for s in sums])) ** 2
    size = size.sum(axis=1)
    with np.errstate(over="ignore"):
        part = x.astype(np.uint64) * np.uint64(n % (1 << 64)) - np.array([s % (1 << 64) for s in sums], np.uint64)
        exact = (part * part).sum(axis=1, dtype=np.uint64).view(np.int64)
    out: list[int | None] = exact.tolist()
    for i in np.nonzero(size >= 2.0 ** 62)[0]:
        value = sum((n * int(c) - s) ** 2 for c, s in zip(x[i], sums))
        out[i] = value if value < 1 << 63 else None
    return out


def projected(spark: SparkSession, blocks: DataFrame, count: int, dims: int, rows: int, w: Whitening) -> DataFrame:
    """(x, copies, deviation, z) of every vector of the fit list; z: its values on the components."""
    k = w.matrix.shape[1]
    across = math.ceil(math.sqrt(count))
    down = math.ceil(count / across)
    grid = centred(spark, blocks, dims, rows, _mean(w.sums, w.n), across, down)
    flat = w.matrix.ravel(order="F").tolist()
    diagonal = BlockMatrix(spark.sparkContext.parallelize(range(across), min(across, 64)).map(lambda i: ((i, i), Matrices.dense(dims, k, flat))), dims, k, dims * across, k * across)
    product = callMLlibFunc("getMatrixBlocks", grid.multiply(diagonal)._java_matrix_wrapper._java_model)
    place, matrix = (F.col(c) for c in product.columns)
    z = product.select((place["_1"] * across + place["_2"]).alias("block"), F.unwrap_udt(matrix).alias("m")).select("block", "m.values", "m.isTransposed")
    n, sums = w.n, w.sums

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, copies, values, transposed in zip(batch.column(0), batch.column(1), batch.column(2), batch.column(3).to_pylist()):
                x = np.frombuffer(raw.as_buffer(), np.int64).reshape(-1, dims)
                v = values.values.to_numpy()
                v = (v.reshape(rows, k) if transposed else v.reshape(k, rows).T)[:len(x)]
                for i in range(0, len(x), 1000):
                    part = x[i:i + 1000]
                    listed = lambda a: pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1, dtype=np.int32) * a.shape[1]), pa.array(a.ravel()))
                    yield pa.RecordBatch.from_arrays([listed(part), pa.array(np.frombuffer(copies.as_buffer(), np.int64)[i:i + 1000]), pa.array(deviations(part, n, sums), pa.int64()), listed(v[i:i + 1000])],
                                                     ["x", "copies", "deviation", "z"])

    both = blocks.join(z, "block").select("x", "copies", "values", "isTransposed")
    return both.mapInArrow(unpack, "x array<long>, copies long, deviation long, z array<double>")


def identity_error(fit: DataFrame, w: Whitening) -> float | None:
    """The largest absolute entry of the projected fit list's covariance minus the identity."""
    at = [i for i, a in enumerate(w.alive) if a]
    if not at:
        return None
    z = [F.col("z")[i] for i in at]
    mean = fit.agg(*[F.avg(c) for c in z]).first()
    entries = [F.avg((z[i] - mean[i]) * (z[j] - mean[j])) - float(i == j) for i in range(len(at)) for j in range(i, len(at))]
    return max(abs(e) for e in fit.agg(*entries).first())


_RESULT = "vec_id {0}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(spark: SparkSession, embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, block_rows: int = BLOCK_ROWS,
             hot: int = HOT) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every remaining row and component."""
    bounded_batches(spark)
    vectors = vectors_of(embeddings, key, vector, scale)
    kind = vectors.schema["k"].dataType.simpleString()
    total, dims = vectors.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    if not dims:
        return spark.createDataFrame([], _RESULT.format(kind))
    vectors = vectors.withColumn("x", F.when(F.size("x") < dims, F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("x")))).otherwise(F.col("x")))
    rows = max(1, min(block_rows, BLOCK_BYTES // (8 * dims)))
    blocks = fit_blocks(spark, vectors, dims, rows)
    count = blocks.count()
    n, sums = column_sums(blocks, dims)
    w = decomposed(n, sums, scatter(centred(spark, blocks, dims, rows, _mean(sums, n), 1, count), count), min(components, dims))
    fit = stored(spark, projected(spark, blocks, count, dims, rows, w), "projected")
    error = identity_error(fit, w)
    # over ``hot`` copies and over a thousandth of the rows: at most 1,000 vectors
    is_hot = F.col("copies") > max(hot, total // 1000)
    found = vectors.join(F.broadcast(fit.where(is_hot).select("x", F.struct("deviation", "z").alias("r"))), "x", "left")
    rest = found.where(F.col("r").isNull()).select("x", "k").join(fit.where(~is_hot).select("x", "deviation", "z"), "x").select("k", "deviation", "z")
    every = found.where(F.col("r").isNotNull()).select("k", "r.deviation", "r.z").unionByName(rest)
    each = F.explode(F.array(*[F.struct(F.lit(i + 1).alias("component"), (F.col("z")[i] if w.alive[i] else F.lit(None).cast("double")).alias("whitened"),
                                        F.lit(float(w.values[i] / w.trace) if w.trace > 0 else None).cast("double").alias("explained")) for i in range(len(w.values))]))
    return every.select("k", "deviation", each.alias("c")).select(F.col("k").alias("vec_id"), "c.component", F.lit(n).cast("long").alias("n"), "deviation", "c.whitened", "c.explained",
                                                                  F.lit(error).cast("double").alias("identity_error"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(spark, table(spark, sf_dir, "embeddings"))
