"""Scans and sinks.

Paths are anything Spark's readers accept (a shared file system or object store on a cluster). The row
count of a write is read back from what was written (for parquet the footers answer it), never by
computing the DataFrame a second time. (An ``Observation`` would count inside the write, but in Spark
4.1 it makes the session unserialisable inside fitted ML models that keep a training summary.)
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DoubleType, FloatType, IntegerType, LongType, ShortType,
                               StructField, StructType)


def read_parquet(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Parquet parts under ``path`` with their own schema; ``glob`` keeps matching file names only."""
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def register_views(tables: dict[str, DataFrame]) -> dict[str, str]:
    """Temp views for Spark SQL text (S8); returns the view name of each table."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return {name: name for name in tables}


def write_counted(df: DataFrame, path: str, n_parts: int | None = None, fmt: str = "parquet",
                  mode: str = "overwrite", **options) -> int:
    """Write ``df`` (optionally into ``n_parts`` files) and return the number of rows written."""
    out = df.repartition(n_parts) if n_parts else df
    out.write.mode(mode).options(**options).format(fmt).save(path)
    return df.sparkSession.read.options(**options).format(fmt).load(path).count()


#: rows that one task sorts and folds by key; with several sorts in a task about 1 KB of memory each
ROWS_A_TASK = 1 << 19


def parts_for(rows: int, least: int = 1) -> int:
    """The number of parts in which each holds about ``ROWS_A_TASK`` of ``rows``, at least ``least`` (and at most the buckets that a Spark table may have)."""
    return min(max(least, -(-rows // ROWS_A_TASK)), 100_000)


def spread(df: DataFrame, key: str, rows: int) -> DataFrame:
    """``df`` (of ``rows`` rows) dealt by ``key`` into as many parts as its rows ask for, so that what sorts, windows and groups by the key in a row needs no
    more memory a task as the table grows. A table of a few rows a core is left to adaptive execution, where that has as many partitions to begin with."""
    parts, spark = parts_for(rows), df.sparkSession
    return df.repartition(parts, key) if parts > min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))) else df


def write_bucketed(df: DataFrame, path: str, key: str, order: Sequence[str], buckets: int) -> DataFrame:
    """The canonical layer by key: ``df`` written under ``path`` in ``buckets`` hash buckets of ``key``, each sorted by ``order``, and read back.

    What groups, windows or joins by the key afterwards reads it in place, without an exchange. A bucket has one file per writing task unless rows
    are dealt by bucket first, as here; a bucket is read as one task, so choose ``buckets`` by the rows (``parts_for``)."""
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex[:12]}"
    (df.repartition(buckets, key).write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(*order).format("parquet").saveAsTable(name))
    return spark.table(name)


def ingest_parquet(spark: SparkSession, src: str, dst: str, n_parts: int | None = None,
                   glob: str | None = None) -> tuple[DataFrame, int]:
    """Copy parquet parts into the canonical layer; returns the copy and its rows. Without ``n_parts`` there is
    one file per scan task, so the file count follows the input's bytes."""
    rows = write_counted(read_parquet(spark, src, glob), dst, n_parts)
    return spark.read.parquet(dst), rows


def target_schema(key: str = "id", label: str | None = "flag", key_type=LongType()) -> StructType:
    fields = [StructField(key, key_type, False)]
    if label:
        fields.append(StructField(label, IntegerType(), False))
    return StructType(fields)


def read_target_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Target CSV with a declared schema (S2, S13). Unlike a positional load, the header must name the
    schema's columns (``enforceSchema=False``) and a value that does not parse fails the job (H8)."""
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False, mode="FAILFAST")


def ingest_target(spark: SparkSession, src_csv: str, dst: str, schema: StructType) -> tuple[DataFrame, int]:
    rows = write_counted(read_target_csv(spark, src_csv, schema), dst)
    return spark.read.parquet(dst), rows


def materialize(spark: SparkSession, df: DataFrame, path: str, n_parts: int | None = None,
                copy_path: str | None = None) -> tuple[DataFrame, int]:
    """Compute ``df`` once into ``path``; further copies and counts read the written table."""
    rows = write_counted(df, path, n_parts)
    out = spark.read.parquet(path)
    if copy_path:
        out.write.mode("overwrite").parquet(copy_path)
    return out, rows


NARROW_KEEP = ("id", "flag")


def compact_types(df: DataFrame, keep=NARROW_KEEP) -> DataFrame:
    """float64 -> float32, wider integers -> int32, except the ``keep`` columns (S15). Out-of-range values
    raise under ANSI, as the safe Arrow cast of the reference does (H10)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in keep:
            cols.append(c)
        elif isinstance(f.dataType, DoubleType):
            cols.append(c.cast(FloatType()).alias(f.name))
        elif isinstance(f.dataType, (LongType, IntegerType, ShortType, ByteType)):
            cols.append(c.cast(IntegerType()).alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


def write_submission_csv(df: DataFrame, path: str, key: str = "id") -> int:
    """Submission sink (S12, O2): header ``id,score``, rows in key order. The sort is a range shuffle, and
    the part files are written in range order."""
    return write_counted(df.orderBy(key), path, fmt="csv", header=True)


def read_submission_csv(spark: SparkSession, path: str) -> DataFrame:
    """Submission scan for the gates (S13): columns as written in the header, values parsed leniently.
    An empty field becomes NULL, 'NaN' becomes NaN and text in ``id`` becomes NULL (counted by the gates)."""
    raw = spark.read.csv(path, header=True, inferSchema=False, mode="PERMISSIVE")
    cols = []
    for c in raw.columns:
        if c == "id":
            cols.append(F.expr("try_cast(id AS BIGINT)").alias("id"))
        elif c == "score":
            cols.append(F.expr("try_cast(score AS DOUBLE)").alias("score"))
        else:
            cols.append(F.col(c))
    return raw.select(*cols)


def write_predictions(df: DataFrame, path: str, key: str = "id") -> int:
    """Prediction sink (S9): (id, y_true, y_score)."""
    return write_counted(df.select(key, "y_true", "y_score"), path)


def write_report(df: DataFrame, path: str) -> dict:
    """JSON report sink (S10): the one row of a report as a JSON object, nested values as structs and arrays;
    returns it as a dict. The report is computed once: the row that was fetched is what is written."""
    row = report_dict(df)
    df.sparkSession.createDataFrame([tuple(row[c] for c in df.columns)], df.schema).coalesce(1).write.mode("overwrite").json(path)
    return row


def read_report(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """JSON report scan."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def report_dict(df: DataFrame) -> dict:
    """A one-row report as a Python dict, for printing; the only collect in the library's reports."""
    rows = df.limit(2).collect()
    if len(rows) != 1:
        raise ValueError("a report has exactly one row")
    return rows[0].asDict(recursive=True)


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """The session with ``values`` set for the jobs inside, and as it was after them."""
    before = {k: spark.conf.get(k) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _folder(spark: SparkSession, path: str):
    """The file system that holds ``path``, whatever it is, and the path on it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _folder(spark, path)
    return fs.exists(p)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders under ``path`` (none, if it does not exist)."""
    fs, p = _folder(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory()] if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    """Removes a table that this library wrote and no DataFrame reads any more."""
    fs, p = _folder(spark, path)
    fs.delete(p, True)
