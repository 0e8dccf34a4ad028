"""Small helpers shared by the operators of this package."""
from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path

BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
#: lower-cases A-Z and leaves every other byte, so UTF-8 text stays valid
LOWER = bytes.maketrans(_UPPER, _UPPER.lower())
#: the same, and ASCII punctuation becomes a space
LOWER_WORDS = bytes(ord(" ") if chr(b) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else LOWER[b] for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a lower-cased (A-Z) text: exactly what ``bytes.split()`` cuts at."""
    return text.translate(LOWER).split() if text else []


def in_fold(key: Column, modulus: int, remainder: int) -> Column:
    """True where crc32(key as text) mod ``modulus`` is ``remainder``. A null key belongs to the held-out fold."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % modulus == remainder, F.lit(True))


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared work folder and read again: cuts lineage and survives lost executors."""
    path = work_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """From now on the session hands Python at most ``BATCH_ROWS`` rows and ``BATCH_BYTES`` bytes at a time (unless it already has
    lower limits): with the defaults, 10,000 long texts would fill a task's memory several times over."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        now = int(spark.conf.get(f"spark.sql.execution.arrow.{name}").rstrip("bB"))
        if not 0 < now <= most:
            spark.conf.set(f"spark.sql.execution.arrow.{name}", str(most))


def arrays(column: pa.ChunkedArray, kind: type) -> list[np.ndarray]:
    """The values of a binary column as numpy arrays, without a copy."""
    return [np.frombuffer(v.as_buffer(), kind) for v in column]


def free_name(columns: Iterable[str], wanted: str) -> str:
    """``wanted``, with underscores appended until no column has that name (Spark names ignore case)."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def labelled_sample(spark: SparkSession, documents: DataFrame, marks: DataFrame, rows: int, seed: int, key: str, text: str) -> DataFrame:
    """(_k, _y, _t): about ``rows`` of the keys of ``marks`` (_k, _y: one row a key) that ``documents`` have, each with one text (binary).

    Keys are sampled after they are known to have rows, and a key's repeated rows come as one, so the result is bounded whatever
    the labels and the copies are."""
    keys = documents.select(F.col(key).alias("_k"))
    chosen = stored(spark, sampled(stored(spark, marks.join(keys, "_k", "left_semi"), "marks"), F.col("_k"), rows, seed), "chosen")
    texts = documents.select(F.col(key).alias("_d"), F.col(text).cast("binary").alias("_t"))
    found = texts.join(F.broadcast(chosen), F.col("_d") == F.col("_k"))  # about ``rows`` small rows
    return found.groupBy("_k", "_y").agg(F.min_by("_t", F.xxhash64(F.lit(seed), "_t")).alias("_t"))


def release_memory() -> None:
    """Gives the memory of arrays that are no longer used back to the system: the driver's Python shares its limit with the JVM."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not with every C library
        ctypes.CDLL(None).malloc_trim(0)


def sampled(df: DataFrame, on: Column, rows: int, seed: int) -> DataFrame:
    """About ``rows`` rows (all, if there are no more), by a seeded hash of ``on``: no shuffle, same rows every run.

    The only action is one count. The bound is on the expected number; the hash keeps it within a few
    standard deviations.
    """
    n = df.count()
    if n <= rows:
        return df
    cells = 1 << 40
    return df.where(F.pmod(F.xxhash64(F.lit(seed), on), F.lit(cells)) < int(cells * rows / n))
