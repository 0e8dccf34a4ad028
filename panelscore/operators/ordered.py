"""Order-dependent primitives without a single-partition window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row to one task. These two helpers give the
same results with the work spread over range-partitioned tasks; only a table of one row per
partition (a proven, configured bound) is broadcast.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def _by_range(df: DataFrame, cols: list[str], n: int | None) -> DataFrame:
    """Range partitioning; without ``n`` adaptive execution may merge neighbouring ranges, which keeps the
    partitions contiguous and in order."""
    return df.repartitionByRange(n, *cols) if n else df.repartitionByRange(*cols)


def with_global_rank(df: DataFrame, order_cols: list[str], out: str = "rank",
                     partitions: int | None = None, keep: list[str] | None = None) -> DataFrame:
    """``row_number() over (order by order_cols)`` computed in parallel.

    Range partitioning splits even a single hot leading key over several tasks. Inside a partition the
    position comes from ``monotonically_increasing_id`` (row index in the lower 33 bits) after a local
    sort; partition offsets come from one count per partition. The partitioned table is checkpointed so
    that the counts and the positions come from the same assignment of rows, even after a lost executor.
    ``order_cols`` must be a total order (unique tuples) for the rank to be deterministic. ``keep`` lists
    the columns to return (default: all); the others are dropped before the checkpoint is written.
    """
    checkpoint_dir(df.sparkSession)
    cols = list(keep) if keep is not None else df.columns
    placed = (_by_range(df, order_cols, partitions)
              .sortWithinPartitions(*order_cols)
              .withColumn("_part", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id()
                          - F.shiftleft(F.col("_part").cast("long"), 33))
              .select(*cols, "_part", "_pos")
              .checkpoint())
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (placed.join(F.broadcast(offsets), "_part")
            .select(*cols, (F.col("_off") + F.col("_pos") + 1).alias(out)))


def running_totals(df: DataFrame, order_col: str, sum_cols: list[str], descending: bool = True,
                   prefix: str = "cum_", partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``sum_cols`` along ``order_col``, which must be unique and not null.

    Rows are range-partitioned by ``order_col`` (Spark samples the bounds; they only affect balance, never the
    result) and checkpointed with their range's number, so that totals and sums see the same assignment even after a
    lost executor. Each range is summed by a window of its own and shifted by the total of the ranges before
    it: one row per range is all that meets in one place.
    """
    checkpoint_dir(df.sparkSession)
    direction = F.col(order_col).desc() if descending else F.col(order_col).asc()
    ranged = df.repartitionByRange(partitions, direction) if partitions else df.repartitionByRange(direction)
    placed = ranged.withColumn("_range", F.spark_partition_id()).checkpoint()
    inside = Window.partitionBy("_range").orderBy(direction).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = placed.select("*", *[F.sum(c).over(inside).alias(f"_loc_{c}") for c in sum_cols])
    totals = placed.groupBy("_range").agg(*[F.sum(c).alias(f"_tot_{c}") for c in sum_cols])
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", *[F.coalesce(F.sum(f"_tot_{c}").over(earlier), F.lit(0))
                                        .alias(f"_off_{c}") for c in sum_cols])
    return (local.join(F.broadcast(offsets), "_range")  # one row per partition
            .select(*df.columns, *[(F.col(f"_loc_{c}") + F.col(f"_off_{c}")).alias(prefix + c)
                                   for c in sum_cols]))
