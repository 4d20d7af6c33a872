"""Exact global row numbers without a single-task window.

``Window.orderBy(...)`` with no partition moves every row into one task.
Here the rows are range-partitioned on the order (made unique by the id
columns), the partitioning is fixed by a reliable checkpoint, and each row's
number is the count of rows in earlier partitions (a table with one row per
partition, broadcast) plus its place inside its own partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.operators.skew import split_join
from graphloom.session import cut_lineage

_LOW33 = (1 << 33) - 1


def global_rank(df: DataFrame, order_cols: list, out_col: str = "rank", partitions: int | None = None) -> DataFrame:
    """Add ``out_col`` = 1-based position of the row in ``order_cols`` order.

    ``order_cols`` must end in a unique key so the order is total.  Scales with
    the data: no step holds more than one range partition, and the offset
    table has one row per partition.
    """
    spark = df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(df.repartitionByRange(n_parts, *order_cols))
    # Sorting inside the fixed partitions is deterministic, so the ids below
    # are the same in both branches that read them.
    local = ranged.sortWithinPartitions(*order_cols).withColumn("_mid", F.monotonically_increasing_id())
    local = local.withColumn("_pid", F.shiftrightunsigned("_mid", 33)) \
                 .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit(_LOW33)))
    counts = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid", "_n",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"),
        F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding,
                                                            Window.unboundedFollowing)).alias("_total"))
    # offsets has one row per range partition: a proven bound, safe to broadcast.
    out = local.join(F.broadcast(offsets), "_pid")
    return out.withColumn(out_col, F.col("_off") + F.col("_pos") + 1) \
              .withColumnRenamed("_total", f"{out_col}_total") \
              .drop("_mid", "_pid", "_pos", "_n", "_off")


def rank_within(df: DataFrame, group: list[str], order_cols: list, out_col: str = "rank") -> DataFrame:
    """Add ``out_col`` = 1-based position of the row in its group by
    ``order_cols``, without gathering a group: the global position less that of
    the group's first row.  Rows equal in all of them are interchangeable."""
    ranked = global_rank(df, [*group, *order_cols], "_g").drop("_g_total")
    first = ranked.groupBy(*group).agg(F.min("_g").alias("_first"))
    return split_join(ranked, first, group, "inner").withColumn(out_col, F.col("_g") - F.col("_first") + 1).drop("_g", "_first")
