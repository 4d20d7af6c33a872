"""A2: latency statistics per (regime, model), per regime, overall, per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.session import cut_lineage, stored


def weighted_medians(ranged: DataFrame, keys: list[str], col: str, out_col: str) -> DataFrame:
    """Median of ``col`` per ``keys`` from a histogram (keys.., col, n) in range
    partitions by value (``_pid``).

    The counts by partition tell in which partitions a group's middle ranks lie;
    only those are then looked into, so no task holds more of a group than one
    partition.  Even sizes average the two middle values, as SQL ``median`` does.
    """
    sums = ranged.groupBy(*keys, "_pid").agg(F.sum("n").alias("_m"))
    of = Window.partitionBy(*keys)
    upto = of.orderBy("_pid")
    sums = sums.withColumns({"_all": F.sum("_m").over(of), "_before": F.sum("_m").over(upto) - F.col("_m")})
    lo, hi = F.floor((F.col("_all") + 1) / 2), F.floor(F.col("_all") / 2) + 1
    inside = lambda r, before, n: (r > before) & (r <= before + n)
    at = sums.withColumns({"_lo": lo, "_hi": hi}) \
        .where(inside(F.col("_lo"), F.col("_before"), F.col("_m")) | inside(F.col("_hi"), F.col("_before"), F.col("_m"))) \
        .select(*keys, "_pid", "_before", "_lo", "_hi")
    rows = ranged.join(at, [*keys, "_pid"]).groupBy(*keys, "_pid", "_before", "_lo", "_hi", col).agg(F.sum("n").alias("n"))
    here = Window.partitionBy(*keys, "_pid").orderBy(col)
    before = F.col("_before") + F.sum("n").over(here) - F.col("n")
    rows = rows.withColumn("_b", before)
    pick = lambda r: F.max(F.when(inside(F.col(r), F.col("_b"), F.col("n")), F.col(col)))
    return rows.groupBy(*keys).agg(((pick("_lo") + pick("_hi")) / 2).alias(out_col))


def _histogram(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """Counts of each distinct value, map side first, in range partitions by value."""
    hist = df.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("n"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(hist.repartitionByRange(parts, col, *keys)).withColumn("_pid", F.spark_partition_id())


def exact_median(df: DataFrame, keys: list[str], col: str, out_col: str = "median") -> DataFrame:
    """Exact median of ``col`` per ``keys``; no group is gathered in one task."""
    return weighted_medians(_histogram(df, keys, col), keys, col, out_col)


def timing_summary(timings: DataFrame, by: str = "model", col: str = "seconds") -> DataFrame:
    """A2: count, mean, exact median, min, max, total seconds.

    ``by='model'``: one row per (regime, model) (``level='model'``), per
    regime (``level='regime'``, model null) and overall (``level='all'``).  All
    three come from one aggregation and one histogram: the sums of the upper
    levels are sums of the lower ones, their medians are read from the same
    partitions.  ``by='file'``: one row per (regime, file_name).
    """
    if by not in ("model", "file"):
        raise ValueError(by)
    second = "model" if by == "model" else "file_name"
    # no key is null inside: a null joins with nothing
    t = timings.select(*[F.coalesce(F.col(c), F.lit("\u0000")).alias(c) for c in ("regime", second)], F.col(col).alias("_v"))
    v = F.col("_v")
    base = stored(t.groupBy("regime", second).agg(F.count(v).alias("n_calls"), F.sum(v).alias("total_s"), F.min(v).alias("min_s"),
                                                  F.max(v).alias("max_s")), "timing-sums")
    hist = _histogram(t, ["regime", second], "_v").withColumn("_every", F.lit(""))
    back = lambda c: F.when(F.col(c) != "\u0000", F.col(c)).alias(c)
    stats = [(F.col("total_s") / F.col("n_calls")).alias("mean_s"), "median_s", "min_s", "max_s", "total_s"]
    if by == "file":
        out = base.join(weighted_medians(hist, ["regime", second], "_v", "median_s"), ["regime", second], "left")
        return out.select(back("regime"), back(second), "n_calls", *stats)
    out = None
    for level, keys in (("model", ["regime", "model"]), ("regime", ["regime"]), ("all", ["_every"])):
        rows = base.withColumn("_every", F.lit("")).groupBy(*keys).agg(
            F.sum("n_calls").alias("n_calls"), F.sum("total_s").alias("total_s"), F.min("min_s").alias("min_s"), F.max("max_s").alias("max_s"))
        rows = rows.join(weighted_medians(hist, keys, "_v", "median_s"), keys, "left")
        have = [back(c) if c in keys else F.lit(None).cast("string").alias(c) for c in ("regime", "model")]
        rows = rows.select(*have, F.lit(level).alias("level"), "n_calls", *stats)
        out = rows if out is None else out.unionByName(rows)
    return out
