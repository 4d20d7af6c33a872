"""Preparation of chat training rows (shuffle-take, split, length batches)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.operators.ranking import global_rank


def hash_order(id_col: str, seed: int) -> F.Column:
    """Seeded pseudo-random order key: md5 of "<seed>-<id>"."""
    return F.md5(F.concat(F.lit(f"{seed}-"), F.col(id_col).cast("string")))


def shuffle_take(df: DataFrame, id_col: str = "id", seed: int = 65, n: int = 143) -> DataFrame:
    """Seeded shuffle, then the first ``n`` rows, with their place ``pick``.

    A top-k (TakeOrderedAndProject): each partition keeps its ``n`` best rows,
    so only ``n`` x partitions rows ever meet in one task.
    """
    key = hash_order(id_col, seed)
    top = df.withColumn("_h", key).orderBy("_h", id_col).limit(n)
    # ``n`` rows at most: the feature's own bound.
    return top.withColumn("pick", F.row_number().over(Window.orderBy("_h", id_col))).drop("_h")


def _ranked(df: DataFrame, slim: DataFrame, order: list[str], id_col: str) -> DataFrame:
    """Rank the slim rows (id and order only, nothing else is stored) and join
    the rank back on the unique id."""
    r = global_rank(slim, order, out_col="_r").select(id_col, "_r", "_r_total")
    return df.join(r, id_col)


def train_test_split(df: DataFrame, id_col: str = "id", test_size: float = 0.1, seed: int = 65) -> DataFrame:
    """Exact split; the first ceil(test_size * n) rows in hash order are ``test``.

    Only (hash, id) is ranked, to find the last test row; every row is then
    compared with that one place, so no payload is shuffled or joined."""
    r = global_rank(df.select(id_col, hash_order(id_col, seed).alias("_h")), ["_h", id_col], out_col="_r")
    last = r.where(F.col("_r") == F.ceil(F.col("_r_total") * F.lit(test_size))).select("_h", id_col).first()
    if last is None:
        return df.withColumn("split", F.lit("train"))
    h = hash_order(id_col, seed)
    test = (h < last["_h"]) | ((h == last["_h"]) & (F.col(id_col) <= F.lit(last[id_col])))
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def length_batches(df: DataFrame, length_col: str, id_col: str = "id", size: int = 8) -> DataFrame:
    """Batches of ``size`` rows of similar length: rows ordered by
    (length, id), batch = position div size.  Hot lengths are split across
    range partitions by the id, so no length value lands in one task."""
    r = _ranked(df, df.select(*dict.fromkeys([id_col, length_col])), [length_col, id_col], id_col)
    return r.withColumn("batch_id", F.floor((F.col("_r") - 1) / size).cast("bigint")).drop("_r", "_r_total")
