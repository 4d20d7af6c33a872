"""Joins on keys of which a few may hold any share of the rows.

A mergeable frequent-items sketch (Spark's ``approx_top_k``) over the join key
names the keys that would fill a task of their own, in one pass and at most
``MOST`` of them.  In the join their rows are dealt over all tasks by a salt and
the other side's rows of just those keys are repeated for each salt; all other
keys are joined as ever.  This does not rest on adaptive execution.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.session import stored

#: Rows, at most, of a group that one task takes up whole.
WHOLE = 100_000
#: Hot keys that are looked for at once, and items that the sketch tracks: a key
#: of 1 / MOST of the rows is found for certain.
MOST, TRACKED = 1024, 16384


def key_hash(keys: list) -> Column:
    return F.xxhash64(*keys)


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_limit(rows: int, tasks: int) -> int:
    """Rows from which a key is hot: half of a task's even share, or the least
    that the sketch tells for certain."""
    return max(1, rows // (2 * tasks), rows // MOST)


def sketch_of(keys: list) -> Column:
    """Aggregate: the most frequent keys, as (item, count) of their hashes."""
    args = ", ".join(f"`{k}`" for k in keys)
    return F.expr(f"approx_top_k(xxhash64({args}), {MOST}, {TRACKED})")


def hot_keys(rows: DataFrame, *key_lists: list) -> list[list[int]]:
    """For each list of key columns the hashes of its hot keys, all in one pass."""
    r = rows.agg(F.count(F.lit(1)).alias("n"), *[sketch_of(k).alias(f"t{i}") for i, k in enumerate(key_lists)]).first()
    limit = hot_limit(r["n"], _tasks(rows))
    return [[x["item"] for x in r[f"t{i}"] or [] if x["count"] > limit] for i in range(len(key_lists))]


def split_join(big: DataFrame, small: DataFrame, keys: list, how: str, hot: list[int] | None = None) -> DataFrame:
    """``big.join(small, keys, how)`` for inner, left, left_semi and left_anti,
    with the hot keys of ``big`` (found here unless given) spread over all
    tasks.  ``small`` holds few rows for each key; those of hot keys are repeated."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(how)
    if hot is None:
        hot = hot_keys(big, keys)[0]
    if not hot:
        return big.join(small, keys, how)
    salts = _tasks(big)
    is_hot = key_hash(keys).isin(hot)
    salt = F.pmod(F.xxhash64(*[c for c, t in big.dtypes if not t.startswith("map")]), F.lit(salts))
    dealt = big.withColumn("_salt", F.when(is_hot, salt).otherwise(F.lit(0).cast("long")))
    every = F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))
    repeated = small.withColumn("_salt", F.explode(F.when(is_hot, every).otherwise(F.array(F.lit(0).cast("long")))))
    return dealt.join(repeated, [*keys, "_salt"], how).drop("_salt")


def by_size(rows: DataFrame, keys: list, most: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Rows of the groups that hold at most ``most`` (``WHOLE``) rows, and rows of
    larger ones, None if there are none.  A null key is a group like any other."""
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > (WHOLE if most is None else most))
    large = stored(sizes.select(*[F.col(k).alias(f"_large{i}") for i, k in enumerate(keys)]), "large-groups")
    if large.isEmpty():
        return rows, None
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_large{i}")) for i, k in enumerate(keys)])
    return rows.join(large, same, "left_anti"), rows.join(large, same, "left_semi")


def gathered(rows: DataFrame, keys: list, once: bool = False) -> DataFrame:
    """The same rows (``once``: without repeats), those of a group in one task: what
    is grouped or windowed by ``keys`` and more next moves no row again.  A key
    travels once for all rows that a task has of it.  Groups must be bounded (``by_size``)."""
    rest = F.struct(*[c for c in rows.columns if c not in keys])
    each = rows.groupBy(*keys).agg((F.collect_set if once else F.collect_list)(rest).alias("_rows"))
    return each.select(*keys, F.inline("_rows"))
