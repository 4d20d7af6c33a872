"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Word characters of the contract: everything but space and \x09-\x0D.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """All words of a text; a null text has none."""
    flat = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " "))


def without(text: Column, chars: str) -> Column:
    """The text with every one of ``chars`` removed."""
    return F.translate(text, chars, "")


def n_words(text: Column) -> Column:
    """Number of words: starts of runs of non-space characters (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def salts_for(rows: int, per_task: int, least: int = 64) -> int:
    """How many salts keep a single key's share under ``per_task`` rows."""
    return max(least, -(-rows // per_task))


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row (a lambda
    variable; a plain reference would be inlined where it is used)."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Lookup tables up to this many rows (a few MB) are broadcast.
BROADCAST_ROWS = 50_000
SALTS = 64


def lookup(big: DataFrame, small: DataFrame, same: Column, spread: Column) -> DataFrame:
    """Left join of rows with a stored lookup table: broadcast where its counted
    rows allow, else by key and salt (``spread`` deals the rows), so that one
    common key is many tasks either way."""
    if small.count() <= BROADCAST_ROWS:
        return big.join(F.broadcast(small), same, "left")
    dealt = small.withColumn("_s2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return big.withColumn("_s1", F.pmod(F.xxhash64(spread), F.lit(SALTS))) \
        .join(dealt, same & (F.col("_s1") == F.col("_s2")), "left").drop("_s1", "_s2")
