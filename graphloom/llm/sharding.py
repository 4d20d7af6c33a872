"""Operator 3: longest-processing-time sharding of groups that stay together.

Rows of one group (equal texts) share a shard.  Groups are the jobs, a group's
bytes its length: sorted by size, longest first, each goes to the least-loaded
shard through a heap.  What the heap sees is bounded: a group above 1/64 of a
mean shard is a job of its own (there are at most 64 per shard), all smaller
groups are dealt by hash into ``bundles`` jobs per shard.  No group is split and
no row is dropped; the same rule holds at every size.  Loads differ by at most
the largest job (a group that alone exceeds a mean shard cannot be balanced).

A row's slot is its place in its shard, gapless from 0: rows are numbered inside
(shard, salt of doc_id) cells and moved up by the prefix sum of the cells
before, so a shard or group holding a third of all rows is never one task.

Defined results: a null text has no bytes; null texts form one group of their
own, apart from the empty text's; a null doc_id is a row like any other;
repeated rows each get a slot; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.common import salts_for
from graphloom.session import local_table, stored

#: A group above mean shard / BIG is scheduled alone; small ones share BUNDLES jobs a shard.
BIG = 64
BUNDLES = 64
#: Rows that one numbering task sorts, about.
CELL_ROWS = 500_000


def schedule(jobs: list[tuple], shards: int) -> dict:
    """Longest processing time first.  jobs: (size, key) -> {key: shard}."""
    loads = [(0, s) for s in range(shards)]
    out = {}
    for size, key in sorted(jobs, key=lambda j: (-j[0], j[1])):
        load, s = heapq.heappop(loads)
        out[key] = s
        heapq.heappush(loads, (load + size, s))
    return out


def shard_documents(docs: DataFrame, shards: int, overhead: int = 16) -> DataFrame:
    """-> doc_id, size, text_crc32, shard, slot for every row of ``docs``."""
    spark = docs.sparkSession
    raw = F.encode(F.col("text"), "utf-8")
    slim = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + overhead).cast("long").alias("size"),
        F.crc32(raw).cast("long").alias("text_crc32"),
        # null texts: a key that no digest has
        F.coalesce(F.unhex(F.sha2(raw, 256)), F.lit(b"\x00")).alias("_group")), "shard-rows")
    total, rows = slim.agg(F.sum("size"), F.count(F.lit(1))).first()
    groups = slim.groupBy("_group").agg(F.sum("size").alias("_bytes"))
    alone = F.col("_bytes") * F.lit(shards * BIG) > F.lit(total or 0)
    bundle = F.pmod(F.xxhash64("_group"), F.lit(shards * BUNDLES))
    # jobs: at most shards * (BIG + BUNDLES) rows, whatever the data's size
    big = groups.where(alone).select("_group", "_bytes").collect()
    small = groups.where(~alone).groupBy(bundle.alias("b")).agg(F.sum("_bytes").alias("n")).collect()
    big_key = {bytes(r["_group"]).hex(): r["_bytes"] for r in big}
    to = schedule([*((n, f"g{k}") for k, n in big_key.items()), *((r["n"], f"b{r['b']}") for r in small)], shards)
    places = local_table(spark, [(k, s) for k, s in to.items()], "_job string, shard int")
    alone_keys = [k for k in big_key]
    hexed = F.lower(F.hex("_group"))
    is_big = hexed.isin(alone_keys) if alone_keys else F.lit(False)
    job = F.when(is_big, F.concat(F.lit("g"), hexed)).otherwise(F.concat(F.lit("b"), bundle.cast("string")))
    placed = slim.withColumn("_job", job).join(F.broadcast(places), "_job")

    salts = salts_for((rows or 0) // shards, CELL_ROWS)
    cells = placed.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
    counts = cells.groupBy("shard", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("shard", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("shard", "_salt").orderBy("doc_id", "_group")
    return cells.withColumn("_r", F.row_number().over(within) - 1).join(bases, ["shard", "_salt"]) \
        .select("doc_id", "size", "text_crc32", "shard", (F.col("_base") + F.col("_r")).cast("long").alias("slot"))
