"""Operator 8: mixing sources to target weights by capped water-filling.

Sources share ``share`` of all words by weight; a source's target stops at
``epochs`` times its size, and what it cannot take is shared again among the
others in proportion to weight, until no target is above its cap.  Each round
is one aggregation over the sources' table that returns four numbers.

A source then takes whole repetitions of every document and, for the fraction
that remains, documents in seeded hash order until the target is met; the last
of them is repeated in part (its first words), so a source's taken words are
its target rounded down.  Where that order ends is found once per source: by
prefix sums over equal ranges of the hash, then inside the one range that holds
the end.  Documents only compare themselves with their source's end, so no row
is sorted or moved and a source holding a third of all rows is many tasks.

Defined results: a null source is a source of its own, last in order; a null or
empty text has no words and takes none; repeated rows at the end of the order
(same doc_id and size) share what is left evenly, rounded down; an empty table
gives no rows; further columns are kept by ``mix`` and ignored by ``plan_mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.common import SPACES, lookup, n_words, salts_for
from graphloom.operators.ranking import global_rank
from graphloom.session import cut_lineage, stored

WEIGHTS = (3, 1, 2)
#: Documents of one hash range, about.
RANGE_ROWS = 500_000


def water_fill(sources: DataFrame, total: float, epochs: float) -> DataFrame:
    """sources (source, source_size, weight) -> the same with target: the
    capped shares of ``total`` (never more than all caps together)."""
    cap = F.col("source_size") * F.lit(float(epochs))
    s = sources.withColumn("_full", F.lit(False))
    while True:
        # what the full sources leave, over the weight of the others
        r = s.agg(F.sum(F.when(F.col("_full"), F.col("source_size")).otherwise(0)).alias("full"),
                  F.sum(F.when(~F.col("_full"), F.col("weight")).otherwise(0)).alias("w"),
                  F.count_if("_full").alias("n")).first()
        if not r["w"]:
            return s.withColumn("target", cap).drop("_full")
        rest, w = float(total) - float(r["full"] or 0) * float(epochs), float(r["w"])
        share = F.lit(rest) * F.col("weight") / F.lit(w)
        s = s.withColumn("_full", F.col("_full") | (share > cap))
        if s.agg(F.count_if("_full")).first()[0] == r["n"]:
            return s.withColumn("target", F.when(F.col("_full"), cap).otherwise(share)).drop("_full")
        s = cut_lineage(s)


def seeded(seed: str, *cols: str) -> Column:
    """A reproducible random order: hex digits of a digest of the seed and the columns."""
    return F.md5(F.concat_ws(":", F.lit(seed), *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in cols)))


def _sized(docs: DataFrame, seed: str, *more: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").alias("_source"),
                       n_words(F.col("text")).alias("size"), seeded(seed, "doc_id").alias("_h"), *more)


def _ends(d: DataFrame, share: float, epochs: float, weights) -> DataFrame:
    """Per source: its size, target, whole repetitions, and the place in hash
    order (end) up to which documents are taken once more, with what the
    documents at that place take."""
    by = d.groupBy("_source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    # code point order is byte order of UTF-8; null last
    ranked = global_rank(by.withColumn("_null", F.col("_source").isNull()), ["_null", "_source"], "_k")
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.pmod(F.col("_k") - 1, F.lit(len(weights))) + 1).cast("int"))
    sources = cut_lineage(ranked.select("_source", "source_size", "_rows", weight.alias("weight")))
    words, rows = sources.agg(F.sum("source_size"), F.sum("_rows")).first()
    t = water_fill(sources, (words or 0) * float(share), epochs).select("_source", "source_size", "target")
    whole = F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0)).cast("long")
    t = t.withColumn("whole", whole).withColumn("extra", F.floor("target").cast("long") - F.col("whole") * F.col("source_size"))
    t = stored(t, "mix-targets")

    salts = salts_for(rows or 0, RANGE_ROWS)
    # the first 7 hex digits cut the hash into equal ranges
    cut = F.floor(F.conv(F.substring("_h", 1, 7), 16, 10).cast("long") * salts / F.lit(16 ** 7)).cast("long")
    d = d.withColumn("_range", cut)
    upto = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = d.groupBy("_source", "_range").agg(F.sum("size").alias("_n")).withColumn("_to", F.sum("_n").over(upto))
    key = t.select(F.col("_source").alias("_s"), "extra")
    ends = sums.join(key, F.col("_source").eqNullSafe(F.col("_s"))).where("_to - _n < extra and extra <= _to") \
        .select("_s", F.col("_range").alias("_r"), "extra", (F.col("_to") - F.col("_n")).alias("_before"))
    ends = stored(ends, "mix-ends")
    inside = d.join(ends, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_r"))) \
        .groupBy("_s", "extra", "_before", "_h", "doc_id", "size").agg(F.count(F.lit(1)).alias("_m"))
    place = Window.partitionBy("_s").orderBy("_h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("_at", F.col("_before") + F.sum(F.col("size") * F.col("_m")).over(place) - F.col("size") * F.col("_m"))
    end = inside.where("_at < extra and extra <= _at + size * _m") \
        .select("_s", F.struct("_h", F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "size").alias("end"),
                F.floor((F.col("extra") - F.col("_at")) / F.col("_m")).cast("long").alias("at_end"))
    out = t.join(end, F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s").withColumnRenamed("_source", "_s")
    return stored(out, "mix-plan")


def _taken(d: DataFrame, plan: DataFrame) -> DataFrame:
    """Join the plan to documents (with _source, _h, size): adds taken."""
    j = lookup(d, plan, F.col("_source").eqNullSafe(F.col("_s")), F.col("_h"))
    me = F.struct("_h", F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "size")
    once = F.when(F.col("end").isNull() | (me > F.col("end")), F.lit(0)).when(me < F.col("end"), F.col("size")).otherwise(F.col("at_end"))
    return j.withColumn("taken", (F.col("whole") * F.col("size") + once).cast("long"))


def plan_mix(docs: DataFrame, share: float = 1.5, epochs: float = 2.0, weights=WEIGHTS, seed: str = "mix-1") -> DataFrame:
    """-> doc_id, source, size, source_size, target, taken."""
    d = stored(_sized(docs, seed), "mix-docs")
    return _taken(d, _ends(d, share, epochs, weights)) \
        .select("doc_id", F.col("_source").alias("source"), "size", "source_size", "target", "taken")


def mix(docs: DataFrame, share: float = 1.5, epochs: float = 2.0, weights=WEIGHTS, seed: str = "mix-1") -> DataFrame:
    """The mix itself: each document as often as it is taken (whole
    repetitions, then the first words of a part), with the columns of
    ``docs``; ``n_chars`` follows the text.  Documents without words go once
    each: they cost nothing."""
    plan = _ends(stored(_sized(docs, seed), "mix-docs"), share, epochs, weights)
    p = _taken(_sized(docs.withColumn("_row", F.struct(*(F.col(f"`{c}`") for c in docs.columns))), seed, "_row"), plan)
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.nullif(F.col("size"), F.lit(0)))).otherwise(F.lit(1)).cast("int")
    part = F.when(F.col("size") > 0, F.col("taken") - whole * F.col("size")).otherwise(F.lit(0)).cast("int")
    text = F.col("_row.text")
    copies = F.concat(F.array_repeat(F.lit(0), whole), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>")))
    out = p.select("_row", F.explode(copies).alias("_part"))
    # the first words, with the space between them, up to the end of the last
    words = F.split(F.regexp_replace(text, r"^[\x20\x09-\x0D]+", ""), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    cut = F.rtrim(F.array_join(F.slice(words, 1, F.col("_part")), ""), F.lit(SPACES))
    new = F.when(F.col("_part") > 0, cut).otherwise(text)

    def column(c: str) -> Column:
        if c == "text":
            return new.alias(c)
        if c == "n_chars":
            return F.when(F.col("_part") > 0, F.length(cut)).otherwise(F.col("_row.n_chars")).cast(docs.schema[c].dataType).alias(c)
        return F.col(f"_row.`{c}`").alias(c)

    return out.select(*(column(c) for c in docs.columns))
