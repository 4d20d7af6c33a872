"""A3 graph statistics, A4 graph merge, A7 entity view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.operators.conform import RDF_TYPE, individual_types
from graphloom.operators.ontology import GRAPH, Ontology
from graphloom.operators.skew import split_join
from graphloom.session import stored

TRIPLE_KEY = ["s", "p", "o", "o_kind", "o_datatype", "o_lang"]


def graph_stats(canon: DataFrame) -> DataFrame:
    """A3: statements, individuals, classes, properties, literals per graph.

    The statements are aggregated once, map side first, by (graph, subject,
    predicate, class of a type statement), and that is stored.  Every count is
    taken from those rows: sums directly, distinct values by one more level of
    grouping each, so no row is repeated for each count.
    """
    is_type = F.col("p_canon") == RDF_TYPE
    cls = F.when(is_type, F.coalesce("o_canon", "o_key"))
    pre = stored(canon.groupBy(*GRAPH, "s_key", "p_canon", cls.alias("cls")).agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("o_kind") == "literal").cast("int")).alias("lit"),
        F.sum(is_type.cast("int")).alias("types")), "graph-counts")

    def distinct(col: str, name: str) -> DataFrame:
        return pre.where(F.col(col).isNotNull()).select(*GRAPH, col).distinct().groupBy(*GRAPH).agg(F.count(F.lit(1)).alias(name))

    out = pre.groupBy(*GRAPH).agg(F.sum("n").alias("n_statements"), F.sum("lit").alias("n_literals"), F.sum("types").alias("n_type_assertions"))
    for col, name in (("s_key", "n_individuals"), ("cls", "n_classes"), ("p_canon", "n_properties")):
        out = out.join(distinct(col, name), GRAPH, "left")
    counts = ("n_individuals", "n_classes", "n_properties")
    return out.fillna(0, list(counts)).select(*GRAPH, "n_statements", *counts, "n_literals", "n_type_assertions")


def merge_graphs(triples: DataFrame, keys=("regime", "model", "doc_id")) -> DataFrame:
    """A4: one RDF set per (regime, model, doc) from several chunks or runs:
    duplicates dropped on the graph key and the full triple.  Idempotent."""
    cols = list(keys) + TRIPLE_KEY
    return triples.dropDuplicates(cols)


def entity_table(canon: DataFrame, onto: Ontology, cls: str, props: list[str]) -> DataFrame:
    """One row per individual of ``cls`` (inferred types) with one column
    per property in ``props``; repeated values joined with '|' in sorted order
    (for properties whose values fit a cell; ``entity_values`` is the long form).

    The pivot values come from the caller (the ontology), so Spark does not
    run an extra job to discover them.
    """
    members = individual_types(canon, onto).where(F.col("cls") == cls).select(*GRAPH, "s_key")
    vals = canon.withColumn("prop", F.regexp_replace("p_canon", "^:", "")) \
        .where(F.col("prop").isin(props)) \
        .withColumn("val", F.coalesce("o_key", "o"))
    joined = vals.join(members, [*GRAPH, "s_key"], "right")
    piv = joined.groupBy(*GRAPH, "s_key").pivot("prop", props).agg(
        F.array_join(F.array_sort(F.collect_list("val")), "|"))
    for p in props:
        piv = piv.withColumn(p, F.when(F.col(p) != "", F.col(p)))
    return piv


def entity_values(canon: DataFrame, onto: Ontology, cls: str, props: list[str]) -> DataFrame:
    """A7, long form: one row per value of a property in ``props`` of each
    individual of ``cls``, for individuals with any number of values; one with
    none has one row without property."""
    members = individual_types(canon, onto).where(F.col("cls") == cls).select(*GRAPH, "s_key")
    vals = canon.withColumn("prop", F.regexp_replace("p_canon", "^:", "")).where(F.col("prop").isin(props)) \
        .select(*GRAPH, "s_key", "prop", F.coalesce("o_key", "o").alias("val"))
    found = split_join(vals, members, [*GRAPH, "s_key"], "inner")
    bare = members.join(vals.select(*GRAPH, "s_key").distinct(), [*GRAPH, "s_key"], "left_anti")
    null = F.lit(None).cast("string")
    return found.unionByName(bare.withColumns({"prop": null, "val": null}))
