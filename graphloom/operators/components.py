"""Weakly connected components of each graph (stronger form of J8).

The rounds grow with the logarithm of the nodes and there is no limit on them
(``operators.linking``); individuals without an edge are components of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.operators.linking import connected_components
from graphloom.operators.ontology import GRAPH


def components(canon: DataFrame, graph: list[str] | None = None) -> DataFrame:
    """-> (graph..., node, component) for every individual that is a subject
    or the object of an object-property edge; ``component`` is the smallest
    node name of its component."""
    graph = graph or GRAPH
    e = canon.where((F.col("o_kind") != "literal") & (F.col("p_canon") != "rdf:type")) \
        .select(*graph, F.col("s_key").alias("a"), F.col("o_key").alias("b"))
    # subjects without an edge are components of their own
    return connected_components(e, graph, canon.select(*graph, F.col("s_key").alias("node")))
