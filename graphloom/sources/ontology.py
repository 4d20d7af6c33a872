"""An OWL ontology in Turtle -> the ontology tables.

The file is read whole, parsed by the tolerant reader on an executor, and
split into tables with joins on the statements.  A class expression is a blank
node, possibly inside others (intersections, equivalences, list nodes): an
iterated join follows them from the class until a round reaches nothing new, and
``owl:onProperty`` / ``owl:someValuesFrom`` are taken from every node reached.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.session import local_table, stored

from graphloom import vocab
from graphloom.operators.ontology import Ontology
from graphloom.operators.turtle import parse_graphs, triples_of


#: Statements that lead from a class expression to one that holds of its members too.
INTO = ["rdfs:subClassOf", "owl:equivalentClass", "owl:intersectionOf", "rdf:first", "rdf:rest"]


def expression_nodes(t: DataFrame, start: str) -> DataFrame:
    """(file, term, bn): every blank node that the class expressions of a named
    term reach, from its ``start`` statements on.  A cycle of nodes adds nothing
    the second time, so it ends too."""
    blank = F.col("o").startswith("_:")
    links = stored(t.where(F.col("p").isin(INTO) & blank & F.col("s").startswith("_:")).select(
        "file", F.col("s").alias("bn"), F.col("o").alias("to")).distinct(), "expression-links")
    new = t.where((F.col("p") == start) & blank & ~F.col("s").startswith("_:")).select("file", F.col("s").alias("term"), F.col("o").alias("bn")).distinct()
    seen = new = stored(new, "expression-nodes")
    while not new.isEmpty():
        step = new.join(links, ["file", "bn"]).select("file", "term", F.col("to").alias("bn")).distinct()
        new = stored(step.join(seen, ["file", "term", "bn"], "left_anti"), "expression-nodes")
        seen = stored(seen.unionByName(new), "expression-nodes")
    return seen


def read_ontology(spark: SparkSession, path: str) -> Ontology:
    """A file, or a folder of files, with parts of one ontology; blank nodes
    belong to their file."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"),
                                                       F.col("value").alias("text"))
    t = triples_of(parse_graphs(raw, "text", ["file"])).select("file", "s", "p", "o", "o_kind", "o_lang")
    t = stored(t, "ontology-statements")
    loc = lambda c: F.regexp_replace(c, "^:", "")
    typed = t.where((F.col("p") == "rdf:type") & ~F.col("s").startswith("_:"))
    classes = typed.where(F.col("o") == "owl:Class").select(loc(F.col("s")).alias("name")).distinct()
    props = typed.where(F.col("o").isin("owl:ObjectProperty", "owl:DatatypeProperty")).select(
        loc(F.col("s")).alias("name"), F.when(F.col("o") == "owl:ObjectProperty", "object").otherwise("data").alias("kind"))
    named = ~F.col("o").startswith("_:") & ~F.col("s").startswith("_:")
    within = expression_nodes(t, "rdfs:subClassOf").unionByName(expression_nodes(t, "owl:equivalentClass")).distinct()
    # a named class inside an intersection is a superclass too
    inner = t.where(F.col("p").isin(INTO) & F.col("s").startswith("_:") & ~F.col("o").startswith("_:") & (F.col("o") != "rdf:nil")) \
        .select("file", F.col("s").alias("bn"), "o").join(within, ["file", "bn"]).select(loc(F.col("term")).alias("child"), loc(F.col("o")).alias("parent"))
    sub = t.where((F.col("p") == "rdfs:subClassOf") & named).select(loc(F.col("s")).alias("child"),
                                                                    loc(F.col("o")).alias("parent")).unionByName(inner).distinct()
    dom = t.where((F.col("p") == "rdfs:domain") & named).select(loc(F.col("s")).alias("property"),
                                                                loc(F.col("o")).alias("cls"))
    rng = t.where((F.col("p") == "rdfs:range") & named).select(loc(F.col("s")).alias("property"),
                                                               loc(F.col("o")).alias("rng"))
    bn_prop = t.where(F.col("p") == "owl:onProperty").select("file", F.col("s").alias("bn"), loc(F.col("o")).alias("property"))
    bn_fill = t.where(F.col("p") == "owl:someValuesFrom").select("file", F.col("s").alias("bn"), loc(F.col("o")).alias("filler"))
    res = within.join(bn_prop, ["file", "bn"]).join(bn_fill, ["file", "bn"]).select(loc(F.col("term")).alias("cls"), "property", "filler").distinct()
    labels = t.where(F.col("p").isin("skos:prefLabel", "skos:altLabel")).select(
        loc(F.col("s")).alias("term"), F.col("o").alias("label"), F.col("o_lang").alias("lang"),
        F.when(F.col("p") == "skos:prefLabel", "pref").otherwise("alt").alias("kind"))
    cls_tbl = classes.join(labels.where("kind = 'pref'").groupBy("term").agg(F.min("label").alias("pref_label")),
                           classes.name == F.col("term"), "left").drop("term") \
        .join(labels.where("kind = 'alt'").groupBy("term").agg(F.min(F.struct("label", "lang")).alias("a")),
              classes.name == F.col("term"), "left") \
        .select("name", "pref_label", F.col("a.label").alias("alt_label"), F.col("a.lang").alias("alt_lang"))
    aliases = local_table(spark, vocab.aliases(), "alias string, term string")
    return Ontology(cls_tbl, sub, props, dom, rng, res, labels, aliases)
