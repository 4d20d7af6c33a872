"""Ontology as data: tables (S2 default), subclass closure and type inference
(J10), vocabulary drift (J11), rendered description (N17).

The built-in tables are local relations of a few hundred rows; joins with them
carry no hint, so that an ontology read from a file is judged by its own size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom import vocab
from graphloom.session import cut_lineage, local_table

GRAPH = ["run_id", "regime", "model", "doc_id"]


@dataclass
class Ontology:
    classes: DataFrame      # name, pref_label, alt_label, alt_lang
    subclass: DataFrame     # child, parent
    properties: DataFrame   # name, kind (object|data)
    domain: DataFrame       # property, cls
    range: DataFrame        # property, rng
    restriction: DataFrame  # cls, property, filler
    labels: DataFrame       # term, label, lang, kind (pref|alt)
    aliases: DataFrame      # alias, term
    # For the built-in ontology: the same facts as Python rows, so that small
    # derived tables (closure, lookups) are literal tables, not Spark jobs.
    fixed: dict | None = None


def builtin_ontology(spark: SparkSession) -> Ontology:
    """The ontology of ``vocab`` as DataFrames."""
    cls = vocab.classes()
    props = vocab.properties()
    c = local_table(spark, [(n, p, a or None, l or None) for n, _, p, a, l in cls],
                              "name string, pref_label string, alt_label string, alt_lang string")
    sub = local_table(spark, [(n, p) for n, ps, *_ in cls for p in ps], "child string, parent string")
    pr = local_table(spark, [(n, k) for n, k, _, _ in props], "name string, kind string")
    dom = local_table(spark, [(n, d) for n, _, ds, _ in props for d in ds], "property string, cls string")
    rng = local_table(spark, [(n, r) for n, _, _, rs in props for r in rs], "property string, rng string")
    res = local_table(spark, vocab.restrictions(), "cls string, property string, filler string")
    labels = local_table(spark, vocab.labels(), "term string, label string, lang string, kind string")
    al = local_table(spark, vocab.aliases(), "alias string, term string")
    fixed = {"classes": [n for n, *_ in cls], "properties": [(n, k) for n, k, _, _ in props],
             "subclass": [(n, p) for n, ps, *_ in cls for p in ps], "aliases": vocab.aliases()}
    return Ontology(c, sub, pr, dom, rng, res, labels, al, fixed)


def _closure_rows(edges: list[tuple[str, str]]) -> list[tuple[str, str, int]]:
    """Shortest-path strict ancestors of a fixed (ontology-sized) edge list."""
    parents: dict[str, set[str]] = {}
    for c, p in edges:
        parents.setdefault(c, set()).add(p)
    out = []
    for child in sorted(parents):
        seen, frontier, depth = {}, set(parents[child]), 1
        while frontier:
            nxt = set()
            for a in sorted(frontier):
                if a not in seen:
                    seen[a] = depth
                    nxt |= parents.get(a, set())
            frontier, depth = nxt, depth + 1
        out += [(child, a, d) for a, d in sorted(seen.items())]
    return out


def subclass_closure(onto: Ontology, reflexive: bool = False) -> DataFrame:
    """(child, ancestor, depth) for every strict ancestor (depth = shortest path).

    A loop of joins on the edge table until a round adds nothing; a cycle
    adds its members once and then nothing, so it ends too.
    """
    if onto.fixed is not None:
        spark = onto.classes.sparkSession
        rows = _closure_rows(onto.fixed["subclass"])
        if reflexive:
            rows += [(n, n, 0) for n in onto.fixed["classes"]]
        return local_table(spark, rows, "child string, ancestor string, depth int")
    edges = onto.subclass.select("child", F.col("parent").alias("ancestor")).distinct()
    closure = edges.withColumn("depth", F.lit(1))
    size = closure.count()
    while True:
        step = closure.alias("c").join(edges.alias("e"), F.col("c.ancestor") == F.col("e.child")) \
            .select(F.col("c.child"), F.col("e.ancestor"), (F.col("c.depth") + 1).alias("depth"))
        closure = closure.unionByName(step).groupBy("child", "ancestor").agg(F.min("depth").alias("depth"))
        closure = cut_lineage(closure)
        n = closure.count()
        if n == size:
            break
        size = n
    if reflexive:
        names = onto.classes.select(F.col("name").alias("child"), F.col("name").alias("ancestor"),
                                    F.lit(0).alias("depth"))
        closure = closure.unionByName(names)
    return closure


def infer_types(typed: DataFrame, closure: DataFrame, cls_col: str = "cls") -> DataFrame:
    """Asserted types (graph cols, s, cls) widened by the reflexive closure."""
    keys = [c for c in typed.columns if c != cls_col]
    t = typed.join(closure.select(F.col("child").alias(cls_col), "ancestor"), cls_col)
    return t.select(*keys, F.col("ancestor").alias(cls_col)).distinct()


def vocab_drift(a: DataFrame, b: DataFrame, term_col: str = "term") -> DataFrame:
    """Compare two term lists: status both / only_a / only_b, plus the
    case-insensitive partner of a one-sided term when there is one."""
    la = a.select(F.col(term_col).alias("term")).distinct().withColumn("in_a", F.lit(True))
    lb = b.select(F.col(term_col).alias("term")).distinct().withColumn("in_b", F.lit(True))
    j = la.join(lb, "term", "full_outer").fillna(False, ["in_a", "in_b"])
    status = F.when(F.col("in_a") & F.col("in_b"), "both").when(F.col("in_a"), "only_a").otherwise("only_b")
    j = j.withColumn("status", status)
    other_b = lb.select(F.lower("term").alias("lt"), F.col("term").alias("b_term"))
    other_a = la.select(F.lower("term").alias("lt"), F.col("term").alias("a_term"))
    ci_b = j.where("status = 'only_a'").join(other_b, F.lower(j.term) == other_b.lt, "left") \
        .groupBy("term").agg(F.min("b_term").alias("ci_match"))
    ci_a = j.where("status = 'only_b'").join(other_a, F.lower(j.term) == other_a.lt, "left") \
        .groupBy("term").agg(F.min("a_term").alias("ci_match"))
    return j.join(ci_b.unionByName(ci_a), "term", "left").select("term", "status", "ci_match")


def ontology_terms(onto: Ontology) -> DataFrame:
    return onto.classes.select(F.col("name").alias("term"), F.lit("class").alias("kind")).unionByName(
        onto.properties.select(F.col("name").alias("term"), F.col("kind")))


def describe_ontology(onto: Ontology, classes: DataFrame | None = None, props: DataFrame | None = None) -> DataFrame:
    """The ontology description block rendered from the tables (one row).

    ``classes`` / ``props`` (one ``name`` column each) restrict the block to
    the terms a prompt should mention; by default the whole ontology.  Lines
    are sorted by name: ``- "cls": subclass of a, b`` and
    ``- "prop": domain1|domain2 -> range``.  The tables are ontology-sized.
    """
    cls = onto.classes.select("name")
    if classes is not None:
        cls = cls.join(classes.select("name").distinct(), "name", "left_semi")
    pr = onto.properties
    if props is not None:
        pr = pr.join(props.select("name").distinct(), "name", "left_semi")
    par = onto.subclass.groupBy("child").agg(F.array_join(F.array_sort(F.collect_list("parent")), ", ").alias("ps"))
    cls_lines = cls.join(par, cls.name == par.child, "left").select(
        F.lit(0).alias("sec"), F.col("name").alias("k"),
        F.concat(F.lit('    - "'), "name", F.lit('"'),
                 F.when(F.col("ps").isNotNull(), F.concat(F.lit(": subclass of "), "ps")).otherwise(F.lit("")),
                 F.lit("\n")).alias("line"))
    dom = onto.domain.groupBy("property").agg(F.array_join(F.array_sort(F.collect_list("cls")), "|").alias("d"))
    rng = onto.range.groupBy("property").agg(F.array_join(F.array_sort(F.collect_list("rng")), "|").alias("r"))
    p = pr.join(dom, pr.name == dom.property, "left").drop("property") \
        .join(rng, pr.name == rng.property, "left")
    p_lines = p.select(F.when(F.col("kind") == "object", 1).otherwise(2).alias("sec"), F.col("name").alias("k"),
                       F.concat(F.lit('    - "'), "name", F.lit('": '), F.coalesce("d", F.lit("?")),
                                F.lit(" -> "), F.coalesce("r", F.lit("?")), F.lit("\n")).alias("line"))
    titles = [(0, "Classes :"), (1, "Object Properties:"), (2, "Data Properties:")]
    heads = local_table(onto.classes.sparkSession,
                        [(sec, "", ("\n" if sec else "") + t + "\n") for sec, t in titles], "sec int, k string, line string")
    allrows = cls_lines.unionByName(p_lines).unionByName(heads)
    # One ontology-sized group; sorted by (section, term) with the title first.
    return allrows.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sec", "k", "line"))),
                                                lambda x: x["line"]), "").alias("description"))
