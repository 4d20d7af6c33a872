"""Queries whose data reach what the others cannot: hub individuals, expected
properties that are filled and that are not, variants of names, subjects larger
than a block, values written in other ways, sweeps of many models, and files in
the layout of saved answers.  All derive their rows from the given tables, whole.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom import prompt_texts as P
from graphloom.functions.text import chunk_text
from graphloom.operators import conform as C
from graphloom.operators import evaluate as EV
from graphloom.operators import graphstats as GS
from graphloom.operators import grounding as GR
from graphloom.operators import turtle as T
from graphloom.operators.ontology import builtin_ontology
from graphloom.operators.responses import context_of, context_offsets
from graphloom.plans.catalog import CHUNK_SQL, G, ORACLE, V, q, register, with_views
from graphloom.plans.oracle_views import VIEWS
from graphloom.session import scratch_path
from graphloom.sinks import writers as W
from graphloom.sources import files as SRC

# ---------------------------------------------------------------- one graph with a hub, coverage and name variants
# Parts are fish lifts: all are realised in one zone (the hub), some have a cost of the right datatype, of another,
# or none, and an associated structure, something else, or nothing.  Suppliers are named in several ways.
_KINDS = [(":Supplier-", ""), (":supplier_", ""), (":SUPPLIÈR", ""), (":Поставщик-", ""), (":поставщик_", ".")]
PROOF_SQL = """
SELECT 'r1' AS run_id, 'proof' AS regime, 'proof' AS model, 'all' AS doc_id, 0::BIGINT AS stmt_idx, s, p, o, o_kind, dt AS o_datatype,
       CAST(NULL AS VARCHAR) AS o_lang, 'ok' AS parse_status FROM (
  SELECT ':Lift_' || p_partkey AS s, 'rdf:type' AS p, ':fishLift' AS o, 'iri' AS o_kind, CAST(NULL AS VARCHAR) AS dt FROM part
  UNION ALL SELECT ':Lift_' || p_partkey, ':realizedIn', ':Hub', 'iri', NULL FROM part
  UNION ALL SELECT ':Lift_' || p_partkey, ':hasCost', p_size::VARCHAR, 'literal', CASE p_size % 4 WHEN 0 THEN 'xsd:decimal' ELSE 'xsd:string' END
            FROM part WHERE p_size % 4 < 2
  UNION ALL SELECT ':Lift_' || p_partkey, ':associatedTo', CASE p_size % 3 WHEN 0 THEN ':Dam_' || (p_partkey % 7) ELSE ':Hub' END, 'iri', NULL
            FROM part WHERE p_size % 3 < 2
  UNION ALL SELECT DISTINCT ':Dam_' || (p_partkey % 7), 'rdf:type', ':dam', 'iri', NULL FROM part
  UNION ALL SELECT ':Hub', 'rdf:type', ':geographicZone', 'iri', NULL FROM (SELECT min(p_partkey) FROM part)
""" + "".join(f"  UNION ALL SELECT {q(a)} || s_suppkey || {q(b)}, ':isLocatedOn', ':Hub', 'iri', NULL FROM supplier\n" for a, b in _KINDS) + ") u"


def _proof(spark, sf):
    part, supplier = V.table(spark, sf, "part"), V.table(spark, sf, "supplier")
    null = F.lit(None).cast("string")

    def t(s, p, o, kind="iri", dt=null):
        return F.struct(s.alias("s"), F.lit(p).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"), dt.alias("o_datatype"))

    lift = F.concat(F.lit(":Lift_"), F.col("p_partkey").cast("string"))
    dam = F.concat(F.lit(":Dam_"), (F.col("p_partkey") % 7).cast("string"))
    size = F.col("p_size")
    rows = part.select(F.explode(F.filter(F.array(
        t(lift, "rdf:type", F.lit(":fishLift")), t(lift, ":realizedIn", F.lit(":Hub")),
        F.when(size % 4 < 2, t(lift, ":hasCost", size.cast("string"), "literal", F.when(size % 4 == 0, "xsd:decimal").otherwise("xsd:string"))),
        F.when(size % 3 < 2, t(lift, ":associatedTo", F.when(size % 3 == 0, dam).otherwise(F.lit(":Hub"))))), lambda x: x.isNotNull())).alias("t"))
    rows = rows.unionByName(part.select(dam.alias("d")).distinct().select(t(F.col("d"), "rdf:type", F.lit(":dam")).alias("t")))
    rows = rows.unionByName(part.agg(F.min("p_partkey")).select(t(F.lit(":Hub"), "rdf:type", F.lit(":geographicZone")).alias("t")))
    names = F.array(*(t(F.concat(F.lit(a), F.col("s_suppkey").cast("string"), F.lit(b)), ":isLocatedOn", F.lit(":Hub")) for a, b in _KINDS))
    rows = rows.unionByName(supplier.select(F.explode(names).alias("t")))
    return rows.select(F.lit("r1").alias("run_id"), F.lit("proof").alias("regime"), F.lit("proof").alias("model"), F.lit("all").alias("doc_id"),
                       F.lit(0).cast("long").alias("stmt_idx"), "t.*", null.alias("o_lang"), F.lit("ok").alias("parse_status"))


def _proof_canon(spark, sf):
    onto = builtin_ontology(spark)
    return C.canonicalise(_proof(spark, sf), onto), onto


def _on_proof(name: str) -> str:
    """The twin of a query over the graph view, over the rows above instead."""
    sql = ORACLE[name].replace(VIEWS["kg_triples"], PROOF_SQL)
    assert sql != ORACLE[name]
    return sql


@register("j5_hub_object", _on_proof("j5_check_domain_range"))
def j5_hub_object(spark, sf):
    """One object holds a third of all statements and more."""
    r = C.check_domain_range(*_proof_canon(spark, sf))
    return r.groupBy("doc_id", "p_canon", "domain_status", "range_status").agg(F.count(F.lit(1)).alias("n"))


@register("j6_coverage", _on_proof("j6_check_restrictions"))
def j6_coverage(spark, sf):
    return C.check_restrictions(*_proof_canon(spark, sf)).select("doc_id", "s_key", "property", "filler", "present", "filled")


@register("j15_name_variants", _on_proof("j15_resolve_individuals"))
def j15_name_variants(spark, sf):
    return C.resolve_individuals(_proof_canon(spark, sf)[0]).select("doc_id", "s_key", "canonical", "n_variants")


@register("a3_hub_stats", _on_proof("a3_graph_stats"))
def a3_hub_stats(spark, sf):
    return GS.graph_stats(_proof_canon(spark, sf)[0]).drop("run_id", "regime", "model")


# ---------------------------------------------------------------- A8, A7, K1, S3 on a subject that states every order
REGISTER_SQL = """SELECT ':register' AS s, ':includes' AS p, ':order_' || o_orderkey AS o, 'iri' AS o_kind FROM orders
UNION ALL SELECT ':order_' || o_orderkey, ':hasCost', o_totalprice::DECIMAL(18,2)::VARCHAR, 'literal' FROM orders"""


def _register(spark, sf):
    key = F.concat(F.lit(":order_"), F.col("o_orderkey").cast("string"))
    null = F.lit(None).cast("string")
    rows = F.explode(F.array(
        F.struct(F.lit(":register").alias("s"), F.lit(":includes").alias("p"), key.alias("o"), F.lit("iri").alias("o_kind")),
        F.struct(key.alias("s"), F.lit(":hasCost").alias("p"), F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("o"),
                 F.lit("literal").alias("o_kind"))))
    t = V.table(spark, sf, "orders").select(rows.alias("t")).select("t.*")
    return t.select(F.lit("r1").alias("run_id"), F.lit("hub").alias("regime"), F.lit("hub").alias("model"), F.lit("orders").alias("doc_id"), "*").withColumns({"o_datatype": null, "o_lang": null})


@register("a8_hub_blocks", f"""
SELECT s, block, md5(s || ' ' || p || ' ' || string_agg(ot, ' , ' ORDER BY ot) || ' .') AS block_md5 FROM (
  SELECT s, p, CASE o_kind WHEN 'literal' THEN '"' || o || '"' ELSE o END AS ot,
         (row_number() OVER (PARTITION BY s ORDER BY p, CASE o_kind WHEN 'literal' THEN '"' || o || '"' ELSE o END) - 1) // 1000 AS block
  FROM ({REGISTER_SQL})) GROUP BY s, p, block""")
def a8_hub_blocks(spark, sf):
    """A subject with every order as object is many blocks of 1000 objects."""
    return T.to_turtle(_register(spark, sf), G).select("s", "block", F.md5("turtle").alias("block_md5"))


@register("k1_s3_hub_graph", f"SELECT s, p, o, o_kind FROM ({REGISTER_SQL})")
def k1_s3_hub_graph(spark, sf):
    """The same graph written as Turtle and read back to its statements."""
    path = scratch_path(spark, "hub")
    W.write_graphs(T.to_turtle(_register(spark, sf), G, header=True), path, fmt="turtle")
    parsed = T.parse_graphs(SRC.read_packed_graphs(spark, path), "text", ["regime", "model", "doc_id"])
    return T.triples_of(parsed).select("s", "p", "o", "o_kind")


@register("a7_entity_values", with_views("""
SELECT m.doc_id, m.s_key, v.prop, v.val
FROM (SELECT DISTINCT run_id, regime, model, doc_id, s_key FROM types WHERE cls = 'restorationMeasure') m
LEFT JOIN (SELECT *, regexp_replace(p_canon, '^:', '') AS prop, coalesce(o_key, o) AS val FROM canon) v
  ON m.run_id = v.run_id AND m.regime = v.regime AND m.model = v.model AND m.doc_id = v.doc_id AND m.s_key = v.s_key
 AND v.prop IN ('associatedTo', 'hasMainContractor')""", "canon", "types"))
def a7_entity_values(spark, sf):
    from graphloom.plans.catalog import _canon_kept

    e = GS.entity_values(_canon_kept(spark, sf, "s_key", "o_key", "o", "p_canon", "o_canon", "o_match"), builtin_ontology(spark), "restorationMeasure", ["associatedTo", "hasMainContractor"])
    return e.select("doc_id", "s_key", "prop", "val")


# ---------------------------------------------------------------- J13: numbers and dates written otherwise
_TAILS = {"en": " It is 2,1 m high, cost €36,700.00 and was built on January 5th, 1995.",
          "fr": " Haut de 2,1 m, il a coûté 36 700 € HT le 12 mars 2011.", None: " 2.1 / 36700 / 2011-03-12"}
_ASKED = [("height", "2.1", "xsd:decimal"), ("cost", "36700", "xsd:decimal"), ("day", "2011-03-12", "xsd:date"),
          ("year", "1995", "xsd:gYear"), ("other", "36.7", "xsd:decimal"), ("words", "haut de 2,1 M", None)]
_HELD = {"height": ("en", "fr", None), "cost": ("en", "fr", None), "day": ("fr", None), "year": ("en",), "other": (), "words": ("fr",)}


@register("j13_by_value", with_views("SELECT doc_id, which, o, grounded FROM (" + " UNION ALL ".join(
    f"SELECT doc_id, {q(w)} AS which, {q(o)} AS o, "
    + (" OR ".join([f"lang = {q(x)}" if x else "coalesce(lang NOT IN ('en', 'fr'), true)" for x in _HELD[w]]) or "false")
    + f" AS grounded FROM documents WHERE text IS NOT NULL" for w, o, _ in _ASKED) + ")"))
def j13_by_value(spark, sf):
    """Numbers, a day and a year that the texts write in other ways, a number no
    text holds, and words."""
    docs = V.table(spark, sf, "documents").where("text is not null")
    texts = V.dealt(docs.select("doc_id", "lang", "text"))
    tail = F.when(F.col("lang") == "en", _TAILS["en"]).when(F.col("lang") == "fr", _TAILS["fr"]).otherwise(_TAILS[None])
    texts = texts.select("doc_id", F.concat("text", tail).alias("text"))
    asked = F.explode(F.array(*(F.struct(F.lit(w).alias("which"), F.lit(o).alias("o"), F.lit(d).cast("string").alias("o_datatype")) for w, o, d in _ASKED)))
    lits = V.dealt(docs.select("doc_id")).select("doc_id", asked.alias("x")).select(
        F.lit("r1").alias("run_id"), F.lit("fixture").alias("regime"), F.lit("fixture").alias("model"), "doc_id", "x.*",
        F.lit("literal").alias("o_kind"), F.lit(":anyValue").alias("p_canon"))
    typed = C.type_literals(lits, builtin_ontology(spark))
    return GR.grounding_by_value(typed, texts).select("doc_id", "which", "o", "grounded")


# ---------------------------------------------------------------- W1 in linear size, W5 on a sweep of a hundred models
@register("w1_context_offsets", ORACLE["w1_running_context"])
def w1_context_offsets(spark, sf):
    c = chunk_text(V.corpus(spark, sf)).withColumnRenamed("chunk", "response")
    texts, offsets = context_offsets(c, keys=("doc_id",), prefix=P.ONE_SHOT_SYSTEM)
    return offsets.join(texts, "doc_id").select("doc_id", "chunk_idx", F.md5(context_of()).alias("context_md5"))


@register("w5_many_models", """
WITH ks AS (SELECT DISTINCT l_returnflag AS doc_id, l_partkey AS k, 'm' || lpad((l_suppkey % 100)::VARCHAR, 2, '0') AS model FROM lineitem),
n AS (SELECT doc_id, model, count(*) AS n FROM ks GROUP BY ALL),
m AS (SELECT DISTINCT 'm' || lpad(i::VARCHAR, 2, '0') AS model FROM range(100) t(i)),
s AS (SELECT a.doc_id, a.model AS model_a, b.model AS model_b, count(*) AS shared FROM ks a JOIN ks b USING (doc_id, k) WHERE a.model < b.model GROUP BY ALL)
SELECT d.doc_id, a.model AS model_a, b.model AS model_b, coalesce(s.shared, 0)::BIGINT AS shared,
       (coalesce(x.n, 0) - coalesce(s.shared, 0))::BIGINT AS only_a, (coalesce(y.n, 0) - coalesce(s.shared, 0))::BIGINT AS only_b
FROM (SELECT DISTINCT doc_id FROM ks) d, m a, m b LEFT JOIN n x ON x.doc_id = d.doc_id AND x.model = a.model
LEFT JOIN n y ON y.doc_id = d.doc_id AND y.model = b.model
LEFT JOIN s ON s.doc_id = d.doc_id AND s.model_a = a.model AND s.model_b = b.model
WHERE a.model < b.model AND coalesce(x.n, 0) + coalesce(y.n, 0) > 0""")
def w5_many_models(spark, sf):
    """A sweep of a hundred models, more than a bit mask holds."""
    li = V.table(spark, sf, "lineitem")
    null = F.lit(None).cast("string")
    t = li.select(F.col("l_returnflag").alias("doc_id"), F.concat(F.lit("m"), F.lpad((F.col("l_suppkey") % 100).cast("string"), 2, "0")).alias("model"),
                  F.concat(F.lit(":part_"), F.col("l_partkey").cast("string")).alias("s"), F.lit(":in").alias("p"), F.lit(":order").alias("o"),
                  F.lit("iri").alias("o_kind"), null.alias("o_datatype"), null.alias("o_lang"))
    return EV.compare_models(t, [f"m{i:02d}" for i in range(100)]).drop("jaccard")


# ---------------------------------------------------------------- S3: the layout of saved answers
_STYLES = [("qwen2.5:14b", "qwen2.5_14b"), ("llama3.1:8b", "llama3.1_8b"), ("mistral:latest", "mistral_latest"), ("llama-3-70b", "llama_3_70b"),
           ("Qwen3-3-72b", "Qwen3_3_72b"), ("Qwen3-3-72b2", "Qwen3_3_72b2"), ("qwen2:7b", "qwen2_7b")]
_STYLE_SQL = "(VALUES " + ", ".join(f"({i}, {q(m)})" for i, (m, _) in enumerate(_STYLES)) + ") v(i, model)"


@register("s3_reference_layout", f"""
SELECT 'answers' AS regime, v.model, 'Site_' || doc_id || '_no__' || (doc_id % 3) AS doc_id, md5(text) AS text_md5, ':Site_' || doc_id AS s
FROM documents JOIN {_STYLE_SQL} ON v.i = doc_id % {len(_STYLES)} WHERE text IS NOT NULL""")
def s3_reference_layout(spark, sf):
    """Files ``<regime>/<doc>_<model suffix>.ttl``: doc and model are taken
    from the name (parentheses dropped, the longest known suffix), the text is
    read whole and its statement parsed.  They lie in 256 such trees under one
    root (one folder of all files could not be listed in parallel)."""
    d = V.dealt(V.table(spark, sf, "documents").where("text is not null").select("doc_id", "text"))
    suffix = F.element_at(F.array(*(F.lit(s) for _, s in _STYLES)), (F.col("doc_id") % len(_STYLES) + 1).cast("int"))
    key = F.col("doc_id").cast("string")
    tree = F.lpad(F.pmod(F.xxhash64("doc_id"), F.lit(256)).cast("string"), 4, "0")
    name = F.concat(tree, F.lit("/answers/Site_("), key, F.lit(")_no__"), (F.col("doc_id") % 3).cast("string"), F.lit("_"), suffix, F.lit(".ttl"))
    quoted = F.replace(F.replace(F.replace(F.replace("text", F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')),
                                 F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))
    body = F.concat(F.lit(":Site_"), key, F.lit(' skos:definition "'), quoted, F.lit('" .\n'))
    root = scratch_path(spark, "answers")
    W.write_named_files(d.select(name.alias("name"), body.alias("text")), root)
    g = SRC.read_graphs(spark, root, models=[m for m, _ in _STYLES])
    parsed = T.triples_of(T.parse_graphs(g.select("regime", "model", "doc_id", "text"), "text", ["regime", "model", "doc_id"]))
    return parsed.select("regime", "model", "doc_id", F.md5("o").alias("text_md5"), "s")


# ---------------------------------------------------------------- K3: a rerun replaces its lines
@register("k3_rerun", with_views("SELECT model, file_name, round(seconds, 2) AS seconds FROM timings", "timings"))
def k3_rerun(spark, sf):
    """All models written, then each of them once more by itself."""
    path, t = scratch_path(spark, "timings"), V.timings(spark, sf)
    W.write_timings(t, path)
    W.write_timings(t.where("model = 'click'"), path)
    W.write_timings(t.where("model <> 'click'"), path)
    r = SRC.read_timings(spark, path)
    return r.select("model", F.col("log_file_name").alias("file_name"), F.round("seconds", 2).alias("seconds"))


# ---------------------------------------------------------------- S2: an ontology of part types by brand, in one file for each
_S2_SQL = """
WITH t AS (SELECT DISTINCT lower(p_type) || '-' || replace(lower(p_brand), '#', '') AS name, replace(lower(p_brand), '#', '') AS brand,
                  lower(p_type) AS line FROM part)
SELECT DISTINCT kind, a, b, c FROM (
  SELECT 'class' AS kind, name AS a, 'type ' || name AS b, CAST(NULL AS VARCHAR) AS c FROM t
  UNION ALL SELECT 'subclass', name, brand, NULL FROM t UNION ALL SELECT 'subclass', name, line, NULL FROM t
  UNION ALL SELECT 'restriction', name, 'hasCost', 'xsd:decimal' FROM t
  UNION ALL SELECT 'restriction', name, 'madeBy', brand FROM t
  UNION ALL SELECT 'property', 'hasCost', 'data', NULL FROM t UNION ALL SELECT 'domain', 'hasCost', name, NULL FROM t
  UNION ALL SELECT 'range', 'hasCost', 'xsd:decimal', NULL FROM t)"""


@register("s2_read_ontology", _S2_SQL)
def s2_read_ontology(spark, sf):
    """Restrictions stand two nodes deep, in an intersection written as list nodes
    and in an equivalence; each type's file numbers its own nodes."""
    from graphloom.sources.ontology import read_ontology
    from graphloom.vocab import ONTO_NS as NS

    parts = V.table(spark, sf, "part").select(F.lower("p_type").alias("line"), F.replace(F.lower("p_brand"), F.lit("#"), F.lit("")).alias("brand")).distinct()
    name = F.concat("line", F.lit("-"), "brand")
    iri = lambda c: F.concat(F.lit(f"<{NS}"), c, F.lit(">"))
    head = ("@prefix owl: <http://www.w3.org/2002/07/owl#> .\n@prefix rdf: <http://www.w3.org/1999/02/22-rdf-syntax-ns#> .\n"
            "@prefix rdfs: <http://www.w3.org/2000/01/rdf-schema#> .\n@prefix skos: <http://www.w3.org/2004/02/skos/core#> .\n"
            "@prefix xsd: <http://www.w3.org/2001/XMLSchema#> .\n")
    brand, line = iri(F.col("brand")), iri(F.col("line"))
    cost = f"<{NS}hasCost>"
    text = F.concat(
        F.lit(head), iri(name), F.lit(' a owl:Class ; skos:prefLabel "type '), name, F.lit('"@en ; rdfs:subClassOf '), line,
        F.lit(", _:both ;\n    owl:equivalentClass [ a owl:Class ; rdfs:subClassOf [ a owl:Restriction ; owl:onProperty <" + NS + "madeBy> ; owl:someValuesFrom "), brand,
        F.lit(" ] ] .\n_:both a owl:Class ; owl:intersectionOf _:l1 .\n_:l1 rdf:first "), brand,
        F.lit(" ; rdf:rest _:l2 .\n_:l2 rdf:first [ a owl:Restriction ; owl:onProperty " + cost + " ; owl:someValuesFrom xsd:decimal ] ; rdf:rest rdf:nil .\n"
              + cost + " a owl:DatatypeProperty ; rdfs:range xsd:decimal ; rdfs:domain "), iri(name), F.lit(" .\n"))
    root = scratch_path(spark, "ontology")
    W.write_named_files(parts.select(F.concat(name, F.lit(".ttl")).alias("name"), text.alias("text")), root)
    o = read_ontology(spark, root)
    rows = lambda kind, df, *cols: df.select(F.lit(kind).alias("kind"), *[
        (F.col(cols[i]) if i < len(cols) else F.lit(None).cast("string")).alias(x) for i, x in enumerate("abc")])
    out = rows("class", o.classes, "name", "pref_label")
    for part in (rows("subclass", o.subclass, "child", "parent"), rows("restriction", o.restriction, "cls", "property", "filler"),
                 rows("property", o.properties, "name", "kind"), rows("domain", o.domain, "property", "cls"), rows("range", o.range, "property", "rng")):
        out = out.unionByName(part)
    return out.distinct()
