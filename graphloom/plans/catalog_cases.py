"""Queries whose data make a feature fire: long paths, wide numbers, planted
labels, failing calls, whole flows.  All derive their rows from the given
tables, whole; each twin computes the expected rows without parsing them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.functions import prompts as PR
from graphloom.operators import conform as C
from graphloom.operators import evaluate as EV
from graphloom.operators import generate as GEN
from graphloom.operators import grounding as GR
from graphloom.operators.components import components
from graphloom.operators.ontology import GRAPH, builtin_ontology
from graphloom.operators.timing import timing_summary
from graphloom.functions.cleaning import flag_placeholders
from graphloom.plans import lifecycles as LC
from graphloom.plans.catalog import (MODELS, MODELS_SQL, TOKENS_SQL, _A2_COLS, _fixture_literals, _labels_sql,
                                     _prompt_sql, FIX_LIT_SQL, FOLD_SQL, V, q, register, with_views)
from graphloom.session import scratch_path


def _orders(spark, sf):
    return V.table(spark, sf, "orders")


# ---------------------------------------------------------------- J9 on paths far above any round limit
@register("j9_long_paths", """
WITH n AS (SELECT DISTINCT o_orderkey + d AS k FROM orders, (VALUES (0), (1)) v(d)),
i AS (SELECT k, k - row_number() OVER (ORDER BY k) AS island FROM n)
SELECT 'node' || lpad(k::VARCHAR, 12, '0') AS node, 'node' || lpad((min(k) OVER (PARTITION BY island))::VARCHAR, 12, '0') AS component FROM i""")
def j9_long_paths(spark, sf):
    """Every order points at the order key after its own: runs of keys are one
    component each, as long as the table."""
    def name(k):
        return F.concat(F.lit("node"), F.lpad(k.cast("string"), 12, "0"))

    g = [F.lit(x).alias(c) for c, x in zip(GRAPH, ("r1", "paths", "orders", "all"))]
    t = _orders(spark, sf).select(*g, name(F.col("o_orderkey")).alias("s_key"), name(F.col("o_orderkey") + 1).alias("o_key"),
                                  F.lit("iri").alias("o_kind"), F.lit(":link").alias("p_canon"))
    return components(t).select("node", "component")


# ---------------------------------------------------------------- N18: wide, united, worded and failing values
@register("n18_wide_literals", """
SELECT o_orderkey, form, v_decimal, v_integer, v_date, unit, parsed FROM (
  SELECT o_orderkey, 'six' AS form, ('0.' || lpad((o_orderkey % 1000000)::VARCHAR, 6, '0') || '000000000000') AS v_decimal, NULL::BIGINT AS v_integer, NULL AS v_date, NULL AS unit, true AS parsed FROM orders
  UNION ALL SELECT o_orderkey, 'long', NULL, 123456700000000000 + o_orderkey, NULL, NULL, true FROM orders
  UNION ALL SELECT o_orderkey, 'cost', ((1 + o_orderkey % 999) * 1000)::DECIMAL(38,18)::VARCHAR, NULL, NULL, '€ HT', true FROM orders
  UNION ALL SELECT o_orderkey, 'worded', NULL, NULL, strftime(make_date(year(o_orderdate), 3, 12), '%Y-%m-%d'), NULL, true FROM orders
  UNION ALL SELECT o_orderkey, 'none', NULL, NULL, NULL, 'unknown', false FROM orders)""")
def n18_wide_literals(spark, sf):
    k = F.col("o_orderkey")
    text = F.lit(None).cast("string")

    def form(name, prop, o, dt=None):
        return F.struct(F.lit(name).alias("form"), F.lit(prop).alias("p_canon"), o.alias("o"), F.lit("literal").alias("o_kind"),
                        (F.lit(dt) if dt else text).alias("o_datatype"))

    t = _orders(spark, sf).select("o_orderkey", F.explode(F.array(
        form("six", ":hasCost", F.concat(F.lit("0."), F.lpad((k % 1000000).cast("string"), 6, "0"))),
        form("long", ":unknownCount", F.concat(F.lit("1234567"), F.lpad(k.cast("string"), 11, "0")), "xsd:integer"),
        form("cost", ":hasCost", F.concat((1 + k % 999).cast("string"), F.lit(" 000 € HT"))),
        form("worded", ":startsAt", F.concat(F.lit("12 mars "), F.year("o_orderdate").cast("string"))),
        form("none", ":hasCost", F.lit("unknown")))).alias("x")).select("o_orderkey", "x.*")
    v = C.type_literals(t, builtin_ontology(spark))
    return v.select("o_orderkey", "form", F.col("v_decimal").cast("string").alias("v_decimal"), "v_integer",
                    F.col("v_date").cast("string").alias("v_date"), "unit", "parsed")


# ---------------------------------------------------------------- J12 and U4 on texts that name the ontology
_TAIL = {"en": " The fish pass and the dam near a barrier were built in 1998 and 2003 for 231 000 €.",
         "fr": " Le barrage, la barrière et le prébarrage: 45 000 euros en 2011."}
_TAIL_OTHER = " A vertical slot passage, 2005."
PLANTED_SQL = ("SELECT doc_id, text || CASE lang " + " ".join(f"WHEN '{k}' THEN {q(v)}" for k, v in _TAIL.items())
               + f" ELSE {q(_TAIL_OTHER)} END AS text FROM corpus")
MENTIONS_SQL = f"""
SELECT DISTINCT g.doc_id, g.pos, g.n, g.gram, l.term FROM (
  SELECT doc_id, n, i AS pos, array_to_string(toks[i:i + n - 1], ' ') AS gram FROM (
    SELECT doc_id, toks, n.n, unnest(range(1, len(toks) - n.n + 2)) AS i
    FROM (SELECT doc_id, {TOKENS_SQL} AS toks FROM planted) c, (SELECT DISTINCT n FROM labels) n)) g
JOIN labels l ON g.gram = l.gram AND g.n = l.n"""


def _planted(spark, sf):
    tail = F.lit(_TAIL_OTHER)
    for lang, t in _TAIL.items():
        tail = F.when(F.col("lang") == lang, F.lit(t)).otherwise(tail)
    return V.corpus(spark, sf).withColumn("text", F.concat("text", tail))


@register("j12_named_terms", with_views("SELECT doc_id, pos, n, gram AS mention, term FROM mentions", "corpus",
                                         extra={"labels": _labels_sql(), "planted": PLANTED_SQL, "mentions": MENTIONS_SQL}))
def j12_named_terms(spark, sf):
    return GR.link_mentions(_planted(spark, sf), builtin_ontology(spark)).select("doc_id", "pos", "n", "mention", "term").distinct()


_COST = r"([0-9][0-9 \x{00a0}\x{202f}.,]*[0-9]|[0-9]) ?(?:€|euros?|EUR)"
U4_SQL = f"""
SELECT doc_id, ':m_' || doc_id || '_' || pos || '_' || n || '_' || term AS s, 'rdf:type' AS p, ':' || term AS o FROM mentions
UNION ALL SELECT doc_id, ':m_' || doc_id || '_' || pos || '_' || n || '_' || term, 'skos:prefLabel', gram FROM mentions
UNION ALL SELECT doc_id, ':doc_' || doc_id, ':includes', ':m_' || doc_id || '_' || pos || '_' || n || '_' || term FROM mentions
UNION ALL SELECT doc_id, ':doc_' || doc_id, 'rdf:type', ':restorationMeasure' FROM planted
UNION ALL SELECT doc_id, ':doc_' || doc_id, ':hasCost', unnest(regexp_extract_all(text, '{_COST}', 1)) FROM planted
UNION ALL SELECT doc_id, ':doc_' || doc_id, ':startsAt', min(y) FROM years GROUP BY doc_id
UNION ALL SELECT doc_id, ':doc_' || doc_id, ':endsAt', max(y) FROM years GROUP BY doc_id"""
# a year is a run of exactly four digits
YEARS_SQL = """
SELECT doc_id, r AS y FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[0-9]+')) AS r FROM planted)
WHERE length(r) = 4 AND (r LIKE '19%' OR r LIKE '20%')"""


@register("u4_rules_fire", with_views(U4_SQL, "corpus", extra={"labels": _labels_sql(), "planted": PLANTED_SQL,
                                                                "mentions": MENTIONS_SQL, "years": YEARS_SQL}))
def u4_rules_fire(spark, sf):
    return GR.extract_rules(_planted(spark, sf), builtin_ontology(spark)).select("doc_id", "s", "p", "o")


# ---------------------------------------------------------------- U3: calls that fail, then a resumed run
@register("u3_failure_policy", with_views(f"""
SELECT doc_id, model, CASE WHEN d < 4 THEN 'ValueError: refused ' || substr(h, 1, 1) END AS first_error, h AS response
FROM (SELECT *, strpos('0123456789abcdef', substr(h, 1, 1)) - 1 AS d FROM (
  SELECT doc_id, model, md5({_prompt_sql(PR.system_text('fine_tuned'), 'text')} || model) AS h FROM corpus CROSS JOIN {MODELS_SQL}))""", "corpus"))
def u3_failure_policy(spark, sf):
    """A backend that refuses a quarter of the prompts; the second run answers
    just those."""
    def ask(docs, models):
        pr = PR.expand_models(PR.build_prompts(docs, "fine_tuned"), models)
        return pr.withColumn("prompt", F.concat(PR.render_chat("messages", add_generation_prompt=True), "model")).select("doc_id", "model", "prompt")

    docs = V.corpus(spark, sf, dealt_rows=True).select("doc_id", "text")
    path, keys = scratch_path(spark, "answers"), ["doc_id", "model"]
    GEN.generate_sweep(docs, MODELS, ask, path, keys, backend="picky", messages_col=None)
    done = GEN.generate_sweep(docs, MODELS, ask, path, keys, backend="hash", messages_col=None)
    first = spark.read.parquet(path).where("error is not null").select(*keys, F.col("error").alias("first_error"))
    return done.where("error is null").join(first, keys, "left").select("doc_id", "model", "first_error", "response")


# ---------------------------------------------------------------- A2 per file, J13 share, N20 on statements
@register("a2_timing_by_file", with_views(f"SELECT regime, file_name, {_A2_COLS} FROM timings GROUP BY regime, file_name", "timings"))
def a2_timing_by_file(spark, sf):
    s = timing_summary(V.timings(spark, sf), by="file")
    return s.select("regime", "file_name", "n_calls", *[F.round(c, 6).alias(c) for c in ("mean_s", "median_s", "min_s", "max_s", "total_s")])


@register("j13_grounding_share", with_views(f"""
SELECT doc_id, count(*) AS n_literals, sum(g::INT) AS n_grounded, round(avg(g::INT), 6) AS grounded_share
FROM (SELECT l.doc_id, strpos({FOLD_SQL.format(c='c.text')}, {FOLD_SQL.format(c='l.o')}) > 0 AS g FROM lits l JOIN corpus c ON l.doc_id = c.doc_id)
GROUP BY doc_id""", "corpus", extra={"lits": FIX_LIT_SQL}))
def j13_grounding_share(spark, sf):
    g = GR.grounding_share(GR.grounding(_fixture_literals(spark, sf), V.corpus(spark, sf)))
    return g.select("doc_id", "n_literals", "n_grounded", F.round("grounded_share", 6).alias("grounded_share"))


@register("n20_placeholder_statements", with_views("""
SELECT doc_id, s, o, lang IN ('fr', 'de', 'es') AS placeholder FROM (
  SELECT doc_id, lang, CASE lang WHEN 'fr' THEN ':<StructureInstance>' ELSE ':doc_' || doc_id END AS s,
         CASE lang WHEN 'de' THEN '<"StartDateTime">' WHEN 'es' THEN '<add a cost>' ELSE length(text)::VARCHAR END AS o FROM corpus)""", "corpus"))
def n20_placeholder_statements(spark, sf):
    """Statements as models leave them: unfilled in three languages, filled in one."""
    lang = F.col("lang")
    t = V.corpus(spark, sf).select(
        "doc_id", F.when(lang == "fr", ":<StructureInstance>").otherwise(F.concat(F.lit(":doc_"), "doc_id")).alias("s"), F.lit(":hasCost").alias("p"),
        F.when(lang == "de", '<"StartDateTime">').when(lang == "es", "<add a cost>").otherwise(F.length("text").cast("string")).alias("o"))
    return flag_placeholders(t).select("doc_id", "s", "o", "placeholder")


# ---------------------------------------------------------------- A5 and A6 over regimes, literals by value
# Two regimes state the order totals of each customer: one as the reference graph writes them, one with other
# spellings; the second model leaves out what was ordered after 1996.
_RUNS = [("r1", "zero_shot", "A"), ("r1", "zero_shot_template", "A"), ("r2", "zero_shot", "B")]
_RUN_VALUES = ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in _RUNS)
RUN_SETS = {
    "rgold": "SELECT o_custkey::VARCHAR AS doc_id, o_orderkey AS k FROM orders",
    "rpred": f"""SELECT v.*, o_custkey::VARCHAR AS doc_id, o_orderkey AS k,
                        v.regime = 'zero_shot' AS same
                 FROM orders, (VALUES {_RUN_VALUES}) v(run_id, regime, model) WHERE v.model = 'A' OR year(o_orderdate) <= 1996""",
    "rscores": f"""
SELECT how, run_id, regime, model, doc_id, tp, n_pred - tp AS fp, n_gold - tp AS fn FROM (
  SELECT h.how, r.run_id, r.regime, r.model, g.doc_id, g.n_gold, coalesce(p.n, 0) AS n_pred,
         CASE WHEN h.how = 'normalised' THEN coalesce(p.n, 0) ELSE coalesce(p.same, 0) END AS tp
  FROM (SELECT doc_id, count(*) AS n_gold FROM rgold GROUP BY doc_id) g, (VALUES ('exact'), ('normalised')) h(how),
       (VALUES {_RUN_VALUES}) r(run_id, regime, model)
  LEFT JOIN (SELECT run_id, regime, model, doc_id, count(*) AS n, sum(same::INT) AS same FROM rpred GROUP BY ALL) p
    ON p.run_id = r.run_id AND p.regime = r.regime AND p.model = r.model AND p.doc_id = g.doc_id)""",
}


def _run_triples(spark, sf):
    """(gold, predictions): names and numbers spelt alike in one regime only."""
    o = _orders(spark, sf)
    k, doc = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string").alias("doc_id")
    total = F.col("o_totalprice").cast("decimal(20,2)").cast("string")
    null = F.lit(None).cast("string")
    gold = o.select(doc, F.concat(F.lit(":Order"), k).alias("s"), F.lit(":hasCost").alias("p"), total.alias("o"), F.lit("literal").alias("o_kind"),
                    F.lit("xsd:decimal").alias("o_datatype"), null.alias("o_lang"))
    runs = F.explode(F.array(*(F.struct(*(F.lit(v).alias(c) for c, v in zip(("run_id", "regime", "model"), r))) for r in _RUNS)))
    same = F.col("r.regime") == "zero_shot"
    pred = o.withColumn("r", runs).where((F.col("r.model") == "A") | (F.year("o_orderdate") <= 1996)).select(
        "r.*", doc, F.when(same, F.concat(F.lit(":Order"), k)).otherwise(F.concat(F.lit(":order_"), k)).alias("s"), F.lit(":hasCost").alias("p"),
        F.when(same, total).otherwise(F.concat(total, F.lit("0"))).alias("o"), F.lit("literal").alias("o_kind"),
        F.when(same, F.lit("xsd:decimal")).alias("o_datatype"), null.alias("o_lang"))
    return gold, pred


def _run_scores(spark, sf):
    gold, pred = _run_triples(spark, sf)
    by = ("run_id", "regime", "model")
    return [EV.evaluate(pred, gold, _RUNS, how, by).withColumn("how", F.lit(how)) for how in ("exact", "normalised")]


@register("a5_runs_and_regimes", with_views("SELECT how, run_id, regime, model, doc_id, tp, fp, fn FROM rscores", extra=RUN_SETS))
def a5_runs_and_regimes(spark, sf):
    exact, normal = _run_scores(spark, sf)
    return exact.unionByName(normal).select("how", "run_id", "regime", "model", "doc_id", "tp", "fp", "fn")


@register("a6_board", with_views(f"""
SELECT *, rank() OVER (ORDER BY micro_f1 DESC NULLS LAST, regime, model) AS rank FROM (
  SELECT s.regime, s.model, s.micro_f1, c.conf AS mean_conformance, t.mean_seconds FROM (
    SELECT regime, model, round(2.0 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)), 6) AS micro_f1 FROM rscores WHERE how = 'normalised' GROUP BY ALL) s
  JOIN (SELECT regime, model, 1.0::DOUBLE AS conf FROM (VALUES {_RUN_VALUES}) r(run_id, regime, model)) c USING (regime, model)
  JOIN (SELECT regime, model, round(avg(o_totalprice / 1000), 6) AS mean_seconds FROM orders, (VALUES {_RUN_VALUES}) r(run_id, regime, model)
        WHERE model = 'A' OR year(o_orderdate) <= 1996 GROUP BY ALL) t USING (regime, model))""", extra=RUN_SETS))
def a6_board(spark, sf):
    _, pred = _run_triples(spark, sf)
    canon = C.canonicalise(pred.withColumn("stmt_idx", F.lit(0)), builtin_ontology(spark))
    calls = _orders(spark, sf).withColumn("r", F.explode(F.array(*(F.struct(F.lit(b).alias("regime"), F.lit(c).alias("model")) for _, b, c in _RUNS)))) \
        .where((F.col("r.model") == "A") | (F.year("o_orderdate") <= 1996)).select("r.*", (F.col("o_totalprice") / 1000).alias("seconds"))
    b = EV.board(_run_scores(spark, sf)[1], C.property_share(canon), calls)
    return b.select("regime", "model", F.round("micro_f1", 6).alias("micro_f1"), "mean_conformance", F.round("mean_seconds", 6).alias("mean_seconds"), "rank")


# ---------------------------------------------------------------- the flows, from texts to saved graphs and timings
def _flow_sql(regime: str) -> str:
    return with_views(f"""
SELECT regime, model, doc_id, s, p, o FROM (
  SELECT '{regime}' AS regime, model, doc_id, ':m_' || substr(h, 1, 8) AS s, unnest([
    {{'p': 'rdf:type', 'o': ':restorationMeasure'}},
    {{'p': ':hasCost', 'o': ((strpos('0123456789abcdef', substr(h, 1, 1)) - 1) * 1000)::VARCHAR}}], recursive := true)
  FROM (SELECT doc_id, md5({_prompt_sql(PR.system_text(regime), 'text')}) AS h FROM corpus), {MODELS_SQL})""", "corpus")


@register("flow_zero_shot", _flow_sql("zero_shot"))
def flow_zero_shot(spark, sf):
    out = scratch_path(spark, "flow")
    answers = LC.zero_shot(V.corpus(spark, sf, dealt_rows=True), MODELS, out, backend="graph")
    return LC.save_graphs(answers, out).select("regime", "model", "doc_id", "s", "p", "o")


@register("flow_zero_shot_template", _flow_sql("zero_shot_template"))
def flow_zero_shot_template(spark, sf):
    out = scratch_path(spark, "flow")
    answers = LC.zero_shot(V.corpus(spark, sf, dealt_rows=True), MODELS, out, backend="graph", template=True)
    return LC.save_graphs(answers, out).select("regime", "model", "doc_id", "s", "p", "o")


@register("flow_fine_tuned", _flow_sql("fine_tuned"))
def flow_fine_tuned(spark, sf):
    """Local generation returns the prompt before the answer: cut at the marker."""
    graphs = None
    for m in MODELS:
        out = scratch_path(spark, "flow")
        answers = LC.fine_tuned(V.corpus(spark, sf), m, out, backend="graph", options={"echo": True})
        g = LC.save_graphs(answers, out, text_col="body").select("regime", "model", "doc_id", "s", "p", "o")
        graphs = g if graphs is None else graphs.unionByName(g)
    return graphs
