"""What is dear is done once: expressions are not repeated in a plan, rows and
texts are not moved again.  Checked on plans and on small rows."""

import glob
import os

from pyspark.sql import functions as F

from graphloom.functions import prompts as PR
from graphloom.functions.cleaning import clean_response
from graphloom.operators import generate as GEN
from graphloom.operators import grounding as GR
from graphloom.operators import turtle as T
from graphloom.session import scratch_path
from graphloom.sources import driver_views as V

GRAPH_ROW = "regime string, model string, doc_id string, s string, p string, o string, o_kind string, o_datatype string, o_lang string"
KEYS = ["regime", "model", "doc_id"]


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_statement_is_cut_once_for_all_its_objects(spark):
    d = spark.range(2).select(F.col("id").cast("string").alias("j"))
    assert optimized(d.select(T._plain_statements(F.col("j")).alias("x"))).count("regexp_replace") == 2
    g = spark.createDataFrame([("x",)], "text string")
    assert "size(" not in optimized(T.parse_graphs(g.withColumn("k", F.lit(1)), "text", ["k"]).where("rec = 'triple'")).split("MapInPandas")[0]


def test_hub_blocks_come_back_and_strays_go_to_the_reader(spark):
    rows = [("r", "m", "d", ":hub", ":has", f":o{i:04d}", "iri", None, None) for i in range(2500)]
    rows += [("r", "m", "d", ":hub", ":cost", '5 "x"', "literal", None, None), ("r", "m", "d", ":o1", "rdf:type", ":dam", "iri", None, None)]
    t = spark.createDataFrame(rows, GRAPH_ROW)
    blocks = T.to_turtle(t, KEYS, header=True)
    assert blocks.count() == 4
    got = T.triples_of(T.parse_graphs(blocks.select(*KEYS, F.col("turtle").alias("text")), "text", KEYS))
    assert {tuple(r) for r in got.select("s", "p", "o", "o_kind").collect()} == {(r[3], r[4], r[5], r[6]) for r in rows}
    odd = spark.createDataFrame([(1, ":a :p :b § ."), (2, ":a :p :b ."), (3, ":a :p .5 .")], "k int, text string")
    plain = odd.select("k", T._plain_tokens(F.col("text"), list(T.PREFIXES)).isNotNull().alias("plain"))
    assert {tuple(r) for r in plain.collect()} == {(1, False), (2, True), (3, False)}


def test_blocks_group_once_and_keep_predicates_without_objects(spark):
    t = spark.createDataFrame([("r", "m", "d", ":a", ":q", None, "iri", None, None), ("r", "m", "d", ":a", ":p", ":y", "iri", None, None),
                               ("r", "m", "d", ":a", ":p", None, "iri", None, None), ("r", "m", "d", ":a", ":p", ":x", "iri", None, None),
                               ("r", "m", "d", ":b", None, ":x", "iri", None, None)], GRAPH_ROW)
    out = T.to_turtle(t, KEYS)
    assert optimized(out).count("collect_list(") == 1
    assert {r["s"]: r["turtle"] for r in out.collect()} == {":a": ":a :p :x , :y ;\n    :q  .", ":b": ":b  ."}


def _tables(spark, root):
    one = {"customer": "1L c_custkey, 'n' c_name, 1L c_nationkey, 'HOUSEHOLD' c_mktsegment",
           "orders": "1L o_orderkey, 1L o_custkey, timestamp'1996-01-02 00:00:00' o_orderdate, 'F' o_orderstatus, 1.5D o_totalprice",
           "lineitem": "1L l_orderkey, 1L l_linenumber, 1L l_partkey, 1L l_suppkey", "part": "1L p_partkey, 'p' p_name, 30 p_size",
           "supplier": "1L s_suppkey, 's' s_name, 1L s_nationkey", "nation": "1L n_nationkey, 'x' n_name"}
    for name, cols in one.items():
        spark.sql(f"select {cols}").write.parquet(f"{root}/{name}.parquet")


def test_statements_that_are_counted_are_not_spelt(spark, tmp_path):
    _tables(spark, str(tmp_path))
    kg = V.kg_triples(spark, str(tmp_path))
    assert kg.count() == 19
    assert "date_format" not in optimized(kg.groupBy("doc_id", "s").count())
    assert [r["p"] for r in kg.where("s = ':order_1'").orderBy("stmt_idx").collect()] == [
        "rdf:type", ":isManagedBy", ":startsAt", ":endssAt", ":hasCost", ":realizedIn", ":associatedTo", ":hasMainContractor"]


def test_an_answer_is_searched_for_fences_once(spark):
    d = spark.createDataFrame([("```ttl\n:a a :b .\n```",), ("\x0b x \n",), (None,), ("``` ```x",)], "t string")
    c = d.select(clean_response("t").alias("c")).select("c.body", "c.format")
    assert optimized(c).count("regexp_extract_all") == 1
    assert [tuple(r) for r in c.collect()] == [(":a a :b .", "turtle"), ("x", "prose"), (None, "empty"), ("``` ```x", "prose")]


def test_a_resumed_sweep_asks_what_is_left(spark):
    docs = spark.createDataFrame([("1", "x"), ("2", "y"), (None, "z")], "doc_id string, text string")
    path, keys, asked = scratch_path(spark, "sweep"), ["doc_id", "model"], []

    def ask(d, models):
        pr = PR.expand_models(d, models).withColumn("prompt", F.concat("text", "model")).select(*keys, "prompt")
        asked.append({tuple(r) for r in pr.select(*keys).collect()})
        return pr

    first = GEN.generate_sweep(docs, ["a", "b"], ask, path, keys, backend="picky", messages_col=None, options={"fail_below": 8})
    failed = {tuple(r) for r in first.where("error is not null").select(*keys).collect()}
    done = GEN.generate_sweep(docs, ["a", "b"], ask, path, keys, backend="hash", messages_col=None)
    assert asked[-1] == failed | {(None, "a"), (None, "b")} and len(asked[-1]) < 6
    assert done.where("doc_id is not null and error is null").count() == 4


def test_messages_go_only_to_backends_that_read_them(spark):
    class Reads:
        def generate(self, prompt, messages_json, options):
            return messages_json

    pr = PR.build_prompts(spark.createDataFrame([("1", "x")], "doc_id string, text string"), "fine_tuned").withColumn("prompt", F.lit("p"))
    assert "to_json" not in optimized(GEN.generate(pr, "graph", keys=["doc_id"]))
    assert '"content":"x"' in GEN.generate(pr, Reads, keys=["doc_id"]).first()["response"]


def test_saved_answers_lie_in_many_folders(spark, tmp_path):
    from graphloom.plans.catalog_proofs import s3_reference_layout

    spark.range(300).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.lit('a "b"').alias("text")).write.parquet(f"{tmp_path}/documents.parquet")
    out = s3_reference_layout(spark, str(tmp_path))
    assert out.count() == 300 and {r["regime"] for r in out.select("regime").distinct().collect()} == {"answers"}
    base = spark.sparkContext.getCheckpointDir().split(":", 1)[-1]
    latest = max(glob.glob(f"{base}/io/answers-*"), key=os.path.getmtime)
    assert len(glob.glob(f"{latest}/*/answers")) > 32


def test_grounding_moves_literals_and_texts_once(spark):
    lits = spark.createDataFrame([("1", "A  b", "literal"), ("1", "A  b", "literal"), ("1", None, "literal"), ("2", "q", "literal"), ("1", ":x", "iri")],
                                 "doc_id string, o string, o_kind string")
    docs = spark.createDataFrame([("1", "x a b"), ("2", None)], "doc_id string, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        g = GR.grounding(lits, docs)
        assert g._jdf.queryExecution().sparkPlan().toString().count("Join") == 1
        assert sorted((tuple(r) for r in g.select("doc_id", "o", "grounded").collect()), key=str) == [("1", "A  b", True), ("1", "A  b", True), ("2", "q", None)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_text_values_cuts_each_text_once(spark):
    docs = spark.createDataFrame([("1", "On 12 Mars 2011 and août 1999, Mayor 5: 36 700,50 / 2001-02-03 / 1.234")], "doc_id string, text string")
    v = GR.text_values(docs)
    assert optimized(v).count("regexp_extract_all(") == 3
    got = {(r["kind"], r["value"]) for r in v.collect()}
    assert {("date", x) for x in ("2011-03-12", "2011-03", "2011", "1999-08", "1999", "2001-02-03", "2001-02", "2001")} <= got
    assert ("number", "36700.500000000000000000") in got and ("number", "1.234000000000000000") in got
