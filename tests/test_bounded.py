"""Operators whose groups may be of any size, on groups larger than their pieces."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from graphloom.operators.evaluate import compare_models
from graphloom.operators.graphstats import entity_values, graph_stats
from graphloom.operators.grounding import grounding_by_value, link_mentions, text_values
from graphloom.operators.ontology import builtin_ontology
from graphloom.operators.ranking import rank_within
from graphloom.operators.responses import context_of, context_offsets, running_context
from graphloom.operators.timing import timing_summary
from graphloom.operators.turtle import parse_graphs, to_turtle, triples_of

SCHEMA = "doc_id string, s string, p string, o string, o_kind string, o_datatype string, o_lang string"


def test_hub_subject_becomes_bounded_blocks_that_read_back(spark):
    rows = [("g", ":hub", p, f":o{i}", "iri", None, None) for i in range(57) for p in (":p", ":q")]
    rows += [("g", ":hub", "rdf:type", ":dam", "iri", None, None), ("g", ":small", ":p", 'a "b"\n', "literal", None, "en"),
             ("h", ":hub", ":p", ":x", "iri", None, None)]
    rows += [("g", ":ten", ":p", f":o{i}", "iri", None, None) for i in range(10)]
    blocks = to_turtle(spark.createDataFrame(rows, SCHEMA), ["doc_id"], header=True, most=10).collect()
    got = {(b.doc_id, b.s, b.block): b.turtle for b in blocks}
    assert len(got) == len(blocks) == 12 + 1 + 1 + 1
    assert sorted(k[2] for k in got if k[:2] == ("g", ":hub")) == list(range(12))
    assert all(t.count(" , ") + t.count(" ;") <= 9 for t in got.values())
    read = triples_of(parse_graphs(spark.createDataFrame([(b.doc_id, b.turtle) for b in blocks], "doc_id string, text string"), "text", ["doc_id"]))
    assert {tuple(r) for r in read.select(*SCHEMA.replace(" string", "").split(", ")).collect()} == set(rows)


def test_rank_within_groups(spark):
    rng = random.Random(1)
    rows = [(rng.choice("aaab"), rng.randrange(50)) for _ in range(400)]
    got = rank_within(spark.createDataFrame(rows, "g string, v int"), ["g"], ["v"], "r").collect()
    for g in "ab":
        mine = sorted((r.r, r.v) for r in got if r.g == g)
        assert [r for r, _ in mine] == list(range(1, len(mine) + 1)) and [v for _, v in mine] == sorted(v for x, v in rows if x == g)


def test_medians_of_every_level(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["z", "o", None]), rng.choice(["a", "b", "c"]), f"f{rng.randrange(9)}", rng.choice([None, 1.0, 1.0, 2.5, float(rng.randrange(40))]))
            for _ in range(601)]
    d = spark.createDataFrame(rows, "regime string, model string, file_name string, seconds double")

    def check(got, mine):
        v = [x for x in mine if x is not None]
        assert got.n_calls == len(v) and got.median_s == (statistics.median(v) if v else None)
        assert got.total_s == pytest.approx(sum(v)) and got.min_s == min(v) and got.max_s == max(v) and got.mean_s == pytest.approx(sum(v) / len(v))

    out = timing_summary(d).collect()
    assert len(out) == 9 + 3 + 1
    for r in out:
        check(r, [x[3] for x in rows if (r.level == "all" or x[0] == r.regime) and (r.level != "model" or x[1] == r.model)])
    for r in timing_summary(d, by="file").collect():
        check(r, [x[3] for x in rows if x[0] == r.regime and x[2] == r.file_name])
    assert timing_summary(d.limit(0)).where("level <> 'all'").count() == 0


def test_contexts_by_offset_equal_the_running_ones(spark):
    d = spark.createDataFrame([(x, i, f"réponse {i} 😀" * i) for x in "ab" for i in range(5)], "doc_id string, chunk_idx int, response string")
    texts, offsets = context_offsets(d, keys=("doc_id",), prefix="P\n")
    got = {(r.doc_id, r.chunk_idx): r.c for r in offsets.join(texts, "doc_id").select("doc_id", "chunk_idx", context_of().alias("c")).collect()}
    assert got == {(r.doc_id, r.chunk_idx): r.context for r in running_context(d, keys=("doc_id",), prefix="P\n").collect()}
    assert texts.count() == 2


def test_a_sweep_of_more_models_than_bits(spark):
    rng = random.Random(3)
    models = [f"m{i}" for i in range(70)]
    rows = [(rng.choice("xy"), m, f":s{rng.randrange(12)}", ":p", ":o", "iri", None, None) for m in models[:-1] for _ in range(6)]
    d = spark.createDataFrame(rows, "doc_id string, model string, s string, p string, o string, o_kind string, o_datatype string, o_lang string")
    sets = {}
    for r in rows:
        sets.setdefault((r[0], r[1]), set()).add(r[2])
    got = {(r.doc_id, r.model_a, r.model_b): (r.shared, r.only_a, r.only_b) for r in compare_models(d, models).collect()}
    expected = {}
    for doc in "xy":
        for i, a in enumerate(models):
            for b in models[i + 1:]:
                x, y = sets.get((doc, a), set()), sets.get((doc, b), set())
                if x or y:
                    expected[doc, a, b] = (len(x & y), len(x - y), len(y - x))
    assert got == expected


def test_values_of_a_text(spark):
    text = "Haut de 2,1 m, coût 36 700 € HT le 12 mars 2011; v1.2.3, 1995 and January 5th, 1994, 2010-09, -3.50 and 87,000€ 12345"
    got = {(r.kind, r.value) for r in text_values(spark.createDataFrame([("d", text), ("e", None), ("f", "")], "doc_id string, text string")).collect()}
    numbers = {float(v) for k, v in got if k == "number"}
    assert {2.1, 36700.0, 12.0, 2011.0, -3.5, 87000.0, 12345.0, 1995.0} <= numbers and not {36.0, 700.0, 87.0, 1.2, 2.3} & numbers
    assert {v for k, v in got if k == "date"} == {"2011-03-12", "2011-03", "2011", "1995", "1994-01-05", "1994-01", "1994", "2010-09", "2010"}


def test_grounding_by_value_and_by_words(spark):
    docs = spark.createDataFrame([("d", "Le barrage: 2,1 m; 12 mars 2011"), ("e", "nothing")], "doc_id string, text string")
    schema = "doc_id string, o string, o_kind string, v_decimal decimal(38,18), v_integer long, v_date date, date_precision string"
    rows = [(x, o, "literal", None, None, None, None) for x in "de" for o in ("le  BARRAGE", "absent")]
    typed = spark.createDataFrame(rows, schema)
    typed = typed.unionByName(spark.sql("""SELECT doc_id, o, 'literal' AS o_kind, cast(n AS decimal(38,18)) AS v_decimal, i AS v_integer,
        cast(day AS date) AS v_date, prec AS date_precision FROM VALUES ('d', '2.1', '2.1', null, null, null), ('d', '12', null, 12L, null, null),
        ('d', '2,10', '2.10', null, null, null), ('d', '21', '21', null, null, null), ('d', 'day', null, null, '2011-03-12', 'day'),
        ('d', 'month', null, null, '2011-03-01', 'month'), ('d', 'first', null, null, '2011-03-01', 'day'), ('e', 'day', null, null, '2011-03-12', 'day')
        AS t(doc_id, o, n, i, day, prec)"""))
    got = {(r.doc_id, r.o): r.grounded for r in grounding_by_value(typed, docs).collect()}
    assert {k for k, v in got.items() if v} == {("d", "le  BARRAGE"), ("d", "2.1"), ("d", "12"), ("d", "2,10"), ("d", "day"), ("d", "month")}
    assert len(got) == 12


def test_mentions_come_only_from_tokens_that_begin_a_label(spark):
    onto = builtin_ontology(spark)
    docs = spark.createDataFrame([("a", "The fish pass, a DAM and the barrage."), ("b", None), ("c", ""), ("d", "nothing named " * 50)], "doc_id string, text string")
    found = link_mentions(docs, onto)
    got = {(r.doc_id, r.pos, r.mention) for r in found.collect()}
    assert ("a", 5, "dam") in got and ("a", 8, "barrage") in got and {x for x, _, _ in got} == {"a"}


def test_statistics_and_values_of_graphs(spark):
    onto = builtin_ontology(spark)
    from graphloom.operators.conform import canonicalise

    rows = [("r", "z", "m", "g", 0, *x) for x in [
        (":m", "rdf:type", ":restorationMeasure", "iri", None, None), (":m", ":hasCost", "1", "literal", None, None), (":m", ":hasCost", "2", "literal", None, None),
        (":n", "rdf:type", ":restorationMeasure", "iri", None, None), (":d", ":hasCost", "3", "literal", None, None)]]
    rows += [("r", "z", "m", "h", 0, ":x", ":p", ":y", "iri", None, None)]
    canon = canonicalise(spark.createDataFrame(rows, "run_id string, regime string, model string, doc_id string, stmt_idx long, " + SCHEMA.replace("doc_id string, ", "")), onto)
    got = {r.doc_id: tuple(r)[4:] for r in graph_stats(canon).collect()}
    assert got == {"g": (5, 3, 1, 2, 3, 2), "h": (1, 1, 0, 1, 0, 0)}
    values = {(r.s_key, r.prop, r.val) for r in entity_values(canon, onto, "restorationMeasure", ["hasCost"]).collect()}
    assert values == {("m", "hasCost", "1"), ("m", "hasCost", "2"), ("n", None, None)}


def test_stored_sets_have_one_row_for_each_group(spark):
    """The plan of the statistics repeats no row."""
    d = spark.range(1).select(*[F.lit("x").alias(c) for c in ("run_id", "regime", "model", "doc_id", "s_key", "p_canon", "o_canon", "o_key", "o_kind")])
    assert "Expand" not in graph_stats(d)._jdf.queryExecution().toString()
