import random

from pyspark.sql import functions as F

from graphloom.operators import evaluate as EV
from graphloom.operators.components import components
from graphloom.operators.grounding import extract_rules, grounding, link_mentions
from graphloom.operators.ontology import builtin_ontology

SCHEMA = ("run_id string, regime string, model string, doc_id string, s_key string, p_canon string, o_key string, "
          "o_kind string")


def union_find(edges, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    comp = {}
    for n in nodes:
        comp.setdefault(find(n), []).append(n)
    return {n: min(members) for members in comp.values() for n in members}


def test_components_match_union_find(spark):
    rng = random.Random(7)
    nodes = [f"n{i:03d}" for i in range(120)]
    edges = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(90)]
    nodes += [f"c{i:03d}" for i in range(300)]
    edges += [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(299)]  # a long chain
    rows = [("r", "z", "m", "g", a, ":link", b, "iri") for a, b in edges]
    rows += [("r", "z", "m", "g", n, "rdf:type", "dam", "iri") for n in nodes]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.node: r.component for r in components(df, ["run_id", "regime", "model", "doc_id"]).collect()}
    want = union_find([(a, b) for a, b in edges if a != b], nodes)
    assert got == want


def test_mentions_and_rules(spark):
    docs = spark.createDataFrame([("d1", "Le seuil de moulin et la passe à poissons, 2010 à 2012, coût 231 000 €."),
                                  ("d2", "A vertical slot passage on the river.")], "doc_id string, text string")
    onto = builtin_ontology(spark)
    m = {(r.doc_id, r.term, r.pos) for r in link_mentions(docs, onto).collect()}
    assert ("d1", "millWeir", 2) in m and ("d1", "weir", 2) in m and ("d1", "fishway", 7) in m
    assert ("d2", "verticalSlotPassage", 2) in m and ("d2", "river", 7) in m
    r = extract_rules(docs, onto)
    got = {(t.s, t.p, t.o) for t in r.where("doc_id = 'd1' AND s = ':doc_d1'").collect()}
    assert (":doc_d1", ":hasCost", "231 000") in got
    assert (":doc_d1", ":startsAt", "2010") in got and (":doc_d1", ":endsAt", "2012") in got


def test_normalised_keys(spark):
    rows = [("A", "d", ":SeuilX", ":hasHeight", "2.1", "literal"), ("A", "d", ":Плотина", ":p", ":b", "iri"), ("A", "d", ":a", ":p", "Text  Here", "literal"),
            ("G", "d", ":seuil_x", ":hasHeight", "2.10", "literal"), ("G", "d", ":Река", ":p", ":b", "iri"), ("G", "d", ":a", ":p", "text here", "literal"),
            ("B", "d", ":SeuilX", ":hasHeight", "21", "literal")]
    t = spark.createDataFrame([(*r, None, None) for r in rows],
                              "model string, doc_id string, s string, p string, o string, o_kind string, o_datatype string, o_lang string")
    sc = {r.model: r.tp for r in EV.evaluate(t, t.where("model = 'G'"), ["A", "B"], "normalised").collect()}
    assert sc == {"A": 2, "B": 0}


def test_labels_of_both_languages(spark):
    docs = spark.createDataFrame([("f", "Le barrage, la barrière et le prébarrage."), ("e", "An obstacle; a pre-dam.")], "doc_id string, text string")
    got = {(r.doc_id, r.term, r.label_lang) for r in link_mentions(docs, builtin_ontology(spark)).collect()}
    assert {("f", "dam", "fr"), ("f", "barrier", "fr"), ("f", "pre-barrage", "fr"), ("e", "barrier", "en"), ("e", "barrier", "fr"), ("e", "pre-barrage", "en")} <= got


def test_closure_of_a_deep_and_cyclic_hierarchy(spark):
    from graphloom.operators.ontology import subclass_closure
    from dataclasses import replace
    chain = [(f"k{i}", f"k{i + 1}") for i in range(50)] + [("k50", "k0")]
    onto = replace(builtin_ontology(spark), fixed=None, subclass=spark.createDataFrame(chain, "child string, parent string"))
    got = {(r.child, r.ancestor): r.depth for r in subclass_closure(onto).collect()}
    assert len(got) == 51 * 51 and got[("k0", "k50")] == 50 and got[("k0", "k0")] == 51


def test_grounding(spark):
    docs = spark.createDataFrame([("d", "Travaux  du Seuil\nde Kembs")], "doc_id string, text string")
    t = spark.createDataFrame([("d", "seuil DE kembs", "literal"), ("d", "Haut-Rhin", "literal")],
                              "doc_id string, o string, o_kind string")
    assert [r.grounded for r in grounding(t, docs).orderBy("o").collect()] == [False, True]


def test_evaluate_and_agreement(spark):
    rows = [("A", "d", ":a", ":p", ":b"), ("A", "d", ":a", ":p", ":c"), ("B", "d", ":a", ":p", ":b"),
            ("G", "d", ":a", ":p", ":b"), ("G", "d", ":x", ":p", ":y"), ("G", "e", ":q", ":p", ":r")]
    t = spark.createDataFrame([(*r, "iri", None, None) for r in rows],
                              "model string, doc_id string, s string, p string, o string, o_kind string, o_datatype string, o_lang string")
    sc = {(r.model, r.doc_id): (r.tp, r.fp, r.fn) for r in EV.evaluate(t, t.where("model = 'G'"), ["A", "B"]).collect()}
    assert sc == {("A", "d"): (1, 1, 1), ("B", "d"): (1, 0, 1), ("A", "e"): (0, 0, 1), ("B", "e"): (0, 0, 1)}
    ag = {(r.model_a, r.model_b): (r.shared, r.only_a, r.only_b) for r in EV.compare_models(t, ["A", "B"]).collect()}
    assert ag == {("A", "B"): (1, 1, 0)}
    ag2 = {(r.model_a, r.model_b): r.jaccard for r in EV.compare_models(t, ["B", "A"]).collect()}
    assert ag2[("B", "A")] == 0.5
