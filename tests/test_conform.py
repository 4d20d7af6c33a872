import pytest
from pyspark.sql import functions as F

from graphloom.functions.literals import parse_date, parse_number, parse_bool, type_literal
from graphloom.operators import conform as C
from graphloom.operators.ontology import builtin_ontology, subclass_closure, describe_ontology
from graphloom.operators.turtle_reader import parse_turtle
from graphloom.prompt_texts import EXAMPLE_GRAPH

GRAPH = ("r", "one_shot", "example", "ex")


@pytest.fixture(scope="module")
def example(spark):
    tr, _ = parse_turtle(EXAMPLE_GRAPH)
    rows = [(*GRAPH, i, s, p, o, k, dt, lang, "ok") for i, s, p, o, k, dt, lang in tr]
    df = spark.createDataFrame(rows, "run_id string, regime string, model string, doc_id string, stmt_idx long, s string, "
                                     "p string, o string, o_kind string, o_datatype string, o_lang string, parse_status string")
    onto = builtin_ontology(spark)
    return C.canonicalise(df, onto), onto


def test_closure(spark):
    cl = subclass_closure(builtin_ontology(spark))
    assert cl.count() == 114
    assert cl.agg(F.max("depth")).first()[0] == 3
    assert cl.where("child = 'verticalSlotPassage' AND ancestor = 'restorationOperation'").first().depth == 3


def test_example_facts(example):
    canon, onto = example
    assert canon.select("s_key").distinct().count() == 5
    dangling = [r.o_key for r in C.dangling_refs(canon).collect()]
    assert dangling == ["MaitriseOuuvreConseilGeneralDuHautRhin"]
    isolated = [r.s_key for r in C.isolated_individuals(canon).collect()]
    assert isolated == ["MaitriseOeuvreConseilGeneralDuHautRhin"]
    drift = {(r.p_local, r.p_match) for r in canon.where("p_match = 'alias'").collect()}
    assert drift == {("endssAt", "alias"), ("averageSlope", "alias")}
    types = {r.o.lstrip(":"): r.status for r in C.check_types(canon).collect()}
    assert types["lowSlopeRockfillWeir"] == "alias" and types["weir"] == "exact"
    imp = C.derive_impassable(canon, onto).collect()
    assert [(r.s_key, r.derived, r.asserted, r.status) for r in imp] == [("SeuilDSSmithKaysersberg", True, True, "agree")]


def test_weir_is_not_a_structure(example):
    canon, onto = example
    dr = {(r.s, r.p_canon): r.domain_status for r in C.check_domain_range(canon, onto).collect()}
    # weir is a technicalElement in the ontology: the example's own height is a domain fault
    assert dr[(":SeuilDSSmithKaysersberg", ":hasHeight")] == "violation"
    # artificialRiver is a fishway, i.e. a restorationOperation; hasCost's domain is restorationMeasure
    assert dr[(":PasseAPoissons", ":hasCost")] == "violation"
    assert dr[(":SeuilDSSmithKaysersberg", ":isImpassable")] == "violation"


def test_literal_cases(spark):
    costs = ["36 700 € HT", "€36,700.00", "87,000€", "171,000", "750000.0", "12.2m", "1,5"]
    df = spark.createDataFrame([(c,) for c in costs], "o string")
    got = [(f"{r.v.value:.4f}" if r.v.value is not None else None, r.v.unit) for r in df.select(parse_number(F.col("o")).alias("v")).collect()]
    assert got == [("36700.0000", "€ HT"), ("36700.0000", "€"), ("87000.0000", "€"), ("171000.0000", None),
                   ("750000.0000", None), ("12.2000", "m"), ("1.5000", None)]
    wide = spark.createDataFrame([("0.123456", "decimal"), ("123456789012345678", "integer"), ("7.5", "integer"), ("12 345", "integer")],
                                 "o string, t string")
    got = [(r.v.v_decimal and str(r.v.v_decimal.normalize()), r.v.v_integer) for r in wide.select(type_literal(F.col("o"), F.col("t")).alias("v")).collect()]
    assert got == [("0.123456", None), (None, 123456789012345678), (None, None), (None, 12345)]
    dates = ["2010-09", "2011", "November 2001", "August 2010", "January 1st, 1995", "200-01-01",
             "2011-08-01T00:00:00Z", "12 mars 2011"]
    df = spark.createDataFrame([(d,) for d in dates], "o string")
    got = [(str(r.v.value) if r.v.value else None, r.v.precision) for r in df.select(parse_date(F.col("o")).alias("v")).collect()]
    assert got == [("2010-09-01", "month"), ("2011-01-01", "year"), ("2001-11-01", "month"), ("2010-08-01", "month"),
                   ("1995-01-01", "day"), (None, None), ("2011-08-01", "second"), ("2011-03-12", "day")]
    b = spark.createDataFrame([("true",), ("non",), ("maybe",)], "o string")
    assert [r[0] for r in b.select(parse_bool(F.col("o"))).collect()] == [True, False, None]


def test_resolve_individuals(spark):
    rows = [(*GRAPH, 0, ":SeuilDeKembs", "rdf:type", ":weir", "iri", None, None, "ok"),
            (*GRAPH, 1, ":seuil_de_kembs", "skos:prefLabel", "x", "literal", None, None, "ok"),
            (*GRAPH, 2, ":Other", ":associatedTo", ":SéuilDeKembs", "iri", None, None, "ok")]
    df = spark.createDataFrame(rows, "run_id string, regime string, model string, doc_id string, stmt_idx long, s string, "
                                     "p string, o string, o_kind string, o_datatype string, o_lang string, parse_status string")
    canon = C.canonicalise(df, builtin_ontology(spark))
    m = {r.s_key: (r.canonical, r.n_variants) for r in C.resolve_individuals(canon).collect()}
    assert m["seuil_de_kembs"] == ("SeuilDeKembs", 3) and m["SéuilDeKembs"][0] == "SeuilDeKembs"


def test_names_of_other_scripts_stay_apart(spark):
    rows = [(*GRAPH, i, s, "rdf:type", ":weir", "iri", None, None, "ok")
            for i, s in enumerate([":Плотина", ":плотина", ":Река", ":Мост", ":---", ":..", ":Шлюз"])]
    df = spark.createDataFrame(rows, "run_id string, regime string, model string, doc_id string, stmt_idx long, s string, "
                                     "p string, o string, o_kind string, o_datatype string, o_lang string, parse_status string")
    m = {r.s_key: (r.canonical, r.n_variants) for r in C.resolve_individuals(C.canonicalise(df, builtin_ontology(spark))).collect()}
    assert m["плотина"] == ("Плотина", 2) and m["Река"] == ("Река", 1) and m["Мост"] == ("Мост", 1) and m["Шлюз"] == ("Шлюз", 1)
    assert m["---"] == ("---", 1) and m[".."] == ("..", 1)


def test_heights_with_units(spark):
    rows = [(*GRAPH, 0, ":a", ":hasHeight", "120 cm", "literal", None, None, "ok"), (*GRAPH, 1, ":b", ":hasHeight", "0.9 m", "literal", None, None, "ok"),
            (*GRAPH, 2, ":c", ":hasHeight", "3 ft", "literal", None, None, "ok"), (*GRAPH, 3, ":d", ":hasHeight", "1500 mm", "literal", None, None, "ok"),
            (*GRAPH, 4, ":a", ":isImpassable", "true", "literal", None, None, "ok")]
    df = spark.createDataFrame(rows, "run_id string, regime string, model string, doc_id string, stmt_idx long, s string, "
                                     "p string, o string, o_kind string, o_datatype string, o_lang string, parse_status string")
    onto = builtin_ontology(spark)
    got = {r.s_key: (r.height and float(r.height), r.status) for r in C.derive_impassable(C.canonicalise(df, onto), onto).collect()}
    assert got == {"a": (1.2, "agree"), "b": (0.9, "no_assertion"), "c": (None, "unknown_unit"), "d": (1.5, "no_assertion")}


def test_restrictions_keep_every_filler(spark):
    onto = builtin_ontology(spark)
    res = {(r.cls, r.property): [] for r in onto.restriction.collect()}
    for r in onto.restriction.collect():
        res[(r.cls, r.property)].append(r.filler)
    (cls, prop), fillers = next((k, v) for k, v in sorted(res.items()) if ":" not in v[0])
    rows = [(*GRAPH, 0, ":x", "rdf:type", ":" + cls, "iri", None, None, "ok"), (*GRAPH, 1, ":y", "rdf:type", ":" + fillers[0], "iri", None, None, "ok"),
            (*GRAPH, 2, ":x", ":" + prop, ":y", "iri", None, None, "ok"), (*GRAPH, 3, ":z", "rdf:type", ":" + cls, "iri", None, None, "ok"),
            (*GRAPH, 4, ":z", ":" + prop, ":nobody", "iri", None, None, "ok")]
    df = spark.createDataFrame(rows, "run_id string, regime string, model string, doc_id string, stmt_idx long, s string, "
                                     "p string, o string, o_kind string, o_datatype string, o_lang string, parse_status string")
    got = {(r.s_key, r.property, r.filler): (r.present, r.filled) for r in C.check_restrictions(C.canonicalise(df, onto), onto).collect()}
    assert got[("x", prop, fillers[0])] == (True, True) and got[("z", prop, fillers[0])] == (True, False)
    assert all((("x", prop, f) in got) for f in fillers) and any(v == (False, False) for v in got.values())


def test_describe(spark):
    d = describe_ontology(builtin_ontology(spark)).first()[0]
    assert d.startswith("Classes :\n") and '    - "verticalSlotPassage": subclass of basinPasses\n' in d
    assert '    - "isLocatedOn": restorationMeasure|structure -> geographicZone|waterBody\n' in d
