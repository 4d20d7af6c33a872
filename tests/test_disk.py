"""What a job keeps on disk: nothing is stored or moved twice.  Checked on plans
and on small rows."""

import glob

from pyspark.sql import functions as F

from graphloom.operators import turtle as T
from graphloom.session import stored
from graphloom.sinks import writers as W
from graphloom.sources import driver_views as V
from graphloom.sources import files as SRC

GRAPH_ROW = "regime string, model string, doc_id string, s string, p string, o string, o_kind string, o_datatype string, o_lang string"
KEYS = ["regime", "model", "doc_id"]


def test_written_graphs_are_packed_and_come_back(spark, tmp_path):
    rows = [("r", "m", "d", f":s{i}", ":p", 'x "y"' if i % 3 else ":o", "literal" if i % 3 else "iri", None, None) for i in range(50)]
    blocks = T.to_turtle(spark.createDataFrame(rows, GRAPH_ROW), KEYS, header=True)
    W.write_graphs(blocks, f"{tmp_path}/g", fmt="turtle")
    files = glob.glob(f"{tmp_path}/g/**/part-*", recursive=True)
    assert files and all(f.endswith(".json.gz") for f in files)
    got = T.triples_of(T.parse_graphs(SRC.read_packed_graphs(spark, f"{tmp_path}/g"), "text", KEYS))
    assert {(r["s"], r["o"], r["o_kind"]) for r in got.collect()} == {(r[3], r[5], r[6]) for r in rows}


def test_texts_are_read_both_ways_without_a_stored_copy(spark):
    import os

    kept = f"{spark.sparkContext.getCheckpointDir().split(':', 1)[-1]}/io"
    before = set(os.listdir(kept)) if os.path.isdir(kept) else set()
    d = spark.createDataFrame([(1, ":a :p :b , :c ."), (2, ':a :p "q\\"r"@en ; :q 5 .'), (3, None), (4, ":a :p"), (5, ':a :p "\u0002" .')], "k int, text string")
    out = T.parse_graphs(d, "text", ["k"], prefixes=T.PREFIXES)
    got = {(r.k, r.stmt_idx, r.s, r.p, r.o, r.o_kind, r.o_lang) for r in T.triples_of(out).where("k <> 4").collect()}
    assert got == {(1, 0, ":a", ":p", ":b", "iri", None), (1, 1, ":a", ":p", ":c", "iri", None), (2, 0, ":a", ":p", 'q"r', "literal", "en"),
                   (2, 1, ":a", ":q", "5", "literal", None), (5, 0, ":a", ":p", "\u0002", "literal", None)}
    assert 4 in {r.k for r in T.diagnostics_of(out).collect()}
    assert before == (set(os.listdir(kept)) if os.path.isdir(kept) else set())


def test_stored_tables_are_packed(spark):
    d = stored(spark.range(10), "small")
    assert d.count() == 10 and all(".zstd." in f for f in d.inputFiles())


def test_lines_are_moved_once_to_their_orders(spark, tmp_path):
    one = {"customer": "1L c_custkey, 'n' c_name, 1L c_nationkey, 'HOUSEHOLD' c_mktsegment",
           "orders": "1L o_orderkey, 1L o_custkey, timestamp'1996-01-02 00:00:00' o_orderdate, 'F' o_orderstatus, 1.5D o_totalprice",
           "lineitem": "1L l_orderkey, 1L l_linenumber, 1L l_partkey, 1L l_suppkey", "part": "1L p_partkey, 'p' p_name, 30 p_size",
           "supplier": "1L s_suppkey, 's' s_name, 1L s_nationkey", "nation": "1L n_nationkey, 'x' n_name"}
    for name, cols in one.items():
        spark.sql(f"select {cols}").write.parquet(f"{tmp_path}/{name}.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kg = V.kg_triples(spark, str(tmp_path)).where(F.col("p").isin(":associatedTo", ":hasMainContractor"))
        plan = kg._jdf.queryExecution().executedPlan().toString()
        assert sum("Exchange hashpartitioning(l_orderkey" in x for x in plan.split("\n")) == 1
        assert kg.count() == 2 and not any("Exchange RoundRobin" in x and "l_orderkey" in x for x in plan.split("\n"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _canon(spark, rows):
    from graphloom.operators.conform import canonicalise
    from graphloom.operators.ontology import builtin_ontology

    full = [("r", "z", "m", g, i, *r) for i, (g, *r) in enumerate(rows)]
    t = spark.createDataFrame(full, "run_id string, regime string, model string, doc_id string, stmt_idx long, s string, p string, o string, "
                                    "o_kind string, o_datatype string, o_lang string")
    onto = builtin_ontology(spark)
    return canonicalise(t, onto), onto


def test_components_of_small_graphs_are_found_where_they_lie(spark, monkeypatch):
    from graphloom.operators import linking as L

    made = []
    monkeypatch.setattr(L, "stored", lambda df, name: (made.append(name), df.localCheckpoint())[1])
    edges = spark.createDataFrame([("g", "c", "b"), ("g", "b", "é"), ("g", "x", "x"), ("h", "b", "a"), (None, "p", "q"), ("g", None, "b"), *[("big", f"n{i}", f"n{i + 1}") for i in range(20)]],
                                  "k string, a string, b string")
    nodes = spark.createDataFrame([("g", "alone"), ("g", "c"), ("g", None), (None, "q"), ("big", "n0"), ("big", "m")], "k string, node string")
    want = {("g", "c"): "b", ("g", "b"): "b", ("g", "é"): "b", ("g", "alone"): "alone", ("g", None): None, ("h", "a"): "a", ("h", "b"): "a",
            (None, "q"): "q", ("big", "m"): "m", **{("big", f"n{i}"): "n0" for i in range(21)}}
    for left, stores in ((1000, False), (10, True), (0, True)):
        monkeypatch.setattr(L, "LEFT", left)
        made.clear()
        got = [((r.k, r.node), r.component) for r in L.connected_components(edges, ["k"], nodes).collect()]
        assert dict(got) == want and len(got) == len(want) and bool(made) == stores


def test_names_of_a_graph_are_moved_once(spark, monkeypatch):
    from graphloom.operators import conform as C
    from graphloom.operators import skew

    canon, _ = _canon(spark, [("g", ":Weir_1", ":includes", ":weir-1", "iri", None, None), ("g", ":--", ":includes", "x", "literal", None, None),
                              ("h", ":weir1", ":includes", None, "iri", None, None), ("h", ":weir1", ":includes", ":weir1", "iri", None, None)])
    want = {("g", "Weir_1"): ("Weir_1", 2), ("g", "weir-1"): ("Weir_1", 2), ("g", "--"): ("--", 1), ("h", "weir1"): ("weir1", 1)}
    made = []
    monkeypatch.setattr(C, "stored", lambda df, name: (made.append(name), df)[1])
    for whole in (100, 2, 0):
        monkeypatch.setattr(skew, "WHOLE", whole)
        got = C.resolve_individuals(canon).collect()
        assert {(r.doc_id, r.s_key): (r.canonical, r.n_variants) for r in got} == want and len(got) == 4
        assert bool(made) == (whole < 3)
    monkeypatch.setattr(skew, "WHOLE", 100)
    plan = C.resolve_individuals(canon)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def _checked(spark):
    """Two graphs with typed and untyped subjects and objects, literals, nulls and repeats."""
    rows = [("g", ":m", "rdf:type", ":restorationMeasure", "iri", None, None), ("g", ":m", "rdf:type", ":restorationMeasure", "iri", None, None),
            ("g", ":w", "rdf:type", ":weir", "iri", None, None), ("g", ":w", "rdf:type", ":noSuch", "iri", None, None), ("g", ":o", "rdf:type", ":projectOwner", "iri", None, None),
            ("g", ":f", "rdf:type", ":fishLift", "iri", None, None), ("g", ":d", "rdf:type", ":dam", "iri", None, None), ("g", None, "rdf:type", ":fishLift", "iri", None, None),
            ("g", ":f", ":associatedTo", ":d", "iri", None, None), ("g", ":f", ":associatedTo", ":o", "iri", None, None), ("g", ":f", ":hasCost", "5", "literal", "xsd:decimal", None),
            ("g", ":f", ":realizedIn", "x", "literal", None, None), ("g", ":f", ":associatedMeas", None, "iri", None, None), ("g", None, ":hasCost", "5", "literal", "xsd:decimal", None)]
    for s in (":m", ":w", ":u", None):
        rows += [("g", s, ":isManagedBy", ":o", "iri", None, None), ("g", s, ":isManagedBy", ":u", "iri", None, None), ("g", s, ":isManagedBy", "x", "literal", None, None),
                 ("g", s, ":hasCost", "1", "literal", "xsd:decimal", None), ("g", s, ":hasCost", "1", "literal", None, None), ("g", s, ":hasCost", ":o", "iri", None, None),
                 ("g", s, ":startsAt", "x", "literal", "xsd:string", None), ("g", s, ":isManagedBy", None, "iri", None, None), ("g", s, ":nothing", ":o", "iri", None, None)]
    rows += [("h", s, p, o, *r) for _, s, p, o, *r in rows if s in (":m", ":f")] + [(None, *r[1:]) for r in rows if r[1] in (":m", ":f", ":o")]
    return _canon(spark, rows)


def test_domain_and_range_are_the_same_gathered_and_joined(spark, monkeypatch):
    from collections import Counter

    from graphloom.operators import conform as C
    from graphloom.operators import skew

    canon, onto = _checked(spark)
    canon = canon.localCheckpoint()
    for strict in (True, False):
        found = []
        for whole in (1000, 12, 0):
            monkeypatch.setattr(skew, "WHOLE", whole)
            found.append(Counter(map(tuple, C.check_domain_range(canon, onto, strict).collect())))
        assert found[0] == found[1] == found[2] and sum(found[0].values()) == canon.where("p_match in ('exact', 'case', 'alias')").count()
    assert {(k[8], k[9]) for k in found[0]} >= {("ok", "ok"), ("violation", "ok"), ("untyped", "untyped"), ("ok", "violation"), ("ok", "untyped_literal")}


def test_restrictions_are_the_same_gathered_and_joined(spark, monkeypatch):
    from collections import Counter

    from graphloom.operators import conform as C
    from graphloom.operators import skew

    canon, onto = _checked(spark)
    canon, found = canon.localCheckpoint(), []
    for whole in (1000, 12, 0):
        monkeypatch.setattr(skew, "WHOLE", whole)
        rows = C.check_restrictions(canon, onto).select("doc_id", "s_key", "property", "filler", "present", "filled").collect()
        found.append(Counter(map(tuple, rows)))
    assert found[0] == found[1] == found[2] and max(found[0].values()) == 1
    got = {(k[2], k[3]): k[4:] for k in found[0] if k[:2] == ("g", "f")}
    assert got[("associatedTo", "structure")] == (True, True) and got[("hasCost", "xsd:decimal")] == (True, True)
    assert got[("realizedIn", "geographicZone")] == (True, False) and got[("isSubjectTo", "restorationMonitoring")] == (False, False)


def test_statements_of_a_graph_are_moved_once(spark):
    from graphloom.operators import conform as C

    canon, onto = _checked(spark)
    canon = canon.localCheckpoint()
    for out in (C.check_domain_range(canon, onto, columns=()), C.check_restrictions(canon, onto)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(run_id") == 1 and plan.count("Window") >= 2
        assert not any("Exchange hashpartitioning(_cls" in x for x in plan.split("\n"))


def test_files_of_a_tree_are_listed_by_tasks(spark, tmp_path, monkeypatch):
    """The same rows as Spark's own reader, odd names among them, and no list of files on the driver."""
    from graphloom.sources import files as S

    texts = {"0001/a b.txt": b"x\r\ny", "0001/50%25 + [é] .txt": "ü".encode(), "0002/deep/c.txt": b"\xff\x00z", "0002/empty.txt": b"", "0002/.hidden.txt": b"h",
             "_skipped/d.txt": b"d", "x=1/_k=2/e.txt": b"e", "top.txt": b"t", "0001/f.md": b"no", "0002/#q?.txt": b"q"}
    for name, text in texts.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(text)
    got = S._whole_files(spark, str(tmp_path), "*.txt", recursive=True)
    assert "FileScan" not in got._jdf.queryExecution().executedPlan().toString()
    cols = ["file_name", F.regexp_extract("file_path", "([^/]+)/[^/]+$", 1).alias("folder"), F.hex(F.col("value").cast("binary")).alias("v")]
    mine = sorted(tuple(r) for r in got.select(*cols).collect())
    monkeypatch.setattr(S, "_store", lambda root: None)
    assert mine == sorted(tuple(r) for r in S._whole_files(spark, str(tmp_path), "*.txt", recursive=True).select(*cols).collect()) and len(mine) == 6


def test_saved_answers_are_read_by_tasks_and_long_ones_in_pieces(spark, tmp_path):
    (tmp_path / "0001" / "answers").mkdir(parents=True)
    for i in range(6):
        (tmp_path / "0001" / "answers" / f"Site_({i})_m.ttl").write_text(f':s{i} :p "{"x" * 400_000}\\"" ; :q {i} .\n')
    g = SRC.read_graphs(spark, str(tmp_path), models=["m"])
    assert "FileScan" not in g._jdf.queryExecution().executedPlan().toString()
    one = g.select("doc_id", "text").coalesce(1)
    got = {(r.doc_id, r.stmt_idx, r.s, r.p, r.n) for r in T.triples_of(T.parse_graphs(one, "text", ["doc_id"])).select("*", F.length("o").alias("n")).collect()}
    assert got == {x for i in range(6) for x in ((f"Site_{i}", 0, f":s{i}", ":p", 400_001), (f"Site_{i}", 1, f":s{i}", ":q", 1))}
