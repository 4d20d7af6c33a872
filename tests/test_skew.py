"""Joins on hot keys: same rows as a plain join, spread over all tasks."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from graphloom.operators.conform import canonicalise, check_domain_range, check_restrictions, resolve_individuals
from graphloom.operators.linking import connected_components
from graphloom.operators.ontology import builtin_ontology
from graphloom.operators.skew import hot_keys, split_join


@pytest.fixture
def without_aqe(spark):
    names = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")
    before = {n: spark.conf.get(n) for n in names}
    for n, v in zip(names, ("false", "-1", "16")):
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def rows_by_task(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_hot_keys_are_found_and_others_are_not(spark, without_aqe):
    d = spark.range(30000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), (F.col("id") % 4000).alias("m"), F.lit("g").alias("g"))
    one, two, both = hot_keys(d, ["k"], ["m"], ["g", "k"])
    assert one == [spark.range(1).select(F.xxhash64(F.lit(-1).cast("long"))).first()[0]]
    assert two == [] and len(both) == 1
    assert hot_keys(d.limit(0), ["k"]) == [[]]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_join_is_a_join_spread_over_tasks(spark, without_aqe, how):
    big = spark.range(30000).select(F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 900).alias("k"), "id")
    small = spark.createDataFrame([(k, w) for k in [-1, *range(0, 900, 2)] for w in "ab"], "k long, w string")
    plain, split = big.join(small, ["k"], how), split_join(big, small, ["k"], how)
    assert split.columns == plain.columns
    assert Counter(map(tuple, split.collect())) == Counter(map(tuple, plain.collect()))
    if how == "inner":
        assert max(rows_by_task(split)) < 3 * sum(rows_by_task(split)) / 16
        assert max(rows_by_task(plain)) > 5 * sum(rows_by_task(plain)) / 16


def test_other_joins_are_refused(spark):
    with pytest.raises(ValueError):
        split_join(spark.range(1), spark.range(1), ["id"], "right")


def triples(spark, rows):
    full = [("r", "z", "m", "g", i, *r) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, "run_id string, regime string, model string, doc_id string, stmt_idx long, s string, p string, o string, "
                                       "o_kind string, o_datatype string, o_lang string")


def hub_graph(spark, n=600):
    """Every measure is managed by one owner: a third of all statements have one object."""
    rows = [(":owner", "rdf:type", ":projectOwner", "iri", None, None)]
    for i in range(n):
        rows += [(f":m{i}", "rdf:type", ":restorationMeasure", "iri", None, None), (f":m{i}", ":isManagedBy", ":owner", "iri", None, None),
                 (f":m{i}", ":hasCost", str(i), "literal", "xsd:decimal", None)]
    return triples(spark, rows)


def test_domain_and_range_on_a_hub(spark, without_aqe):
    onto = builtin_ontology(spark)
    out = check_domain_range(canonicalise(hub_graph(spark), onto), onto)
    got = Counter((r.p_canon, r.domain_status, r.range_status) for r in out.collect())
    assert sum(got.values()) == 1200 and len(got) == 2
    assert {k[0]: v for k, v in got.items()} == {":isManagedBy": 600, ":hasCost": 600}


def test_restrictions_and_names_on_a_hub(spark, without_aqe):
    onto = builtin_ontology(spark)
    canon = canonicalise(hub_graph(spark), onto)
    got = check_restrictions(canon, onto).collect()
    assert len(got) == len({(r.s_key, r.property, r.filler) for r in got})
    names = [(f":Hub{'-' * i}", ":isManagedBy", ":x", "iri", None, None) for i in range(400)] + [(":other", ":isManagedBy", ":x", "iri", None, None)]
    found = {r.s_key: (r.canonical, r.n_variants) for r in resolve_individuals(canonicalise(triples(spark, names), onto)).collect()}
    assert found["Hub---"] == ("Hub", 400) and found["other"] == ("other", 1)


def test_components_of_a_star(spark, without_aqe):
    edges = spark.range(2000).select(F.lit(5000).cast("long").alias("a"), F.col("id").alias("b")) \
        .unionByName(spark.createDataFrame([(9000, 9001), (9001, 9002)], "a long, b long"))
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in [*range(2000), 5000]}, 9000: 9000, 9001: 9000, 9002: 9000}


def test_components_by_contraction_match_union_find(spark, monkeypatch):
    """Every round on Spark: a path, a star, repeated edges, loops, nulls, names of
    two graphs, and nodes without an edge; a path takes few rounds."""
    import random

    from graphloom.operators import linking as L

    monkeypatch.setattr(L, "LEFT", 0)
    made = []
    monkeypatch.setattr(L, "stored", lambda df, name: (made.append(name), df.localCheckpoint())[1])
    rnd = random.Random(5)
    pairs = [("g", f"p{i:04}", f"p{i + 1:04}") for i in range(1500)] + [("g", "hub", f"leaf{i}") for i in range(300)]
    pairs += [("h", f"p{rnd.randrange(300):04}", f"p{rnd.randrange(300):04}") for _ in range(200)] + [("g", "p0000", "p0001"), ("g", "q", "q")]
    nodes = [("g", "alone"), ("g", "q"), ("g", "p0003"), (None, "p0003"), ("g", None)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for g, a, b in pairs:
        x, y = sorted((find((g, a)), find((g, b))))
        up[y] = x
    want = {(g, a): find((g, a))[1] for g, a, b in pairs for a in (a, b) if not (g == "h" and len({p for p in pairs if p[0] == "h" and a in p[1:] and p[1] != p[2]}) == 0)}
    want.update({(g, n): find((g, n))[1] if (g, n) in up else n for g, n in nodes})
    null = [(None, "a", "b"), ("g", None, "b"), ("g", "a", None)]
    got = connected_components(spark.createDataFrame(pairs + null, "g string, a string, b string"), ["g"], spark.createDataFrame(nodes, "g string, node string")).collect()
    assert {(r.g, r.node): r.component for r in got} == want and len(got) == len(want)
    assert made.count("contraction") < 25
