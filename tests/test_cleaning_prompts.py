from pyspark.sql import functions as F

from graphloom.functions import prompts as PR
from graphloom.functions.cleaning import clean_response, flag_placeholders, placeholder_count
from graphloom.prompt_texts import GRAPH_TEMPLATE
from graphloom.vocab import MODELS


def test_clean_response_formats(spark):
    rows = [("fenced", "Here you go:\n```turtle\n@prefix : <x#> .\n:a a :dam .\n```\nHope it helps."),
            ("two", "```\n:a a :dam .\n```\ntext\n```ttl\n:b a :weir .\n```"),
            ("xml", "```turtle\n<rdf:RDF xmlns:rdf=\"x\"></rdf:RDF>\n```"),
            ("prose", "The text describes a fish pass built in 2010."),
            ("empty", "   ")]
    df = spark.createDataFrame(rows, "k string, t string")
    got = {r.k: (r.c.body, r.c.format) for r in df.select("k", clean_response("t").alias("c")).collect()}
    assert got["fenced"] == ("@prefix : <x#> .\n:a a :dam .", "turtle")
    assert got["two"] == (":a a :dam .\n\n:b a :weir .", "turtle")
    assert got["xml"][1] == "rdfxml" and got["prose"][1] == "prose" and got["empty"][1] == "empty"


def test_placeholders(spark):
    df = spark.createDataFrame([(GRAPH_TEMPLATE,)], "t string")
    assert df.select(placeholder_count("t")).first()[0] > 10
    tr = spark.createDataFrame([(":<StructureInstance>", ":hasHeight", "x"), (":a", ":b", ":c")], "s string, p string, o string")
    assert [r.placeholder for r in flag_placeholders(tr).collect()] == [True, False]


def test_expand_models_and_regimes(spark):
    docs = spark.createDataFrame([("d1", "t1"), ("d2", "t2")], "doc_id string, text string")
    x = PR.expand_models(docs, MODELS, partitions=4)
    assert x.count() == 2 * len(MODELS) and x.rdd.getNumPartitions() == 4
    for regime in PR.REGIMES:
        m = PR.build_prompts(docs, regime).first().messages
        assert [r.role for r in m] == ["system", "user"] and m[1].content == "t1"
    z = PR.system_text("zero_shot_template")
    assert GRAPH_TEMPLATE in z and "{ontology}" not in z and "{template}" not in z
    t = PR.translate_text()
    assert ":PasseAPoissons" in t and "{example}" not in t


def test_repeated_prefix_lines_are_dropped(spark):
    from pyspark.sql import functions as F

    from graphloom.functions.cleaning import clean_response
    t = "@prefix : <http://a/> .\n:x a :y .\n@prefix : <http://a/> .\n@prefix b: <http://b/> .\n:x a :y ."
    df = spark.createDataFrame([(1, t), (2, "no prefix\nno prefix"), (3, None)], "i int, t string")
    got = {r.i: r.b for r in df.select("i", clean_response(F.col("t"))["body"].alias("b")).collect()}
    assert got == {1: "@prefix : <http://a/> .\n:x a :y .\n@prefix b: <http://b/> .\n:x a :y .", 2: "no prefix\nno prefix", 3: None}
