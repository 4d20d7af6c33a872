import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from graphloom.functions import prompts as PR
from graphloom.operators.generate import generate, generate_once
from graphloom.sinks import writers as W
from graphloom.sources import files as SRC
from graphloom.sources.ontology import read_ontology


class Boom:
    def generate(self, prompt, messages, options):
        if "bad" in prompt:
            raise ValueError("model down")
        return "ok:" + str(options.get("temperature"))


# ship the test backend to the Python workers by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _prompts(spark, texts):
    df = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "doc_id string, text string")
    p = PR.build_prompts(df, "fine_tuned").withColumn("model", F.lit("m"))
    return p.withColumn("prompt", PR.render_chat("messages", True)).select("doc_id", "model", "prompt", "messages")


def test_keep_going_and_fail(spark):
    p = _prompts(spark, ["good", "bad"])
    out = {r.doc_id: (r.response, r.error) for r in generate(p, Boom, {"temperature": 0.7}, keys=["doc_id", "model"]).collect()}
    assert out["d0"] == ("ok:0.7", None) and out["d1"][0] is None and "model down" in out["d1"][1]
    with pytest.raises(Exception):
        generate(p, Boom, keys=["doc_id", "model"], on_error="fail").collect()


def test_generate_once_resumes(spark, tmp_dir):
    path = os.path.join(tmp_dir, "resp")
    p = _prompts(spark, ["one", "two"])
    first = generate_once(p.where("doc_id = 'd0'"), path, ["doc_id", "model"], backend="hash")
    assert first.count() == 1
    both = generate_once(p, path, ["doc_id", "model"], backend="hash")
    assert both.count() == 2 and both.select("doc_id").distinct().count() == 2


def test_corpus_and_graph_files(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "corpus")
    os.makedirs(folder)
    for name, text in [("case1.txt", "a\r\nb"), ("case4_en.txt", "english"), ("skip.md", "x")]:
        with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as f:
            f.write(text)
    c = {r.doc_id: (r.lang, r.text) for r in SRC.read_corpus(spark, folder).collect()}
    assert c == {"case1": ("fr", "a\nb"), "case4_en": ("en", "english")}
    root = os.path.join(tmp_dir, "graphs", "one_shot_outputs")
    os.makedirs(root)
    for name in ["case1_qwen2.5_14b.ttl", "Passes_de_Kembs_(poissons__castors)_llama3.1_8b.ttl", "case2_llama_3_70b.ttl"]:
        with open(os.path.join(root, name), "w") as f:
            f.write(":a a :dam .")
    g = SRC.read_graphs(spark, os.path.join(tmp_dir, "graphs"), models=["qwen2.5:14b", "llama3.1:8b", "llama-3-70b", "qwen2:7b"])
    got = {(r.regime, r.model, r.doc_id) for r in g.collect()}
    assert got == {("one_shot_outputs", "qwen2.5:14b", "case1"), ("one_shot_outputs", "llama3.1:8b", "Passes_de_Kembs_poissons__castors"),
                   ("one_shot_outputs", "llama-3-70b", "case2")}


def test_timings_append_and_read(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = spark.createDataFrame([("zero_shot", "qwen2:7b", "case1.txt", 87.444)], "regime string, model string, file_name string, seconds double")
    W.write_timings(df, path, mode="append")
    W.write_timings(df, path, mode="append")
    t = SRC.read_timings(spark, path).collect()
    assert len(t) == 2 and t[0].model == "qwen2:7b" and abs(t[0].seconds - 87.44) < 1e-9


def test_a_rerun_replaces_its_timings(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = spark.createDataFrame([("z", "qwen2:7b", "a.txt", 1.0), ("z", "qwen2:7b", "b.txt", 2.0), ("z", "llama3:8b", "a.txt", 3.0)],
                               "regime string, model string, file_name string, seconds double")
    W.write_timings(df, path)
    W.write_timings(df.where("model = 'qwen2:7b'").withColumn("seconds", df.seconds + 10), path)
    assert sorted((r.model, r.seconds) for r in SRC.read_timings(spark, path).collect()) == [("llama3:8b", 3.0), ("qwen2:7b", 11.0), ("qwen2:7b", 12.0)]


def test_read_ontology(spark, tmp_dir):
    from graphloom.vocab import ONTO_NS as NS
    ttl = f"""@prefix owl: <http://www.w3.org/2002/07/owl#> .
@prefix rdfs: <http://www.w3.org/2000/01/rdf-schema#> .
@prefix skos: <http://www.w3.org/2004/02/skos/core#> .
@prefix xsd: <http://www.w3.org/2001/XMLSchema#> .
<{NS}fishway> a owl:Class ;
    rdfs:subClassOf [ a owl:Restriction ; owl:onProperty <{NS}hasCost> ;
            owl:someValuesFrom xsd:decimal ], <{NS}restorationOperation> ;
    skos:altLabel "passe à poissons"@fr ; skos:prefLabel "fishway"@en .
<{NS}hasCost> a owl:DatatypeProperty ;
    rdfs:domain <{NS}restorationMeasure> ; rdfs:range xsd:decimal .
"""
    path = os.path.join(tmp_dir, "o.ttl")
    with open(path, "w", encoding="utf-8") as f:
        f.write(ttl)
    o = read_ontology(spark, path)
    assert [tuple(r) for r in o.subclass.collect()] == [("fishway", "restorationOperation")]
    assert [tuple(r) for r in o.restriction.collect()] == [("fishway", "hasCost", "xsd:decimal")]
    assert [tuple(r) for r in o.range.collect()] == [("hasCost", "xsd:decimal")]
    assert {tuple(r) for r in o.classes.collect()} == {("fishway", "fishway", "passe à poissons", "fr")}


def test_failed_rows_are_tried_again(spark, tmp_dir):
    from graphloom.operators.generate import generate_once
    p = spark.createDataFrame([(i, f"prompt {i}") for i in range(40)], "k long, prompt string")
    path = os.path.join(tmp_dir, "answers")
    first = generate_once(p, path, ["k"], backend="picky", messages_col=None)
    bad = first.where("error is not null").count()
    assert 0 < bad < 40 and first.count() == 40
    again = generate_once(p, path, ["k"], backend="hash", messages_col=None)
    assert again.count() == 40 and again.where("error is not null").count() == 0
    assert spark.read.parquet(path).count() == 40 + bad


def test_an_unreadable_table_of_answers_raises(spark, tmp_dir):
    from graphloom.operators.generate import generate_once
    path = os.path.join(tmp_dir, "broken")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.parquet"), "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        generate_once(spark.createDataFrame([(1, "p")], "k long, prompt string"), path, ["k"], messages_col=None)


def test_batch_backend(spark):
    from graphloom.operators.generate import generate
    p = spark.createDataFrame([(1, "aB"), (2, "Cd")], "k long, prompt string").coalesce(1)
    make = lambda: type("B", (), {"generate_batch": lambda s, a, m, o: [x.upper() for x in a]})()
    assert {r.k: r.response for r in generate(p, make, keys=["k"], messages_col=None).collect()} == {1: "AB", 2: "CD"}


def test_scores_are_strict(spark):
    from graphloom.operators.generate import parse_score
    answers = ['{"score": 4}', "Score: 10", "On criterion 2 of 3: 4", '{"score": 9}', '```json\n{"score": 3.5}\n```', '{"note": 1}', "", None]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(answers)], "i long, response string")
    got = [(r.s.score, r.s.status) for r in df.orderBy("i").select(parse_score().alias("s")).collect()]
    assert got == [(4.0, "ok"), (None, "not_json"), (None, "not_json"), (None, "out_of_range"), (3.5, "ok"), (None, "no_score"), (None, "empty"), (None, "empty")]


def test_a_corpus_is_written_as_files_and_read_back(spark, tmp_dir):
    rows = [("001", "a\nb"), ("x_en", "é\r\n"), ("a/b%2F", "c"), ("é +", "d"), ("twice", "2"), ("twice", "1"), ("none", None)]
    W.write_corpus(spark.createDataFrame(rows, "doc_id string, text string"), f"{tmp_dir}/corpus", folders=3)
    back = SRC.read_corpus(spark, f"{tmp_dir}/corpus", folders=True)
    got = {r.doc_id: (r.file_name, r.lang, r.text) for r in back.collect()}
    assert got == {"001": ("001.txt", "fr", "a\nb\n"), "x_en": ("x_en.txt", "en", "é\n\n"), "a/b%2F": ("a/b%2F.txt", "fr", "c\n"),
                   "é +": ("é +.txt", "fr", "d\n"), "twice": ("twice.txt", "fr", "1\n2\n"), "none": ("none.txt", "fr", "\n")}
    # few folders, and no commit of a folder per document
    import os
    assert len(os.listdir(f"{tmp_dir}/corpus")) <= 3
