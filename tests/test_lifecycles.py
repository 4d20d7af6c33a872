import json
import os

from pyspark.sql import functions as F

from graphloom.plans import lifecycles as LC


def _corpus(spark):
    return spark.createDataFrame([("case1", "Seuil de Kembs, 2010."), ("case4_en", "A fish pass " * 400)],
                                 "doc_id string, text string")


def test_zero_shot_is_answered_once(spark, tmp_dir):
    out = os.path.join(tmp_dir, "zs")
    r = LC.zero_shot(_corpus(spark), ["qwen2:7b", "mistral:latest"], out, template=True)
    assert r.count() == 4 and set(r.select("regime").distinct().toPandas().regime) == {"zero_shot_template"}
    again = LC.zero_shot(_corpus(spark), ["qwen2:7b", "mistral:latest"], out, template=True)
    assert again.count() == 4  # resumed: nothing answered twice


def test_one_shot_chunks_then_translates(spark, tmp_dir):
    out = os.path.join(tmp_dir, "os")
    r = LC.one_shot(_corpus(spark), ["qwen2:7b"], out)
    assert r.count() == 2
    p1 = spark.read.parquet(os.path.join(out, "pass1"))
    assert p1.where("doc_id = 'case4_en'").count() == 2  # 4800 characters -> two chunks


def test_fine_tuned_cuts_and_cleans(spark, tmp_dir):
    r = LC.fine_tuned(_corpus(spark), "llama-3-70b-populate-ontology", os.path.join(tmp_dir, "ft"), backend="echo")
    rows = {x.doc_id: x for x in r.collect()}
    # the echo backend answers with the prompt: the text after the first "assistant" marker is the open turn
    assert rows["case1"].cut_status == "ok"


def test_training_rows(spark, tmp_dir):
    rows = [(i, json.dumps({"messages": [{"role": "user", "content": "q " * (i % 7 + 1)},
                                         {"role": "assistant", "content": "a"}]})) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, raw string")
    t = LC.training_rows(df, os.path.join(tmp_dir, "tr"), take=143)
    assert t.count() == 143
    assert t.where("split = 'test'").count() == 15
    assert t.select("batch_id").distinct().count() == 143


def test_a_failed_chunk_is_carried_as_an_error(spark, tmp_dir):
    docs = spark.createDataFrame([(f"d{i}", f"text {i} " * 600) for i in range(12)], "doc_id string, text string")
    r = LC.one_shot(docs, ["qwen2:7b"], os.path.join(tmp_dir, "bad"), backend="picky", options={"fail_below": 3})
    rows = {x.doc_id: x for x in r.collect()}
    assert len(rows) == 12
    failed = {x.doc_id for x in spark.read.parquet(os.path.join(tmp_dir, "bad", "pass1")).where("error is not null").collect()}
    assert failed and all(rows[d].response is None and rows[d].error.startswith("chunk ") for d in failed)


def test_the_cap_keeps_the_opened_turn(spark, tmp_dir):
    docs = spark.createDataFrame([("long", "one two\nthree four five"), ("short", "a\nb")], "doc_id string, text string")
    r = LC.fine_tuned(docs, "m", os.path.join(tmp_dir, "cap"), backend="echo", max_tokens=3)
    assert {x.doc_id: x.cut_status for x in r.collect()} == {"long": "ok", "short": "ok"}
    saved = {x.doc_id: x.response for x in spark.read.parquet(os.path.join(tmp_dir, "cap", "responses")).collect()}
    assert "one two three<" in saved["long"] and "a\nb<" in saved["short"]
