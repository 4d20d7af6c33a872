from pyspark.sql import functions as F

from graphloom.functions.text import chunk_text, frame_chunk_response, output_name, strip_prompt_echo
from graphloom.functions.timefmt import format_duration, parse_timing, timing_line


def test_chunk_edges(spark):
    texts = [("empty", ""), ("exact", "a" * 3000), ("over", "b" * 3001), ("astral", "😀" * 4)]
    df = spark.createDataFrame(texts, "doc_id string, text string")
    rows = chunk_text(df).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append((r.chunk_idx, r.chunk))
    assert "empty" not in by
    assert [len(c) for _, c in sorted(by["exact"])] == [3000]
    assert [len(c) for _, c in sorted(by["over"])] == [3000, 1]
    small = chunk_text(df.where("doc_id = 'astral'"), n=3).collect()
    assert sorted((r.chunk_idx, r.chunk) for r in small) == [(0, "😀" * 3), (1, "😀")]


def test_chunks_concatenate_back(spark):
    df = spark.createDataFrame([("d", "x" * 7001 + "yz")], "doc_id string, text string")
    parts = sorted((r.chunk_idx, r.chunk) for r in chunk_text(df).collect())
    assert "".join(c for _, c in parts) == "x" * 7001 + "yz"


def test_output_name(spark):
    df = spark.createDataFrame([("case1.txt", "qwen2.5:14b"), ("Passes_de_Kembs_(poissons__castors).txt", "mistral:latest"),
                                ("case4_en.txt", "llama-3-70b-populate-ontology")], "file_name string, model string")
    got = [r[0] for r in df.select(output_name("file_name", "model", replace=":-")).collect()]
    assert got == ["case1_qwen2.5_14b.ttl", "Passes_de_Kembs_(poissons__castors)_mistral_latest.ttl",
                   "case4_en_llama_3_70b_populate_ontology.ttl"]


def test_strip_prompt_echo(spark):
    df = spark.createDataFrame([("no marker",), ("sys assistant\nbody",), ("a assistant b assistant c",)], "t string")
    between = [tuple(r[0]) for r in df.select(strip_prompt_echo("t", "between")).collect()]
    after = [tuple(r[0]) for r in df.select(strip_prompt_echo("t", "after")).collect()]
    assert between == [("", "no_marker"), ("\nbody", "ok"), (" b ", "cut_at_second")]
    assert after == [("no marker", "no_marker"), ("\nbody", "ok"), (" b assistant c", "ok")]


def test_frame(spark):
    df = spark.createDataFrame([(0, "r")], "i int, r string")
    assert df.select(frame_chunk_response("i", "r")).first()[0] == "Response for chunk 1:\n\nr\n\n"


def test_duration_matches_python(spark):
    vals = [0.125, 0.375, 59.995, 60.0, 87.44, 1405.03, 3599.999, 71.38]
    df = spark.createDataFrame([(v,) for v in vals], "s double")
    got = [r[0] for r in df.select(format_duration("s")).collect()]
    want = []
    for v in vals:
        m, s = divmod(v, 60)
        want.append(f"{int(m)} minutes and {s:.2f} seconds")
    assert got == want


def test_timing_roundtrip_with_quotes(spark):
    df = spark.createDataFrame([("qwen2:7b", "Passes_de_Kembs_(poissons_&_castors)'s.txt", 123.456)],
                               "model string, file_name string, seconds double")
    r = df.select(parse_timing(timing_line("model", "file_name", "seconds")).alias("p")).first().p
    assert r.model == "qwen2:7b" and r.file_name == "Passes_de_Kembs_(poissons_&_castors)'s.txt"
    assert abs(r.seconds - 123.46) < 1e-9
