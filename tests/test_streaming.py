import os

from graphloom.streaming.incremental import start_extraction


def test_stream_answers_each_file_once(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    for i in range(3):
        with open(os.path.join(src, f"case{i}.txt"), "w") as f:
            f.write(f"text {i}")
    out = os.path.join(tmp_dir, "responses")
    ck = os.path.join(tmp_dir, "ck")
    q = start_extraction(spark, src, out, ck, available_now=True)
    q.awaitTermination(120)
    with open(os.path.join(src, "case9.txt"), "w") as f:
        f.write("late text")
    q = start_extraction(spark, src, out, ck, available_now=True)
    q.awaitTermination(120)
    r = spark.read.parquet(out)
    assert r.count() == 4 and r.select("doc_id").distinct().count() == 4
