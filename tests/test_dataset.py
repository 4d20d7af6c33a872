import hashlib
import math

from pyspark.sql import functions as F

from graphloom.operators.dataset import length_batches, shuffle_take, train_test_split
from graphloom.operators.ranking import global_rank


def test_global_rank_matches_sort(spark):
    rows = [(i, (i * 7919) % 97) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, k long")
    got = {r.id: r["rank"] for r in global_rank(df, ["k", "id"], partitions=7).collect()}
    want = {i: n + 1 for n, (i, _) in enumerate(sorted(rows, key=lambda x: (x[1], x[0])))}
    assert got == want


def test_split_and_take(spark):
    df = spark.range(1000).withColumnRenamed("id", "id")
    s = train_test_split(df, "id", 0.1, seed=65)
    assert s.where("split = 'test'").count() == 100
    order = sorted(range(1000), key=lambda i: (hashlib.md5(f"65-{i}".encode()).hexdigest(), i))
    assert {r.id for r in s.where("split = 'test'").collect()} == set(order[:100])
    t = shuffle_take(df, "id", seed=65, n=143).collect()
    assert [r.id for r in sorted(t, key=lambda r: r.pick)] == order[:143]


def test_length_batches_hot_length(spark):
    # one length holds most rows: batches stay exact
    rows = [(i, 5 if i % 4 else i) for i in range(203)]
    df = spark.createDataFrame(rows, "id long, n long")
    got = {r.id: r.batch_id for r in length_batches(df, "n", "id", size=8).collect()}
    order = sorted(rows, key=lambda x: (x[1], x[0]))
    assert got == {i: pos // 8 for pos, (i, _) in enumerate(order)}
    assert max(got.values()) == math.ceil(203 / 8) - 1


def test_exact_median_hot_group(spark):
    import pandas as pd

    from graphloom.operators.timing import exact_median
    rows = [("hot" if i % 5 else f"g{i % 7}", float((i * 37) % 101)) for i in range(700)]
    df = spark.createDataFrame(rows, "model string, seconds double")
    got = {r.model: r.median for r in exact_median(df, ["model"], "seconds").collect()}
    want = pd.DataFrame(rows, columns=["model", "seconds"]).groupby("model").seconds.median().to_dict()
    assert got == want
