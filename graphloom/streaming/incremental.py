"""Incremental extraction over a folder that keeps receiving texts.

The reference loops over a finished folder; on a cluster the same work runs
as a Structured Streaming query: new ``*.txt`` files are picked up by the
file source, each micro-batch builds prompts (J1 + N9-N13), drops the
(doc, model) pairs already answered in the responses table (so a replayed
batch after a failure never calls a model twice), calls the backend (U1) and
appends to the Parquet responses table.  The streaming checkpoint records
which files were consumed.  No state store is needed: graphs are per file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions import prompts as PR
from graphloom.functions.text import doc_key
from graphloom.operators.generate import generate, path_exists


def text_stream(spark: SparkSession, folder: str, glob: str = "*.txt", max_files: int = 64) -> DataFrame:
    """S1 as a stream: one row per new file (whole text)."""
    df = (spark.readStream.option("pathGlobFilter", glob).option("maxFilesPerTrigger", max_files)
          .text(folder, wholetext=True))
    name = F.col("_metadata.file_name")
    return df.select(doc_key(name).alias("doc_id"), name.alias("file_name"),
                     F.regexp_replace("value", "\r\n", "\n").alias("text"))


def answer_batch(batch: DataFrame, responses_path: str, regime: str, models: list[str], backend="hash",
                 options: dict | None = None) -> None:
    """foreachBatch body: prompts -> skip answered -> generate -> append."""
    spark = batch.sparkSession
    pr = PR.expand_models(PR.build_prompts(batch, regime), models)
    pr = pr.withColumn("prompt", PR.render_chat("messages", add_generation_prompt=True))
    keys = ["regime", "doc_id", "model"]
    if path_exists(spark, responses_path):  # only this regime's and these models' partitions are read
        done = spark.read.parquet(responses_path).where((F.col("regime") == regime) & F.col("model").isin(models)) \
            .where("error is null").select(*keys)
        pr = pr.join(done, keys, "left_anti")
    out = generate(pr.select(*keys, "prompt", "messages"), backend=backend, options=options, keys=keys)
    out.write.mode("append").partitionBy("regime", "model").parquet(responses_path)


def start_extraction(spark: SparkSession, folder: str, responses_path: str, checkpoint: str,
                     regime: str = "fine_tuned", models: list[str] | None = None, backend="hash",
                     options: dict | None = None, available_now: bool = False):
    """Start the streaming extraction; returns the StreamingQuery."""
    models = models or ["llama-3-70b-populate-ontology"]
    w = (text_stream(spark, folder).writeStream
         .foreachBatch(lambda df, _id: answer_batch(df, responses_path, regime, models, backend, options))
         .option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
