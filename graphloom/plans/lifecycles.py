"""The four end-to-end flows of the reference, composed from the operators.

Every model pass is written once (Parquet under ``out``) and read back before
the next stage, so a retry or a second action never calls a model again and
the lineage of later stages starts at the saved answers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.functions import prompts as PR
from graphloom.functions.chatrows import parse_chat_rows, truncate_tokens, with_chat_text
from graphloom.functions.cleaning import clean_response
from graphloom.functions.text import chunk_text, strip_prompt_echo, with_prefix_header
from graphloom.operators.dataset import length_batches, shuffle_take, train_test_split
from graphloom.operators.generate import generate_once
from graphloom.operators.responses import assemble_responses
from graphloom.operators.turtle import parse_graphs, triples_of
from graphloom.session import stored
from graphloom.sinks.writers import write_graphs, write_timings
from graphloom.vocab import PREFIXES

KEYS = ["regime", "model", "doc_id"]


def zero_shot(corpus: DataFrame, models: list[str], out: str, backend="hash", template: bool = False,
              options: dict | None = None, partitions: int | None = None) -> DataFrame:
    """§3.1: (doc x model) -> system + text prompt -> answer -> saved responses."""
    regime = "zero_shot_template" if template else "zero_shot"
    # (every model is asked the same: the prompt is made once a document)
    pr = PR.build_prompts(corpus, regime).withColumn("prompt", PR.render_chat("messages", add_generation_prompt=True))
    pr = PR.expand_models(pr, models, partitions)
    return generate_once(pr.select(*KEYS, "prompt", "messages"), f"{out}/responses", KEYS, backend=backend,
                         options=options)


def one_shot(corpus: DataFrame, models: list[str], out: str, backend="hash", chunk: int = 3000,
             options: dict | None = None, partitions: int | None = None) -> DataFrame:
    """§3.2: chunks -> pass 1 per chunk (independent: the running context is
    never sent) -> saved -> framed and assembled per (doc, model) -> pass 2
    translation -> saved.  A1 is the only shuffle between the passes."""
    chunks = chunk_text(corpus, chunk)
    p1 = PR.expand_models(PR.build_prompts(chunks, "one_shot", text_col="chunk"), models, partitions)
    p1 = p1.withColumn("prompt", PR.render_chat("messages", add_generation_prompt=True))
    k1 = [*KEYS, "chunk_idx"]
    pass1 = generate_once(p1.select(*k1, "prompt", "messages"), f"{out}/pass1", k1, backend=backend, options=options)
    # a document with a failed chunk is not translated from what is left of it: its error goes on
    failed = pass1.where("error is not null").groupBy(*KEYS).agg(
        F.min(F.concat(F.lit("chunk "), (F.col("chunk_idx") + 1).cast("string"), F.lit(": "), F.col("error"))).alias("error"))
    assembled = assemble_responses(pass1.join(failed.select(*KEYS), KEYS, "left_anti"), keys=("regime", "model", "doc_id"))
    p2 = PR.build_translate_prompts(assembled).withColumn("prompt", PR.render_chat("messages", True))
    pass2 = generate_once(p2.select(*KEYS, "prompt", "messages"), f"{out}/pass2", KEYS, backend=backend, options=options)
    lost = failed.select(*KEYS, F.lit(None).cast("string").alias("response"), F.lit(None).cast("double").alias("seconds"), "error")
    return pass2.unionByName(lost)


def fine_tuned(corpus: DataFrame, model: str, out: str, backend="hash", max_tokens: int | None = None,
               options: dict | None = None) -> DataFrame:
    """§3.3 inference: user text (optionally capped) -> fixed system sentence
    -> open ChatML prompt -> answer -> cut at the assistant marker -> cleaned
    body.  The cap never touches the frame or the opened assistant turn, and a
    text within it keeps its line breaks."""
    if max_tokens:
        capped = truncate_tokens(corpus, max_tokens, "text")
        corpus = capped.withColumn("text", F.when(F.col("truncated"), F.col("text_capped")).otherwise(F.col("text"))) \
            .drop("n_tokens", "truncated", "text_capped")
    pr = PR.build_prompts(corpus, "fine_tuned").withColumn("model", F.lit(model))
    pr = pr.withColumn("prompt", PR.render_chat("messages", add_generation_prompt=True))
    ans = generate_once(pr.select(*KEYS, "prompt", "messages"), f"{out}/responses", KEYS, backend=backend,
                        options=options)
    cut = ans.withColumn("_c", strip_prompt_echo("response", "between"))
    return cut.withColumn("_b", clean_response(F.col("_c.text"))) \
        .select(*KEYS, F.col("_b.body").alias("body"), F.col("_b.format").alias("format"),
                F.col("_c.status").alias("cut_status"), "seconds", "error")


def save_graphs(answers: DataFrame, out: str, text_col: str = "response", known_props: list[str] | None = None) -> DataFrame:
    """The end of every flow: answers -> cleaned body (N19) with the prefix
    header (N5) -> triples and diagnostics (G1), parsed once -> graphs by
    (regime, model) under ``out/graphs`` (K1) and one timing line per call
    under ``out/timings`` (K3).  A rerun replaces what it carries.  Returns the
    triples as saved; answers that failed have none."""
    body = answers.where("error is null").withColumn("_b", clean_response(F.col(text_col))) \
        .select(*KEYS, with_prefix_header(F.col("_b.body")).alias("text"))
    parsed = stored(parse_graphs(body, "text", KEYS, known_props, prefixes=PREFIXES), "parsed")
    write_graphs(triples_of(parsed), f"{out}/graphs")
    calls = answers.where("error is null").withColumn("file_name", F.concat("doc_id", F.lit(".txt")))
    write_timings(calls, f"{out}/timings", mode="overwrite")
    return answers.sparkSession.read.parquet(f"{out}/graphs")


def training_rows(rows: DataFrame, out: str, take: int, seed: int = 65, test_size: float = 0.1,
                  max_tokens: int = 2048, batch: int = 1) -> DataFrame:
    """§3.3 training side: shuffle-take -> validate raw JSON -> ChatML text ->
    token cap -> split -> length batches -> Parquet."""
    t = shuffle_take(rows, "id", seed, take)
    t = parse_chat_rows(t, on_error="fail")
    t = with_chat_text(t)
    t = truncate_tokens(t, max_tokens, "text")
    t = train_test_split(t, "id", test_size, seed)
    t = length_batches(t.withColumn("n_tokens_", F.col("n_tokens")), "n_tokens_", "id", batch).drop("n_tokens_")
    t.write.mode("overwrite").partitionBy("split").parquet(f"{out}/training_rows")
    return t.sparkSession.read.parquet(f"{out}/training_rows")
