"""Put per-chunk answers back together per (document, model)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom import prompt_texts as P
from graphloom.functions.text import frame_chunk_response


def assemble_responses(df: DataFrame, keys=("doc_id", "model"), idx_col: str = "chunk_idx",
                       text_col: str = "response", framed: bool = True, out_col: str = "individuals") -> DataFrame:
    """A1: concatenate the answers of one (doc, model) in chunk order.

    With ``framed`` each answer is wrapped as "Response for chunk i: ..."
    (the file the first pass writes).  One group is one document's chunks, so
    the group is bounded by the document, not by the table; the aggregate is
    partial (map side) before the shuffle on the keys.
    """
    body = frame_chunk_response(idx_col, text_col) if framed else F.col(text_col)
    g = df.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(F.col(idx_col).alias("i"), body.alias("t")))).alias("_parts"),
        F.count(F.lit(1)).alias("n_chunks"))
    return g.select(*keys, "n_chunks", F.array_join(F.transform("_parts", lambda x: x["t"]), "").alias(out_col))


def running_context(df: DataFrame, keys=("doc_id", "model"), idx_col: str = "chunk_idx",
                    text_col: str = "response", prefix: str | None = None, out_col: str = "context") -> DataFrame:
    """For chunk i, the prefix (ontology summary) followed by every earlier
    answer framed as "Réponse pour le chunk j : r\\n" (j counts from 1).

    A window over one document's chunks (rows before the current one).
    """
    head, tail = P.CONTEXT_FRAME.split("{i}")
    mid, end = tail.split("{r}")
    line = F.concat(F.lit(head), (F.col(idx_col) + 1).cast("string"), F.lit(mid), F.col(text_col), F.lit(end))
    w = Window.partitionBy(*keys).orderBy(idx_col).rowsBetween(Window.unboundedPreceding, -1)
    pre = F.lit(prefix if prefix is not None else "")
    return df.withColumn(out_col, F.concat(pre, F.array_join(F.collect_list(line).over(w), "")))


def context_offsets(df: DataFrame, keys=("doc_id", "model"), idx_col: str = "chunk_idx", text_col: str = "response",
                    prefix: str | None = None) -> tuple[DataFrame, DataFrame]:
    """W1 in linear size: (texts, offsets).  ``texts`` has one row per keys, the
    prefix and all framed answers in chunk order (``whole``); ``offsets`` one row
    per chunk with the length ``upto`` of the part of it that is the chunk's
    context (``context_of`` reads it)."""
    head, tail = P.CONTEXT_FRAME.split("{i}")
    mid, end = tail.split("{r}")
    line = F.concat(F.lit(head), (F.col(idx_col) + 1).cast("string"), F.lit(mid), F.col(text_col), F.lit(end))
    pre = prefix if prefix is not None else ""
    lines = df.select(*keys, idx_col, line.alias("_l"))
    texts = lines.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(idx_col).alias("i"), F.col("_l").alias("t")))).alias("_p")) \
        .select(*keys, F.concat(F.lit(pre), F.array_join(F.col("_p.t"), "")).alias("whole"))
    w = Window.partitionBy(*keys).orderBy(idx_col).rowsBetween(Window.unboundedPreceding, -1)
    upto = F.coalesce(F.sum(F.length("_l")).over(w), F.lit(0)) + len(pre)
    return texts, lines.select(*keys, idx_col, upto.cast("long").alias("upto"))


def context_of(whole: str = "whole", upto: str = "upto"):
    """The context of a chunk, from its document's text and its offset."""
    return F.substr(F.col(whole), F.lit(1), F.col(upto).cast("int"))
