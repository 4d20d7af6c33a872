"""Chat training rows -- validate ``raw`` JSON, cap token budgets."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.prompts import MESSAGE_TYPE, render_chat
from graphloom.session import ship_package

STATUS_OK = "ok"


def parse_chat_rows(df: DataFrame, raw_col: str = "raw", on_error: str = "quarantine") -> DataFrame:
    """Parse ``raw`` = {"messages": [{"role", "content"}, ...]}.

    Adds ``messages`` (role and content only) and ``status``:
    ``invalid_json`` (not JSON or not an object), ``no_messages`` (key absent
    or not a list), ``bad_message`` (an element lacks a string role/content),
    ``ok``.  ``on_error='fail'`` raises on the first bad row, as the training
    script does; ``'quarantine'`` keeps them with their status.
    """
    v = F.try_parse_json(F.col(raw_col))
    is_obj = F.expr(f"schema_of_variant(try_parse_json({raw_col}))").startswith("OBJECT")
    arr = F.try_variant_get(v, "$.messages", "array<variant>")
    msgs = F.try_variant_get(v, "$.messages", MESSAGE_TYPE)
    bad_el = F.exists(msgs, lambda m: m["role"].isNull() | m["content"].isNull())
    status = (F.when(v.isNull() | ~is_obj, "invalid_json")
              .when(arr.isNull(), "no_messages")
              .when(msgs.isNull() | bad_el, "bad_message")
              .otherwise(STATUS_OK))
    out = df.withColumn("status", status).withColumn(
        "messages", F.when(F.col("status") == STATUS_OK, msgs))
    if on_error == "fail":
        out = out.withColumn("status", F.when(F.col("status") == STATUS_OK, F.col("status"))
                             .otherwise(F.raise_error(F.concat(F.lit("bad chat row: "), F.col("status")))))
    elif on_error != "quarantine":
        raise ValueError(on_error)
    return out


def with_chat_text(df: DataFrame, msgs: str = "messages", out: str = "text",
                   add_generation_prompt: bool = False) -> DataFrame:
    """N14 applied to parsed rows: the training ``text`` field."""
    return df.withColumn(out, render_chat(msgs, add_generation_prompt))


WS = r"[ \t\n\r]+"


def whitespace_tokens(text: str | Column) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    trimmed = F.regexp_replace(t, r"^[ \t\n\r]+|[ \t\n\r]+$", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WS))


def truncate_tokens(df: DataFrame, n: int = 2048, text_col: str = "text", tokenizer=None) -> DataFrame:
    """Cap a text at ``n`` tokens; adds ``n_tokens``, ``truncated``, ``text_capped``.

    Default tokens are whitespace-separated words, all JVM side.  A real
    tokenizer (any object with ``encode(str)->ids`` and ``decode(ids)->str``,
    e.g. from the ``tokenizers`` package) runs as an Arrow-batched pandas UDF.
    """
    if tokenizer is None:
        toks = whitespace_tokens(text_col)
        return (df.withColumn("_toks", toks)
                .withColumn("n_tokens", F.size("_toks"))
                .withColumn("truncated", F.col("n_tokens") > n)
                .withColumn("text_capped", F.array_join(F.slice("_toks", 1, n), " "))
                .drop("_toks"))
    ship_package(df.sparkSession)

    @F.pandas_udf("struct<n_tokens:int,text_capped:string>")
    def _cap(s: pd.Series) -> pd.DataFrame:
        counts, texts = [], []
        for t in s:
            ids = tokenizer.encode(t) if t is not None else []
            ids = getattr(ids, "ids", ids)
            counts.append(len(ids))
            texts.append(tokenizer.decode(list(ids[:n])) if t is not None else None)
        return pd.DataFrame({"n_tokens": counts, "text_capped": texts})

    return (df.withColumn("_cap", _cap(F.col(text_col)))
            .withColumn("n_tokens", F.col("_cap.n_tokens"))
            .withColumn("truncated", F.col("n_tokens") > n)
            .withColumn("text_capped", F.col("_cap.text_capped")).drop("_cap"))
