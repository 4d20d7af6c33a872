"""Text functions: chunking, output names, prompt-echo cutting, headers.

All are Column expressions (JVM side, inside whole-stage codegen).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.prompt_texts import CHUNK_FRAME
from graphloom.vocab import PREFIX_HEADER

DEFAULT_CHUNK = 3000


def chunk_text(df: DataFrame, n: int = DEFAULT_CHUNK, text_col: str = "text",
               out_col: str = "chunk") -> DataFrame:
    """Split each text into slices of ``n`` characters, no overlap, last
    slice short, ``chunk_idx`` from 0.  Empty text gives no chunk.

    The slices are built inside the document row and exploded once, so a long
    text is not copied into every chunk row.
    """
    t = F.col(text_col)
    size = F.length(t)
    starts = F.when(size > 0, F.sequence(F.lit(0), F.ceil(size / F.lit(n)).cast("int") - 1)) \
        .otherwise(F.array().cast("array<int>"))
    slices = F.transform(starts, lambda i: F.substring(t, i * n + 1, n))
    keep = [c for c in df.columns if c != text_col]
    return df.select(*keep, F.posexplode(slices).alias("chunk_idx", out_col))


def output_name(file_col: str | Column = "file_name", model_col: str | Column = "model",
                replace: str = ":", ext: str = ".ttl") -> Column:
    """``<file stem>_<model with `replace` chars as _><ext>``."""
    f = F.col(file_col) if isinstance(file_col, str) else file_col
    m = F.col(model_col) if isinstance(model_col, str) else model_col
    stem = F.regexp_replace(f, r"(?<=.)\.[^./]*$", "")
    return F.concat(stem, F.lit("_"), F.translate(m, replace, "_" * len(replace)), F.lit(ext))


def doc_key(file_col: str | Column = "file_name") -> Column:
    """Document key = file name without its extension."""
    f = F.col(file_col) if isinstance(file_col, str) else file_col
    return F.regexp_replace(f, r"(?<=.)\.[^./]*$", "")


MARKER = "assistant"


def strip_prompt_echo(text: str | Column, how: str = "between", marker: str = MARKER) -> Column:
    """Cut a decoded generation at the role marker.

    ``between``: the part between the first and second marker (empty with
    status ``no_marker`` when absent); ``after``: everything after the first
    marker, else the whole text.  Returns struct(text, status).
    """
    t = F.col(text) if isinstance(text, str) else text
    has = F.instr(t, marker) > 0
    if how == "between":
        body = F.split_part(t, F.lit(marker), F.lit(2))
        n_marks = F.size(F.split(t, marker, -1)) - 1
        status = F.when(~has, "no_marker").when(n_marks > 1, "cut_at_second").otherwise("ok")
    elif how == "after":
        body = F.when(has, F.substr(t, F.instr(t, marker) + F.lit(len(marker)))).otherwise(t)
        status = F.when(has, "ok").otherwise("no_marker")
    else:
        raise ValueError(how)
    return F.struct(body.alias("text"), status.alias("status"))


def with_prefix_header(text: str | Column) -> Column:
    """Prepend the three fixed @prefix lines (even when already present)."""
    t = F.col(text) if isinstance(text, str) else text
    return F.concat(F.lit(PREFIX_HEADER), t)


def frame_chunk_response(idx: str | Column, response: str | Column) -> Column:
    """``Response for chunk {i+1}:\\n\\n{r}\\n\\n`` (idx counts from 0)."""
    i = F.col(idx) if isinstance(idx, str) else idx
    r = F.col(response) if isinstance(response, str) else response
    head, tail = CHUNK_FRAME.split("{i}")
    mid, end = tail.split("{r}")
    return F.concat(F.lit(head), (i + 1).cast("string"), F.lit(mid), r, F.lit(end))
