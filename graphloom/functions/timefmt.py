"""Timing lines "Execution time for model 'M' on file 'F': X minutes and S.SS seconds"."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LINE_PATTERN = r"^Execution time for model '([^']*)' on file '(.*)': (\d+) minutes and ([0-9]+\.[0-9]+) seconds$"


def format_duration(seconds: str | Column) -> Column:
    """``{int(m)} minutes and {s:.2f} seconds`` with m, s = divmod(x, 60).

    ``%`` on doubles is IEEE fmod (as divmod's remainder) and format_number
    rounds half-even on the exact binary value, as Python's ``:.2f`` does.
    """
    s = F.col(seconds) if isinstance(seconds, str) else seconds
    minutes = F.floor(s / 60).cast("bigint")
    rem = s % 60
    return F.concat(minutes.cast("string"), F.lit(" minutes and "),
                    F.regexp_replace(F.format_number(rem, 2), ",", ""), F.lit(" seconds"))


def timing_line(model: str | Column, file_name: str | Column, seconds: str | Column) -> Column:
    m = F.col(model) if isinstance(model, str) else model
    f = F.col(file_name) if isinstance(file_name, str) else file_name
    return F.concat(F.lit("Execution time for model '"), m, F.lit("' on file '"), f, F.lit("': "),
                    format_duration(seconds))


def parse_timing(line: str | Column) -> Column:
    """Timing line -> struct(model, file_name, seconds); null fields when the line does not match."""
    ln = F.col(line) if isinstance(line, str) else line
    ok = ln.rlike(LINE_PATTERN)
    g = lambda i: F.regexp_extract(ln, LINE_PATTERN, i)
    secs = g(3).cast("double") * 60 + g(4).cast("double")
    return F.struct(F.when(ok, g(1)).alias("model"), F.when(ok, g(2)).alias("file_name"),
                    F.when(ok, secs).alias("seconds"))
