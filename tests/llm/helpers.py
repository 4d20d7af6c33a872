"""Inputs for the tests of the training-text operators."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for columns of their own.
CLASHING = ("size", "shard", "kept", "n_words", "cls", "_row", "_drop", "_h", "taken", "spans", "length", "label", "target")


def docs(spark, rows, extra=False):
    """rows: (doc_id, text[, lang[, source]])."""
    full = []
    for r in rows:
        r = (*r, *("en", "s0")[len(r) - 2:]) if len(r) < 4 else r
        full.append((*r, len(r[1]) if r[1] is not None else None))
    d = spark.createDataFrame(full, SCHEMA)
    if extra:
        from pyspark.sql import functions as F
        d = d.withColumns({c: F.lit("x") for c in CLASHING})
    return d


def words_of(text):
    import re
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sentence(rng, n, vocab=4000):
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))
