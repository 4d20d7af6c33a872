"""Operator 7: packing pieces of documents into windows by non-negative least
squares over shallow length combinations.

1. Every document's ids (with the end id) are cut into whole windows and a tail;
   a tail longer than ``tail`` is cut at multiples of ``tail``.  A document's
   cuts depend on its own length only, so each piece's checksum is taken where
   the document is encoded and no id is moved.
2. The histogram of piece lengths (at most ``window`` numbers) is all that the
   driver sees.  It enumerates the combinations of up to three lengths that
   fill a window exactly, solves for their repeat counts by non-negative least
   squares against the histogram, rounds down, and packs what remains greedily
   (largest first, best fit, whole multiplicities at a time).
3. Each piece's rank among the pieces of its length (prefix sums over salted
   counts, so one very common length is spread) picks its place in the plan.

Defined results: a null text is empty, its document holds only the end id; an
empty table gives no rows; repeated doc_ids are packed as separate documents;
further columns are ignored.  Sequence ids are gapless from 0; a sequence whose
ids do not fill the window is padded to it, unless their number is a power of
two.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.common import salts_for
from graphloom.llm.tokens import encoder
from graphloom.session import ship_package, stored

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
#: Rows of one length that one ranking task sorts, about.
RANK_ROWS = 500_000


def cut_points(n: int, window: int, tail: int) -> list[int]:
    """Starts of a document's pieces: whole windows, then the tail's parts."""
    full = n // window * window
    return [*range(0, full, window), *range(full, n, tail)]


def pieces_of(docs: DataFrame, tokenizer_path: str, units: str, end_id: int, window: int, tail: int) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens."""
    ship_package(docs.sparkSession)

    def cut(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        enc, end = encoder(tokenizer_path, units), np.asarray([end_id], "<u4").tobytes()
        for b in batches:
            doc, start, length, crc, total = [], [], [], [], []
            for i, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = enc.encode(text.as_py()) + end
                n = len(ids) // 4
                at = cut_points(n, window, tail)
                for s, e in zip(at, [*at[1:], n]):
                    doc.append(i)
                    start.append(s)
                    length.append(e - s)
                    crc.append(zlib.crc32(ids[4 * s:4 * e]))
                    total.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (doc, start, length, crc, total)],
                                             names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


def combinations(lengths, window: int) -> list[tuple[int, ...]]:
    """All combinations of one, two or three of ``lengths`` that sum to the window."""
    have = sorted(set(lengths))
    inside, out = set(have), [(window,)] if window in lengths else []
    for i, a in enumerate(have):
        if 2 * a > window:
            break
        if window - a in inside and window - a < window:
            out.append((a, window - a))
        for b in have[i:]:
            c = window - a - b
            if c < b:
                break
            if c in inside:
                out.append((a, b, c))
    return out


def solve(hist, combos, window: int, steps: int = 400):
    """Repeat counts x >= 0 that minimise ||A x - hist||^2, A the multiplicity
    of each length in each combination: multiplicative updates on the sparse A."""
    import numpy as np

    idx = np.array([(*c, *[0] * (3 - len(c))) for c in combos])  # length 0: unused place
    h = np.array(hist, float)
    h[0] = 0
    x = np.full(len(combos), h.sum() / max(1, 3 * len(combos)))
    top = h[idx].sum(1)
    for _ in range(steps):
        use = np.bincount(idx.ravel(), np.repeat(x, 3), minlength=window + 1)
        use[0] = 0
        x *= top / np.maximum(use[idx].sum(1), 1e-12)
    return x


def plan_windows(hist: list[int], window: int) -> list[tuple[tuple[int, ...], int]]:
    """hist[l] pieces of length l -> [(combination, repeats)] that uses each
    piece once.  Bounded by the window, whatever the data's size."""
    left, plan = list(hist), []

    def take(combo: tuple[int, ...], n: int) -> int:
        n = min([n, *(left[x] // combo.count(x) for x in set(combo))])
        if n > 0:
            for x in combo:
                left[x] -= n
            plan.append((combo, n))
        return n

    combos = combinations([x for x in range(1, window + 1) if hist[x]], window)
    if combos:
        x = solve(hist, combos, window)
        for k in sorted(range(len(combos)), key=lambda k: (-x[k], combos[k])):
            if x[k] >= 1:
                take(combos[k], int(x[k]))
    # residuals: longest first, then the longest that still fits, as often as possible
    while any(left[1:]):
        gap, combo = window, []
        while gap:
            fit = next((x for x in range(gap, 0, -1) if left[x] > combo.count(x)), 0)
            if not fit:
                break
            combo.append(fit)
            gap -= fit
        take(tuple(combo), max(left))
    return plan


def place_table(plan, window: int):
    """The plan as arrays by (length, first rank): where each rank of each
    length goes."""
    import numpy as np

    seen, rows, seq = [0] * (window + 1), [], 0
    for combo, n in plan:
        offset, copies = 0, {}
        for x in combo:
            rows.append((x, seen[x] + copies.get(x, 0) * n, seq, offset))
            copies[x] = copies.get(x, 0) + 1
            offset += x
        for x, k in copies.items():
            seen[x] += k * n
        seq += n
    rows.sort()
    a = np.array(rows or [(0, 0, 0, 0)], np.int64)
    return a


def pack(pieces: DataFrame, window: int) -> DataFrame:
    """Add sequence_id and offset to a stored table of pieces (doc_id, start,
    length, ...; 0 < length <= window)."""
    spark = pieces.sparkSession
    ship_package(spark)
    salts = salts_for(pieces.count(), RANK_ROWS)
    p = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)))
    counts = p.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    hist = [0] * (window + 1)
    for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect():  # at most `window` rows
        hist[r["length"]] = r["n"]
    table = place_table(plan_windows(hist, window), window)

    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("length", "_salt").orderBy("doc_id", "start", *(c for c in ("ids_crc32",) if c in pieces.columns))
    ranked = p.withColumn("_r", F.row_number().over(within) - 1).join(bases, ["length", "_salt"]) \
        .withColumn("_rank", F.col("_base") + F.col("_r")).select(*pieces.columns, "_rank")
    keep = pieces.columns

    def assign(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        # one sortable key per plan row: lengths in order, ranks in order within
        at = [table[table[:, 0] == x] for x in range(window + 1)]
        for b in batches:
            length = np.asarray(b.column(keep.index("length")))
            rank = np.asarray(b.column(len(keep)))
            seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length):
                mine, t = length == x, at[x]
                k = np.searchsorted(t[:, 1], rank[mine], "right") - 1
                seq[mine], off[mine] = t[k, 2] + rank[mine] - t[k, 1], t[k, 3]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(seq), pa.array(off)],
                                             names=[*keep, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return ranked.mapInArrow(assign, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, units: str, end_id: int = 0, window: int = 1024,
                   tail: int = 512) -> DataFrame:
    """Encode, cut and pack whole documents into windows."""
    pieces = stored(pieces_of(docs, tokenizer_path, units, end_id, window, tail), "pieces")
    return pack(pieces, window)
