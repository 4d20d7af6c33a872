"""Operator 13: spelling variants by a trie-node pair dictionary.

Two words differ by one code point exactly if they share what stands before a
place and what stands behind it.  Both are nodes of tries:

1. The nodes of the trie of all words, and of the trie of all reversed words,
   are numbered.  In sorted order a word shares its longest known beginning with
   the word before it, so range partitions number their nodes alone; only the
   nodes on the path of a partition's first word may be met by several, and those
   get their numbers from the list of first words.
2. A word with ``skip`` at place i is the pair (node of its beginning up to i,
   node of its end behind i); ``split`` at i is the pair of its beginning and end
   at i.  Words that skip alike differ in that one code point; a word that skips
   to where another is split is the other with one code point more.  A word that
   could skip any of a run of equal code points for the same result does so at
   the first only, and a pair of nodes is split by one word at most, so each pair
   of near words meets exactly once.
3. Only numbers travel: a word is its place in the order of (count descending,
   code points).  No pairs of words are made: each row of a pair of nodes takes
   the number of others, and the best of them, from windows over that pair, which
   hold at most one word for each letter of the alphabet.

Defined results: a null text has no words; a null doc_id is written as nothing
in the drill; one word alone has no near words; ties of count go to the smallest
word in code-point order; repeated rows count again; an empty table gives no
rows; words of any length are taken whole; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.operators.ranking import global_rank
from graphloom.session import cut_lineage, ship_package, stored

RUN = "[A-Za-zÀ-ÿ]+"
#: Distinct words that a task counts before it hands them on.
WORDS_HELD = 300_000
_UPPER = {c: c + 32 for c in range(65, 91)}
_OWN = 1 << 40  # numbers of a partition's own nodes; those of first words' paths are negative


def drilled(doc_id, word: str, every: int = 31) -> str:
    """The word without one code point where ``every`` divides the checksum of
    ``<doc_id>:<word>``."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def count_words(docs: DataFrame, shortest: int = 7, least: int = 2, drill: int | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """-> word, n: lower-cased (A-Z) letter runs of whole texts of at least
    ``shortest`` code points that occur at least ``least`` times.  ``drill``: every
    so many are damaged first (a planted error rate to test by)."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        runs, held = re.compile(RUN).findall, Counter()
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                text = text.as_py()
                if not text:
                    continue
                for word, n in Counter(runs(text)).items():
                    word = word.translate(_UPPER)
                    if drill:
                        word = drilled(doc_id, word, drill)
                    if len(word) >= shortest:
                        held[word] += n
                if len(held) > WORDS_HELD:
                    yield _counted(held)
                    held.clear()
        if held:
            yield _counted(held)

    def _counted(held):
        import pyarrow as pa

        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    part = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "word string, n long")
    return part.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _common(a: str, b: str) -> int:
    """Length of the longest common beginning."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n - 1
    while lo < hi:  # the first place that differs
        mid = (lo + hi) // 2
        if a[lo:mid + 1] == b[lo:mid + 1]:
            lo = mid + 1
        else:
            hi = mid
    return lo


def _paths(firsts: list[str]) -> list[list[int]]:
    """For each partition's first word the numbers of the nodes on its path
    (depth 0 to its length); a node met before keeps its number."""
    out: list[list[int]] = []
    for p, word in enumerate(firsts):
        known = _common(firsts[p - 1], word) if p else -1
        path = out[-1][:known + 1] if p else []
        out.append(path + [-1 - (p * _OWN + d) for d in range(known + 1, len(word) + 1)])
    return out


def number_nodes(words: DataFrame, col: str) -> DataFrame:
    """Words (distinct) -> the same rows with ``nodes``: the numbers of the trie
    nodes of all beginnings of ``col``, the empty one first.  Equal beginnings
    have equal numbers, different ones different numbers."""
    spark = words.sparkSession
    ship_package(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fixed = cut_lineage(words.repartitionByRange(n, col).sortWithinPartitions(col))
    # one word a partition comes to the driver
    rows = fixed.groupBy(F.spark_partition_id().alias("p")).agg(F.min(col).alias("w")).orderBy("p").collect()
    firsts, place = [r["w"] for r in rows], {r["p"]: i for i, r in enumerate(rows)}
    at = fixed.columns.index(col)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        p = place.get(TaskContext.get().partitionId())
        if p is None:
            return
        paths = _paths(firsts[:p + 2])
        ends = firsts[p + 1] if p + 1 < len(firsts) else None
        before, path, fresh = firsts[p], paths[p], p * _OWN
        for b in batches:
            for k in range(0, b.num_rows, 2000):
                part, nodes, starts = b.slice(k, 2000), [], [0]
                for w in part.column(at).to_pylist():
                    known = _common(before, w)
                    new = list(range(fresh, fresh + len(w) - known))
                    path = path[:known + 1] + new
                    fresh += len(new)
                    if ends is not None:
                        # what the next partition's first word shares has its number from there
                        shared = _common(w, ends)
                        if shared > known:
                            path[known + 1:shared + 1] = paths[p + 1][known + 1:shared + 1]
                    before = w
                    nodes.append(np.array(path, np.int64))
                    starts.append(starts[-1] + len(path))
                lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(np.concatenate(nodes) if nodes else [], pa.int64()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, "nodes"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fixed.schema) + ", nodes array<long>"
    return fixed.mapInArrow(run, schema)


def _pairs(words: DataFrame) -> DataFrame:
    """(word, pri) -> pairs of nodes (x, y) with the word's pri and what it does
    there: 0 split, 1 skip, 2 skip at the first of a run of equal code points."""
    heads = number_nodes(words.select("pri", "word"), "word")
    tails = number_nodes(words.select("pri", F.reverse("word").alias("drow")), "drow")
    both = heads.withColumnRenamed("nodes", "heads").join(tails.select("pri", F.col("nodes").alias("tails")), "pri")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            cols = [[], [], [], []]
            held = 0
            for pri, word, heads, tails in zip(*(b.column(i) for i in range(4))):
                word, pri = word.as_py(), pri.as_py()
                x = np.asarray(heads.values, np.int64)
                y = np.asarray(tails.values, np.int64)[::-1]  # y[i]: the end from place i on
                n = len(word)
                code = np.frombuffer(word.encode("utf-32-le"), "<u4")
                first = np.ones(n, np.int8)
                first[1:] = code[1:] != code[:-1]
                cols[0] += [x, x[:-1]]
                cols[1] += [y, y[1:]]
                cols[2].append(np.full(2 * n + 1, pri, np.int64))
                cols[3] += [np.zeros(n + 1, np.int8), 1 + first]
                held += 2 * n + 1
                if held > 200_000:
                    yield _flat(cols)
                    cols, held = [[], [], [], []], 0
            if held:
                yield _flat(cols)

    def _flat(cols):
        import numpy as np
        import pyarrow as pa

        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], names=["x", "y", "pri", "does"])

    return both.select("pri", "word", "heads", "tails").mapInArrow(run, "x long, y long, pri long, does byte")


def near_words(words: DataFrame) -> DataFrame:
    """(word, pri) with distinct pri -> pri, n_near, best (the smallest pri among
    the near words) for each word that has near words."""
    at = Window.partitionBy("x", "y")
    skips, firsts = F.col("does") > 0, F.col("does") == 2
    pri = F.col("pri")
    seen = _pairs(words).withColumns({
        "skipping": F.sum(skips.cast("long")).over(at),
        "shorter": F.min(F.when(F.col("does") == 0, pri)).over(at),  # one word at most
        "longer": F.sum(firsts.cast("long")).over(at),
        "best_longer": F.min(F.when(firsts, pri)).over(at),
        "best": F.min(F.when(skips, pri)).over(at),
        # the next one among those that skip: the second best, seen from the best
        "second": F.lead(F.when(skips, pri)).over(at.orderBy(F.when(skips, F.lit(0)).otherwise(1), "pri"))})
    other = F.when(pri == F.col("best"), F.col("second")).otherwise(F.col("best"))
    found = seen.select(
        "pri",
        F.when(skips, F.col("skipping") - 1 + F.when(firsts & F.col("shorter").isNotNull(), 1).otherwise(0))
        .otherwise(F.col("longer")).alias("m"),
        F.when(skips, F.when(firsts, F.least(other, "shorter")).otherwise(other)).otherwise(F.col("best_longer")).alias("near"))
    return found.where("m > 0").groupBy("pri").agg(F.sum("m").alias("n_near"), F.min("near").alias("best"))


def variant_forms(counts: DataFrame, times: int = 10) -> DataFrame:
    """(word, n) -> word, n, n_near, form, form_n, root."""
    counts = stored(counts.select("word", "n"), "word-counts")
    ranked = stored(global_rank(counts, [F.desc("n"), F.asc("word")], "pri").select("pri", "word", "n"), "ranked-words")
    near = stored(near_words(ranked.select("pri", "word")), "near-words")
    to = ranked.select(F.col("pri").alias("best"), F.col("word").alias("best_word"), F.col("n").alias("best_n"))
    joined = ranked.join(near, "pri", "left").join(to, "best", "left")
    formed = F.col("best_n") >= times * F.col("n")
    words = stored(joined.select("pri", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                 F.when(formed, F.col("best_word")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n"),
                                 F.when(formed, F.col("best")).alias("up")), "forms")
    # pointers to the root, doubled each round: counts grow by ``times`` with each step, so there are few
    up = words.where("up is not null").select("pri", "up")
    while True:
        nxt = up.select(F.col("pri").alias("up"), F.col("up").alias("_far"))
        far = stored(up.join(nxt, "up", "left").select("pri", F.coalesce("_far", "up").alias("up"), F.col("_far").isNotNull().alias("moved")), "roots")
        up = far.select("pri", "up")
        if far.where("moved").isEmpty():
            break
    root = up.select("pri", F.col("up").alias("root_pri")).join(ranked.select(F.col("pri").alias("root_pri"), F.col("word").alias("_root")), "root_pri")
    return words.join(root.select("pri", "_root"), "pri", "left") \
        .select("word", "form", F.coalesce("_root", "word").alias("root"), "n", "n_near", "form_n")
