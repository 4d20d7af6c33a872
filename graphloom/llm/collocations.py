"""Operator 12: phrases of two to five words by external stream estimation.

Counts are never looked up in tables; they are streams in a sorted order.

0. A phrase of the least count has words, word pairs and triples of the least
   count.  One pass counts all words, pairs and triples by a 64-bit checksum; those
   that reach it are marked in bitmaps of fixed size (``SIEVE_BITS``), which tasks
   ask.  Two keys that share a mark cost a little work, no key is missed, so results
   do not depend on the bitmaps; where vocabularies outgrow them, less is sieved.
1. Each word occurrence gives one window: the word and up to four before it in
   its piece, last word first, as far as all pairs and triples pass.  A word that
   does not pass gives the empty window.  Tasks count equal windows before they
   leave: nearly all of a task's windows are phrases of the least count, so their
   number follows that of the phrases, not the number of places where frequent pairs
   happen to meet.
2. Windows in *suffix order* (range partitions, sorted): all windows that begin
   with the same k reversed words stand together, so one pass gives the count of
   every phrase of every length, and of each language as the phrase of no words.
   Phrases below the least count go; what touches a partition's ends is summed.
3. Suffix order again, of phrases now: a phrase follows its shorter ends, so a
   stack of them gives the right count ``r`` of every cut; a phrase as frequent
   as the end it extends to the left marks that one.
4. *Prefix order*: a phrase follows its beginnings, whose stack gives the left
   counts ``l`` and the language's total; marks of step 3 stand before the phrase
   they mean, extensions to the right after it.  Here the cuts are scored, in
   integers of any size.

The beginnings that a partition's first phrase has in earlier partitions (five
at most) are handed to it.  A phrase lies inside a longer one of at least a
given share of its count only if it does so in one of one more word: counts can
only fall as a phrase grows.

Defined results: a null text is empty; a null language is ``und``; text without
words counts nothing; repeated rows count again; ties in score go by count, then
by the phrase's bytes; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm import worker
from graphloom.llm.shingles import mix
from graphloom.session import cut_lineage, ship_package, stored

LONGEST = 5
#: Distinct windows that a task counts before it hands them on.
WINDOWS_HELD = 400_000
#: Partitions of the input that one task of windows reads: each task hands on nearly
#: every phrase once, so fewer and longer tasks hand on fewer rows.
PARTS_JOINED = 4
SALTS = 64
#: A word's end in a key.  No word holds it, so equal beginnings stand together.
END = b"\n"
#: Piece ends as full stops (no word holds one); A-Z lower-cased.
_PLAIN = bytes.maketrans(b"\n,;:!?\x0b\x0c\rABCDEFGHIJKLMNOPQRSTUVWXYZ", b"." * 9 + b"abcdefghijklmnopqrstuvwxyz")
_STOP = b"."
SIEVE_BITS = 1 << 25
#: Words whose checksum is kept, and checksums that are counted at once.
WORDS_KEPT, SUMS_HELD = 200_000, 3_000_000


class _Checksums(dict):
    """word (bytes) -> 64-bit checksum; 0 is the end of a piece."""

    def __missing__(self, w: bytes) -> int:
        import xxhash

        if len(self) > WORDS_KEPT:
            self.clear()
        h = 0 if w == _STOP else xxhash.xxh3_64_intdigest(w) | 1
        if len(w) <= 64:
            self[w] = h
        return h


def _words(text: bytes, sums: _Checksums, lang: int):
    """Words of a text with stops between its pieces; checksums of each word and
    of each pair with the word before it (0 where there is none)."""
    import numpy as np

    words = text.translate(_PLAIN).replace(_STOP, b" . ").split()
    h = np.fromiter(map(sums.__getitem__, words), np.uint64, len(words))
    pair = np.zeros_like(h)
    inside = (h[1:] != 0) & (h[:-1] != 0)
    pair[1:][inside] = mix(h[:-1][inside] * np.uint64(0x9E3779B97F4A7C15) + h[1:][inside] + np.uint64(lang)) | np.uint64(1)
    some = h != 0
    h[some] = mix(h[some] + np.uint64(lang)) | np.uint64(1)
    return words, h, pair


def _triples(pair):
    """Checksums of each word and the two before it, from those of the pairs (0
    where there is none)."""
    import numpy as np

    triple = np.zeros_like(pair)
    inside = (pair[1:] != 0) & (pair[:-1] != 0)
    triple[1:][inside] = mix(pair[:-1][inside] * np.uint64(0x9E3779B97F4A7C15) + pair[1:][inside]) | np.uint64(1)
    return triple


def _back(linked, triple):
    """How many words each window holds, as far as pairs (``linked``) and triples
    pass: 1 where the word does not pass with the one before it."""
    import numpy as np

    def earlier(x, k):
        out = np.zeros_like(x)
        out[k:] = x[:max(len(x) - k, 0)]
        return out

    held = linked & earlier(linked, 1) & triple  # windows of k words: here k is 3
    m = 1 + linked.astype(np.int64) + held
    three = held
    for k in range(4, LONGEST + 1):
        held = held & earlier(three, k - 3)
        m += held
    return m


def _lang_sum(lang: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(lang.encode())


def _sums(batches: Iterator) -> Iterator:
    """(lang, text bytes) -> checksum whose last two bits are its kind (0 word, 1 pair,
    2 triple), how often."""
    import numpy as np
    import pyarrow as pa

    worker.none()
    sums, held, n = _Checksums(), [[], [], []], 0

    def out():
        for kind, parts in enumerate(held):
            if parts:
                h, k = np.unique(np.concatenate(parts), return_counts=True)
                h = h & ~np.uint64(3) | np.uint64(kind)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(k)], names=["h", "n"])
                parts.clear()

    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
            text = text.as_py()
            if not text:
                continue
            _, h, pair = _words(text, sums, _lang_sum(lang))
            for parts, h in zip(held, (h, pair, _triples(pair))):
                parts.append(h[h != 0])
                n += len(h)
            if n > SUMS_HELD:
                yield from out()
                n = 0
    yield from out()


def _sieves(texts: DataFrame, least: int) -> list[bytes]:
    """The bitmaps of the words, pairs and triples whose n reaches ``least``:
    SIEVE_BITS / 8 bytes each, whatever there is to mark."""
    counts = texts.mapInArrow(_sums, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    at = F.shiftrightunsigned("h", 2).bitwiseAND(F.lit(SIEVE_BITS - 1)) + 1
    parts = counts.select(F.col("h").bitwiseAND(F.lit(3)).alias("kind"), at.alias("at")).groupBy("kind", F.bitmap_bucket_number("at").alias("b")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    out = [bytearray(SIEVE_BITS // 8) for _ in range(3)]
    for r in parts.collect():
        first = (r["b"] - 1) * len(r["bits"])
        out[r["kind"]][first:first + len(r["bits"])] = r["bits"]
    return [bytes(o) for o in out]


def _windows(texts: DataFrame, sieves: list[bytes]) -> DataFrame:
    """(lang, text bytes) -> lang, key of a window, how often, counted as far as a task holds them."""
    sent = texts.sparkSession.sparkContext.broadcast(sieves)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        worker.none()
        sums, held = _Checksums(), {}
        marks = [np.frombuffer(s, np.uint8) for s in sent.value]

        def passes(bits, h):
            at = (h >> np.uint64(2)) & np.uint64(SIEVE_BITS - 1)
            return (h != 0) & ((bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)

        def out():
            for lang, found in held.items():
                keys = [k + END if k else k for k in found]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(keys, pa.binary()),
                                                  pa.array(found.values(), pa.int64())], names=["lang", "key", "n"])
            held.clear()

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                text = text.as_py()
                if not text:
                    continue
                words, h, pair = _words(text, sums, _lang_sum(lang))
                linked = passes(marks[1], pair)  # with the word before
                m = _back(linked, passes(marks[2], _triples(pair)))
                alone = (m == 1) & passes(marks[0], h)
                found = held.setdefault(lang, Counter())
                found.update([words[i] for i in np.flatnonzero(alone).tolist()])
                found[b""] += int((h != 0).sum() - alone.sum() - linked.sum())
                at = np.flatnonzero(linked)
                if len(at):
                    words.reverse()
                    joined = END.join(words) + END
                    ends = np.zeros(len(words) + 1, np.int64)
                    np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=ends[1:])
                    first = len(words) - 1 - at
                    found.update([joined[x:y] for x, y in zip(ends[first].tolist(), (ends[first + m[at]] - 1).tolist())])
                if sum(map(len, held.values())) > WINDOWS_HELD:
                    yield from out()
        yield from out()

    tasks = max(texts.sparkSession.sparkContext.defaultParallelism, -(-texts.rdd.getNumPartitions() // PARTS_JOINED))
    return texts.coalesce(tasks).mapInArrow(run, "lang string, key binary, n long")


def _fold(least: int):
    """Sorted (lang, key, n) -> the phrases of each length with their counts:
    those of ``least`` at least, and those that touch an end of the partition
    (``edge``), whose count may go on in the next one."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        # per length: the group not yet closed (lang, words, count), and whether it is the first
        open_: list = [None] * (LONGEST + 1)
        first = [True] * (LONGEST + 1)
        before = None  # the last row: lang, words

        def close(k: int, edge: bool, out: list):
            lang, words, n = open_[k]
            edge = edge or first[k]
            first[k], open_[k] = False, None
            if edge or n >= least:
                out.append((lang, b"".join(w + END for w in words), k, n, edge))

        def batch_of(out: list):
            cols = list(zip(*out))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.bool_()))],
                names=["lang", "key", "size", "f", "edge"])

        for b in batches:
            if not b.num_rows:
                continue
            langs, n = b.column(0), np.asarray(b.column(2))
            lists = pc.split_pattern(b.column(1), END)
            starts = np.asarray(lists.offsets)[:-1]
            words, m = lists.flatten(), np.diff(np.asarray(lists.offsets)) - 1
            same = np.ones(b.num_rows, bool)
            same[1:] = np.asarray(pc.equal(langs[1:], langs[:-1]).to_numpy(zero_copy_only=False))
            head = [words[int(starts[0]) + i].as_py() for i in range(int(m[0]))]
            same[0] = before is not None and before[0] == langs[0].as_py()
            out: list = []
            for k in range(LONGEST + 1):
                if k:
                    # word k of each row (any word where there is none: such rows are not of this length)
                    col = words.take(pa.array(starts + np.minimum(k - 1, m)))
                    equal = np.ones(b.num_rows, bool)
                    equal[1:] = pc.equal(col[1:], col[:-1]).to_numpy(zero_copy_only=False) & (m[1:] >= k) & (m[:-1] >= k)
                    equal[0] = before is not None and len(before[1]) >= k and m[0] >= k and before[1][k - 1] == head[k - 1]
                    same = same & equal
                rows = np.flatnonzero(m >= k)
                if open_[k] and not (len(rows) and same[0]):
                    close(k, False, out)
                if not len(rows):
                    continue
                begin = np.flatnonzero(~same[rows] | (np.arange(len(rows)) == 0))
                sums = np.add.reduceat(n[rows], begin)
                if open_[k]:
                    sums[0] += open_[k][2]
                spell = lambda g, k=k: [words[int(starts[rows[begin[g]]]) + i].as_py() for i in range(k)]
                if first[k] and len(begin) > 1:
                    open_[k] = (langs[int(rows[begin[0]])].as_py(), spell(0), int(sums[0]))
                    close(k, True, out)
                    sums[0] = 0
                for g in np.flatnonzero(sums[:-1] >= least).tolist():
                    out.append((langs[int(rows[begin[g]])].as_py(), b"".join(w + END for w in spell(g)), k, int(sums[g]), False))
                g = len(begin) - 1
                open_[k] = (langs[int(rows[begin[g]])].as_py(), spell(g), int(sums[g]))
            last = b.num_rows - 1
            before = (langs[last].as_py(), [words[int(starts[last]) + i].as_py() for i in range(int(m[last]))])
            if out:
                yield batch_of(out)
        out = []
        for k in range(LONGEST + 1):
            if open_[k]:
                close(k, True, out)
        if out:
            yield batch_of(out)

    return run


def _in_order(rows: DataFrame, key: str, *then) -> tuple[DataFrame, dict]:
    """Rows in range partitions by (lang, key), sorted, fixed by a checkpoint;
    and for each partition the counts of the shorter beginnings of its first
    phrase, by (lang, key): at most five a partition."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fixed = cut_lineage(rows.repartitionByRange(n, "lang", key).sortWithinPartitions("lang", key, *then))
    firsts = fixed.groupBy(F.spark_partition_id()).agg(F.min(F.struct("lang", key)).alias("s")).select("s.*").distinct()
    beginnings = firsts.select("lang", F.explode(_beginnings(key)).alias(key)).distinct()
    found = fixed.where("f is not null").join(F.broadcast(beginnings), ["lang", key])
    return fixed, {(r["lang"], bytes(r[key])): r["f"] for r in found.select("lang", key, "f").collect()}


def _beginnings(key: str):
    """The shorter beginnings of a key, from no word on."""
    words = F.split(F.col(key).cast("string"), "\n")
    n = F.size(words) - 1
    short = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
                        lambda k: F.when(k == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(words, 1, k), "\n"), F.lit("\n"))))
    return F.transform(short, lambda s: s.cast("binary"))


class _Stack:
    """The shorter beginnings of the phrase at hand: entries
    [word, count, payload, whether it comes from an earlier partition]."""

    def __init__(self, carried: dict):
        self.carried, self.lang, self.entries = carried, None, []

    def to(self, lang: str, words: list) -> list:
        """Come to a phrase: -> the entries left behind, deepest first."""
        gone = []
        if lang != self.lang:
            gone, self.entries = self.entries[::-1], []
        else:
            keep = 0
            while keep < len(words) - 1 and keep + 1 < len(self.entries) and self.entries[keep + 1][0] == words[keep]:
                keep += 1
            while len(self.entries) > keep + 1:
                gone.append(self.entries.pop())
        self.lang = lang
        # what is still missing lies in earlier partitions: only at a partition's start
        for k in range(len(self.entries), len(words)):
            key = b"".join(w + END for w in words[:k])
            self.entries.append([words[k - 1] if k else None, self.carried[lang, key], None, True])
        return gone


def _suffix_pass(carried: dict, percent: int):
    """Phrases in suffix order -> lang, key (words in order), f, right counts by
    cut, and marks (f null) of phrases that one with a word more in front equals."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        at = _Stack(carried)
        for b in batches:
            out = []
            for lang, key, f in zip(*(b.column(c).to_pylist() for c in ("lang", "key", "f"))):
                words = key.split(END)[:-1]
                at.to(lang, words)
                ends = at.entries
                forward = b"".join(w + END for w in reversed(words))
                # cut after k words: the rest is the end of len - k words
                out.append((lang, forward, f, [ends[len(words) - k][1] for k in range(1, len(words))]))
                if len(words) > 2 and 100 * f >= percent * ends[-1][1]:
                    out.append((lang, forward[len(words[-1]) + 1:], None, None))
                ends.append([words[-1] if words else None, f, None, False])
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.int64()),
                     pa.array(cols[3], pa.list_(pa.int64()))], names=["lang", "key", "f", "rights"])

    return run


SCORED = "lang string, key binary, a long, l long, r long, n long, score long, state string"


def _prefix_pass(carried: dict, percent: int):
    """Phrases in prefix order, marks before what they mean -> scored phrases:
    state ``kept``, ``open`` (an extension may follow in a later partition) or
    ``mark`` (of a phrase in an earlier partition)."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        at, marked = _Stack(carried), None

        def row(entry, lang, state):
            key, f, rights, lefts = entry[2]
            n = lefts[0]
            best = None
            for k in range(1, len(lefts)):
                score = 1000 * f * n // (lefts[k] * rights[k - 1])
                if best is None or score < best[0]:
                    best = (score, lefts[k], rights[k - 1])
            return lang, key, f, best[1], best[2], n, best[0], state

        def batch_of(out):
            cols, kinds = list(zip(*out)), (pa.string(), pa.binary(), *[pa.int64()] * 5, pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                              names=["lang", "key", "a", "l", "r", "n", "score", "state"])

        for b in batches:
            out = []
            for lang, key, f, rights in zip(*(b.column(c).to_pylist() for c in ("lang", "key", "f", "rights"))):
                if f is None:
                    marked = (lang, key)
                    continue
                words = key.split(END)[:-1]
                was = at.lang
                out += [row(e, was, "kept") for e in at.to(lang, words) if e[2]]
                path = at.entries
                if len(words) > 2 and 100 * f >= percent * path[-1][1]:
                    if path[-1][3]:
                        out.append((lang, key[:-len(words[-1]) - 1], *[None] * 5, "mark"))
                    path[-1][2] = None
                payload = None
                if len(words) > 1 and (lang, key) != marked:
                    payload = (key, f, rights, [e[1] for e in path])
                path.append([words[-1] if words else None, f, payload, False])
            if out:
                yield batch_of(out)
        out = [row(e, at.lang, "open") for e in reversed(at.entries) if e[2]]
        if out:
            yield batch_of(out)

    return run


def phrase_scores(docs: DataFrame, least: int = 100, percent: int = 100, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """-> lang, phrase, a, l, r, n, score of every phrase of two to five words
    that occurs ``least`` times and lies in no longer one of ``percent`` of its count."""
    ship_package(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.encode(F.col(text_col), "utf-8").alias("text"))
    windows = stored(_windows(texts, _sieves(texts, least)), "windows")
    folded = windows.repartitionByRange("lang", "key").sortWithinPartitions("lang", "key") \
        .mapInArrow(_fold(least), "lang string, key binary, size long, f long, edge boolean")
    folded = stored(folded, "folded")
    whole = folded.where("not edge").select("lang", "key", "f")
    edges = folded.where("edge").groupBy("lang", "key").agg(F.sum("f").alias("f"))
    phrases = whole.unionByName(edges).where(F.col("f") >= least)

    in_suffix, carried = _in_order(phrases, "key")
    rights = in_suffix.mapInArrow(_suffix_pass(carried, percent), "lang string, key binary, f long, rights array<long>")
    in_prefix, carried = _in_order(stored(rights, "right-counts"), "key", F.col("f").asc_nulls_first())
    scored = stored(in_prefix.mapInArrow(_prefix_pass(carried, percent), SCORED), "scored")
    # the few phrases that a partition ends in, against the marks from later ones
    undecided = scored.where("state = 'open'").join(scored.where("state = 'mark'").select("lang", "key"), ["lang", "key"], "left_anti")
    done = scored.where("state = 'kept'").unionByName(undecided.select(*scored.columns))
    return done.select("lang", F.translate(F.expr("substr(string(key), 1, length(string(key)) - 1)"), "\n", " ").alias("phrase"),
                       "a", "l", "r", "n", "score")


def top_phrases(scored: DataFrame, first: int) -> DataFrame:
    """The ``first`` of each language, with their rank: by salt, then of what is left."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = scored.withColumn("_s", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    few = salted.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_s").orderBy(*order))) \
        .where(F.col("_r") <= first).drop("_s", "_r")
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")) \
        .where(F.col("rank") <= first)
