"""Operator 10: near-duplicate documents by MinHash bands and odd sketches.

1. One pass over the whole texts gives each document its set of word shingles
   (64-bit hashes, never stored), a 128-bit digest of the set, ``bands`` band
   keys over MinHash samples, and an odd sketch: the samples folded into a
   parity bitmap.  Documents with equal sets form one class, so exact copies
   cost nothing further.
2. Classes that share a band key are candidates.  Each bucket is first compared
   with its smallest class only (a star, no pairs among the others).  The
   population count of the XOR of two odd sketches estimates the similarity; a
   candidate is set aside only if that lies ``SIGMAS`` standard deviations below
   the threshold.  The others are confirmed on their full sets, which are made
   again from the texts of just these documents.
3. Buckets whose members the star has not all connected are compared in full,
   in tiles of bounded size: within a tile by numpy, each pair in the first band
   that it shares, pairs already connected skipped, and only links leave a task.
   So no link between different classes is lost to the star, and a bucket
   holding a third of all rows becomes many tiles.
4. Connected components of the links; the smallest doc_id names the group.

A pair at exactly 0.8 shares no band of 32 x 5 with probability 3e-6, and less
above it.

Defined results: a null or empty text, or one without words, has the empty set
and links with nothing; fewer words than a shingle give the whole sequence as
one; equal texts with different ids are linked; repeated rows are judged alike;
a group whose rows have no doc_id has a null component and keeps them; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.shingles import Sketcher, keep_words, most_flips, shingle_set
from graphloom.operators.linking import connected_components
from graphloom.operators.skew import hot_keys, split_join
from graphloom.session import ship_package, stored

BANDS, ROWS, BITS = 32, 5, 512
SIGMAS = 5.2
#: A tile holds at most two chunks of so many classes, or bytes of sets.
CHUNK_ROWS, CHUNK_SHINGLES = 1024, 1_000_000
#: Id lists up to this length (a few MB) are broadcast, longer ones joined by shuffle.
BROADCAST_IDS = 200_000
#: Rows of an Arrow batch worked on at once.
SLICE = 500

SIGNED = "doc_id long, tkey long, n_shingles long, cls binary, bands binary, odd binary"


def _slices(batches: Iterator) -> Iterator:
    for b in batches:
        for k in range(0, b.num_rows, SLICE):
            yield b.slice(k, SLICE)


def _signatures(docs: DataFrame, k: int) -> DataFrame:
    def sign(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash

        keep_words()
        sk = Sketcher(BANDS, ROWS, BITS)
        for b in _slices(batches):
            n, cls, bands, odd = [], [], [], []
            for text in b.column(2):
                s = shingle_set(text.as_py(), k)
                n.append(len(s))
                cls.append(xxhash.xxh3_128_digest(s))
                if len(s):
                    m = sk.samples(s)
                    bands.append(sk.band_keys(m).tobytes())
                    odd.append(sk.odd(m).tobytes())
                else:
                    bands.append(None)
                    odd.append(None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(cls, pa.binary()),
                 pa.array(bands, pa.binary()), pa.array(odd, pa.binary())],
                names=["doc_id", "tkey", "n_shingles", "cls", "bands", "odd"])

    return _texts(docs).mapInArrow(sign, SIGNED)


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, a key of the text, and the text's bytes."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tkey"),
                       F.encode("text", "utf-8").alias("text"))


def _sets(docs: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """(cid, shingles) of the given classes (cid, rep_id, tkey), made from their texts."""
    def again(batches: Iterator) -> Iterator:
        import pyarrow as pa

        keep_words()
        for b in _slices(batches):
            sets = pa.array([shingle_set(t.as_py(), k).tobytes() for t in b.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), sets], names=["cid", "shingles"])

    want = classes.select("cid", F.col("rep_id").alias("_d"), F.col("tkey").alias("_t"))
    t = _texts(docs)
    same = (t["tkey"] == F.col("_t")) & t["doc_id"].eqNullSafe(F.col("_d"))
    few = classes.count() <= BROADCAST_IDS
    found = t.join(F.broadcast(want) if few else want, same).select("cid", "text")
    return stored(found.mapInArrow(again, "cid long, shingles binary"), "shingle-sets")


def _longs(c: str, n: int) -> Column:
    """A binary of n * 8 bytes as an array of longs (byte order does not matter here)."""
    return F.array(*(F.conv(F.hex(F.substring(c, 8 * i + 1, 8)), 16, -10).cast("long") for i in range(n)))


def _flips(a: str, b: str) -> Column:
    out = F.lit(0)
    for i in range(BITS // 64):
        out = out + F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i]))
    return out


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the similarity."""
    def check(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for t in _slices(batches):
            ok = []
            for x, y in zip(t.column(2), t.column(3)):
                x, y = np.frombuffer(x.as_py(), "<u8"), np.frombuffer(y.as_py(), "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([t.column(0), t.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    j = pairs.join(sets.select(F.col("cid").alias("a"), F.col("shingles").alias("sa")), "a") \
        .join(sets.select(F.col("cid").alias("b"), F.col("shingles").alias("sb")), "b")
    return j.select("a", "b", "sa", "sb").mapInArrow(check, "a long, b long")


def _runs(batches: Iterator, names: list[str], keys: int, with_key: bool = False):
    """Consecutive rows with the same first ``keys`` columns, as lists of the
    rest (``with_key``: each after its key)."""
    now, rows = None, []
    for b in _slices(batches):
        cols = [b.column(i).to_pylist() for i in range(len(names))]
        for r in zip(*cols):
            if r[:keys] != now:
                if rows:
                    yield (now, rows) if with_key else rows
                now, rows = r[:keys], []
            rows.append(r[keys:])
    if rows:
        yield (now, rows) if with_key else rows


def _tile_pairs(rows: list, bk: int, i: int, j: int, percent: int, most: int):
    """Index pairs of a tile of bucket ``bk`` that have to be confirmed: of
    different components, sharing no earlier band, near by size and by odd
    sketch.  rows: (side, cid, comp, n, odd, bands, ...)"""
    import numpy as np

    side = np.array([r[0] for r in rows])
    at, to = np.flatnonzero(side == i), np.flatnonzero(side == j)
    comp = np.unique([r[2] for r in rows], return_inverse=True)[1]
    n = np.array([r[3] for r in rows], np.int64)
    odd = np.array([np.frombuffer(r[4], "<u8") for r in rows])
    keys = np.array([np.frombuffer(r[5], "<i8") for r in rows])
    band = int(np.flatnonzero(keys[0].byteswap() == bk)[0])  # the keys' bytes are read in order by _longs
    out = []
    for x in at:
        y = to[to > x] if i == j else to
        y = y[comp[y] != comp[x]]
        y = y[100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])]
        if len(y):
            y = y[np.bitwise_count(odd[y] ^ odd[x]).sum(1) <= most]
        if len(y):
            y = y[~(keys[y, :band] == keys[x, :band]).any(1)]
        if len(y):
            out.append((x, y))
    return out


def _flag(most: int, percent: int):
    """Classes of a tile with a pair to confirm."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for (bk, i, j), rows in _runs(batches, TILE, 3, True):
            found = {k for x, y in _tile_pairs(rows, bk, i, j, percent, most) for k in (x, *y.tolist())}
            yield pa.RecordBatch.from_arrays([pa.array([rows[k][1] for k in found], pa.int64())], names=["cid"])

    return run


def _link(most: int, percent: int):
    """Links of a tile, confirmed on full sets: enough of them to connect what
    all of them connect."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for (bk, i, j), rows in _runs(batches, TILE, 3, True):
            todo = _tile_pairs(rows, bk, i, j, percent, most)
            if not todo:
                continue
            sets = [np.frombuffer(r[6], "<u8") for r in rows]
            n = np.array([len(s) for s in sets])
            starts = np.concatenate([[0], np.cumsum(n)])
            ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
            mark, root = np.zeros(ids.max() + 1, np.int64), list(range(len(rows)))

            def find(v, root=root):
                while root[v] != v:
                    root[v] = v = root[root[v]]
                return v

            a, b = [], []
            for x, ys in todo:
                ys = [y for y in ys.tolist() if find(y) != find(x)]
                if not ys:
                    continue
                mine = ids[starts[x]:starts[x + 1]]
                mark[mine] = 1
                for y in ys:
                    both = int(mark[ids[starts[y]:starts[y + 1]]].sum())
                    if 100 * both >= percent * (n[x] + n[y] - both) and find(x) != find(y):
                        a.append(rows[x][1])
                        b.append(rows[y][1])
                        root[find(y)] = find(x)
                mark[mine] = 0
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


TILE = ["bk", "i", "j", "side", "cid", "comp", "n", "odd", "bands", "shingles"]


def _tiled(rows: DataFrame) -> DataFrame:
    """Rows of buckets (bk, chunks, ...) dealt to the tiles they belong to, each
    tile's rows one after another."""
    side = F.pmod(F.xxhash64("cid"), F.col("chunks"))
    d = rows.withColumn("side", side)
    d = d.withColumn("_o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    d = d.withColumn("i", F.least("side", "_o")).withColumn("j", F.greatest("side", "_o"))
    return d.select(*TILE).repartition("bk", "i", "j").sortWithinPartitions("bk", "i", "j")


def near_duplicates(docs: DataFrame, k: int, percent: int = 80) -> DataFrame:
    """-> doc_id, n_shingles, component_id, kept for every document: links are
    pairs whose sets of k-word shingles have a similarity of ``percent`` or more."""
    return _judged(docs, k, percent).drop("tkey")


def _judged(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """``near_duplicates`` with the key of the text, which tells apart the texts of a repeated doc_id."""
    ship_package(docs.sparkSession)
    most = most_flips(percent / 100, BITS, BANDS * ROWS, SIGMAS)
    sig = stored(_signatures(docs, k), "signatures")
    # a class is read back by one of its rows; its smallest id is set apart
    rep = F.min(F.struct("doc_id", "tkey"))
    classes = sig.where("n_shingles > 0").groupBy("cls").agg(
        rep.alias("_r"), F.min("doc_id").alias("low"), F.max("n_shingles").alias("n"),
        F.min("bands").alias("bands"), F.min("odd").alias("odd")) \
        .select(F.monotonically_increasing_id().alias("cid"), "cls", F.col("_r.doc_id").alias("rep_id"),
                F.col("_r.tkey").alias("tkey"), "low", "n", "bands", "odd")  # cid is fixed by being stored
    classes = stored(classes, "classes")

    # a key tells its band too; two longs are all that is shuffled of a band
    entries = classes.select("cid", F.explode(_longs("bands", BANDS)).alias("bk"))
    buckets = entries.groupBy("bk").agg(F.min("cid").alias("hub"), F.count(F.lit(1)).alias("m")).where("m > 1")
    # (a bucket that holds much of the rows is dealt over all tasks in each of these joins)
    hot_bk = hot_keys(entries, ["bk"])[0]
    members = stored(split_join(entries, stored(buckets, "buckets"), ["bk"], "inner", hot_bk), "members")
    side = classes.select("cid", "n", _longs("odd", BITS // 64).alias("odd"))
    star = members.where("hub <> cid").select(F.col("hub").alias("a"), F.col("cid").alias("b")).distinct()
    near = (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")) & (_flips("oa", "ob") <= most)
    star = split_join(stored(star, "star-pairs"), side.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("odd").alias("oa")), ["a"], "inner") \
        .join(side.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("odd").alias("ob")), "b") \
        .where(near).select("a", "b")
    star = stored(star, "star")
    ends = star.select(F.col("a").alias("cid")).unionByName(star.select(F.col("b").alias("cid"))).distinct()
    links = stored(_confirm(star, _sets(docs, classes.join(ends, "cid", "left_semi"), k), percent), "links")
    comps = stored(connected_components(links), "components")

    # buckets that the star has left apart; of two members the star is the only pair
    of = comps.select(F.col("node").alias("cid"), F.col("component").alias("_c"))
    known = members.where("m > 2").join(of, "cid", "left").withColumn("comp", F.coalesce("_c", "cid")).drop("_c")
    apart = known.groupBy("bk").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi")).where("_lo <> _hi")
    apart = stored(split_join(known, apart.select("bk"), ["bk"], "left_semi", hot_bk), "apart")
    if not apart.isEmpty():
        rows = apart.join(classes.select("cid", "n", "odd", "bands"), "cid") \
            .withColumn("chunks", F.ceil(F.col("m") / CHUNK_ROWS).cast("long")).withColumn("shingles", F.lit(None).cast("binary"))
        flagged = stored(_tiled(rows).mapInArrow(_flag(most, percent), "cid long").distinct(), "flagged")
        if not flagged.isEmpty():
            sets = _sets(docs, classes.join(flagged, "cid", "left_semi"), k)
            rows = rows.drop("shingles", "chunks").join(sets, "cid")
            size = rows.groupBy("bk").agg(F.greatest(F.ceil(F.count(F.lit(1)) / CHUNK_ROWS),
                                                     F.ceil(F.sum("n") / CHUNK_SHINGLES)).cast("long").alias("chunks"))
            more = _tiled(rows.join(size, "bk")).mapInArrow(_link(most, percent), "a long, b long")
            links = links.unionByName(stored(more, "more-links"))
            comps = stored(connected_components(links), "components")

    roots = classes.select("cid", "cls", "low").join(comps.select(F.col("node").alias("cid"), F.col("component").alias("root")), "cid", "left") \
        .withColumn("root", F.coalesce("root", "cid"))
    lowest = roots.groupBy("root").agg(F.min("low").alias("component_id"))
    named = roots.join(lowest, "root").select("cls", "component_id")
    with_words = split_join(sig.where("n_shingles > 0").select("doc_id", "tkey", "n_shingles", "cls"), named, ["cls"], "inner") \
        .select("doc_id", "tkey", "n_shingles", "component_id")
    without = sig.where("n_shingles = 0").select("doc_id", "tkey", "n_shingles", F.col("doc_id").alias("component_id"))
    return with_words.unionByName(without).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, k: int, percent: int = 80) -> DataFrame:
    """The documents without those that another of their group stands for, with
    all columns.  Exact repeats of a row (same doc_id and text) go too; rows
    without a doc_id cannot be told apart and stay."""
    found = stored(_judged(docs, k, percent), "near-duplicates")
    drop = found.where("not kept and doc_id is not null").select(F.col("doc_id").alias("_drop"), F.col("tkey").alias("_dropped")).distinct()
    again = found.where("kept and doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    few = drop.count() <= BROADCAST_IDS
    row = (docs["doc_id"] == drop["_drop"]) & (F.xxhash64(docs["text"]) == drop["_dropped"])
    left = docs.join(F.broadcast(drop) if few else drop, row, "left_anti")
    if again.isEmpty():
        return left
    again = again.select(F.col("doc_id").alias("_again"))
    same = left["doc_id"] == again["_again"]
    return left.join(again, same, "left_anti").unionByName(left.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))
