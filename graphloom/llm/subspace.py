"""Operator 2: near-duplicate vectors by a subspace pigeonhole join.

Unit vectors with cosine >= c are at most 2 - 2c apart (squared).  After a seeded
rotation the dimensions are cut into blocks; each block's budget is its share of
that distance by dimensions, so a pair within the whole must be within budget in
at least one block.  Each block is range-joined: cells around pivots (a bounded
sample of the vectors, by hash order), every vector at home in its nearest
pivot's cell and a visitor in each later cell whose bisecting plane is nearer
than the radius, which no pair within the radius can avoid.  Cells are compared in tiles of
bounded size by numpy:

1. on single-precision block coordinates, with slack: which vectors of a cell
   have a candidate there at all;
2. for those, on whole vectors in double precision: a pair is confirmed by its
   cosine, in the first block where it is within budget, so it counts once.

Only sums of links and the edges that connect a tile leave a task; pairs do not.
Equal vectors are one class with a weight from the start.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing (n_links 0, component of their own); vectors of
different length do not link; a null vec_id is a vector like any other, its
component is the smallest id there is in it; repeated rows are separate vectors
that link; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.near_dup import _runs
from graphloom.operators.linking import connected_components
from graphloom.session import ship_package, stored

BLOCK_DIMS = 16
#: Pivots of a block: about a quarter of the root of the classes, at most this many.
MOST_PIVOTS = 4096
#: A tile's chunk of block coordinates, and the rows of it compared at once.
CHUNK, STRIP = 8192, 1024
#: A tile's chunk of whole vectors.
WHOLE_CHUNK = 1024
#: Pairs whose whole vectors are compared at once.
AT_ONCE = 50_000
SLACK = 1e-9


def _rotation(dim: int):
    """A seeded random rotation of ``dim`` dimensions."""
    import numpy as np

    q, r = np.linalg.qr(np.random.RandomState(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _blocks(dim: int) -> list[tuple[int, int]]:
    n = max(1, round(dim / BLOCK_DIMS))
    cut = [dim * i // n for i in range(n + 1)]
    return list(zip(cut, cut[1:]))


def _read(vectors: DataFrame, id_col: str, col: str) -> DataFrame:
    """vec_id, cls (digest of the values; null: links with nothing), vec (doubles)."""
    def read(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash

        for b in batches:
            cls, vec = [], []
            for v in b.column(1):
                x = None
                if v.is_valid and len(v) and not v.values.null_count:
                    x = np.asarray(v.values, "<f8") + 0.0  # no negative zero
                    x = x if np.isfinite(x).all() and x.any() else None
                    if x is not None:  # the direction counts; this keeps squares finite
                        top = np.abs(x).max()
                        x = x if 1e-100 < top < 1e100 else x / top
                cls.append(None if x is None else xxhash.xxh3_128_digest(x.tobytes()))
                vec.append(None if x is None else x.tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cls, pa.binary()), pa.array(vec, pa.binary())],
                                             names=["vec_id", "cls", "vec"])

    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(col).cast("array<double>")) \
        .mapInArrow(read, "vec_id long, cls binary, vec binary")


def _unit(raw: list):
    import numpy as np

    x = np.array([np.frombuffer(v, "<f8") for v in raw])
    return x / np.sqrt((x * x).sum(1))[:, None]


def _rotated(classes: DataFrame) -> DataFrame:
    """Add ``rot``, the rotated unit vector: made once, so every task reads the same numbers."""
    def turn(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            raw = b.column(3).to_pylist()
            dims = np.array([len(v) // 8 for v in raw])
            out = [b""] * len(raw)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                for k, v in zip(at, _unit([raw[k] for k in at]) @ _rotation(int(d))):
                    out[k] = v.tobytes()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(dims, pa.int32()), pa.array(out, pa.binary())],
                                             names=["cls", "low", "n", "vec", "dim", "rot"])

    return classes.mapInArrow(turn, "cls binary, low long, n long, vec binary, dim int, rot binary")


PACKED = "dim int, block int, cell int, home boolean, n long, ids binary, coords binary"


def _cells(classes: DataFrame, pivots: dict, reach: float) -> DataFrame:
    """The classes at home in, or visiting, each block's cells; those that an
    Arrow batch holds of a cell travel as one row (ids, single-precision
    coordinates)."""
    def deal(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            cls, dims = np.array(b.column(0).to_pylist(), "V16"), np.asarray(b.column(1))
            rot, rows = b.column(2).to_pylist(), []
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x, p = np.array([np.frombuffer(rot[k], "<f8") for k in at]), pivots[int(d)]
                for block, (s, e) in enumerate(_blocks(int(d))):
                    y, c = x[:, s:e], p[:, s:e]
                    far = (y * y).sum(1)[:, None] + (c * c).sum(1) - 2 * y @ c.T
                    home = far.argmin(1)
                    apart = np.sqrt(np.maximum((c * c).sum(1)[:, None] + (c * c).sum(1) - 2 * c @ c.T, 0))[home]
                    radius = math.sqrt(reach * (e - s) / d) + 1e-6
                    # distance to the plane between home and the other pivot; equal pivots have none
                    visit = far - far[np.arange(len(at)), home][:, None] <= 2 * radius * apart + 1e-9
                    visit &= np.arange(len(p)) > home[:, None]
                    y4 = y.astype("<f4")
                    for cell in range(len(p)):
                        for is_home, k in ((True, np.flatnonzero(home == cell)), (False, np.flatnonzero(visit[:, cell]))):
                            if len(k):
                                rows.append((int(d), block, cell, is_home, len(k), cls[at[k]].tobytes(), y4[k].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                    (pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.binary(), pa.binary()))],
                names=["dim", "block", "cell", "home", "n", "ids", "coords"])

    return classes.select("cls", "dim", "rot").mapInArrow(deal, PACKED)


KEYS = ["dim", "block", "cell", "i", "j"]


def _tiled(rows: DataFrame, chunk: int, cols: list[str]) -> DataFrame:
    """Deal each cell's rows to tiles of two chunks; each tile's rows come one
    after another, keys first."""
    cell = KEYS[:3]
    size = rows.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / chunk).cast("long").alias("chunks"))
    d = rows.join(size, cell).withColumn("side", F.pmod(F.xxhash64("cls"), F.col("chunks")))
    d = d.withColumn("_o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    d = d.withColumn("i", F.least("side", "_o")).withColumn("j", F.greatest("side", "_o"))
    return d.select(*KEYS, "side", "home", "cls", *cols, *(F.col(k).alias(f"{k}_") for k in KEYS)) \
        .repartition(*KEYS).sortWithinPartitions(*KEYS)


def _packed_tiles(packs: DataFrame, chunk: int) -> DataFrame:
    """Tiles of a chunk of a cell's home rows (i) with a later chunk of them or
    a chunk of its visitors (j); ``part`` is the side that a row is on.
    Visitors do not meet each other: they meet where one of them is at home."""
    cell = KEYS[:3]

    def chunks(home) -> Column:
        return F.ceil(F.coalesce(F.sum(F.when(F.col("home") == home, F.col("n"))), F.lit(0)) / chunk).cast("long")

    size = packs.groupBy(*cell).agg(chunks(True).alias("nh"), chunks(False).alias("nv")).where("nh > 0")
    d = packs.join(size, cell)
    c = F.pmod(F.xxhash64("ids"), F.when(F.col("home"), F.col("nh")).otherwise(F.col("nv")))
    nh, zero = F.col("nh"), F.lit(0).cast("long")
    at_home = F.transform(F.sequence(zero, nh + F.col("nv") - 1), lambda j: F.struct(
        F.when(j < nh, F.least(c, j)).otherwise(c).alias("i"), F.when(j < nh, F.greatest(c, j)).otherwise(j).alias("j"),
        ((j < nh) & (j < c)).alias("part")))
    visiting = F.transform(F.sequence(zero, nh - 1), lambda i: F.struct(i.alias("i"), (nh + c).alias("j"), F.lit(True).alias("part")))
    d = d.withColumn("_t", F.explode(F.when(F.col("home"), at_home).otherwise(visiting)))
    return d.select(*cell, "_t.i", "_t.j", "_t.part", "home", "ids", "coords") \
        .repartition(*KEYS).sortWithinPartitions(*KEYS)


def _near(rows: list, x, budget: float):
    """Index pairs (a < b in place) of a tile within the block's budget, of
    which at least one is at home."""
    import numpy as np

    i, j = rows[0][-2:]
    side, home = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    a, b = np.flatnonzero(side == i), np.flatnonzero(side == j)
    sq = (x * x).sum(1)
    close = sq[a][:, None] + sq[b] - 2 * x[a] @ x[b].T <= budget
    close &= home[a][:, None] | home[b]
    if i == j:
        close &= a[:, None] < b
    p, q = np.nonzero(close)
    return a[p], b[q]


def _flag(reach: float):
    """Per tile: the vectors with a candidate there."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        names = [*KEYS, "part", "home", "ids", "coords"]
        for (d, block, cell, i, j), rows in _runs(batches, names, 5, True):
            s, e = _blocks(d)[block]
            budget = np.float32(reach * (e - s) / d + 1e-5)

            def side(part, rows=rows, width=e - s):
                got = [r for r in rows if r[0] == part]
                ids = np.frombuffer(b"".join(r[2] for r in got), "V16")
                home = np.repeat([r[1] for r in got], [len(r[2]) // 16 for r in got]).astype(bool)
                return ids, home, np.frombuffer(b"".join(r[3] for r in got), "<f4").reshape(-1, width)

            a_ids, a_home, a = side(False)
            b_ids, b_home, b = (a_ids, a_home, a) if i == j else side(True)
            a_found, b_found = np.zeros(len(a), bool), np.zeros(len(b), bool)
            b_sq = (b * b).sum(1) - budget
            for at in range(0, len(a), STRIP):
                x = a[at:at + STRIP]
                # |x|^2 + |y|^2 - 2xy <= budget
                gap = x @ b.T
                gap *= -2
                gap += b_sq
                gap += (x * x).sum(1)[:, None]
                close = gap <= 0
                if i == j:
                    close &= np.arange(at, at + len(x))[:, None] < np.arange(len(b))
                a_found[at:at + len(x)] |= close.any(1)
                b_found |= close.any(0)
            if i == j:
                a_found |= b_found
                b_found[:] = False
            ids = a_ids[a_found].tolist() + b_ids[b_found].tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), v), pa.int32()) for v in (d, block, cell)]
                + [pa.array(np.concatenate([a_home[a_found], b_home[b_found]]), pa.bool_()), pa.array(ids, pa.binary())],
                names=["dim", "block", "cell", "home", "cls"])

    return run


def _link(reach: float, cosine: float):
    """Per tile: links to add to each class (a, null b), and the edges that
    connect what is linked (a, b)."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        names = [*KEYS, "side", "home", "cls", "n", "vec", "rot", *(f"{k}_" for k in KEYS)]
        for rows in _runs(batches, names, 5):
            d, block = rows[0][-5:-3]
            cut = _blocks(d)
            n = np.array([r[3] for r in rows], np.int64)
            vec, rot = (np.array([np.frombuffer(r[k], "<f8") for r in rows]) for k in (4, 5))
            norm = np.sqrt((vec * vec).sum(1))
            s, e = cut[block]
            p, q = _near(rows, np.ascontiguousarray(rot[:, s:e]), reach * (e - s) / d + 1e-9)
            links, root = np.zeros(len(rows), np.int64), list(range(len(rows)))

            def find(v, root=root):
                while root[v] != v:
                    root[v] = v = root[root[v]]
                return v

            a, b = [], []
            for at in range(0, len(p), AT_ONCE):
                x, y = p[at:at + AT_ONCE], q[at:at + AT_ONCE]
                for k, (s, e) in enumerate(cut[:block + 1]):
                    gap = rot[x, s:e] - rot[y, s:e]
                    within = (gap * gap).sum(1) <= reach * (e - s) / d + SLACK
                    keep = within if k == block else ~within  # the first block that the pair is within
                    x, y = x[keep], y[keep]
                keep = (vec[x] * vec[y]).sum(1) / (norm[x] * norm[y]) >= cosine
                x, y = x[keep], y[keep]
                np.add.at(links, x, n[y])
                np.add.at(links, y, n[x])
                for u, v in zip(x.tolist(), y.tolist()):
                    if find(u) != find(v):
                        root[find(v)] = find(u)
                        a.append(rows[u][2])
                        b.append(rows[v][2])
            k = np.flatnonzero(links).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows[v][2] for v in k] + a, pa.binary()), pa.array([None] * len(k) + b, pa.binary()),
                 pa.array(links[k].tolist() + [0] * len(a), pa.int64())], names=["a", "b", "links"])

    return run


def vector_duplicates(vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", col: str = "embedding") -> DataFrame:
    """-> vec_id, n_links, component_id, kept for every row of ``vectors``."""
    import numpy as np

    ship_package(vectors.sparkSession)
    reach = 2 - 2 * cosine
    v = stored(_read(vectors, id_col, col), "vectors")
    classes = v.where("cls is not null").groupBy("cls").agg(
        F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("n"), F.min("vec").alias("vec"))
    classes = stored(_rotated(classes), "vector-classes")

    pivots = {}
    for r in classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect():  # one row per vector length
        k = min(MOST_PIVOTS, max(8, round(math.sqrt(r["n"]) / 4)))
        rows = classes.where(F.col("dim") == r["dim"]).select(F.xxhash64("cls").alias("h"), "rot").orderBy("h").limit(k).collect()
        pivots[r["dim"]] = np.array([np.frombuffer(x["rot"], "<f8") for x in rows])

    cells = stored(_cells(classes, pivots, reach), "cells")
    flagged = stored(_packed_tiles(cells, CHUNK).mapInArrow(
        _flag(reach), "dim int, block int, cell int, home boolean, cls binary").distinct(), "flagged")
    whole = flagged.join(classes.select("cls", "n", "vec", "rot"), "cls")
    found = stored(_tiled(whole, WHOLE_CHUNK, ["n", "vec", "rot"]).mapInArrow(
        _link(reach, cosine), "a binary, b binary, links long"), "vector-links")
    comps = connected_components(found.where("b is not null").select("a", "b"))

    links = found.where("b is null").groupBy(F.col("a").alias("cls")).agg(F.sum("links").alias("links"))
    roots = classes.select("cls", "low", "n").join(comps.select(F.col("node").alias("cls"), F.col("component").alias("root")), "cls", "left") \
        .join(links, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    lowest = roots.groupBy("root").agg(F.min("low").alias("component_id"))
    named = roots.join(lowest, "root").select("cls", "component_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    good = v.where("cls is not null").select("vec_id", "cls").join(named, "cls").select("vec_id", "n_links", "component_id")
    bad = v.where("cls is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(bad).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
