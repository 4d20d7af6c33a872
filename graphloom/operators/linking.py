"""Connected components of an edge list, as a general helper.

Randomised contraction (Boegeholz, Brand and Todor, "In-database connected
component analysis"): in each round every node goes to the node of least hash in
its closed neighbourhood, with another hash each round, and the edges are
rewritten to those.  A constant share of the nodes goes in each round on any
graph, so the rounds grow with the logarithm of the nodes, their cost falls
geometrically, and all of them together cost a few passes over the edges.
Nodes are 64-bit numbers meanwhile, and names are put back once.  Edges of hubs
are dealt over all tasks (``skew.split_join``).  There is no round limit; what a
round leaves below ``LEFT`` edges is finished in one task.  Where components lie
within groups (graphs), groups of up to ``LEFT`` rows are moved once and each is
finished where it then lies; only larger ones go through the rounds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.operators.skew import by_size, hot_keys, hot_limit, sketch_of, split_join
from graphloom.session import stored

#: Edges, at most, that one task finishes.
LEFT = 100_000
#: Edges below which no hub is looked for.
FEW = 100_000


def _size_and_hubs(e: DataFrame) -> tuple[int, list[int], list[int]]:
    r = e.agg(F.count(F.lit(1)).alias("n"), sketch_of(["a"]).alias("ta"), sketch_of(["b"]).alias("tb")).first()
    if r["n"] <= FEW:
        return r["n"], [], []
    limit = hot_limit(r["n"], int(e.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ta, tb = ([x["item"] for x in r[t] or [] if x["count"] > limit] for t in ("ta", "tb"))
    return r["n"], ta, tb


def _united(pairs) -> dict:
    """node -> the smallest node of its component, by union and find."""
    up: dict = {}

    def find(x):
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(up)}


def _finish(batches):
    """(a, b) of all edges left -> (v, root)."""
    import pyarrow as pa

    to = _united((a, b) for t in batches for a, b in zip(t.column(0).to_pylist(), t.column(1).to_pylist()))
    v = list(to)
    for i in range(0, len(v), 20000):
        part = v[i:i + 20000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([to[x] for x in part], pa.int64())], names=["v", "root"])


def _finish_each(batches):
    """(keys..., pairs) with the pairs of a whole group -> (keys..., node, component)."""
    import pyarrow as pa

    for t in batches:
        pairs, names = t.column(t.num_columns - 1), [*t.schema.names[:-1], "node", "component"]
        flat = pairs.flatten()
        a, b, at = flat.field(0).to_pylist(), flat.field(1).to_pylist(), 0
        group, nodes, least = [], [], []
        for i, n in enumerate(pairs.value_lengths().to_pylist()):
            to = _united(zip(a[at:at + n], b[at:at + n]))
            at += n
            group += [i] * len(to)
            nodes += to
            least += to.values()
        kind = flat.type.field(0).type
        yield pa.RecordBatch.from_arrays([*[t.column(k).take(pa.array(group, pa.int64())) for k in range(t.num_columns - 1)],
                                          pa.array(nodes, kind), pa.array(least, kind)], names=names)


def _roots(edges: DataFrame) -> DataFrame:
    """edges (a, b) of bigint, no loops -> (v, root): one row per node, one root
    per component."""
    e = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    n, hot_a, hot_b = _size_and_hubs(e)
    steps = []
    while n > LEFT:
        def h(c: str) -> Column:
            return F.xxhash64(F.lit(len(steps)), F.col(c))

        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.struct(h("b").alias("h"), "b")).alias("m"))
        own = F.struct(h("a").alias("h"), F.col("a").alias("b"))
        to = stored(least.select(F.col("a").alias("v"), F.least(own, "m")["b"].alias("r")), "contraction")
        steps.append(to)
        e = split_join(e, to.select(F.col("v").alias("a"), F.col("r").alias("ra")), ["a"], "inner", hot_a)
        e = split_join(e, to.select(F.col("v").alias("b"), F.col("r").alias("rb")), ["b"], "inner", hot_b)
        e = stored(e.where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
        n, hot_a, hot_b = _size_and_hubs(e)
    # (no more than LEFT rows)
    roots = e.coalesce(1).mapInArrow(_finish, "v long, root long")
    for to in reversed(steps):
        hot = hot_keys(to, ["r"])[0]
        roots = split_join(to, roots.withColumnRenamed("v", "r"), ["r"], "left", hot).select("v", F.coalesce("root", "r").alias("root"))
    return stored(roots, "roots")


def _number(keys: list[str], c: str, seed: int) -> Column:
    """A node's number: a hash of graph and name (nulls told from one another)."""
    cols = [F.col(x) for x in [*keys, c]]
    return F.xxhash64(F.lit(seed), *cols, *[x.isNull() for x in cols])


def connected_components(edges: DataFrame, keys: list[str] | None = None, nodes: DataFrame | None = None) -> DataFrame:
    """edges (keys..., a, b) -> (keys..., node, component) for every node that
    has an edge to another node; ``component`` is the smallest node reachable.
    Components never cross ``keys``.  Loops and repeated edges change nothing;
    rows with a null end or key are ignored; no edges give no rows.  ``nodes``
    (keys..., node), repeated or not, are in the result whether they have an edge
    or not."""
    keys = keys or []
    e = edges.where(reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in [*keys, "a", "b"]]) & (F.col("a") != F.col("b"))).select(*keys, "a", "b")
    if not keys:
        return _by_rounds(e, keys, nodes)
    # a node by itself is a loop
    pairs = e if nodes is None else e.unionByName(nodes.select(*keys, F.col("node").alias("a"), F.col("node").alias("b")))
    small, large = by_size(pairs, keys, LEFT)
    kind, kinds = dict(e.dtypes)["a"], [f"`{k}` {t}" for k, t in e.dtypes if k in keys]
    whole = small.groupBy(*keys).agg(F.collect_set(F.struct("a", "b")).alias("pairs")) \
        .mapInArrow(_finish_each, ", ".join([*kinds, f"node {kind}", f"component {kind}"]))
    if large is None:
        return whole
    loops = F.col("a").eqNullSafe(F.col("b"))
    alone = None if nodes is None else large.where(loops).select(*keys, F.col("a").alias("node"))
    return whole.unionByName(_by_rounds(large.where(~loops), keys, alone))


def _by_rounds(e: DataFrame, keys: list[str], nodes: DataFrame | None) -> DataFrame:
    """The same for edges without loops and nulls, by contraction."""
    if not keys and nodes is None and all(dict(e.dtypes)[c] == "bigint" for c in "ab"):
        named = _roots(e.select("a", "b")).select(F.col("v").alias("node"), "root")
    else:
        # both ends in one pass over the edges
        ends = e.select(*keys, F.explode(F.array("a", "b")).alias("node"))
        ends = stored((ends if nodes is None else ends.unionByName(nodes.select(*keys, "node"))).distinct(), "nodes")
        seed = 0
        while not ends.groupBy(_number(keys, "node", seed).alias("v")).count().where("count > 1").isEmpty():
            seed += 1  # two nodes of one number: other numbers
        roots = _roots(e.select(_number(keys, "a", seed).alias("a"), _number(keys, "b", seed).alias("b")))
        named = stored(ends.withColumn("v", _number(keys, "node", seed)).join(roots, "v", "left")
                       .select(*keys, "node", F.coalesce("root", "v").alias("root")), "labels")
    least = named.groupBy("root").agg(F.min("node").alias("component"))
    return split_join(named, least, ["root"], "inner").select(*keys, "node", "component")
