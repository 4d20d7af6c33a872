"""Session helpers.

Library code never picks storage on its own: lineage cuts go to the folder the
cluster names in ``spark.checkpoint.dir``.  Only tests and the bench build a
session here, and only they may point that setting at a scratch folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Model calls and the Turtle parser stream Arrow batches of this many rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "graphloom", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench (never used by library code)."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "16g"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.getCheckpointDir() is None:
        # Test/bench only: a per-run scratch folder. A cluster names a shared one.
        scratch = tempfile.mkdtemp(prefix="graphloom-ckpt-", dir=os.environ.get("GRAPHLOOM_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", scratch)
        spark.sparkContext.setCheckpointDir(scratch)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and written tables.

    Read from the session (``spark.checkpoint.dir``) on every master.  Only
    where nothing is set, a folder of its own under the warehouse is used: the
    warehouse is the one other place that driver and executors share.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        conf = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def cut_lineage(df):
    """Reliable checkpoint into spark.checkpoint.dir (survives executor loss).

    The input is persisted first so that the checkpoint job writes what the
    counting job computed instead of computing it a second time.
    """
    from pyspark import StorageLevel
    checkpoint_dir(df.sparkSession)
    p = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = p.checkpoint(eager=True)
    p.unpersist()
    return out


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    import uuid
    return f"{checkpoint_dir(spark).rstrip('/')}/io/{name}-{uuid.uuid4().hex}"


def stored(df, name: str):
    """Write ``df`` once to the shared folder and read it back: a lineage cut
    that later reads can prune columns of.  (zstd: these tables count as disk.)"""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_table(spark: SparkSession, rows: list[tuple], schema: str):
    """A small fixed table (ontology rows, a model sweep) as one SQL VALUES
    clause: parsed once, planned as a local relation of known size (so it is
    broadcast), no Python worker."""
    from pyspark.sql.types import _parse_datatype_string

    st = _parse_datatype_string(schema)
    if not rows:
        return spark.createDataFrame([], st)

    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "true" if v else "false"
        if isinstance(v, (int, float)):
            return repr(v)
        return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"

    names = [f"_c{i}" for i in range(len(st.fields))]
    values = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    cols = ", ".join(f"CAST({n} AS {f.dataType.simpleString()}) AS `{f.name}`" for n, f in zip(names, st.fields))
    return spark.sql(f"SELECT {cols} FROM VALUES {values} AS t({', '.join(names)})")


def ship_package(spark: SparkSession) -> None:
    """Make ``graphloom`` importable in the executors' Python workers (the
    code behind ``mapInPandas`` / pandas UDFs): zip the package once per
    SparkContext and ``addPyFile`` it, as ``--py-files`` would on submit."""
    import zipfile

    import graphloom

    sc = spark.sparkContext
    if getattr(sc, "_graphloom_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(graphloom.__file__)))
    d = tempfile.mkdtemp(prefix="graphloom-pkg-")
    z = os.path.join(d, "graphloom.zip")
    with zipfile.ZipFile(z, "w") as f:
        for dirpath, _, files in os.walk(os.path.join(root, "graphloom")):
            for fn in files:
                if fn.endswith(".py"):
                    full = os.path.join(dirpath, fn)
                    f.write(full, os.path.relpath(full, root))
    sc.addPyFile(z)
    sc._graphloom_shipped = True
