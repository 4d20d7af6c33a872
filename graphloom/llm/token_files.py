"""Operator 4: token ids as flat binary files.

A dataset is a folder of parts in ascending document order.  Part k has

* ``.bin``: the ids of its documents one after another, unsigned little-endian
  integers of ``width`` bytes (2 where the vocabulary allows, else 4);
* ``.idx``: n_docs + 1 unsigned 64-bit offsets into the part, in ids;
* ``.ids``: n_docs signed 64-bit document ids.

and one row of the manifest (a Parquet table, so only parts of committed tasks
count: a retried or lost task leaves files that nothing names).  A part's base
is the prefix sum of the ids of the parts before it.  Readers map the files
(``numpy.memmap``) where the folder is local or mounted, and read ranges of
them elsewhere.

Defined results: a null text is empty (its document holds only the end id);
rows with a null doc_id come first (the manifest counts them); rows that repeat
a doc_id are ordered by text; an empty table gives an empty manifest; further
columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.tokens import encoder
from graphloom.session import scratch_path, ship_package, stored

MANIFEST = ("part long, name string, width int, n_docs long, n_null_ids long, n_tokens long")
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"
#: Documents whose ids a reader holds at once, at most.
READ_DOCS = 2000


def _fs(folder: str):
    from pyarrow import fs

    if "://" not in folder and ":/" in folder:  # Hadoop writes file:/x
        folder = folder.replace(":/", ":///", 1)
    return fs.FileSystem.from_uri(folder)


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, units: str, end_id: int,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text, append ``end_id``, write the files of the
    format above into ``folder``; -> the manifest, stored."""
    spark = docs.sparkSession
    ship_package(spark)

    def write(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        enc, end = encoder(tokenizer_path, units), np.asarray([end_id], "<u4").tobytes()
        part, store, name = TaskContext.get().partitionId(), None, None
        bin_f = idx_f = ids_f = None
        n_docs = n_null = n_tokens = 0
        width = enc.width
        for b in batches:
            if not b.num_rows:
                continue
            if name is None:
                store, root = _fs(folder)
                store.create_dir(root, recursive=True)
                name = f"part-{part:06d}-{uuid.uuid4().hex}"
                bin_f, idx_f, ids_f = (store.open_output_stream(f"{root}/{name}.{x}") for x in ("bin", "idx", "ids"))
                idx_f.write(np.zeros(1, "<u8").tobytes())
            lens = []
            for text in b.column(1):
                ids = enc.encode(text.as_py()) + end
                lens.append(len(ids) // 4)
                bin_f.write(np.frombuffer(ids, "<u4").astype("<u2").tobytes() if width == 2 else ids)
            idx_f.write((n_tokens + np.cumsum(lens)).astype("<u8").tobytes())
            ids_f.write(np.asarray(b.column(0).fill_null(0), "<i8").tobytes())
            n_docs, n_null, n_tokens = n_docs + b.num_rows, n_null + b.column(0).null_count, n_tokens + sum(lens)
        if name is not None:
            for f in (bin_f, idx_f, ids_f):
                f.close()
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int64()), "name": [name], "width": pa.array([width], pa.int32()),
                 "n_docs": pa.array([n_docs], pa.int64()), "n_null_ids": pa.array([n_null], pa.int64()),
                 "n_tokens": pa.array([n_tokens], pa.int64())})

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # whole texts move once, by range of id, and are encoded where they land
    d = d.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.length("text")) \
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    return stored(d.mapInArrow(write, MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Read the files back: doc_id, start (ids of all documents before it),
    n_tokens, ids_crc32 (of the ids as 32-bit little-endian integers)."""
    spark = manifest.sparkSession
    ship_package(spark)
    # one row per file: the prefix sum over them is small
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def read(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for m in b.to_pylist():
                store, root = _fs(folder)

                def arr(kind: str, dtype: str, first: int, n: int, path=f"{root}/{m['name']}", store=store):
                    if store.type_name == "local":
                        return np.memmap(f"{path}.{kind}", dtype, "r")[first:first + n]
                    with store.open_input_file(f"{path}.{kind}") as f:
                        size = np.dtype(dtype).itemsize
                        return np.frombuffer(f.read_at(n * size, first * size), dtype)

                for d in range(0, m["n_docs"], READ_DOCS):
                    n = min(READ_DOCS, m["n_docs"] - d)
                    off = arr("idx", "<u8", d, n + 1).astype(np.int64)
                    ids = arr("ids", "<i8", d, n)
                    tokens = arr("bin", f"<u{m['width']}", int(off[0]), int(off[-1] - off[0]))
                    crc = [zlib.crc32(tokens[s:e].astype("<u4").tobytes())
                           for s, e in zip(off[:-1] - off[0], off[1:] - off[0])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.asarray(ids), pa.int64(), mask=np.arange(d, d + n) < m["n_null_ids"]),
                         pa.array(m["base"] + off[:-1], pa.int64()), pa.array(np.diff(off), pa.int64()),
                         pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return parts.repartition(n, "part").mapInArrow(read, ROWS)


def token_dataset(docs: DataFrame, tokenizer_path: str, units: str, end_id: int) -> DataFrame:
    """Write the files into a fresh shared folder and read them back."""
    folder = scratch_path(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, folder, tokenizer_path, units, end_id), folder)
