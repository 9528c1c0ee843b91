"""Token ids in ORC files.

Rows lie in ascending doc_id order, so that stripes and row groups of the files hold narrow ranges of ids: min/max figures
and Bloom filters on doc_id let a reader skip all but a few. Ids are integers in run-length encoding. Each stripe is read by
itself."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common as C
from .tokens import encoder, ending

PART_BYTES = 16 << 20
OPTIONS = {"orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.create.index": "true", "orc.row.index.stride": "2000", "orc.stripe.size": str(32 << 20), "compression": "zstd"}
SCHEMA = "doc_id long, part int, before long, n_tokens int, ids array<int>"


def _encode(path: str, end_id: int):
    def run(batches):
        part, before = TaskContext.get().partitionId(), 0
        for b in C.slices(batches, most=1 << 20):
            ids, rows = ending(*encoder(path, True).encode(b.column("text")), end_id)
            n = len(rows) - 1
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array(np.full(n, part, np.int32)), pa.array(before + rows[:-1]), pa.array(np.diff(rows).astype(np.int32)),
                pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), pa.array(ids.astype(np.int32))),
            ], ["doc_id", "part", "before", "n_tokens", "ids"])
            before += int(rows[-1])
    return run


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, part_bytes: int = PART_BYTES) -> None:
    """Encode every whole text of (doc_id, text) and write the files, one for each range of ids; their names follow that order.

    A null or empty text is its end id alone. Null ids come first; rows of one id lie in the order of their texts; other
    columns are not read; an empty table writes files without rows."""
    spark, total = docs.sparkSession, C.text_bytes(docs)
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(C.parts(spark, total, part_bytes), "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_encode(tokenizer, end_id), SCHEMA).write.options(**OPTIONS).orc(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, part, before (ids of earlier rows in the same part), n_tokens, ids. A filter on doc_id is pushed to stripes and row groups."""
    return spark.read.schema(SCHEMA).orc(path)


def _crc(batches):
    for b in batches:
        ids = b.column("ids")
        at, raw = ids.offsets.to_numpy(), ids.values.to_numpy().astype("<u4")
        crc = [zlib.crc32(raw[i:j]) for i, j in zip(at.tolist(), at[1:].tolist())]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("part"), b.column("before"), pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())], ["doc_id", "part", "before", "n_tokens", "ids_crc32"])


def digest(files: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32, from the files."""
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # one row for each file
    base = parts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("base"))
    rows = files.select("doc_id", "part", "before", "ids").mapInArrow(_crc, "doc_id long, part int, before long, n_tokens long, ids_crc32 long")
    return rows.join(base, "part").select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
