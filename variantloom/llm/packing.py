"""Packing token sequences into fixed windows: best fit, longest pieces first.

An overlong document is first cut into full windows. What remains is dealt by hash into shards of bounded size; in a shard
each piece, from the longest down, goes to the open window with the least room that still holds it, found in a segment
tree indexed by remaining capacity. A shard leaves at most a few windows partly filled, so padding falls with its size."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .tokens import encoder, ending

WINDOW = 2048
SHARD_BYTES = 8 << 20


class CapacityTree:
    """Windows by the room they have left (0 to `most`); each node holds how many windows lie below it."""

    def __init__(self, most: int):
        self.size = 1 << (most + 1 - 1).bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, room: int, window: int) -> None:
        self.open[room].append(window)
        self._add(room, 1)

    def _add(self, room: int, by: int) -> None:
        at = room + self.size
        while at:
            self.count[at] += by
            at >>= 1

    def tightest(self, least: int) -> tuple[int, int] | None:
        """The room and number of a window with the least room of at least `least`, which is taken out."""
        at = least + self.size
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        room = at - self.size
        self._add(room, -1)
        return room, self.open[room].pop()


def best_fit(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of each piece of 1 to `window` ids. Equal pieces are taken in their order."""
    tree, windows = CapacityTree(window), 0
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        found = tree.tightest(n) if n < window else None
        if found is None:
            found, windows = (window, windows), windows + 1
        room, where[i] = found
        offset[i] = window - room
        if room > n:
            tree.put(room - n, int(where[i]))
    return where, offset


def _pieces(path: str, end_id: int, window: int, shards: int):
    def run(batches):
        task, met = TaskContext.get().partitionId(), {}
        for b in C.slices(batches, most=1 << 20):
            ids, rows = ending(*encoder(path, False).encode(b.column("text")), end_id)
            total = np.diff(rows)
            n = -(-total // window)
            doc = np.repeat(np.arange(len(total)), n)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * window
            length = np.minimum(window, total[doc] - start)
            begin = rows[:-1][doc] + start
            # a piece is dealt by its document, place, and how many rows like it its task met before: copies spread too
            own = C.hash_slices(*_row_bytes(b.column("doc_id"), _row_hashes(ids, rows), np.zeros(len(total), np.int64)))
            again = np.empty(len(own), np.int64)
            for i, x in enumerate(own.tolist()):
                again[i] = met[x] = met.get(x, -1) + 1
            seed = C.chain(C.chain(own, C.mix(((again << 24) + task).astype(C.U64)))[doc], start.astype(C.U64))
            yield pa.RecordBatch.from_arrays([
                pa.array((seed % C.U64(shards)).astype(np.int32)), b.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(total[doc]),
                pa.array([C.planes(ids[i : i + k]) for i, k in zip(begin.tolist(), length.tolist())], pa.binary()),
            ], ["shard", "doc_id", "start", "length", "doc_tokens", "packed"])
    return run


def _row_hashes(ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
    raw = np.ascontiguousarray(ids, "<u4")
    return np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b].tobytes()) for a, b in zip(rows.tolist(), rows[1:].tolist())), C.U64, len(rows) - 1)


def _row_bytes(ids: pa.Array, text: np.ndarray, start: np.ndarray) -> tuple:
    both = np.stack([ids.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64), text.view(np.int64), start.astype(np.int64)], 1)
    return both.reshape(-1).view(np.uint8), np.arange(len(both)) * 24, np.full(len(both), 24)


def _pack(window: int):
    def run(table: pa.Table) -> pa.Table:
        packed = table["packed"].to_pylist()
        own = np.fromiter(map(xxhash.xxh3_64_intdigest, packed), C.U64, len(packed))
        by = np.lexsort([own, *(table[c].fill_null(-1).to_numpy() for c in ("doc_tokens", "length", "start", "doc_id"))])  # whatever order the shuffle brought; rows alike in all of it are alike
        table = table.take(pa.array(by))
        length = table["length"].to_numpy()
        where, offset = best_fit(length, window)
        ids = [C.unplanes(x, n)[0].astype("<u4").tobytes() for x, n in zip(table["packed"].to_pylist(), length.tolist())]
        return pa.table({
            "doc_id": table["doc_id"], "start": table["start"], "length": table["length"], "doc_tokens": table["doc_tokens"],
            "sequence_id": (np.int64(table["shard"][0].as_py()) << 32) + where, "offset": offset, "ids": pa.array(ids, pa.binary()),
        })
    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = WINDOW, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Pieces of all whole texts of (doc_id, text), with the sequence and the offset at which each lies.

    doc_id, start, length, doc_tokens, sequence_id, offset, and ids: little-endian unsigned 32-bit integers. A null or empty
    text is its end id alone. Repeated rows and null ids are packed each, and dealt over all shards; other columns are not
    read; a very long text is cut into windows; an empty table gives no rows. Memory is that of one shard."""
    total = C.text_bytes(docs)
    shards = max(1, math.ceil(total / shard_bytes))
    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_pieces(tokenizer, end_id, window, shards), "shard int, doc_id long, start long, length long, doc_tokens long, packed binary")
    # dealt by the shard's number itself: a hash of few shards puts several into one task
    return pieces.repartitionById(C.parts(docs.sparkSession, total, 64 << 20), F.col("shard")).groupBy("shard").applyInArrow(C.lean(_pack(window)), "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
