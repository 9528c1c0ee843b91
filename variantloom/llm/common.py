"""Shared pieces: the shared folder, word splitting over whole byte blocks, packed exchange payloads."""

from __future__ import annotations

import ctypes
import gc
import math
import uuid
import zlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java and Python spelling of one word.
WORD = "[^\\x20\\x09-\\x0D]+"
SPACES = " \t\n\x0b\f\r"
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
U64 = np.uint64


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it. Where it is unset and everything runs
    in one process (local mode, as in tests), it is a folder of the warehouse; a cluster without one is refused."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def column(name: str):
    """A column by its whole name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(columns: list[str], *names: str) -> list[str]:
    """The names, with marks before them until none is a column's, whatever its case."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stash(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage and survives a lost executor. by: a column of few values, each of which gets a folder."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(df: DataFrame, text: str = "text") -> int:
    """Bytes of all texts: one number, used only to choose how many blocks and shards there are."""
    return df.agg(F.sum(F.octet_length(text))).first()[0] or 0


def parts(spark: SparkSession, total: int, each: int) -> int:
    """Shuffle partitions for so many bytes: at least the session's setting."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / each))


def salted_join(rows: DataFrame, by_key: DataFrame, key: str, salt: str, salts: int = 16, how: str = "left") -> DataFrame:
    """Join with a side that has one row for each key, while a key may hold a third of `rows`: its rows are dealt over `salts` tasks, the small side's rows are repeated."""
    name, = fresh(rows.columns + by_key.columns, "_salt")
    left = rows.withColumn(name, F.pmod(F.xxhash64(salt), F.lit(salts)).cast("int"))
    right = by_key.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [key, name], how).drop(name)


def crc(doc_id) -> int:
    """crc32 of the id as text; a null id counts as empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def remainders(ids: list, mod: int) -> np.ndarray:
    return np.fromiter((crc(x) % mod for x in ids), np.int64, len(ids))


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of texts (null: empty), and where each row begins and the last ends."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks)
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def binary_array(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """offsets: one more than there are values."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(values))])


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each lower-cased word of whole texts in order, and where each row's words begin (and the end)."""
    data, rows = utf8(texts)
    solid = ~SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    heads = rows[:-1][rows[:-1] < len(data)]
    first[heads] = solid[heads]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(solid & ~np.append(solid[1:] & ~first[1:], False)) + 1 if len(data) else starts
    return hash_slices(LOWER[data], starts, ends - starts), np.searchsorted(starts, rows)


def hash_slices(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hash of each slice of a byte array, eight bytes at a time; what lies beyond 64 bytes goes to xxhash."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    loads = np.ndarray(len(padded) - 7, U64, padded, strides=1)
    out, left, at = mix(lengths.astype(U64)), np.arange(len(starts)), 0
    while len(left) and at < 64:
        rest = lengths[left] - at
        part = loads[starts[left] + at] & ~U64(0) >> (U64(64) - U64(8) * np.minimum(rest, 8).astype(U64))
        out[left] = chain(out[left], part)
        at += 8
        left = left[rest > 8]
    for i in left:
        out[i] ^= U64(xxhash.xxh3_64_intdigest(data[starts[i] + at : starts[i] + lengths[i]].tobytes()))
    return out


def factorize(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct values and each value's place among them; sorting is several times faster here than hashing."""
    by = np.argsort(values)
    ordered = values[by]
    new = np.ones(len(values), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    place = np.empty(len(values), np.int64)
    place[by] = np.cumsum(new) - 1
    return ordered[new], place


def distinct(values: np.ndarray, counts: bool = False):
    """Ascending distinct values, and how often each occurs."""
    ordered = np.sort(values)
    at = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, np.int64)
    return (ordered[at], np.diff(at, append=len(ordered))) if counts else ordered[at]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def chain(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a sequence from the hash of its start and that of the next item."""
    return mix(left * U64(0x9E3779B97F4A7C15) + right)


def planes(values: np.ndarray) -> bytes:
    """Integers as one plane for each byte: the mostly zero high bytes then compress to nothing in the shuffle."""
    values = np.ascontiguousarray(values, U64)
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + values.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unplanes(packed: bytes, n: int, at: int = 0) -> tuple[np.ndarray, int]:
    """The integers, and where the next ones begin."""
    width, out = packed[at], np.zeros((n, 8), np.uint8)
    end = at + 1 + width * n
    out[:, :width] = np.frombuffer(packed, np.uint8, width * n, at + 1).reshape(width, n).T
    return out.reshape(-1).view(U64), end


def pack_sorted(keys: np.ndarray, *more: np.ndarray) -> bytes:
    """Ascending keys as differences, then other columns."""
    head = len(keys).to_bytes(8, "little")
    return head + planes(np.diff(keys, prepend=U64(0))) + b"".join(planes(x) for x in more)


def unpack_sorted(packed: bytes, columns: int, at: int = 0) -> tuple[list[np.ndarray], int]:
    """The keys and the other columns, and where what follows them begins."""
    n = int.from_bytes(packed[at : at + 8], "little")
    deltas, at = unplanes(packed, n, at + 8)
    out = [np.cumsum(deltas, dtype=U64)]
    for _ in range(columns):
        x, at = unplanes(packed, n, at)
        out.append(x)
    return out, at


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def unsqueeze(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def freeze(table: pa.Table) -> bytes:
    """A table as compressed bytes."""
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema) as stream:
        stream.write_table(table)
    return zstandard.ZstdCompressor(level=3).compress(out.getvalue())


def thaw(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(unsqueeze(data)).read_all()


def pack_counted(columns: list[tuple[np.ndarray, np.ndarray]]) -> bytes:
    """Lists of ascending distinct keys, each with a small number. The low planes of the keys' differences are noise and
    stay as they are; the highest ones, and the numbers, hold little and are compressed, each kind by itself."""
    low, top, numbers = [], [], []
    for keys, n in columns:
        first = int(keys[0]) if len(keys) else 0
        packed = planes(np.diff(keys, prepend=U64(first)))
        cut = len(packed) - len(keys)
        low.append(len(keys).to_bytes(8, "little") + first.to_bytes(8, "little") + packed[:cut])
        top.append(packed[cut:])
        numbers.append(planes(n))
    parts = [b"".join(low), squeeze(b"".join(top)), squeeze(b"".join(numbers))]
    return b"".join(len(x).to_bytes(8, "little") for x in parts) + b"".join(parts)


def unpack_counted(packed: bytes, lists: int) -> list[tuple[np.ndarray, np.ndarray]]:
    a, b, c = (int.from_bytes(packed[i : i + 8], "little") for i in (0, 8, 16))
    low, top, numbers = packed[24 : 24 + a], unsqueeze(packed[24 + a : 24 + a + b]), unsqueeze(packed[24 + a + b : 24 + a + b + c])
    out, at, top_at, number_at = [], 0, 0, 0
    for _ in range(lists):
        n, first = int.from_bytes(low[at : at + 8], "little"), int.from_bytes(low[at + 8 : at + 16], "little")
        below = 1 + (low[at + 16] - 1) * n
        deltas, _end = unplanes(low[at + 16 : at + 16 + below] + top[top_at : top_at + n], n)
        counts, number_at = unplanes(numbers, n, number_at)
        out.append((np.cumsum(deltas, dtype=U64) + U64(first), counts))
        at, top_at = at + 16 + below, top_at + n
    return out


def shard_cuts(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's range of ascending 64-bit keys begins, and the end: a shard is a range of the key's upper half."""
    return np.searchsorted((keys >> U64(32)) * U64(shards) >> U64(32), np.arange(shards + 1, dtype=U64))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of runs, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def release() -> None:
    """Give freed memory back to the system: a Python worker lives on, and would hold its largest block's memory beside the next stage's."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


def lean(run):
    """A function of one or two tables that releases memory when it is done. Spark counts its arguments."""
    def one(table):
        try:
            return run(table)
        finally:
            release()

    def two(left, right):
        try:
            return run(left, right)
        finally:
            release()

    return two if run.__code__.co_argcount == 2 else one


def slices(batches, text: str = "text", most: int = 8 << 20):
    """Cut record batches so that each piece holds at most so many bytes of text, or one row."""
    for batch in batches:
        at, ends = 0, np.cumsum(np.diff(utf8(batch.column(text))[1])) if batch.num_rows else []
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
            yield batch.slice(at, stop - at)
            at = stop
    release()
