"""Exact dedup by two-pass Bloom filtering, in DataFrame operations alone.

Pass one: each text's hash names a place of a first filter, two bits of one of its 64-bit words. A task folds its rows to
one small row for each place, and only those are counted; the places met twice are the possibly repeated ones. They alone
are entered in the second filter, whose size follows their number and not the number of texts. Pass two tests every row
against it: a row with a bit that isn't set has no equal and passes straight through; only the rest shuffle and are
grouped by their SHA-256."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

BITS_PER_ROW = 32
#: Bits of the second filter for each place met twice, and its bound: 128 MB to each executor. Beyond some 32 million places it only lets more rows shuffle.
BITS_PER_PLACE = 32
MOST_WORDS = 1 << 24
CHUNK = 1 << 10


def normalised(text: str | Column) -> Column:
    return F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), C.SPACES, "")


def _bits(own: Column) -> Column:
    """Two bits of a word, from a hash."""
    bit = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(own, k), F.lit(64)).cast("int"))
    return bit(0).bitwiseOR(bit(8))


def met_twice(hashed: DataFrame, words: int, sha: str = "text_sha256") -> DataFrame:
    """(place): places of the first filter, a word and two of its bits, that more than one row has."""
    place = F.pmod(F.xxhash64(sha), F.lit(words)), _bits(F.xxhash64(sha, F.lit(7)))
    return hashed.groupBy(place[0].alias("word"), place[1].alias("bits")).agg(F.count("*").alias("n")).where("n > 1").select(F.xxhash64("word", "bits").alias("place"))


class Repeated:
    """The filter of hashes met twice in `slim` (which should be a written table), to test any rows against."""

    def __init__(self, slim: DataFrame, sha: str = "text_sha256", most_words: int = MOST_WORDS):
        self.sha, self.first = sha, max(1, slim.count() * BITS_PER_ROW // 64)
        places = C.stash(met_twice(slim, self.first, sha), "places")
        self.words = max(1, min(most_words, places.count() * BITS_PER_PLACE // 64))
        word, bits = self._second(F.col("place"))
        filled = places.groupBy(word.alias("word")).agg(F.bit_or(bits).alias("bits"))
        in_chunk = F.map_from_entries(F.collect_list(F.struct(F.pmod("word", F.lit(CHUNK)).cast("int"), "bits")))  # at most CHUNK entries
        dense = F.transform(F.sequence(F.lit(0), F.lit(CHUNK - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0).cast("long")))
        chunks = filled.groupBy(F.floor(F.col("word") / CHUNK).cast("long").alias("chunk")).agg(in_chunk.alias("m")).select("chunk", dense.alias("filter"))
        self.known = C.stash(chunks, "bloom")  # at most most_words words of 8 bytes, whatever the input

    def _second(self, place: Column) -> tuple[Column, Column]:
        return F.pmod(F.xxhash64(place, F.lit(11)), F.lit(self.words)), _bits(F.xxhash64(place, F.lit(13)))

    def split(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows that surely have no equal, and the rest."""
        chunk, filter_, word, bits, again = C.fresh(rows.columns, "chunk", "filter", "word", "bits", "again")
        place = F.xxhash64(F.pmod(F.xxhash64(self.sha), F.lit(self.first)), _bits(F.xxhash64(self.sha, F.lit(7))))
        at, mask = self._second(place)
        tested = rows.withColumns({word: at, bits: mask}).withColumn(chunk, F.floor(F.col(word) / CHUNK).cast("long"))
        tested = tested.join(F.broadcast(self.known.withColumnsRenamed({"chunk": chunk, "filter": filter_})), chunk, "left")
        held = F.get(F.col(filter_), F.pmod(F.col(word), F.lit(CHUNK)).cast("int"))
        tested = tested.withColumn(again, F.coalesce(held.bitwiseAND(F.col(bits)) == F.col(bits), F.lit(False))).select(*(C.column(c) for c in rows.columns), again)
        return tested.where(~F.col(again)).drop(again), tested.where(again).drop(again)


def hashed_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, row, n_chars, text_sha256) of every row, written once. row tells rows apart that are alike."""
    return C.stash(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
        F.sha2(normalised("text").cast("binary"), 256).alias("text_sha256")), "hashed")


def _best(rows: DataFrame, by: str, n: str, doc_id: str, row: str) -> DataFrame:
    """by: its row with the most code points, then the smallest id (null last), then the first; and how many rows there are."""
    first = F.struct((-F.col(n)).alias("n"), F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col(row).alias("row"))
    return rows.groupBy(by).agg(F.min(first).alias("best"), F.count("*").alias("group_size"))


def groups(docs: DataFrame) -> DataFrame:
    """One row for each row of (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without white space; null counts as empty. Of equal texts the one with the most code
    points stays, then the smallest doc_id (null last), then one of the rows that are alike in both. Other columns are not
    read; a very long text is hashed whole; an empty table gives no rows. A group may hold any share of the rows: it is
    counted before the shuffle, and its rows are dealt over salts."""
    hashed = hashed_rows(docs)
    alone, again = Repeated(hashed).split(hashed)
    best = _best(again, "text_sha256", "n_chars", "doc_id", "row")
    shared = C.salted_join(again, best, "text_sha256", "row", how="inner").select("doc_id", F.col("best.id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256")
    return alone.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256").unionByName(shared)


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns, whatever these are called. Rows that surely have no equal never leave their task.

    Rows stay as in `groups`: one of each group of equal texts; null texts are equal to empty ones; of repeated rows one
    stays; an empty table gives an empty one."""
    columns, (sha, n, doc_id, best) = docs.columns, C.fresh(docs.columns, "sha", "n", "id", "best")
    own = {sha: F.sha2(normalised("text").cast("binary"), 256), n: F.char_length(F.coalesce("text", F.lit(""))), doc_id: F.col("doc_id").cast("long")}
    slim = C.stash(docs.select(*(c.alias(k) for k, c in own.items())), "hashed")
    repeated = Repeated(slim, sha)
    alone, again = repeated.split(docs.withColumns(own))
    _, few = repeated.split(slim)
    found = _best(few, sha, n, doc_id, n).select(sha, F.col("best").alias(best))
    stay = C.salted_join(again, found, sha, doc_id, how="inner").where((F.col(n) == -F.col(f"{best}.n")) & F.col(doc_id).eqNullSafe(F.col(f"{best}.id")))
    plain = [C.column(c) for c in columns]
    return alone.select(*plain).unionByName(stay.dropDuplicates([sha]).select(*plain))  # rows alike in text and id: one of them
