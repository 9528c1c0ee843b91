"""Mixing sources to target weights by hash-threshold histograms, in DataFrame operations alone.

A source's target is met by whole passes over it and, for the rest, by the documents whose hash lies below a threshold.
Words are summed by source and hash bucket; where the running sum crosses the budget, only that bucket is split again,
level by level, until one hash is left. What the threshold leaves of a budget is then filled by up to FILLS hashes beyond
it, each the one with the most words that still fit; the last is the one whose words come nearest, fitting or not. A document is judged by its own hash alone: nothing is sorted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common as C

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
LEVELS, BITS = 6, 10
FILLS, SHORT = 3, 8


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, key, size, hash) of every row, written once. A hash has LEVELS * BITS bits."""
    size = F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), "")).cast("long")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"))
    digits = F.substring(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), F.col("size").cast("string")).cast("binary")), 1, LEVELS * BITS // 4)
    return C.stash(slim.withColumn("key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))).withColumn("hash", F.conv(digits, 16, 10).cast("long")), "sized")


def targets(slim: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """(key, source_size, target, whole, rest): one row for each source. Every window here runs over one row a source."""
    by = slim.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    by = by.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    by = by.withColumn("cap", (most * F.col("source_size")).cast("double")).withColumn("ratio", F.col("cap") / F.col("weight"))
    first = W.orderBy("ratio", "key").rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy()
    by = by.withColumn("left", F.sum("source_size").over(every).cast("double") - F.coalesce(F.sum("cap").over(first), F.lit(0.0)))
    by = by.withColumn("level", F.col("left") / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(first), F.lit(0.0))))
    by = by.withColumn("water", F.min_by("level", F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "key"))).over(every))
    by = by.withColumn("target", F.round(F.least("cap", F.col("water") * F.col("weight")), 6))
    whole = F.when(F.col("source_size") > 0, F.least(F.lit(most), F.floor(F.try_divide("target", "source_size")))).otherwise(0)
    return by.withColumn("whole", whole.cast("long")).select("key", "source_size", "target", "whole", (F.col("target") - F.col("whole") * F.col("source_size")).alias("rest"))


def _cross(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(key, below, need): the hash below which the rows (key, size, hash) of a key stay within its budget (key, need), and what is left of that. A level's histogram has at most 2 ** BITS rows a source."""
    running = W.partitionBy("key").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    state = budgets.select("key", "need", F.lit(0).cast("long").alias("prefix"))
    for level in range(LEVELS):
        shift = (LEVELS - level) * BITS
        inside = rows.select("key", "size", F.shiftright("hash", shift).alias("prefix"), F.shiftright("hash", shift - BITS).alias("bucket"))
        words = inside.join(state, ["key", "prefix"]).groupBy("key", "bucket").agg(F.sum("size").alias("size"), F.first("need").alias("need"))
        words = words.withColumn("upto", F.sum("size").over(running)).where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("size") < F.col("need")))
        state = words.select("key", (F.col("need") - (F.col("upto") - F.col("size"))).alias("need"), F.col("bucket").alias("prefix"))
    return state.select("key", F.col("prefix").alias("below"), "need")


def thresholds(slim: DataFrame, by: DataFrame) -> DataFrame:
    """by, with what decides which documents are taken once more: below, the first threshold; limit and short_below, the second one, for documents of at most `limit` words; more, single hashes."""
    first = C.stash(_cross(slim, by.where("rest > 0").select("key", F.col("rest").alias("need"))).withColumn("limit", F.floor(F.col("need") / SHORT).cast("long")), "threshold")
    short = slim.where("size > 0").join(small(first.select("key", "below", "limit")), "key").where("hash >= below and size <= limit").select("key", "size", "hash")
    short = C.stash(short.groupBy("key", "hash").agg(F.sum("size").alias("size")), "short")
    whole = short.groupBy("key").agg(F.sum("size").alias("all"))  # where all short ones fit, all are taken
    second = _cross(short, first.select("key", "need")).select("key", F.col("below").alias("cut"), F.col("need").alias("left"))
    state = first.join(whole, "key", "left").join(second, "key", "left").select(
        "key", "below", "limit", F.coalesce("cut", F.lit(1 << (LEVELS * BITS))).alias("short_below"), F.coalesce("left", F.col("need") - F.coalesce("all", F.lit(0))).alias("need"), F.array().cast("array<long>").alias("more"))
    state = C.stash(state, "threshold")
    # a hash beyond the thresholds helps where its words are fewer than twice what is missing
    beyond = slim.where("size > 0").join(small(state.select("key", "below", "limit", "short_below", F.col("need").alias("missing"))), "key").where("hash >= below and not (size <= limit and hash < short_below) and size < 2 * missing")
    beyond = C.stash(beyond.groupBy("key", "hash").agg(F.sum("size").alias("words")), "beyond")
    for k in range(FILLS):
        off = F.abs(F.col("words") - F.col("need"))
        helps = off < F.col("need") if k == FILLS - 1 else F.col("words") <= F.col("need")
        near = beyond.join(state, "key").where(~F.array_contains("more", F.col("hash")) & helps).groupBy("key").agg(F.min(F.struct(off.alias("off"), "hash", "words")).alias("best"))
        state = state.join(near, "key", "left").select("key", "below", "limit", "short_below", (F.col("need") - F.coalesce("best.words", F.lit(0))).alias("need"), F.when(F.col("best").isNull(), F.col("more")).otherwise(F.array_append("more", F.col("best.hash"))).alias("more"))
    rule = F.struct(*(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("below", "limit", "short_below")), F.coalesce("more", F.array().cast("array<long>")).alias("more"))
    return by.join(state, "key", "left").select("key", "source_size", "target", "whole", rule.alias("rule"))


def _times(whole: str, rule: str, size: str, hash_: Column) -> Column:
    """How often a document is taken."""
    of = lambda c: F.col(f"{rule}.{c}")
    return F.col(whole) + ((hash_ < of("below")) | ((F.col(size) <= of("limit")) & (hash_ < of("short_below"))) | F.array_contains(of("more"), hash_)).cast("long")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row for each row of (doc_id, text, source): doc_id, size, source_size, target, taken.

    Null sources are a source of their own, the last. Null texts have size 0. Rows alike in id and size share a hash and so
    a fate; of hashes that come equally near a budget the smaller is taken. Other columns are not read; a very long text
    counts whole; an empty table gives no rows. The table of sources is joined as Spark sees fit; a source that holds a
    third of the rows is split by the adaptive skew join."""
    slim = sized(docs)
    edges = C.stash(thresholds(slim, C.stash(targets(slim, weights, most), "targets")), "edges")
    taken = F.col("size") * _times("whole", "rule", "size", F.col("hash"))
    return slim.join(small(edges), "key").select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def small(edges: DataFrame, most: int = 100_000) -> DataFrame:
    """Broadcast the table of sources where it is counted to have at most `most` rows of a few numbers."""
    return F.broadcast(edges) if edges.count() <= most else edges


def take(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """The rows of the mix, each as often as it is taken, with all columns, whatever these are called. Rows without words stay once: they cost no budget. Null sources and ids and repeated rows count as in `mix`; an empty table gives an empty one."""
    columns, slim = docs.columns, sized(docs)
    key, size, whole, rule, times, copy = C.fresh(columns, "key", "size", "whole", "rule", "times", "copy")
    edges = small(C.stash(thresholds(slim, C.stash(targets(slim, weights, most), "targets")), "edges"))
    plain = docs.withColumns({key: F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n")),
                              size: F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), "")).cast("long")})
    digits = F.substring(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")), F.lit("|"), F.col(size).cast("string")).cast("binary")), 1, LEVELS * BITS // 4)
    often = F.when(F.col(size) == 0, 1).otherwise(_times(whole, rule, size, F.conv(digits, 16, 10).cast("long")))
    joined = plain.join(edges.select(F.col("key").alias(key), F.col("whole").alias(whole), F.col("rule").alias(rule)), key).withColumn(times, often.cast("int"))
    return joined.where(F.col(times) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*(C.column(c) for c in columns))
