"""A corpus pipeline: classify, drop exact and near copies, mix the sources, and pack what is left.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last keep the columns of `documents`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from variantloom.llm import dedup, mixing, packing, quality, setjoin
from variantloom.llm.common import stash
from variantloom.llm.queries import table, tokenizer
from variantloom.session import ship


#: Near copies: sets of five-word shingles that are alike in 80 percent or more.
SHINGLE, PERCENT = 5, 80


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labelled ones, doesn't reject.

    Null and empty texts are scored as any other, by the bias alone; repeated rows share their fate, a very long text is scored whole; without labels every score is 0.5 and all stay; an empty table gives an empty one."""
    ship(spark)
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, null and empty ones being equal; ties go to the smallest doc_id (null last), of repeated rows one stays; an empty table gives an empty one."""
    ship(spark)
    return dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by near-equal shingle sets: the one with the smallest doc_id (null last). Texts without a word are linked with nothing and stay; of repeated rows one stays; an empty table gives an empty one."""
    ship(spark)
    return setjoin.keep_one(docs, SHINGLE, PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them. Null sources are one source; texts without a word stay once; rows alike in id and size share a fate; an empty table gives an empty one."""
    ship(spark)
    return mixing.take(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences. A null or empty text is its end id, a very long one is cut into windows; repeated rows are packed each; an empty table gives no rows."""
    ship(spark)
    return packing.digest(packing.pack(docs, tokenizer("byte_bpe_50k.json")))


STAGES = [("quality classifier", classify), ("exact dedup", drop_copies), ("n-gram jaccard join", drop_near_copies), ("mixing", mix_sources), ("packing", pack)]

#: Hashed features, shingle links and tokenizers can't be told in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stash(docs, name.replace(" ", "_"))
    return docs
