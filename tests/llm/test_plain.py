"""The quality classifier against plain dictionaries, and large families against all pairs."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_llm import documents
from tests.llm.test_whole import brute_components
from variantloom.llm import packing, quality, setjoin
from variantloom.llm.queries import tokenizer


def plain_vector(text):
    """Features by what they are, unhashed: words, pairs, `same` for a word that follows itself, `again` for one that comes after one other."""
    words = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x09-\x0d\x20]+", (text or "").encode())
    words = [w.lower() for w in words]
    n = Counter(("word", w) for w in words)
    n.update(("same",) if a == b else ("pair", a, b) for a, b in zip(words, words[1:]))
    n.update(("again",) for a, b in zip(words, words[2:]) if a == b)
    norm = math.sqrt(sum(n.values()))
    return {k: math.sqrt(c) / norm for k, c in n.items()}


class PlainFtrl:
    def __init__(self, alpha=0.5, beta=1.0, l1=0.002, l2=0.1):
        self.z, self.n, self.alpha, self.beta, self.l1, self.l2 = Counter(), Counter(), alpha, beta, l1, l2

    def weight(self, k):
        z = self.z[k]
        if abs(z) <= self.l1:
            return 0.0
        return (math.copysign(self.l1, z) - z) / ((self.beta + math.sqrt(self.n[k])) / self.alpha + self.l2)

    def probability(self, x):
        return 1 / (1 + math.exp(-sum(self.weight(k) * v for k, v in x.items())))

    def learn(self, x, label, weight):
        w = {k: self.weight(k) for k in x}
        error = weight * (self.probability(x) - label)
        for k, v in x.items():
            g = error * v
            self.z[k] += g - (math.sqrt(self.n[k] + g * g) - math.sqrt(self.n[k])) / self.alpha * w[k]
            self.n[k] += g * g


@pytest.mark.parametrize("share", [3, 2])
def test_classifier_against_plain_dictionaries(spark, share):
    rng = np.random.default_rng(share)
    words = ["alpha", "Beta", "gamma,", "dé-lta", "!!!", "x1", "王伟"]
    rows = [(i, " ".join(rng.choice(words[i % share :], int(rng.integers(1, 25)))), "s") for i in range(90)]
    rows += [(200, None, None), (201, "", "s"), (202, "alpha alpha beta alpha", "s"), (203, " \t\n", "s"), (None, "gamma", "s")]
    docs = documents(spark, rows).repartition(3)
    label = {i: int(i % share != 0) for i in range(90)}
    w = quality.fit(docs, spark.createDataFrame(sorted(label.items()), "doc_id long, quality int"))
    draw = {r.doc_id: r.draw for r in spark.range(90).select(F.col("id").alias("doc_id"), F.xxhash64("id").alias("draw")).collect()}
    seen = sorted((draw[i], label[i], plain_vector(t) | {"bias": 1.0}) for i, t, _ in rows if i in label and zlib.crc32(str(i).encode()) % 3 != 1)
    ones = sum(y for _, y, _ in seen)
    few = 1 if 2 * ones <= len(seen) else 0
    model = PlainFtrl()
    for _ in range(3):
        for _, y, x in seen:
            model.learn(x, y, min(2.0, len(seen) / min(ones, len(seen) - ones) - 1) if y == few else 1.0)
    got = quality.score(docs, w).collect()
    near = {i: model.probability(plain_vector(t) | {"bias": 1.0}) for i, t, _ in rows}
    assert len({round(p, 4) for p in near.values()}) > 30 and len(got) == len(rows) and all(abs(r.score - near[r.doc_id]) < 1e-5 for r in got)


def family(rng, kind, n=70):
    """One family of many different texts: copies of one, a chain in which only neighbours are alike, or two far ends."""
    base = [f"b{i}" for i in range(60)]
    texts = []
    for i in range(n):
        w = list(base)
        if kind == "copies":
            w[int(rng.integers(60))] = f"c{i}"
        elif kind == "chain":
            w = [f"b{(i + j)}" for j in range(60)]
        else:
            far = 25 if i % 2 else 0
            w[:far] = [f"far{j}" for j in range(far)]
            w[int(rng.integers(30, 60))] = f"c{i}"
        texts.append(" ".join(w))
    return texts


@pytest.mark.parametrize("kind", ["copies", "chain", "ends"])
@pytest.mark.parametrize("shingles, k, percent", [(400, 3, 90), (1500, 2, 80)])
def test_large_families_in_pieces(spark, kind, shingles, k, percent):
    rng = np.random.default_rng(5)
    rows = list(enumerate([*family(rng, kind), "something else that no other text is like at all"]))
    docs = documents(spark, [(i, t, "s") for i, t in rows]).repartition(3)
    got = setjoin.link_texts(docs, k, percent, block_bytes=4000, shard_bytes=6000, family_shingles=shingles).collect()
    want = brute_components(rows, k, percent)
    assert len(got) == len(rows) and {(r.doc_id, r.n_shingles, r.component_id) for r in got} == want
    assert kind != "chain" or {c for _, _, c in want} == {0, len(rows) - 1}  # all but one text are one component


def test_shards_are_dealt_evenly(spark):
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("w"), F.col("id").cast("string"), F.lit(" ")), 30).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    pieces = packing.pack(docs, tokenizer("byte_bpe_50k.json"), shard_bytes=-(-total // 4))
    per = {r.task: r.shards for r in pieces.groupBy(F.spark_partition_id().alias("task")).agg(F.countDistinct(F.shiftright("sequence_id", 32)).alias("shards")).collect()}
    assert sorted(per.values()) == [1, 1, 1, 1]  # four shards over four partitions
