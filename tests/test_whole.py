"""Registered model queries cover their whole job: all pairs, the whole pool, the default number of wild-type cells."""

import os

import pytest
from pyspark.sql import functions as F

from variantloom import registry
from variantloom.functions.variant import classify_variant
from variantloom.operators import models

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


def test_models_over_whole_tables(spark, monkeypatch):
    """What the queries hand over to training, without the training."""
    rounds = []

    def held(rows, features, ids, params=models.Params(), seed=42):
        rounds.append(params.rounds)
        return rows.groupBy("key").agg(F.count_if(F.col("positive") == 1).alias("pos"), F.count_if(F.col("positive") == 0).alias("neg"), F.lit("").alias("model"), F.lit("").alias("importance"))

    monkeypatch.setattr(models, "train_groups", held)
    c = registry.cells(spark, SF).cache()
    wt = {r.meta_barcode: r["count"] for r in c.where("meta_aa_changes = 'WT'").groupBy("meta_barcode").count().collect() if r["count"] >= 50}
    pool = c.where("meta_aa_changes <> 'WT'").where(classify_variant(F.col("meta_aa_changes")) == "Synonymous").count()
    pairs = registry.wild_type_pairs(spark, SF).collect()
    assert len(pairs) == len(wt) * (len(wt) - 1) // 2 > 6
    assert {(r.key, r.pos, r.neg) for r in registry.wild_type_vs_pool(spark, SF).collect()} == {(b, n, pool) for b, n in wt.items()}
    assert {r.pos for r in registry.one_vs_wild_type(spark, SF).collect()} == {5000} and sum(wt.values()) > 5000
    assert rounds == [100, 100, 100]
