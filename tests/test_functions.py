import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from variantloom.functions import special, vectors
from variantloom.functions.naming import feature_columns, measured_columns
from variantloom.functions.variant import classify_variant, untagged_synonymous

LABELS = [("WT", "WT"), ("WT:half", "WT"), ("L42L", "Synonymous"), ("L42L:downsample-0.5", "Synonymous"), ("G7V", "Single Missense"), ("G7V:x:y", "Single Missense"), ("Q310fs", "Frameshift"), ("WTfs", "Frameshift"),
          ("R9X", "Nonsense"), ("R9*", "Nonsense"), ("K30-", "3nt Deletion"), ("K30-|E31-", "3nt Deletion"), ("K30-|E33-", "Other"), ("K31-|E30-", "Other"), ("K30-|E31-|T32-", "Other"), ("Kx-|E31-", "Other"), ("g7V", "Other"), ("", "Other"), ("G7Vtail", "Single Missense"), (None, None)]


def test_classes(spark):
    rows = spark.createDataFrame(LABELS, "label string, want string").select("label", "want", classify_variant(F.col("label")).alias("got"), untagged_synonymous(F.col("label")).alias("control")).collect()
    assert [r for r in rows if r.got != r.want] == []
    assert {r.label for r in rows if r.control} == {"L42L"}


def test_column_rules(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "Cells_A long, nuclei_b long, meta_x long, Plain long")
    assert feature_columns(df) == ["Cells_A", "nuclei_b", "Plain"]
    assert measured_columns(df) == ["Cells_A"]


def test_kolmogorov_stays_finite(spark):
    rows = spark.createDataFrame([(0.0, 50.0), (0.3, 20.0), (0.9, 400.0)], "d double, n double").select(special.neg_log10_kolmogorov(F.col("d"), F.col("n")).alias("p")).collect()
    assert rows[0].p == 0
    want = -math.log10(2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * 20 * 0.09) for k in range(1, 101)))
    assert rows[1].p == pytest.approx(want, abs=1e-10)
    assert 200 < rows[2].p < 400


def test_normal_tail(spark):
    zs = [0.0, 0.5, -1.96, 6.0]
    rows = spark.createDataFrame([(z,) for z in zs], "z double").select(special.neg_log10_two_sided_normal(F.col("z")).alias("p"), special.normal_cdf(F.col("z")).alias("c")).collect()
    for z, r in zip(zs, rows):
        assert r.p == pytest.approx(-math.log10(math.erfc(abs(z) / math.sqrt(2))), abs=1e-5)
        assert r.c == pytest.approx(0.5 * math.erfc(-z / math.sqrt(2)), abs=1e-6)


def test_f_and_range_tails():
    assert special.f_sf(3.0, 2, 10) == pytest.approx((1 + 2 * 3 / 10) ** -5, rel=1e-9)  # closed form for two groups' freedom
    assert special.studentized_range_sf(3.877, 3, 10) == pytest.approx(0.05, abs=2e-4)
    t = 2.3
    assert special.studentized_range_sf(t * math.sqrt(2), 2, 9) == pytest.approx(special.f_sf(t * t, 1, 9), abs=1e-6)
    assert special.f_sf(float("inf"), 2, 5) == 0 and math.isnan(special.f_sf(float("nan"), 2, 5))


@pytest.mark.parametrize("k, df, q05, q01", [(2, 5, 3.635, 5.702), (3, 10, 3.877, 5.270), (4, 20, 3.958, 5.018), (5, 60, 3.977, 4.818), (10, 30, 4.824, 5.756), (10, 120, 4.560, 5.299), (20, 20, 5.714, 6.823)])
def test_range_tails_against_published_points(k, df, q05, q01):
    """Upper 5 and 1 percent points of the studentized range, as tables print them."""
    got = special.studentized_range_sf_many(np.array([q05, q01, 0.0, -1.0]), k, df)
    assert got[0] == pytest.approx(0.05, abs=2e-4) and got[1] == pytest.approx(0.01, abs=1e-4) and (got[2:] == 1).all()


def test_range_tails_fall_and_agree_with_the_integral():
    q = np.linspace(0.01, 12, 400)
    for k, df in ((3, 7), (8, 40), (24, 5000)):
        got = special.studentized_range_sf_many(q, k, df)
        assert (np.diff(got) <= 1e-12).all()
    w = np.array([0.333, 1.7777, 4.0404])  # between table points: the integral itself
    z, wt = np.polynomial.legendre.leggauss(400)
    z, wt = 9 * z, 9 * wt
    cdf = np.vectorize(lambda v: 0.5 * math.erfc(-v / math.sqrt(2)))
    want = [(5 * np.exp(-z * z / 2) / math.sqrt(2 * math.pi) * (cdf(z) - cdf(z - x)) ** 4 * wt).sum() for x in w]
    assert special._range_cdf(w, 5.0) == pytest.approx(want, abs=1e-9)


def test_ten_thousand_columns(spark):
    n = 10_000
    values = np.random.default_rng(1).normal(size=n)
    df = spark.range(2).select((F.col("id") == 0).alias("meta_is_control"), F.lit(values.tolist()).alias("meta_v")).select("meta_is_control", *(F.when(F.col("meta_is_control"), 1.0).otherwise(F.col("meta_v")[i]).alias(f"x{i}") for i in range(n)))
    names = [f"x{i}" for i in range(n)]
    got = {r[0]: r[1] for r in df.select("meta_is_control", vectors.norm(names)).collect()}
    assert got[True] == pytest.approx(100) and got[False] == pytest.approx(np.linalg.norm(values))


def test_query_vector_is_one_row(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, None)], "a double, b double")
    assert [r[0] for r in df.select(vectors.query_dot(["a", "b"], df.limit(1))).collect()] == [5.0, 3.0]
    for bad in (df, df.limit(0)):
        with pytest.raises(ValueError):
            vectors.query_dot(["a", "b"], bad)


def test_mann_whitney_exact_against_enumeration():
    from itertools import combinations

    x, y = np.array([1.2, 3.4, 5.1]), np.array([0.4, 2.2, 3.0, 4.1])
    both = np.sort(np.concatenate([x, y]))
    u = sum((a > y).sum() for a in x)
    us = [sum((a > np.setdiff1d(both, c)).sum() for a in c) for c in combinations(both, 3)]
    assert special.mann_whitney_greater(x, y) == pytest.approx(np.mean([v >= u for v in us]))


def test_cosine_and_impact(spark):
    df = spark.createDataFrame([(True, 1.0, 0.0), (False, 1.0, 0.0), (False, 0.0, 1.0), (False, -1.0, 0.0), (False, 2.0, None)], "meta_is_control boolean, f1 double, f2 double")
    assert [r.meta_impact_score for r in vectors.impact_score(df).collect()] == pytest.approx([0, 0, 0.5, 1, 0])
