import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from variantloom.functions.naming import CONTROL, LABEL
from variantloom.operators import boosting, comparisons, models, qc, sampling, selection
from variantloom.operators.aggregate import AGGREGATORS, aggregate, qq, ranks
from variantloom.operators.batchcorrect import BatchCorrector
from variantloom.operators.embedding import pca
from variantloom.operators.normalize import Normalizer

NAN, INF = float("nan"), float("inf")


def labelled(spark, groups, controls):
    rows = [("WT", True, v) for v in controls] + [(g, False, v) for g, vs in groups.items() for v in vs]
    return spark.createDataFrame(rows, f"{LABEL} string, {CONTROL} boolean, f1 double")


def values(df, name):
    return {r[LABEL]: r[f"f1_{name}"] for r in df.collect()}


@pytest.fixture(scope="module")
def pool():
    rng = np.random.default_rng(3)
    ref = rng.normal(size=40).round(1).tolist()
    return ref, {"R": rng.normal(0.4, 1, 12).round(1).tolist(), "T": [1.0, 1.0, 2.0, 2.0, 2.0, 3.0], "S": [5.0] * 4, "N": [1.0, None, NAN, INF, 2.0]}


def test_rank_statistics_against_brute_force(spark, pool):
    ref, groups = pool
    df = labelled(spark, groups, ref)
    got = {n: values(aggregate(df, n), n) for n in ("KS", "signedKS", "AUROC", "KSnegLogP", "AUROCnegLogP")}
    r = np.array(ref)
    for g, vs in groups.items():
        x = np.array([v for v in vs if v is not None and math.isfinite(v)])
        at = np.concatenate([x, r])
        diff = np.array([(x <= v).mean() - (r <= v).mean() for v in at])
        up, down = max(diff.max(), 0), max(-diff.min(), 0)
        assert got["KS"][g] == pytest.approx(max(up, down))
        assert got["signedKS"][g] == pytest.approx(up if up >= down else -down)
        u = sum((a > r).sum() + 0.5 * (a == r).sum() for a in x)
        assert got["AUROC"][g] == pytest.approx(u / (len(x) * len(r)))
        _, t = np.unique(at, return_counts=True)
        n = len(at)
        z = (u - len(x) * len(r) / 2) / math.sqrt(len(x) * len(r) / 12 * (n + 1 - (t**3 - t).sum() / (n * (n - 1))))
        assert got["AUROCnegLogP"][g] == pytest.approx(-math.log10(math.erfc(abs(z) / math.sqrt(2))), abs=1e-5)


def test_ranks_are_the_same_in_windows_and_in_packed_features(spark, pool):
    ref, groups = pool
    rows = [("WT", True, v, -v, None) for v in ref] + [(g, False, v, 0.0, 1.0) for g, vs in groups.items() for v in vs] + [(None, False, 0.5, -0.0, NAN), ("Z", None, 3.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, f"{LABEL} string, {CONTROL} boolean, `f.1` double, f2 double, f3 double").repartition(3)
    got, want = ({(r[0] or "", r["feature"]): tuple(r)[2:] for r in ranks(df, LABEL, ["f.1", "f2", "f3"], n).collect()} for n in (10**6, 0))
    assert set(got) == set(want) and ("", "f2") in got and not any(f == "f3" for _, f in got)
    assert all(got[k] == pytest.approx(want[k]) for k in got)


def test_quantile_correlation(spark, pool):
    ref, groups = pool
    got = values(aggregate(labelled(spark, groups, ref), "QQ"), "QQ")
    other = values(qq(labelled(spark, groups, ref), LABEL, ["f1"], most_cells=0), "QQ")
    assert got.keys() == other.keys() and all(got[k] == pytest.approx(other[k]) for k in got)
    q = np.linspace(0, 1, 100)
    assert got["R"] == pytest.approx(np.corrcoef(np.quantile(groups["R"], q), np.quantile(ref, q))[0, 1])
    assert got["S"] is None


@pytest.mark.parametrize("name", list(AGGREGATORS))
def test_no_value_keeps_the_row(spark, name):
    df = labelled(spark, {"A": [None, NAN, INF], "B": [1.0, 2.0]}, [1.0, 3.0, 2.0])
    got = values(aggregate(df, name), name)
    assert set(got) == {"A", "B"} and got["A"] is None
    assert name not in ("KS", "AUROC", "QQ") or values(aggregate(labelled(spark, {"B": [1.0]}, [None, INF]), name), name) == {"B": None}


def test_simple_statistics_and_errors(spark):
    df = labelled(spark, {"A": [1.0, 2.0, 3.0], "B": [10.0]}, [0.0])
    assert values(aggregate(df, "MAD"), "MAD") == {"A": 1.0, "B": 0.0}
    assert values(aggregate(df, "std"), "std") == {"A": 1.0, "B": None}
    assert aggregate(df, "mean", block_list={"f1_mean"}).columns == [LABEL]
    with pytest.raises(ValueError):
        aggregate(df, "nope")


def test_normalizer(spark, tmp_path):
    df = spark.createDataFrame([(True, 1.0, 5.0), (True, 3.0, 5.0), (True, NAN, 5.0), (False, 5.0, 7.0)], f"{CONTROL} boolean, f1 double, f2 double")
    n = Normalizer.fit(df)
    n.save(spark, str(tmp_path / "n"))
    rows = Normalizer.load(spark, str(tmp_path / "n")).apply(df).collect()
    assert rows[3].f1 == pytest.approx(3 / math.sqrt(2))
    assert rows[2].f1 is None and all(r.f2 is None for r in rows)


def test_qc_order_matters(spark):
    rows = [("V", "a", 0)] * 3 + [("V", "b", 0)] * 3 + [("W", "c", 0)] * 3 + [("W", "d", 0)] * 2 + [("V", "a", 5), ("V", "e", None)]
    df = spark.createDataFrame(rows, f"{LABEL} string, meta_barcode string, meta_edit_distance long")
    cells, barcodes, variants = qc.qc(df, 3, 2, 1)
    assert {r[LABEL] for r in cells.collect()} == {"V"} and cells.count() == 6
    assert {r.meta_barcode: r.barcode_ok for r in barcodes.collect()} == {"a": 3, "b": 3, "c": 3, "d": None}
    assert {r[LABEL]: r.variant_barcode_count_ok for r in variants.collect()} == {"V": 2, "W": None}
    m = {r[LABEL]: r for r in qc.metadata(df).collect()}
    assert m["V"].meta_num_cells == 8 and m["V"].meta_barcode_num_unique == 3 and m["V"].meta_barcode_counts[0] == ("a", 4)


def cells(spark, n=400):
    rng = np.random.default_rng(1)
    rows = [(i, lab, f"{lab}_{i % 4}", f"b{i // 3 % 3}", float(rng.normal(2.5 if lab == "M2K" else 0)), float(rng.normal())) for i, lab in enumerate(["WT", "A1A", "M2K"] * n)]
    return spark.createDataFrame(rows, f"id long, {LABEL} string, meta_barcode string, meta_batch string, Cells_A double, Cells_B double")


def test_places_in_parts_are_those_of_one_window(spark):
    rows = [("WT", i % 3, i) for i in range(900)] + [(None, 0, i) for i in range(40)] + [("A1B", None, 1), ("A1B", None, 1), ("A1B", None, None), ("Z", 2, 7)]
    df = spark.createDataFrame(rows, "g string, `h.1` int, id int").repartition(5)
    own = sampling.draw(3, "id")
    for by in ("g", ["g", "h.1"]):
        got = sampling.placed(df, by, own, "id")
        assert got.columns == df.columns + ["_place", "_size"]
        of = W.partitionBy(*("`h.1`" if b == "h.1" else b for b in ([by] if isinstance(by, str) else by)))
        want = df.withColumns({"_place": F.row_number().over(of.orderBy(own, "id")), "_size": F.count("*").over(of)})
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    assert sampling.placed(df.limit(0), "g", own, "id").count() == 0


def test_sampling(spark):
    df = cells(spark, 100)
    a = {r.id for r in sampling.pseudo_variants(df, 0.25, ["Synonymous"], "id", 1).collect()}
    assert len(a) == 25 and a == {r.id for r in sampling.pseudo_variants(df, 0.25, ["Synonymous"], "id", 1).collect()}
    assert a != {r.id for r in sampling.pseudo_variants(df, 0.25, ["Synonymous"], "id", 2).collect()}
    assert sampling.pseudo_variants(df, 101, ["Synonymous"], "id").count() == 0
    for bad in (0.0, 1.5, 0, True):
        with pytest.raises(ValueError):
            sampling.pseudo_variants(df, bad, ["Synonymous"], "id")
    split = {(r[LABEL], r.split): r["count"] for r in sampling.stratified_split(df, LABEL, models.SHARES, "id").groupBy(LABEL, "split").count().collect()}
    assert split[("WT", "train")] == 80 and split[("WT", "eval")] == 10 and split[("WT", "test")] == 10
    assert sampling.downsample(df, F.col(LABEL) == "WT", 7, "id").groupBy(LABEL).count().where(f"{LABEL} = 'WT'").first()["count"] == 7
    assert sampling.cap_groups(df, "meta_barcode", 5, "id").groupBy("meta_barcode").count().agg(F.max("count")).first()[0] == 5
    halves = sampling.replicate_halves(df, [0, 1], "id").groupBy("seed", "half").count().collect()
    assert {r["count"] for r in halves} == {150}
    assert {r[0] for r in sampling.top_groups(df.groupBy(LABEL).agg(F.count("*").alias("n")), LABEL, 1).collect()} == {"A1A"}
    with pytest.raises(ValueError):
        sampling.top_groups(df.groupBy(LABEL).agg(F.count("*").alias("n")), LABEL, 1, "best")
    blocked = spark.createDataFrame([("WT_0", False), ("WT_1", True)], "barcode string, barcode_ok boolean")
    assert sampling.exclude_barcodes(df, blocked).where("meta_barcode = 'WT_0'").isEmpty()


def test_selection(spark):
    one = spark.createDataFrame([("A", 1.0, 2.0), ("B", 4.0, 2.0), ("C", 2.0, 2.0), ("D", 3.0, 2.0)], f"{LABEL} string, f1 double, f2 double")
    two = spark.createDataFrame([("A", 2.0, 1.0), ("B", 5.0, 3.0), ("C", 1.0, 2.0), ("D", 4.0, 2.0)], f"{LABEL} string, f1 double, f2 double")
    r = {x.feature: x.r for x in selection.correlate_halves(one, two).collect()}
    assert r["f1"] == pytest.approx(np.corrcoef([1, 4, 2, 3], [2, 5, 1, 4])[0, 1]) and r["f2"] is None
    ok = {x.feature: x.feature_ok for x in selection.bootstrap_block_list(selection.correlate_halves(one, two)).collect()}
    assert ok == {"f1": True, "f2": False}
    lists = [spark.createDataFrame([("f1", True), ("f2", b)], "feature string, feature_ok boolean") for b in (True, False)]
    assert {x.feature: (x.n_batches, x.n_ok, x.feature_ok) for x in selection.agree_block_lists(lists).collect()} == {"f1": (2, 2, True), "f2": (2, 1, False)}
    assert selection.drop_blocked(one, lists[1]).columns == [LABEL, "f1"]
    assert {x[LABEL]: x.f1 for x in selection.cross_batch_median([one, two]).collect()}["A"] == 1.5
    rng = np.random.default_rng(0)
    rows = [(f"v{i}", float(x), float(2 * x + 1e-3 * y), float(y), 1.0) for i, (x, y) in enumerate(rng.normal(size=(60, 2)))]
    kept = selection.select_features(spark.createDataFrame(rows, f"{LABEL} string, a double, b double, c double, d double")).columns
    assert "c" in kept and "d" not in kept and len({"a", "b"} & set(kept)) == 1


def test_nulls_elsewhere_hide_no_correlation(spark):
    rng = np.random.default_rng(1)
    rows = [(f"v{i}", float(x), float(2 * x + 1e-4 * y), float(y) if i % 3 else None, None if i % 3 else float(z), float(w) if i % 3 == 1 else None) for i, (x, y, z, w) in enumerate(rng.normal(size=(60, 4)))]
    df = spark.createDataFrame(rows, f"{LABEL} string, a double, b double, c double, d double, e double")
    kept = selection.select_features(df).columns
    assert len({"a", "b"} & set(kept)) == 1 and {"c", "d", "e"} <= set(kept)
    r = selection.pairwise_correlations(df, ["a", "b", "c", "d"], stripe=3)
    x, y = (np.array([q[i] for q in rows if q[1] is not None and q[3] is not None], float) for i in (1, 3))
    assert r[0, 2] == pytest.approx(np.corrcoef(x, y)[0, 1]) and r[2, 0] == pytest.approx(r[0, 2]) and r[2, 3] == 0


def test_another_statistic_can_be_added(spark):
    from variantloom.operators.aggregate import _wide, register

    register("most", lambda df, label, features: _wide(df, label, features, "most", F.max))
    try:
        assert values(aggregate(labelled(spark, {"A": [1.0, 3.0]}, [0.0]), "most"), "most") == {"A": 3.0}
        with pytest.raises(ValueError):
            register("most", lambda *_: None)
    finally:
        del AGGREGATORS["most"]


def test_models_take_a_feature_block_list_and_scores_come_in_parts(spark):
    df, block = cells(spark, 200), spark.createDataFrame([("Cells_B", False), ("Cells_A", True)], "feature string, feature_ok boolean")
    held = models.one_vs_wild_type(df, "id", min_cells=50, params=boosting.Params(rounds=3), blocked_features=block)
    assert {r.feature for r in models.importance_table(held).collect()} <= {"Cells_A"}
    one, parts = (sorted(models.score_cells(df, held, most_bytes=n).select("meta_barcode", "A1A", "M2K").collect()) for n in (1 << 27, 1))
    assert one == parts and len(one) == 600
    got = models.batch_vs_batch(df, "id", params=boosting.Params(rounds=3), blocked_features={"Cells_B"}).collect()
    assert sum(r.n_cells for r in got) == 600 and sum(r.model is not None for r in got) == 3


def test_batch_correction_moves_to_the_wild_type(spark):
    df = cells(spark, 200).withColumn("Cells_A", F.col("Cells_A") + F.when(F.col("meta_batch") == "b1", 10.0).otherwise(0.0)).unionByName(spark.createDataFrame([(-1, "L1L", "x", "b0", 1.0, 1.0)], cells(spark, 1).schema))
    out = BatchCorrector.fit(df, ["Cells_A", "Cells_B"]).transform(df)
    means = [r[0] for r in out.groupBy(LABEL, "meta_batch").agg(F.avg("Cells_A")).select("avg(Cells_A)").collect()]
    assert np.ptp(means) < 1e-6 and out.where(f"{LABEL} = 'L1L'").isEmpty()
    with pytest.raises(ValueError):
        BatchCorrector.fit(df.where(f"{LABEL} <> 'WT'"), ["Cells_A"])


def test_anova_and_tukey(spark):
    rng = np.random.default_rng(5)
    groups = [rng.normal(m, 1, n) for m, n in ((0, 12), (0.5, 20), (3, 9))]
    rows = [("A1A", f"b{i}", float(v)) for i, g in enumerate(groups) for v in g]
    df = spark.createDataFrame(rows, f"{LABEL} string, meta_batch string, f1 double")
    got = comparisons.anova(df, features=["f1"]).first()
    every = np.concatenate(groups)
    within = sum(((g - g.mean()) ** 2).sum() for g in groups)
    between = ((every - every.mean()) ** 2).sum() - within
    assert got.f_value == pytest.approx((between / 2) / (within / (len(every) - 3))) and got.p_value < 1e-6
    scores = df.select(LABEL, F.col("meta_batch").alias("meta_barcode"), F.col("f1").alias("score"))
    t = {(r.barcode, r.comparison_barcode): r for r in comparisons.tukey(scores, min_cells=9).collect()}
    assert len(t) == 3 and t[("b0", "b2")].reject and t[("b0", "b2")].mean_diff == pytest.approx(groups[2].mean() - groups[0].mean())
    assert {r.barcode for r in comparisons.barcode_block_list(comparisons.tukey(scores, min_cells=9)).collect()} == {"b0", "b1", "b2"}


def test_booster_and_models(spark):
    df = cells(spark)
    got = {r.key: r for r in models.one_vs_wild_type(df, "id", min_cells=50, downsample_wt=200, params=boosting.Params(rounds=20)).collect()}
    assert got["M2K"].test_auroc > 0.85 and got["A1A"].test_auroc < 0.75 and got["M2K"].error is None
    held = models.one_vs_wild_type(df, "id", min_cells=50, params=boosting.Params(rounds=5))
    own = models.own_score(models.score_cells(df, held))
    assert own.where(f"{LABEL} = 'WT'").agg(F.count("score")).first()[0] == 0 and own.where(f"{LABEL} = 'M2K'").agg(F.avg("score")).first()[0] < 0.5
    pairs = models.wild_type_pairs(df, "id", min_cells=50, params=boosting.Params(rounds=3)).collect()
    assert len(pairs) == 6 and all(p.n_cells_a == 100 for p in pairs)
    assert models.wild_type_pairs(df, "id", min_cells=10_000).count() == 0
    assert models.wild_type_vs_pool(df, "id", min_cells=50, params=boosting.Params(rounds=3)).count() == 4
    with pytest.raises(ValueError):
        models.wild_type_vs_pool(df, "id", classes=("Nonsense",))
    assert models.batch_vs_batch(df, "id", params=boosting.Params(rounds=3)).count() == 9
    b = boosting.Booster(["x"], 2, boosting.Params(rounds=5, subsample=1.0, colsample=1.0))
    x = np.array([[0.0], [1.0], [2.0], [3.0], [np.nan]] * 10)
    y = np.array([0, 0, 1, 1, 1] * 10)
    assert (np.round(boosting.Booster.load(b.fit(x, y).dump()).predict(x)) == y).all()


def test_pca_against_svd(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(30, 4)) * [3, 2, 1, 0.5]
    df = spark.createDataFrame([(f"v{i}", *map(float, r), None) for i, r in enumerate(x)], f"{LABEL} string, a double, b double, c double, d double, e double")
    scores, loadings, variance = pca(df, 2)
    c = x - x.mean(0)
    _, s, vt = np.linalg.svd(c, full_matrices=False)
    got = np.array([r[1:] for r in sorted(scores.collect(), key=lambda r: int(r[0][1:]))])
    assert np.abs(got) == pytest.approx(np.abs(c @ vt[:2].T), abs=1e-8)
    assert [r.meta_variance_explained for r in variance.orderBy("meta_component_idx").collect()] == pytest.approx((s**2 / (s**2).sum())[:2])
    assert loadings.count() == 8
    with pytest.raises(ValueError):
        pca(df.withColumn("a", F.when(F.col("a") > 0, F.col("a"))), 2)


def test_packed_cells_split_and_train_like_plain_rows(spark, monkeypatch):
    from variantloom.operators import packed
    from variantloom.operators.sampling import stratified_split

    df = cells(spark, 200).withColumn("Cells_A", F.when(F.col("id") % 7 != 0, F.col("Cells_A")))
    rows = [r.asDict() for r in stratified_split(df.withColumn("_d", packed.draw_number(42, "id")), "meta_batch", models.SHARES, "id", 42).collect()]
    whole = df.select(F.lit("k"), "meta_batch", packed.draw_number(42, "id"), "Cells_A", "Cells_B").toArrow().combine_chunks().to_batches(max_chunksize=70)
    got = packed.Cells(packed.pack(2)(whole), 2)
    rows.sort(key=lambda r: r["_d"])
    assert [got.names[c] for c in got.code] == [r["meta_batch"] for r in rows]
    assert [list(models.SHARES)[i] for i in packed.split_of(got.code, models.SHARES)] == [r["split"] for r in rows]
    assert np.array_equal(got.column(0), np.array([r["Cells_A"] for r in rows], float), equal_nan=True)
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 9, (3000, 3)).astype(float), rng.integers(0, 3, 3000)
    x[::11, 1] = np.nan
    for classes in (2, 3):
        plain = boosting.Booster(["a", "b", "c"], classes, boosting.Params(rounds=8)).fit(x, y % classes, x[:500], y[:500] % classes)
        monkeypatch.setattr(boosting, "CHUNK", 256)
        monkeypatch.setattr(packed, "HELD", 64)
        assert boosting.alike(boosting._binned(x, [np.unique(x[np.isfinite(x[:, j]), j]) for j in range(3)], 64), 64) is not None
        sets = boosting.Booster(["a", "b", "c"], classes, boosting.Params(rounds=8)).fit(x, y % classes, x[:500], y[:500] % classes)
        monkeypatch.undo()
        assert len(plain.trees) == len(sets.trees) and np.abs(plain.predict(x) - sets.predict(x)).max() < 1e-9


def test_block_list_without_a_row_for_each_pair(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(v, b, float(x)) for v, names in (("A1A", [f"a{i}" for i in range(9)] + ["both", None]), ("M2K", ["m1", "m2", "both"]), ("L3L", ["c1", "c2"]), ("K4K", ["one", None]), (None, ["n1", "n2"])) for b in names for x in (rng.normal(rng.normal(), 1, rng.integers(8, 30)) if v != "L3L" else np.ones(12))]
    scores = spark.createDataFrame(rows, f"{LABEL} string, meta_barcode string, score double")
    want = {r.barcode: r for r in comparisons.barcode_block_list(comparisons.tukey(scores)).collect()}
    monkeypatch.setattr(comparisons, "tukey_q", None)  # pairs aren't rows
    got = {r.barcode: r for r in comparisons.score_block_list(scores).collect()}
    assert got.keys() == want.keys() and got["c1"].p_adj is None and not got["c1"].barcode_ok
    assert all(got[b].barcode_ok == r.barcode_ok and (r.p_adj is None or got[b].p_adj == pytest.approx(r.p_adj, abs=1e-12)) for b, r in want.items())


def test_selection_makes_its_table_once(spark):
    made = spark.sparkContext.accumulator(0)

    def seen(x):
        made.add(1)
        return x

    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(f"v{i}", *map(float, x)) for i, x in enumerate(rng.normal(size=(30, 2)))], f"{LABEL} string, a double, b double")
    assert selection.select_features(df.withColumn("a", F.udf(seen, "double")("a"))).count() == 30 and made.value == 30
