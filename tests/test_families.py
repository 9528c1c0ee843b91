"""Families whose models share cells: the same models as from one row for each cell and key, without those rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from variantloom.operators import boosting, families, models, packed, pools

from .test_operators import cells

P = boosting.Params(rounds=6)


def odd(spark):
    """Barcodes of uneven sizes, missing values and none."""
    df = cells(spark, 200).withColumn("Cells_A", F.when(F.col("id") % 7 != 0, F.col("Cells_A")).otherwise(float("nan")))
    return df.withColumn("meta_barcode", F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 5 == 0, F.concat("meta_barcode", F.lit("x"))).otherwise(F.col("meta_barcode")))


def whole(spark, monkeypatch, run):
    """Rows as trained from one row for each cell and key, and as trained without them."""
    sides = []
    with monkeypatch.context() as m:
        m.setattr(models, "train_groups", lambda rows, *a, f=models.train_groups: sides.append(rows) or f(rows.rows, *a))
        want = {r.key: r for r in run().collect()}
    with monkeypatch.context() as m:
        m.setattr(models, "stratified_split", None)  # cells aren't repeated for each key
        got = run().collect()
    assert len(got) == len(want) and sides[0].groupBy("key").count().count() == len(want)
    return {r.key: r for r in got}, want


@pytest.mark.parametrize("members", [16, 3])
def test_pairs_without_a_row_for_each_cell_and_pair(spark, monkeypatch, members):
    monkeypatch.setattr(families, "MEMBERS", members)  # one block, or several
    df = odd(spark)
    got, want = whole(spark, monkeypatch, lambda: models.wild_type_pairs(df, "id", min_cells=5, params=P))
    assert got == want and len(got) == 28 and all(r.error is None for r in got.values())
    got, want = whole(spark, monkeypatch, lambda: models.wild_type_pairs(df, "id", min_cells=5, max_barcodes=3, params=P))
    assert got == want and len(got) == 3


def test_pool_without_a_row_for_each_cell_and_barcode(spark, monkeypatch):
    df = odd(spark).withColumn("meta_aa_changes", F.when(F.col("meta_aa_changes") == "M2K", "A2A").otherwise(F.col("meta_aa_changes")))
    got, want = whole(spark, monkeypatch, lambda: models.wild_type_vs_pool(df, "id", min_cells=5, params=P))
    assert got == want and len(got) == 8 and all(r.error is None and r.n_train > 300 for r in got.values())


def test_models_grown_together_are_those_grown_alone():
    rng, groups = np.random.default_rng(6), []
    for i in range(40):
        n = int(rng.integers(2, 30) if i % 4 == 0 else rng.integers(100, 900))
        x, y = rng.normal(size=(n, 3)), rng.integers(0, 2, n)
        y[:2] = 0, 1
        x[:, 0] += y * (i % 3)
        x[:, 1] = np.round(x[:, 1])
        x[rng.random((n, 3)) < (i % 5 == 0) * 0.1] = np.nan
        t, v = max(2, n * 4 // 5), n // 10
        edges = [boosting.edges_of(x[:t, j], 64) for j in range(3)]
        groups.append((edges, boosting._binned(x, edges, 64), y, t, v))
    p = boosting.Params(rounds=25)
    for (model, prob), (edges, b, y, t, v) in zip(boosting.fit_together(["a", "b", "c"], p, *map(list, zip(*groups))), groups):
        alone = boosting.Booster(["a", "b", "c"], 2, p).fit_binned(edges, b[:t], y[:t], b[t : t + v], y[t : t + v])
        assert model.dump() == alone.dump() and np.array_equal(prob, alone.predict_binned(edges, b))


def test_a_model_that_fails_and_a_member_outside_memory(monkeypatch):
    rng = np.random.default_rng(7)
    rows = pa.RecordBatch.from_arrays([pa.array(["a"] * 90), pa.array([""] * 90), pa.array(rng.integers(0, 99, 90)), *(pa.array(rng.normal(size=90)) for _ in range(2))], list("kndxy"))
    sent = [pa.RecordBatch.from_arrays([*b.columns, pa.array([0]), pa.array([0])], [*b.schema.names, "block", "task"]) for b in packed.pack(2)([rows.slice(0, 40), rows.slice(40)])]
    a = families.Member(iter(sent), 2)
    monkeypatch.setattr(families, "HELD", 64)
    b = families.Member(iter(sent), 2)
    assert a._cells is None and b._held is None and all(np.array_equal(x, y) for j in range(2) for x, y in zip(a.column(j), b.column(j)))
    good, bad = families._group(a, b, 2, 64), families._group(a, b, 2, 64)
    want = families._fits(["x", "y"], P, ["k"], [good])
    none = (bad[0], bad[1][:, :0], bad[2], bad[3])
    got = families._fits(["x", "y"], P, ["k", "none"], [good, none])
    assert got[0] == want[0] and got[1]["error"].startswith("ValueError") and got[1]["n_train"] == want[0]["n_train"]


def test_draws_in_step_are_those_of_a_generator():
    sizes, draws = [1, 40, 40, 333], boosting.Draws(7, 0.5)
    at, half, rngs = np.zeros(4, np.intp), np.full(4, -1), [np.random.default_rng(7) for _ in sizes]
    for w, n in [(4, 3), (3, 2), (2, 1), (1, 1), (5, 5), (60, 42), (9, 1)] * 5:
        draws.reach(int((at + sizes).max()))
        for i, (a, rng) in enumerate(zip(at, rngs)):
            assert np.array_equal(draws.hits[a : a + sizes[i]], rng.random(sizes[i]) < 0.5)
        at += sizes
        of = np.array([0, 2, 3]) if w == 9 else np.arange(4)  # only some draw
        cols = np.arange(w) + 100 * of[:, None]
        assert np.array_equal(draws.columns(cols, n, at, half, of), [np.sort(rngs[i].choice(c, n, replace=False)) for i, c in zip(of, cols)])


def test_members_in_order_give_the_same_edges_and_bins(monkeypatch):
    rng = np.random.default_rng(8)

    def member(n, block):
        x = rng.normal(size=(n, 3))
        x[:, 1] = np.round(x[:, 1], 1)
        x[rng.random((n, 3)) < [0, 0.1, 1]] = np.nan  # whole, with gaps, none
        rows = pa.RecordBatch.from_arrays([pa.array([f"m{n}"] * n), pa.array([""] * n), pa.array(rng.integers(0, 1 << 60, n)), *map(pa.array, x.T)], list("kndxyz"))
        sent = [pa.RecordBatch.from_arrays([*b.columns, pa.array([0]), pa.array([0])], [*b.schema.names, "block", "task"]) for b in packed.pack(3)([rows])]
        with monkeypatch.context() as m:
            if block:
                m.setattr(families, "HELD", 0)
            return families.Member(iter(sent), 3)
    for a, b in ((90, 70), (1, 2), (700, 3)):
        state = rng.bit_generator.state
        got = families._group(member(a, False), member(b, False), 3, 64)
        rng.bit_generator.state = state
        want = families._group(member(a, True), member(b, True), 3, 64)
        assert all(np.array_equal(x, y) for x, y in zip(got[0], want[0])) and np.array_equal(got[1], want[1]) and np.array_equal(got[2], want[2]) and got[3] == want[3]


def test_more_models_than_are_grown_at_a_time_and_without_their_text(monkeypatch):
    rng, groups = np.random.default_rng(9), []
    for i in range(50):
        x, y = rng.normal(size=(60 + 9 * (i % 7), 2)), rng.integers(0, 2, 60 + 9 * (i % 7))
        x[:, 0] += y * (i % 3)
        edges = [boosting.edges_of(x[:50, j], 64) for j in range(2)]
        groups.append((edges, boosting._binned(x, edges, 64), y, [50, 6 * (i % 9 > 0), len(y) - 50 - 6 * (i % 9 > 0)]))
    keys, p = [f"k{i}" for i in range(50)], boosting.Params(rounds=12)
    want = [families._fits(["a", "b"], p, [k], [g])[0] for k, g in zip(keys, groups)]
    monkeypatch.setattr(boosting, "CHUNK", 1)  # 16 at a time
    assert families._fits(["a", "b"], p, keys, groups) == want
    assert families._fits(["a", "b"], p, keys, groups, False) == [r | {"model": None, "importance": None} for r in want]


def test_a_large_pool_is_held_as_numbers_of_its_different_rows(spark, monkeypatch):
    """Without a draw of rows or columns the models are those of all cells one by one; parts and results are in any case."""
    p = boosting.Params(rounds=6, subsample=1.0, colsample=1.0)
    df = odd(spark).withColumn("meta_aa_changes", F.when(F.col("meta_aa_changes") == "M2K", "A2A").otherwise(F.col("meta_aa_changes")))
    df = df.withColumn("Cells_A", F.round("Cells_A", 1)).withColumn("Cells_B", F.round("Cells_B", 1))
    run = lambda p: {r.key: r for r in models.wild_type_vs_pool(df, "id", min_cells=5, params=p).collect()}
    want, drawn, fits = run(p), run(P), []
    monkeypatch.setattr(families, "CHUNK", 64)
    monkeypatch.setattr(pools, "counted", lambda *a, f=pools.counted: fits.append(f(*a)) or fits[-1])
    got, other = run(p), run(P)
    assert len(fits) == 2 and 0 < fits[0].count() < want[next(iter(want))].n_train and got.keys() == want.keys() == other.keys()
    for k, r in got.items():
        w = want[k]
        assert r.error is None and (r.n_train, r.n_eval, r.n_test) == (w.n_train, w.n_eval, w.n_test) == (other[k].n_train, other[k].n_eval, other[k].n_test)
        assert [getattr(r, f"{s}_{m}") for s in families.SHARES for m in ("auroc", "accuracy")] == pytest.approx([getattr(w, f"{s}_{m}") for s in families.SHARES for m in ("auroc", "accuracy")])
        assert r.importance == pytest.approx(w.importance) and abs(other[k].train_auroc - drawn[k].train_auroc) < 0.15
    assert run(P) == other


def test_scores_against_counted_ones():
    rng = np.random.default_rng(10)
    for n, digits in ((1, 9), (30, 1), (500, 2), (500, 9), (40, 0)):
        one, none, counts = np.round(rng.normal(size=n), digits), np.round(rng.normal(size=900) - 0.3, digits), rng.integers(0, 5, 900)
        y = np.repeat([1, 0], [n, counts.sum()])
        assert pools.against(one, none, counts) == pytest.approx(boosting.auroc(y, np.concatenate([one, np.repeat(none, counts)])), abs=1e-12)
        assert pools.against(one, none, counts, 8) == pools.against(one, none, counts)
    v, c, more = np.sort(rng.normal(size=40)), rng.integers(0, 9, 40), np.sort(rng.normal(size=7))
    assert np.array_equal(boosting.edges_of_weighted(v, c, more, 16), boosting.edges_of(np.concatenate([np.repeat(v, c), more]), 16))


def test_values_that_are_joined_share_a_bin_for_every_member():
    rng = np.random.default_rng(1)
    for i in range(60):
        v = np.unique(np.round(rng.normal(size=rng.integers(1, 3000)), i % 6))
        n, most = rng.integers(0, 40, len(v)), int(rng.integers(1, 200))
        run = pools.alike(v, n, most, 64)
        for shift in (0, 9, -9):
            edges = boosting.edges_of_weighted(v, n, np.sort(rng.normal(size=rng.integers(0, most + 1)) + shift), 64)
            bins = np.searchsorted(edges, v)
            first = np.flatnonzero(np.diff(run, prepend=-1))
            assert np.array_equal(bins[first][run], bins)
    assert pools.alike(np.arange(100_000.0), np.full(100_000, 14), 480, 64).max() < 5000
