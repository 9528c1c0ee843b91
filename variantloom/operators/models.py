"""Families of classifiers, one small model for each group: a task trains a group, and a failure is a row with its reason.

The wild type is the positive class. Its cells, sampled to a bounded number, join every variant's group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.naming import BARCODE, BATCH, LABEL, col, measured_columns
from ..functions.special import mann_whitney_greater
from ..functions.variant import classify_variant
from .boosting import Booster, Params, auroc, bins_of, edges_of
from .families import RESULTS, SHARES, Sides
from .packed import PACKED, Cells, by_key, draw_number, pack, split_of
from .sampling import cap_groups, downsample, draw, drop_small_groups, exclude_barcodes, stratified_split, top_groups


def model_features(df: DataFrame, blocked: DataFrame | set | None = None) -> list[str]:
    """Measured columns that no feature block-list names: a table (feature, feature_ok) or names."""
    bad = blocked if isinstance(blocked, set) else set() if blocked is None else {r[0] for r in blocked.where("NOT feature_ok").select("feature").collect()}
    return [f for f in measured_columns(df) if f not in bad]


def _matrix(pdf: pd.DataFrame, features: list[str]) -> np.ndarray:
    x = pdf[features].to_numpy(float, na_value=np.nan)
    x[~np.isfinite(x)] = np.nan
    return x


def _binary(features: list[str], params: Params):
    """A group with columns key, positive, split and features to one row of results."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        row = {"key": pdf["key"].iloc[0], "error": None, "model": None, "importance": None}
        part = {s: pdf[pdf["split"] == s].sort_values("_draw") for s in SHARES}
        try:
            x = {s: _matrix(p, features) for s, p in part.items()}
            y = {s: p["positive"].to_numpy(int) for s, p in part.items()}
            if len(set(y["train"])) < 2:
                raise ValueError("one class only")
            model = Booster(features, 2, params).fit(x["train"], y["train"], x["eval"], y["eval"])
            for s in SHARES:
                prob = model.predict(x[s]) if len(x[s]) else np.zeros(0)
                row |= {f"n_{s}": len(prob), f"{s}_auroc": auroc(y[s], prob), f"{s}_accuracy": float(((prob >= 0.5) == y[s]).mean()) if len(prob) else np.nan}
            row |= {"model": model.dump(), "importance": model.importance()}
        except (ValueError, ArithmeticError, np.linalg.LinAlgError) as e:  # data that can't be trained on must not stop the other groups; its row says why
            row |= {f"n_{s}": len(p) for s, p in part.items()} | {"error": f"{type(e).__name__}: {e}"}
        return pd.DataFrame([row]).reindex(columns=[c.split(" ")[0] for c in RESULTS.replace("map<string,double>", "map").split(", ")])
    return run


def train_groups(rows: DataFrame | Sides, features: list[str], ids, params: Params = Params(), seed: int = 42) -> DataFrame:
    """rows: key, positive, features, ids; or sides, of which the same models are trained without a row for each cell and key. Splits are made within each group and class."""
    if isinstance(rows, Sides):
        return rows.train(features, ids, params, seed)
    rows = rows.withColumn("_stratum", F.concat_ws("|", "key", F.col("positive").cast("string")))
    rows = stratified_split(rows, "_stratum", SHARES, ids, seed).withColumn("_draw", draw(seed, *([ids] if isinstance(ids, str) else ids)))
    slim = rows.select("key", "positive", "split", "_draw", *(col(f).cast("double").alias(f) for f in features))
    return slim.groupBy("key").applyInPandas(_binary(features, params), RESULTS)


def prepare_variants(df: DataFrame, ids, label: str = LABEL, wild_type: str = "WT", min_cells: int = 100, downsample_wt: int | None = 5000, cap_wt: int | None = None, cap_variant: int | None = None, blocked: DataFrame | None = None, seed: int = 42) -> DataFrame:
    """Blocked barcodes out, caps on cells of a barcode, variants with enough cells (the wild type always), and a bounded number of wild-type cells."""
    if blocked is not None:
        df = exclude_barcodes(df, blocked)
    if BARCODE in df.columns and (cap_wt or cap_variant):
        wt = F.col(label) == wild_type
        df = cap_groups(df.where(wt), BARCODE, cap_wt, ids, seed).unionByName(cap_groups(df.where(~wt), BARCODE, cap_variant, ids, seed))
    df = drop_small_groups(df.where(F.col(label).isNotNull()), label, min_cells, wild_type)
    return downsample(df, F.col(label) == wild_type, downsample_wt, ids, seed)


def variant_splits(df: DataFrame, ids, label: str = LABEL, wild_type: str = "WT", seed: int = 42, **prepare) -> DataFrame:
    """The cells that one_vs_wild_type uses with these arguments, and each one's part in `split`: a cell's part is the same under every model that sees it."""
    return stratified_split(prepare_variants(df, ids, label, wild_type, seed=seed, **prepare), label, SHARES, ids, seed)


def one_vs_wild_type(df: DataFrame, ids, label: str = LABEL, wild_type: str = "WT", params: Params = Params(), blocked_features: DataFrame | set | None = None, seed: int = 42, **prepare) -> DataFrame:
    """key = variant: a model that tells the wild type from it. The wild-type cells (bounded by downsample_wt) are repeated for each variant."""
    features = model_features(df, blocked_features)
    rows = prepare_variants(df, ids, label, wild_type, seed=seed, **prepare)
    variants = rows.where(F.col(label) != wild_type).groupBy(F.col(label).alias("key")).count().select("key")
    wt = rows.where(F.col(label) == wild_type).withColumn("_one", F.lit(1))
    bounded = isinstance(prepare.get("downsample_wt", 5000), int)  # a share of a large table is none
    every = variants.withColumn("_one", F.lit(1)).join(F.broadcast(wt) if bounded else wt, "_one").drop("_one")  # at most downsample_wt rows
    both = rows.where(F.col(label) != wild_type).withColumn("key", F.col(label)).withColumn("positive", F.lit(0)).unionByName(every.withColumn("positive", F.lit(1)))
    return train_groups(both, features, ids, params, seed)


def wild_type_pairs(df: DataFrame, ids, label: str = LABEL, wild_type: str = "WT", min_cells: int = 100, max_barcodes: int | None = None, mode: str = "top", params: Params = Params(), blocked_features: DataFrame | set | None = None, seed: int = 42, tell: bool = True) -> DataFrame:
    """key = `a|b`: a model for each pair of wild-type barcodes (a is positive), with n_cells_a and n_cells_b. Fewer than two barcodes: no rows. tell: else model and importance are null, which takes less time."""
    features = model_features(df, blocked_features)
    rows = drop_small_groups(df.where(F.col(label) == wild_type), BARCODE, min_cells)
    counts = rows.groupBy(BARCODE).agg(F.count("*").alias("n"))
    if max_barcodes is not None:
        counts = counts.join(top_groups(counts, BARCODE, max_barcodes, mode, seed), BARCODE, "left_semi")
        rows = rows.join(counts, BARCODE, "left_semi")
    a, b = counts.select(F.col(BARCODE).alias("a"), F.col("n").alias("n_cells_a"), F.lit(1).alias("_k")), counts.select(F.col(BARCODE).alias("b"), F.col("n").alias("n_cells_b"), F.lit(1).alias("_k"))
    pairs = a.join(F.broadcast(b), "_k").where("string(a) < string(b)").drop("_k").withColumn("key", F.concat_ws("|", "a", "b"))  # a row for each barcode; unless sent whole, a plain product counts them anew for each of its partitions
    sides = pairs.select("key", F.col("a").alias(BARCODE), F.lit(1).alias("positive")).unionByName(pairs.select("key", F.col("b").alias(BARCODE), F.lit(0).alias("positive")))
    return train_groups(Sides(rows.join(sides, BARCODE), rows, BARCODE, tell=tell), features, ids, params, seed).join(pairs, "key")


POOL = "__POOL__"


def wild_type_vs_pool(df: DataFrame, ids, label: str = LABEL, wild_type: str = "WT", classes: tuple = ("Synonymous",), min_cells: int = 100, downsample_pool: int | None = None, params: Params = Params(), blocked_features: DataFrame | set | None = None, seed: int = 42, tell: bool = True) -> DataFrame:
    """key = wild-type barcode: a model that tells it from the pooled cells of variants of these classes. tell: as in wild_type_pairs."""
    features = model_features(df, blocked_features)
    pool = downsample(df.where((F.col(label) != wild_type) & classify_variant(F.col(label)).isin(list(classes))), F.lit(True), downsample_pool, ids, seed)
    if pool.isEmpty():
        raise ValueError(f"No cells of classes {', '.join(classes)}")
    if not df.where(F.col(BARCODE) == POOL).isEmpty():
        raise ValueError(f"{POOL} must not be a barcode")
    rows = drop_small_groups(df.where(F.col(label) == wild_type), BARCODE, min_cells)
    keys = rows.select(F.col(BARCODE).alias("key")).distinct().withColumn("_one", F.lit(1))
    both = rows.withColumn("key", F.col(BARCODE)).withColumn("positive", F.lit(1)).unionByName(pool.withColumn("_one", F.lit(1)).join(keys, "_one").drop("_one").withColumn("positive", F.lit(0)))
    members = rows.withColumn(BARCODE, F.col(BARCODE).cast("string")).unionByName(pool.withColumn(BARCODE, F.lit(POOL)))
    return train_groups(Sides(both, members, BARCODE, POOL, tell), features, ids, params, seed)


BATCH_RESULTS = "key string, batch string, n_cells long, n_test long, auroc double, p_value double, model string, importance map<string,double>, error string"


def batch_vs_batch(df: DataFrame, ids, label: str = LABEL, batch: str = BATCH, min_cells: int = 50, min_batches: int = 2, params: Params = Params(), blocked_features: DataFrame | set | None = None, seed: int = 42) -> DataFrame:
    """(variant, batch): how well a softmax model of the variant's cells tells the batch from the others on held-out cells, and a one-sided rank test of its scores; n_cells counts the variant's cells in the batch. A variant's model and importance stand in its first row."""
    features = model_features(df, blocked_features)
    rows = df.where(F.col(label).isNotNull() & F.col(batch).isNotNull())
    slim = rows.select(F.col(label).cast("string").alias("key"), F.col(batch).cast("string"), draw_number(seed, ids), *(col(f).cast("double").alias(f"x{j}") for j, f in enumerate(features)))
    width, names = len(features), [c.split(" ")[0] for c in BATCH_RESULTS.replace("map<string,double>", "map").split(", ")]
    schema = to_arrow_schema(StructType.fromDDL(BATCH_RESULTS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = Cells(batches, width)
        if len(cells) < min_cells or len(cells.names) < min_batches:  # every batch has cells in `train`
            return
        try:
            parts = split_of(cells.code, SHARES)
            y = {s: cells.code[parts == i] for i, s in enumerate(SHARES)}
            edges, b = [], {s: np.empty((len(v), width), np.uint8 if params.bins < 256 else np.int64, "F") for s, v in y.items()}
            for j in range(width):  # one feature's values at a time
                v = cells.column(j)
                edges.append(edges_of(v[parts == 0], params.bins))
                for i, s in enumerate(SHARES):
                    b[s][:, j] = bins_of(v[parts == i], edges[j], params.bins)
            v = parts = None
            model = Booster(features, max(2, len(cells.names)), params).fit_binned(edges, b["train"], y["train"], b["eval"], y["eval"])
            prob, test = model.predict_binned(edges, b["test"]), y["test"]
            prob = np.stack([1 - prob, prob], 1) if prob.ndim == 1 else prob
            size = np.bincount(cells.code)
            out = [{"key": cells.key, "batch": n, "n_cells": int(size[i]), "model": model.dump() if i == 0 else None, "importance": model.importance() if i == 0 else None, "n_test": int((test == i).sum()), "auroc": auroc((test == i).astype(int), prob[:, i]), "p_value": mann_whitney_greater(prob[test == i, i], prob[test != i, i]), "error": None} for i, n in enumerate(cells.names)]
        except (ValueError, ArithmeticError, np.linalg.LinAlgError) as e:  # as for the other families: the row says why
            out = [{"key": cells.key, "batch": None, "n_cells": len(cells), "model": None, "importance": None, "n_test": 0, "auroc": float("nan"), "p_value": float("nan"), "error": f"{type(e).__name__}: {e}"}]
        yield pa.RecordBatch.from_pylist([{n: list(r[n].items()) if isinstance(r[n], dict) else r[n] for n in names} for r in out], schema)

    return by_key(slim.mapInArrow(pack(width), PACKED), run, BATCH_RESULTS)


#: Bytes of models that are given to every task at once.
MODEL_BYTES = 128 << 20


def _parts(sizes: list[tuple[str, int]], most: int) -> list[list[str]]:
    """Keys in order, in parts of at most so many bytes or one key."""
    out, held = [], 0
    for key, n in sizes:
        if not out or held + n > most:
            out.append([])
            held = 0
        out[-1].append(key)
        held += n
    return out


def score_cells(df: DataFrame, models: DataFrame, label: str = LABEL, most_bytes: int = MODEL_BYTES) -> DataFrame:
    """Every cell under every model (its probability of the wild type), one column for each variant, beside the `meta_` columns. A model reads its own features. Models are sized first, and given to the tasks in parts of at most `most_bytes`."""
    known = models.where("model IS NOT NULL")
    sizes = sorted((r[0], r[1]) for r in known.select("key", F.length("model")).collect())  # one number for each variant
    meta = [c for c in df.columns if c.startswith("meta_")]
    features, names = [c for c in measured_columns(df) if c not in meta], [k for k, _ in sizes]
    place = {n: f"s{i}" for i, n in enumerate(names)}
    rows = df.select(*map(col, meta), *(col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)))
    at = {f: f"x{i}" for i, f in enumerate(features)}
    for part in _parts(sizes, most_bytes):
        held = {r["key"]: Booster.load(r["model"]) for r in known.where(F.col("key").isin(part)).select("key", "model").collect()}
        missing = {f for m in held.values() for f in m.features} - set(features)
        if missing:
            raise ValueError(f"The cells lack features of the models: {', '.join(sorted(missing))}")
        rows = _scored(rows, df.sparkSession.sparkContext.broadcast(held), part, place, at)
    return rows.select(*map(col, meta), *(F.col(place[n]).alias(n) for n in names))


def _scored(rows: DataFrame, shared, part: list[str], place: dict[str, str], at: dict[str, str]) -> DataFrame:
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), *(f"{place[n]} double" for n in part)])

    def run(frames):
        for pdf in frames:
            more = {place[n]: shared.value[n].predict(_matrix(pdf, [at[f] for f in shared.value[n].features])) for n in part}
            yield pd.concat([pdf, pd.DataFrame(more, index=pdf.index)], axis=1)

    return rows.mapInPandas(run, schema)


def own_score(scores: DataFrame, label: str = LABEL) -> DataFrame:
    """meta columns and `score`, each cell's score under its own variant's model; null without one."""
    names = [c for c in scores.columns if not c.startswith("meta_")]
    own = F.coalesce(*(F.when(F.col(label) == n, col(n)) for n in names)) if names else F.lit(None).cast("double")
    return scores.select(*(c for c in scores.columns if c.startswith("meta_")), own.alias("score"))


def importance_table(models: DataFrame) -> DataFrame:
    return models.where("importance IS NOT NULL").select("key", F.explode("importance").alias("feature", "gain"))
