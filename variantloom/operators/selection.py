"""Feature selection: reproducibility between halves, block-lists and their algebra, redundancy, cross-batch medians."""

from __future__ import annotations

import logging
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.naming import LABEL, col, feature_columns, finite, no_nan, to_long
from .normalize import one_row

log = logging.getLogger(__name__)


def pearson(x: str, y: str):
    """Correlation as an aggregate; null where either side is constant or empty, which plain corr would raise on."""
    x, y = (F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), F.col(c)) for c in (x, y))
    return F.try_divide(F.covar_pop(x, y), F.when(F.stddev_pop(x) * F.stddev_pop(y) > 0, F.stddev_pop(x) * F.stddev_pop(y)))


def correlate_halves(one: DataFrame, two: DataFrame, label: str = LABEL, keys: tuple = ()) -> DataFrame:
    """feature (and keys): r and r_squared of the values of labels in both tables."""
    features = [f for f in feature_columns(one, label, *keys) if f in two.columns]
    a, b = (to_long(df, [*map(col, keys), F.col(label).alias(label)], features).withColumnRenamed("v", v) for df, v in ((one, "x"), (two, "y")))
    joined = a.join(b, [*keys, label, "feature"])
    out = joined.groupBy(*keys, "feature").agg(pearson("x", "y").alias("r")).withColumn("r_squared", F.col("r") * F.col("r"))
    if keys:
        return out
    every = one.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    return every.join(out, "feature", "left")


def bootstrap_block_list(correlations: DataFrame, least: float = 0.5) -> DataFrame:
    """feature: median r over replicates, and whether that is enough. No r at all, as for a constant feature, is not enough."""
    return correlations.groupBy("feature").agg(F.median("r").alias("median_r")).withColumn("feature_ok", F.coalesce(F.col("median_r") >= least, F.lit(False)))


def anova_block_list(anova: DataFrame, least_p: float = 0.05) -> DataFrame:
    """Features that don't differ between batches are ok."""
    return anova.withColumn("feature_ok", F.coalesce(F.col("p_value") >= least_p, F.lit(False)))


def combine_block_lists(lists: list[DataFrame]) -> DataFrame:
    if not lists:
        raise ValueError("No block-lists given")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), lists)


def agree_block_lists(lists: list[DataFrame], min_batches_ok: int | None = None) -> DataFrame:
    """feature: lists that name it, lists that find it ok, and whether those are enough (None: all)."""
    both = combine_block_lists([x.select("feature", "feature_ok") for x in lists])
    out = both.groupBy("feature").agg(F.count("*").alias("n_batches"), F.count_if("feature_ok").alias("n_ok"))
    return out.withColumn("feature_ok", F.col("n_ok") == F.col("n_batches") if min_batches_ok is None else F.col("n_ok") >= min_batches_ok)


def blocked(block_list: DataFrame) -> set[str]:
    """Names that aren't ok: at most one for each column of a table."""
    return {r[0] for r in block_list.where(~F.col("feature_ok")).select("feature").collect()}


def drop_blocked(df: DataFrame, block_list: DataFrame) -> DataFrame:
    bad = blocked(block_list)
    return df.select(*(col(c) for c in df.columns if c not in bad))


def cross_batch_median(frames: list[DataFrame], label: str = LABEL) -> DataFrame:
    """label: the median over tables of each feature that all have."""
    if not frames:
        raise ValueError("No tables given")
    common = [f for f in feature_columns(frames[0], label) if all(f in x.columns for x in frames)]
    both = reduce(DataFrame.unionByName, [x.select(label, *(no_nan(col(f)).alias(f) for f in common)) for x in frames])
    return both.groupBy(label).agg(*(F.median(col(f)).alias(f) for f in common))


def join_feature_types(frames: list[DataFrame], label: str = LABEL) -> DataFrame:
    return reduce(lambda a, b: a.join(b, label), frames)


def varied_features(df: DataFrame, features: list[str], freq_cut: float = 0.05, unique_cut: float = 0.01) -> list[str]:
    """Features whose second most common value is common enough beside the first, and that have enough distinct values."""
    long = to_long(df, [], features).groupBy("feature", "v").count()
    place = F.row_number().over(W.partitionBy("feature").orderBy(F.desc("count"), "v"))
    top = long.withColumn("k", place).groupBy("feature").agg(F.count("*").alias("unique"), F.sum("count").alias("n"), F.max("count").alias("first"), F.max(F.when(F.col("k") == 2, F.col("count"))).alias("second"))
    rows = top.select("feature", (F.coalesce("second", F.lit(0)) / F.col("first")).alias("ratio"), (F.col("unique") / F.col("n")).alias("share")).collect()
    ok = {r["feature"] for r in rows if r["ratio"] >= freq_cut and r["share"] >= unique_cut}
    return [f for f in features if f in ok]


def _co_moments(features: int, shift: list[float], stripe: int):
    """Of each pair of columns, over the rows where both have a value: count, sums, sums of squares and of products; one row for each stripe of first columns."""
    def run(batches):
        held: dict[int, list] = {}
        for b in batches:
            x = np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(features)], 1) - shift
            m = np.isfinite(x)
            x[~m] = 0.0
            m, y = m.astype(float), x * x
            for k in range(0, features, stripe):
                c = slice(k, k + stripe)
                new = [m[:, c].T @ m, x[:, c].T @ m, m[:, c].T @ x, y[:, c].T @ m, m[:, c].T @ y, x[:, c].T @ x]
                held[k] = [a + v for a, v in zip(held[k], new)] if k in held else new
        for k, sums in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([np.stack(sums).tobytes()], pa.binary())], ["stripe", "sums"])
    return run


def _added(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x) for x in table["sums"].to_pylist())
    return pa.table({"stripe": table["stripe"].slice(0, 1).cast(pa.int32()), "sums": pa.array([total.tobytes()], pa.binary())})


def pairwise_correlations(df: DataFrame, features: list[str], stripe: int = 128) -> np.ndarray:
    """Pearson correlation of each pair of features, over the rows where both are finite; 0 where there is none or one side is constant. One pass over the rows; the matrix has one number for each pair of columns."""
    means = [m or 0.0 for m in one_row(df, [F.avg(finite(col(f))) for f in features])]
    rows = df.select(*(finite(col(f)).alias(f"x{i}") for i, f in enumerate(features)))
    sums = rows.mapInArrow(_co_moments(len(features), means, stripe), "stripe int, sums binary").groupBy("stripe").applyInArrow(_added, "stripe int, sums binary")
    out = np.zeros((len(features), len(features)))
    for k, packed in sums.collect():  # six numbers for each pair of columns
        n, sx, sy, xx, yy, xy = np.frombuffer(packed).reshape(6, -1, len(features))
        with np.errstate(invalid="ignore", divide="ignore"):
            vx, vy = xx - sx * sx / n, yy - sy * sy / n
            noise = 1e-9 * np.abs(means)  # what varies by less is constant but for rounding
            ok = (n > 1) & (vx > np.maximum(1e-12 * xx, n * noise[k : k + len(n), None] ** 2)) & (vy > np.maximum(1e-12 * yy, n * noise**2))
            out[k : k + len(n)] = np.where(ok, (xy - sx * sy / n) / np.sqrt(np.where(ok, vx * vy, 1.0)), 0.0)
    return out


def correlated_features(df: DataFrame, features: list[str], most: float = 0.9) -> set[str]:
    """Of each pair correlated beyond `most`, the feature that is more correlated with all."""
    if len(features) < 2:
        return set()
    r = np.abs(pairwise_correlations(df, features))
    total = r.sum(0)
    return {features[i if total[i] > total[j] else j] for i in range(len(features)) for j in range(i) if r[i, j] > most}


def feature_choice(df: DataFrame, label: str = LABEL) -> DataFrame:
    """feature: whether it varies enough, and whether it is kept by select_features."""
    every = feature_columns(df, label)
    varied = varied_features(df, every)
    gone = correlated_features(df, varied)
    return df.sparkSession.createDataFrame([(f, f in varied, f in varied and f not in gone) for f in every], "feature string, varied boolean, kept boolean")


def select_features(df: DataFrame, label: str = LABEL, static_block_list: tuple = ()) -> DataFrame:
    """Without features that vary too little, are listed, or repeat others. `meta_` columns stay. The table is read four times, and what made it runs once."""
    df = df.persist()
    features = [f for f in varied_features(df, feature_columns(df, label)) if f not in static_block_list]
    keep = set(features) - correlated_features(df, features)
    return df.select(*(col(c) for c in df.columns if c.startswith("meta_") or c == label or c in keep))


def fittable(df: DataFrame, features: list[str]) -> tuple[list[str], list[str]]:
    """Features with a value, and those without one."""
    counts = one_row(df, [F.count(col(f)) for f in features])
    good = [f for f, n in zip(features, counts) if n]
    if not good:
        raise ValueError("No feature has a value")
    empty = [f for f, n in zip(features, counts) if not n]
    if empty:
        log.warning("%d features without a value are left out: %s", len(empty), ", ".join(empty))
    return good, empty
