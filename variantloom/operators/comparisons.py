"""Tests: one-way analysis of variance between batches, and Tukey's comparison of a variant's barcodes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from ..functions.naming import BARCODE, BATCH, LABEL, col, feature_columns
from ..functions.special import f_sf, studentized_range_sf_many
from ..functions.variant import classify_variant


@F.pandas_udf(DoubleType())
def _f_sf(f: pd.Series, dfn: pd.Series, dfd: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or x != x else f_sf(x, a, b) for x, a, b in zip(f, dfn, dfd)], dtype="float64")


@F.pandas_udf(DoubleType())
def _range_sf(q: pd.Series, k: pd.Series, df: pd.Series) -> pd.Series:
    """A variant's pairs share k and df, and are computed together."""
    out = pd.Series(np.nan, index=q.index, dtype="float64")
    for (groups, freedom), at in q.groupby([k, df]).groups.items():
        out[at] = studentized_range_sf_many(q[at].to_numpy(float), groups, freedom)
    return out


def control_variants(df: DataFrame, label: str = LABEL, skip_pseudo: bool = False) -> DataFrame:
    """Synonymous rows. Tags that end in `:downsampled` are left out; pseudo-variants (`:downsample-...`) count unless told otherwise."""
    rows = df.where((classify_variant(F.col(label)) == "Synonymous") & ~F.endswith(label, F.lit(":downsampled")))
    return rows.where(~F.contains(label, F.lit(":downsample-"))) if skip_pseudo else rows


def anova_f(df: DataFrame, group: str = BATCH, features: list[str] | None = None) -> DataFrame:
    """feature: f_value, df_between, df_within. One pass for all features; a feature with under two rows or groups is left out; NaN and infinite values carry into F."""
    features = features or feature_columns(df, group, LABEL)
    pairs = F.array(*(F.struct(F.lit(f).alias("feature"), col(f).cast("double").alias("v")) for f in features))
    sums = df.select(group, F.explode(pairs).alias("p")).where("p.v IS NOT NULL").groupBy("p.feature", group).agg(F.count("*").alias("n"), F.sum("p.v").alias("s"), F.sum(F.col("p.v") * F.col("p.v")).alias("q"))
    total = sums.groupBy("feature").agg(F.sum("n").alias("n"), F.count("*").alias("a"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum(F.col("q") - F.col("s") * F.col("s") / F.col("n")).alias("within")).where("n >= 2 AND a >= 2")
    between = F.col("q") - F.col("s") * F.col("s") / F.col("n") - F.col("within")
    f = F.try_divide(F.try_divide(between, F.col("a") - 1), F.try_divide(F.col("within"), F.col("n") - F.col("a")))
    return total.select("feature", f.alias("f_value"), (F.col("a") - 1).alias("df_between"), (F.col("n") - F.col("a")).alias("df_within"))


def anova(df: DataFrame, group: str = BATCH, features: list[str] | None = None) -> DataFrame:
    """feature, f_value, p_value."""
    return anova_f(df, group, features).select("feature", "f_value", _f_sf("f_value", F.col("df_between").cast("double"), F.col("df_within").cast("double")).alias("p_value"))


def _each_barcode(scores: DataFrame, variant: str, barcode: str, score: str, min_cells: int) -> DataFrame:
    return scores.where(F.col(score).isNotNull()).groupBy(F.col(variant).alias("variant"), F.col(barcode).alias("barcode")).agg(F.count("*").alias("n"), F.avg(score).alias("mean"), F.sum(score).alias("s"), F.sum(F.col(score) * F.col(score)).alias("q2")).where(F.col("n") >= min_cells)


def tukey_q(scores: DataFrame, variant: str = LABEL, barcode: str = BARCODE, score: str = "score", min_cells: int = 10) -> DataFrame:
    """One row for each pair of a variant's barcodes: means, their difference, q, and what its p-value needs. The self join is on the variant: a variant has at most a few dozen barcodes."""
    each = _each_barcode(scores, variant, barcode, score, min_cells)
    pool = each.groupBy("variant").agg(F.sum(F.col("q2") - F.col("s") * F.col("s") / F.col("n")).alias("within"), F.sum("n").alias("total"), F.count("*").alias("k")).where("k >= 2")
    pool = pool.withColumn("df", F.col("total") - F.col("k")).where("df >= 1").withColumn("mse", F.col("within") / F.col("df")).select("variant", "mse", "df", "k")
    a = each.select("variant", "barcode", F.col("mean").alias("group_mean"), F.col("n").alias("n_a"))
    b = each.select("variant", F.col("barcode").alias("comparison_barcode"), F.col("mean").alias("comparison_group_mean"), F.col("n").alias("n_b"))
    pairs = a.join(b, "variant").where("barcode < comparison_barcode").join(pool, "variant")
    se = F.sqrt(F.greatest(F.col("mse"), F.lit(0.0)) / 2 * (1 / F.col("n_a") + 1 / F.col("n_b")))
    return pairs.withColumn("mean_diff", F.col("comparison_group_mean") - F.col("group_mean")).withColumn("q", F.try_divide(F.abs("mean_diff"), se))


def tukey(scores: DataFrame, alpha: float = 0.05, **how) -> DataFrame:
    rows = tukey_q(scores, **how).withColumn("p_adj", _range_sf("q", F.col("k").cast("double"), F.col("df").cast("double"))).withColumn("p_adj", F.when(~F.isnan("p_adj"), F.col("p_adj")))
    return rows.select("variant", "barcode", "group_mean", "comparison_barcode", "comparison_group_mean", "mean_diff", "p_adj", (F.col("p_adj") < alpha).alias("reject"))


def _median_p(sides: DataFrame, least: float) -> DataFrame:
    return sides.groupBy("barcode").agg(F.median("p_adj").alias("p_adj")).withColumn("barcode_ok", F.coalesce(F.col("p_adj") >= least, F.lit(False)))


def barcode_block_list(tukey_rows: DataFrame, least: float = 0.05) -> DataFrame:
    """barcode: median p-value over all its comparisons, on either side, and whether that is enough."""
    sides = tukey_rows.select("barcode", "p_adj").unionByName(tukey_rows.select(F.col("comparison_barcode").alias("barcode"), "p_adj"))
    return _median_p(sides, least)


#: Barcodes whose comparisons a task makes for one row, and comparisons that it holds at once.
BLOCK, HELD = 1024, 1 << 20


def _middle_p(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Barcodes of a block against all of their variant to the p-values that their median needs."""
    for b in batches:
        for row in range(b.num_rows):
            block, within, df, k = (b.column(c)[row].as_py() for c in range(4))
            names, mean, n, several = (b.column(c)[row].values for c in range(4, 8))
            mean, n, several = mean.to_numpy(), n.to_numpy().astype(float), several.to_numpy(zero_copy_only=False)
            mse, out, size = within / df, [], len(mean)
            mine = np.arange(block * BLOCK, min(size, (block + 1) * BLOCK))
            for at in np.array_split(mine, max(1, len(mine) * size // HELD)):
                if not mse > 0:  # no p-value at all
                    out += [[]] * len(at)
                    continue
                q = np.abs(mean - mean[at, None]) / np.sqrt(mse / 2 * (1 / n[at, None] + 1 / n))
                q[np.arange(len(at)), at] = -1.0  # itself: before all others
                low, high = 1 + (size - 2) // 2, 1 + (size - 1) // 2
                p = studentized_range_sf_many(np.partition(q, (low, high), 1)[:, [low, high]].ravel(), k, df).reshape(-1, 2).tolist()
                for i in np.flatnonzero(several[at]):  # the median is over other variants' p-values too
                    p[i] = studentized_range_sf_many(np.delete(q[i], at[i]), k, df).tolist()
                out += p
            yield pa.RecordBatch.from_arrays([names.take(pa.array(mine)), pa.array(out, pa.list_(pa.float64()))], ["barcode", "p"])


def score_block_list(scores: DataFrame, least: float = 0.05, variant: str = LABEL, barcode: str = BARCODE, score: str = "score", min_cells: int = 10) -> DataFrame:
    """barcode_block_list(tukey(scores)) without a row or a p-value for each pair.

    Within a variant p falls as q grows, so a barcode's median p is that of its middle q; q is computed for all pairs in blocks of
    BLOCK barcodes against their variant's means and sizes. Barcodes of several variants get all their p-values."""
    each = _each_barcode(scores, variant, barcode, score, min_cells).where("variant IS NOT NULL")
    sums = each.withColumn("several", F.count("*").over(W.partitionBy("barcode")) > 1).groupBy("variant").agg(
        F.sum(F.col("q2") - F.col("s") * F.col("s") / F.col("n")).alias("within"), (F.sum("n") - F.count("*")).alias("df"), F.count("*").alias("k"),
        F.array_sort(F.collect_list(F.when(F.col("barcode").isNotNull(), F.struct("barcode", "mean", "n", "several")))).alias("all"))
    blocks = sums.where((F.col("k") >= 2) & (F.col("df") >= 1) & (F.size("all") >= 2)).withColumn("block", F.explode(F.sequence(F.lit(0), F.expr(f"(size(all) - 1) div {BLOCK}").cast("int"))))
    rows = blocks.repartition("variant", "block").select("block", "within", F.col("df").cast("double"), F.col("k").cast("double"), "all.barcode", "all.mean", "all.n", "all.several")
    schema = StructType([StructField("barcode", scores.schema[barcode].dataType), StructField("p", ArrayType(DoubleType()))])
    return _median_p(rows.mapInArrow(_middle_p, schema).select("barcode", F.explode_outer("p").alias("p_adj")), least)
