"""Profiles of variants: ten statistics of each feature over a variant's cells, some against all control cells.

Rank statistics (KS and AUROC, with signs and p-values) share one plan, chosen, as that of QQ, by the counted number of
cells. Up to FEATURE_CELLS of them, cells leave their task as one packed row for each feature, and a task orders a whole
feature in numpy. Beyond, QQ takes percentiles by group, and for ranks values are first counted by feature, label and value. Each feature's range is cut into buckets at approximate
quantiles; running counts are windows inside a bucket plus the totals of the buckets before it, so no window has to hold a
whole feature. Equal values always fall in one bucket."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.naming import CONTROL, LABEL, col, feature_columns, finite, to_long
from ..functions.special import neg_log10_kolmogorov, neg_log10_two_sided_normal
from .normalize import CHUNK

BUCKETS = 64
#: A task may hold one feature of so many cells: 12 bytes for each, and some times that while they are ranked.
FEATURE_CELLS = 2_000_000
QUANTILES = 100


def _wide(df: DataFrame, label: str, features: list[str], stat: str, how: Callable[[Column], Column]) -> DataFrame:
    cells = df.where(~F.col(CONTROL))
    out = None
    for i in range(0, len(features), CHUNK):
        part = cells.groupBy(label).agg(*(how(finite(col(f))).alias(f"{f}_{stat}") for f in features[i : i + CHUNK]))
        out = part if out is None else out.join(part.withColumnRenamed(label, "_l"), F.col(label).eqNullSafe(F.col("_l"))).drop("_l")
    return cells.select(label).distinct() if out is None else out


def mean(df, label, features):
    return _wide(df, label, features, "mean", F.avg)


def median(df, label, features):
    return _wide(df, label, features, "median", F.median)


def std(df, label, features):
    return _wide(df, label, features, "std", F.stddev_samp)


def mad(df, label, features):
    """The median distance from the median, unscaled."""
    cells = df.where(~F.col(CONTROL)).select(label, *(finite(col(f)).alias(f"x{i}") for i, f in enumerate(features)))
    mid = cells.groupBy(label).agg(*(F.median(f"x{i}").alias(f"m{i}") for i in range(len(features)))).withColumnRenamed(label, "_l")
    near = cells.join(mid, F.col(label).eqNullSafe(F.col("_l")))
    return near.groupBy(label).agg(*(F.median(F.abs(F.col(f"x{i}") - F.col(f"m{i}"))).alias(f"{f}_MAD") for i, f in enumerate(features)))


def _spread(values: DataFrame, df: DataFrame, label: str, features: list[str], stat: str) -> DataFrame:
    """(label, feature, value) to one row for each label of a cell that isn't a control, null where there is no value."""
    labels = df.where(~F.col(CONTROL)).select(F.col(label).alias("_l")).distinct()
    wide = values.groupBy(label).pivot("feature", features).agg(F.first("value"))
    got = labels.join(wide, F.col("_l").eqNullSafe(F.col(label)), "left")
    return got.select(F.col("_l").alias(label), *(col(f).alias(f"{f}_{stat}") for f in features))


def rank_counts(df: DataFrame, label: str, features: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(label, feature, v) of cells that aren't controls: c_eq, c_le of the label's n_g values and r_eq, r_le of the n_r control values that are equal or at most v; tie, the controls' sum of t^3 - t."""
    long = to_long(df, [F.col(label).alias("label"), F.col(CONTROL).alias("control")], features)
    counted = long.groupBy("label", "control", "feature", "v").agg(F.count("*").alias("n"))
    cuts = counted.groupBy("feature").agg(F.percentile_approx("v", [k / buckets for k in range(1, buckets)], 1000).alias("cuts"))  # one short row for each feature
    counted = counted.join(cuts, "feature").withColumn("bucket", F.size(F.filter("cuts", lambda c: c < F.col("v")))).drop("cuts")
    ref = F.when(F.col("control"), F.col("n")).otherwise(0)
    counted = counted.withColumns({
        "r_in": F.sum(ref).over(W.partitionBy("feature", "bucket").orderBy("v").rangeBetween(W.unboundedPreceding, 0)),
        "r_eq": F.sum(ref).over(W.partitionBy("feature", "bucket", "v")),
    })
    before = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    r_tot = counted.groupBy("feature", "bucket").agg(F.sum(ref).alias("r"), F.sum(F.when(F.col("control"), F.col("n").cast("double") * F.col("n") * F.col("n") - F.col("n")).otherwise(0.0)).alias("t"))
    r_tot = r_tot.select("feature", "bucket", F.coalesce(F.sum("r").over(before.partitionBy("feature")), F.lit(0)).alias("r_before"), F.sum("r").over(W.partitionBy("feature")).alias("n_r"), F.sum("t").over(W.partitionBy("feature")).alias("tie"))
    own = counted.where(~F.col("control")).withColumn("c_in", F.sum("n").over(W.partitionBy("feature", "label", "bucket").orderBy("v").rowsBetween(W.unboundedPreceding, 0)))
    g_tot = own.groupBy("feature", "label", "bucket").agg(F.sum("n").alias("g"))
    g_tot = g_tot.select("feature", F.col("label").alias("_l"), "bucket", F.coalesce(F.sum("g").over(before.partitionBy("feature", "label")), F.lit(0)).alias("c_before"), F.sum("g").over(W.partitionBy("feature", "label")).alias("n_g"))
    own = own.join(r_tot, ["feature", "bucket"]).join(g_tot.withColumnsRenamed({"feature": "_f", "bucket": "_b"}), F.col("label").eqNullSafe(F.col("_l")) & (F.col("feature") == F.col("_f")) & (F.col("bucket") == F.col("_b")))
    return own.where("n_r > 0").select(F.col("label").alias(label), "feature", "v", F.col("n").alias("c_eq"), (F.col("c_in") + F.col("c_before")).alias("c_le"), "n_g", "r_eq", (F.col("r_in") + F.col("r_before")).alias("r_le"), "n_r", "tie")


def _packed(width: int):
    """Batches of (label, control, features) to one row for each feature: the finite values, their labels' places in `names` (-1: a control), and the names."""
    def run(batches):
        for b in batches:
            label, control = b.column(0).dictionary_encode(null_encoding="encode"), b.column(1)
            known = control.is_valid().to_numpy(zero_copy_only=False)
            code = np.where(control.fill_null(False).to_numpy(zero_copy_only=False), -1, label.indices.to_numpy()).astype(np.int32)
            values, codes = [], []
            for i in range(width):
                v = b.column(2 + i).to_numpy(zero_copy_only=False).astype(float)  # null: NaN
                ok = np.isfinite(v) & known
                values.append(v[ok].tobytes())
                codes.append(code[ok].tobytes())
            names = pa.concat_arrays([label.dictionary] * width) if width else label.dictionary
            at = pa.array(np.arange(width + 1, dtype=np.int32) * len(label.dictionary))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.ListArray.from_arrays(at, names), pa.array(codes, pa.binary()), pa.array(values, pa.binary())], ["feature", "names", "codes", "vals"])
    return run


def _unpacked(table: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """A feature's packed rows: labels, the controls' values in order, and the other values, by label and then in order, with their labels' places."""
    lists = table["names"].combine_chunks()
    names = lists.flatten().dictionary_encode(null_encoding="encode")
    place, at = names.indices.to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
    codes = []
    for k, packed in enumerate(table["codes"].to_pylist()):
        c = np.frombuffer(packed, np.int32)
        codes.append(np.where(c < 0, -1, place[at[k] + np.maximum(c, 0)]) if at[k + 1] > at[k] else c)
    code, v = np.concatenate(codes).astype(np.int64), np.concatenate([np.frombuffer(x) for x in table["vals"].to_pylist()])
    ref, own, code = np.sort(v[code < 0]), v[code >= 0], code[code >= 0]
    by = np.lexsort((own, code))
    return names.dictionary, ref, own[by], code[by]


def _by_label(features: list[str], statistics: Callable, columns: list[str]):
    """All packed rows of a feature to one row for each label that has a value, if the controls have one; statistics: (controls, values, each value's label as a number, where each label begins) to one array for each column."""
    def run(table: pa.Table) -> pa.Table:
        names, ref, own, code = _unpacked(table)
        first = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(ref) and len(own) else np.zeros(0, np.int64)
        out = statistics(ref, own, np.repeat(np.arange(len(first)), np.diff(first, append=len(own))), first) if len(first) else [np.zeros(0)] * len(columns)
        return pa.Table.from_arrays([names.take(pa.array(code[first])), pa.array([features[table["feature"][0].as_py()]] * len(first), pa.string()), *(pa.array(x, from_pandas=True) for x in out)], ["_l", "feature", *columns])
    return run


def _packed_statistics(df: DataFrame, label: str, features: list[str], statistics: Callable, columns: list[str]) -> DataFrame:
    wide = df.select(F.col(label).alias("_l"), F.col(CONTROL), *(col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)))
    kind = df.schema[label].dataType
    packed = wide.mapInArrow(_packed(len(features)), T.StructType([T.StructField("feature", T.IntegerType()), T.StructField("names", T.ArrayType(kind)), T.StructField("codes", T.BinaryType()), T.StructField("vals", T.BinaryType())]))
    schema = T.StructType([T.StructField("_l", kind), T.StructField("feature", T.StringType()), *(T.StructField(c, T.DoubleType()) for c in columns)])
    return packed.groupBy("feature").applyInArrow(_by_label(features, statistics, columns), schema).withColumnRenamed("_l", label)


def _rank_statistics(ref: np.ndarray, own: np.ndarray, which: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    run_at = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (which[1:] != which[:-1])))  # equal values of a label
    n = np.diff(run_at, append=len(own)).astype(float)
    own, which, first = own[run_at], which[run_at], np.searchsorted(run_at, first)
    n_g, n_r = np.add.reduceat(n, first), float(len(ref))
    c_le = np.cumsum(n)
    c_le -= (c_le - n)[first][which]
    r_lt, r_le = np.searchsorted(ref, own, "left").astype(float), np.searchsorted(ref, own, "right").astype(float)
    r = r_le - r_lt
    t = np.diff(np.flatnonzero(np.append(True, ref[1:] != ref[:-1])), append=len(ref)).astype(float)
    up = np.maximum.reduceat(c_le / n_g[which] - r_le / n_r, first)
    down = np.maximum.reduceat(r_lt / n_r - (c_le - n) / n_g[which], first)
    u = np.add.reduceat(n * (r_lt + 0.5 * r), first)
    tie = (t**3 - t).sum() + np.add.reduceat((n + r) ** 3 - (n + r) - (r**3 - r), first)
    return [np.maximum(up, 0.0), np.maximum(down, 0.0), u, n_g, np.full(len(n_g), n_r), tie]


def _quantile_correlation(points: int):
    """Null (NaN) where either side's quantiles are all equal."""
    def statistics(ref: np.ndarray, own: np.ndarray, which: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
        share = np.arange(points) / (points - 1)

        def quantiles(v: np.ndarray, begin: np.ndarray, n: np.ndarray) -> np.ndarray:
            at = share * (n[:, None] - 1)
            low = np.floor(at).astype(np.int64)
            a, b = v[begin[:, None] + low], v[begin[:, None] + np.minimum(low + 1, n[:, None] - 1)]
            return a + (b - a) * (at - low)

        y = quantiles(ref, np.zeros(1, np.int64), np.array([len(ref)]))[0]
        x = quantiles(own, first, np.diff(first, append=len(own)))
        ok = (x.max(1) > x.min(1)) & (y.max() > y.min())
        x, y = x - x.mean(1, keepdims=True), y - y.mean()
        scale = np.sqrt((x * x).sum(1) * (y @ y))
        ok &= scale > 0
        return [np.where(ok, x @ y / np.where(ok, scale, 1.0), np.nan)]
    return statistics


def ranks(df: DataFrame, label: str, features: list[str], most_cells: int = FEATURE_CELLS) -> DataFrame:
    """(label, feature): up and down, the largest differences of the distribution functions; u, pairs in which the label's value is above a control's (ties count half); sizes n_g and n_r; tie, the joint sum of t^3 - t."""
    if features and df.count() <= most_cells:
        return _packed_statistics(df, label, features, _rank_statistics, ["up", "down", "u", "n_g", "n_r", "tie"])
    x = lambda c: F.col(c).cast("double")
    both = x("c_eq") + x("r_eq")
    return rank_counts(df, label, features).groupBy(label, "feature").agg(
        F.greatest(F.max(F.col("c_le") / F.col("n_g") - F.col("r_le") / F.col("n_r")), F.lit(0.0)).alias("up"),
        F.greatest(F.max((F.col("r_le") - F.col("r_eq")) / F.col("n_r") - (F.col("c_le") - F.col("c_eq")) / F.col("n_g")), F.lit(0.0)).alias("down"),
        F.sum(x("c_eq") * (x("r_le") - x("r_eq") + 0.5 * x("r_eq"))).alias("u"), F.first(x("n_g")).alias("n_g"), F.first(x("n_r")).alias("n_r"),
        (F.first("tie") + F.sum((both * both * both - both) - (x("r_eq") * x("r_eq") * x("r_eq") - x("r_eq")))).alias("tie"))


def ks(df, label, features):
    return _spread(ranks(df, label, features).withColumn("value", F.greatest("up", "down")), df, label, features, "KS")


def signed_ks(df, label, features):
    return _spread(ranks(df, label, features).withColumn("value", F.when(F.col("up") >= F.col("down"), F.col("up")).otherwise(-F.col("down"))), df, label, features, "signedKS")


def ks_neg_log_p(df, label, features):
    n_e = F.col("n_g") * F.col("n_r") / (F.col("n_g") + F.col("n_r"))
    return _spread(ranks(df, label, features).withColumn("value", neg_log10_kolmogorov(F.greatest("up", "down"), n_e)), df, label, features, "KSnegLogP")


def auroc(df, label, features):
    return _spread(ranks(df, label, features).withColumn("value", F.try_divide(F.col("u"), F.col("n_g") * F.col("n_r"))), df, label, features, "AUROC")


def auroc_neg_log_p(df, label, features):
    n = F.col("n_g") + F.col("n_r")
    var = F.col("n_g") * F.col("n_r") / 12.0 * ((n + 1) - F.try_divide(F.col("tie"), n * (n - 1)))
    z = F.try_divide(F.col("u") - F.col("n_g") * F.col("n_r") / 2.0, F.sqrt(F.when(var > 0, var)))
    return _spread(ranks(df, label, features).withColumn("value", F.when(z.isNotNull(), neg_log10_two_sided_normal(z))), df, label, features, "AUROCnegLogP")


def qq(df, label, features, n_quantiles: int = QUANTILES, most_cells: int = FEATURE_CELLS):
    """Correlation of a label's quantiles with those of the controls."""
    if features and df.count() <= most_cells:
        return _spread(_packed_statistics(df, label, features, _quantile_correlation(n_quantiles), ["value"]), df, label, features, "QQ")
    points = F.array(*(F.lit(k / (n_quantiles - 1)) for k in range(n_quantiles)))
    long = to_long(df, [F.col(label).alias(label), F.col(CONTROL).alias("control")], features)
    own = long.where(~F.col("control")).groupBy(label, "feature").agg(F.percentile("v", points).alias("x"))
    ref = long.where("control").groupBy("feature").agg(F.percentile("v", points).alias("y"))
    both = own.join(ref, "feature")
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v)
    both = both.withColumns({"mx": total(F.col("x")) / n_quantiles, "my": total(F.col("y")) / n_quantiles})
    dot = lambda f: F.aggregate(F.zip_with("x", "y", f), F.lit(0.0), lambda s, v: s + v)
    dx, dy = (lambda p: p - F.col("mx")), (lambda q: q - F.col("my"))
    ok = (F.array_max("x") > F.array_min("x")) & (F.array_max("y") > F.array_min("y"))
    r = F.try_divide(dot(lambda p, q: dx(p) * dy(q)), F.sqrt(dot(lambda p, q: dx(p) * dx(p)) * dot(lambda p, q: dy(q) * dy(q))))
    return _spread(both.withColumn("value", F.when(ok, r)), df, label, features, "QQ")


AGGREGATORS: dict[str, Callable] = {"mean": mean, "median": median, "MAD": mad, "std": std, "KS": ks, "signedKS": signed_ks, "KSnegLogP": ks_neg_log_p, "QQ": qq, "AUROC": auroc, "AUROCnegLogP": auroc_neg_log_p}


def register(name: str, statistic: Callable[[DataFrame, str, list[str]], DataFrame]) -> None:
    """Add a statistic: (cells with a control flag, label, features) to one row for each label of a cell that isn't a control, with a column `{feature}_{name}` for each feature."""
    if name in AGGREGATORS:
        raise ValueError(f"There is an aggregator {name!r} already")
    AGGREGATORS[name] = statistic


def aggregate(df: DataFrame, name: str, label: str = LABEL, block_list: set[str] | None = None) -> DataFrame:
    """One row for each label of a cell that isn't a control, a column `{feature}_{name}` for each feature; columns on the block-list aren't computed."""
    if name not in AGGREGATORS:
        raise ValueError(f"Unknown aggregator: {name!r}; one of {', '.join(AGGREGATORS)}")
    features = [f for f in feature_columns(df, label) if f"{f}_{name}" not in (block_list or ())]
    return AGGREGATORS[name](df, label, features)
