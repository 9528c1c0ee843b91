"""Z-scores against control cells."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.naming import CONTROL, col, feature_columns, no_nan

#: Fixed value: the smallest step of a 32-bit float at 1.
EPS = 1.1920929e-07
CHUNK = 200


def one_row(df: DataFrame, aggregates: list) -> list:
    """Many aggregates of a whole table, in passes of at most CHUNK so that generated code stays compilable."""
    out: list = []
    for i in range(0, len(aggregates), CHUNK):
        out += list(df.agg(*(a.alias(f"a{i + k}") for k, a in enumerate(aggregates[i : i + CHUNK]))).first())
    return out


@dataclass
class Normalizer:
    """Means and sample standard deviations of features over control rows. A deviation too near 0 is none: that feature becomes null."""

    mean: dict[str, float | None]
    std: dict[str, float | None]

    @classmethod
    def fit(cls, df: DataFrame, features: list[str] | None = None) -> Normalizer:
        features = features or feature_columns(df)
        rows = df.where(F.col(CONTROL))
        got = one_row(rows, [g(no_nan(col(f))) for f in features for g in (F.avg, F.stddev_samp)])
        std = {f: s if s is None or not abs(s) < EPS else None for f, s in zip(features, got[1::2])}
        return cls(dict(zip(features, got[::2])), std)

    def apply(self, df: DataFrame) -> DataFrame:
        value = lambda x: F.lit(x).cast("double")
        return df.select(*(((no_nan(col(c)) - value(self.mean[c])) / value(self.std[c])).alias(c) if c in self.mean else col(c) for c in df.columns))

    def table(self, spark: SparkSession) -> DataFrame:
        names = ", ".join(f"`{f}` double" for f in self.mean)
        return spark.createDataFrame([(stat, *values.values()) for stat, values in (("mean", self.mean), ("std", self.std))], f"_stat string, {names}")

    def save(self, spark: SparkSession, path: str) -> None:
        self.table(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Normalizer:
        rows = {r["_stat"]: {k: v for k, v in r.asDict().items() if k != "_stat"} for r in spark.read.parquet(path).collect()}  # two rows
        return cls(rows["mean"], rows["std"])
