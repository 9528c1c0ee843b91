"""Centroid batch correction: each variant's cells to the variant's own centroid over batches, then to the wild type's."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.naming import BATCH, LABEL, col, feature_columns, no_nan


@dataclass
class BatchCorrector:
    """stats: (label, batch, m0.., s0..), the mean and deviation of each feature; centroids: (label, m0.., s0..), their means over batches. features gives the order."""

    features: list[str]
    stats: DataFrame
    centroids: DataFrame
    label: str = LABEL
    batch: str = BATCH
    wild_type: str = "WT"

    @classmethod
    def fit(cls, df: DataFrame, features: list[str] | None = None, label: str = LABEL, batch: str = BATCH, wild_type: str = "WT") -> BatchCorrector:
        """Variants in a single batch are left out."""
        features = features or feature_columns(df, label, batch)
        stats = df.groupBy(label, batch).agg(*(g(no_nan(col(f))).alias(f"{k}{i}") for i, f in enumerate(features) for k, g in (("m", F.avg), ("s", F.stddev_samp))))
        several = stats.groupBy(label).agg(F.count_distinct(batch).alias("n")).where("n > 1").select(label)
        stats = stats.join(several, label, "left_semi")
        centroids = stats.groupBy(label).agg(*(F.avg(f"{k}{i}").alias(f"{k}{i}") for i in range(len(features)) for k in "ms"))
        if centroids.where(F.col(label) == wild_type).isEmpty():
            raise ValueError(f"No centroid for {wild_type!r}: it must be in two batches or more")
        return cls(features, stats, centroids, label, batch, wild_type)

    def transform(self, df: DataFrame) -> DataFrame:
        """Corrected cells of fitted variants and batches; one join with a table of variants by batches."""
        wt = self.centroids.where(F.col(self.label) == self.wild_type).first()
        names = [f"{k}{i}" for i in range(len(self.features)) for k in "ms"]
        own = self.centroids.select(self.label, *(F.col(n).alias(f"c{n}") for n in names))
        table = self.stats.join(own, self.label)
        joined = df.join(table, [self.label, self.batch])

        def corrected(i: int):
            first = (no_nan(col(self.features[i])) - F.col(f"m{i}")) / F.when(F.col(f"s{i}") != 0, F.col(f"s{i}")) * F.col(f"cs{i}") + F.col(f"cm{i}")
            return (first - F.col(f"cm{i}")) / F.when(F.col(f"cs{i}") != 0, F.col(f"cs{i}")) * F.lit(wt[f"s{i}"]).cast("double") + F.lit(wt[f"m{i}"]).cast("double")

        at = {f: i for i, f in enumerate(self.features)}
        return joined.select(*(corrected(at[c]).alias(c) if c in at else col(c) for c in df.columns))

    def save(self, path: str) -> None:
        self.stats.write.mode("overwrite").parquet(f"{path}/stats")
        self.centroids.write.mode("overwrite").parquet(f"{path}/centroids")

    @classmethod
    def load(cls, spark: SparkSession, path: str, features: list[str], **names) -> BatchCorrector:
        return cls(features, spark.read.parquet(f"{path}/stats"), spark.read.parquet(f"{path}/centroids"), **names)
