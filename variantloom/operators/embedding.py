"""Embeddings of aggregated variants: principal components, and UMAP where that library is installed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.naming import LABEL, col, feature_columns
from .normalize import one_row
from .selection import fittable


def pca(df: DataFrame, k: int = 10, label: str = LABEL, features: list[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scores (label, meta_pc_1..), loadings (feature, meta_component_idx, loading) and explained variance. Columns without a value are dropped; a partly null one raises."""
    from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    features, _ = fittable(df, features or feature_columns(df, label))
    counts = one_row(df, [F.count("*"), *(F.count(col(f)) for f in features)])
    if any(c != counts[0] for c in counts[1:]):
        raise ValueError("Some features are partly null")
    if k > min(counts[0], len(features)):
        raise ValueError(f"{k} components of {counts[0]} rows and {len(features)} features")
    rows = df.select(label, *(col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)))
    vectors = VectorAssembler(inputCols=[f"x{i}" for i in range(len(features))], outputCol="raw").transform(rows)
    centred = StandardScaler(inputCol="raw", outputCol="v", withMean=True, withStd=False).fit(vectors).transform(vectors)
    model = PCA(k=k, inputCol="v", outputCol="pc").fit(centred)
    scores = model.transform(centred).select(label, vector_to_array("pc").alias("pc")).select(label, *(F.get("pc", F.lit(i)).alias(f"meta_pc_{i + 1}") for i in range(k)))
    spark, ratio, loading = df.sparkSession, model.explainedVariance.toArray(), model.pc.toArray()
    loadings = spark.createDataFrame([(f, j + 1, float(loading[i, j])) for i, f in enumerate(features) for j in range(k)], "feature string, meta_component_idx long, loading double")
    variance = spark.createDataFrame([(j + 1, float(ratio[j]), float(ratio[: j + 1].sum())) for j in range(k)], "meta_component_idx long, meta_variance_explained double, meta_cumulative_variance_explained double")
    return scores, loadings, variance


def umap(df: DataFrame, n_components: int = 2, n_neighbors: int = 10, metric: str = "cosine", min_dist: float = 0.1, random_state: int | None = 42, label: str = LABEL) -> DataFrame:
    """Coordinates of each label. The table has one row for each variant, so it is embedded on the driver."""
    try:
        import umap as library
    except ImportError as e:
        raise RuntimeError("UMAP needs the umap-learn library") from e
    features, _ = fittable(df, feature_columns(df, label))
    rows = df.select(label, *map(col, features)).toPandas()
    at = library.UMAP(n_components=n_components, n_neighbors=n_neighbors, metric=metric, min_dist=min_dist, random_state=random_state).fit_transform(rows[features].to_numpy(float))
    out = rows[[label]].copy()
    for i in range(n_components):
        out[f"meta_umap_{i + 1}"] = at[:, i]
    return df.sparkSession.createDataFrame(out)
