"""Norms, dot products and cosine distances over feature columns: a row's values become one array, so that any number of columns makes an expression of the same depth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .naming import CONTROL, col, feature_columns, finite, to_long


def _vector(features: list[str]) -> Column:
    return F.array(*(col(f).cast("double") for f in features)) if features else F.array().cast("array<double>")


def _numbers(values: list[float | None]) -> Column:
    return F.array(*(F.lit(v).cast("double") for v in values)) if values else F.array().cast("array<double>")


def _total(terms: Column) -> Column:
    """The sum of an array; null counts as nothing."""
    return F.aggregate(terms, F.lit(0.0), lambda a, v: a + F.coalesce(v, F.lit(0.0)))


def norm(features: list[str]) -> Column:
    return F.sqrt(_total(F.transform(_vector(features), lambda v: v * v)))


def query_vector(query: DataFrame, features: list[str]) -> dict[str, float | None]:
    """The one row of a table, as a query vector; any other number of rows is refused."""
    rows = query.select(*map(col, features)).limit(2).collect()
    if len(rows) != 1:
        raise ValueError("a query vector is one row, not " + ("none" if not rows else "several"))
    return dict(zip(features, rows[0]))


def query_dot(features: list[str], query: dict[str, float] | DataFrame) -> Column:
    """The dot product with a query: numbers by feature, or a table of one row."""
    query = query_vector(query, features) if isinstance(query, DataFrame) else query
    return _total(F.zip_with(_vector(features), _numbers([query.get(f) for f in features]), lambda v, q: v * q))


def cosine_distance(features: list[str], query: dict[str, float | None] | DataFrame) -> Column:
    """1 - cosine to a query vector, over the dimensions finite on both sides; a norm of zero counts as 1."""
    query = query_vector(query, features) if isinstance(query, DataFrame) else query
    used = [f for f in features if query.get(f) is not None and abs(query[f]) < float("inf")]
    x, q = F.transform(_vector(used), finite), _numbers([float(query[f]) for f in used])
    own = F.sqrt(_total(F.transform(x, lambda v: v * v)))
    other = F.sqrt(_total(F.zip_with(x, q, lambda v, w: F.when(v.isNotNull(), w * w))))
    whole = lambda n: F.when(n == 0, 1.0).otherwise(n)
    return 1.0 - _total(F.zip_with(x, q, lambda v, w: v * w)) / (whole(own) * whole(other))


def control_median(df: DataFrame, features: list[str] | None = None) -> dict[str, float | None]:
    """Each feature's median over control rows: one number for each column."""
    features = features or feature_columns(df)
    found = {r[0]: r[1] for r in to_long(df.where(F.col(CONTROL)), [], features).groupBy("feature").agg(F.median("v")).collect()} if features else {}
    return {f: found.get(f) for f in features}


def impact_score(df: DataFrame, features: list[str] | None = None) -> DataFrame:
    """meta_impact_score: half the cosine distance to the control median; from 0 to 1."""
    features = features or feature_columns(df)
    return df.withColumn("meta_impact_score", cosine_distance(features, control_median(df, features)) / 2)
