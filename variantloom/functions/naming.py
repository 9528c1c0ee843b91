"""Which columns are features. Two rules hold side by side: whatever isn't `meta_`, and capitalised names with an underscore."""

from __future__ import annotations

from fnmatch import fnmatchcase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LABEL, CONTROL, BARCODE, BATCH, EDIT, TAG = "meta_aa_changes", "meta_is_control", "meta_barcode", "meta_batch", "meta_edit_distance", "meta_variant_tag"
FILE, ROW = "meta_source_file", "meta_source_file_idx"


def col(name: str) -> Column:
    """A column by its whole name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def feature_columns(df: DataFrame, *but: str) -> list[str]:
    return [c for c in df.columns if not c.startswith("meta_") and c not in but]


def meta_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("meta_")]


def measured_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c[:1].isupper() and "_" in c]


def match_any(names: list[str], patterns: list[str]) -> list[str]:
    return [n for n in names if any(fnmatchcase(n, p) for p in patterns)]


def finite(c: Column) -> Column:
    """The value as a double; null where it is null, NaN or infinite."""
    c = c.cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)


def no_nan(c: Column) -> Column:
    c = c.cast("double")
    return F.when(~F.isnan(c), c)


def add_control(df: DataFrame, predicate: str = f"{LABEL} = 'WT'") -> DataFrame:
    """meta_is_control by any SQL predicate."""
    return df.withColumn(CONTROL, F.expr(predicate))


def to_long(df: DataFrame, keys: list[Column], features: list[str]) -> DataFrame:
    """(keys, feature, v): one row for each finite value."""
    pairs = F.array(*(F.struct(F.lit(f).alias("feature"), finite(col(f)).alias("v")) for f in features))
    return df.select(*keys, F.explode(pairs).alias("_p")).select("*", "_p.feature", "_p.v").drop("_p").where("v IS NOT NULL")
