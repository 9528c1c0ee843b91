"""Readers: one file is one batch; rows keep the file and place that they come from."""

from __future__ import annotations

import csv
import glob as globbing
import os
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.naming import BARCODE, BATCH, EDIT, FILE, LABEL, ROW, TAG, col, match_any, measured_columns, meta_columns

RAW = {"upBarcode": BARCODE, "aaChanges": LABEL, "editDistance": EDIT}
WIDER = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()]


def read_table(spark: SparkSession, path: str, infer_rows: int | None = 100) -> DataFrame:
    """A .csv or a Parquet table. A CSV's types are those of its first rows, or of all where infer_rows is None; a later value that doesn't fit raises when it is read, and is never lost."""
    kind = os.path.splitext(path.rstrip("/"))[1].lower()
    if kind in (".parquet", ".parq", ".pq", "") or (kind != ".csv" and os.path.isdir(path)):  # a written table is a folder
        df = spark.read.parquet(path)
        # unsigned 64-bit integers come as decimals
        return df.select(*(col(f.name).cast("bigint").alias(f.name) if isinstance(f.dataType, T.DecimalType) and f.dataType.scale == 0 else col(f.name) for f in df.schema))
    if kind != ".csv":
        raise ValueError(f"Unsupported file type: {path}")
    if infer_rows is None:
        return spark.read.csv(path, header=True, inferSchema=True)
    head = [r.value for r in spark.read.text(path).limit(infer_rows + 1).collect()]  # infer_rows + 1 lines
    if not head:
        return spark.read.csv(path, header=True)
    names = next(csv.reader(head[:1]))
    return spark.read.csv(path, header=True, schema=first_types(names, list(csv.reader(head[1:]))), mode="FAILFAST")


def first_types(names: list[str], rows: list[list[str]]) -> T.StructType:
    """Each column's type from these rows: the narrowest of bigint, double, boolean and string that holds them all; string without a value."""
    fields = []
    for i, name in enumerate(names):
        seen = [r[i] for r in rows if i < len(r) and r[i] != ""]
        kind: T.DataType = T.StringType()
        if seen and all(x.lower() in ("true", "false") for x in seen):
            kind = T.BooleanType()
        elif seen and all(re.fullmatch(r"[+-]?\d+", x) and -(2**63) <= int(x) < 2**63 for x in seen):
            kind = T.LongType()
        elif seen and all(re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|NaN|-?Inf|-?Infinity", x) for x in seen):
            kind = T.DoubleType()
        fields.append(T.StructField(name, kind))
    return T.StructType(fields)


def tagged(spark: SparkSession, path: str, infer_rows: int | None = 100, file_name: str = FILE, row_name: str = ROW) -> DataFrame:
    """The table with each row's file and place in it. Parquet tells the place at the scan; a CSV's rows are numbered in file order."""
    df = read_table(spark, path, infer_rows)
    if path.lower().endswith(".csv"):
        first = "_mono"
        numbered = df.withColumn(first, F.monotonically_increasing_id()).withColumn("_part", F.shiftright(first, 33))
        counts = {r[0]: r[1] for r in numbered.groupBy("_part").count().collect()}  # one number for each split of the file
        base, at = [], 0
        for p in sorted(counts):
            base += [F.lit(int(p)).cast("long"), F.lit(at).cast("long")]
            at += counts[p]
        place = F.element_at(F.create_map(*base), F.col("_part")) + F.col(first) - F.shiftleft("_part", 33) if base else F.lit(0).cast("long")
        return numbered.withColumn(row_name, place).withColumn(file_name, F.lit(path)).drop(first, "_part")
    return df.select("*", F.lit(path).alias(file_name), F.col("_metadata.row_index").alias(row_name)) if os.path.isfile(path) else df.select("*", F.col("_metadata.file_path").alias(file_name), F.col("_metadata.row_index").alias(row_name))


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    return WIDER[max(WIDER.index(a), WIDER.index(b))] if a in WIDER and b in WIDER else T.StringType()


def union_widened(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL in which a column takes the widest of its types."""
    types: dict[str, T.DataType] = {}
    for df in frames:
        for f in df.schema:
            types[f.name] = common_type(types.get(f.name, f.dataType), f.dataType)
    return reduce(DataFrame.unionByName, [df.select(*(col(f.name).cast(types[f.name]).alias(f.name) for f in df.schema)) for df in frames])


def load_batches(spark: SparkSession, pattern: str, use_parent_name: bool = False) -> tuple[DataFrame, str]:
    """All files that match, with meta_batch from the file's stem or its folder's name; and a stem for outputs. One plan reads every batch."""
    paths = sorted(globbing.glob(pattern))
    if not paths:
        raise ValueError(f"No files match {pattern}")
    frames = []
    for p in paths:  # the name is a literal: a batch may be a folder of part files
        stem = os.path.basename(os.path.dirname(p)) if use_parent_name else os.path.splitext(os.path.basename(p))[0]
        frames.append(read_table(spark, p).withColumn(BATCH, F.lit(stem)))
    return reduce(DataFrame.unionByName, frames), os.path.splitext(os.path.basename(paths[0]))[0] if len(paths) == 1 else "output"


def pattern_file(path: str) -> list[str]:
    return [x.strip() for x in open(path) if x.strip()]


def batch_spec(path: str) -> dict:
    """A batch's YAML: input_paths and any overrides."""
    import yaml

    return yaml.safe_load(open(path)) or {}


def ingest(spark: SparkSession, paths: list[str], allow: list[str] | None = None, block: list[str] | None = None, infer_rows: int | None = 100) -> DataFrame:
    """Raw tables to one: identity columns, `meta_origin_*`, and features through allow-list then block-list. Other `meta_` columns are dropped."""
    df = union_widened([tagged(spark, p, infer_rows, "origin_file", "origin_row_idx") for p in paths])
    features = [c for c in df.columns if c not in RAW and not c.startswith(("meta_", "origin_"))]
    if allow is not None:
        features = match_any(features, allow)
    if block:
        features = [f for f in features if f not in set(match_any(features, block))]
    return df.select(*(c for c in RAW if c in df.columns), F.col("origin_file").alias("meta_origin_file"), F.col("origin_row_idx").alias("meta_origin_row_idx"), *map(col, features))


def project_cells(df: DataFrame) -> DataFrame:
    """For QC: the label split from its tag, canonical `meta_` names, then `meta_` columns and measured features only."""
    parts = F.split("aaChanges", ":", 2)
    df = df.withColumns({LABEL: F.get(parts, F.lit(0)), TAG: F.get(parts, F.lit(1)), BARCODE: F.col("upBarcode"), EDIT: F.col("editDistance")})
    return df.select(*map(col, meta_columns(df)), *map(col, measured_columns(df)))


def by_index(df: DataFrame, index: DataFrame | None, on: list[str] | str) -> DataFrame:
    """Rows named by an index table; all rows without one."""
    return df if index is None else df.join(index.select(on).distinct(), on, "left_semi")


def load_split(spark: SparkSession, pattern: str) -> DataFrame:
    """Rows that a split index (row_idx, origin_file) names, read from the files that it names; any other table as load_batches reads it."""
    paths = sorted(globbing.glob(pattern))
    index = read_table(spark, paths[0]) if len(paths) == 1 else None
    if index is None or not {"row_idx", "origin_file"} <= set(index.columns):
        return load_batches(spark, pattern)[0]
    frames = []
    for origin in sorted(r[0] for r in index.select("origin_file").distinct().collect()):  # one name for each file
        rows = tagged(spark, origin, file_name="_file", row_name="row_idx").drop("_file")
        own = by_index(rows, index.where(F.col("origin_file") == origin), "row_idx").drop("row_idx")
        frames.append(own.withColumn(BATCH, F.lit(os.path.splitext(os.path.basename(origin.rstrip("/")))[0])) if BATCH not in own.columns else own)
    return reduce(DataFrame.unionByName, frames)
