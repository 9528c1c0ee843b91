"""Quality control of cells: edit distance, then barcodes with enough cells, then variants with enough surviving barcodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.naming import BARCODE, BATCH, EDIT, LABEL


def n_unique(c: str):
    """Distinct values, null counted as one."""
    return F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))


def barcode_counts(df: DataFrame, least: int = 10, order: str | None = None) -> DataFrame:
    """barcode: cells, first label (by `order`, else the least), and the count again where it is enough."""
    label = F.min_by(LABEL, order) if order else F.min(LABEL)
    return df.groupBy(BARCODE).agg(F.count("*").alias("count"), label.alias(LABEL)).withColumn("barcode_ok", F.when(F.col("count") >= least, F.col("count")))


def variant_barcodes(df: DataFrame, least: int = 4) -> DataFrame:
    """variant: its barcodes, and the count again where it is enough."""
    return df.groupBy(LABEL).agg(n_unique(BARCODE).cast("long").alias("barcode_count")).withColumn("variant_barcode_count_ok", F.when(F.col("barcode_count") >= least, F.col("barcode_count")))


def qc(df: DataFrame, bc_threshold: int = 10, variant_bc_threshold: int = 4, edit_distance_threshold: int = 1) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Surviving cells, barcode counts and variant counts. Counts are small tables: the cells are joined to them, never shuffled for them where they can be broadcast."""
    near = df.where(F.col(EDIT) <= edit_distance_threshold)
    barcodes = barcode_counts(near, bc_threshold)
    cells = near.join(barcodes.where("barcode_ok IS NOT NULL").select(BARCODE), BARCODE, "left_semi")
    variants = variant_barcodes(cells, variant_bc_threshold)
    return cells.join(variants.where("variant_barcode_count_ok IS NOT NULL").select(LABEL), LABEL, "left_semi"), barcodes, variants


def metadata(df: DataFrame, label: str = LABEL) -> DataFrame:
    """label: cells, and for barcode and batch (where present) the number of values and each with its count, largest first."""
    out = df.groupBy(label).agg(F.count("*").alias("meta_num_cells"))
    for c in (c for c in (BARCODE, BATCH) if c in df.columns):
        each = df.groupBy(label, c).agg(F.count("*").alias("count"))
        lists = F.array_sort(F.collect_list(F.struct(F.col(c).alias(c), F.col("count").alias("count"))), lambda a, b: F.when(a["count"] != b["count"], F.when(a["count"] > b["count"], -1).otherwise(1)).when(a[c].eqNullSafe(b[c]), 0).when(a[c].isNull() | (a[c] > b[c]), 1).otherwise(-1))
        listed = each.groupBy(F.col(label).alias("_l")).agg(F.count("*").alias(f"{c}_num_unique"), lists.alias(f"{c}_counts"))
        out = out.join(listed, F.col(label).eqNullSafe(F.col("_l"))).drop("_l")
    return out
