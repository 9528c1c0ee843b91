"""Incremental arrival of batches: each new file is a micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from ..functions.naming import BARCODE, BATCH, LABEL


def cell_stream(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 1) -> DataFrame:
    """Cells of the files that appear in a folder, with meta_batch from the file's name."""
    stem = F.regexp_extract(F.col("_metadata.file_name"), "^(.*?)(?:\\.[^.]*)?$", 1)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder).withColumn(BATCH, stem)


def barcode_counts_stream(cells: DataFrame) -> DataFrame:
    """Running cell counts of (variant, barcode), kept in state."""
    return cells.groupBy(LABEL, BARCODE).agg(F.count("*").alias("count"))


def each_batch(cells: DataFrame, handle, checkpoint: str) -> DataStreamWriter:
    """handle(batch, id) for each arrival: any batch operator of this package applies there."""
    return cells.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True)
