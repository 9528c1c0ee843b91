"""Sessions, and shipping this package to executors."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

#: Bytes of a batch of rows on its way to a Python worker: beside the rows themselves both sides hold such a batch.
BATCH = "4m"
_shipped: set[str] = set()


def get_session(app: str = "variantloom", **conf: str) -> SparkSession:
    """A session with the settings the operators count on: adaptive execution and UTC. Values given win."""
    settings = {"spark.sql.adaptive.enabled": "true", "spark.sql.session.timeZone": "UTC", "spark.sql.execution.arrow.maxBytesPerBatch": BATCH, "spark.ui.showConsoleProgress": "false"} | {k.replace("__", "."): v for k, v in conf.items()}
    return SparkSession.builder.appName(app).config(map=settings).getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors' Python workers this package, once for each application; and small batches, unless the session was configured otherwise."""
    if "spark.sql.execution.arrow.maxBytesPerBatch" not in dict(spark.sparkContext.getConf().getAll()):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        where = tempfile.mkdtemp(prefix="variantloom-ship-")
        spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(where, "variantloom"), "zip", root, "variantloom"))
        _shipped.add(app)
    return spark
