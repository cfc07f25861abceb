"""The session: UTC, adaptive execution, and shuffle partitions that adaptive execution may merge."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def session(app: str = "candlewright", **conf: str) -> SparkSession:
    """A session for candle work. Settings given by name, with dots as ``__``, come last."""
    builder = SparkSession.builder.appName(app)
    for key, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Give this package to the executors' Python, once for each application, so that functions find it there.

    The archive goes through Spark's own file server; executors need no folder of the driver.
    """
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        folder = tempfile.mkdtemp(prefix="candlewright-zip-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        package = Path(__file__).resolve().parent
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/candlewright_src", "zip", package.parent, package.name))
    return spark
