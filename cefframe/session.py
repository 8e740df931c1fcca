"""Session helpers for tests, tools and the benchmark (not used by the library)."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "cefframe") -> SparkSession:
    """A local session configured like the tests: UTC, AQE on, no UI."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.driver.memory", os.environ.get("CEF_DRIVER_MEMORY", "8g")))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cefframe-chk-"))
    return spark
