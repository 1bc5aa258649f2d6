"""Session construction.

Production jobs receive a session from the cluster; ``get_session`` is for
tests, the bench and the smoke entry.  It only fills settings that are unset
and needs no site defaults.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app_name: str = "martforge") -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    builder = (builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("MARTFORGE_DRIVER_MEMORY", "16g")))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
