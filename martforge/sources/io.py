"""Readers.

* ``read_table``: Parquet table with an explicit column list, so only those
  columns are read (``ReadSchema`` in the scan).
* ``read_jdbc``: a warehouse table read in parallel ranges of a numeric key;
  joins happen in Spark, not in the source.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


_SCHEMAS: dict[tuple[str, str], StructType] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """A source table.  Its schema is read from the files once per application: sources do not change under a run,
    and a plan that reads a table often would otherwise start a footer-reading job each time."""
    path = table_path(sf_dir, name)
    known = (spark.sparkContext.applicationId, path)
    if known not in _SCHEMAS:
        _SCHEMAS[known] = spark.read.parquet(path).schema
    df = spark.read.schema(_SCHEMAS[known]).parquet(path)
    return df.select(*columns) if columns else df


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str,
              lower: int, upper: int, num_partitions: int, properties: dict | None = None,
              fetch_size: int = 10_000) -> DataFrame:
    """Parallel JDBC scan split into ``num_partitions`` ranges of ``partition_column``."""
    props = dict(properties or {})
    props.setdefault("fetchsize", str(fetch_size))
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                           upperBound=upper, numPartitions=num_partitions, properties=props)
