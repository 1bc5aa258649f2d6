"""Runs of a job in a shared folder: tables, and a manifest that is written last.

A run is a folder ``<out>/<run>``.  While it is written it holds tables and no manifest, so nobody reads it; the manifest
(one JSON row per table, written in one commit) publishes it.  Each row states how many tables there are, so half
a manifest is none.  A run that ended early stays an unpublished folder.

``check`` compares a written table with what was meant to be written before the manifest may name it.
"""

from __future__ import annotations

import datetime as dt
import json
import os
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFEST = "manifest"
MANIFEST_COLUMNS = ("run string, published string, as_of string, tables long, name string, folder string, origin string, "
                    "rows long, schema string")


class RunFailed(RuntimeError):
    """A written table is not what it was meant to be; the run is not published."""


@dataclass(frozen=True)
class TableEntry:
    """A table of a run; ``origin`` is the run that computed it (an older one where it was carried over)."""

    name: str
    folder: str
    origin: str
    rows: int
    schema: str


def _missing(e: AnalysisException) -> bool:
    return (e.getCondition() or "").split(".")[0] in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def write_table(df: DataFrame, out: str, run: str, folder: str, name: str, origin: str | None = None,
                partition_by: Sequence[str] = (), keys: Sequence[str] = ()) -> TableEntry:
    """Write one table of an unpublished run, read it back and check it."""
    path = os.path.join(out, run, folder, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return check(df.sparkSession, path, TableEntry(name, folder, origin or run, -1, df.schema.json()), partition_by, keys)


def check(spark: SparkSession, path: str, entry: TableEntry, partition_by: Sequence[str] = (),
          keys: Sequence[str] = ()) -> TableEntry:
    """The entry with its row count; raises if columns differ or ``keys`` repeat."""
    meant = StructType.fromJson(json.loads(entry.schema))
    back = spark.read.schema(meant).parquet(path)
    stored = spark.read.parquet(path).schema if entry.rows < 0 else meant
    differing = [f.name for f in meant if f.name not in partition_by and (
        f.name not in stored.names or stored[f.name].dataType != f.dataType)]
    if differing:
        raise RunFailed(f"{entry.name}: columns {differing} were not stored as meant")
    if keys:
        repeated = back.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
        if repeated:
            raise RunFailed(f"{entry.name}: {list(keys)} repeat, e.g. {repeated[0]}")
    return TableEntry(entry.name, entry.folder, entry.origin, back.count(), entry.schema)


def publish(spark: SparkSession, out: str, run: str, as_of: dt.datetime, entries: Sequence[TableEntry]) -> None:
    """Write the manifest, after which the run can be read."""
    now = dt.datetime.now(dt.timezone.utc).isoformat(timespec="microseconds")
    rows = [(run, now, as_of.isoformat(), len(entries), *asdict(e).values()) for e in entries]
    spark.createDataFrame(rows, MANIFEST_COLUMNS).coalesce(1).write.json(os.path.join(out, run, MANIFEST))


def published(spark: SparkSession, out: str) -> list[dict]:
    """Complete runs below ``out``, newest first: ``run, published, as_of`` and ``tables`` (entries by name)."""
    try:
        rows = spark.read.schema(MANIFEST_COLUMNS).json(os.path.join(out, "*", MANIFEST)).collect()  # a row a table
    except AnalysisException as e:
        if _missing(e):
            return []
        raise
    runs: dict[str, dict] = {}
    for r in rows:
        run = runs.setdefault(r["run"], {"run": r["run"], "published": r["published"], "as_of": r["as_of"],
                                         "stated": r["tables"], "tables": {}})
        run["tables"][r["name"]] = TableEntry(r["name"], r["folder"], r["origin"], r["rows"], r["schema"])
    whole = [r for r in runs.values() if len(r["tables"]) == r["stated"]]
    return sorted(whole, key=lambda r: (r["published"], r["run"]), reverse=True)


def read_run(spark: SparkSession, out: str, run: str, name: str) -> DataFrame:
    """A table of a published run."""
    for found in published(spark, out):
        if found["run"] == run and name in found["tables"]:
            entry = found["tables"][name]
            return spark.read.schema(StructType.fromJson(json.loads(entry.schema))).parquet(
                os.path.join(out, run, entry.folder, name))
    raise LookupError(f"no published run {run} with a table {name} below {out}")


def newest_with(spark: SparkSession, out: str, name: str, runs: list[dict] | None = None) -> tuple[DataFrame, TableEntry] | None:
    """The table of the newest complete run that has it."""
    for found in runs if runs is not None else published(spark, out):
        if name in found["tables"]:
            return read_run(spark, out, found["run"], name), found["tables"][name]
    return None
