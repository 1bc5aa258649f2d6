"""Shared helpers: reading, reliable intermediate tables, Arrow batch mapping."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space of all contracts here: space and 0x09-0x0D (what ``bytes.split()`` splits at).
ASCII_WS = b" \t\n\x0b\x0c\r"

#: Rows an Arrow batch may hold: whole texts are never split, so few rows keep a batch small.
BATCH_ROWS = 512


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application: their Python may not have it on its path."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="martforge-code-"), "martforge-code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)  # the driver serves it to every executor
    _SHIPPED.add(app)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the given folder; every query begins here."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only a local session without the setting (tests) gets a scratch folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get().rstrip("/")
    root = tempfile.mkdtemp(prefix="martforge-llm-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


_MADE: dict[str, SparkSession] = {}


def new_path(spark: SparkSession, tag: str) -> str:
    """A new folder below the shared root; ``release`` deletes it when its readers are done."""
    path = f"{shared_root(spark)}/llm-{tag}-{uuid.uuid4().hex[:12]}"
    _MADE[path] = spark
    return path


def release(spark: SparkSession) -> None:
    """Delete the intermediate tables that this application has written.

    Call it once their results are stored; results still to be computed read them.
    """
    for path in [p for p, s in _MADE.items() if s.sparkContext.applicationId == spark.sparkContext.applicationId]:
        drop_path(spark, path)


def written(df: DataFrame, tag: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to a new Parquet table in the shared folder and read it back.

    The table outlives lost executors, and what was computed is not computed again.
    """
    path = new_path(df.sparkSession, tag)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, tag: str, key: str) -> DataFrame:
    """As ``written``, dealt by ``key`` into as many buckets as a shuffle has partitions, each a sorted file.

    Buckets of two such tables hold the same keys, so Spark joins and aggregates them by ``key`` without an exchange.
    The catalog knows the table only until it is read here; its files are those of ``new_path``.
    """
    spark = df.sparkSession
    path, name = new_path(spark, tag), f"llm_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # a table with a path of its own keeps its files
    return table


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` cut off from its lineage by a reliable checkpoint in the shared folder."""
    shared_root(df.sparkSession)  # sets a folder where a local session has none
    return df.checkpoint()


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store once nothing reads it any more."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)
    _MADE.pop(path, None)


def share_files(spark: SparkSession, path: str) -> list[str]:
    """Have Spark bring the files of a Parquet table in the shared folder to every executor; their names there.

    Executors fetch them through Spark's own file layer, whatever store holds them, also those that start later.
    Files without rows, which empty tasks may write, are left out.
    """
    names = []
    found = spark.read.parquet(path).select(F.input_file_name().alias("file")).distinct().collect()  # a name a file
    for file in sorted(r["file"] for r in found):
        spark.sparkContext.addFile(file)
        names.append(file.rsplit("/", 1)[1])
    return names


def executor_file(name: str) -> str:
    """Local place of a file of ``share_files`` in a task."""
    return SparkFiles.get(name)


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows, so what is built beside a batch stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str, arrow: pa.Schema,
                rows: int = BATCH_ROWS) -> DataFrame:
    """``mapInArrow`` for functions from one batch to columns (a dict by name)."""
    def run(batches):
        for batch in small_batches(batches, rows):
            yield pa.RecordBatch.from_pydict(fn(batch), schema=arrow)
    return df.mapInArrow(run, schema)


def bounded_sample(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """About ``rows`` rows of ``df`` (all, if it has fewer), the same for the same keys: those whose key hash lies
    below the share wanted.  No row is gathered to choose them; keys should be different."""
    n = df.count()
    if n <= rows:
        return df
    return df.where(F.shiftrightunsigned(F.xxhash64(key), 1) < F.lit(int((1 << 63) * (rows / n))))


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file (the package is on every node)."""
    import public_tokenizers
    return public_tokenizers.path(os.path.basename(name))


def append_columns(df: DataFrame, inputs: dict, fn: Callable[[pa.RecordBatch], dict], ddl: str, arrow: pa.Schema,
                   rows: int = BATCH_ROWS) -> DataFrame:
    """``df`` with the columns of ``arrow`` appended, made by ``fn`` from the ``inputs`` (columns by name).

    The columns of ``df`` pass through under neutral names, so theirs may be anything.
    """
    names = [f"c{i}" for i in range(len(df.columns))]
    src = df.select(*[df[f"`{c}`"].alias(n) for c, n in zip(df.columns, names)],
                    *[c.alias(f"in_{n}") for n, c in inputs.items()])
    given = list(inputs)
    kept = ", ".join(f"{n} {src.schema[n].dataType.simpleString()}" for n in names)

    def run(batches):
        for batch in small_batches(batches, rows):
            made = fn(pa.RecordBatch.from_arrays([batch.column(f"in_{n}") for n in given], given))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], *[pa.array(made[f.name], f.type) for f in arrow]],
                [*names, *arrow.names])

    return src.mapInArrow(run, f"{kept}, {ddl}").toDF(*df.columns, *arrow.names)
