"""Materialised feature blocks: compute once, reuse by name, data key and plan.

A block is written as parquet under the folder the session names in ``spark.checkpoint.dir`` (shared storage on a
cluster), or as a table bucketed by the entity where a catalog database is given. Bucketed blocks join without a
shuffle.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder: spark.checkpoint.dir, or a folder in the warehouse (shared as well) where that is unset. Never a machine's own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/relfold-scratch"
    return found.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Checkpoints go to the shared folder."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def stored(df: DataFrame, name: str = "step") -> DataFrame:
    """The same rows, written to the shared folder as Parquet under a name of their own and read again: no lineage, no repeated work, sizes known to Catalyst."""
    path = f"{shared_dir(df.sparkSession)}/relfold-steps/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a query that is planned and run inside are deleted with its end; else they stay until the driver collects its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def place(spark: SparkSession, name: str, key: str, buckets: int, parts: Sequence[Callable[[], DataFrame]]) -> DataFrame:
    """The rows of the parts as one stored table bucketed by the key: folds and joins by the key then need no shuffle.

    The parts are written one after another, each without the shuffle files of the one before. The table is this run's own, in the shared folder.
    """
    own = f"{name}_{uuid.uuid4().hex}"
    table, path = f"relfold_{own}", f"{shared_dir(spark)}/relfold-steps/{own}"
    with shuffles_deleted(spark):
        for part in parts:
            rows = part().repartition(buckets, key)
            rows.write.mode("append").bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(table)
    return spark.table(table)


# How the file systems that Spark reads through write the status of a file; the fields between do not matter.
STATUS = re.compile(r"path=([^;]*); isDirectory=false; length=(\d+);.*?modification_time=(\d+)")


def file_versions(spark: SparkSession, files: Iterable[str]) -> list[str]:
    """Path, length and modification time of each file, from one listing for each folder, so that a rewritten file gives another list."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = {p.toString(): p for f in files for p in [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI.create(f))]}
    folders = {p.getParent().toString(): p.getParent() for p in paths.values()}
    found: dict[str, str] = {}
    for folder in folders.values():
        listing = "".join(status.toString() for status in folder.getFileSystem(conf).listStatus(folder))
        for path, length, changed in STATUS.findall(listing):
            found[jvm.org.apache.hadoop.fs.Path(path).toUri().getPath()] = f"{length}:{changed}"
    return sorted(f"{name}:{found.get(p.toUri().getPath(), 'unknown')}" for name, p in paths.items())


def spec_hash(df: DataFrame, data_key: str, params: str = "") -> str:
    """Changes with the data key, the parameters, the columns, the plan (so with every option that shapes it) and the input files: names, lengths and times."""
    text = "|".join([data_key, params, df.schema.simpleString(), str(df.semanticHash()), *file_versions(df.sparkSession, df.inputFiles())])
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def _complete(spark: SparkSession, path: str) -> bool:
    """Whether an earlier write was committed (its _SUCCESS marker is there)."""
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def block_path(df: DataFrame, name: str, data_key: str, root: str | None = None, params: str = "") -> str:
    return f"{root or shared_dir(df.sparkSession) + '/relfold-blocks'}/{name}/{data_key}-{spec_hash(df, data_key, params)}"


def materialize(df: DataFrame, name: str, data_key: str, root: str | None = None, params: str = "") -> DataFrame:
    """Store the block under (name, data_key, spec hash) unless a complete copy is there; return the stored block.

    After any input file was rewritten, the block is built anew beside the old one.
    """
    spark = df.sparkSession
    path = block_path(df, name, data_key, root, params)
    if not _complete(spark, path):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_bucketed(df: DataFrame, name: str, data_key: str, key: str, buckets: int, root: str | None = None, params: str = "") -> DataFrame:
    """The same as a table bucketed and sorted by the entity: blocks with equal bucket counts join without a shuffle."""
    spark = df.sparkSession
    path = block_path(df, name, data_key, root, f"{params}|{key}|{buckets}")
    table = f"relfold_{name}_{hashlib.sha256(path.encode()).hexdigest()[:16]}"
    if not spark.catalog.tableExists(table):
        rows = df.repartition(buckets, key)
        rows.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(table)
    return spark.table(table)
