"""Helpers that several text operators share."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space that separates words: the ASCII blanks, nothing else.
BLANKS = r"[\x20\x09-\x0D]+"

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the session names in spark.checkpoint.dir; a temporary one only where the setting is unset (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found or tempfile.mkdtemp(prefix="llm-"))
    return spark.sparkContext.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared checkpoint folder; later reads survive lost executors and repeat no work.

    The shuffle files of the step are deleted with its end, else those of all steps pile up on the executors' disks.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        return df.select("*").checkpoint()  # a plan made under the setting
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def pieces(text: Column) -> Column:
    """The text cut at every single blank, so with empty pieces between blanks; NULL counts as empty."""
    return F.split(F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     "), " ", -1)


def words(text: Column) -> Column:
    """The words of a text, in order; NULL counts as empty."""
    return F.array_remove(pieces(text), "")


def id_crc(name: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % modulus


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all other characters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def values(column: pa.Array) -> Iterator:
    """Python values one by one, so that a batch is never held twice."""
    return (x.as_py() for x in column)


def raw_texts(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text, NULL as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return (x.as_py() or b"" for x in column.cast(kind))


def out_batch(like: pa.Array, rest: dict[str, pa.Array]) -> pa.RecordBatch:
    """A batch of the id column and what was found for each row."""
    return pa.RecordBatch.from_arrays([like, *rest.values()], ["id", *rest])


def id_schema(df: DataFrame, name: str, rest: str) -> str:
    """Schema text of an ``id`` column of the type that ``name`` has, then the rest."""
    return f"id {df.schema[name].dataType.simpleString()}, {rest}"
