"""Readers and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None, fmt: str = "csv") -> DataFrame:
    """Headered CSV with a declared schema (blank = NULL), or parquet."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    if schema is None:
        raise ValueError("a CSV needs a schema; inferring one would read the data twice")
    return spark.read.schema(schema).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Headered CSV folder, one part per partition."""
    df.write.mode("overwrite").option("header", True).csv(path)


def save_split(df: DataFrame, path: str, key: str, part: str = "part") -> DataFrame:
    """Store (id, part) and read it back, so that later runs use the same split."""
    df.select(key, part).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def labelled_union(train: DataFrame, test: DataFrame, label: str = "label") -> DataFrame:
    """Training and test entities in one table; test rows have a NULL label."""
    return train.unionByName(test.withColumn(label, F.lit(None).cast(train.schema[label].dataType)), allowMissingColumns=True)
