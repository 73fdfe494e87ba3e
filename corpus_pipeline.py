"""A corpus pipeline in five stages over ``documents``; each stage calls one operator of the text package and its decisions take effect.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of documents; the last one adds what the mix takes of each document. Empty
tables pass through. NULL texts are rejected by the first stage; on their own the other stages keep one of them, find nothing in them, and take no words.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relfold.llm import decontaminate, mixing, quality, secrets, simhash
from relfold.llm.common import checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep_good(docs, quality.rule_order(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints of three-word shingles within 3 bits: the smallest id, of rows without id the smallest hash of the text.

    Of several rows with that id and text the one with the smallest other columns stays.
    """
    keyed = docs.select(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("key")).alias("row"), F.struct(*docs.columns).alias("kept"), "text")
    near = simhash.near_duplicates(keyed, "row", "text", shingle=3, radius=3)
    first = keyed.groupBy("row").agg(F.min("kept").alias("kept"))
    return first.join(near.select(F.col("component_id").alias("row")).distinct(), "row").select("kept.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; n_chars follows the new text."""
    return secrets.redacted(docs, "text", "n_chars")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes words of, with how many: whole repetitions, words of a partial one, and both together.

    Where documents have a column of such a name already, the new one gets ``mix_`` in front.
    """
    taken = mixing.mix(docs, keep=docs.columns).where("taken > 0")
    have = {c.lower() for c in docs.columns}
    return taken.select("kept.*", *[F.col(m).alias(f"mix_{m}" if m in have else m) for m in ("size", "source_size", "target", "epochs", "part", "taken")])


STAGES = [("quality rules", quality_rules), ("simhash near-dedup", near_dedup), ("benchmark decontamination", decontamination), ("secret scan", secret_scan), ("source mix", source_mix)]

# Fingerprints, edit distances and token counts have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet to the shared folder and read again."""
    root = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{k}")
        docs = spark.read.parquet(f"{root}/{k}")
    return docs
