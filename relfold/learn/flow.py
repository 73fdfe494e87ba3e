"""From the feature matrix to scores: folds, out-of-fold and averaged test scores, their quality, and the two score files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relfold.learn.boost import cross_validate
from relfold.operators.evaluate import auc, oof_table
from relfold.sources.store import ensure_checkpoint_dir
from relfold.sources.tables import write_csv


def train_and_submit(matrix: DataFrame, key: str, label: str, features: Sequence[str], folder: str, k: int = 10, seed: int = 666, params: dict | None = None) -> DataFrame:
    """Cross-validate on the labelled rows, score the others, and write ``submission`` (test ids) and ``scores`` (all ids) as CSV below ``folder``.

    Returns (fold, rows, auc): one row for each fold and one with a NULL fold for all out-of-fold scores together. Ids are unique and not NULL.
    """
    ensure_checkpoint_dir(matrix.sparkSession)
    rows = matrix.select(key, label, *features).checkpoint()
    # every later step reads the scores, not the models
    scores = cross_validate(rows, key, label, features, k, seed, params).checkpoint()
    valid, test = scores.where("part = 'train'"), scores.where("part = 'test'")
    write_csv(test.select(key, "score"), f"{folder}/submission")
    write_csv(oof_table(valid, test, key), f"{folder}/scores")
    judged = valid.select(key, "fold", "score").join(rows.select(key, label), key)
    folds = judged.groupBy("fold").agg(F.count(F.lit(1)).alias("rows")).join(auc(judged, label, "score", ["fold"]), "fold", "left")
    whole = auc(judged, label, "score").select(F.lit(None).cast("bigint").alias("fold"), judged.select(F.count(F.lit(1))).scalar().alias("rows"), "auc")
    return folds.select("fold", "rows", "auc").unionByName(whole)
