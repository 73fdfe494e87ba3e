"""Boosted-tree training, scoring and cross-validation. Each fit is a distributed Spark ML job."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relfold.operators.evaluate import fold_average, stratified_folds
from relfold.sources.store import ensure_checkpoint_dir

# fixed training parameters of the credit model that Spark's trees also have
DEFAULTS = {"maxDepth": 8, "stepSize": 0.02, "subsamplingRate": 0.8715623, "minInfoGain": 0.0222415, "seed": 66, "maxIter": 100}
MISSING = -1.0e9
# Fits of a cross-validation that run at once, so that one fit's small last stages leave no core idle.
SIDE_BY_SIDE = 4


def predictors(df: DataFrame, label: str, exclude: Sequence[str] = ()) -> list[str]:
    """Every column but the label and the ids."""
    return [c for c in df.columns if c != label and c not in exclude]


def assemble_features(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """keep + one feature vector; a missing value becomes a constant below every range, which trees can split off."""
    values = [F.coalesce(F.col(c).cast("double"), F.lit(MISSING)).alias(c) for c in features]
    rows = df.select(*[F.col(k).alias(f"_keep_{k}") for k in keep], *values)
    out = VectorAssembler(inputCols=list(features), outputCol="features").transform(rows)
    return out.select(*[F.col(f"_keep_{k}").alias(k) for k in keep], "features")


def train(df: DataFrame, label: str, features: Sequence[str], params: dict | None = None, valid_flag: str | None = None) -> GBTClassificationModel:
    """Fit on the rows with a label; with ``valid_flag`` (boolean column) the marked rows stop the boosting early."""
    rows = df.where(F.col(label).isNotNull())
    keep = [label] + ([valid_flag] if valid_flag else [])
    data = assemble_features(rows, features, keep).withColumn(label, F.col(label).cast("double"))
    settings = {**DEFAULTS, **(params or {})}
    gbt = GBTClassifier(labelCol=label, featuresCol="features", **settings)
    if valid_flag:
        gbt = gbt.setValidationIndicatorCol(valid_flag)
    return gbt.fit(data)


def score(model: GBTClassificationModel, df: DataFrame, features: Sequence[str], keep: Sequence[str], name: str = "score") -> DataFrame:
    """keep + probability of the positive class."""
    scored = model.transform(assemble_features(df, features, keep))
    return scored.select(*keep, vector_to_array("probability")[1].alias(name))


def feature_importance(model: GBTClassificationModel, features: Sequence[str], like: DataFrame) -> DataFrame:
    """(feature, importance), highest first; one row per model input, so its size is the table's width."""
    pairs = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray())]
    return like.sparkSession.createDataFrame(pairs, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def cross_validate(df: DataFrame, key: str, label: str, features: Sequence[str], k: int = 10, seed: int = 666,
                   params: dict | None = None) -> DataFrame:
    """(key, part, fold, score): out-of-fold scores of labelled rows, mean of the k models' scores for the others."""
    # every fold reads the split and the rows to score again, so both are computed once
    ensure_checkpoint_dir(df.sparkSession)
    known = stratified_folds(df.where(F.col(label).isNotNull()), key, label, k, seed).checkpoint()
    unknown = df.where(F.col(label).isNull()).select(key, *features).checkpoint()

    def fold(i: int) -> tuple[DataFrame, DataFrame]:
        held = known.withColumn("_valid", F.col("fold") == i)
        model = train(held, label, features, params, "_valid")
        return score(model, held.where("_valid"), features, [key, "fold"]), score(model, unknown, features, [key])

    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        parts = list(pool.map(fold, range(k)))
    valid, test = parts[0]
    for v, t in parts[1:]:
        valid, test = valid.unionByName(v), test.unionByName(t)
    test = fold_average(test, key).withColumn("fold", F.lit(None).cast("bigint")).withColumn("part", F.lit("test"))
    return valid.withColumn("part", F.lit("train")).unionByName(test).select(key, "part", "fold", "score")
