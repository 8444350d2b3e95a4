"""Churn: a random forest on early-period habits, scored for every user."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from playlake import fixed
from playlake.functions import ranks
from playlake.functions.labels import risk_band
from playlake.functions.numbers import half_up
from playlake.operators.features import HABIT_COLUMNS
from playlake.operators.segments import scaled_features

CHURN_COLUMNS = [*HABIT_COLUMNS, "days_span", "plays_per_day"]
PREDICTION_COLUMNS = [
    "userId",
    "label",
    "churn_probability",
    "risk_level",
    "total_plays",
    "unique_artists",
    "active_days",
    "plays_per_day",
    "avg_duration",
    "level",
]


def in_training(user: Column) -> Column:
    """True for about 80 % of the users. A hash of the user, so the split stays
    the same under any partitioning and when a task is run again."""
    return F.pmod(F.xxhash64(user, F.lit(fixed.SEED)), F.lit(100)) < fixed.TRAIN_PERCENT


def holdout_split(dataset: DataFrame) -> tuple[DataFrame, DataFrame]:
    train = in_training(F.col("userId"))
    return dataset.filter(train), dataset.filter(~train)


def fit_churn(train: DataFrame, path: str) -> PipelineModel | None:
    """Fit on a stored table and keep the model at ``path``; None without rows.

    The stored copy is returned: a freshly fitted forest drags its training
    summary, and with it the session, into every scoring task.
    """
    if train.isEmpty():
        return None
    forest = RandomForestClassifier(
        numTrees=fixed.FOREST_TREES,
        maxDepth=fixed.FOREST_DEPTH,
        seed=fixed.SEED,
        featuresCol="features",
        labelCol="label",
        probabilityCol="probability",
    )
    fitted = Pipeline(stages=[*scaled_features(CHURN_COLUMNS), forest]).fit(train)
    fitted.write().overwrite().save(path)
    return PipelineModel.load(path)


def score(model: PipelineModel | None, dataset: DataFrame) -> DataFrame:
    """Every user with churn probability and risk band.

    A forest that only ever saw one class returns a vector of length 1; its
    probability of churn is 0.
    """
    if model is None:
        scored = dataset.withColumn("churn_probability", F.lit(0.0))
    else:
        second = F.get(vector_to_array("probability"), F.lit(1))
        scored = model.transform(dataset).withColumn(
            "churn_probability", F.coalesce(second, F.lit(0.0))
        )
    banded = scored.withColumn("risk_level", risk_band(F.col("churn_probability")))
    return banded.select(*PREDICTION_COLUMNS)


def feature_auc(dataset: DataFrame, store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(feature, positives, negatives, auc): how well each number alone tells who churns."""
    each = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in CHURN_COLUMNS]
    values = dataset.select("label", F.inline(F.array(*each)))
    return ranks.roc_auc(values, "value", "label", ["feature"], store)


def _kept_at(path: str):
    def store(frame: DataFrame) -> DataFrame:
        frame.write.mode("overwrite").parquet(path)
        return frame.sparkSession.read.schema(frame.schema).parquet(path)

    return store


def holdout_auc(predictions: DataFrame, work: str) -> float | None:
    """Area under ROC of the held-out users' scores; None unless both labels occur there.

    Exact at any size: ties share their rank, and no curve is thinned out. ``work`` is
    a folder for the counts per score.
    """
    held = predictions.filter(~in_training(F.col("userId")))
    row = ranks.roc_auc(held, "churn_probability", "label", [], _kept_at(work)).first()
    return row["auc"] if row else None


def churn_risk_counts(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("risk_level").agg(F.count(F.lit(1)).alias("user_count"))


def churn_summary(predictions: DataFrame, auc: float | None) -> DataFrame:
    """One row of headline numbers; the churn rate is that of the labels trained on."""

    def users(band: str) -> Column:
        return F.count_if(F.col("risk_level") == band)

    area = F.lit(None if auc is None else round(auc, 4)).cast("double")
    return predictions.agg(
        F.count(F.lit(1)).alias("total_users"),
        users("High").alias("high_risk"),
        users("Medium").alias("medium_risk"),
        users("Low").alias("low_risk"),
        half_up(F.avg("churn_probability") * 100, 1).alias("avg_churn_pct"),
        area.alias("auc_roc"),
        half_up(F.avg("label") * 100, 1).alias("churn_rate_pct"),
    )
