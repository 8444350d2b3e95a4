"""User segments: k-means on scaled habits, named by mean plays."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Window, functions as F

from playlake import fixed
from playlake.functions.labels import segment_name
from playlake.functions.numbers import half_up, percent
from playlake.operators.features import HABIT_COLUMNS


def scaled_features(numeric: list[str]) -> list:
    """Stages: index the level, assemble, standardise. Unknown levels get an index of their own."""
    return [
        StringIndexer(inputCol="level", outputCol="level_idx", handleInvalid="keep"),
        VectorAssembler(inputCols=[*numeric, "level_idx"], outputCol="features_raw"),
        StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
    ]


def _complete(features: DataFrame) -> DataFrame:
    """Missing habits count as 0; the user id is left alone."""
    return features.na.fill(0, subset=HABIT_COLUMNS)


def fit_segments(features: DataFrame, k: int = fixed.SEGMENTS, seed: int = fixed.SEED) -> PipelineModel:
    """Fit on a stored feature table: k-means reads it several times.

    The fit depends on row order, so give it a written table.
    """
    kmeans = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="segment")
    return Pipeline(stages=[*scaled_features(HABIT_COLUMNS), kmeans]).fit(_complete(features))


def segment_ranks(assigned: DataFrame) -> DataFrame:
    """segment -> name, by descending mean plays. At most k rows."""
    means = assigned.groupBy("segment").agg(F.avg("total_plays").alias("mean_plays"))
    order = Window.orderBy(F.desc("mean_plays"), "segment")
    return means.select("segment", segment_name(F.row_number().over(order) - 1).alias("segment_label"))


def user_segments(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Every user with its segment and the segment's name.

    The ranked side holds one row per cluster (k), so broadcasting it is safe
    at any number of users.
    """
    assigned = model.transform(_complete(features)).select("userId", "segment", *HABIT_COLUMNS, "level")
    named = assigned.join(F.broadcast(segment_ranks(assigned)), "segment")
    return named.select("userId", "segment", "segment_label", *HABIT_COLUMNS, "level")


def segment_profiles(segments: DataFrame, by: str = "segment_label") -> DataFrame:
    return segments.groupBy(by).agg(
        F.count(F.lit(1)).alias("user_count"),
        half_up(F.avg("total_plays"), 0).alias("avg_plays"),
        half_up(F.avg("unique_artists"), 0).alias("avg_artists"),
        half_up(F.avg("active_days"), 0).alias("avg_active_days"),
        half_up(F.avg("avg_duration"), 0).alias("avg_duration_sec"),
        percent(F.count_if(F.col("level") == "paid"), F.count(F.lit(1))).alias("paid_pct"),
    )
