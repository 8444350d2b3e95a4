"""Model runs: features are written once, models fit and score the stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from playlake.operators import churn, features, model_tables, segments
from playlake.sources.files import read_view, write_parquet

USERS_PER_TASK = 200_000


def _stored(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back: cuts the lineage, and a model that reads
    its input several times neither recomputes it nor sees it change."""
    write_parquet(df, path)
    return read_view(spark, path)


def _laid_out(df: DataFrame) -> DataFrame:
    """Rows in an order and in tasks that follow from the rows alone.

    Fits depend on both, so neither cores, file sizes nor adaptive execution may
    have a say: users are hashed into a number of tasks taken from their count.
    """
    tasks = -(-df.count() // USERS_PER_TASK) or 1
    return df.repartition(tasks, "userId").sortWithinPartitions(*df.columns)


def run_segments(spark: SparkSession, users: DataFrame, store: str) -> tuple[DataFrame, DataFrame]:
    """Write user_features, user_segments, segment_profiles and the tables of the fitted model."""
    held = _stored(spark, users, f"{store}/user_features")
    model = segments.fit_segments(_laid_out(held))
    write_parquet(model_tables.input_table(spark, model), f"{store}/segment_inputs")
    write_parquet(model_tables.level_table(spark, model), f"{store}/segment_levels")
    write_parquet(model_tables.centre_table(spark, model), f"{store}/segment_centres")
    named = _stored(spark, segments.user_segments(model, held), f"{store}/user_segments")
    profiles = segments.segment_profiles(named)
    return named, _stored(spark, profiles, f"{store}/segment_profiles")


def run_churn(spark: SparkSession, clean: DataFrame, store: str) -> tuple[DataFrame, DataFrame]:
    """Write churn_features, churn_dataset, churn_predictions, churn_summary and the tables of the fitted model."""
    habits = _stored(spark, features.churn_features(clean), f"{store}/churn_features")
    labelled = features.churn_dataset(habits, features.churn_labels_time(clean))
    dataset = _stored(spark, labelled, f"{store}/churn_dataset")
    train, _ = churn.holdout_split(_laid_out(dataset))
    model = churn.fit_churn(train, f"{store}/churn_model")
    write_parquet(model_tables.input_table(spark, model), f"{store}/churn_inputs")
    write_parquet(model_tables.level_table(spark, model), f"{store}/churn_levels")
    write_parquet(model_tables.node_table(spark, model, f"{store}/churn_model"), f"{store}/churn_nodes")
    predictions = _stored(spark, churn.score(model, dataset), f"{store}/churn_predictions")
    summary = churn.churn_summary(predictions, churn.holdout_auc(predictions, f"{store}/churn_ranks"))
    return predictions, _stored(spark, summary, f"{store}/churn_summary")
