"""Models as tables: their rows give what the fitted models give, here and in DuckDB."""

import duckdb
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from checks.queries import cleaned, order_clean
from playlake.functions import ranks
from playlake.operators import churn, features, model_tables, segments
from playlake.plans.models import run_churn, run_segments
from playlake.sources.files import read_view
from tests.conftest import SMALL, plan, rows


@pytest.fixture(scope="module")
def churn_store(spark, tmp_path_factory):
    store = str(tmp_path_factory.mktemp("churn"))
    run_churn(spark, order_clean(spark, SMALL), store)
    return store


@pytest.fixture(scope="module")
def segment_store(spark, tmp_path_factory):
    store = str(tmp_path_factory.mktemp("segments"))
    run_segments(spark, features.user_features(cleaned(spark, SMALL)), store)
    return store


def tables(spark, store, *names):
    return [read_view(spark, f"{store}/{name}") for name in names]


def duck(store, *names):
    con = duckdb.connect()
    for name in names:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{store}/{name}/*.parquet')")
    return con


def stored(path):
    def store(df):
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.parquet(path)

    return store


MODEL_INPUTS = """
numbers AS (
  SELECT rows.*, i.feature, ((CASE i.name WHEN 'level_idx' THEN coalesce(l.place, (SELECT count(*) FROM {0}_levels))
    WHEN 'total_plays' THEN total_plays WHEN 'unique_artists' THEN unique_artists WHEN 'unique_songs' THEN unique_songs
    WHEN 'total_sessions' THEN total_sessions WHEN 'avg_duration' THEN avg_duration WHEN 'active_days' THEN active_days
    {1} END)::DOUBLE - i.mean) * i.scale AS x
  FROM {2} rows LEFT JOIN {0}_levels l ON rows.level = l.level, {0}_inputs i
)"""


def test_nodes_give_the_forest_s_probabilities(spark, churn_store):
    parts = tables(spark, churn_store, "churn_dataset", "churn_inputs", "churn_levels", "churn_nodes")
    mine = model_tables.forest_scores(*parts)
    both = mine.withColumnRenamed("churn_probability", "mine").join(
        read_view(spark, f"{churn_store}/churn_predictions"), "userId"
    )
    assert both.count() == parts[0].count() == mine.count() > 1000
    assert both.agg(F.max(F.abs(F.col("mine") - F.col("churn_probability")))).first()[0] < 1e-9
    nodes = parts[3]
    assert nodes.count() <= 100 * 2**7 and nodes.select("tree").distinct().count() == 100
    text = plan(mine)
    assert "Python" not in text and text.count("BroadcastHashJoin") >= 7 and "CartesianProduct" not in text


def test_nodes_give_the_scores_in_duckdb(spark, churn_store):
    con = duck(churn_store, "churn_dataset", "churn_inputs", "churn_levels", "churn_nodes", "churn_predictions")
    more = "WHEN 'days_span' THEN days_span WHEN 'plays_per_day' THEN plays_per_day"
    worst, count = con.execute(
        f"""WITH RECURSIVE {MODEL_INPUTS.format("churn", more, "churn_dataset")},
        places AS (
          SELECT userId, tree, 0 AS node FROM churn_dataset, (SELECT DISTINCT tree FROM churn_nodes)
          UNION ALL
          SELECT p.userId, p.tree, CASE WHEN x <= threshold THEN low ELSE high END
          FROM places p JOIN churn_nodes n ON p.tree = n.tree AND p.node = n.node
          JOIN numbers v ON v.userId = p.userId AND v.feature = n.feature
        ), scores AS (
          SELECT userId, avg(share) AS mine FROM places p JOIN churn_nodes n ON p.tree = n.tree AND p.node = n.node
          WHERE n.feature IS NULL GROUP BY userId
        )
        SELECT max(abs(mine - churn_probability)), count(*) FROM scores JOIN churn_predictions USING (userId)"""
    ).fetchone()
    assert count == spark.read.parquet(f"{churn_store}/churn_predictions").count() and worst < 1e-9


def test_importances_are_the_forest_s(spark, churn_store):
    model = PipelineModel.load(f"{churn_store}/churn_model")
    got = dict(rows(model_tables.importances(*tables(spark, churn_store, "churn_nodes", "churn_inputs"))))
    want = model.stages[-1].featureImportances.toArray()
    for name, value in zip(model.stages[1].getInputCols(), want, strict=True):
        assert got[name] == pytest.approx(value, abs=1e-9)


def test_no_model_scores_zero(spark):
    users = spark.createDataFrame([(1, "free")], "userId int, level string")
    none = [model_tables.input_table(spark, None), model_tables.level_table(spark, None), model_tables.node_table(spark, None, "")]
    assert rows(model_tables.banded(model_tables.forest_scores(users, *none))) == [(1, 0.0, "Low")]


def test_one_leaf_and_unknown_levels(spark):
    users = spark.createDataFrame([(1, "free", 2.0), (2, None, 3.0), (3, "gone", None)], "userId int, level string, v double")
    inputs = spark.createDataFrame([(0, "v", 1.0, 2.0), (1, "level_idx", 0.0, 1.0)], model_tables.INPUTS_DDL)
    levels = spark.createDataFrame([("free", 0)], model_tables.LEVELS_DDL)
    leaf = spark.createDataFrame([(0, 0, None, None, None, None, 0.5, 1.0, None)], model_tables.NODES_DDL)
    assert rows(model_tables.forest_scores(users, inputs, levels, leaf)) == [(1, 0.5), (2, 0.5), (3, 0.5)]
    assert [list(r[0]) for r in users.orderBy("userId").select(model_tables.model_vector(inputs, levels)).collect()] == [
        [2.0, 0.0], [4.0, 1.0], [None, 1.0],
    ]


def test_centres_give_the_segments(spark, segment_store):
    parts = tables(spark, segment_store, "user_features", "segment_inputs", "segment_levels", "segment_centres")
    mine = model_tables.assigned(*parts)
    named = read_view(spark, f"{segment_store}/user_segments")
    assert rows(mine, "userId", "segment") == rows(named, "userId", "segment")
    assert "Python" not in plan(mine) and "Join" not in plan(mine)
    assert parts[3].count() == 4 * 7


def test_centres_give_segments_and_profiles_in_duckdb(spark, segment_store):
    con = duck(segment_store, "user_features", "segment_inputs", "segment_levels", "segment_centres")
    con.execute(
        f"""CREATE VIEW assigned AS WITH {MODEL_INPUTS.format("segment", "", "user_features")}
        SELECT userId, arg_min(segment, distance) AS segment FROM (
          SELECT userId, segment, sum((x - centre) ** 2) AS distance
          FROM numbers JOIN segment_centres c ON c.feature = numbers.feature GROUP BY userId, segment) GROUP BY userId"""
    )
    con.execute(
        """CREATE VIEW named AS SELECT userId, segment, (['Power Users', 'Regular Listeners', 'Casual Listeners',
          'At-Risk Users'])[place] AS segment_label FROM assigned JOIN (
          SELECT segment, row_number() OVER (ORDER BY avg(total_plays) DESC, segment) AS place
          FROM assigned JOIN user_features USING (userId) GROUP BY segment) ranked USING (segment)"""
    )
    got = sorted(con.execute("SELECT userId, segment, segment_label FROM named").fetchall(), key=repr)
    assert got == rows(read_view(spark, f"{segment_store}/user_segments"), "userId", "segment", "segment_label")

    def half_up(value):
        return f"CAST(round(CAST({value} AS DECIMAL(38, 9)), 0) AS DOUBLE)"

    profile = con.execute(
        f"""SELECT segment_label, count(*), {half_up("avg(total_plays)")}, {half_up("avg(unique_artists)")},
        {half_up("avg(active_days)")}, {half_up("avg(avg_duration)")},
        CAST(round(CAST(count(*) FILTER (level = 'paid') / count(*) * 100 AS DECIMAL(38, 9)), 1) AS DOUBLE)
        FROM named JOIN user_features USING (userId) GROUP BY segment_label"""
    ).fetchall()
    assert sorted(profile, key=repr) == rows(read_view(spark, f"{segment_store}/segment_profiles"))


def test_summary_follows_from_the_predictions(spark, churn_store):
    predictions = read_view(spark, f"{churn_store}/churn_predictions")
    held = predictions.filter(~churn.in_training(F.col("userId")))
    pairs = held.select("churn_probability", "label").collect()
    high, low = [p for p, label in pairs if label == 1], [p for p, label in pairs if label == 0]
    plain = sum((a > b) + 0.5 * (a == b) for a in high for b in low) / (len(high) * len(low))
    summary = read_view(spark, f"{churn_store}/churn_summary").first()
    assert summary["auc_roc"] == round(plain, 4)
    con = duck(churn_store, "churn_predictions")
    got = con.execute(
        """SELECT count(*), count(*) FILTER (risk_level = 'High'), count(*) FILTER (risk_level = 'Medium'),
        count(*) FILTER (risk_level = 'Low'),
        CAST(round(CAST(avg(churn_probability) * 100 AS DECIMAL(38, 9)), 1) AS DOUBLE),
        CAST(round(CAST(avg(label) * 100 AS DECIMAL(38, 9)), 1) AS DOUBLE) FROM churn_predictions"""
    ).fetchone()
    names = ("total_users", "high_risk", "medium_risk", "low_risk", "avg_churn_pct", "churn_rate_pct")
    assert got == tuple(summary[n] for n in names)


@pytest.mark.parametrize("ties", [2, 50, 100_000])
def test_auc_equals_the_evaluator(spark, tmp_path, ties):
    data = spark.range(4000).select(
        (F.pmod(F.xxhash64("id"), F.lit(ties)) / ties).alias("rawPrediction"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10)) < 2 + F.col("id") / 2000).cast("int").alias("label"),
    )
    data = stored(str(tmp_path / "data"))(data)
    got = ranks.roc_auc(data, "rawPrediction", "label", [], stored(str(tmp_path / "ranks"))).first()
    want = BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0).evaluate(data)
    assert got["positives"] + got["negatives"] == 4000
    assert got["auc"] == pytest.approx(want, abs=1e-9)


def test_auc_per_key_and_without_both_labels(spark, tmp_path):
    data = spark.createDataFrame(
        [("a", 0.1, 0), ("a", 0.2, 1), ("a", 0.2, 0), ("b", 0.5, 1), (None, 1.0, 1), (None, 2.0, 0), ("a", None, 1), ("a", 9.0, None)],
        "k string, s double, label int",
    )
    got = ranks.roc_auc(data, "s", "label", ["k"], stored(str(tmp_path / "a")))
    assert rows(got) == sorted([("a", 1, 2, 0.75), ("b", 1, 0, None), (None, 1, 1, 0.0)], key=repr)
    assert ranks.roc_auc(data.limit(0), "s", "label", [], stored(str(tmp_path / "b"))).first()["auc"] is None


def test_ranks_are_a_running_number(spark, tmp_path):
    data = spark.range(3000).select(F.pmod(F.xxhash64("id"), F.lit(40)).alias("v"), "id")
    got = ranks.ranked(data, [F.desc("v"), F.asc("id")], stored(str(tmp_path / "r")))
    want = sorted(((r.v, r.id) for r in data.collect()), key=lambda r: (-r[0], r[1]))
    assert [(r.v, r.id) for r in got.orderBy("rank").collect()] == want
    assert [r.rank for r in got.orderBy("rank").collect()] == list(range(1, 3001))
    assert "Window" not in plan(got)


def test_given_groups_have_centres(spark):
    users = spark.createDataFrame([("a", 1.0, 5.0), ("a", 3.0, 5.0), ("b", 9.0, 5.0)], "k string, x double, y double")
    inputs, centres = model_tables.group_centres(users, ["x", "y"], "k")
    levels = spark.createDataFrame([], model_tables.LEVELS_DDL)
    got = model_tables.assigned(users.withColumn("level", F.col("k")), inputs, levels, centres)
    assert rows(got, "k", "x", "segment") == [("a", 1.0, 0), ("a", 3.0, 0), ("b", 9.0, 1)]
