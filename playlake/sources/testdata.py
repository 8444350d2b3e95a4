"""The given test tables seen as play events (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from playlake import fixed
from playlake.schema import EVENT_COLUMNS

PAID_BALANCE = 5000
SPEED_START = "2024-01-24"
SESSION_MS = 432_000_000
SESSION_IDS = 997
FIRST_REGISTRATION = 1_640_995_200_000
DAY_MS = 86_400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _listeners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer attributes as listener attributes, one row per customer."""
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    balance = F.col("c_acctbal")
    key = F.col("c_custkey")
    return (
        table(spark, sf_dir, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "c_custkey",
            F.when(balance >= PAID_BALANCE, "paid").otherwise("free").alias("level"),
            F.concat("r_name", F.lit(", "), "n_name").alias("location"),
            F.col("c_mktsegment").alias("userAgent"),
            F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
            F.col("c_name").alias("firstName"),
            F.col("n_name").alias("lastName"),
            (F.lit(FIRST_REGISTRATION) + key * DAY_MS).cast("bigint").alias("registration"),
        )
    )


def _tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")


def _only_plays(column: str) -> Column:
    return F.when(F.col("page") == fixed.PLAY_PAGE, F.col(column))


def _event_page() -> Column:
    kind, k = F.col("event_type"), F.col("k")
    stages = F.array(*[F.lit(s) for s in fixed.FUNNEL_STAGES])
    return (
        F.when(kind == "error", "Error")
        .when(kind == "signup", F.get(stages, (k % 4).cast("int")))
        .otherwise(fixed.PLAY_PAGE)
    )


def map_events(events: DataFrame, tracks: DataFrame, listeners: DataFrame) -> DataFrame:
    """Rows of ``events`` as play events, without replays. Also works on a stream.

    They meet their listeners by ``userId``, which is part of an event's key: the copies of an
    event are then in one task already when they are cleaned in the same plan.
    """
    moment = F.col("ts").cast("timestamp")
    k = F.get_json_object("props", "$.k").cast("bigint")
    seen = events.select(
        "event_id",
        F.col("user_id").cast("int").alias("userId"),
        "value",
        "event_type",
        k.alias("k"),
        moment.alias("moment"),
        F.unix_millis(moment).alias("ts"),
    ).withColumn("page", _event_page())
    session = F.pmod(F.floor(F.col("ts") / SESSION_MS), F.lit(SESSION_IDS))
    plays_song = F.col("page") == fixed.PLAY_PAGE
    return (
        seen.join(tracks, F.col("p_partkey") == F.col("k"))
        .join(listeners.withColumn("userId", F.col("c_custkey").cast("int")), "userId")
        .withColumns(
            {
                "artist": _only_plays("p_brand"),
                "song": _only_plays("p_name"),
                "duration": _only_plays("value"),
                "sessionId": session.cast("int"),
                "itemInSession": F.pmod("event_id", F.lit(50)).cast("int"),
                "status": F.when(F.col("page") == "Error", 404).otherwise(200),
                "method": F.when(plays_song, "PUT").otherwise("GET"),
                "event_ts": F.when(F.col("event_id") % 7 != 0, F.col("moment")),
                "kafka_timestamp": F.timestamp_millis(F.col("ts") + 1000),
                "ingestion_time": F.timestamp_millis(F.col("ts") + 2000),
            }
        )
        .select("event_type", *EVENT_COLUMNS)
    )


def event_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture A without replays."""
    rows = map_events(
        table(spark, sf_dir, "events"), _tracks(spark, sf_dir), _listeners(spark, sf_dir)
    )
    return rows.select(*EVENT_COLUMNS)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture A with replays: every purchase arrives a second time, 5 s later."""
    rows = map_events(
        table(spark, sf_dir, "events"), _tracks(spark, sf_dir), _listeners(spark, sf_dir)
    )
    once, twice = F.array(F.lit(0)), F.array(F.lit(0), F.lit(5000))
    delay = F.explode(F.when(F.col("event_type") == "purchase", twice).otherwise(once))
    late = F.timestamp_millis(F.unix_millis("kafka_timestamp") + F.col("delay"))
    return rows.withColumn("delay", delay).withColumn("kafka_timestamp", late).select(*EVENT_COLUMNS)


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture A without replays, as a stream of the events table.

    All files make one micro-batch: the table is in no time order across
    files, and a watermark between batches would drop rows as late. The
    pattern matches a single file as well as a folder of files.
    """
    stream = (
        spark.readStream.schema(table(spark, sf_dir, "events").schema)
        .option("maxFilesPerTrigger", 2**31 - 1)
        .parquet(f"{sf_dir}/events.parque[t]")
    )
    rows = map_events(stream, _tracks(spark, sf_dir), _listeners(spark, sf_dir))
    return rows.select(*EVENT_COLUMNS)


def speed_start(batch: bool) -> Column:
    """Condition on ``ts`` for the batch or the speed side of the split."""
    start = F.unix_millis(F.lit(SPEED_START).cast("timestamp"))
    return F.col("ts") < start if batch else F.col("ts") >= start


def order_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture B: order lines as play events.

    Listeners join the orders, of which there are fewer than lines. Lines meet them last, by
    session: the copies of an event share one, so cleaning finds them in one task already.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("int").alias("sessionId"),
        "l_partkey",
        "l_linenumber",
        (F.col("l_quantity") * 10).cast("double").alias("duration"),
        F.when(F.col("l_returnflag") == "R", "Error").otherwise(fixed.PLAY_PAGE).alias("page"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("int").alias("sessionId"), "o_custkey", "o_orderdate"
    )
    ordered = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    offset = F.col("l_linenumber") * 3_600_000 + F.pmod("l_partkey", F.lit(3600)) * 1000
    no_text, no_int = F.lit(None).cast("string"), F.lit(None).cast("int")
    heard = lines.join(_tracks(spark, sf_dir), F.col("l_partkey") == F.col("p_partkey")).select(
        "sessionId", "l_linenumber", "duration", "page", offset.alias("offset"), "p_brand", "p_name"
    )
    placed = orders.join(_listeners(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
    return (
        heard.join(placed, "sessionId")
        .withColumn("ts", (ordered + F.col("offset")).cast("bigint"))
        .withColumns(
            {
                "artist": F.col("p_brand"),
                "song": F.col("p_name"),
                "userId": F.col("o_custkey").cast("int"),
                "itemInSession": F.col("l_linenumber").cast("int"),
                "status": no_int,
                "method": no_text,
                "event_ts": F.timestamp_millis("ts"),
                "kafka_timestamp": F.timestamp_millis(F.col("ts") + 1000),
                "ingestion_time": F.timestamp_millis(F.col("ts") + 2000),
            }
        )
        .select(*EVENT_COLUMNS)
    )
