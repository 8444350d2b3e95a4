"""DuckDB SQL for the registered queries, written independently of the Spark code.

Each statement is a chain of CTEs that map the given tables to play events
(FIXTURES.md), followed by a SELECT.
"""

from __future__ import annotations

PAYLOAD = (
    "artist, song, duration, ts, userId, sessionId, page, level, location, userAgent, gender, "
    "firstName, lastName, registration, itemInSession, status, method"
)
EVENT = PAYLOAD + ", event_ts, kafka_timestamp, ingestion_time"

LISTENERS = """
listeners AS (
  SELECT c_custkey,
         CASE WHEN c_acctbal >= 5000 THEN 'paid' ELSE 'free' END AS level,
         r_name || ', ' || n_name AS location,
         c_mktsegment AS userAgent,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         c_name AS firstName,
         n_name AS lastName,
         CAST(1640995200000 + c_custkey * 86400000 AS BIGINT) AS registration
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

PLAIN = f"""{LISTENERS},
seen AS (
  SELECT event_id, user_id, value, event_type, ts AS moment,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CAST(epoch_us(ts) // 1000 AS BIGINT) AS ms
  FROM events
),
paged AS (
  SELECT *, CASE WHEN event_type = 'error' THEN 'Error'
                 WHEN event_type <> 'signup' THEN 'NextSong'
                 WHEN k % 4 = 0 THEN 'Home'
                 WHEN k % 4 = 1 THEN 'Settings'
                 WHEN k % 4 = 2 THEN 'Upgrade'
                 ELSE 'Submit Upgrade' END AS page
  FROM seen
),
typed AS (
  SELECT event_type,
         CASE WHEN page = 'NextSong' THEN p_brand END AS artist,
         CASE WHEN page = 'NextSong' THEN p_name END AS song,
         CASE WHEN page = 'NextSong' THEN value END AS duration,
         ms AS ts,
         CAST(user_id AS INTEGER) AS userId,
         CAST((ms // 432000000) % 997 AS INTEGER) AS sessionId,
         page, level, location, userAgent, gender, firstName, lastName, registration,
         CAST(event_id % 50 AS INTEGER) AS itemInSession,
         CASE WHEN page = 'Error' THEN 404 ELSE 200 END AS status,
         CASE WHEN page = 'NextSong' THEN 'PUT' ELSE 'GET' END AS method,
         CASE WHEN event_id % 7 <> 0 THEN moment END AS event_ts,
         make_timestamp((ms + 1000) * 1000) AS kafka_timestamp,
         make_timestamp((ms + 2000) * 1000) AS ingestion_time
  FROM paged JOIN part ON p_partkey = k JOIN listeners ON c_custkey = user_id
),
plain AS (SELECT {EVENT} FROM typed)"""

RAW = f"""{PLAIN},
raw AS (
  SELECT {EVENT} FROM typed
  UNION ALL
  SELECT {EVENT.replace("kafka_timestamp", "kafka_timestamp + INTERVAL 5 SECOND")}
  FROM typed WHERE event_type = 'purchase'
)"""

SURVIVOR = (
    "kafka_timestamp NULLS FIRST, ingestion_time NULLS FIRST, artist NULLS FIRST, "
    "song NULLS FIRST, duration NULLS FIRST, page NULLS FIRST, level NULLS FIRST, "
    "location NULLS FIRST, userAgent NULLS FIRST, gender NULLS FIRST, firstName NULLS FIRST, "
    "lastName NULLS FIRST, registration NULLS FIRST, itemInSession NULLS FIRST, "
    "status NULLS FIRST, method NULLS FIRST, event_ts NULLS FIRST"
)


def deduplicated(source: str) -> str:
    return f"""SELECT {EVENT} FROM (
    SELECT *, row_number() OVER (PARTITION BY userId, sessionId, ts ORDER BY {SURVIVOR}) AS copy
    FROM {source}) numbered WHERE copy = 1"""


def cleaned(source: str) -> str:
    filled = EVENT.replace("event_ts", "coalesce(event_ts, make_timestamp(ts * 1000)) AS event_ts")
    return f"SELECT {filled} FROM ({deduplicated(source)}) survivors WHERE page = 'NextSong'"


# The page filter comes first, so that a copy on another page cannot win.
CLEAN = f"""{RAW},
raw_plays AS (SELECT {EVENT} FROM raw WHERE page = 'NextSong'),
clean AS ({cleaned("raw_plays")})"""

LAYERS = f"""{CLEAN},
batch AS (SELECT {EVENT} FROM clean WHERE ts < epoch_ms(TIMESTAMP '2024-01-24 00:00:00')),
speed AS (SELECT {EVENT} FROM clean WHERE ts >= epoch_ms(TIMESTAMP '2024-01-24 00:00:00'))"""

ORDERS = f"""{LISTENERS},
lines AS (
  SELECT p_brand AS artist, p_name AS song, CAST(l_quantity * 10 AS DOUBLE) AS duration,
         CAST(epoch_ms(o_orderdate) + l_linenumber * 3600000 + (l_partkey % 3600) * 1000 AS BIGINT) AS ts,
         CAST(o_custkey AS INTEGER) AS userId, CAST(l_orderkey AS INTEGER) AS sessionId,
         CASE WHEN l_returnflag = 'R' THEN 'Error' ELSE 'NextSong' END AS page,
         level, location, userAgent, gender, firstName, lastName, registration,
         CAST(l_linenumber AS INTEGER) AS itemInSession,
         CAST(NULL AS INTEGER) AS status, CAST(NULL AS VARCHAR) AS method
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
       JOIN listeners ON o_custkey = c_custkey
),
order_plays AS (
  SELECT *, make_timestamp(ts * 1000) AS event_ts, make_timestamp((ts + 1000) * 1000) AS kafka_timestamp,
         make_timestamp((ts + 2000) * 1000) AS ingestion_time
  FROM lines
)"""

ORDER_CLEAN = f"""{ORDERS},
order_songs AS (SELECT {EVENT} FROM order_plays WHERE page = 'NextSong'),
clean AS ({cleaned("order_songs")})"""


def rnd(value: str, places: int) -> str:
    """Round half up on the decimal value, free of the last bits of a double."""
    return f"CAST(round(CAST({value} AS DECIMAL(38, 9)), {places}) AS DOUBLE)"


AVG_SECONDS = f"{rnd('avg(duration)', 1)} AS avg_duration_sec"
HOURS = f"{rnd('sum(duration) / 3600', 2)} AS total_hours_played"
LISTENED = "count(*) AS play_count, count(DISTINCT userId) AS unique_listeners"

TOP_SONGS = f"SELECT song, artist, {LISTENED}, {AVG_SECONDS} FROM {{0}} GROUP BY song, artist"
TOP_ARTISTS = (
    f"SELECT artist, {LISTENED}, count(DISTINCT song) AS unique_songs FROM {{0}} GROUP BY artist"
)
BY_HOUR = (
    "SELECT CAST(hour(event_ts) AS INTEGER) AS hour_of_day, count(*) AS play_count, "
    f"count(DISTINCT userId) AS active_users, {AVG_SECONDS} FROM {{0}} GROUP BY 1"
)
LEVELS = (
    "SELECT level, count(*) AS play_count, count(DISTINCT userId) AS user_count, "
    f"{AVG_SECONDS} FROM {{0}} GROUP BY level"
)
ACTIVE = (
    "SELECT CAST(date_trunc('hour', {1}) AS TIMESTAMP) AS hour_bucket, "
    "count(DISTINCT userId) AS active_users, count(*) AS total_plays FROM {0} GROUP BY 1"
)
OVERVIEW = f"""SELECT count(*) AS total_plays, count(DISTINCT userId) AS unique_users,
  count(DISTINCT artist) AS unique_artists, count(DISTINCT song) AS unique_songs,
  count(DISTINCT sessionId) AS total_sessions, {AVG_SECONDS},
  {rnd("min(duration)", 1)} AS min_duration_sec, {rnd("max(duration)", 1)} AS max_duration_sec
  FROM {{0}}"""
SESSIONS = f"""SELECT userId, sessionId, count(*) AS songs_per_session,
  {rnd("sum(duration) / 60", 1)} AS session_minutes,
  min(event_ts) AS session_start, max(event_ts) AS session_end,
  {rnd("(epoch_us(max(event_ts)) // 1000000 - epoch_us(min(event_ts)) // 1000000) / 60", 1)}
    AS session_duration_min
  FROM {{0}} GROUP BY userId, sessionId"""
USER_SHARE = (
    "count(DISTINCT userId) / (SELECT count(*) FROM (SELECT DISTINCT userId, level FROM {0})) * 100"
)
LEVEL_RATIO = f"""SELECT level, count(*) AS play_count, count(DISTINCT userId) AS user_count,
  {AVG_SECONDS}, {HOURS},
  {rnd(USER_SHARE, 1)} AS user_pct
  FROM {{0}} GROUP BY level"""
SESSION_DIST = f"""SELECT songs_per_session, count(*) AS session_count,
  {rnd("avg(session_minutes)", 1)} AS avg_session_minutes
  FROM ({SESSIONS}) s GROUP BY songs_per_session"""
# Join form of retention: every play beside its user's first day.
RETENTION = """SELECT play_date, user_type, count(DISTINCT userId) AS user_count, count(*) AS play_count
  FROM (SELECT userId, CAST(event_ts AS DATE) AS play_date,
               CASE WHEN CAST(event_ts AS DATE) = first_day THEN 'new' ELSE 'returning' END AS user_type
        FROM {0} JOIN (SELECT userId, min(CAST(event_ts AS DATE)) AS first_day FROM {0} GROUP BY userId) f
        USING (userId)) typed
  GROUP BY play_date, user_type"""
HABITS = f"""count(*) AS total_plays, count(DISTINCT artist) AS unique_artists,
  count(DISTINCT song) AS unique_songs, count(DISTINCT sessionId) AS total_sessions,
  {rnd("avg(duration)", 1)} AS avg_duration, count(DISTINCT CAST(event_ts AS DATE)) AS active_days"""
USER_FEATURES = f"""SELECT userId, {HABITS}, arg_max(level, event_ts) AS level FROM clean GROUP BY userId"""

CUTOFF = """,
bounds AS (
  SELECT make_timestamp(CAST(epoch_us(min(event_ts))
         + round((epoch_us(max(event_ts)) - epoch_us(min(event_ts))) * 0.8) AS BIGINT)) AS cutoff
  FROM clean
),
early AS (SELECT clean.* FROM clean, bounds WHERE event_ts <= cutoff),
late AS (SELECT clean.* FROM clean, bounds WHERE event_ts > cutoff)"""
FEATURES = f"""{CUTOFF},
features AS (
  SELECT userId, {HABITS},
         CAST(date_diff('day', min(event_ts), max(event_ts)) AS INTEGER) AS days_span,
         arg_max(level, event_ts) AS level,
         {rnd("count(*) / (date_diff('day', min(event_ts), max(event_ts)) + 1)", 2)} AS plays_per_day
  FROM early GROUP BY userId
),
bars AS (
  SELECT quantile_disc(plays_per_day, 0.25) AS daily, quantile_disc(active_days, 0.25) AS days
  FROM features
)"""
# Set form of the time labels: early users who are not, or are, among the late ones.
TIME_LABELS = """,
time_labels AS (
  SELECT DISTINCT userId, 1 AS label FROM early
  WHERE userId NOT IN (SELECT userId FROM late WHERE userId IS NOT NULL)
  UNION ALL
  SELECT DISTINCT userId, 0 AS label FROM early WHERE userId IN (SELECT userId FROM late)
)"""
DATASET = f"""{FEATURES}{TIME_LABELS},
rate AS (SELECT avg(label) AS rate FROM time_labels),
dataset AS (
  SELECT features.*,
         CAST(CASE WHEN rate >= 0.05 THEN time_labels.label
              WHEN plays_per_day <= daily AND active_days <= days THEN 1 ELSE 0 END AS INTEGER) AS label,
         CASE WHEN rate >= 0.05 THEN 'time' ELSE 'engagement' END AS label_kind
  FROM features JOIN time_labels USING (userId), rate, bars
)"""

SCORED = (
    "userId, label, total_plays, unique_artists, active_days, plays_per_day, avg_duration, level"
)

MERGED = f"""{LAYERS},
merged AS (
  SELECT {PAYLOAD}, 'batch' AS data_source FROM batch
  UNION ALL
  SELECT {PAYLOAD}, 'stream' AS data_source FROM speed
)"""
SPEED_SONGS = (
    "SELECT song, artist, count(*) AS stream_plays, count(DISTINCT userId) AS stream_listeners "
    "FROM speed GROUP BY song, artist"
)
SPEED_ARTISTS = (
    "SELECT artist, count(*) AS stream_plays, count(DISTINCT userId) AS stream_listeners "
    "FROM speed GROUP BY artist"
)
SUMMARY = """SELECT (SELECT count(*) FROM speed) AS stream_total,
  (SELECT count(*) FROM batch) AS batch_total,
  (SELECT max(ingestion_time) FROM speed) AS latest"""
# Spark prints a timestamp without trailing zeros of the fraction.
LATEST_TEXT = "regexp_replace(strftime(latest, '%Y-%m-%d %H:%M:%S.%f'), '\\.?0+$', '')"
WINDOWS = f"""SELECT time_bucket(INTERVAL 1 MINUTE, event_ts) AS window_start,
  time_bucket(INTERVAL 1 MINUTE, event_ts) + INTERVAL 1 MINUTE AS window_end,
  artist, song, count(*) AS play_count, {AVG_SECONDS}
  FROM {{0}} GROUP BY 1, 2, artist, song"""
PERIODS = (
    "SELECT CAST(date_trunc('{0}', event_ts) AS TIMESTAMP) AS period, count(DISTINCT userId) AS active_users, "
    "count(*) AS total_plays FROM clean GROUP BY 1"
)
# Area under ROC by average ranks, per number of the training table.
FEATURE_AUC = f"""SELECT feature, positives, negatives, {rnd(
    "(pos_ranks - positives * (positives + 1) / 2) / (positives::DOUBLE * negatives)", 9)} AS auc
  FROM (SELECT feature, count(*) FILTER (label = 1) AS positives, count(*) FILTER (label <> 1) AS negatives,
               sum(mean_rank) FILTER (label = 1) AS pos_ranks
        FROM (SELECT feature, label, rank() OVER (PARTITION BY feature ORDER BY value)
                     + (count(*) OVER (PARTITION BY feature, value) - 1) / 2 AS mean_rank
              FROM (UNPIVOT (SELECT label, total_plays::DOUBLE AS total_plays, unique_artists::DOUBLE AS unique_artists,
                                    unique_songs::DOUBLE AS unique_songs, total_sessions::DOUBLE AS total_sessions,
                                    coalesce(avg_duration, 0)::DOUBLE AS avg_duration, active_days::DOUBLE AS active_days,
                                    days_span::DOUBLE AS days_span, plays_per_day::DOUBLE AS plays_per_day FROM dataset)
                    ON total_plays, unique_artists, unique_songs, total_sessions, avg_duration, active_days,
                       days_span, plays_per_day INTO NAME feature VALUE value) v) r
        GROUP BY feature) counted"""
RULE_SCORES = """SELECT userId, churn_probability,
  CASE WHEN churn_probability >= 0.7 THEN 'High' WHEN churn_probability >= 0.4 THEN 'Medium' ELSE 'Low' END AS risk_level
  FROM (SELECT userId, (CASE WHEN plays_per_day <= 0.03 THEN 0.75::DOUBLE WHEN active_days <= 8 THEN 0.4 ELSE 0.125 END
    + CASE WHEN level <> 'free' THEN 0.2::DOUBLE WHEN active_days <= 5 THEN 0.9 ELSE 0.35 END) / 2 AS churn_probability
    FROM features WHERE userId IS NOT NULL) scored"""
NEAREST_PLAN = f"""SELECT userId, total_plays, active_days, avg_duration, level,
  CASE WHEN free <= paid THEN 0 ELSE 1 END::INTEGER AS segment FROM (
    SELECT users.*,
      ((users.total_plays - f.plays) / s.plays) ** 2 + ((users.active_days - f.days) / s.days) ** 2
        + ((avg_duration - f.seconds) / s.seconds) ** 2 AS free,
      ((users.total_plays - p.plays) / s.plays) ** 2 + ((users.active_days - p.days) / s.days) ** 2
        + ((avg_duration - p.seconds) / s.seconds) ** 2 AS paid
    FROM ({USER_FEATURES}) users,
      (SELECT stddev_samp(total_plays) AS plays, stddev_samp(active_days) AS days, stddev_samp(avg_duration) AS seconds
       FROM ({USER_FEATURES}) u) s,
      (SELECT avg(total_plays) AS plays, avg(active_days) AS days, avg(avg_duration) AS seconds
       FROM ({USER_FEATURES}) u WHERE level = 'free') f,
      (SELECT avg(total_plays) AS plays, avg(active_days) AS days, avg(avg_duration) AS seconds
       FROM ({USER_FEATURES}) u WHERE level = 'paid') p) distances"""
# What the stream job sees: event time from ts, complete plays only.
STREAMED = f"""{PLAIN},
landed AS (
  SELECT {PAYLOAD}, make_timestamp(ts * 1000) AS event_ts, kafka_timestamp FROM plain
),
streamed AS (
  SELECT * FROM landed WHERE page = 'NextSong' AND userId IS NOT NULL
    AND artist IS NOT NULL AND song IS NOT NULL
)"""


def _with(chain: str, select: str) -> str:
    return f"WITH {chain.strip()}\n{select}"


def _clean(select: str) -> str:
    return _with(CLEAN, select.replace("{0}", "clean"))


def _order(select: str) -> str:
    return _with(ORDER_CLEAN, select.replace("{0}", "clean"))


def _top(select: str, rows: int, *ties: str) -> str:
    return f"{select} ORDER BY play_count DESC, {', '.join(ties)} LIMIT {rows}"


def statements() -> dict[str, str]:
    songs = TOP_SONGS.replace("{0}", "batch")
    artists = TOP_ARTISTS.replace("{0}", "batch")
    active_batch = ACTIVE.format("batch", "event_ts")
    active_speed = ACTIVE.format("speed", "ingestion_time")
    raw_plays = "(SELECT * FROM raw WHERE page = 'NextSong')"
    found = {
        "scan_events": _with(RAW, f"SELECT {EVENT} FROM raw"),
        "json_roundtrip": _clean(f"SELECT {EVENT} FROM clean"),
        "parse_json_events": _with(PLAIN, f"SELECT {PAYLOAD}, kafka_timestamp FROM plain"),
        "filter_page": _with(RAW, f"SELECT {EVENT} FROM raw WHERE page = 'NextSong'"),
        "dedup_events": _with(RAW, deduplicated("raw")),
        "clean_events": _clean(f"SELECT {EVENT} FROM clean"),
        "clean_counts": _clean("""SELECT (SELECT count(*) FROM raw) AS raw_events,
            (SELECT count(*) FROM clean) AS clean_events,
            (SELECT count(*) FROM raw) - (SELECT count(*) FROM clean) AS dropped_events"""),
        "drop_incomplete": _with(RAW, f"""SELECT {EVENT} FROM raw
            WHERE userId IS NOT NULL AND artist IS NOT NULL AND song IS NOT NULL"""),
        "time_bounds": _clean(
            "SELECT min(event_ts) AS first_event, max(event_ts) AS last_event FROM clean"
        ),
        "time_split": _with(
            CLEAN + CUTOFF,
            """SELECT CASE WHEN event_ts <= cutoff THEN 'early' ELSE 'late' END AS period,
               count(*) AS events, min(event_ts) AS first_event, max(event_ts) AS last_event
               FROM clean, bounds GROUP BY 1""",
        ),
        "overview": _clean(OVERVIEW),
        "top_songs": _clean(TOP_SONGS),
        "top_artists": _clean(TOP_ARTISTS),
        "top_locations": _clean("""SELECT trim(split_part(location, ',', -1)) AS state,
            count(*) AS play_count, count(DISTINCT userId) AS unique_users
            FROM clean GROUP BY 1 ORDER BY play_count DESC, state LIMIT 15"""),
        "plays_by_hour_users": _clean("""SELECT CAST(hour(event_ts) AS INTEGER) AS hour_of_day,
            count(*) AS play_count, count(DISTINCT userId) AS active_users FROM clean GROUP BY 1"""),
        "plays_by_hour": _clean(BY_HOUR),
        "level_stats": _clean(LEVELS),
        "page_dist": _with(RAW, """SELECT page, count(*) AS event_count,
            count(DISTINCT userId) AS unique_users FROM raw GROUP BY page"""),
        "gender_stats": _clean(f"""SELECT gender, count(*) AS play_count,
            count(DISTINCT userId) AS user_count, {AVG_SECONDS} FROM clean GROUP BY gender"""),
        "top10_songs": _clean(_top(TOP_SONGS, 10, "song", "artist")),
        "top10_artists": _clean(_top(TOP_ARTISTS, 10, "artist")),
        "level_ratio": _clean(LEVEL_RATIO),
        "session_stats": _clean(SESSIONS),
        "session_dist": _clean(SESSION_DIST),
        "first_play": _clean(
            "SELECT userId, min(CAST(event_ts AS DATE)) AS first_play_date FROM clean GROUP BY userId"
        ),
        "retention": _clean(RETENTION),
        "active_users_ts": _clean(ACTIVE.format("clean", "event_ts")),
        "distinct_user_levels": _clean("SELECT DISTINCT userId, level FROM clean"),
        "listener_tracks": _clean(f"""SELECT userId, level, gender, location, artist, song,
            count(*) AS plays, {rnd("sum(duration)", 6)} AS seconds, count(duration) AS timed,
            max(event_ts) AS last_seen FROM clean GROUP BY ALL"""),
        "listener_hours": _clean(f"""SELECT userId, CAST(date_trunc('hour', event_ts) AS TIMESTAMP)
            AS hour_bucket, count(*) AS plays, {rnd("sum(duration)", 6)} AS seconds,
            count(duration) AS timed FROM clean GROUP BY ALL"""),
        "orders_overview": _order(OVERVIEW),
        "orders_top_songs": _order(TOP_SONGS),
        "orders_retention": _order(RETENTION),
        "orders_session_stats": _order(SESSIONS),
        "orders_user_features": _order(USER_FEATURES),
        "user_features": _clean(USER_FEATURES),
        "user_features_of_tables": _clean(USER_FEATURES),
        "profile_by_level": _clean(f"""SELECT level, count(*) AS user_count,
            {rnd("avg(total_plays)", 0)} AS avg_plays, {rnd("avg(unique_artists)", 0)} AS avg_artists,
            {rnd("avg(active_days)", 0)} AS avg_active_days,
            {rnd("avg(avg_duration)", 0)} AS avg_duration_sec,
            {rnd("count(*) FILTER (level = 'paid') / count(*) * 100", 1)} AS paid_pct
            FROM ({USER_FEATURES}) u GROUP BY level"""),
        "churn_features": _with(CLEAN + FEATURES, "SELECT * FROM features"),
        "churned_users": _with(
            ORDER_CLEAN + CUTOFF, "SELECT userId FROM early EXCEPT SELECT userId FROM late"
        ),
        "retained_users": _with(
            ORDER_CLEAN + CUTOFF, "SELECT userId FROM early INTERSECT SELECT userId FROM late"
        ),
        "churn_labels_time": _with(ORDER_CLEAN + CUTOFF + TIME_LABELS, "SELECT * FROM time_labels"),
        "engagement_quartiles": _with(
            CLEAN + FEATURES, "SELECT daily AS plays_per_day_q25, days AS active_days_q25 FROM bars"
        ),
        "churn_labels_engagement": _with(
            CLEAN + FEATURES,
            """SELECT userId, CAST(plays_per_day <= daily AND active_days <= days AS INTEGER) AS label
               FROM features, bars""",
        ),
        "churn_dataset": _with(CLEAN + DATASET, "SELECT * FROM dataset"),
        "churn_dataset_orders": _with(ORDER_CLEAN + DATASET, "SELECT * FROM dataset"),
        "churn_rate": _with(CLEAN + DATASET, "SELECT avg(label) AS churn_rate FROM dataset"),
        "churn_rate_orders": _with(
            ORDER_CLEAN + DATASET, "SELECT avg(label) AS churn_rate FROM dataset"
        ),
        "risk_band": _clean(f"""SELECT userId, probability, CASE WHEN probability >= 0.7 THEN 'High'
            WHEN probability >= 0.4 THEN 'Medium' ELSE 'Low' END AS risk_level
            FROM (SELECT userId, {rnd("avg(duration) / 100", 2)} AS probability
                  FROM clean GROUP BY userId) p"""),
        "segmented_users": _clean(USER_FEATURES),
        "scored_users": _with(CLEAN + DATASET, f"SELECT {SCORED} FROM dataset"),
        "scored_users_orders": _with(ORDER_CLEAN + DATASET, f"SELECT {SCORED} FROM dataset"),
        "catalog_play_events": _with(LAYERS, f"SELECT {EVENT} FROM batch"),
        "catalog_streaming_events": _with(LAYERS, f"SELECT {EVENT} FROM speed"),
        "sql_top_songs": _with(LAYERS, _top(songs, 100, "song", "artist")),
        "sql_top_artists": _with(LAYERS, _top(artists, 100, "artist")),
        "sql_plays_by_hour": _with(LAYERS, BY_HOUR.replace("{0}", "batch")),
        "sql_level_stats": _with(LAYERS, f"""SELECT level, count(*) AS play_count,
            count(DISTINCT userId) AS user_count, {AVG_SECONDS}, {HOURS} FROM batch GROUP BY level"""),
        "sql_text_top_songs": _clean(_top(TOP_SONGS, 100, "song", "artist")),
        "sql_text_top_artists": _clean(_top(TOP_ARTISTS, 100, "artist")),
        "sql_text_plays_by_hour": _clean(BY_HOUR),
        "sql_text_level_stats": _clean(f"""SELECT level, count(*) AS play_count,
            count(DISTINCT userId) AS user_count, {AVG_SECONDS}, {HOURS} FROM clean GROUP BY level"""),
        "merged_events": _with(MERGED, "SELECT * FROM merged"),
        "merged_songs_by_source": _with(
            MERGED,
            _top(
                f"SELECT song, artist, data_source, {LISTENED} FROM merged GROUP BY ALL",
                200, "song", "artist", "data_source",
            ),
        ),
        "merged_artists_by_source": _with(
            MERGED,
            _top(
                f"SELECT artist, data_source, {LISTENED} FROM merged GROUP BY ALL",
                200, "artist", "data_source",
            ),
        ),
        "records_by_source": _with(
            MERGED, "SELECT data_source, count(*) AS records FROM merged GROUP BY data_source"
        ),
        "sql_top_songs_script": _with(
            RAW,
            _top(
                f"SELECT song, artist, count(*) AS play_count, {AVG_SECONDS} "
                f"FROM {raw_plays} p GROUP BY song, artist",
                100, "song", "artist",
            ),
        ),
        "sql_top_artists_script": _with(
            RAW, _top(f"SELECT artist, {LISTENED} FROM {raw_plays} p GROUP BY artist", 100, "artist")
        ),
        "sql_plays_by_hour_ts": _with(RAW, f"""SELECT
            CAST(hour(make_timestamp(ts * 1000)) AS INTEGER) AS hour_of_day, count(*) AS play_count,
            count(DISTINCT userId) AS active_users FROM {raw_plays} p GROUP BY 1"""),
        "sql_level_stats_script": _with(RAW, LEVELS.replace("{0}", f"{raw_plays} p")),
        "merged_events_unfiltered": _with(LAYERS, f"""
            SELECT {PAYLOAD}, 'batch' AS data_source FROM plain
            WHERE ts < epoch_ms(TIMESTAMP '2024-01-24 00:00:00')
            UNION ALL SELECT {PAYLOAD}, 'stream' AS data_source FROM speed"""),
        "speed_top_songs": _with(LAYERS, SPEED_SONGS),
        "speed_top_artists": _with(LAYERS, SPEED_ARTISTS),
        "speed_active_ts": _with(LAYERS, active_speed),
        "speed_level": _with(LAYERS, """SELECT level, count(*) AS stream_plays,
            count(DISTINCT userId) AS stream_users FROM speed GROUP BY level"""),
        "speed_summary": _with(LAYERS, f"""SELECT stream_total, batch_total,
            coalesce({LATEST_TEXT}, 'N/A') AS latest_ingestion FROM ({SUMMARY}) s"""),
        "merged_top_songs": _with(LAYERS, f"""SELECT song, artist,
            coalesce(play_count, 0) AS play_count, coalesce(unique_listeners, 0) AS unique_listeners,
            avg_duration_sec, coalesce(stream_plays, 0) AS stream_plays,
            coalesce(stream_listeners, 0) AS stream_listeners,
            coalesce(play_count, 0) + coalesce(stream_plays, 0) AS merged_plays
            FROM ({songs}) b FULL JOIN ({SPEED_SONGS}) s USING (song, artist)"""),
        "merged_top_artists": _with(LAYERS, f"""SELECT artist,
            coalesce(play_count, 0) AS play_count, coalesce(unique_listeners, 0) AS unique_listeners,
            unique_songs, coalesce(stream_plays, 0) AS stream_plays,
            coalesce(stream_listeners, 0) AS stream_listeners,
            coalesce(play_count, 0) + coalesce(stream_plays, 0) AS merged_plays
            FROM ({artists}) b FULL JOIN ({SPEED_ARTISTS}) s USING (artist)"""),
        "merged_active_ts": _with(LAYERS, f"""SELECT hour_bucket,
            CAST(sum(active_users) AS BIGINT) AS active_users,
            CAST(sum(total_plays) AS BIGINT) AS total_plays
            FROM ({active_batch} UNION ALL {active_speed}) h GROUP BY hour_bucket"""),
        "merged_active_users_exact": _clean(ACTIVE.format("clean", "event_ts")),
        "merged_listeners_exact": _clean(
            "SELECT song, artist, count(DISTINCT userId) AS unique_listeners, count(*) AS merged_plays "
            "FROM clean GROUP BY song, artist"
        ),
        "active_users_per_day": _clean(PERIODS.format("day")),
        "active_users_per_month": _clean(PERIODS.format("month")),
        "stickiness": _clean(f"""SELECT month, users, active_days,
            {rnd("user_days / active_days", 2)} AS mean_daily_users,
            {rnd("user_days / active_days * 100 / users", 2)} AS stickiness_pct
            FROM (SELECT CAST(date_trunc('month', event_ts) AS TIMESTAMP) AS month, count(DISTINCT userId) AS users
                  FROM clean GROUP BY 1) m
            JOIN (SELECT CAST(date_trunc('month', period) AS TIMESTAMP) AS month, sum(active_users) AS user_days,
                  count(*) AS active_days FROM ({PERIODS.format("day")}) d GROUP BY 1) days USING (month)"""),
        "churn_feature_auc": _with(ORDER_CLEAN + DATASET, FEATURE_AUC),
        "rule_forest_scores": _with(ORDER_CLEAN + FEATURES, RULE_SCORES),
        "nearest_plan": _order(NEAREST_PLAN),
        "stream_append": _with(STREAMED, "SELECT * FROM streamed"),
        "stream_append_raw": _with(STREAMED, "SELECT * FROM landed"),
        "stream_window_top_songs": _with(STREAMED, f"""SELECT w.* FROM ({WINDOWS.replace("{0}", "streamed")}) w
            WHERE window_end <= (SELECT max(event_ts) FROM streamed) - INTERVAL 2 MINUTE"""),
        "window_top_songs": _clean(WINDOWS),
        "stream_level_users": _with(
            STREAMED,
            "SELECT level, count(DISTINCT userId) AS active_users, count(*) AS plays FROM streamed GROUP BY level",
        ),
        "stream_level_plays": _with(
            STREAMED, "SELECT level, count(*) AS plays FROM streamed GROUP BY level"
        ),
        "count_by_artist_key": _with(PLAIN, """SELECT artist AS key, count(*) AS n FROM plain
            WHERE artist <> '' GROUP BY artist"""),
        "count_by_hour_key": _with(PLAIN, """SELECT lpad(CAST((ts // 3600000) % 24 AS VARCHAR), 2, '0')
            AS key, count(*) AS n FROM plain WHERE ts <> 0 GROUP BY 1"""),
        "count_by_user_key": _with(PLAIN, """SELECT CAST(userId AS VARCHAR) AS key, count(*) AS n
            FROM plain WHERE userId IS NOT NULL GROUP BY 1"""),
        "bench_top_artists": _with(
            ORDERS, "SELECT artist, count(*) AS count FROM order_plays GROUP BY artist"
        ),
        "bench_plays_by_hour": _with(ORDERS, """SELECT CAST(hour(make_timestamp(ts * 1000)) AS INTEGER)
            AS hour, count(*) AS count FROM order_plays GROUP BY 1"""),
        "bench_user_sessions": _with(
            ORDERS, "SELECT userId, count(*) AS count FROM order_plays GROUP BY userId"
        ),
        "kpi_summary": _with(LAYERS, f"""SELECT batch_total + stream_total AS total_streams,
            (SELECT count(DISTINCT userId) FROM batch) AS active_users,
            (SELECT {rnd("count(DISTINCT userId) FILTER (level = 'paid') / count(DISTINCT userId) * 100", 1)}
             FROM batch) AS premium_pct,
            strftime(latest, '%Y-%m-%d %H:%M') AS last_sync FROM ({SUMMARY}) s"""),
        "funnel": _with(RAW, """SELECT step, stage, count(page) AS event_count
            FROM (VALUES (1, 'Home'), (2, 'Settings'), (3, 'Upgrade'), (4, 'Submit Upgrade'))
                 stages(step, stage) LEFT JOIN raw ON page = stage GROUP BY step, stage"""),
        "live_feed": _with(LAYERS, """SELECT artist, song, userId, level, location FROM speed
            ORDER BY ingestion_time DESC, ts DESC, userId DESC, sessionId DESC LIMIT 10"""),
        "hourly_by_layer": _with(LAYERS, f"""SELECT *, 'batch' AS layer FROM ({active_batch}) b
            UNION ALL SELECT *, 'speed' AS layer FROM ({active_speed}) s"""),
        "top_artist": _clean(_top(TOP_ARTISTS, 1, "artist")),
    }
    stored = {
        "overview": OVERVIEW,
        "top_songs": TOP_SONGS,
        "top_artists": TOP_ARTISTS,
        "plays_by_hour": BY_HOUR,
        "level_ratio": LEVEL_RATIO,
        "session_dist": SESSION_DIST,
        "retention": RETENTION,
    }
    for name, select in stored.items():
        found[f"stored_{name}"] = _with(LAYERS, select.replace("{0}", "batch"))
    found["bucketed_churn_dataset"] = found["churn_dataset_orders"]
    found["bucketed_merged_songs"] = found["merged_top_songs"]
    # At this scale the sketches hold every user's value, so the bars are exact.
    quartiles = "SELECT daily AS plays_per_day_q25, CAST(days AS BIGINT) AS active_days_q25 FROM bars"
    found["sketched_quartiles"] = _with(ORDER_CLEAN + FEATURES, quartiles)
    found["sketched_engagement_labels"] = _with(
        ORDER_CLEAN + FEATURES,
        """SELECT userId, CAST(plays_per_day <= daily AND active_days <= days AS INTEGER) AS label
           FROM features, bars WHERE userId IS NOT NULL""",
    )
    for name in ("top_songs", "plays_by_hour", "first_play", "retention"):
        found[f"by_day_{name}"] = found[name]
    found["by_day_clean"] = found["clean_events"]
    found["served_top10_songs"] = _with(LAYERS, _top(songs, 10, "song", "artist"))
    for name in ("speed_summary", "merged_top_songs", "merged_top_artists", "merged_active_ts"):
        found[f"served_{name}"] = found[name]
    found["served_merged_active_users"] = _with(LAYERS, """SELECT hour_bucket,
        count(DISTINCT userId) AS active_users, count(*) AS total_plays
        FROM (SELECT date_trunc('hour', event_ts) AS hour_bucket, userId FROM batch UNION ALL
              SELECT date_trunc('hour', ingestion_time), userId FROM speed) h GROUP BY hour_bucket""")
    found["served_merged_listeners"] = _with(LAYERS, """SELECT song, artist,
        count(DISTINCT userId) AS unique_listeners, count(*) AS merged_plays FROM clean GROUP BY song, artist""")
    return found
