"""Constants that results must agree on."""

# Pages.
PLAY_PAGE = "NextSong"
FUNNEL_STAGES = ["Home", "Settings", "Upgrade", "Submit Upgrade"]

# Report lengths.
TOP_VIEW = 10
TOP_LOCATIONS = 15
TOP_SQL = 100
TOP_SQL_MERGED = 200
AT_RISK_ROWS = 4
LIVE_ROWS = 10

# Segmentation.
SEGMENTS = 4
SEED = 42
SEGMENT_LABELS = ["Power Users", "Regular Listeners", "Casual Listeners", "At-Risk Users"]

# Churn.
EARLY_SHARE = 0.8
LOW_CHURN_RATE = 0.05
QUARTILE = 0.25
TRAIN_PERCENT = 80
FOREST_TREES = 100
FOREST_DEPTH = 6
HIGH_RISK = 0.7
MEDIUM_RISK = 0.4

# Stream.
TOPIC = "music-events"
WATERMARK = "2 minutes"
WINDOW = "1 minute"
SINK_TRIGGER = "2 seconds"
SUMMARY_TRIGGER = "10 seconds"

# Names of the stored views that are published.
PUBLISHED_VIEWS = [
    "overview",
    "top10_songs",
    "top10_artists",
    "top_songs",
    "top_artists",
    "plays_by_hour",
    "level_ratio",
    "level_stats",
    "session_dist",
    "session_stats",
    "retention",
    "active_users_ts",
    "gender_stats",
    "page_dist",
    "top_locations",
    "segment_profiles",
    "user_segments",
    "churn_predictions",
    "churn_summary",
]
MODEL_VIEWS = ["segment_profiles", "user_segments", "churn_predictions", "churn_summary"]
