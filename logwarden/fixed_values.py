"""Schemas and the values that decide results.

Everything in this module is a fixed value: tokens, weights, thresholds and
column lists that results depend on. Logic lives elsewhere.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: columns -------------------------------------------------

LOG_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("ip_address", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("response_bytes", T.LongType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("referrer", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("attack_type", T.StringType()),
])
REQUIRED_COLUMNS = LOG_SCHEMA.fieldNames()
NON_NULL_COLUMNS = ["timestamp", "ip_address", "url", "status_code"]

FEATURE_COLUMNS = [
    "requests_per_minute",
    "post_login_rate",
    "error_rate_5min",
    "unique_urls_per_hour",
    "avg_response_bytes_ratio",
    "request_interval_variance",
    "is_offhours",
    "sequential_url_score",
    "suspicious_param_rate",
    "new_session_flag",
]
ZSCORE_FEATURES = [
    "requests_per_minute",
    "post_login_rate",
    "error_rate_5min",
    "avg_response_bytes_ratio",
    "suspicious_param_rate",
]
SUMMARY_FEATURES = [
    "requests_per_minute",
    "error_rate_5min",
    "avg_response_bytes_ratio",
    "suspicious_param_rate",
]
STREAM_ALERT_COLUMNS = [
    "timestamp", "ip_address", "url", "status_code", "response_bytes",
    "is_bot", "has_suspicious_params", "zscore_flag", "threat_score",
    "severity", "attack_type",
]

# --- Fixed values: tokens --------------------------------------------------

BOT_TOKENS = ["python-requests", "curl", "wget", "scrapy", "bot", "crawler"]
BOT_PREFIXES = ["go-http", "scrapy"]
SCANNER_TOKENS = ["sqlmap", "nmap", "zgrab"]
# Tested in this order; the first family with a matching token wins.
BROWSER_TOKENS = [
    ("Edge", ["edg/"]),
    ("Opera", ["opr/", "opera"]),
    ("Chrome", ["chrome/"]),
    ("Firefox", ["firefox/"]),
    ("Safari", ["safari/"]),
]
SUSPICIOUS_TOKENS = [
    "1=1", "or 1=1", "union select", "drop table", "information_schema",
    "xp_cmdshell", "sleep(", "--", "';", "' or '", "/*", "*/", "@@version",
    "benchmark(", "load_file(", "0x",
]
STREAM_SUSPICIOUS_TOKENS = [
    "1=1", "or 1=1", "union select", "drop table", "information_schema",
    "xp_cmdshell", "sleep(", "--", "';", "' or '",
]

# --- Fixed values: windows, thresholds and weights -------------------------

TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{1,6})?$"
MINUTE_SECONDS = 60
FIVE_MINUTES_SECONDS = 300
HALF_HOUR_SECONDS = 1800
HOUR_SECONDS = 3600
DAY_SECONDS = 86400
OFFHOURS_BEFORE = 7
OFFHOURS_AFTER = 22

CONTAMINATION = 0.1
ZSCORE_LIMIT = 3.0
ALERT_THRESHOLD = 25
# Severity of a score is the first label whose threshold it reaches.
SEVERITY_THRESHOLDS = [("CRITICAL", 75), ("HIGH", 50), ("MEDIUM", 25)]
SEVERITY_FLOOR = "NORMAL"
NO_SINGLE_REASON = "ml_pattern"
NORMAL_LABEL = "normal"

BATCH_WEIGHTS = {
    "isolation_forest_flag": 35,
    "lof_flag": 35,
    "zscore_flag": 20,
    "is_bot": 5,
    "mostly_suspicious": 5,
}
MOSTLY_SUSPICIOUS_RATE = 0.5
STREAM_WEIGHTS = {"is_bot": 25, "has_suspicious_params": 25, "zscore_flag": 30}

BASELINE_BATCHES = 10
TRIGGER_INTERVAL = "30 seconds"

FOREST_TREES = 100
FOREST_SAMPLE_ROWS = 256
FOREST_SEED = 42
# Digits of the standard scores that the models see, and of the scores they give.
MODEL_PLACES = 6
SCORE_PLACES = 9
LOF_NEIGHBORS = 20
LOF_DENSITY_FLOOR = 1e-10
SCATTER_SAMPLE_ROWS = 6000
SCATTER_SAMPLE_SEED = 1
ALERT_QUEUE_ROWS = 500

# Our own wording.
CRITICAL_MESSAGE = "Act now: %d critical alerts by %d addresses, worst %s with %d points"
QUIET_MESSAGE = "Nothing critical, high: %d, medium: %d"
