"""Access logs derived from the generic ``events`` table.

``events(event_id, ts, user_id, event_type, value, props)`` has no web requests, so
each event is mapped to one. Two clocks are offered: the event's own time (30 days)
and a compressed one (3 hours around closing time) that makes minute-wide windows
hold several requests of an address.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden.functions.timekeys import epoch_micros, wall_clock

# Client names by event_id % 12.
USER_AGENTS = [
    "python-requests/2.28.0",
    "curl/7.68.0",
    "sqlmap/1.6.12#stable (https://sqlmap.org)",
    "Mozilla/5.0 zgrab/0.x Chrome/124.0",
    "Go-http-client/2.0",
    "Mozilla/5.0 Chrome/124.0 Safari/537.36 Edg/124.0",
    "Mozilla/5.0 Chrome/124.0 Safari/537.36 OPR/110.0",
    "Mozilla/5.0 Gecko/20100101 Firefox/125.0",
    "Mozilla/5.0 Version/17.4 Safari/605.1.15",
    None,
    "-",
    "Mozilla/5.0 Chrome/124.0 Safari/537.36",
]
# 2024-01-01 00:00:00 and 2026-01-01 20:30:00 in microseconds, and the compression.
EVENTS_START_MICROS = 1_704_067_200_000_000
BURST_START_MICROS = 1_767_299_400_000_000
BURST_COMPRESSION = 240
BATCH_DAYS = 1


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def burst_time(ts: Column) -> Column:
    elapsed = F.floor((epoch_micros(ts) - EVENTS_START_MICROS) / BURST_COMPRESSION)
    return wall_clock(elapsed + BURST_START_MICROS)


def _url(event_id: Column, event_type: Column, props: Column) -> Column:
    return (
        F.when(event_type == "signup", "/login")
        .when(event_type == "purchase",
              F.concat(F.lit("/api/v1/checkout?cart="), (event_id % 7).cast("string")))
        .when((event_type == "error") & (event_id % 4 == 0), "/api/v1/user?id=1 OR 1=1")
        .when((event_type == "error") & (event_id % 4 == 1), "/api/v1/product?id=1 AND SLEEP(5)")
        .when(event_type == "error", F.concat(F.lit("/api/v1/search?q="), event_id.cast("string")))
        .otherwise(F.concat(
            F.lit("/products/"), (F.get_json_object(props, "$.k").cast("int") % 5).cast("string")))
    )


def _full_fraction(time: Column) -> Column:
    """Text of a wall-clock time with six fraction digits."""
    return F.date_format(time, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def batch_of(ts: Column) -> Column:
    """Micro-batch of an event: one per ``BATCH_DAYS`` days."""
    days = F.datediff(ts.cast("date"), F.lit("2024-01-01").cast("date"))
    return F.floor(days / BATCH_DAYS).cast("int")


def as_access_log(events: DataFrame, clock: str = "event") -> DataFrame:
    """Events as a raw access log with a ``row_id`` and a ``batch_id``; see the module notes.
    Works on streams too."""
    event_id, event_type = F.col("event_id"), F.col("event_type")
    time = burst_time(F.col("ts")) if clock == "burst" else F.col("ts")
    failed_signup = (event_type == "signup") & (event_id % 3 == 0)
    return events.select(
        event_id.alias("row_id"),
        batch_of(F.col("ts")).alias("batch_id"),
        F.when(event_id % 97 == 0, "n/a").otherwise(_full_fraction(time)).alias("timestamp"),
        F.concat(F.lit("10.0.0."), F.col("user_id").cast("string")).alias("ip_address"),
        F.when(event_type.isin("signup", "purchase"), "POST").otherwise("GET").alias("method"),
        _url(event_id, event_type, F.col("props")).alias("url"),
        F.when(event_type == "error", 500).when(failed_signup, 401).otherwise(200).alias("status_code"),
        F.floor(F.col("value") * 100).alias("response_bytes"),
        F.element_at(
            F.array(*[F.lit(a) for a in USER_AGENTS]), (event_id % 12 + 1).cast("int")
        ).alias("user_agent"),
        F.lit("-").alias("referrer"),
        F.concat_ws("-", F.col("user_id").cast("string"), (event_id % 3).cast("string")).alias("session_id"),
        F.when(failed_signup, "brute_force")
        .when((event_type == "error") & (event_id % 4 < 2), "sql_injection")
        .when(event_id % 12 < 2, "bot_scraper")
        .when(F.col("value") > 200, "data_exfiltration")
        .when(event_id % 50 == 7, "account_takeover")
        .otherwise("normal").alias("attack_type"),
    )


def access_log(spark: SparkSession, sf_dir: str, clock: str = "event") -> DataFrame:
    return as_access_log(read_table(spark, sf_dir, "events"), clock)


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table followed as a file stream."""
    schema = read_table(spark, sf_dir, "events").schema
    # A pattern, because a file source takes a plain path for a directory.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")
