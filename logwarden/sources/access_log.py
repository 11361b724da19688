"""Access-log files and tables: Parquet, CSV, JSON events, Kafka, external tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden import fixed_values as V
from logwarden.functions.text import parse_event_time
from logwarden.operators.durable import durable
from logwarden.operators.hot_features import NULL_ADDRESS

ROW_ID = "row_id"
#: The address of a laid-out log, never missing, by which it lies in buckets.
ADDRESS_KEY = "address_key"


def validate_columns(columns: Iterable[str]) -> None:
    """Raise when a required column is missing. Looks at names only; runs no job."""
    present = set(columns)
    missing = [c for c in V.REQUIRED_COLUMNS if c not in present]
    if missing:
        raise ValueError(f"Access log lacks required columns: {missing}")


def read_access_log(
    spark: SparkSession, path: str, file_format: str | None = None, row_id: bool = True
) -> DataFrame:
    """Read a log directory. CSV is read with the declared schema, never by inference.

    Without ``file_format``, names ending in ``.csv`` are CSV and all else is Parquet.
    ``row_id`` adds a unique key, repeated lines included: file and position. For Parquet it is
    the same in every read. CSV lines have no position, so a CSV log is first written to the
    shared folder as Parquet and keyed there; the key holds for that read.
    """
    if file_format is None:
        file_format = "csv" if path.rstrip("/").endswith(".csv") else "parquet"
    if file_format == "csv":
        log = spark.read.schema(V.LOG_SCHEMA).option("header", True).option("escape", '"').csv(path)
        log = durable(log, "csv") if row_id else log
    else:
        log = spark.read.parquet(path)
    validate_columns(log.columns)
    if row_id and ROW_ID not in log.columns:
        position = F.lpad(F.col("_metadata.row_index").cast("string"), 12, "0")
        key = F.concat_ws("-", F.hex(F.xxhash64("_metadata.file_path")), position)
        log = log.select("*", key.alias(ROW_ID))
    return log


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: tuple[str, ...] = ()) -> None:
    """Write to any URI Spark has a file system for (local, hdfs, s3a, ...)."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def with_event_time(df: DataFrame) -> DataFrame:
    """Make sure ``event_time`` is there, falling back to the timestamp text."""
    parsed = parse_event_time(F.col("timestamp"))
    if "event_time" in df.columns:
        kept = F.col("event_time").try_cast("timestamp_ntz")
        parsed = F.coalesce(kept, parsed) if "timestamp" in df.columns else kept
    return df.withColumn("event_time", parsed)


def as_json_events(log: DataFrame) -> DataFrame:
    """One JSON object per request in ``value``, keyed by address, as a message bus wants it."""
    return log.select(
        F.col("ip_address").alias("key"),
        F.to_json(F.struct(*V.REQUIRED_COLUMNS)).alias("value"),
    )


def publish_to_kafka(log: DataFrame, servers: str, topic: str) -> None:
    """Send every row as a JSON event. Needs the Spark Kafka connector on the class path."""
    (as_json_events(log).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())


def read_event_stream(
    spark: SparkSession, source: str = "kafka", options: Mapping[str, str] | None = None
) -> DataFrame:
    """Streaming frame with the raw event in ``value``.

    ``source="kafka"`` needs the connector and at least ``kafka.bootstrap.servers`` and
    ``subscribe``; ``source="text"`` follows a directory of JSON lines given as ``path``.
    """
    reader = spark.readStream.format(source)
    if source == "kafka":
        reader = reader.option("startingOffsets", "latest")
    return reader.options(**(options or {})).load()


def create_alert_table(spark: SparkSession, table: str, location: str) -> DataFrame:
    """Register an external table over alert Parquet files, so that SQL can query it."""
    database = table.rpartition(".")[0]
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    escaped = location.replace("'", "\\'")
    spark.sql(f"""
        CREATE TABLE IF NOT EXISTS {table} (
            timestamp STRING, ip_address STRING, url STRING, status_code INT,
            threat_score BIGINT, severity STRING, attack_type STRING, top_flag STRING
        ) USING parquet LOCATION '{escaped}'
    """)
    return spark.table(table)


def create_daily_alert_table(spark: SparkSession, table: str, location: str, alerts: DataFrame) -> DataFrame:
    """Write alerts by day under ``location`` and register them as an external table; a query for some
    days reads their folders only. Alerts without a readable time lie in the folder of no day."""
    daily = alerts.withColumn("event_date", parse_event_time(F.col("timestamp")).cast("date"))
    daily.write.mode("overwrite").option("path", location).partitionBy("event_date").saveAsTable(table)
    return spark.table(table)


def write_laid_out(clean: DataFrame, table: str, location: str, buckets: int) -> DataFrame:
    """Write a cleaned log by day and in buckets of addresses, and register it as ``table``.

    An address lies in one bucket on every day, so windows and joins by address need no exchange;
    missing addresses have a bucket too. Each task writes one bucket, so a day has ``buckets``
    files at most. Choose ``buckets`` for the size of all days that are read together.
    """
    placed = clean.withColumns({
        ADDRESS_KEY: F.coalesce(F.col("ip_address"), F.lit(NULL_ADDRESS)), "event_date": F.col("event_time").cast("date")})
    (placed.repartition(buckets, ADDRESS_KEY).write.mode("overwrite").option("path", location)
     .partitionBy("event_date").bucketBy(buckets, ADDRESS_KEY).saveAsTable(table))
    return clean.sparkSession.table(table)
