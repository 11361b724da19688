"""Cleaning, quality report, and files."""

import pytest
from pyspark.sql import functions as F

from logwarden import fixed_values as V
from logwarden.operators.ingest import clean_logs, quality_report
from logwarden.plans.pipeline import score_logs
from logwarden.sources import access_log as files
from logwarden.sources.driver_tables import access_log


def log(spark, rows):
    return spark.createDataFrame(rows, V.LOG_SCHEMA)


ROWS = [
    ("2026-01-01 10:00:00.000000", "10.0.0.1", "GET", "/a?x=1", 200, 10, "curl/1", "-", "s", "normal"),
    ("bad", None, "GET", None, 200, 10, None, "-", None, "normal"),
    ("2026-01-01 10:00:01", "10.0.0.1", "GET", "/a?id=1 OR 1=1", None, None, "X", "-", "s", "sql_injection"),
]


def test_required_columns(spark):
    files.validate_columns(V.REQUIRED_COLUMNS)
    with pytest.raises(ValueError, match="user_agent"):
        clean_logs(log(spark, ROWS).drop("user_agent"))


def test_quality_report_is_one_pass(spark):
    report = quality_report(clean_logs(log(spark, ROWS)))
    # Before it has run: afterwards the text shows the initial plan next to the final one.
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1
    found = {r.metric: (r.value, r.status) for r in report.collect()}
    assert found == {
        "total_rows": (3, None), "null_timestamp": (0, "OK"), "null_ip_address": (1, "FAIL"), "null_url": (1, "FAIL"),
        "null_status_code": (1, "FAIL"), "bad_timestamps": (1, None), "bot_requests": (1, None),
        "suspicious_requests": (1, None)}


def test_text_numbers_are_cast_and_bad_ones_nulled(spark):
    raw = log(spark, ROWS).withColumns({"status_code": F.lit("4o4"), "response_bytes": F.lit("77")})
    row = clean_logs(raw).first()
    assert row.status_code is None and row.response_bytes == 77


def test_csv_and_parquet_read_back_the_same(spark, sf, tmp_path):
    raw = access_log(spark, sf).select(V.REQUIRED_COLUMNS)
    files.write_csv(raw, f"{tmp_path}/log.csv")
    files.write_parquet(raw, f"{tmp_path}/log")
    csv = files.read_access_log(spark, f"{tmp_path}/log.csv")
    parquet = files.read_access_log(spark, f"{tmp_path}/log")
    assert csv.select(V.REQUIRED_COLUMNS).exceptAll(parquet.select(V.REQUIRED_COLUMNS)).isEmpty()
    assert csv.count() == parquet.count() == 1000
    assert parquet.select("row_id").distinct().count() == 1000


def test_object_store_path_is_just_a_uri(spark, sf, tmp_path):
    files.write_parquet(access_log(spark, sf), f"file://{tmp_path}/bucket/alerts", partition_by=("attack_type",))
    pruned = spark.read.parquet(f"file://{tmp_path}/bucket/alerts").filter("attack_type = 'normal'")
    assert "PartitionFilters: [isnotnull(attack_type" in pruned._jdf.queryExecution().executedPlan().toString()


def test_event_time_is_taken_from_text_when_absent(spark):
    rows = files.with_event_time(log(spark, ROWS)).orderBy("timestamp").collect()
    assert [r.event_time is None for r in rows] == [False, False, True]


def test_kafka_writer_needs_only_the_connector(spark):
    value = files.as_json_events(log(spark, ROWS)).first()
    assert value.key == "10.0.0.1" and '"url":"/a?x=1"' in value.value
    with pytest.raises(Exception, match="(?i)kafka"):
        files.publish_to_kafka(log(spark, ROWS), "nowhere:9", "t")


def test_repeated_csv_lines_get_their_own_keys_and_scores(spark, sf, tmp_path):
    requests = access_log(spark, sf, "burst").limit(300).select(V.REQUIRED_COLUMNS)
    path = str(tmp_path / "log.csv")
    files.write_csv(requests.unionByName(requests.limit(20)), path)
    scored = score_logs(files.read_access_log(spark, path))
    timed = scored.count()
    assert timed > 300 and scored.select("row_id").distinct().count() == timed
