"""Logs and alerts laid out by day and address: what the plans no longer do, and equal results."""

import uuid

from pyspark.sql import functions as F

from logwarden import fixed_values as V
from logwarden.operators.features import log_features
from logwarden.operators.ingest import clean_logs
from logwarden.plans import catalog
from logwarden.sources import access_log as files
from logwarden.sources.driver_tables import access_log


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_windows_over_a_laid_out_log_need_no_exchange(spark, sf, tmp_path):
    clean = clean_logs(access_log(spark, sf, "burst").withColumn(
        "ip_address", F.when(F.col("row_id") % 10 > 0, F.col("ip_address"))))
    table = files.write_laid_out(clean, f"laid_out_{uuid.uuid4().hex}", f"{tmp_path}/log", 4)
    laid_out = log_features(table, hot_rows=None, placed_by=files.ADDRESS_KEY)
    plan = plan_of(laid_out)
    assert "Window" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    plain = log_features(clean, hot_rows=None)
    assert "Exchange" in plan_of(plain)
    columns = ["row_id", *V.FEATURE_COLUMNS]
    rows = lambda frame: sorted(tuple(round(float(v), 6) for v in r) for r in frame.select(columns).collect())
    assert rows(laid_out) == rows(plain)
    assert len(rows(plain)) > 0


def test_a_day_of_alerts_reads_its_own_folder(spark, tmp_path):
    alerts = spark.createDataFrame(
        [(f"2026-01-0{1 + i % 5} 10:00:00.000000" if i % 7 else "n/a", f"10.0.0.{i}", 30 + i) for i in range(40)],
        "timestamp string, ip_address string, threat_score int")
    name = f"alerts_{uuid.uuid4().hex}"
    table = files.create_daily_alert_table(spark, name, f"{tmp_path}/alerts", alerts)
    day = spark.sql(f"SELECT ip_address FROM {name} WHERE event_date = DATE '2026-01-03'")
    plan = plan_of(day)
    assert "PartitionFilters: [isnotnull(event_date" in plan and len(day.inputFiles()) < len(table.inputFiles())
    assert {r.ip_address for r in day.collect()} == {f"10.0.0.{i}" for i in range(40) if i % 7 and i % 5 == 2}
    assert table.count() == 40 and table.where("event_date is null").count() == 6


def test_reports_do_not_go_stale(spark, sf, monkeypatch):
    made = []
    monkeypatch.setattr(catalog.pipeline, "score_logs", lambda log: made.append(1) or log.select("row_id"))
    monkeypatch.setattr(catalog, "_SCORED_TABLES", {})
    catalog.scored_table(spark, sf)
    catalog.scored_table(spark, sf)
    assert len(made) == 1
    key = next(iter(catalog._SCORED_TABLES))
    catalog._SCORED_TABLES[key] += "-gone"  # the folder was cleaned
    assert catalog.scored_table(spark, sf).count() > 0 and len(made) == 2
    monkeypatch.setattr(catalog, "_input_key", lambda *a: ("other files",))
    catalog.scored_table(spark, sf)
    assert len(made) == 3
