"""The running streams: replay, restart, rejects, triage."""

import json

import pytest
from pyspark.sql import functions as F

from logwarden import fixed_values as V
from logwarden.sources import access_log as files
from logwarden.sources.driver_tables import access_log
from logwarden.streaming.alert_stream import AlertStream
from logwarden.streaming.scoring import parse_events, rejected_events, rolling_baseline, score_events, score_in_batches, stream_alerts
from logwarden.streaming.triage import alert_files, start_triage


def event(size, agent="Mozilla", ip="10.0.0.1", url="/a"):
    return {"timestamp": "2026-01-01 10:00:00.000000", "ip_address": ip, "method": "GET", "url": url,
            "status_code": 200, "response_bytes": size, "user_agent": agent, "referrer": "-", "session_id": "s",
            "attack_type": "normal"}


def write(folder, name, events):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(e) for e in events) + "\n")


def run(spark, source, root):
    stream = AlertStream(str(root))
    raw = files.read_event_stream(spark, "text", {"path": str(source), "maxFilesPerTrigger": "1"})
    stream.start(parse_events(raw), f"{root}/checkpoint", available_now=True).awaitTermination()
    return stream


def test_baseline_survives_a_restart_and_replay_adds_nothing(spark, tmp_path):
    source, root = tmp_path / "in", tmp_path / "out"
    write(source, "a.json", [event(100), event(102), event(98)])
    first = run(spark, source, root)
    assert first.alerts(spark).count() == 0
    # A new process: nothing is left in memory, the window comes from the state table.
    write(source, "b.json", [event(5000), event(101), event(None, agent="curl/7")])
    second = run(spark, source, root)
    found = {(r.response_bytes, r.threat_score, r.zscore_flag) for r in second.alerts(spark).collect()}
    assert found == {(5000, 30, True), (None, 25, False)}
    metrics = {r.batch_id: (r.events, r.alerts, r.medium) for r in second.metrics(spark).collect()}
    assert metrics == {0: (3, 0, 0), 1: (3, 2, 2)}
    again = spark.createDataFrame([event(5000), event(101), event(None, agent="curl/7")], V.LOG_SCHEMA)
    runs = [r.run for r in second.alerts(spark).select("run").distinct().collect()]
    assert len(runs) == 1 and runs != ["direct"]
    AlertStream(str(root), runs[0]).process_batch(again, 1)
    assert second.alerts(spark).count() == 2 and second.metrics(spark).count() == 2


def test_a_new_checkpoint_on_the_same_root_loses_nothing(spark, tmp_path):
    source, root = tmp_path / "in", tmp_path / "out"
    write(source, "a.json", [event(100, agent="curl/7"), event(102, agent="curl/7")])
    for checkpoint in ("one", "two"):
        stream = AlertStream(str(root))
        raw = files.read_event_stream(spark, "text", {"path": str(source)})
        stream.start(parse_events(raw), f"{tmp_path}/{checkpoint}", available_now=True).awaitTermination()
    assert stream.alerts(spark).groupBy("run").count().toPandas()["count"].tolist() == [2, 2]


def test_missing_state_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="before 3"):
        AlertStream(str(tmp_path)).process_batch(spark.createDataFrame([event(10)], V.LOG_SCHEMA), 3)


def test_empty_batches_take_no_slot(spark, tmp_path):
    stream = AlertStream(str(tmp_path))
    empty = spark.createDataFrame([], V.LOG_SCHEMA)
    stream.process_batch(spark.createDataFrame([event(10), event(12)], V.LOG_SCHEMA), 0)
    for batch in range(1, 4):
        stream.process_batch(empty, batch)
    stream.process_batch(spark.createDataFrame([event(90)], V.LOG_SCHEMA), 4)
    assert [r.threat_score for r in stream.alerts(spark).collect()] == [30]


def test_handler_equals_the_batch_form(spark, sf, tmp_path):
    log = access_log(spark, sf).filter("batch_id < 13")
    stream = AlertStream(str(tmp_path))
    for batch in range(13):
        stream.process_batch(log.filter(F.col("batch_id") == batch).select(V.REQUIRED_COLUMNS), batch)
    live = stream.alerts(spark).select("batch_id", *V.STREAM_ALERT_COLUMNS)
    batch = stream_alerts(score_in_batches(log)).select("batch_id", *V.STREAM_ALERT_COLUMNS)
    assert live.count() == batch.count() > 0
    assert live.exceptAll(batch).isEmpty() and batch.exceptAll(live).isEmpty()


def test_events_are_not_shuffled_for_their_baseline(spark, sf):
    plan = score_in_batches(access_log(spark, sf))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_baseline_covers_the_last_ten_filled_batches(spark):
    rows = [(b, None if b in (3, 4) else 100 * b) for b in range(15)]
    frame = spark.createDataFrame(rows, "batch_id int, response_bytes long")
    found = {r.batch_id: (r.baseline_rows, r.baseline_mean) for r in rolling_baseline(frame).collect()}
    assert found[0] == (0, 0.0) and found[1] == (1, 0.0) and found[2] == (2, 50.0)
    assert found[5] == (3, 100.0)
    filled = [b for b in range(14) if b not in (3, 4)][-10:]
    assert found[14] == (10, pytest.approx(100 * sum(filled) / 10))


def test_missing_size_never_hides_a_bot(spark):
    frame = spark.createDataFrame([(True, 0, None)], "is_bot boolean, has_suspicious_params int, response_bytes long")
    assert score_events(frame, F.lit(5.0), F.lit(2.0)).first().threat_score == 25


def test_rejects(spark):
    raw = spark.createDataFrame([('{"ip_address": "1", "status_code": "x"}',), ("junk",), ('{"url": "/a"}',), (None,)], "value string")
    good = parse_events(raw).collect()
    assert [(r.ip_address, r.status_code) for r in good] == [("1", None)]
    assert rejected_events(raw).count() == 3


def test_rejects_of_a_running_stream_are_kept(spark, tmp_path):
    source, root = tmp_path / "in", tmp_path / "out"
    write(source, "a.json", [event(100, agent="curl/7"), "no event", {"url": "/a"}])
    stream = AlertStream(str(root))
    raw = files.read_event_stream(spark, "text", {"path": str(source)})
    stream.start_raw(raw, f"{root}/checkpoint", available_now=True).awaitTermination()
    assert stream.alerts(spark).count() == 1
    assert sorted(r.value for r in stream.rejects(spark).collect()) == ['"no event"', '{"url": "/a"}']


def test_triage_of_new_files(spark, tmp_path):
    schema = "ip_address string, threat_score int, severity string"
    alerts = [("a", 60, "HIGH"), ("b", 90, "CRITICAL"), ("c", 90, "CRITICAL"), ("d", None, None)]
    spark.createDataFrame(alerts, schema).coalesce(1).write.parquet(f"{tmp_path}/alerts/batch_id=0")
    root = str(tmp_path / "triage")

    def total():
        start_triage(alert_files(spark, f"{tmp_path}/alerts"), root, f"{root}/checkpoint").awaitTermination()
        return spark.read.parquet(f"{root}/totals").orderBy("batch_id").collect()

    row = total()[0]
    assert (row.critical, row.high, row.medium, row.top_ip, row.top_score, row.unique_ips) == (2, 1, 0, "b", 90, 4)
    assert row.message.startswith("Act now: 2 critical alerts by 4 addresses, worst b with 90")
    spark.createDataFrame([("e", 30, "MEDIUM")], schema).coalesce(1).write.parquet(f"{tmp_path}/alerts/batch_id=1")
    assert total()[1].message == "Nothing critical, high: 0, medium: 1"
    assert spark.read.parquet(f"{root}/files").count() == 2


def test_triage_with_a_new_checkpoint_loses_nothing(spark, tmp_path):
    schema, root = "ip_address string, threat_score int, severity string", str(tmp_path / "triage")
    spark.createDataFrame([("a", 60, "HIGH")], schema).coalesce(1).write.parquet(f"{tmp_path}/alerts/batch_id=0")
    for checkpoint in ("one", "two"):
        start_triage(alert_files(spark, f"{tmp_path}/alerts"), root, f"{tmp_path}/{checkpoint}").awaitTermination()
    assert spark.read.parquet(f"{root}/files").select("run").distinct().count() == 2
    assert spark.read.parquet(f"{root}/totals").count() == 2


def test_runs_of_one_stream_object_keep_their_own_baseline(spark, tmp_path):
    stream, sizes = AlertStream(str(tmp_path)), {"one": [10, 12], "two": [1000, 1200]}
    for run, values in sizes.items():
        stream._run = run
        stream.process_batch(spark.createDataFrame([event(v) for v in values], V.LOG_SCHEMA), 0)
    for run, size in (("one", 1100), ("two", 1100)):
        stream._run = run
        stream.process_batch(spark.createDataFrame([event(size)], V.LOG_SCHEMA), 1)
    assert {(r.run, r.threat_score) for r in stream.alerts(spark).collect()} == {("one", 30)}
