"""The compacted alert log: few files, no loss and no double whatever fails, reports without rescans."""

import pytest
from pyspark.sql import functions as F

from logwarden.operators import reports
from logwarden.streaming import alert_log
from logwarden.streaming.alert_log import AlertLog
from logwarden.streaming.alert_stream import AlertStream
from tests.test_streaming import event, write
from logwarden.sources import access_log as files

SCHEMA = "n long, ip_address string, severity string, threat_score int, attack_type string, timestamp string"


def batch(spark, number, rows=5):
    return spark.createDataFrame([
        (number * 100 + i, f"10.0.0.{(number * i) % 7}", ["MEDIUM", "HIGH", "CRITICAL"][(number + i) % 3], 25 + (number * 7 + i * 13) % 70,
         "bot" if i % 2 else None, f"2026-01-01 {(number + i) % 24:02d}:00:00.000000" if i else "n/a") for i in range(rows)], SCHEMA)


def numbers(log):
    return sorted(r.n for r in log.alerts().collect())


def test_many_batches_end_in_few_files(spark, tmp_path):
    log = AlertLog(spark, str(tmp_path), every=5)
    for number in range(24):
        log.append(batch(spark, number, 2).coalesce(1), "run", number)
        log.compact()
    assert len(log.entries) < 2 * 5 + 2 and len(log.alerts().inputFiles()) < 5 + 6
    assert numbers(log) == sorted(n * 100 + i for n in range(24) for i in range(2))
    again = AlertLog(spark, str(tmp_path))
    assert again.version == log.version and numbers(again) == numbers(log)


@pytest.mark.parametrize("broken", ["append", "compact"])
def test_a_crash_between_steps_loses_and_doubles_nothing(spark, tmp_path, monkeypatch, broken):
    log = AlertLog(spark, str(tmp_path), every=3)
    for number in range(2 if broken == "append" else 3):
        log.append(batch(spark, number), "run", number)
    before = numbers(log)
    monkeypatch.setattr(AlertLog, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        log.append(batch(spark, 2), "run", 2) if broken == "append" else log.compact()
    monkeypatch.undo()
    fresh = AlertLog(spark, str(tmp_path), every=3)  # a new process sees what the manifest names
    assert numbers(fresh) == before
    assert fresh.append(batch(spark, 2), "run", 2)  # the batch is run again, the second time replacing itself
    assert fresh.append(batch(spark, 2), "run", 2)
    fresh.compact()
    want = sorted(n * 100 + i for n in range(3) for i in range(5))
    assert numbers(fresh) == want and len(fresh.entries) == 2
    assert not fresh.append(batch(spark, 1), "run", 1) and numbers(fresh) == want
    assert fresh.append(batch(spark, 1), "other run", 1) and len(numbers(fresh)) == 20


def test_reports_after_every_batch_equal_those_over_the_alerts(spark, tmp_path):
    log, seen = AlertLog(spark, str(tmp_path), every=3), None
    for number in range(5):
        new = batch(spark, number, 9)
        seen = new if seen is None else seen.unionByName(new)
        log.append(new, "run", number)
        log.compact()
        counts = log.counts()
        rows = lambda frame: [tuple(r) for r in frame.collect()]
        assert rows(alert_log.severity_summary(counts)) == rows(reports.severity_summary(seen))
        assert rows(alert_log.top_dangerous_ips(counts)) == rows(reports.top_dangerous_ips(seen))
        assert rows(alert_log.alerts_by(counts, "attack_type")) == rows(reports.alerts_by_attack_type(seen))
        critical = alert_log.critical_share(counts).first()
        assert (critical.alerts, critical.critical) == (seen.count(), seen.where("severity = 'CRITICAL'").count())
    assert counts.agg(F.sum("alerts")).first()[0] == 45


def test_empty_log_and_empty_batches(spark, tmp_path):
    log = AlertLog(spark, str(tmp_path), every=2)
    assert log.alerts().count() == 0 and alert_log.severity_summary(log.counts()).count() == 0
    for number in range(3):
        log.append(batch(spark, 0).limit(0), "run", number)
        log.compact()
    assert log.alerts().count() == 0 and log.counts().count() == 0


def test_a_stream_with_a_log(spark, tmp_path):
    source, root = tmp_path / "in", tmp_path / "out"
    for name in "abcde":
        write(source, f"{name}.json", [event(100, agent="curl/7"), event(102)])
        stream = AlertStream(str(root), log=AlertLog(spark, f"{root}/log", every=2))
        raw = files.read_event_stream(spark, "text", {"path": str(source)})
        stream.start_raw(raw, f"{root}/checkpoint", available_now=True).awaitTermination()
    assert stream.alerts(spark).count() == 5 and stream.metrics(spark).count() == 5
    assert len(AlertLog(spark, f"{root}/log").entries) <= 4
