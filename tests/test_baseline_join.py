"""Events scored by event time on a stream, against a plain range join."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from logwarden.operators.ingest import clean_logs
from logwarden.streaming.baseline_join import score_by_event_time
from tests.test_feature_stream import START, follow, random_log, request, write


def run(spark, source, out, late, **options):
    clean = clean_logs(follow(spark, source)).drop("is_bot", "has_suspicious_params")
    scored = score_by_event_time(clean, late, **options)
    scored.writeStream.format("parquet").option("path", f"{out}/rows").option(
        "checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return {r.row_id: (r.baseline_rows, round(r.baseline_mean, 6), round(r.resp_zscore, 6)) for r in
            spark.read.parquet(f"{out}/rows").collect()}


@pytest.mark.parametrize("salts", [1, 7])
def test_equals_a_range_join_on_closed_windows(spark, tmp_path, salts):
    rows = random_log(500, seed=9, hours=1.0)
    half = len(rows) // 2
    for name, part in (("a", rows[:half]), ("b", rows[half:])):
        write(spark, part, f"{tmp_path}/in", name)
    found = run(spark, f"{tmp_path}/in", f"{tmp_path}/out", "35 minutes", salts=salts)
    timed = [(r[0], (dt.datetime.strptime(r[1], "%Y-%m-%d %H:%M:%S.%f") - START).total_seconds(), r[6]) for r in rows]
    last = int(max(t for _, t, _ in timed) * 1000) / 1000 - 35 * 60
    want = {}
    for row_id, time, size in timed:
        end = time // 30 * 30
        inside = [s for _, t, s in timed if end - 300 <= t < end]
        sizes = [s for s in inside if s is not None]
        if inside and end <= last:
            mean = sum(sizes) / len(sizes) if len(sizes) > 1 else 0.0
            std = max(sum(s * s for s in sizes) / len(sizes) - mean * mean, 0.0) ** 0.5 if len(sizes) > 1 else 0.0
            want[row_id] = (len(sizes), round(mean, 6), round((size - mean) / std, 6) if std > 0 and size is not None else 0.0)
    assert len(want) > 100 and found.keys() == want.keys()
    for row_id, values in want.items():
        assert found[row_id] == pytest.approx(values, abs=2e-6)


def test_events_without_time_or_baseline_are_left_out(spark, tmp_path):
    rows = [request(1, 0), request(2, 31), (3, "n/a", *request(3, 0)[2:]), request(4, 4000), request(5, 4020)]
    write(spark, rows, f"{tmp_path}/in", "a")
    write(spark, [request(9, 9000)], f"{tmp_path}/in", "b")
    assert set(run(spark, f"{tmp_path}/in", f"{tmp_path}/out", "1 minute")) == {2, 5}
