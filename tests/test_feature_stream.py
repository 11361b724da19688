"""Features on a stream: equal to the batch features on closed time, whole over restarts, bounded in state."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from logwarden import fixed_values as V
from logwarden.functions.timekeys import epoch_micros
from logwarden.operators.features import log_features
from logwarden.operators.ingest import clean_logs
from logwarden.streaming.feature_stream import STREAM_FEATURES, start_features, trailing

START = dt.datetime(2026, 1, 1, 10, 0, 0)
SCHEMA = "row_id long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in V.LOG_SCHEMA)


def request(row_id, seconds, ip="10.0.0.1", url="/a", method="GET", status=200, size=100):
    time = (START + dt.timedelta(seconds=seconds)).strftime("%Y-%m-%d %H:%M:%S.%f")
    return (row_id, time, ip, method, url, status, size, "Mozilla", "-", "s", "normal")


def random_log(rows, seed, hours=3.0):
    rng, out = random.Random(seed), []
    for i in range(rows):
        # whole seconds meet frame edges, and many requests share an instant
        seconds = rng.choice([rng.randrange(int(hours * 60)) * 60, rng.randrange(int(hours * 3600)), rng.random() * hours * 3600])
        out.append(request(
            i, round(seconds, 6), rng.choice(["10.0.0.1", "10.0.0.1", "10.0.0.2", None, f"10.0.1.{rng.randrange(5)}"]),
            rng.choice(["/login", "/p/1", "/p/2?id=1 or 1=1", f"/q/{rng.randrange(30)}", None]), rng.choice(["GET", "POST"]),
            rng.choice([200, 404, 500, None]), rng.choice([None, 0, rng.randrange(10**6)])))
    return sorted(out, key=lambda r: r[1])


def follow(spark, source):
    schema = spark.createDataFrame([], SCHEMA).schema
    return clean_logs(spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(f"{source}/*"))


def write(spark, rows, source, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{source}/{name}")


def on_closed_time(spark, rows, watermark):
    """Batch features of the minutes that end by the watermark (seconds after START)."""
    end = int(START.replace(tzinfo=dt.UTC).timestamp()) + watermark
    minute = F.floor(epoch_micros(F.col("event_time")) / 60_000_000)
    found = log_features(clean_logs(spark.createDataFrame(rows, SCHEMA)))
    return found.where((minute + 1) * 60 <= end).select("row_id", "ip_address", "event_time", *STREAM_FEATURES)


def same(stream, batch):
    def rows(frame):
        return sorted((r.row_id, r.ip_address, r.event_time, *(round(float(r[c]), 6) if r[c] is not None else None
                                                                for c in STREAM_FEATURES)) for r in frame.collect())
    got, want = rows(stream), rows(batch)
    assert len(got) == len(want) > 0
    assert got == want


@pytest.mark.parametrize("restart", [False, True])
def test_equals_the_batch_features_on_closed_time(spark, tmp_path, restart):
    rows = random_log(700, seed=5)
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    third = len(rows) // 3
    for i, part in enumerate([rows[:third], rows[third:2 * third], rows[2 * third:]]):
        write(spark, part, source, f"part{i}")
        if restart:  # a new query for each file, on the same checkpoint
            start_features(follow(spark, source), out, f"{tmp_path}/checkpoint", "90 minutes").awaitTermination()
    if not restart:
        start_features(follow(spark, source), out, f"{tmp_path}/checkpoint", "90 minutes").awaitTermination()
    last = max(dt.datetime.strptime(r[1], "%Y-%m-%d %H:%M:%S.%f") for r in rows)
    same(spark.read.parquet(out), on_closed_time(spark, rows, int((last - START).total_seconds()) - 90 * 60))


def test_late_rows_and_rows_without_time_are_left_out(spark, tmp_path):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    write(spark, [request(1, 0), request(2, 30), (3, "n/a", *request(3, 0)[2:])], source, "a")
    write(spark, [request(4, 1000)], source, "b")
    write(spark, [request(5, 1200)], source, "c")
    write(spark, [request(6, 40), request(7, 2400)], source, "d")  # row 6 is far too late
    start_features(follow(spark, source), out, f"{tmp_path}/checkpoint", "1 minute").awaitTermination()
    found = {r.row_id: r.requests_per_minute for r in spark.read.parquet(out).collect()}
    assert found == {1: 1, 2: 2, 4: 1, 5: 1}


def test_state_holds_an_hour_at_most(spark, tmp_path):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    for hour in range(6):  # every hour other addresses, none of which comes back
        write(spark, [request(hour * 100 + i, hour * 3600 + i * 60, ip=f"10.0.{hour}.{i % 3}") for i in range(50)], source, f"h{hour}")
    query = start_features(follow(spark, source), out, f"{tmp_path}/checkpoint", "1 minute")
    query.awaitTermination()
    held = [p["stateOperators"][0]["customMetrics"] for p in query.recentProgress if p["stateOperators"]]
    total = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert held and max(total) < 3 * 50 * 4  # an hour's minutes, sums and timers, not six hours of them
    assert spark.read.parquet(out).count() >= 5 * 50


def test_sizes_beyond_a_long_in_sum(spark, tmp_path):
    rows = [request(i, i, size=2**62) for i in range(5)] + [request(9, 4000)]
    write(spark, rows, f"{tmp_path}/in", "a")
    start_features(follow(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/checkpoint", "1 minute").awaitTermination()
    assert {r.avg_response_bytes_ratio for r in spark.read.parquet(f"{tmp_path}/out").collect()} == {1.0}


def test_many_addresses_share_few_state_rows(spark, tmp_path):
    rows = [request(i, i % 60, ip=f"10.1.{i // 250}.{i % 250}") for i in range(3000)] + [request(9999, 4000)]
    write(spark, rows, f"{tmp_path}/in", "a")
    query = start_features(follow(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/checkpoint", "1 minute")
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert held and max(held) < 1500  # a minute, an index and a timer of each group, not of each address
    found = spark.read.parquet(f"{tmp_path}/out")
    assert found.count() == 3000 and found.agg(F.max("requests_per_minute")).first()[0] == 1


def test_totals_equal_brute_force():
    """Totals over the requests of two hours equal brute force, edges and returning paths included."""
    rng = random.Random(11)
    made = [(rng.randrange(0, 7200) * 1_000_000, rng.choice("ab"), rng.choice(["/x", "/y", "/z", None])) for _ in range(300)]
    rows = {"at": [m[0] for m in made], "address": [m[1] for m in made], "path": [m[2] for m in made],
            "row_id": list(range(300)), **{m: [1] * 300 for m in ("post", "err", "susp", "size", "sized")}}
    now = np.array([m[0] >= 3_600_000_000 for m in made])
    found = trailing(rows, now).set_index("row_id")
    assert len(found) == now.sum()
    for i in np.flatnonzero(now):
        frame = {w: [m for m in made if m[1] == made[i][1] and made[i][0] - w * 1_000_000 <= m[0] <= made[i][0]] for w in (60, 3600)}
        assert found.n60[i] == len(frame[60]) and found.size3600[i] == len(frame[3600])
        assert found.urls3600[i] == len({m[2] for m in frame[3600]} - {None})
