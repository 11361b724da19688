"""Behavioural features: golden values, edges, the split of hot addresses, and the plan."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from logwarden.fixed_values import FEATURE_COLUMNS
from logwarden.operators import hot_features
from logwarden.operators.durable import durable
from logwarden.operators.features import log_features
from logwarden.operators.hot_features import block_cuts, in_blocks
from logwarden.plans import catalog

BASE = dt.datetime(2026, 1, 1, 10)
SCHEMA = ("row_id long, ip_address string, event_time timestamp_ntz, base_url string, method string, "
          "status_code int, response_bytes long, has_suspicious_params int, session_id string")


def request(row_id, seconds, path="/x", method="GET", status=200, size=100, suspicious=0, session="A", ip="10.0.0.1"):
    time = None if seconds is None else BASE + dt.timedelta(seconds=seconds)
    return (row_id, ip, time, path, method, status, size, suspicious, session)


def features(spark, requests, **options):
    frame = log_features(spark.createDataFrame(requests, SCHEMA), **options)
    return {r.row_id: r for r in frame.collect()}


GOLDEN = [
    request(1, 0, "/login", "POST"),
    request(2, 30, "/login", "POST", 401),
    request(3, 45, "/products/5", suspicious=1, session="B"),
    request(4, 120, "/products/6", status=500, size=400, suspicious=1),
]


@pytest.mark.parametrize("hot_rows", [None, 1, 2])
def test_golden_values(spark, hot_rows):
    rows = features(spark, GOLDEN, hot_rows=hot_rows)

    def column(name):
        return [rows[i][name] for i in (1, 2, 3, 4)]

    assert column("requests_per_minute") == [1, 2, 3, 1]
    assert column("post_login_rate") == [1, 2, 2, 2]
    assert column("error_rate_5min") == pytest.approx([0, 0.5, 1 / 3, 0.5])
    assert column("unique_urls_per_hour") == [1, 1, 2, 3]
    assert column("avg_response_bytes_ratio") == pytest.approx([1, 1, 1, 400 / 175])
    assert column("sequential_url_score") == [0, 0, 0, 1]
    assert column("request_interval_variance") == pytest.approx([975.0] * 4)
    assert column("new_session_flag") == [1, 0, 1, 0]
    assert column("suspicious_param_rate") == pytest.approx([0, 0, 1 / 3, 0.5])


def test_frame_includes_its_lower_edge(spark):
    rows = features(spark, [request(1, 0), request(2, 60), request(3, 120.000001)])
    assert [rows[i].requests_per_minute for i in (1, 2, 3)] == [1, 2, 1]


def test_equal_times_see_each_other(spark):
    rows = features(spark, [request(1, 0, "/a"), request(2, 0, "/b")])
    assert [rows[i].requests_per_minute for i in (1, 2)] == [2, 2]
    assert [rows[i].unique_urls_per_hour for i in (1, 2)] == [2, 2]


def test_single_request_and_zero_sizes(spark):
    row = features(spark, [request(1, 0, size=0)])[1]
    assert row.request_interval_variance == 0.0 and row.avg_response_bytes_ratio == 1.0


def test_session_gap_of_a_day(spark):
    rows = features(spark, [request(1, 0), request(2, 86400), request(3, 172801)])
    assert [rows[i].new_session_flag for i in (1, 2, 3)] == [1, 0, 1]


def test_missing_values(spark):
    rows = features(spark, [
        request(1, 0, path=None, session=None, ip=None, size=None), request(2, 10, path="/a", session=None, ip=None),
        request(3, None)])
    assert set(rows) == {1, 2}
    assert rows[2].requests_per_minute == 2 and rows[2].unique_urls_per_hour == 1
    assert rows[2].new_session_flag == 0 and rows[1].unique_urls_per_hour == 0


def test_huge_sizes_do_not_overflow(spark):
    rows = features(spark, [request(i, i, size=2**62) for i in range(4)])
    assert rows[3].avg_response_bytes_ratio == pytest.approx(1.0)


def test_path_leaving_and_returning(spark):
    rows = features(spark, [request(1, 0, "/a"), request(2, 3000, "/a"), request(3, 6600, "/b"), request(4, 6601, "/c"),
                            request(5, 20000, "/a")])
    assert [rows[i].unique_urls_per_hour for i in range(1, 6)] == [1, 1, 2, 2, 1]


def test_empty_table(spark):
    assert features(spark, []) == {}


def brute_force(requests):
    """Feature values straight from the definitions."""
    found = {}
    for r in requests:
        row_id, ip, time, path, _, _, size, _, session = r
        same = [q for q in requests if q[1] == ip]

        def within(seconds):
            return [q for q in same if dt.timedelta(0) <= time - q[2] <= dt.timedelta(seconds=seconds)]

        five, hour, half = within(300), within(3600), within(1800)
        mean = sum(q[6] for q in hour) / len(hour)
        found[row_id] = (
            len(within(60)),
            sum(q[3] == "/login" and q[4] == "POST" for q in five),
            sum(q[5] >= 400 for q in five) / len(five),
            len({q[3] for q in hour}),
            size / mean if mean > 0 else 1.0,
            sum(q[7] for q in half) / len(half),
            int(not any(q[8] == session and (q[2], q[0]) < (time, row_id)
                        and time - q[2] <= dt.timedelta(days=1) for q in same)),
        )
    return found


CHECKED = ["requests_per_minute", "post_login_rate", "error_rate_5min", "unique_urls_per_hour",
           "avg_response_bytes_ratio", "suspicious_param_rate", "new_session_flag"]


@pytest.mark.parametrize("hot_rows", [None, 7, 60])
def test_against_brute_force_with_one_dominant_address(spark, hot_rows):
    rng = random.Random(5)
    requests = [
        request(i, rng.choice([rng.randrange(200000), rng.randrange(4000), 1800, 3600]),
                rng.choice(["/login", "/a/1", "/a/2", "/b"]), rng.choice(["GET", "POST"]), rng.choice([200, 404]),
                rng.randrange(500), rng.randrange(2), rng.choice("ABC"), rng.choice(["hot", "hot", "c1", "c2", "c3"]))
        for i in range(300)
    ]
    rows = features(spark, requests, hot_rows=hot_rows)
    for row_id, expected in brute_force(requests).items():
        assert [rows[row_id][c] for c in CHECKED] == pytest.approx(list(expected)), row_id


def test_split_addresses_equal_the_plain_path(spark, sf):
    from logwarden.operators.ingest import clean_logs
    from logwarden.sources.driver_tables import access_log
    clean = clean_logs(access_log(spark, sf, "burst"))
    plain, split = (
        {r.row_id: r for r in log_features(clean, hot_rows=h).select("row_id", *FEATURE_COLUMNS).collect()}
        for h in (None, 20))
    assert plain.keys() == split.keys() and len(plain) > 900
    for row_id, row in plain.items():
        assert list(split[row_id]) == pytest.approx(list(row), rel=1e-9, abs=1e-9)


def test_blocks_of_a_burst_hold_at_most_twice_their_rows(spark):
    """Nearly all rows of an address within a minute, a third of them in one second."""
    hot_rows = 100
    times = spark.range(20000).select(
        F.lit("a").alias("_key"),
        F.when(F.col("id") < 20, F.col("id") * 86_400_000_000)
        .when(F.col("id") % 3 == 0, 5_000_000_000_000 + F.col("id"))
        .otherwise(5_000_000_000_000 + F.col("id") * 2_900).alias("_at"))
    blocks = in_blocks(times, block_cuts(times, hot_rows)).groupBy("_block").count().collect()
    assert sum(b["count"] for b in blocks) == 20000
    assert max(b["count"] for b in blocks) <= 2 * hot_rows and len(blocks) >= 20000 / (2 * hot_rows)


def test_burst_split_equals_the_plain_path(spark):
    rng = random.Random(8)
    requests = [
        request(i, 100 + i % 3 if i % 4 else rng.randrange(7200), rng.choice(["/login", "/a/1", "/a/2"]), rng.choice(["GET", "POST"]),
                rng.choice([200, 404]), rng.randrange(500), rng.randrange(2), rng.choice("AB"), "hot") for i in range(400)]
    plain, split = features(spark, requests, hot_rows=None), features(spark, requests, hot_rows=30)
    for row_id, row in plain.items():
        assert [split[row_id][c] for c in FEATURE_COLUMNS] == pytest.approx([row[c] for c in FEATURE_COLUMNS]), row_id


def test_plan_has_one_exchange_and_three_sorts(spark):
    frame = log_features(spark.createDataFrame(GOLDEN, SCHEMA), hot_rows=None)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "SinglePartition" not in plan
    assert len(re.findall(r"\bSort \[", plan)) == 3
    assert "Python" not in plan


def test_split_query_writes_only_what_the_features_read(spark, tmp_path, monkeypatch):
    events = spark.range(600).selectExpr(
        "id AS event_id", "timestamp_seconds(1704067200 + id * 4320) AS ts", "id % 4 AS user_id",
        "element_at(array('view', 'signup', 'error'), cast(id % 3 + 1 AS int)) AS event_type", "id / 7.0D AS value",
        "'{\"k\": 5}' AS props")
    events.write.parquet(f"{tmp_path}/events.parquet")
    written = {}

    def noted(df, label):
        written[label] = set(df.columns)
        return durable(df, label)

    monkeypatch.setattr(hot_features, "durable", noted)
    split = catalog.all_features_split(spark, str(tmp_path))
    assert written["hot-times"] == {"_key", "_at"}
    assert "base_url" in written["hot"] and not written["hot"] & {"timestamp", "url", "user_agent", "referrer", "browser_type"}
    plain = catalog.all_features(spark, str(tmp_path))
    assert split.columns == plain.columns and split.exceptAll(plain).isEmpty() and split.count() == plain.count() > 0
