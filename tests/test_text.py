"""Scalar expressions on hand-picked values."""

import datetime as dt

from pyspark.sql import functions as F

from logwarden.functions import scoring, text
from logwarden.operators.scaling import sanitize_features


def values(spark, rows, kind, expression):
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r.y for r in frame.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_trailing_id(spark):
    paths = ["/products/123", "/42", "/login", "/products/abc", "", None, "/a/" + "9" * 20]
    assert values(spark, paths, "string", text.trailing_id) == [123, 42, None, None, None, None, None]


def test_parse_event_time(spark):
    times = ["2026-01-01 10:00:00.000001", "2026-01-01 10:00:00.5", "2026-01-01 10:00:00", "n/a", None,
             "2026-13-01 10:00:00.000000", "2026-01-01"]
    day = dt.datetime(2026, 1, 1, 10)
    assert values(spark, times, "string", text.parse_event_time) == [
        day.replace(microsecond=1), day.replace(microsecond=500000), day, None, None, None, None]


def test_bot_and_browser(spark):
    agents = ["curl/7.68.0", "Go-http-client/2.0", "Mozilla/5.0 zgrab/0.x Chrome/124.0", "X Chrome/1 Safari/2 Edg/3",
              "X Chrome/1 OPR/3", "X Chrome/1 Safari/2", "Firefox/125.0", "Version/17 Safari/605", "-", None,
              "GoogleBot Chrome/1"]
    assert values(spark, agents, "string", text.is_bot) == [True] + [False] * 9 + [True]
    assert values(spark, agents, "string", text.browser_type) == [
        "Bot/Tool", "Bot/Tool", "Scanner", "Edge", "Opera", "Chrome", "Firefox", "Safari", "Other", "Other", "Bot/Tool"]


def test_suspicious_params(spark):
    from logwarden import fixed_values as V
    urls = ["/a?id=1 OR 1=1", "/a?q=SLEEP(5)", "/a?q=/*x*/", "/plain", None, "/a?x=0xff"]
    assert values(spark, urls, "string", text.has_suspicious_params) == [1, 1, 1, 0, 0, 1]
    short = lambda u: text.has_suspicious_params(u, V.STREAM_SUSPICIOUS_TOKENS)
    assert values(spark, urls, "string", short) == [1, 1, 0, 0, 0, 0]


def test_every_token_is_found(spark):
    from logwarden import fixed_values as V
    assert values(spark, V.SUSPICIOUS_TOKENS, "string", text.has_suspicious_params) == [1] * 16
    assert values(spark, V.BOT_TOKENS, "string", text.is_bot) == [True] * 6


def test_offhours_edges(spark):
    hours = [f"2026-01-01 {h:02d}:30:00" for h in (6, 7, 22, 23)]
    assert values(spark, hours, "string", lambda t: text.is_offhours(text.parse_event_time(t))) == [1, 0, 0, 1]


def test_severity_edges(spark):
    scores = [0, 24, 25, 49, 50, 74, 75, 100]
    assert values(spark, scores, "int", scoring.severity) == [
        "NORMAL", "NORMAL", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "CRITICAL", "CRITICAL"]


def test_sanitized(spark):
    frame = spark.createDataFrame([(float("inf"),), (float("-inf"),), (float("nan"),), (None,), (1.5,)], "x double")
    assert [r.x for r in sanitize_features(frame, ["x"]).collect()] == [0.0, 0.0, 0.0, 0.0, 1.5]


def test_largest_name_prefers_the_first_on_ties(spark):
    row = spark.range(1).select(scoring.name_of_largest({"a": F.lit(1.0), "b": F.lit(2.0), "c": F.lit(2.0)}).alias("n"))
    assert row.first().n == "b"
