"""Expressions of the stream path. They work on streaming and on batch frames alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logwarden import fixed_values as V
from logwarden.functions import text
from logwarden.functions.scoring import is_alert, severity, weighted_sum
from logwarden.operators.durable import durable


def parse_events(raw: DataFrame, value: str = "value") -> DataFrame:
    """JSON text to typed events. Events without an address, or no JSON at all, are left out."""
    return _decoded(raw, value).filter(F.col("ip_address").isNotNull()).drop("_raw")


def rejected_events(raw: DataFrame, value: str = "value") -> DataFrame:
    """The raw text of what ``parse_events`` leaves out."""
    return (_decoded(raw, value).filter(F.col("ip_address").isNull())
            .select(F.col("_raw").alias("value")))


def _decoded(raw: DataFrame, value: str) -> DataFrame:
    body = F.col(value).cast("string")
    others = [c for c in raw.columns if c != value and c not in V.REQUIRED_COLUMNS]
    return (raw.select(*others, body.alias("_raw"), F.from_json(body, V.LOG_SCHEMA).alias("d"))
            .select(*others, "_raw", "d.*"))


def watch_rejects(raw: DataFrame, seen: Observation, value: str = "value") -> DataFrame:
    """As ``parse_events``; ``seen`` gets the number of ``rejects`` when the rows are used."""
    decoded = _decoded(raw, value).observe(seen, F.count_if(F.col("ip_address").isNull()).alias("rejects"))
    return decoded.filter(F.col("ip_address").isNotNull()).drop("_raw")


def enrich_events(events: DataFrame) -> DataFrame:
    return events.withColumns({
        "is_bot": text.is_bot(F.col("user_agent")),
        "has_suspicious_params":
            text.has_suspicious_params(F.col("url"), V.STREAM_SUSPICIOUS_TOKENS),
    })


def score_events(enriched: DataFrame, mean: Column, std: Column) -> DataFrame:
    """Real-time score. Without a baseline (std 0), or a size, the size counts as usual."""
    deviation = F.when(std > 0, (F.col("response_bytes") - mean) / std)
    scored = enriched.withColumn("resp_zscore", F.coalesce(deviation, F.lit(0.0)))
    scored = scored.withColumn("zscore_flag", F.abs("resp_zscore") > V.ZSCORE_LIMIT)
    points = weighted_sum({name: F.col(name) for name in V.STREAM_WEIGHTS}, V.STREAM_WEIGHTS)
    return (scored.withColumn("threat_score", points)
            .withColumn("severity", severity(F.col("threat_score"))))


def moments() -> list[Column]:
    """Count, sum and sum of squares of the response sizes; doubles cannot overflow."""
    size = F.col("response_bytes").cast("double")
    return [
        F.count("response_bytes").alias("n"),
        F.coalesce(F.sum(size), F.lit(0.0)).alias("s"),
        F.coalesce(F.sum(size * size), F.lit(0.0)).alias("sq"),
    ]


def mean_and_std(n: Column, s: Column, sq: Column) -> tuple[Column, Column]:
    """Population mean and deviation from summed moments; (0, 0) below two values."""
    mean = s / F.nullif(n, F.lit(0))
    variance = F.greatest(sq / F.nullif(n, F.lit(0)) - mean * mean, F.lit(0.0))
    enough = n >= 2
    return (F.when(enough, mean).otherwise(F.lit(0.0)),
            F.when(enough, F.sqrt(variance)).otherwise(F.lit(0.0)))


def rolling_baseline(events: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Per batch, mean and deviation of the sizes in the 10 non-empty batches before it.

    The window runs over one row of moments per batch, never over events.
    """
    per_batch = events.groupBy(batch).agg(*moments())
    # Batches without sizes keep their place but add nothing and take no slot of the ten.
    filled = F.when(F.col("n") > 0, 1).otherwise(0)
    numbered = per_batch.withColumn(
        "_slot", F.sum(filled).over(W.orderBy(batch).rowsBetween(W.unboundedPreceding, W.currentRow)) - filled)
    before = W.orderBy("_slot").rangeBetween(-V.BASELINE_BATCHES, -1)
    totals = [F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("n", "s", "sq")]
    summed = numbered.select(batch, *totals)
    mean, std = mean_and_std(F.col("n"), F.col("s"), F.col("sq"))
    return summed.select(
        batch, F.col("n").alias("baseline_rows"), mean.alias("baseline_mean"), std.alias("baseline_std"))


def score_in_batches(events: DataFrame, batch: str = "batch_id") -> DataFrame:
    """What the stream computes, as one batch job over events that carry their batch number."""
    # Written out, the baseline has a known size (one row per batch), so that Spark can tell
    # that it may be broadcast instead of shuffling the events by their few batch numbers.
    baseline = durable(rolling_baseline(events, batch), "baseline")
    joined = enrich_events(events).join(baseline, batch)
    return score_events(joined, F.col("baseline_mean"), F.col("baseline_std"))


def stream_alerts(scored: DataFrame) -> DataFrame:
    return scored.filter(is_alert())


def batch_metrics() -> list[Column]:
    """Events, alerts and alerts per severity."""
    by_severity = [
        F.count_if(F.col("severity") == name).alias(name.lower())
        for name, _ in V.SEVERITY_THRESHOLDS
    ]
    return [F.count(F.lit(1)).alias("events"), F.count_if(is_alert()).alias("alerts"), *by_severity]


def event_time_baseline(
    events: DataFrame, window: str = "5 minutes", slide: str = "30 seconds", late: str = "10 minutes"
) -> DataFrame:
    """Moments of the response size per sliding event-time window.

    ``event_time`` must be a TIMESTAMP, which watermarks need. On a stream a window is
    emitted once the watermark has passed its end.
    """
    grouped = events.withWatermark("event_time", late).groupBy(
        F.window("event_time", window, slide).alias("w")).agg(*moments())
    mean, std = mean_and_std(F.col("n"), F.col("s"), F.col("sq"))
    return grouped.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        F.col("n").alias("events"), mean.alias("mean_bytes"), std.alias("std_bytes"))
