"""Scoring events by event time: each event meets the window that closed last before it, on the stream itself.

The windowed baseline and the events are two branches of one stream, joined within an interval.
Both carry the watermark, so the join drops an event once no window for it can still come, and
a window once its events are past.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.functions.timekeys import MICROS, epoch_micros
from logwarden.streaming.scoring import enrich_events, mean_and_std, moments, score_events

WINDOW_SECONDS, SLIDE_SECONDS = 300, 30

#: A window is sent to so many parts of its slot, so that the events of one slot are spread over as many tasks.
SALTS = 32


def score_by_event_time(
    events: DataFrame, late: str = "10 minutes", window_seconds: int = WINDOW_SECONDS,
    slide_seconds: int = SLIDE_SECONDS, salts: int = SALTS,
) -> DataFrame:
    """Events scored against the moments of the sizes in the ``window_seconds`` before their slot.

    ``events`` have row_id and event_time (a wall clock); a slot is ``slide_seconds`` long, and its
    baseline is the window that ends where it begins. An event comes out when that window is
    closed. Events without a time, and events whose window holds none, have no baseline and are left out.
    """
    timed = events.where(F.col("event_time").isNotNull()).withColumn(
        "happened", F.timestamp_micros(epoch_micros(F.col("event_time")))).withWatermark("happened", late)
    window = F.window("happened", f"{window_seconds} seconds", f"{slide_seconds} seconds")
    grouped = timed.groupBy(window.alias("w")).agg(*moments())
    mean, std = mean_and_std(F.col("n"), F.col("s"), F.col("sq"))
    slot = lambda time: F.floor(F.unix_micros(time) / F.lit(slide_seconds * MICROS))
    baseline = grouped.select(
        F.window_time("w").alias("closed_at"), slot(F.col("w.end")).alias("after"), F.col("n").alias("baseline_rows"),
        mean.alias("baseline_mean"), std.alias("baseline_std"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("part"))
    dealt = enrich_events(timed).withColumns({
        "slot": slot(F.col("happened")), "salt": F.pmod(F.xxhash64("row_id"), F.lit(salts)).cast("int")})
    # the slot says it all; the interval tells Spark for how long to keep either side
    near = (F.col("slot") == F.col("after")) & (F.col("salt") == F.col("part")) & (
        F.col("happened") > F.col("closed_at")) & (
        F.col("happened") <= F.col("closed_at") + F.expr(f"interval {slide_seconds} seconds"))
    joined = dealt.join(baseline, near).drop("happened", "closed_at", "slot", "salt", "after", "part")
    return score_events(joined, F.col("baseline_mean"), F.col("baseline_std"))
