"""Features of each address on a stream, equal to the batch features on closed time.

Requests wait in keyed state, by group of addresses and minute. Once the watermark has passed the
end of a minute no request of it can come any more; a timer then emits its requests with their
trailing totals. A group holds many addresses, because every call between Python and the state store
has its price: minutes are read and written whole, and all addresses of a group are summed at once.
At most an hour of minutes is closed in one step, so a step reads two hours of a group. Minutes are
removed an hour later, whether or not their addresses are heard of again, so state never holds more
than an hour and the allowed delay.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from logwarden import fixed_values as V
from logwarden.functions import text
from logwarden.functions.scoring import guarded_ratio
from logwarden.functions.timekeys import MICROS, epoch_micros, wall_clock
from logwarden.operators.hot_features import NULL_ADDRESS

#: Requests are kept and emitted by the minute; every frame is a whole number of minutes.
SLOT_SECONDS = V.MINUTE_SECONDS
SLOT_MICROS, SLOT_MILLIS = SLOT_SECONDS * MICROS, SLOT_SECONDS * 1000
KEPT_SLOTS = V.HOUR_SECONDS // SLOT_SECONDS
#: Groups that addresses are dealt to; a checkpoint holds for one number only.
GROUPS = 256

STREAM_FEATURES = [
    "requests_per_minute", "post_login_rate", "error_rate_5min", "unique_urls_per_hour",
    "avg_response_bytes_ratio", "suspicious_param_rate",
]
MEASURES = ["post", "err", "susp", "size", "sized"]
#: Trailing totals that the features need: name, measure, frame.
TOTALS = [
    ("n60", "n", V.MINUTE_SECONDS), ("n300", "n", V.FIVE_MINUTES_SECONDS), ("n1800", "n", V.HALF_HOUR_SECONDS),
    ("post300", "post", V.FIVE_MINUTES_SECONDS), ("err300", "err", V.FIVE_MINUTES_SECONDS),
    ("susp1800", "susp", V.HALF_HOUR_SECONDS), ("size3600", "size", V.HOUR_SECONDS),
    ("sized3600", "sized", V.HOUR_SECONDS),
]
COLUMNS = ["address", "at", "row_id", "post", "err", "susp", "size", "sized", "path"]


def running(values: np.ndarray) -> np.ndarray:
    """Totals of the first 0, 1, 2, ... values. Sums may exceed a long, Python's integers cannot."""
    if len(values) and max(abs(int(values.max())), abs(int(values.min()))) * len(values) >= 2**63:
        values = values.astype(object)
    return np.concatenate(([0], np.cumsum(values)))


def trailing(rows: dict[str, list], now: np.ndarray) -> pd.DataFrame:
    """The requests marked ``now`` with their trailing totals over all rows of their address.

    In the order of address and time a frame is a run of rows, and its total is the difference of two
    running totals. A path's requests form runs without a gap over an hour: those begun until a request
    less those ended before its hour are the different paths in it.
    """
    hour = V.HOUR_SECONDS * MICROS
    address, path = pd.factorize(np.array(rows["address"], object))[0], pd.factorize(np.array(rows["path"], object))[0]
    at = np.array(rows["at"], np.int64)
    order = np.lexsort((at, address))
    address, path, at, now = address[order], path[order], at[order], now[order]
    measured = {m: np.array(rows[m], np.int64)[order] for m in MEASURES}
    sums = {"n": np.arange(len(at) + 1), **{m: running(v) for m, v in measured.items()}}

    passed = at - at.min()
    width = int(passed.max()) + 1
    place = address * width + passed
    asked = np.flatnonzero(now)
    last = np.searchsorted(place, place[asked], "right")

    def first(micros: int) -> np.ndarray:
        return np.searchsorted(place, address[asked] * width + np.maximum(passed[asked] - micros, 0), "left")

    back = {seconds: first(seconds * MICROS) for seconds in {seconds for _, _, seconds in TOTALS}}
    out = {
        "row_id": [rows["row_id"][i] for i in order[asked]], "address": [rows["address"][i] for i in order[asked]],
        "at": at[asked], "size": pd.array(np.where(measured["sized"][asked] > 0, measured["size"][asked], 0), "Int64")}
    out["size"][measured["sized"][asked] == 0] = pd.NA
    for name, measure, seconds in TOTALS:
        total = sums[measure][last] - sums[measure][back[seconds]]
        out[name] = total.astype(float) if measure == "size" else total

    by_path = np.lexsort((at, path, address))
    follows = (np.diff(address[by_path]) == 0) & (np.diff(path[by_path]) == 0) & (np.diff(at[by_path]) <= hour)
    opens, closes = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    opens[by_path], closes[by_path] = np.r_[True, ~follows], np.r_[~follows, True]
    opens, closes = running(opens * (path >= 0)), running(closes * (path >= 0))
    start = np.searchsorted(address, address[asked], "left")
    out["urls3600"] = opens[last] - opens[start] - (closes[back[V.HOUR_SECONDS]] - closes[start])
    return pd.DataFrame(out)


class TrailingTotals(StatefulProcessor):
    """State of a group of addresses: requests by minute, and an index of its minutes, open and closed.

    The index is one value, read and written once a batch. One timer is set for the next minute
    to close, or, when none is open, for the time at which the last closed one is of no more use.
    """

    def __init__(self, key_type: str) -> None:
        self.row_schema = (f"address array<string>, at array<long>, row_id array<{key_type}>, post array<int>, err array<int>, "
                           "susp array<int>, size array<long>, sized array<int>, path array<string>")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getMapState("rows", "slot long", self.row_schema)
        self.index = handle.getValueState("index", "open array<long>, closed array<long>")

    def _index(self) -> tuple[set[int], set[int]]:
        found = self.index.get()
        return (set(found[0]), set(found[1])) if found else (set(), set())

    def _leave(self, open_: set[int], closed: set[int]) -> None:
        if open_ or closed:
            self.index.update((sorted(open_), sorted(closed)))
            due = min(open_) + 1 if open_ else max(closed) + 1 + KEPT_SLOTS + 1
            self.handle.registerTimer(due * SLOT_MILLIS)
        else:
            self.index.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        open_, closed = self._index()
        added: dict[int, list[list]] = {}
        for frame in rows:
            frame = frame.iloc[np.argsort(frame["at"].to_numpy(), kind="stable")]
            slots, begins = np.unique(frame["at"].to_numpy() // SLOT_MICROS, return_index=True)
            columns = [c.astype(object).where(c.notna(), None).tolist() if c.hasnans else c.tolist()
                       for c in (frame[name] for name in COLUMNS)]
            for slot, begin, end in zip(slots.tolist(), begins, [*begins[1:], len(frame)]):
                held = added.setdefault(slot, [[] for _ in COLUMNS])
                for values, new in zip(held, columns):
                    values += new[begin:end]
        for slot, new in added.items():
            before = self.rows.getValue((slot,)) if slot in open_ else [[]] * len(COLUMNS)
            self.rows.updateValue((slot,), tuple([*old, *values] for old, values in zip(before, new)))
            open_.add(slot)
        self._leave(open_, closed)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() // SLOT_MILLIS  # minutes before this one are over
        open_, closed = self._index()
        due, minutes = sorted(s for s in open_ if s < passed), {}
        while due:
            closing = [s for s in due if s < due[0] + KEPT_SLOTS]
            needed = [s for s in sorted(closed.union(closing)) if due[0] - KEPT_SLOTS <= s <= closing[-1]]
            minutes = {s: minutes[s] if s in minutes else self.rows.getValue((s,)) for s in needed}
            together = {c: [v for s in needed for v in minutes[s][i]] for i, c in enumerate(COLUMNS)}
            now = np.repeat(np.isin(needed, closing), [len(minutes[s][0]) for s in needed])
            yield trailing(together, now)
            closed.update(closing)
            open_.difference_update(closing)
            due = due[len(closing):]
        # the next minute to close is not before ``passed`` and looks back by KEPT_SLOTS at most
        for slot in [s for s in closed if s < passed - KEPT_SLOTS]:
            closed.remove(slot)
            self.rows.removeKey((slot,))
        self._leave(open_, closed)

    def close(self) -> None:
        pass


def stream_features(clean: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """(row_id, ip_address, event_time, features) of each request once its minute is closed.

    ``clean`` is a cleaned log with row_id, streaming. Requests later than the ``delay`` are left
    out, as are those without a time; missing addresses form one group. On a stream
    the state store must be RocksDB (see ``rocksdb_state``).
    """
    path = F.col("base_url")
    events = clean.where(F.col("event_time").isNotNull()).withColumn("at", epoch_micros(F.col("event_time"))).select(
        F.coalesce("ip_address", F.lit(NULL_ADDRESS)).alias("address"), "row_id", "at",
        F.timestamp_micros("at").alias("happened"),  # watermarks need a TIMESTAMP; this one knows no zone
        text.is_post_login(path, F.col("method")).alias("post"), text.is_error(F.col("status_code")).alias("err"),
        F.col("has_suspicious_params").alias("susp"), F.coalesce("response_bytes", F.lit(0).cast("long")).alias("size"),
        F.col("response_bytes").isNotNull().cast("int").alias("sized"), path.alias("path"))
    dealt = events.withColumn("group", F.pmod(F.xxhash64("address"), F.lit(GROUPS)))
    key_type = clean.schema["row_id"].dataType.simpleString()
    totals = ", ".join(f"{name} {'double' if measure == 'size' else 'long'}" for name, measure, _ in TOTALS)
    held = dealt.withWatermark("happened", delay).groupBy("group").transformWithStateInPandas(
        statefulProcessor=TrailingTotals(key_type), outputMode="Append", timeMode="EventTime",
        outputStructType=f"row_id {key_type}, address string, at long, size long, {totals}, urls3600 long")
    mean_size = F.col("size3600") / F.nullif(F.col("sized3600"), F.lit(0))
    return held.select(
        "row_id", F.nullif(F.col("address"), F.lit(NULL_ADDRESS)).alias("ip_address"), wall_clock(F.col("at")).alias("event_time"),
        F.col("n60").alias("requests_per_minute"), F.col("post300").alias("post_login_rate"),
        (F.col("err300") / F.col("n300")).alias("error_rate_5min"), F.col("urls3600").cast("int").alias("unique_urls_per_hour"),
        guarded_ratio(F.col("size"), mean_size).alias("avg_response_bytes_ratio"),
        (F.col("susp1800") / F.col("n1800")).alias("suspicious_param_rate"))


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB; the session's setting is put back after."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def start_features(
    clean: DataFrame, path: str, checkpoint: str, delay: str = "10 minutes", interval: str | None = None
) -> StreamingQuery:
    """Append the features to Parquet files, each once whatever fails in between.

    With an ``interval`` it keeps running; without, it stops when the input is used up.
    """
    with rocksdb_state(clean.sparkSession):
        return (stream_features(clean, delay).writeStream.format("parquet").outputMode("append")
                .option("path", path).option("checkpointLocation", checkpoint)
                .trigger(**({"processingTime": interval} if interval else {"availableNow": True})).start())
