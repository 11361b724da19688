"""A log of alerts that stays in few files, with report state that is folded, not rescanned.

Every batch adds two small tables: its alerts, and their counts by address, severity, attack type
and hour. Which tables count is said by a manifest, a new version of which is one small file that
appears as a whole or not at all. So a batch, or a compaction, takes effect in one step: whatever a
crash leaves behind without a manifest that names it does not exist for readers. Compaction puts
many small tables of one kind into one; counts are folded, so their size follows the different
addresses, not the alerts.
"""

from __future__ import annotations

import uuid
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from logwarden import fixed_values as V
from logwarden.functions.scoring import percent
from logwarden.functions.text import parse_event_time

ALERTS, COUNTS = "alerts", "counts"
ENTRY = "kind string, path string, run string, first_batch long, last_batch long, rows long"
KEYS = ["ip_address", "severity", "attack_type", "hour_of_day"]


@dataclass(frozen=True)
class Entry:
    """A table of the log: the alerts, or the counts, of some batches of a run."""

    kind: str
    path: str
    run: str
    first_batch: int
    last_batch: int
    rows: int


class AlertLog:
    """One writer appends and compacts; any number of readers go by the newest manifest."""

    def __init__(self, spark: SparkSession, root: str, every: int = 16, file_rows: int = 1_000_000) -> None:
        """``every`` small tables are put into one; a table of ``file_rows`` alerts is left as it is."""
        self.spark, self.root, self.every, self.file_rows = spark, root, every, file_rows
        self.version, self.entries = self._newest()

    def _newest(self) -> tuple[int, list[Entry]]:
        try:
            found = self.spark.read.schema(f"{ENTRY}, version long").parquet(f"{self.root}/manifest")
        except AnalysisException:
            return -1, []
        newest = found.agg(F.max("version")).first()[0]
        if newest is None:
            return -1, []
        rows = found.where(F.col("version") == newest).drop("version").collect()
        return newest, [Entry(**r.asDict()) for r in rows]

    def _commit(self, entries: list[Entry]) -> None:
        rows = self.spark.createDataFrame([asdict(e) for e in entries], ENTRY)
        rows.coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/manifest/version={self.version + 1}")
        self.version, self.entries = self.version + 1, entries

    def _write(self, frame: DataFrame, kind: str) -> tuple[str, int]:
        path = f"{self.root}/{kind}/{uuid.uuid4().hex}"
        seen = Observation()
        frame.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
        return path, seen.get["rows"]

    def _of(self, run: str, batch: int) -> list[Entry]:
        return [e for e in self.entries if e.run == run and e.first_batch <= batch <= e.last_batch]

    def holds_compacted(self, run: str, batch: int) -> bool:
        return any(e.first_batch < e.last_batch for e in self._of(run, batch))

    def append(self, alerts: DataFrame, run: str, batch: int) -> bool:
        """Add the alerts of a batch. One that is run again replaces itself; False if it is part of a
        compacted table already, and so surely whole."""
        mine = self._of(run, batch)
        if self.holds_compacted(run, batch):
            return False
        path, rows = self._write(alerts, ALERTS)
        counts, cells = self._write(count_alerts(self.spark.read.schema(alerts.schema).parquet(path)), COUNTS)
        self._commit([*(e for e in self.entries if e not in mine),
                      Entry(ALERTS, path, run, batch, batch, rows), Entry(COUNTS, counts, run, batch, batch, cells)])
        return True

    def compact(self) -> None:
        """Put the small tables of each run and kind into one where there are ``every`` of them or more."""
        entries = list(self.entries)
        for run, kind in sorted({(e.run, e.kind) for e in entries}):
            small = sorted((e for e in entries if (e.run, e.kind) == (run, kind) and (kind == COUNTS or e.rows < self.file_rows)),
                           key=lambda e: e.first_batch)
            if len(small) < self.every:
                continue
            frame = self.spark.read.parquet(*[e.path for e in small])
            rows = sum(e.rows for e in small)
            frame = fold(frame) if kind == COUNTS else frame.coalesce(max(1, -(-rows // self.file_rows)))
            path, rows = self._write(frame, kind)
            whole = Entry(kind, path, run, small[0].first_batch, small[-1].last_batch, rows)
            entries = [*(e for e in entries if e not in small), whole]
        if entries != self.entries:
            self._commit(entries)

    def _read(self, kind: str, schema: str) -> DataFrame:
        paths = [e.path for e in self.entries if e.kind == kind]
        return self.spark.read.parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def alerts(self) -> DataFrame:
        return self._read(ALERTS, "ip_address string, severity string, threat_score int, attack_type string, timestamp string")

    def counts(self) -> DataFrame:
        """The folded counts: one row per address, severity, attack type and hour."""
        return fold(self._read(COUNTS, COUNTS_SCHEMA))


COUNTS_SCHEMA = ("ip_address string, severity string, attack_type string, hour_of_day int, alerts long, "
                 "max_threat_score int, first timestamp_ntz, last timestamp_ntz")


def count_alerts(alerts: DataFrame) -> DataFrame:
    """Counts of alerts that can be added up: alerts, highest score, first and last time of each cell."""
    timed = alerts.withColumn("event_time", parse_event_time(F.col("timestamp"))).withColumn("hour_of_day", F.hour("event_time"))
    return timed.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("alerts"), F.max("threat_score").alias("max_threat_score"),
        F.min("event_time").alias("first"), F.max("event_time").alias("last"))


def fold(counts: DataFrame) -> DataFrame:
    return counts.groupBy(*KEYS).agg(
        F.sum("alerts").alias("alerts"), F.max("max_threat_score").alias("max_threat_score"),
        F.min("first").alias("first"), F.max("last").alias("last"))


# --- Reports from the counts, equal to those over the alerts -------------------------------

def severity_summary(counts: DataFrame) -> DataFrame:
    return (counts.groupBy("severity").agg(F.sum("alerts").alias("alerts"), F.countDistinct("ip_address").alias("unique_ips"))
            .orderBy("severity"))


def top_dangerous_ips(counts: DataFrame, k: int = 10) -> DataFrame:
    return (counts.groupBy("ip_address").agg(
        F.max("max_threat_score").alias("max_threat_score"), F.sum("alerts").alias("alert_count"),
        F.max_by("severity", "max_threat_score").alias("top_severity"))
        .orderBy(F.desc("max_threat_score"), F.desc("alert_count"), "ip_address").limit(k))


def alerts_by(counts: DataFrame, column: str) -> DataFrame:
    return counts.groupBy(column).agg(F.sum("alerts").alias("alert_count")).orderBy(F.desc("alert_count"), column)


def critical_share(counts: DataFrame) -> DataFrame:
    """Alerts, critical ones, their share in percent, and distinct addresses."""
    critical = F.coalesce(F.sum(F.when(F.col("severity") == V.SEVERITY_THRESHOLDS[0][0], F.col("alerts"))), F.lit(0))
    total = F.coalesce(F.sum("alerts"), F.lit(0))
    return counts.agg(total.alias("alerts"), critical.alias("critical"), percent(critical, total).alias("critical_pct"),
                      F.countDistinct("ip_address").alias("unique_ips"))
