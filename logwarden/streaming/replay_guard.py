"""Input that may come twice or too late: repeats are left out, late rows go to a table of their own.

A source that starts again from an older offset sends rows again; a slow sender sends them after
their time is closed. A row is late if its event time lies more than ``delay_seconds`` before the
newest one of earlier batches. Any other row counts once, however often it comes: keys are kept by
batch, and only batches that reach into the delay are looked at. All that a batch writes lies under
its run and number, so a batch that is run again replaces itself and finds what it found before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logwarden.functions.timekeys import MICROS, epoch_micros

STATE = "newest long, oldest_needed long, received long, admitted long, repeats long, late long"


class ReplayGuard:
    """Splits each batch into new, repeated and late rows; ``event_time`` is a wall clock."""

    def __init__(self, root: str, key: Sequence[str], delay_seconds: int) -> None:
        self.root, self.key, self.delay = root, list(key), delay_seconds * MICROS

    def _place(self, kind: str, run: str, batch: int) -> str:
        return f"{self.root}/{kind}/run={run}/batch_id={batch}"

    def admit(self, batch: DataFrame, batch_id: int, run: str = "direct") -> DataFrame:
        """The new rows of a batch, read back from where they are kept. Batches come in order from 0.

        Rows without a time are never late. Of rows with one key in a batch one is new. Raises
        ValueError if an earlier batch left no state.
        """
        spark = batch.sparkSession
        newest, needed = self._before(batch, batch_id, run)
        timed = batch.withColumn("_at", epoch_micros(F.col("event_time")))
        late = F.coalesce(F.col("_at") < F.lit(newest) - self.delay, F.lit(False)) if newest is not None else F.lit(False)
        keys = [F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in self.key]
        timed = timed.withColumns({
            "_mark": F.when(late, "late").otherwise("new"),
            "_key": F.sha2(F.concat_ws("\x01", *keys, F.col("_at").cast("string")), 256)})
        seen = Observation()
        timed = timed.observe(seen, F.count(F.lit(1)).alias("received"))
        known = self._known(batch, batch_id, run, needed)
        if known is not None:
            timed = timed.join(known, "_key", "left").where("_mark = 'late' or _known is null").drop("_known")
        # every late row is kept, of new ones one a key; copies are dropped where they lie before any shuffle
        turn = F.when(F.col("_mark") == "late", F.monotonically_increasing_id()).otherwise(F.lit(-1))
        marked = timed.withColumn("_turn", turn).dropDuplicates(["_key", "_turn"]).drop("_turn")
        kept = self._place("rows", run, batch_id)
        marked.write.mode("overwrite").partitionBy("_mark").parquet(kept)
        found = spark.read.schema(marked.schema).parquet(kept)
        counts = {r["_mark"]: r for r in found.groupBy("_mark").agg(
            F.count(F.lit(1)).alias("n"), F.max("_at").alias("newest")).collect()}
        tops = [t for t in (newest, *(r["newest"] for m, r in counts.items() if m != "late")) if t is not None]
        new, late_ones = (counts[m]["n"] if m in counts else 0 for m in ("new", "late"))
        received = seen.get["received"]
        row = (max(tops, default=None), self._oldest(spark, batch_id, run, newest), received, new, received - new - late_ones, late_ones)
        spark.createDataFrame([row], STATE).coalesce(1).write.mode("overwrite").parquet(self._place("state", run, batch_id))
        return found.where("_mark = 'new'").drop("_at", "_mark", "_key")

    def _state(self, batch: DataFrame, run: str) -> DataFrame:
        return batch.sparkSession.read.schema(f"{STATE}, batch_id long").option(
            "basePath", f"{self.root}/state/run={run}").parquet(f"{self.root}/state/run={run}")

    def _before(self, batch: DataFrame, batch_id: int, run: str) -> tuple[int | None, int]:
        """Newest time of earlier batches, and the first batch whose keys may still be repeated."""
        if batch_id == 0:
            return None, 0
        try:
            row = self._state(batch, run).where(F.col("batch_id") == batch_id - 1).first()
        except AnalysisException:
            row = None
        if row is None:
            raise ValueError(f"no state of the batch before {batch_id} under {self.root}")
        return row["newest"], row["oldest_needed"]

    def _oldest(self, spark: SparkSession, batch_id: int, run: str, newest: int | None) -> int:
        """The first batch that may hold a row within the delay: those before it closed too long ago."""
        if batch_id == 0 or newest is None:
            return 0
        states = spark.read.schema(f"{STATE}, batch_id long").parquet(f"{self.root}/state/run={run}")
        # rows of a batch are no newer than its newest time, so older batches hold late rows only
        past = states.where((F.col("newest") < newest - self.delay) & (F.col("batch_id") < batch_id)).agg(F.max("batch_id")).first()[0]
        return 0 if past is None else past + 1

    def _known(self, batch: DataFrame, batch_id: int, run: str, needed: int) -> DataFrame | None:
        """Keys of the new rows of the batches that still matter."""
        if batch_id == 0:
            return None
        rows = batch.sparkSession.read.option("basePath", f"{self.root}/rows/run={run}").parquet(
            *[self._place("rows", run, b) for b in range(needed, batch_id)])
        return rows.where("_mark = 'new'").select("_key", F.lit(True).alias("_known"))

    def late_rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.root}/rows").where("_mark = 'late'").drop("_at", "_mark", "_key")

    def counts(self, spark: SparkSession) -> DataFrame:
        """Rows received, admitted, repeated and late of every batch."""
        return spark.read.parquet(f"{self.root}/state").select("run", "batch_id", "received", "admitted", "repeats", "late")

    def start(
        self, events: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str, interval: str | None = None
    ) -> StreamingQuery:
        """Run a batch handler, such as ``AlertStream.process_batch``, on the admitted rows of a stream."""
        def guarded(batch: DataFrame, batch_id: int) -> None:
            run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
            handler(self.admit(batch, batch_id, run), batch_id)

        return (events.writeStream.foreachBatch(guarded).option("checkpointLocation", checkpoint)
                .trigger(**({"processingTime": interval} if interval else {"availableNow": True})).start())
