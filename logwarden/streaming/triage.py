"""Reaction to new alert files: a file stream that summarises each file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from logwarden.operators.reports import triage_per_file, triage_total

TRIAGE_SCHEMA = T.StructType([
    T.StructField("ip_address", T.StringType()),
    T.StructField("threat_score", T.IntegerType()),
    T.StructField("severity", T.StringType()),
])


def alert_files(spark: SparkSession, path: str) -> DataFrame:
    """Stream of alert rows with the file each came from and its position there."""
    rows = spark.readStream.schema(TRIAGE_SCHEMA).option("recursiveFileLookup", True).parquet(path)
    return rows.select(
        "*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row_id"))


def start_triage(
    alert_rows: DataFrame, root: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Writes a row per file and a total per micro-batch below ``root``, under the run they belong to.

    A run is what one checkpoint belongs to: a query with a new checkpoint writes beside earlier
    ones, a batch that is run again replaces its own output. With an ``interval`` it keeps running and looks for new files that often; without, it stops
    at the end of the files present.
    """

    def triage(batch: DataFrame, batch_id: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        place = f"run={run}/batch_id={batch_id}"
        files_path = f"{root}/files/{place}"
        triage_per_file(batch).write.mode("overwrite").parquet(files_path)
        triage_total(batch.sparkSession.read.parquet(files_path)).write.mode("overwrite").parquet(
            f"{root}/totals/{place}")

    return (alert_rows.writeStream.foreachBatch(triage)
            .option("checkpointLocation", checkpoint)
            .trigger(**({"processingTime": interval} if interval else {"availableNow": True})).start())
