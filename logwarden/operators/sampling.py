"""Samples that depend on the row key and a seed only, not on the partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_rank(seed: int, row_id: str = "row_id") -> Column:
    return F.md5(F.concat(F.lit(f"{seed}-"), F.col(row_id).cast("string")))


def hash_sample(df: DataFrame, rows: int, seed: int, total: int | None = None) -> DataFrame:
    """The ``rows`` rows with the smallest key hash, in hash order.

    Rows whose hash cannot be among the smallest, judging by the ``total`` number of rows,
    are filtered out first, so that the final top-k sees a few multiples of ``rows``
    instead of ``rows`` candidates from every partition.
    """
    ranked = df.withColumn("_hash", hash_rank(seed))
    total = df.count() if total is None else total
    if total > 20 * rows:
        bound = f"{int(16**12 * 4 * rows / total):012x}"
        likely = ranked.filter(F.col("_hash") < bound)
        if len(likely.select(F.lit(1)).head(rows)) == rows:
            ranked = likely
    return ranked.orderBy("_hash", "row_id").limit(rows).drop("_hash")
