"""Local Outlier Factor (Breunig, Kriegel, Ng, Sander 2000) over all rows.

Every row's neighbours are found among all rows with a distributed join. Distances are Euclidean,
rounded to nine places; equal ones are taken in key order, so each row has exactly ``neighbors``
neighbours and the result does not depend on partitioning. A row is never its own neighbour.

Most neighbours of a row lie in its own group of cells, so reach and density are looked up where the
group's lists are; only what a group needs from others is joined, once for each group and row.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden import fixed_values as V
from logwarden.operators.durable import durable
from logwarden.operators.neighbors import first_copies, neighbor_lists


def exact_lof(
    df: DataFrame, columns: Sequence[str] = V.FEATURE_COLUMNS, neighbors: int = V.LOF_NEIGHBORS
) -> DataFrame:
    """(row_id, lof_score) of every row, each compared with all others.

    A copy of a point beyond the first k + 1 has only copies at distance 0 around it, all
    equally dense, and so a factor of exactly 1; it needs no search.
    """
    columns = list(columns)
    searched = durable(first_copies(df, columns, neighbors + 1), "points")
    k = min(neighbors, searched.count() - 1)
    if k < 1:
        return df.select("row_id", F.lit(-1.0).alias("lof_score"))
    dense = durable(_densities(neighbor_lists(searched, columns, k)), "density")
    around = (
        dense.select("row_id", F.explode("outer").alias("neighbor_id"))
        .join(dense.select(F.col("row_id").alias("neighbor_id"), F.col("density").alias("other")), "neighbor_id")
        .groupBy("row_id").agg(F.sum("other").alias("outside"))
    )
    others = (F.col("inside") + F.coalesce("outside", F.lit(0.0))) / F.lit(k)
    factor = dense.join(around, "row_id", "left").select("row_id", (-others / F.col("density")).alias("lof_score"))
    return (df.select("row_id").join(factor, "row_id", "left")
            .withColumn("lof_score", F.coalesce("lof_score", F.lit(-1.0))))


def _densities(lists: DataFrame) -> DataFrame:
    """(row_id, density, inside, outer): a row's density, the sum of those of its neighbours in its own
    group, and the neighbours of other groups, whose densities are still to be added."""
    key = lists.schema["row_id"].dataType.simpleString()
    needed = lists.select(F.col("group").alias("home"), F.explode("outer").alias("neighbor_id")).distinct()
    kth = lists.select(F.col("row_id").alias("neighbor_id"), F.array_max("distances").alias("kth"))
    fetched = needed.join(kth, "neighbor_id")

    def density(rows: pa.Table, outer: pa.Table) -> pa.Table:
        keys, many = rows["row_id"].combine_chunks(), len(rows)
        distances = pa.compute.list_flatten(rows["distances"]).to_numpy().reshape(many, -1)
        known = pa.concat_arrays([keys, outer["neighbor_id"].combine_chunks().cast(keys.type)])
        kth = np.r_[distances.max(axis=1), outer["kth"].to_numpy()]
        place = pa.compute.index_in(pa.compute.list_flatten(rows["ids"]), value_set=known).to_numpy()
        place = place.reshape(distances.shape)
        reach = np.maximum(distances, kth[place])
        dense = 1.0 / (reach.mean(axis=1) + V.LOF_DENSITY_FLOOR)
        inside = np.r_[dense, np.zeros(len(outer))][place].sum(axis=1)
        return pa.table({"row_id": keys, "density": dense, "inside": inside, "outer": rows["outer"]})

    return lists.groupBy("group").cogroup(fetched.groupBy("home")).applyInArrow(
        density, f"row_id {key}, density double, inside double, outer array<{key}>")
