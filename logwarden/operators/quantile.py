"""Exact quantiles in two reads, and the contamination threshold built on them.

A built-in exact percentile holds every distinct value in one task. Here one read makes a mergeable
rank summary that brackets both ranks a quantile needs, and a second one counts what lies below the
bracket and writes the values within it, with their counts: well under a thousandth of the
rows, however many there are. The ranks are then looked up in that small table.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from logwarden import fixed_values as V
from logwarden.operators.durable import durable

SMALL_ROWS = 100_000
#: The summary is off by a share of 1 / _ACCURACY of the ranks at most; the bracket is wider than that on either side.
_ACCURACY, _SLACK = 10_000, 4.0 / 10_000
#: Parts into which a table of distinct values that is too long to list is cut again.
_CUTS = 200


def _at_ranks(values: DataFrame, ranks: list[int], small_rows: int) -> list[float]:
    """The values at some ranks (from 0) of a written table (v, n) of distinct values and their counts."""
    size = values.count()
    if size <= small_rows:
        rows = values.agg(F.sort_array(F.collect_list(F.struct("v", "n"))).alias("all")).first()["all"]
        found, passed, wanted = [], 0, list(ranks)
        for row in rows:
            passed += row["n"]
            while wanted and wanted[0] < passed:
                found.append(row["v"])
                wanted.pop(0)
        return found
    shares = [i / _CUTS for i in range(1, _CUTS)]
    cuts = sorted(set(values.agg(F.percentile_approx("v", shares, _ACCURACY).alias("c")).first()["c"]))
    part = sum((F.when(F.col("v") > c, 1).otherwise(0) for c in cuts), F.lit(0))
    held = {r["part"]: r["n"] for r in values.groupBy(part.alias("part")).agg(F.sum("n").alias("n")).collect()}
    found = []
    for rank in ranks:
        passed = 0
        for p in sorted(held):
            if rank < passed + held[p]:
                inside = durable(values.where(part == p), "quantile")
                found += _at_ranks(inside, [rank - passed], small_rows)
                break
            passed += held[p]
    return found


def exact_quantile(
    df: DataFrame, column: str, share: float, small_rows: int = SMALL_ROWS
) -> float | None:
    """Quantile with linear interpolation over the non-NULL values; reads ``df`` twice."""
    values = df.select(F.col(column).cast("double").alias("v")).filter("v IS NOT NULL")
    around = [max(share - _SLACK, 0.0), min(share + _SLACK, 1.0)]
    summary = values.agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx("v", around, _ACCURACY).alias("b"),
        F.min("v").alias("low"), F.max("v").alias("high")).first()
    total = summary["n"]
    if total == 0:
        return None
    position = share * (total - 1)
    below, above = math.floor(position), math.ceil(position)
    # among fewer rows than the summary keeps, a step of one rank may be wider than the bracket
    low, high = summary["b"] if total > _ACCURACY else (summary["low"], summary["high"])
    seen = Observation()
    inside = values.observe(seen, F.count_if(F.col("v") < F.lit(low)).alias("below")).where(
        (F.col("v") >= F.lit(low)) & (F.col("v") <= F.lit(high)))
    counted = durable(inside.groupBy("v").agg(F.count(F.lit(1)).alias("n")), "quantile")
    before = seen.get["below"]
    first, last = _at_ranks(counted, [below - before, above - before], small_rows)
    return first if position == below else first + (last - first) * (position - below)


def contamination_flag(
    df: DataFrame, score: str, flag: str, share: float = V.CONTAMINATION
) -> DataFrame:
    """Flags the rows whose score is strictly below the ``share`` quantile (lower is worse)."""
    threshold = exact_quantile(df, score, share)
    return df.withColumn(flag, F.coalesce(F.col(score) < F.lit(threshold), F.lit(False)))
