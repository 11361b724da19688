"""Expressions that turn flags and features into scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from logwarden import fixed_values as V


def sanitized(value: Column) -> Column:
    """The value as a double; NULL, NaN and the infinities become 0."""
    number = value.cast("double")
    unusable = number.isNull() | F.isnan(number) | (F.abs(number) == float("inf"))
    return F.when(unusable, 0.0).otherwise(number)


def guarded_ratio(numerator: Column, denominator: Column, otherwise: float = 1.0) -> Column:
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(otherwise))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, 0 for an empty whole."""
    return F.when(whole > 0, part * 100.0 / whole).otherwise(F.lit(0.0))


def standardized(value: Column, mean: Column, std: Column) -> Column:
    """Z-score; a constant column scores 0 everywhere."""
    return F.when(std > 0, (value - mean) / std).otherwise(F.lit(0.0))


def any_above(values: Sequence[Column], limit: float) -> Column:
    return reduce(lambda a, b: a | b, [v > limit for v in values])


def name_of_largest(named: Mapping[str, Column]) -> Column:
    """Name of the largest value; the first name wins a tie."""
    top = F.greatest(*named.values())
    return F.coalesce(*[F.when(v == top, F.lit(name)) for name, v in named.items()])


def weighted_sum(flags: Mapping[str, Column], weights: Mapping[str, int]) -> Column:
    return reduce(
        lambda a, b: a + b, [flags[name].cast("int") * w for name, w in weights.items()]
    )


def severity(score: Column) -> Column:
    label = F
    for name, threshold in V.SEVERITY_THRESHOLDS:
        label = label.when(score >= threshold, name)
    return label.otherwise(V.SEVERITY_FLOOR)


def threat_score() -> Column:
    """Composite 0-100 score of a row that carries the three detector flags."""
    flags = {
        "isolation_forest_flag": F.col("isolation_forest_flag"),
        "lof_flag": F.col("lof_flag"),
        "zscore_flag": F.col("zscore_flag"),
        "is_bot": F.col("is_bot"),
        "mostly_suspicious": F.col("suspicious_param_rate") > V.MOSTLY_SUSPICIOUS_RATE,
    }
    return weighted_sum(flags, V.BATCH_WEIGHTS)


def is_alert() -> Column:
    return F.col("threat_score") >= V.ALERT_THRESHOLD
