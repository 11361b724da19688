"""Standard scaling and the z-score baseline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden import fixed_values as V
from logwarden.functions.scoring import any_above, name_of_largest, sanitized, standardized


def sanitize_features(df: DataFrame, columns: Sequence[str] = V.FEATURE_COLUMNS) -> DataFrame:
    return df.withColumns({c: sanitized(F.col(c)) for c in columns})


def zscores(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """Z-score per column. Means and population deviations come from one aggregate whose
    single row becomes constants of the plan, so scoring needs no join."""
    moments = df.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns],
        *[F.stddev_pop(c).alias(f"{c}_std") for c in columns],
    ).first()
    return {
        c: standardized(F.col(c), F.lit(moments[f"{c}_mean"]), F.lit(moments[f"{c}_std"]))
        for c in columns
    }


def standard_scale(
    df: DataFrame, columns: Sequence[str] = V.FEATURE_COLUMNS, suffix: str = "_scaled"
) -> DataFrame:
    return df.withColumns({c + suffix: z for c, z in zscores(df, columns).items()})


def zscore_baseline(df: DataFrame, columns: Sequence[str] = V.ZSCORE_FEATURES) -> DataFrame:
    """Adds max_zscore, zscore_flag and top_flag, the feature behind the largest deviation."""
    distance = {c: F.abs(z) for c, z in zscores(df, columns).items()}
    staged = df.withColumns({f"_z_{c}": d for c, d in distance.items()})
    staged_distance = {c: F.col(f"_z_{c}") for c in columns}
    flagged = staged.withColumns({
        "max_zscore": F.greatest(*staged_distance.values()),
        "zscore_flag": any_above(list(staged_distance.values()), V.ZSCORE_LIMIT),
    })
    reason = F.when(F.col("zscore_flag"), name_of_largest(staged_distance))
    return (flagged.withColumn("top_flag", F.coalesce(reason, F.lit(V.NO_SINGLE_REASON)))
            .drop(*[f"_z_{c}" for c in columns]))
