"""From a raw access log to scored requests and alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden import fixed_values as V
from logwarden.functions.scoring import is_alert, severity, threat_score
from logwarden.operators.durable import durable
from logwarden.operators.features import HOT_ROWS, log_features
from logwarden.operators.ingest import clean_logs
from logwarden.operators.isolation_forest import fit_forest, forest_anomaly
from logwarden.operators.lof import exact_lof
from logwarden.operators.quantile import exact_quantile
from logwarden.operators.scaling import sanitize_features, standard_scale, zscore_baseline

FLAG_SCORES = ["isolation_forest_score", "lof_score"]


def with_threat_score(flagged: DataFrame) -> DataFrame:
    """Composite score and severity of rows that carry the three detector flags."""
    return (flagged.withColumn("threat_score", threat_score())
            .withColumn("severity", severity(F.col("threat_score"))))


def model_inputs(ready: DataFrame) -> tuple[DataFrame, list[str]]:
    """Row keys and the ten standard scores, written once and narrow; the models read them often.

    Six digits: rows that differ by the noise of a sum are copies of each other to the models.
    """
    names = [f"{c}_scaled" for c in V.FEATURE_COLUMNS]
    scaled = standard_scale(ready).select("row_id", *[F.round(c, V.MODEL_PLACES).alias(c) for c in names])
    return durable(scaled, "scaled"), names


def model_scores(ready: DataFrame) -> DataFrame:
    """(row_id, isolation_forest_score, lof_score) of both models over all rows; lower is worse."""
    scaled, names = model_inputs(ready)
    nodes, psi = fit_forest(scaled, names)
    forest = scaled.select("row_id", (-forest_anomaly(nodes, psi, names)).alias("isolation_forest_score"))
    both = forest.join(exact_lof(scaled, names), "row_id")
    return durable(both.select("row_id", *[F.round(c, V.SCORE_PLACES).alias(c) for c in FLAG_SCORES]), "scores")


def detect(features: DataFrame, contamination: float = V.CONTAMINATION) -> DataFrame:
    """Runs the three detectors over all feature rows and adds the composite score.

    Row keys must be unique. The outlier factor compares each row with all others, by a pruned
    search. Written on the way are the features, the models' narrow inputs and their scores.
    What the driver holds is bounded by settings: one row of moments, the forest, the pivots.
    """
    ready = durable(sanitize_features(features), "features")
    scores = model_scores(ready)
    offset = exact_quantile(scores, "isolation_forest_score", contamination)
    lof_limit = exact_quantile(scores, "lof_score", contamination)
    flags = scores.select(
        "row_id",
        F.round(F.col("isolation_forest_score") - F.lit(offset), V.SCORE_PLACES).alias("isolation_forest_score"),
        (F.col("isolation_forest_score") < F.lit(offset)).alias("isolation_forest_flag"),
        "lof_score",
        (F.col("lof_score") < F.lit(lof_limit)).alias("lof_flag"))
    return with_threat_score(zscore_baseline(ready).join(flags, "row_id"))


def score_logs(raw: DataFrame, hot_rows: int | None = HOT_ROWS, keep: Sequence[str] | None = None) -> DataFrame:
    """Raw access log (with a unique ``row_id``) to scored log.

    ``keep`` names the columns of the cleaned log that are wanted beside the key and what the detectors make;
    without it all stay, and go through every exchange and sort.
    """
    features = log_features(clean_logs(raw), hot_rows)
    if keep is not None:
        needed = {"row_id", "is_bot", *keep, *V.FEATURE_COLUMNS}
        features = features.select([c for c in features.columns if c in needed])
    return detect(features)


def alerts(scored: DataFrame) -> DataFrame:
    return scored.filter(is_alert())


def sorted_alerts(scored: DataFrame) -> DataFrame:
    """Alerts, worst first. Time and key in the order keep the sort's ranges even, because
    scores alone have a few dozen values."""
    return alerts(scored).orderBy(F.desc("threat_score"), "event_time", "row_id")
