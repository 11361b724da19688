"""Fitted models kept by version, to score later rows, on a stream or in a batch, as the fit scored its own."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden import fixed_values as V
from logwarden.functions.scoring import standardized
from logwarden.operators.durable import durable
from logwarden.operators.isolation_forest import NODE_SCHEMA, fit_forest, forest_anomaly
from logwarden.operators.quantile import exact_quantile

SETTINGS = "columns array<string>, means array<double>, stds array<double>, psi int, threshold double, rows long"


@dataclass(frozen=True)
class ForestModel:
    """Standard scores, an isolation forest over them and the score below which a row is flagged."""

    nodes: DataFrame
    columns: list[str]
    means: list[float]
    stds: list[float]
    psi: int
    threshold: float
    rows: int

    def inputs(self) -> dict[str, Column]:
        """Standard scores by the moments of the fit, to the digits the models see."""
        return {f"{c}_scaled": F.round(standardized(F.col(c), F.lit(m), F.lit(s)), V.MODEL_PLACES)
                for c, m, s in zip(self.columns, self.means, self.stds)}

    def score(self, features: DataFrame) -> DataFrame:
        """The rows with isolation_forest_score and isolation_forest_flag; streaming frames stay streaming.

        The nodes are broadcast (their number is bounded by the settings of the forest), and a row
        needs nothing but itself, so no state is kept and nothing is shuffled.
        """
        scaled = features.withColumns(self.inputs())
        names = [f"{c}_scaled" for c in self.columns]
        score = F.round(-forest_anomaly(self.nodes, self.psi, names), V.SCORE_PLACES)
        return scaled.withColumn("isolation_forest_score", score).drop(*names).withColumn(
            "isolation_forest_flag", F.coalesce(F.col("isolation_forest_score") < F.lit(self.threshold), F.lit(False)))


def fit_model(
    features: DataFrame, columns: Sequence[str] = V.FEATURE_COLUMNS, contamination: float = V.CONTAMINATION
) -> ForestModel:
    """Fit on rows with row_id and finite features; raises ValueError without rows."""
    columns = list(columns)
    found = features.agg(
        F.count(F.lit(1)).alias("rows"), F.array(*map(F.avg, columns)).alias("means"),
        F.array(*map(F.stddev_pop, columns)).alias("stds")).first()
    if not found["rows"]:
        raise ValueError("no rows to fit a model on")
    bare = ForestModel(features, columns, found["means"], found["stds"], 0, 0.0, found["rows"])
    scaled = durable(features.withColumns(bare.inputs()).select("row_id", *bare.inputs()), "scaled")
    names = [f"{c}_scaled" for c in columns]
    nodes, psi = fit_forest(scaled, names, total=found["rows"])
    nodes = durable(nodes, "forest-nodes")
    scores = durable(scaled.select(F.round(-forest_anomaly(nodes, psi, names), V.SCORE_PLACES).alias("s")), "forest")
    threshold = exact_quantile(scores, "s", contamination)
    return ForestModel(nodes, columns, found["means"], found["stds"], psi, threshold, found["rows"])


def versions(spark: SparkSession, path: str) -> list[int]:
    """Saved versions, oldest first. A version is there once its settings are, which are written last."""
    try:
        found = spark.read.schema(f"{SETTINGS}, version int").parquet(f"{path}/settings")
    except AnalysisException:
        return []
    return [r["version"] for r in found.select("version").distinct().orderBy("version").collect()]


def save_model(model: ForestModel, path: str) -> int:
    """Write the model as the next version and return its number; nothing saved before is changed."""
    spark = model.nodes.sparkSession
    version = max(versions(spark, path), default=-1) + 1
    # a version whose settings were never written is not one, so its nodes are written over
    model.nodes.write.mode("overwrite").parquet(f"{path}/nodes/version={version}")
    row = (model.columns, [float(m) for m in model.means], [float(s) for s in model.stds], model.psi, model.threshold, model.rows)
    spark.createDataFrame([row], SETTINGS).coalesce(1).write.mode("errorifexists").parquet(f"{path}/settings/version={version}")
    return version


def load_model(spark: SparkSession, path: str, version: int | None = None) -> ForestModel:
    """A saved version, the newest by default; raises ValueError if it is not there."""
    held = versions(spark, path)
    version = (held[-1] if held else -1) if version is None else version
    if version not in held:
        raise ValueError(f"no model version {version} in {path}")
    row = spark.read.schema(SETTINGS).parquet(f"{path}/settings/version={version}").first()
    nodes = spark.read.schema(NODE_SCHEMA).parquet(f"{path}/nodes/version={version}")
    return ForestModel(nodes, *(row[c] for c in ("columns", "means", "stds", "psi", "threshold", "rows")))
