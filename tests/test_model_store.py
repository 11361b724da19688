"""Models saved and loaded: the same flags elsewhere, in a batch and on a stream."""

import pytest
from pyspark.sql import functions as F

from logwarden import fixed_values as V
from logwarden.operators.durable import durable
from logwarden.operators.isolation_forest import fit_forest, forest_anomaly
from logwarden.operators.quantile import contamination_flag
from logwarden.plans.model_store import fit_model, load_model, save_model, versions
from logwarden.plans.pipeline import model_inputs
from tests.test_detectors import planted


@pytest.fixture(scope="module")
def features(spark):
    return durable(spark.createDataFrame(planted()), "features")


def flags(frame):
    return sorted((r.row_id, r.isolation_forest_score, r.isolation_forest_flag) for r in frame.select(
        "row_id", "isolation_forest_score", "isolation_forest_flag").collect())


def test_saved_model_flags_as_the_fit_does(spark, features, tmp_path):
    scaled, names = model_inputs(features)
    nodes, psi = fit_forest(scaled, names)
    score = F.round(-forest_anomaly(nodes, psi, names), V.SCORE_PLACES)
    want = flags(contamination_flag(
        durable(scaled.select("row_id", score.alias("isolation_forest_score")), "f"), "isolation_forest_score", "isolation_forest_flag"))
    path = f"{tmp_path}/model"
    assert save_model(fit_model(features), path) == 0
    loaded = load_model(spark, path)
    assert flags(loaded.score(features)) == want
    features.write.parquet(f"{tmp_path}/in")
    stream = loaded.score(spark.readStream.schema(features.schema).option("maxFilesPerTrigger", "1").parquet(f"{tmp_path}/in"))
    (stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())
    assert flags(spark.read.parquet(f"{tmp_path}/out")) == want


def test_versions(spark, features, tmp_path):
    path = f"{tmp_path}/model"
    assert versions(spark, path) == []
    with pytest.raises(ValueError, match="no model version"):
        load_model(spark, path)
    some = fit_model(features.where("row_id % 2 = 0"), V.FEATURE_COLUMNS[:3], contamination=0.3)
    assert [save_model(m, path) for m in (fit_model(features), some)] == [0, 1]
    assert versions(spark, path) == [0, 1]
    assert load_model(spark, path).columns == V.FEATURE_COLUMNS[:3]
    assert load_model(spark, path, 0).columns == V.FEATURE_COLUMNS
    assert load_model(spark, path, 0).threshold != load_model(spark, path, 1).threshold
    # nodes without settings, as a crash leaves them, are no version and are written over
    some.nodes.write.parquet(f"{path}/nodes/version=2")
    assert versions(spark, path) == [0, 1] and save_model(some, path) == 2
    with pytest.raises(ValueError, match="no rows"):
        fit_model(features.limit(0))
