"""Contracts of the detectors on a dense cluster with planted outliers."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from logwarden import fixed_values as V
from logwarden.operators import reports
from logwarden.operators.durable import durable
from logwarden.operators.isolation_forest import draw, expected_path, fit_forest, forest_anomaly
from logwarden.operators.lof import exact_lof
from logwarden.operators.quantile import contamination_flag, exact_quantile
from logwarden.operators.sampling import hash_sample
from logwarden.operators.scaling import zscore_baseline
from logwarden.plans.pipeline import alerts, detect, sorted_alerts


PROBES = 12


def planted() -> pd.DataFrame:
    """Three regimes of ordinary traffic on a ring of feature values, and a few rows far off it."""
    rng = np.random.default_rng(20)
    angle = rng.uniform(0.0, 6.3, (228, 1)) + np.arange(len(V.FEATURE_COLUMNS))
    ordinary = 3.0 + np.cos(angle) + rng.exponential(0.05, angle.shape)
    strange = rng.uniform(30.0, 60.0, (PROBES, ordinary.shape[1]))
    rows = pd.DataFrame(np.vstack([strange, ordinary]), columns=V.FEATURE_COLUMNS)
    attack = np.arange(len(rows)) < PROBES
    return rows.assign(
        is_bot=attack, attack_type=np.where(attack, "bot_scraper", "normal"),
        row_id=rng.permutation(len(rows)), ip_address="10.0.0.1", event_time=pd.Timestamp("2026-01-01"))


@pytest.fixture(scope="module")
def scored(spark):
    return detect(spark.createDataFrame(planted())).toPandas()


def test_model_scores_follow_from_their_inputs(spark, scored):
    """Factor and share flagged, computed again from the standard scores."""
    features = scored[V.FEATURE_COLUMNS].to_numpy()
    standard = np.round((features - features.mean(axis=0)) / features.std(axis=0), V.MODEL_PLACES)
    order = np.argsort(scored.row_id.to_numpy())
    factor = np.empty(len(scored))
    factor[order] = brute_lof(standard[order], V.LOF_NEIGHBORS)
    assert scored.lof_score.to_numpy() == pytest.approx(factor, abs=1e-6)
    for flag, score in (("lof_flag", "lof_score"), ("isolation_forest_flag", "isolation_forest_score")):
        assert (scored[flag] == (scored[score] < scored[score].quantile(V.CONTAMINATION))).all()


def test_composite_recomputed_row_by_row(scored):
    points = {"isolation_forest_flag": 35, "lof_flag": 35, "zscore_flag": 20, "is_bot": 5}
    for row in scored.itertuples():
        total = sum(p for name, p in points.items() if getattr(row, name)) + (5 if row.suspicious_param_rate > 0.5 else 0)
        steps = [label for label, least in (("CRITICAL", 75), ("HIGH", 50), ("MEDIUM", 25)) if total >= least]
        assert (row.threat_score, row.severity) == (total, (steps or ["NORMAL"])[0])


def test_rows_off_the_ring_lead_the_queue(spark, scored):
    first = scored.sort_values("isolation_forest_score").head(PROBES)
    assert set(first.attack_type) == {"bot_scraper"}
    queue = [r.attack_type for r in sorted_alerts(spark.createDataFrame(scored)).head(PROBES)]
    assert queue == ["bot_scraper"] * PROBES


def test_models_do_not_depend_on_partitioning(spark):
    rows = spark.createDataFrame(planted())
    results = []
    for parts in (1, 17):
        frame = rows.repartition(parts)
        nodes, psi = fit_forest(frame)
        both = frame.select("row_id", forest_anomaly(nodes, psi).alias("anomaly")).join(exact_lof(frame), "row_id")
        results.append(both.toPandas().sort_values("row_id", ignore_index=True))
    pd.testing.assert_frame_equal(*results)
    assert results[0].anomaly.between(0, 1).all()


def test_forest_of_a_large_table(spark):
    rows = spark.range(20000).select(
        F.col("id").alias("row_id"), F.rand(3).alias("a"), F.when(F.col("id") % 100 == 5, 50.0).otherwise(F.rand(4)).alias("b"))
    nodes, psi = fit_forest(rows, ["a", "b"], trees=40, sample_rows=64)
    assert psi == 64 and nodes.select("tree").distinct().count() == 40
    assert nodes.count() <= 40 * 127
    scored = rows.withColumn("anomaly", forest_anomaly(nodes, psi, ["a", "b"]))
    # One row in a hundred is far away; most of them were in no sample.
    far, near = (scored.filter((F.col("b") > 2) == side).agg(F.avg("anomaly")).first()[0] for side in (True, False))
    assert far > near + 0.1


def test_draws_are_spread_and_repeatable():
    drawn = [draw(42, tree, node, "feature") for tree in range(100) for node in range(20)]
    assert drawn == [draw(42, tree, node, "feature") for tree in range(100) for node in range(20)]
    assert 0.0 <= min(drawn) and max(drawn) < 1.0 and np.histogram(drawn, 4, (0, 1))[0].min() > 400


def test_expected_path():
    assert expected_path(np.array([0, 1, 2])).tolist() == [0, 0, 1]
    assert float(expected_path(256)) == pytest.approx(10.24, abs=0.01)


def brute_lof(points: np.ndarray, k: int) -> np.ndarray:
    distance = np.round(np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2)), 9)
    np.fill_diagonal(distance, np.inf)
    near = [sorted(range(len(points)), key=lambda j, i=i: (distance[i, j], j))[:k] for i in range(len(points))]
    kth = np.array([max(distance[i, j] for j in near[i]) for i in range(len(points))])
    density = np.array([
        1 / (np.mean([max(kth[j], distance[i, j]) for j in near[i]]) + 1e-10) for i in range(len(points))])
    return np.array([-np.mean(density[near[i]]) / density[i] for i in range(len(points))])


@pytest.mark.parametrize("copies", [1, 30])
def test_lof_against_all_pairs(spark, copies):
    rng = np.random.default_rng(3)
    points = np.vstack([rng.normal(size=(120, 3)), np.zeros((copies, 3))])
    rows = pd.DataFrame(points, columns=["a", "b", "c"]).assign(row_id=range(len(points)))
    frame = spark.createDataFrame(rows)
    got = exact_lof(frame, ["a", "b", "c"]).toPandas().sort_values("row_id")
    assert got.lof_score.to_numpy() == pytest.approx(brute_lof(points, 20))


def test_lof_of_a_single_row(spark):
    frame = spark.createDataFrame([(1, 2.0)], "row_id long, a double")
    assert exact_lof(frame, ["a"]).first().lof_score == -1.0


def test_zscore_of_constant_columns_is_zero(spark):
    frame = spark.createDataFrame([(1, 2.0, 5.0), (2, 2.0, 5.0)], "row_id long, a double, b double")
    rows = zscore_baseline(frame, ["a", "b"]).collect()
    assert [(r.max_zscore, r.zscore_flag, r.top_flag) for r in rows] == [(0.0, False, "ml_pattern")] * 2


@pytest.mark.parametrize("share", [0.0, 0.1, 0.5, 0.937, 1.0])
@pytest.mark.parametrize("shape", ["spread", "tied"])
def test_exact_quantile_by_narrowing(spark, share, shape):
    value = (F.col("id") * 7919 % 20011).cast("double") if shape == "spread" else F.floor(F.col("id") / 7000).cast("double")
    frame = spark.range(20011).select(value.alias("v"))
    expected = frame.agg(F.percentile("v", share)).first()[0]
    assert exact_quantile(frame, "v", share, small_rows=50) == pytest.approx(expected, abs=1e-9)


@pytest.mark.parametrize("rows", [1, 2, 40, 10_001, 60_000])
def test_exact_quantile_at_every_size(spark, rows):
    """Small and large inputs, with ties, nulls and infinities, through the same two reads."""
    value = F.when(F.col("id") % 11 == 10, F.lit(None)).when(F.col("id") == 7, F.lit(float("-inf"))).otherwise(
        F.round(F.pmod(F.xxhash64("id"), F.lit(50_000)) / 3, 1))
    frame = durable(spark.range(rows).select(value.alias("v")), "quantile-test")
    for share in (0.0, 0.1, 0.99):
        expected = frame.agg(F.percentile("v", share)).first()[0]
        assert exact_quantile(frame, "v", share, small_rows=20) == pytest.approx(expected, rel=1e-12, nan_ok=True)


def test_contamination_is_strict_under_ties(spark):
    frame = spark.createDataFrame([(float(x),) for x in [0, 0, 0, 0, 1, 2, 3, 4, 5, 6]], "s double")
    assert contamination_flag(frame, "s", "f").filter("f").count() == 0
    assert contamination_flag(frame.filter("s > 9"), "s", "f").count() == 0


def test_hash_sample_ignores_partitioning_and_prefilter(spark):
    frame = spark.range(5000).select(F.col("id").alias("row_id"))
    one = [r.row_id for r in hash_sample(frame.repartition(1), 30, 9).collect()]
    many = [r.row_id for r in hash_sample(frame.repartition(13), 30, 9, total=5000).collect()]
    assert one == many and len(set(one)) == 30


def test_alerts_are_sorted_and_reported(spark, scored):
    frame = spark.createDataFrame(scored)
    listed = [r.threat_score for r in sorted_alerts(frame).collect()]
    assert listed == sorted(listed, reverse=True) and min(listed) >= 25
    assert reports.top_dangerous_ips(alerts(frame)).first().top_severity == "CRITICAL"
    counts = {r.severity: r.requests for r in reports.severity_distribution(frame).collect()}
    assert set(counts) == {"CRITICAL", "HIGH", "MEDIUM", "NORMAL"} and sum(counts.values()) == 228 + PROBES
    rates = {r.category: r for r in reports.detection_rates(frame).collect()}
    assert rates["ATTACK (overall)"].rate_pct == 100.0 == rates["bot_scraper"].rate_pct
    assert {r.detector for r in reports.detector_comparison(frame).collect()} == {
        "Isolation Forest", "Local Outlier Factor", "Z-Score Baseline", "Composite (Combined)"}
    assert reports.overview_kpis(frame.limit(0)).first().anomaly_rate_pct == 0.0


def test_only_wanted_columns_of_the_log_go_through_the_scoring(spark, sf, monkeypatch):
    """With the columns named that are wanted, texts that only the features read are not written with them."""
    from logwarden.plans import catalog, pipeline
    from logwarden.sources.driver_tables import access_log

    written = {}
    for module in (catalog, pipeline):
        monkeypatch.setattr(module, "durable", lambda df, label: written.setdefault(label, df.columns) and durable(df, label))
    catalog._ready(spark, sf)
    assert written.pop("features") == ["row_id", *V.FEATURE_COLUMNS]
    log = access_log(spark, sf, "burst").where("row_id < 300")
    narrow = pipeline.score_logs(log, keep=["attack_type"])
    assert set(written.pop("features")) == {"row_id", "is_bot", "attack_type", *V.FEATURE_COLUMNS}
    wide = pipeline.score_logs(log)
    assert {"url", "user_agent"} <= set(wide.columns) and not {"url", "user_agent"} & set(narrow.columns)
    shared = sorted(narrow.columns)
    assert sorted(map(tuple, narrow.select(shared).collect())) == sorted(map(tuple, wide.select(shared).collect()))
