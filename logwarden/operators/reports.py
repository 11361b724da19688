"""Reports over scored logs and alerts. All are small grouped results; every top-k order
ends with a unique key, so the choice among equals is stable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden import fixed_values as V
from logwarden.functions.scoring import is_alert, percent
from logwarden.functions.timekeys import epoch_micros, interval_seconds
from logwarden.operators.sampling import hash_sample


def _rows(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def _value_counts(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.groupBy(column).agg(_rows(name)).orderBy(F.desc(name), column)


# --- Alerts ------------------------------------------------------------------

def severity_summary(alerts: DataFrame) -> DataFrame:
    """Alerts and distinct addresses per severity."""
    return (alerts.groupBy("severity")
            .agg(_rows("alerts"), F.countDistinct("ip_address").alias("unique_ips"))
            .orderBy("severity"))


def top_threat_ips(alerts: DataFrame, k: int = 5) -> DataFrame:
    return (alerts.groupBy("ip_address").agg(F.max("threat_score").alias("max_threat_score"))
            .orderBy(F.desc("max_threat_score"), "ip_address").limit(k))


def top_dangerous_ips(alerts: DataFrame, k: int = 10) -> DataFrame:
    """Worst addresses with the severity of their worst alert."""
    return (
        alerts.groupBy("ip_address").agg(
            F.max("threat_score").alias("max_threat_score"),
            _rows("alert_count"),
            F.max_by("severity", "threat_score").alias("top_severity"),
        )
        .orderBy(F.desc("max_threat_score"), F.desc("alert_count"), "ip_address").limit(k)
    )


def alerts_by_severity(alerts: DataFrame) -> DataFrame:
    return _value_counts(alerts, "severity", "alert_count")


def alerts_by_hour(alerts: DataFrame) -> DataFrame:
    return (alerts.groupBy(F.hour("event_time").alias("hour_of_day"))
            .agg(_rows("alert_count")).orderBy("hour_of_day"))


def alerts_by_attack_type(alerts: DataFrame) -> DataFrame:
    return _value_counts(alerts, "attack_type", "alert_count")


def alert_queue(alerts: DataFrame, severity: str | None = None, rows: int = V.ALERT_QUEUE_ROWS) -> DataFrame:
    """The analyst's queue: worst alerts first, optionally of one severity."""
    wanted = alerts if severity is None else alerts.filter(F.col("severity") == severity)
    return (wanted.orderBy(F.desc("threat_score"), "row_id").limit(rows)
            .select("row_id", "ip_address", "threat_score", "severity", "top_flag", "timestamp"))


# --- Traffic -----------------------------------------------------------------

def status_mix(log: DataFrame) -> DataFrame:
    return _value_counts(
        log.select(F.col("status_code").cast("string").alias("status_code")), "status_code", "requests")


def requests_per_hour(log: DataFrame) -> DataFrame:
    """Hourly series of the requests whose time could be read."""
    timed = log.filter(F.col("event_time").isNotNull())
    return (timed.groupBy(F.date_trunc("hour", "event_time").cast("timestamp_ntz").alias("hour"))
            .agg(_rows("requests")).orderBy("hour"))


def top_talkers(log: DataFrame, k: int = 10) -> DataFrame:
    return _value_counts(log, "ip_address", "requests").limit(k)


def browser_mix(clean: DataFrame) -> DataFrame:
    return (clean.groupBy("browser_type", "is_bot").agg(_rows("requests"))
            .orderBy("browser_type", "is_bot"))


def suspicious_requests(clean: DataFrame) -> DataFrame:
    """Base paths hit by injection probes."""
    return (clean.filter(F.col("has_suspicious_params") == 1).groupBy("base_url", "method")
            .agg(_rows("requests"), F.countDistinct("ip_address").alias("unique_ips"))
            .orderBy("base_url", "method"))


def dataset_profile(log: DataFrame) -> DataFrame:
    return log.agg(
        _rows("row_count"),
        F.min("timestamp").alias("first_timestamp"),
        F.max("timestamp").alias("last_timestamp"),
        F.countDistinct("ip_address").alias("unique_ips"),
        F.countDistinct("session_id").alias("unique_sessions"),
    )


def label_share(log: DataFrame) -> DataFrame:
    """Rows per label and their share; the total is added up from the label counts."""
    counts = log.groupBy("attack_type").agg(_rows("requests"))
    total = counts.agg(F.sum("requests")).scalar()
    return (counts.withColumn("share_pct", F.round(percent(F.col("requests"), total), 6))
            .orderBy(F.desc("requests"), "attack_type"))


def feature_means_by_attack(features: DataFrame) -> DataFrame:
    means = [F.round(F.avg(c), 3).alias(c) for c in V.SUMMARY_FEATURES]
    return features.groupBy("attack_type").agg(*means).orderBy("attack_type")


# --- Detection quality -------------------------------------------------------

def overview_kpis(scored: DataFrame) -> DataFrame:
    attack = is_alert() & (F.col("attack_type") != V.NORMAL_LABEL)
    totals = scored.agg(
        _rows("total_logs"),
        F.count_if(is_alert()).alias("flagged"),
        F.countDistinct("ip_address").alias("unique_ips"),
        F.countDistinct(F.when(attack, F.col("attack_type"))).alias("attack_types_detected"),
    )
    return totals.withColumn("anomaly_rate_pct", percent(F.col("flagged"), F.col("total_logs")))


def _detector_flags() -> dict[str, Column]:
    return {
        "Isolation Forest": F.col("isolation_forest_flag"),
        "Local Outlier Factor": F.col("lof_flag"),
        "Z-Score Baseline": F.col("zscore_flag"),
        "Composite (Combined)": is_alert(),
    }


def _as_rows(totals: DataFrame, rows: list) -> DataFrame:
    return totals.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def method_flag_counts(scored: DataFrame) -> DataFrame:
    """Flagged rows per detector, without the composite."""
    flags = {n: c for n, c in _detector_flags().items() if not n.startswith("Composite")}
    totals = scored.agg(*[F.count_if(c).alias(n) for n, c in flags.items()])
    return _as_rows(totals, [
        F.struct(F.lit(n).alias("method"), F.col(f"`{n}`").alias("flagged")) for n in flags])


def severity_distribution(scored: DataFrame) -> DataFrame:
    """Rows per severity; a severity nobody has is listed with zero."""
    names = [n for n, _ in V.SEVERITY_THRESHOLDS] + [V.SEVERITY_FLOOR]
    totals = scored.agg(*[F.count_if(F.col("severity") == n).alias(n) for n in names])
    return _as_rows(totals, [
        F.struct(F.lit(n).alias("severity"), F.col(n).alias("requests")) for n in names])


def detection_rates(scored: DataFrame) -> DataFrame:
    """Flagged share per attack, over all attacks, and of normal traffic (false positives)."""
    attack = F.col("attack_type") != V.NORMAL_LABEL
    per_label = scored.groupBy("attack_type").agg(
        _rows("requests"), F.count_if(is_alert()).alias("flagged"))
    # Each label's counts go into its own line and, for attacks, into the overall line.
    lines = F.when(attack, F.array(F.col("attack_type"), F.lit("ATTACK (overall)"))).otherwise(
        F.array(F.lit("FALSE POSITIVES")))
    return (
        per_label.select(F.explode(lines).alias("category"), "requests", "flagged")
        .groupBy("category").agg(F.sum("requests").alias("requests"), F.sum("flagged").alias("flagged"))
        .withColumn("rate_pct", F.round(percent(F.col("flagged"), F.col("requests")), 6))
        .orderBy("category")
    )


def detector_comparison(scored: DataFrame) -> DataFrame:
    """Detections, false positives and recall of each detector, from one pass."""
    attack = F.col("attack_type") != V.NORMAL_LABEL
    flags = _detector_flags()
    aggregates = [F.count_if(attack).alias("attacks")]
    for name, flag in flags.items():
        aggregates += [
            F.count_if(flag).alias(f"{name}|all"),
            F.count_if(flag & ~attack).alias(f"{name}|false"),
            F.count_if(flag & attack).alias(f"{name}|true"),
        ]
    return _as_rows(scored.agg(*aggregates), [
        F.struct(
            F.lit(name).alias("detector"),
            F.col(f"`{name}|all`").alias("detections"),
            F.col(f"`{name}|false`").alias("false_positives"),
            F.round(percent(F.col(f"`{name}|true`"), F.col("attacks")), 6).alias("detection_rate_pct"),
        )
        for name in flags
    ])


def score_scatter_sample(
    scored: DataFrame, rows: int = V.SCATTER_SAMPLE_ROWS, seed: int = V.SCATTER_SAMPLE_SEED,
    total: int | None = None,
) -> DataFrame:
    """Repeatable sample of both model scores for plotting."""
    keep = scored.select("row_id", "isolation_forest_score", "lof_score", "attack_type")
    return hash_sample(keep, rows, seed, total)


# --- Stream alerts -----------------------------------------------------------

def stream_kpis(alerts: DataFrame) -> DataFrame:
    """Alert count, critical count and alerts per second of the observed span (1 s at least)."""
    totals = alerts.agg(
        _rows("alerts"),
        F.count_if(F.col("severity") == "CRITICAL").alias("critical"),
        F.min("event_time").alias("first"), F.max("event_time").alias("last"),
    )
    span = interval_seconds(epoch_micros(F.col("last")), epoch_micros(F.col("first")))
    seconds = F.greatest(F.coalesce(span, F.lit(1.0)), F.lit(1.0))
    return totals.select(
        "alerts", "critical", F.round(F.col("alerts") / seconds, 9).alias("alerts_per_second"))


def latest_stream_alerts(alerts: DataFrame, k: int = 20) -> DataFrame:
    """Newest alerts first."""
    return (alerts.orderBy(F.desc("event_time"), F.desc("row_id")).limit(k)
            .select("row_id", "timestamp", "ip_address", "url", "threat_score", "severity", "attack_type"))


# --- Triage of alert files ---------------------------------------------------

def triage_per_file(alerts: DataFrame, file: str = "file") -> DataFrame:
    """Per alert file: counts by severity, worst address and distinct addresses.

    The first row with the highest score names the worst address.
    """
    first_worst = F.struct(
        F.col("threat_score").alias("score"), (-F.col("row_id")).alias("earliest"))
    counts = [
        F.count_if(F.col("severity") == n).alias(n.lower()) for n, _ in V.SEVERITY_THRESHOLDS]
    return alerts.groupBy(file).agg(
        *counts,
        F.max_by("ip_address", F.when(F.col("threat_score").isNotNull(), first_worst)).alias("top_ip"),
        F.coalesce(F.max("threat_score"), F.lit(-1)).alias("top_score"),
        F.countDistinct("ip_address").alias("unique_ips"),
    )


def triage_total(per_file: DataFrame, file: str = "file") -> DataFrame:
    """One row over all files, with the worst file's address and a message."""
    names = [n.lower() for n, _ in V.SEVERITY_THRESHOLDS]
    # Of files with equal top scores the first by name counts.
    per_score = per_file.groupBy("top_score").agg(
        *[F.sum(n).alias(n) for n in names],
        F.min_by(F.struct("top_ip", "unique_ips"), file).alias("worst"),
    )
    totals = per_score.agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names],
        F.max_by("worst", "top_score").alias("worst"), F.max("top_score").alias("top_score"),
    ).select(*names, "worst.*", "top_score")
    critical = F.format_string(V.CRITICAL_MESSAGE, "critical", "unique_ips", "top_ip", "top_score")
    quiet = F.format_string(V.QUIET_MESSAGE, "high", "medium")
    return totals.withColumn("message", F.when(F.col("critical") > 0, critical).otherwise(quiet))
