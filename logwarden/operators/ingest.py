"""Cleaning of raw logs and the data-quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden import fixed_values as V
from logwarden.functions import text
from logwarden.sources.access_log import validate_columns


def clean_logs(raw: DataFrame) -> DataFrame:
    """Typed and enriched log; every input row is kept, bad values become NULL."""
    validate_columns(raw.columns)
    agent, url = F.col("user_agent"), F.col("url")
    typed = raw.withColumns({
        "status_code": F.col("status_code").try_cast("int"),
        "response_bytes": F.col("response_bytes").try_cast("long"),
    })
    return typed.withColumns({
        "event_time": text.parse_event_time(F.col("timestamp")),
        "is_bot": text.is_bot(agent),
        "browser_type": text.browser_type(agent),
        "base_url": text.base_url(url),
        "has_suspicious_params": text.has_suspicious_params(url),
    })


def quality_report(clean: DataFrame) -> DataFrame:
    """Rows of (metric, value, status) from a single pass; only null counts have a status."""
    checks = {"total_rows": F.count(F.lit(1))}
    checks |= {f"null_{c}": F.count_if(F.col(c).isNull()) for c in V.NON_NULL_COLUMNS}
    checks |= {
        "bad_timestamps": F.count_if(F.col("event_time").isNull()),
        "bot_requests": F.count_if(F.col("is_bot")),
        "suspicious_requests": F.count_if(F.col("has_suspicious_params") == 1),
    }
    totals = clean.agg(*[expr.alias(name) for name, expr in checks.items()])
    pairs = [F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in checks]
    status = F.when(
        F.col("metric").startswith("null_"), F.when(F.col("value") == 0, "OK").otherwise("FAIL")
    )
    return (totals.select(F.explode(F.array(*pairs)).alias("m"))
            .select("m.metric", "m.value").withColumn("status", status))
