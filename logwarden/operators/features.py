"""The ten behavioural features of a request, relative to its address's other requests.

Trailing frames ``[t - w, t]`` are differences of two running totals: everything up to
``t`` minus everything before ``t - w``. Both are frames that only ever grow, so a
request costs O(1) however many others its hour holds, whereas a sliding frame is
re-aggregated for every row. Distinct paths work the same way: a path's requests form
runs without a gap over an hour; runs begun minus runs ended is the number alive.

One hash exchange on the address serves all ten. Addresses with more than ``hot_rows``
requests would still make one huge task, so they take ``hot_features`` instead, which
splits an address into blocks of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logwarden import fixed_values as V
from logwarden.functions import text
from logwarden.functions.scoring import guarded_ratio
from logwarden.functions.timekeys import MICROS, epoch_micros, interval_seconds
from logwarden.operators.hot_features import (
    NULL_ADDRESS, TOTALS, find_hot_addresses, hot_features, trailing_total)

HOT_ROWS = 1_000_000
#: Columns of the cleaned log that the features are made of. Hot addresses are written and exchanged a few
#: times with every column that is passed in, so whoever needs the features alone passes these.
INPUT_COLUMNS = [
    "row_id", "ip_address", "event_time", "method", "base_url", "status_code", "response_bytes",
    "has_suspicious_params", "session_id"]

# Helper columns, dropped from the result.
KEY, AT, NUM = "_key", "_at", "_num"
POST, ERR, SUSP, SIZE, SIZED = "_post", "_err", "_susp", "_size", "_sized"
OPENS, CLOSES, GAP = "_opens", "_closes", "_gap"


def log_features(clean: DataFrame, hot_rows: int | None = HOT_ROWS, placed_by: str | None = None) -> DataFrame:
    """Cleaned log plus the ten features; rows without an event time are left out.

    ``hot_rows=None`` skips the look for hot addresses (one narrow pre-aggregated pass). A log that
    lies in buckets of the address key in column ``placed_by`` (see ``write_laid_out``) is not
    exchanged; with it there is no look for hot addresses.
    """
    if placed_by is not None:
        return _finished(_windowed(_prepared(clean).withColumn(KEY, F.col(placed_by)), placed=True), clean)
    rows = _prepared(clean)
    names = find_hot_addresses(clean, hot_rows) if hot_rows is not None else None
    if names is None:
        return _finished(_windowed(rows), clean)
    cold = rows.join(names, KEY, "left_anti")
    split = hot_features(rows, names, hot_rows, run_flags)
    return _finished(_windowed(cold), clean).unionByName(_finished(split, clean))


def _prepared(clean: DataFrame) -> DataFrame:
    path = F.col("base_url")
    return clean.filter(F.col("event_time").isNotNull()).withColumns({
        KEY: F.coalesce(F.col("ip_address"), F.lit(NULL_ADDRESS)),
        AT: epoch_micros(F.col("event_time")),
        NUM: text.trailing_id(path),
        POST: text.is_post_login(path, F.col("method")),
        ERR: text.is_error(F.col("status_code")),
        SUSP: F.col("has_suspicious_params"),
        # Decimal totals neither overflow nor lose digits.
        SIZE: F.coalesce(F.col("response_bytes"), F.lit(0)).cast("decimal(20,0)"),
        SIZED: F.col("response_bytes").isNotNull().cast("int"),
    })


def run_flags(rows: DataFrame, *part: str, only_url: tuple[Column, ...] = (),
              only_session: tuple[Column, ...] = (), only_key: tuple[Column, ...] = ()) -> DataFrame:
    """Comparisons of a request with the one before or after it in its group.

    ``part`` is the grouping; ``only_*`` are further grouping terms of one comparison.
    """
    hour, day = V.HOUR_SECONDS * MICROS, V.DAY_SECONDS * MICROS
    by_url = W.partitionBy(*part, "base_url", *only_url).orderBy(AT)
    by_session = W.partitionBy(*part, "session_id", *only_session).orderBy(AT, "row_id")
    by_key = W.partitionBy(*part, *only_key).orderBy(AT, "row_id")
    at = F.col(AT)
    has_path = F.col("base_url").isNotNull()

    def starts(previous: Column, width: int) -> Column:
        return previous.isNull() | (at - previous > width)

    following = F.lead(AT).over(by_url)
    rows = rows.withColumns({
        OPENS: (has_path & starts(F.lag(AT).over(by_url), hour)).cast("int"),
        CLOSES: (has_path & (following.isNull() | (following - at > hour))).cast("int"),
    })
    rows = rows.withColumn(
        "new_session_flag", starts(F.lag(AT).over(by_session), day).cast("int"))
    # Carrying OPENS makes the optimizer keep this window after the one above and next to
    # the totals, which then need no sort of their own.
    previous = F.lag(F.struct(AT, NUM, OPENS)).over(by_key)
    return rows.withColumn("_previous", previous).withColumns({
        GAP: interval_seconds(at, F.col("_previous")[AT]),
        "sequential_url_score":
            F.coalesce(F.col(NUM) == F.col("_previous")[NUM] + 1, F.lit(False)).cast("double"),
    }).drop("_previous")


def _windowed(rows: DataFrame, placed: bool = False) -> DataFrame:
    ordered = W.partitionBy(KEY).orderBy(AT)
    # Grouped by address once; the finer groups of the flags lie within it. Left to itself
    # the planner would shuffle anew for each of them.
    rows = run_flags(rows if placed else rows.repartition(KEY), KEY).withColumn("_one", F.lit(1))
    return rows.withColumns({
        name: trailing_total(ordered, seconds, entering, leaving)
        for name, (seconds, entering, leaving) in TOTALS.items()
    }).withColumn("_variance", F.var_samp(GAP).over(W.partitionBy(KEY)))


def _finished(rows: DataFrame, clean: DataFrame) -> DataFrame:
    """Features from the trailing totals, next to the columns of the cleaned log."""
    mean_size = F.col("_size3600").cast("double") / F.nullif(F.col("_sized3600"), F.lit(0))
    return rows.select(
        *clean.columns,
        F.col("_n60").alias("requests_per_minute"),
        F.col("_post300").alias("post_login_rate"),
        (F.col("_err300") / F.col("_n300")).alias("error_rate_5min"),
        F.col("_urls3600").cast("int").alias("unique_urls_per_hour"),
        guarded_ratio(F.col("response_bytes"), mean_size).alias("avg_response_bytes_ratio"),
        F.coalesce(F.col("_variance"), F.lit(0.0)).alias("request_interval_variance"),
        text.is_offhours(F.col("event_time")).alias("is_offhours"),
        "sequential_url_score",
        (F.col("_susp1800") / F.col("_n1800")).alias("suspicious_param_rate"),
        "new_session_flag",
    )
