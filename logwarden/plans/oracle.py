"""The registered queries as plain SQL, for checking results on another engine.

Nothing here is shared with the Spark code: features are written with sliding range
frames and windowed distinct counts, factors with self-joins on small tables.
"""

from __future__ import annotations

_BURST = ("TIMESTAMP '2026-01-01 20:30:00' + "
          "to_microseconds(epoch_us(ts - TIMESTAMP '2024-01-01') // 240)")

_TEN = ["requests_per_minute", "post_login_rate", "error_rate_5min", "unique_urls_per_hour",
        "avg_response_bytes_ratio", "request_interval_variance", "is_offhours",
        "sequential_url_score", "suspicious_param_rate", "new_session_flag"]
_FIVE = ["requests_per_minute", "post_login_rate", "error_rate_5min",
         "avg_response_bytes_ratio", "suspicious_param_rate"]
_STREAMED = ["requests_per_minute", "post_login_rate", "error_rate_5min", "unique_urls_per_hour",
             "avg_response_bytes_ratio", "suspicious_param_rate"]
_BOTS = ["python-requests", "curl", "wget", "scrapy", "bot", "crawler"]
_PROBES = ["1=1", "or 1=1", "union select", "drop table", "information_schema", "xp_cmdshell",
           "sleep(", "--", "';", "' or '", "/*", "*/", "@@version", "benchmark(", "load_file(", "0x"]
_STREAM_PROBES = _PROBES[:10]
_RAW = ("timestamp, ip_address, method, url, status_code, response_bytes, user_agent, "
        "referrer, session_id, attack_type")


def _any(column: str, tokens: list[str]) -> str:
    tests = ["contains(lower(coalesce({}, '')), '{}')".format(column, t.replace("'", "''")) for t in tokens]
    return "(" + " OR ".join(tests) + ")"


def _log(clock: str = "event") -> str:
    time = _BURST if clock == "burst" else "ts"
    return f"""
log AS (
  SELECT event_id AS row_id,
    CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS batch_id,
    CASE WHEN event_id % 97 = 0 THEN 'n/a' ELSE strftime({time}, '%Y-%m-%d %H:%M:%S.%f') END AS timestamp,
    '10.0.0.' || user_id AS ip_address,
    CASE WHEN event_type IN ('signup', 'purchase') THEN 'POST' ELSE 'GET' END AS method,
    CASE WHEN event_type = 'signup' THEN '/login'
         WHEN event_type = 'purchase' THEN '/api/v1/checkout?cart=' || (event_id % 7)
         WHEN event_type = 'error' AND event_id % 4 = 0 THEN '/api/v1/user?id=1 OR 1=1'
         WHEN event_type = 'error' AND event_id % 4 = 1 THEN '/api/v1/product?id=1 AND SLEEP(5)'
         WHEN event_type = 'error' THEN '/api/v1/search?q=' || event_id
         ELSE '/products/' || (CAST(json_extract_string(props, '$.k') AS INTEGER) % 5) END AS url,
    CAST(CASE WHEN event_type = 'error' THEN 500
         WHEN event_type = 'signup' AND event_id % 3 = 0 THEN 401 ELSE 200 END AS INTEGER) AS status_code,
    CAST(floor(value * 100) AS BIGINT) AS response_bytes,
    CASE event_id % 12 WHEN 0 THEN 'python-requests/2.28.0' WHEN 1 THEN 'curl/7.68.0'
      WHEN 2 THEN 'sqlmap/1.6.12#stable (https://sqlmap.org)'
      WHEN 3 THEN 'Mozilla/5.0 zgrab/0.x Chrome/124.0' WHEN 4 THEN 'Go-http-client/2.0'
      WHEN 5 THEN 'Mozilla/5.0 Chrome/124.0 Safari/537.36 Edg/124.0'
      WHEN 6 THEN 'Mozilla/5.0 Chrome/124.0 Safari/537.36 OPR/110.0'
      WHEN 7 THEN 'Mozilla/5.0 Gecko/20100101 Firefox/125.0'
      WHEN 8 THEN 'Mozilla/5.0 Version/17.4 Safari/605.1.15'
      WHEN 9 THEN NULL WHEN 10 THEN '-'
      ELSE 'Mozilla/5.0 Chrome/124.0 Safari/537.36' END AS user_agent,
    '-' AS referrer,
    user_id || '-' || (event_id % 3) AS session_id,
    CASE WHEN event_type = 'signup' AND event_id % 3 = 0 THEN 'brute_force'
         WHEN event_type = 'error' AND event_id % 4 < 2 THEN 'sql_injection'
         WHEN event_id % 12 < 2 THEN 'bot_scraper'
         WHEN value > 200 THEN 'data_exfiltration'
         WHEN event_id % 50 = 7 THEN 'account_takeover' ELSE 'normal' END AS attack_type
  FROM events)"""


_CLEAN = f""",
clean AS (
  SELECT *, TRY_CAST(CASE WHEN timestamp LIKE '____-__-__ __:__:__%' THEN timestamp END AS TIMESTAMP) AS event_time,
    {_any('user_agent', _BOTS)} AS is_bot,
    CASE WHEN {_any('user_agent', _BOTS)} OR lower(user_agent) LIKE 'go-http%' THEN 'Bot/Tool'
         WHEN {_any('user_agent', ['sqlmap', 'nmap', 'zgrab'])} THEN 'Scanner'
         WHEN {_any('user_agent', ['edg/'])} THEN 'Edge'
         WHEN {_any('user_agent', ['opr/', 'opera'])} THEN 'Opera'
         WHEN {_any('user_agent', ['chrome/'])} THEN 'Chrome'
         WHEN {_any('user_agent', ['firefox/'])} THEN 'Firefox'
         WHEN {_any('user_agent', ['safari/'])} THEN 'Safari' ELSE 'Other' END AS browser_type,
    split_part(url, '?', 1) AS base_url,
    CAST({_any('url', _PROBES)} AS INTEGER) AS has_suspicious_params
  FROM log)"""

_FEATURES = """,
flags AS (
  SELECT *, CASE WHEN base_url = '/login' AND method = 'POST' THEN 1 ELSE 0 END AS post_login,
    CASE WHEN status_code >= 400 THEN 1.0 ELSE 0.0 END AS err,
    TRY_CAST(nullif(regexp_extract(base_url, '/(\\d+)$', 1), '') AS BIGINT) AS num
  FROM clean WHERE event_time IS NOT NULL),
lagged AS (
  SELECT *,
    epoch_us(event_time - lag(event_time) OVER o) / 1000000.0 AS gap,
    lag(num) OVER o AS prev_num,
    lag(event_time) OVER (PARTITION BY ip_address, session_id ORDER BY event_time, row_id) AS prev_session
  FROM flags WINDOW o AS (PARTITION BY ip_address ORDER BY event_time, row_id)),
features AS (
  SELECT *,
    count(*) OVER m1 AS requests_per_minute,
    CAST(sum(post_login) OVER m5 AS BIGINT) AS post_login_rate,
    avg(err) OVER m5 AS error_rate_5min,
    count(DISTINCT base_url) OVER h1 AS unique_urls_per_hour,
    CASE WHEN avg(response_bytes) OVER h1 > 0
         THEN response_bytes / (avg(response_bytes) OVER h1) ELSE 1.0 END AS avg_response_bytes_ratio,
    coalesce(var_samp(gap) OVER (PARTITION BY ip_address), 0.0) AS request_interval_variance,
    CASE WHEN hour(event_time) < 7 OR hour(event_time) > 22 THEN 1 ELSE 0 END AS is_offhours,
    CASE WHEN num = prev_num + 1 THEN 1.0 ELSE 0.0 END AS sequential_url_score,
    avg(CAST(has_suspicious_params AS DOUBLE)) OVER m30 AS suspicious_param_rate,
    CASE WHEN prev_session IS NULL OR event_time - prev_session > INTERVAL 86400 SECONDS
         THEN 1 ELSE 0 END AS new_session_flag
  FROM lagged WINDOW
    m1 AS (PARTITION BY ip_address ORDER BY event_time RANGE BETWEEN INTERVAL 60 SECONDS PRECEDING AND CURRENT ROW),
    m5 AS (PARTITION BY ip_address ORDER BY event_time RANGE BETWEEN INTERVAL 300 SECONDS PRECEDING AND CURRENT ROW),
    m30 AS (PARTITION BY ip_address ORDER BY event_time RANGE BETWEEN INTERVAL 1800 SECONDS PRECEDING AND CURRENT ROW),
    h1 AS (PARTITION BY ip_address ORDER BY event_time RANGE BETWEEN INTERVAL 3600 SECONDS PRECEDING AND CURRENT ROW))"""


def _zscores(source: str = "features") -> str:
    scores = ",\n    ".join(
        f"CASE WHEN stddev_pop({c}) OVER () = 0 THEN 0.0 "
        f"ELSE abs(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()) END AS z_{c}" for c in _FIVE)
    top = "greatest(" + ", ".join(f"z_{c}" for c in _FIVE) + ")"
    reason = " ".join(f"WHEN z_{c} = {top} THEN '{c}'" for c in _FIVE)
    return f""",
z AS (SELECT *, {scores} FROM {source}),
zscored AS (
  SELECT *, {top} AS max_zscore, {top} > 3.0 AS zscore_flag,
    CASE WHEN {top} > 3.0 THEN CASE {reason} END ELSE 'ml_pattern' END AS top_flag
  FROM z)"""


def _draw(what: str) -> str:
    return f"CAST('0x' || substr(md5('42-' || tree || '-' || node || '-{what}'), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE"


def _forest() -> str:
    """100 trees of 256 rows, grown and then walked level by level, over ``scaled.v``."""
    path = ("CASE WHEN {n} > 2 THEN 2.0::DOUBLE * (ln({n} - 1.0::DOUBLE) + 0.5772156649::DOUBLE)"
            " - 2.0::DOUBLE * ({n} - 1.0::DOUBLE) / {n} WHEN {n} = 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END")
    lows, highs = (", ".join(f"{kind}(v[{i + 1}])" for i in range(len(_TEN))) for kind in ("min", "max"))
    parts = ["""
pool AS (SELECT row_id, v FROM scaled ORDER BY md5('42-' || row_id), row_id LIMIT 25600),
rows0 AS MATERIALIZED (
  SELECT tree, 0 AS node, v FROM (
    SELECT tree, v, row_number() OVER (PARTITION BY tree ORDER BY md5('42-' || tree || '-' || row_id), row_id) AS place
    FROM pool, range(100) AS r(tree)) WHERE place <= 256),
walk0 AS MATERIALIZED (SELECT row_id, tree, 0 AS node, v FROM scaled, range(100) AS r(tree))"""]
    for level in range(9):
        grows = "n > 1 AND len(spread) > 0" if level < 8 else "false"
        parts.append(f"""
range{level} AS (
  SELECT *, list_filter(range(1, {len(_TEN) + 1}), lambda i: highs[i] > lows[i]) AS spread FROM (
    SELECT tree, node, count(*) AS n, [{lows}] AS lows, [{highs}] AS highs FROM rows{level} GROUP BY tree, node)),
cut{level} AS MATERIALIZED (
  SELECT *, lows[f] + {_draw('threshold')} * (highs[f] - lows[f]) AS threshold FROM (
    SELECT *, CASE WHEN {grows} THEN spread[1 + CAST(floor({_draw('feature')} * len(spread)) AS BIGINT)] END AS f
    FROM range{level})),
ends{level} AS (
  SELECT row_id, {level} + {path.format(n='n')} AS path FROM walk{level} JOIN cut{level} USING (tree, node) WHERE f IS NULL)""")
        if level < 8:
            child = "2 * node + 1 + CAST(v[f] > threshold AS INTEGER) AS node, v"
            parts.append(f"""
rows{level + 1} AS MATERIALIZED (SELECT tree, {child} FROM rows{level} JOIN cut{level} USING (tree, node) WHERE f IS NOT NULL),
walk{level + 1} AS MATERIALIZED (
  SELECT row_id, tree, {child} FROM walk{level} JOIN cut{level} USING (tree, node) WHERE f IS NOT NULL)""")
    every = " UNION ALL ".join(f"SELECT * FROM ends{level}" for level in range(9))
    parts.append(f"""
forest AS (
  SELECT row_id, round(-pow(2.0::DOUBLE, -sum(path) / (100 * ({path.format(n='256.0::DOUBLE')}))), 9) AS raw_score
  FROM ({every}) GROUP BY row_id)""")
    return ",".join(parts)


def _factor() -> str:
    """Local outlier factor of ``scaled`` among all of its rows, k = 20."""
    squares = " + ".join(f"(p.{c}_scaled - r.{c}_scaled) * (p.{c}_scaled - r.{c}_scaled)" for c in _TEN)
    return f"""
near AS MATERIALIZED (
  SELECT p, n.d AS d, n.r AS r FROM (
    SELECT p.row_id AS p, unnest(min({{'d': round(sqrt({squares}), 9), 'r': r.row_id}}, 20)) AS n
    FROM scaled p JOIN scaled r ON p.row_id <> r.row_id GROUP BY p.row_id)),
kth AS (SELECT p AS r, max(d) AS kd FROM near GROUP BY p),
density AS (SELECT p, 1.0 / (avg(greatest(d, kd)) + 1e-10) AS lrd FROM near JOIN kth USING (r) GROUP BY p),
lof AS (
  SELECT near.p AS row_id, round(-avg(nb.lrd) / any_value(own.lrd), 9) AS lof_score
  FROM near JOIN density nb ON near.r = nb.p JOIN density own ON near.p = own.p GROUP BY near.p)"""


_STANDARD = ", ".join(
    f"round(CASE WHEN stddev_pop({c}) OVER () = 0 THEN 0.0 "
    f"ELSE ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () END, 6) AS {c}_scaled" for c in _TEN)
_INPUTS = f""",
scaled AS MATERIALIZED (
  SELECT *, [{', '.join(f'{c}_scaled' for c in _TEN)}] AS v FROM (SELECT row_id, {_STANDARD} FROM features))"""

_SCORED = _zscores() + _INPUTS + "," + _forest() + "," + _factor() + """,
limits AS (
  SELECT (SELECT quantile_cont(raw_score, 0.1) FROM forest) AS forest_limit,
    (SELECT quantile_cont(lof_score, 0.1) FROM lof) AS lof_limit),
flagged AS (
  SELECT *, round(raw_score - forest_limit, 9) AS isolation_forest_score,
    raw_score < forest_limit AS isolation_forest_flag, lof_score < lof_limit AS lof_flag
  FROM zscored JOIN forest USING (row_id) JOIN lof USING (row_id), limits),
points AS (
  SELECT *, CAST(35 * isolation_forest_flag::INT + 35 * lof_flag::INT + 20 * zscore_flag::INT
    + 5 * is_bot::INT + 5 * (suspicious_param_rate > 0.5)::INT AS INTEGER) AS threat_score
  FROM flagged),
scored AS MATERIALIZED (
  SELECT *, CASE WHEN threat_score >= 75 THEN 'CRITICAL' WHEN threat_score >= 50 THEN 'HIGH'
    WHEN threat_score >= 25 THEN 'MEDIUM' ELSE 'NORMAL' END AS severity
  FROM points),
alerts AS (SELECT * FROM scored WHERE threat_score >= 25)"""

_STREAM_EVENTS = f""",
enriched AS (
  SELECT *, {_any('user_agent', _BOTS)} AS is_bot,
    CAST({_any('url', _STREAM_PROBES)} AS INTEGER) AS has_suspicious_params
  FROM log)"""

_BASELINE = """,
per_batch AS (
  SELECT batch_id, count(response_bytes) AS n, sum(CAST(response_bytes AS DOUBLE)) AS s,
    sum(CAST(response_bytes AS DOUBLE) * CAST(response_bytes AS DOUBLE)) AS sq
  FROM log GROUP BY batch_id),
summed AS (
  SELECT batch_id, CAST(coalesce(sum(n) OVER w, 0) AS BIGINT) AS n, sum(s) OVER w AS s, sum(sq) OVER w AS sq
  FROM per_batch WINDOW w AS (ORDER BY batch_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)),
baseline AS (
  SELECT batch_id, n AS baseline_rows,
    CASE WHEN n >= 2 THEN s / n ELSE 0.0 END AS baseline_mean,
    CASE WHEN n >= 2 THEN sqrt(greatest(sq / n - (s / n) * (s / n), 0.0)) ELSE 0.0 END AS baseline_std
  FROM summed)"""

_STREAM_SCORED = _STREAM_EVENTS + _BASELINE + """,
deviations AS (
  SELECT e.*, CASE WHEN baseline_std > 0 THEN coalesce((response_bytes - baseline_mean) / baseline_std, 0.0)
    ELSE 0.0 END AS resp_zscore
  FROM enriched e JOIN baseline USING (batch_id)),
stream_points AS (
  SELECT *, abs(resp_zscore) > 3.0 AS zscore_flag,
    CAST(25 * is_bot::INT + 25 * has_suspicious_params + 30 * (abs(resp_zscore) > 3.0)::INT AS INTEGER) AS threat_score
  FROM deviations),
stream_scored AS MATERIALIZED (
  SELECT *, CASE WHEN threat_score >= 75 THEN 'CRITICAL' WHEN threat_score >= 50 THEN 'HIGH'
    WHEN threat_score >= 25 THEN 'MEDIUM' ELSE 'NORMAL' END AS severity
  FROM stream_points),
stream_alerts AS (SELECT * FROM stream_scored WHERE threat_score >= 25)"""

_STREAM_COLUMNS = ("timestamp, ip_address, url, status_code, response_bytes, is_bot, "
                   "has_suspicious_params, zscore_flag, threat_score, severity, attack_type")

_TRIAGE = """,
per_file AS (
  SELECT batch_id, count(*) FILTER (severity = 'CRITICAL') AS critical,
    count(*) FILTER (severity = 'HIGH') AS high, count(*) FILTER (severity = 'MEDIUM') AS medium,
    first(ip_address ORDER BY threat_score DESC, row_id) AS top_ip,
    max(threat_score) AS top_score, count(DISTINCT ip_address) AS unique_ips
  FROM stream_alerts GROUP BY batch_id)"""


def _lof(points: str, names: list[str], reference: str) -> str:
    """Local outlier factor of ``points`` against ``reference`` (both CTE names), k = 20."""
    squares = " + ".join(f"(p.{c} - r.{c}) * (p.{c} - r.{c})" for c in names)
    return f""",
pairs AS (
  SELECT p.row_id AS p, r.row_id AS r, round(sqrt({squares}), 9) AS d
  FROM {points} p JOIN {reference} r ON p.row_id <> r.row_id),
near AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY p ORDER BY d, r) AS rank FROM pairs) WHERE rank <= 20),
kth AS (SELECT p AS r, max(d) AS kd FROM near WHERE p IN (SELECT row_id FROM {reference}) GROUP BY p),
density AS (
  SELECT p, 1.0 / (avg(greatest(d, kd)) + 1e-10) AS lrd FROM near JOIN kth USING (r) GROUP BY p),
lof AS (
  SELECT near.p AS row_id, -avg(nb.lrd) / any_value(own.lrd) AS lof_score
  FROM near JOIN density nb ON near.r = nb.p JOIN density own ON near.p = own.p GROUP BY near.p)"""


_EMBEDDED = "points AS (SELECT vec_id AS row_id, " + ", ".join(
    f"CAST(embedding[{i + 1}] AS DOUBLE) AS x{i}" for i in range(64)) + " FROM embeddings)"

_SCALED = ", ".join(
    f"CASE WHEN stddev_pop({c}) OVER () = 0 THEN 0.0 "
    f"ELSE ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () END AS {c}_scaled" for c in _TEN)

_BURST_FEATURES = "WITH" + _log("burst") + _CLEAN + _FEATURES
_EVENT_CLEAN = "WITH" + _log() + _CLEAN
_BURST_SCORED = _BURST_FEATURES + _SCORED
_STREAM = "WITH" + _log() + _STREAM_SCORED


def _six(*columns: str) -> str:
    return ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in columns)


def _feature(name: str) -> str:
    return f"{_BURST_FEATURES} SELECT row_id, {_six(name)} FROM features"


_DETECTORS = [("Isolation Forest", "isolation_forest_flag"), ("Local Outlier Factor", "lof_flag"),
              ("Z-Score Baseline", "zscore_flag"), ("Composite (Combined)", "threat_score >= 25")]


def _comparison() -> str:
    return _BURST_SCORED + " UNION ALL ".join(
        f" SELECT '{name}' AS detector, count(*) FILTER ({flag}) AS detections,"
        f" count(*) FILTER (({flag}) AND attack_type = 'normal') AS false_positives,"
        f" round(count(*) FILTER (({flag}) AND attack_type <> 'normal') * 100.0::DOUBLE"
        " / count(*) FILTER (attack_type <> 'normal'), 6) AS detection_rate_pct FROM scored"
        for name, flag in _DETECTORS)


_QUALITY = [("total_rows", "true"), ("null_timestamp", "timestamp IS NULL"),
            ("null_ip_address", "ip_address IS NULL"), ("null_url", "url IS NULL"),
            ("null_status_code", "status_code IS NULL"), ("bad_timestamps", "event_time IS NULL"),
            ("bot_requests", "is_bot"), ("suspicious_requests", "has_suspicious_params = 1")]

_ALERT_COLUMNS = "row_id, timestamp, ip_address, url, threat_score, severity, top_flag, attack_type"
_DIRTY = """,
dirty AS (
  SELECT row_id, timestamp, ip_address, method, url,
    CASE WHEN row_id % 107 = 0 THEN NULL ELSE status_code END AS status_code,
    response_bytes, user_agent, referrer, session_id, attack_type
  FROM log WHERE row_id % 101 <> 0 AND row_id % 103 <> 0)"""

_LINES = """WITH lines AS (
  SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS score FROM lineitem)"""

_LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

ORACLE: dict[str, str] = {
    "minimum_slice_top10": _BURST_FEATURES + _zscores() + """,
        points AS (
          SELECT *, CAST(20 * zscore_flag::INT + 5 * is_bot::INT + 5 * (suspicious_param_rate > 0.5)::INT AS INTEGER) AS threat_score
          FROM zscored)
        SELECT ip_address, max(threat_score) AS max_threat_score, count(*) AS alert_count,
          CASE WHEN max(threat_score) >= 75 THEN 'CRITICAL' WHEN max(threat_score) >= 50 THEN 'HIGH' ELSE 'MEDIUM' END AS top_severity
        FROM points WHERE threat_score >= 25 GROUP BY ip_address
        ORDER BY max_threat_score DESC, alert_count DESC, ip_address LIMIT 10""",
    "scan_access_log": f"WITH{_log()} SELECT row_id, {_RAW} FROM log",
    "csv_roundtrip": f"WITH{_log()} SELECT {_RAW} FROM log",
    "csv_row_keys": f"""WITH{_log()}, twice AS (SELECT * FROM log UNION ALL SELECT * FROM log WHERE row_id % 7 = 0)
        SELECT attack_type, count(*) AS requests, count(*) AS row_keys FROM twice GROUP BY attack_type""",
    "parquet_roundtrip": f"""{_EVENT_CLEAN} SELECT row_id, {_RAW}, event_time, is_bot, browser_type, base_url,
        has_suspicious_params FROM clean""",
    "json_roundtrip": f"WITH{_log()} SELECT {_RAW} FROM log",
    "external_alert_table": f"""{_BURST_SCORED} SELECT attack_type, top_flag, count(*) AS alert_count,
        max(threat_score) AS max_threat_score, min(status_code) AS min_status FROM alerts GROUP BY ALL""",
    "parse_event_time": f"{_EVENT_CLEAN} SELECT row_id, timestamp, event_time FROM clean",
    "enrich": f"""{_EVENT_CLEAN} SELECT row_id, status_code, response_bytes, is_bot, browser_type, base_url,
        has_suspicious_params FROM clean""",
    "browser_mix": f"{_EVENT_CLEAN} SELECT browser_type, is_bot, count(*) AS requests FROM clean GROUP BY ALL",
    "suspicious_requests": f"""{_EVENT_CLEAN} SELECT base_url, method, count(*) AS requests,
        count(DISTINCT ip_address) AS unique_ips FROM clean WHERE has_suspicious_params = 1 GROUP BY ALL""",
    "url_trailing_id": f"""WITH{_log()}, paths AS (
          SELECT 'page' AS origin, page_id AS id, split_part(url, '?', 1) AS base_url FROM pages
          UNION ALL SELECT 'log', row_id, split_part(url, '?', 1) FROM log)
        SELECT *, TRY_CAST(nullif(regexp_extract(base_url, '/(\\d+)$', 1), '') AS BIGINT) AS trailing_id FROM paths""",
    "offhours": f"""{_EVENT_CLEAN} SELECT row_id, CAST(hour(event_time) < 7 OR hour(event_time) > 22 AS INTEGER) AS is_offhours
        FROM clean WHERE event_time IS NOT NULL""",
    "sanitize_features": """SELECT event_id AS row_id,
        CASE WHEN event_id % 5 = 0 OR event_id % 4 = 0 THEN 0.0 ELSE round(value / (event_id % 4), 6) END AS ratio
        FROM events""",
    "severity_buckets": """SELECT event_id AS row_id, CAST(event_id % 101 AS INTEGER) AS threat_score,
        CASE WHEN event_id % 101 <= 24 THEN 'NORMAL' WHEN event_id % 101 <= 49 THEN 'MEDIUM'
             WHEN event_id % 101 <= 74 THEN 'HIGH' ELSE 'CRITICAL' END AS severity FROM events""",
    "quality_report": _EVENT_CLEAN + " UNION ALL ".join(
        f" SELECT '{name}' AS metric, count(*) AS value, "
        + ("CASE WHEN count(*) = 0 THEN 'OK' ELSE 'FAIL' END" if name.startswith("null_") else "NULL")
        + f" AS status FROM clean WHERE {test}" for name, test in _QUALITY),
    "status_mix": f"{_EVENT_CLEAN} SELECT CAST(status_code AS VARCHAR) AS status_code, count(*) AS requests FROM clean GROUP BY ALL",
    "requests_per_hour": f"""{_EVENT_CLEAN} SELECT date_trunc('hour', event_time) AS hour, count(*) AS requests
        FROM clean WHERE event_time IS NOT NULL GROUP BY ALL""",
    "top10_talkers": f"""{_EVENT_CLEAN} SELECT ip_address, count(*) AS requests FROM clean GROUP BY ALL
        ORDER BY requests DESC, ip_address LIMIT 10""",
    "dataset_profile": f"""{_EVENT_CLEAN} SELECT count(*) AS row_count, min(timestamp) AS first_timestamp,
        max(timestamp) AS last_timestamp, count(DISTINCT ip_address) AS unique_ips,
        count(DISTINCT session_id) AS unique_sessions FROM clean""",
    "label_share": f"""{_EVENT_CLEAN} SELECT attack_type, count(*) AS requests,
        round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM clean), 6) AS share_pct FROM clean GROUP BY ALL""",
    "feat_requests_per_minute": _feature("requests_per_minute"),
    "feat_post_login_rate": _feature("post_login_rate"),
    "feat_error_rate_5min": _feature("error_rate_5min"),
    "feat_unique_urls_per_hour": _feature("unique_urls_per_hour"),
    "feat_bytes_ratio": _feature("avg_response_bytes_ratio"),
    "feat_interval_variance": _feature("request_interval_variance"),
    "feat_sequential_url": _feature("sequential_url_score"),
    "feat_suspicious_rate": _feature("suspicious_param_rate"),
    "feat_new_session": f"{_EVENT_CLEAN}{_FEATURES} SELECT row_id, {_six('new_session_flag')} FROM features",
    "log_features": f"{_BURST_FEATURES} SELECT row_id, ip_address, {_six(*_TEN)} FROM features",
    "log_features_split": f"{_BURST_FEATURES} SELECT row_id, ip_address, {_six(*_TEN)} FROM features",
    "feature_means_by_attack": f"""{_BURST_FEATURES} SELECT attack_type,
        {', '.join(f'round(avg({c}), 3) AS {c}' for c in ['requests_per_minute', 'error_rate_5min', 'avg_response_bytes_ratio', 'suspicious_param_rate'])}
        FROM features GROUP BY attack_type""",
    "standard_scale": f"""{_BURST_FEATURES}, scaled AS (SELECT row_id, {_SCALED} FROM features)
        SELECT row_id, {_six(*[c + '_scaled' for c in _TEN])} FROM scaled""",
    "standard_scale_lineitem": f"""WITH scaled AS (SELECT l_orderkey, l_linenumber,
        {', '.join(f'({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}_scaled' for c in _LINE_COLUMNS)} FROM lineitem)
        SELECT l_orderkey, l_linenumber, {_six(*[c + '_scaled' for c in _LINE_COLUMNS])} FROM scaled""",
    "zscore_baseline": f"{_BURST_FEATURES}{_zscores()} SELECT row_id, {_six('max_zscore')}, zscore_flag FROM zscored",
    "alert_reason": f"{_BURST_FEATURES}{_zscores()} SELECT row_id, zscore_flag, top_flag FROM zscored",
    "contamination_flag": f"""{_LINES} SELECT l_orderkey, l_linenumber, round(score, 4) AS score,
        score < (SELECT quantile_cont(score, 0.1) FROM lines) AS flag FROM lines""",
    "knn_self_join": "WITH " + _EMBEDDED + _lof("points", [f"x{i}" for i in range(64)], "points") + """
        SELECT p AS row_id, CAST(rank AS INTEGER) AS rank, r AS neighbor_id, d AS distance FROM near""",
    "lof_exact": "WITH " + _EMBEDDED + _lof("points", [f"x{i}" for i in range(64)], "points") + """
        SELECT row_id, round(lof_score, 6) AS lof_score,
          lof_score < (SELECT quantile_cont(lof_score, 0.1) FROM lof) AS lof_flag FROM lof""",
    "lof_reference": f"{_BURST_FEATURES}{_INPUTS},{_factor()} SELECT row_id, lof_score FROM lof",
    "isolation_forest": f"""{_BURST_FEATURES}{_INPUTS},{_forest()} SELECT row_id, raw_score AS isolation_forest_score,
        raw_score < (SELECT quantile_cont(raw_score, 0.1) FROM forest) AS isolation_forest_flag FROM forest""",
    "stored_model_flags": f"""{_BURST_FEATURES}{_INPUTS},{_forest()} SELECT row_id, raw_score AS isolation_forest_score,
        raw_score < (SELECT quantile_cont(raw_score, 0.1) FROM forest) AS isolation_forest_flag FROM forest""",
    "lof_features": f"""{_BURST_FEATURES}{_INPUTS},{_factor()} SELECT row_id, lof_score,
        lof_score < (SELECT quantile_cont(lof_score, 0.1) FROM lof) AS lof_flag FROM lof""",
    "scored_logs": f"""{_BURST_SCORED} SELECT row_id, ip_address, attack_type, isolation_forest_score, lof_score,
        isolation_forest_flag, lof_flag, {_six('max_zscore')}, zscore_flag, top_flag, threat_score, severity FROM scored""",
    "threat_score": f"""{_BURST_SCORED} SELECT row_id, isolation_forest_flag, lof_flag, zscore_flag, is_bot,
        threat_score, severity FROM scored""",
    "alerts": f"{_BURST_SCORED} SELECT {_ALERT_COLUMNS} FROM alerts",
    "severity_summary": f"""{_BURST_SCORED} SELECT severity, count(*) AS alerts, count(DISTINCT ip_address) AS unique_ips
        FROM alerts GROUP BY severity""",
    "top5_threat_ips": f"""{_BURST_SCORED} SELECT ip_address, max(threat_score) AS max_threat_score FROM alerts
        GROUP BY ip_address ORDER BY max_threat_score DESC, ip_address LIMIT 5""",
    "top10_dangerous_ips": f"""{_BURST_SCORED} SELECT ip_address, max(threat_score) AS max_threat_score,
        count(*) AS alert_count, arg_max(severity, threat_score) AS top_severity FROM alerts
        GROUP BY ip_address ORDER BY max_threat_score DESC, alert_count DESC, ip_address LIMIT 10""",
    "alerts_by_severity": f"{_BURST_SCORED} SELECT severity, count(*) AS alert_count FROM alerts GROUP BY severity",
    "alerts_by_hour": f"""{_BURST_SCORED} SELECT CAST(hour(event_time) AS INTEGER) AS hour_of_day,
        count(*) AS alert_count FROM alerts GROUP BY ALL""",
    "alerts_by_attack_type": f"{_BURST_SCORED} SELECT attack_type, count(*) AS alert_count FROM alerts GROUP BY ALL",
    "alert_queue": f"""{_BURST_SCORED} SELECT row_id, ip_address, threat_score, severity, top_flag, timestamp
        FROM alerts ORDER BY threat_score DESC, row_id LIMIT 500""",
    "alert_queue_high": f"""{_BURST_SCORED} SELECT row_id, ip_address, threat_score, severity, top_flag, timestamp
        FROM alerts WHERE severity = 'HIGH' ORDER BY threat_score DESC, row_id LIMIT 500""",
    "method_flag_counts": _BURST_SCORED + " UNION ALL ".join(
        f" SELECT '{name}' AS method, count(*) FILTER ({flag}) AS flagged FROM scored" for name, flag in _DETECTORS[:3]),
    "severity_distribution": _BURST_SCORED + " UNION ALL ".join(
        f" SELECT '{name}' AS severity, count(*) FILTER (severity = '{name}') AS requests FROM scored"
        for name in ["CRITICAL", "HIGH", "MEDIUM", "NORMAL"]),
    "detection_rates": f"""{_BURST_SCORED}, lines AS (
          SELECT attack_type AS category, threat_score FROM scored WHERE attack_type <> 'normal'
          UNION ALL SELECT 'ATTACK (overall)', threat_score FROM scored WHERE attack_type <> 'normal'
          UNION ALL SELECT 'FALSE POSITIVES', threat_score FROM scored WHERE attack_type = 'normal')
        SELECT category, count(*) AS requests, count(*) FILTER (threat_score >= 25) AS flagged,
          round(count(*) FILTER (threat_score >= 25) * 100.0::DOUBLE / count(*), 6) AS rate_pct
        FROM lines GROUP BY category""",
    "detector_comparison": _comparison(),
    "detector_comparison_full": _comparison(),
    "overview_kpis": f"""{_BURST_SCORED} SELECT count(*) AS total_logs, count(*) FILTER (threat_score >= 25) AS flagged,
        count(DISTINCT ip_address) AS unique_ips,
        count(DISTINCT CASE WHEN threat_score >= 25 AND attack_type <> 'normal' THEN attack_type END) AS attack_types_detected,
        round(count(*) FILTER (threat_score >= 25) * 100.0::DOUBLE / count(*), 6) AS anomaly_rate_pct FROM scored""",
    "score_scatter_sample": f"""{_BURST_SCORED} SELECT row_id, isolation_forest_score, lof_score, attack_type
        FROM scored ORDER BY md5('1-' || row_id), row_id LIMIT 6000""",
    "stream_parse": f"WITH{_log()}{_DIRTY} SELECT row_id, {_RAW} FROM dirty",
    "stream_rejects": f"""WITH{_log()} SELECT CASE WHEN row_id % 101 = 0 THEN 'not json' ELSE '{{"timest' END AS start,
        count(*) AS events FROM log WHERE row_id % 101 = 0 OR row_id % 103 = 0 GROUP BY ALL""",
    "rolling_baseline": f"""WITH{_log()}{_BASELINE} SELECT batch_id, baseline_rows,
        {_six('baseline_mean', 'baseline_std')} FROM baseline""",
    "stream_scores": f"""{_STREAM} SELECT row_id, batch_id, {_six('resp_zscore')}, zscore_flag, threat_score, severity
        FROM stream_scored""",
    "stream_alerts": f"{_STREAM} SELECT batch_id, {_STREAM_COLUMNS} FROM stream_alerts",
    "stream_batch_metrics": f"""{_STREAM} SELECT batch_id, count(*) AS events,
        count(*) FILTER (threat_score >= 25) AS alerts, count(*) FILTER (severity = 'CRITICAL') AS critical,
        count(*) FILTER (severity = 'HIGH') AS high, count(*) FILTER (severity = 'MEDIUM') AS medium
        FROM stream_scored GROUP BY batch_id""",
    "stream_replay_alerts": f"{_STREAM} SELECT batch_id, {_STREAM_COLUMNS} FROM stream_alerts",
    "stream_live_alerts": f"{_STREAM} SELECT {_STREAM_COLUMNS} FROM stream_alerts",
    "alert_log_read": f"{_STREAM} SELECT {_STREAM_COLUMNS} FROM stream_alerts",
    "live_dangerous_ips": f"""{_STREAM} SELECT ip_address, max(threat_score) AS max_threat_score,
        count(*) AS alert_count, arg_max(severity, threat_score) AS top_severity FROM stream_alerts
        GROUP BY ip_address ORDER BY max_threat_score DESC, alert_count DESC, ip_address LIMIT 10""",
    "laid_out_features": f"{_BURST_FEATURES} SELECT row_id, ip_address, {_six(*_TEN)} FROM features",
    "daily_alert_table": f"""{_STREAM} SELECT ip_address, count(*) AS alert_count, max(threat_score) AS max_threat_score
        FROM stream_alerts WHERE timestamp LIKE '2024-01-05 %' GROUP BY ip_address""",
    "replayed_input": f"""WITH{_log()}, timed AS (
          SELECT row_id, batch_id // 3 AS batch, TRY_CAST(CASE WHEN timestamp <> 'n/a' THEN timestamp END AS TIMESTAMP) AS t FROM log),
        sent AS (
          SELECT * FROM (
            SELECT * FROM timed UNION ALL SELECT row_id, batch + 1, t FROM timed WHERE row_id % 13 = 0
            UNION ALL SELECT row_id, batch + 3, t FROM timed WHERE row_id % 17 = 0) WHERE batch < 10),
        per_batch AS (SELECT batch, max(t) AS top FROM sent GROUP BY batch),
        tops AS (SELECT batch, max(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM per_batch),
        marked AS (SELECT sent.*, coalesce(t < newest - INTERVAL 5 DAYS, false) AS late FROM sent JOIN tops USING (batch)),
        turned AS (SELECT *, row_number() OVER (PARTITION BY row_id, late ORDER BY batch) AS turn FROM marked)
        SELECT batch AS batch_id, count(*) AS received, count(*) FILTER (NOT late AND turn = 1) AS admitted,
          count(*) FILTER (NOT late AND turn > 1) AS repeats, count(*) FILTER (late) AS late FROM turned GROUP BY batch""",
    "stream_event_time_scores": f"""WITH{_log('burst')}{_STREAM_EVENTS}, timed AS (
          SELECT *, TRY_CAST(CASE WHEN timestamp <> 'n/a' THEN timestamp END AS TIMESTAMP) AS t,
            CAST(response_bytes AS DOUBLE) AS b FROM enriched),
        slots AS (
          SELECT time_bucket(INTERVAL 30 SECONDS, t) - to_seconds(30 * i) + INTERVAL 5 MINUTES AS closes, b
          FROM timed, range(10) AS r(i) WHERE t IS NOT NULL),
        base AS (
          SELECT closes, count(b) AS n, sum(b) AS s, sum(b * b) AS sq FROM slots GROUP BY closes
          HAVING closes <= (SELECT date_trunc('millisecond', max(t)) - INTERVAL 45 MINUTES FROM timed)),
        deviations AS (
          SELECT e.*, n AS baseline_rows,
            CASE WHEN n >= 2 AND sqrt(greatest(sq / n - (s / n) * (s / n), 0.0)) > 0
                 THEN coalesce((b - s / n) / sqrt(greatest(sq / n - (s / n) * (s / n), 0.0)), 0.0) ELSE 0.0 END AS resp_zscore
          FROM timed e JOIN base ON time_bucket(INTERVAL 30 SECONDS, t) = closes),
        points AS (
          SELECT *, abs(resp_zscore) > 3.0 AS zscore_flag, CAST(25 * is_bot::INT + 25 * has_suspicious_params
            + 30 * (abs(resp_zscore) > 3.0)::INT AS INTEGER) AS threat_score FROM deviations)
        SELECT row_id, baseline_rows, round(resp_zscore, 6) AS resp_zscore, zscore_flag, threat_score,
          CASE WHEN threat_score >= 75 THEN 'CRITICAL' WHEN threat_score >= 50 THEN 'HIGH'
            WHEN threat_score >= 25 THEN 'MEDIUM' ELSE 'NORMAL' END AS severity FROM points""",
    "stream_features": f"""{_BURST_FEATURES}
        SELECT row_id, ip_address, {_six(*_STREAMED)} FROM features
        WHERE (epoch_us(event_time) // 60000000 + 1) * 60000
              <= (SELECT epoch_us(max(event_time)) // 1000 - 45 * 60000 FROM features)""",
    "event_time_baseline": f"""WITH{_log('burst')}, timed AS (
          SELECT TRY_CAST(CASE WHEN timestamp <> 'n/a' THEN timestamp END AS TIMESTAMP) AS t,
            CAST(response_bytes AS DOUBLE) AS b FROM log),
        slots AS (
          SELECT time_bucket(INTERVAL 30 SECONDS, t) - to_seconds(30 * i) AS window_start, b
          FROM timed, range(10) AS r(i) WHERE t IS NOT NULL)
        SELECT window_start, window_start + INTERVAL 5 MINUTES AS window_end, count(*) AS events,
          CASE WHEN count(*) >= 2 THEN round(avg(b), 6) ELSE 0.0 END AS mean_bytes,
          CASE WHEN count(*) >= 2 THEN round(sqrt(greatest(sum(b * b) / count(*) - avg(b) * avg(b), 0.0)), 6) ELSE 0.0 END AS std_bytes
        FROM slots GROUP BY window_start
        HAVING window_start + INTERVAL 5 MINUTES
          <= (SELECT date_trunc('millisecond', max(t)) - INTERVAL 10 MINUTES FROM timed)""",
    "stream_kpis": f"""{_STREAM}, timed AS (
          SELECT *, TRY_CAST(CASE WHEN timestamp <> 'n/a' THEN timestamp END AS TIMESTAMP) AS t FROM stream_alerts)
        SELECT count(*) AS alerts, count(*) FILTER (severity = 'CRITICAL') AS critical,
          round(count(*) / greatest(epoch_us(max(t) - min(t)) / 1000000.0, 1.0), 9) AS alerts_per_second FROM timed""",
    "last20_stream_alerts": f"""{_STREAM} SELECT row_id, timestamp, ip_address, url, threat_score, severity, attack_type
        FROM stream_alerts WHERE timestamp <> 'n/a' ORDER BY timestamp DESC, row_id DESC LIMIT 20""",
    "triage_per_file": f"{_STREAM}{_TRIAGE} SELECT * FROM per_file",
    "triage_total": f"""{_STREAM}{_TRIAGE}, worst AS (SELECT * FROM per_file ORDER BY top_score DESC, batch_id LIMIT 1),
        totals AS (
          SELECT CAST(sum(critical) AS BIGINT) AS critical, CAST(sum(high) AS BIGINT) AS high,
            CAST(sum(medium) AS BIGINT) AS medium FROM per_file)
        SELECT t.*, w.top_ip, w.unique_ips, w.top_score,
          CASE WHEN t.critical > 0 THEN 'Act now: ' || t.critical || ' critical alerts by ' || w.unique_ips
            || ' addresses, worst ' || w.top_ip || ' with ' || w.top_score || ' points'
          ELSE 'Nothing critical, high: ' || t.high || ', medium: ' || t.medium END AS message
        FROM totals t, worst w""",
}
