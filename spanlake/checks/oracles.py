"""SQL for DuckDB with the names and columns of the registered queries, over the given tables.

Written from the description of the data, not from the engine: attributes are plain columns here, rollups and
histograms are computed from the events themselves.
"""

from __future__ import annotations

EVENTS = """ev AS (
  SELECT event_id, user_id, event_type, value, props, epoch_us(ts) * 1000 AS ns,
    CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
    'svc-' || (user_id % 7) AS service, 't' || (event_id // 8) AS trace_id, 's' || event_id AS span_id,
    CASE user_id % 3 WHEN 0 THEN 'prod' WHEN 1 THEN 'staging' ELSE 'dev' END AS env
  FROM events)"""

LOGS = (
    EVENTS
    + """, logs AS (
  SELECT *, CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' ELSE 'INFO' END AS severity,
    CASE event_type WHEN 'error' THEN 17 WHEN 'signup' THEN 13 ELSE 9 END AS severity_number,
    event_type || ' user=' || user_id || ' props=' || props AS body,
    'u' || user_id AS session, CASE WHEN event_type = 'error' THEN 'g' || (k % 10) ELSE '' END AS grp
  FROM ev)"""
)

SPANS = (
    EVENTS
    + """, spans AS (
  SELECT *, CASE WHEN event_id % 8 = 0 THEN '' ELSE 's' || (event_id - event_id % 8) END AS parent_id,
    CASE WHEN event_type = 'purchase' THEN 'db.query' ELSE 'GET /' || event_type END AS name,
    CASE WHEN event_type = 'purchase' THEN 'Client' ELSE 'Server' END AS kind,
    CASE event_type WHEN 'error' THEN 'Error' WHEN 'signup' THEN 'Ok' ELSE 'Unset' END AS status,
    CASE WHEN event_type = 'error' THEN 'failed' ELSE '' END AS message,
    CAST(round(value * 1000000) AS BIGINT) AS duration,
    '/' || event_type AS route, CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS code,
    CASE WHEN event_type = 'purchase' THEN 'select * from t' || (k % 10) || ' where id = ?' ELSE '' END AS stmt,
    CASE WHEN event_type <> 'purchase' THEN '' WHEN k % 2 = 0 THEN 'mysql' ELSE 'postgresql' END AS sys,
    CASE WHEN event_id % 10 = 0 THEN 't' || (event_id // 8 - 1) ELSE '' END AS link_trace_id,
    's' || (event_id - 8) AS link_span_id
  FROM ev)"""
)

COUNTERS = (
    EVENTS
    + """, counters AS (
  SELECT service, event_type, m AS ns,
    CAST(sum(n) OVER (PARTITION BY service, event_type ORDER BY m) AS DOUBLE) AS v
  FROM (SELECT service, event_type, ns - ns % 60000000000 AS m, count(*) AS n FROM ev GROUP BY ALL))"""
)

HISTOGRAM = (
    EVENTS
    + """, bounded AS (
  SELECT service, ns - ns % 3600000000000 AS h, CAST(round(value * 1000000) AS BIGINT) AS nanos,
    CASE WHEN service = 'svc-6' THEN CASE WHEN value <= 10 THEN 0 WHEN value <= 100 THEN 1 ELSE 2 END
      WHEN value <= 5 THEN 0 WHEN value <= 10 THEN 1 WHEN value <= 25 THEN 2 WHEN value <= 50 THEN 3
      WHEN value <= 100 THEN 4 WHEN value <= 250 THEN 5 ELSE 6 END AS pos
  FROM ev), hours AS (
  SELECT service, h AS ns, sum(n) OVER w AS count, sum(nanos) OVER w / 1e6 AS total
  FROM (SELECT service, h, count(*) AS n, sum(nanos) AS nanos FROM bounded GROUP BY ALL)
  WINDOW w AS (PARTITION BY service ORDER BY h))"""
)


def _logs(where: str) -> str:
    return f"WITH {LOGS} SELECT ns, span_id, body AS line FROM logs WHERE {where}"


def _spans(where: str) -> str:
    return f"WITH {SPANS} SELECT ns, span_id, duration FROM spans WHERE {where}"


RESOURCE = "'deployment.environment.name=' || env || ';service.name=' || service"
LOG_ATTRIBUTES = "CASE WHEN grp <> '' THEN 'exception.group=' || grp || ';' ELSE '' END || 'session.id=' || session"
SPAN_ATTRIBUTES = """CASE WHEN stmt <> '' THEN 'db.query.text=' || stmt || ';db.system.name=' || sys || ';' ELSE '' END
  || 'http.response.status_code=' || code || ';http.route=' || route"""


def _stats(key: str, duration: str, quantile: str = "quantile_cont({d}, 0.95)") -> str:
    q = quantile.format(d=duration)
    return f"""{key} AS key, count(*) AS count, sum({duration}) / count(*) / 1e6 AS avg_ms,
      round({q} / 1e6, 9) AS p95_ms, max({duration}) / 1e6 AS max_ms, sum({duration}) / 1e6 AS total_ms"""


def _top(order: str) -> str:
    return f"""WITH line AS (
      SELECT CAST(l_partkey AS VARCHAR) AS part, CAST(round(l_extendedprice * 1000) AS BIGINT) AS d FROM lineitem),
    stats AS (SELECT {_stats("part", "d")}, {order} AS best FROM line GROUP BY part)
    SELECT key, count, avg_ms, p95_ms, max_ms, total_ms FROM stats ORDER BY best DESC, key LIMIT 25"""


def _traces(where: str, limit: int, columns: str, spans_per_trace: int | None = 50) -> str:
    fetched = "" if spans_per_trace is None else f"LIMIT {limit * spans_per_trace}"
    return f"""WITH {SPANS}, found AS (
      SELECT * FROM spans WHERE {where} ORDER BY ns DESC, trace_id, span_id {fetched}),
    ordered AS (
      SELECT *, row_number() OVER (PARTITION BY trace_id ORDER BY parent_id <> '', ns, span_id) AS r FROM found),
    folded AS (
      SELECT trace_id, max(ns) AS last_ns, count(*) AS spans, max(service) FILTER (r = 1) AS root_service_name,
        max(name) FILTER (r = 1) AS root_trace_name, max(ns // 1000000000) FILTER (r = 1) AS started,
        max(duration) FILTER (r = 1) / 1e6 AS duration_ms,
        string_agg(span_id || ':' || name || ':' || ns, ',' ORDER BY ns, span_id) AS listed
      FROM ordered GROUP BY trace_id)
    SELECT {columns} FROM folded ORDER BY last_ns DESC, trace_id LIMIT {limit}"""


def _increase(labels: str, where: str = "true", factor: str = "") -> str:
    return f"""WITH {COUNTERS} SELECT {labels}, CAST({_END} AS DOUBLE) AS timestamp,
      round((max(v) - min(v)){factor}, 6) AS value FROM counters WHERE {where} GROUP BY ALL"""


def _range(labels: str, step: int, factor: str = "") -> str:
    return f"""WITH {COUNTERS} SELECT {labels}, {_slot(step)} AS t, round((max(v) - min(v)){factor}, 9) AS value
      FROM counters GROUP BY ALL"""


def _slot(step: int) -> str:
    return f"ns // {step * 1_000_000_000} * {step}"


def _quantile(q: float, labels: str, keys: str, t: str = "", digits: int = 6) -> str:
    """Buckets counted from the events, then linear interpolation in the bucket that crosses the rank."""
    partition = f"PARTITION BY {keys}" if keys else ""
    return f"""WITH {HISTOGRAM}, sized AS (
      SELECT *, CASE WHEN service = 'svc-6' THEN [10.0, 100.0] ELSE [5.0, 10.0, 25.0, 50.0, 100.0, 250.0] END AS bs
      FROM bounded),
    slotted AS (SELECT *, h AS ns FROM sized),
    counted AS (SELECT {labels}{t} pos, count(*) AS n FROM slotted GROUP BY ALL),
    edges AS (SELECT {labels}{t} min(bs::DOUBLE[]) AS bs FROM slotted GROUP BY ALL),
    running AS (SELECT *, sum(n) OVER (PARTITION BY {keys or "1"} ORDER BY pos) AS cum,
      sum(n) OVER (PARTITION BY {keys or "1"}) AS total FROM counted),
    crossing AS (SELECT *, row_number() OVER (PARTITION BY {keys or "1"} ORDER BY pos) AS r
      FROM running WHERE cum >= {q} * total)
    SELECT {{columns}}, round(
      CASE WHEN pos = 0 THEN 0 ELSE coalesce(bs[pos], 0) END
      + (coalesce(bs[pos + 1], CASE WHEN pos = 0 THEN 0 ELSE coalesce(bs[pos], 0) END)
         - CASE WHEN pos = 0 THEN 0 ELSE coalesce(bs[pos], 0) END) * ({q} * total - (cum - n)) / n, {digits}) AS value
    FROM crossing, edges WHERE r = 1 {{on}}"""


_END = 1706745600

ORACLES = {
    "otlp_logs": f"""WITH {LOGS} SELECT ns, ns // 1000 AS us, trace_id, span_id, severity, severity_number::BIGINT AS
      severity_number, service, body, {RESOURCE} AS resource, {LOG_ATTRIBUTES} AS attributes,
      strftime(make_timestamp(ns // 1000), '%Y-%m-%d') AS day FROM logs""",
    "otlp_traces": f"""WITH {SPANS} SELECT ns, trace_id, span_id, parent_id, name, kind, service, duration, status,
      message, {RESOURCE} AS resource, {SPAN_ATTRIBUTES} AS attributes FROM spans""",
    "otlp_span_events": f"""WITH {SPANS} SELECT span_id, ns + 1000 AS ns, 'exception' AS name,
      'exception.type=E' || (k % 10) AS attributes FROM spans WHERE event_type = 'error'""",
    "otlp_span_links": f"""WITH {SPANS} SELECT span_id, link_trace_id, link_span_id, 0::BIGINT AS attribute_count
      FROM spans WHERE event_id % 5 = 0""",
    "otlp_metrics_sum": f"""WITH {COUNTERS} SELECT ns, 1704067200000000000 AS start_ns, 'events_total' AS name, service,
      'event.type=' || event_type AS attributes, v AS value, 2::BIGINT AS temporality, true AS monotonic
      FROM counters""",
    "otlp_metrics_gauge": f"""WITH {EVENTS} SELECT ns, 1704067200000000000 AS start_ns, 'queue_depth' AS name, service,
      'event.type=' || event_type AS attributes, value FROM ev""",
    "otlp_metrics_hist": f"""WITH {HISTOGRAM}, counted AS (SELECT service, h AS ns, pos, count(*) AS n FROM bounded
      GROUP BY ALL),
    arrays AS (SELECT service, ns, string_agg(coalesce(n, 0)::VARCHAR, ',' ORDER BY p) AS buckets FROM (
      SELECT hours.service, hours.ns, p, n FROM hours, range(7) t(p) LEFT JOIN counted
        ON counted.service = hours.service AND counted.ns = hours.ns AND pos = p
      WHERE p < CASE WHEN hours.service = 'svc-6' THEN 3 ELSE 7 END) GROUP BY ALL)
    SELECT ns, 1704067200000000000 AS start_ns, 'request_duration_milliseconds' AS name, service,
      'job=api' AS attributes, count::BIGINT AS count, round(total, 6) AS sum, buckets,
      CASE WHEN service = 'svc-6' THEN '10,100' ELSE '5,10,25,50,100,250' END AS bounds, 2::BIGINT AS temporality
    FROM hours JOIN arrays USING (service, ns)""",
    "otlp_attr_flatten": f"""WITH {EVENTS} SELECT span_id, k::VARCHAR AS body, 'bare=plain;bare_count=' || k ||
      ';bytes=AQID;count=' || k || ';flag=true;none=;ratio=1.5;text=' || event_type || ';twice=last' AS attributes
      FROM ev""",
    "otlp_default_service": f"""WITH {EVENTS} SELECT span_id, ns, 'unknown_service' AS service, event_type AS body
      FROM ev""",
    "otlp_snake_case": f"WITH {EVENTS} SELECT span_id, ns, 'svc' AS service, 9::BIGINT AS severity_number FROM ev",
    "otlp_enum_norm": f"""WITH {EVENTS}
      SELECT 'i' || event_id AS span_id, 'Server' AS kind, 'Error' AS status, 0::BIGINT AS duration FROM ev UNION ALL
      SELECT 'n' || event_id, 'Producer', 'Ok', 0 FROM ev UNION ALL
      SELECT 't' || event_id, 'Unspecified', 'Unset', 0 FROM ev UNION ALL
      SELECT 'x' || event_id, 'Unspecified', 'Unset', 0 FROM ev""",
    "otlp_quarantine": """SELECT 'rejected' AS what, count(*) FILTER (event_id % 2 = 0) AS n FROM events UNION ALL
      SELECT 'rows', 0""",
    "metric_names": f"""WITH {EVENTS} SELECT replace(service, '.', '_') || '_' || event_type || '_seen' ||
      CASE k % 8 WHEN 0 THEN '_milliseconds' WHEN 1 THEN '_seconds' WHEN 2 THEN '_bytes' WHEN 3 THEN '_bytes'
        WHEN 4 THEN '_bytes_per_second' WHEN 5 THEN '_percent' ELSE '' END ||
      CASE WHEN k % 2 = 0 THEN '_total' ELSE '' END AS metric, count(*) AS n FROM ev GROUP BY 1""",
    "sink_roundtrip": f"""WITH {SPANS} SELECT span_id, ns, duration, {SPAN_ATTRIBUTES} AS attributes,
      strftime(make_timestamp(ns // 1000), '%Y-%m-%d') AS day FROM spans""",
    "retention": """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events
      WHERE CAST(ts AS DATE) >= DATE '2024-02-01' - 20 GROUP BY 1""",
    "log_match_eq": _logs("service = 'svc-3'"),
    "log_match_neq": _logs("grp <> 'g3'"),
    "log_match_re": _logs("severity IN ('ERROR', 'WARN')"),
    "log_match_nre": _logs("NOT regexp_matches(grp, 'g[0-4]')"),
    "log_attr_fallback": _logs("env = 'prod' AND session <> 'u3'"),
    "log_line_contains": _logs("contains(body, 'purchase')"),
    "log_line_not_contains": _logs("NOT contains(body, 'view')"),
    "log_line_regex": _logs("regexp_matches(body, 'user=1[0-9] props.*7')"),
    "log_line_not_regex": _logs("NOT regexp_matches(body, '^(click|view)')"),
    "log_label_or": _logs("severity = 'ERROR' OR service = 'svc-1'"),
    "log_label_and": _logs("severity = 'ERROR' AND regexp_matches(grp, 'g[13579]')"),
    "log_time_range": _logs("ns BETWEEN 1704844800000000000 AND 1705708800000000000"),
    "log_search": f"""WITH {LOGS} SELECT ns, body AS line, grp AS exception_group FROM logs WHERE severity = 'ERROR'
      ORDER BY ns DESC, trace_id, span_id LIMIT 100""",
    "log_labels": f"""WITH {LOGS} SELECT span_id AS id, 'deployment.environment.name=' || env ||
      ';deployment_environment_name=' || env ||
      CASE WHEN grp <> '' THEN ';exception.group=' || grp || ';exception_group=' || grp ELSE '' END || ';level=' ||
      severity || ';service.name=' || service || ';service_name=' || service || ';session.id=' || session ||
      ';session_id=' || session || ';span_id=' || span_id || ';trace_id=' || trace_id AS labels FROM logs""",
    "log_label_values": "SELECT DISTINCT 'u' || user_id AS value FROM events ORDER BY 1 LIMIT 1000",
    "log_label_values_all": "SELECT DISTINCT 't' || (event_id // 8) AS value FROM events",
    "log_long_bodies": """SELECT source AS "ServiceName", count(*) AS n, sum(length(text))::BIGINT AS chars
      FROM documents WHERE contains(text, 'and') AND NOT regexp_matches(text, 'the.of', 's') GROUP BY 1""",
    "span_duration_filter": _spans("duration > 50000000"),
    "span_attr_numeric": _spans("code::BIGINT >= 500"),
    "span_name_regex": _spans("name IN ('GET /view', 'GET /click')"),
    "span_name_not_regex": _spans("NOT starts_with(name, 'GET')"),
    "span_attr_present": _spans("stmt <> ''"),
    "span_attr_absent": _spans("stmt = ''"),
    "span_attr_eq": _spans("route = '/signup'"),
    "span_attr_neq": _spans("sys <> 'mysql'"),
    "span_resource_eq": _spans("env = 'staging'"),
    "span_service_eq": _spans("service = 'svc-2'"),
    "span_status_error": _spans("status = 'Error'"),
    "span_kind_server": _spans("kind = 'Server'"),
    "trace_search": _traces("status = 'Error'", 20, "trace_id, spans"),
    "trace_search_all_spans": _traces("NOT contains(name, 'click')", 30, "trace_id, spans", None),
    "trace_root": _traces("NOT contains(name, 'click')", 2000, "trace_id, root_service_name, root_trace_name"),
    "trace_summary": _traces("true", 2000, "trace_id, started, duration_ms, listed AS spans"),
    "trace_waterfall": f"""WITH {SPANS} SELECT span_id, CASE WHEN parent_id = '' THEN 'none' ELSE parent_id END AS parent,
      name, service AS service_name, lower(kind) AS kind, ns AS start_nano, ns + duration AS end_nano,
      status = 'Error' AS has_error, CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END::BIGINT AS links
      FROM spans WHERE trace_id = 't10'""",
    "trace_services": f"""WITH {SPANS} SELECT service AS service_name, arg_min({RESOURCE}, (ns, span_id)) AS attributes
      FROM spans WHERE trace_id = 't10' GROUP BY service""",
    "trace_links": f"""WITH {SPANS} SELECT span_id AS span, link_trace_id, link_span_id FROM spans
      WHERE event_id % 10 = 0""",
    "tag_values": "SELECT DISTINCT '/' || event_type AS value FROM events",
    "tag_values_filtered": f"""WITH {SPANS} SELECT DISTINCT stmt AS value FROM spans WHERE stmt <> '' AND
      duration >= 100000000 ORDER BY 1 LIMIT 5""",
    "span_agg": f"WITH {SPANS} SELECT {_stats('route', 'duration')} FROM spans GROUP BY route",
    "span_agg_carry": f"""WITH {SPANS} SELECT {_stats("stmt", "duration")}, min(sys) AS db_system_name,
      min(env) AS deployment_environment_name FROM spans WHERE stmt <> '' AND duration > 1000000 GROUP BY stmt""",
    "span_top_total": _top("sum(d)"),
    "span_top_avg": _top("sum(d) / count(*)"),
    "span_top_p95": _top("quantile_cont(d, 0.95)"),
    "span_top_max": _top("max(d)"),
    "span_top_calls": _top("count(*)"),
    "span_agg_sketch": f"""WITH {SPANS}, stats AS (SELECT {_stats("route", "duration")} FROM spans GROUP BY route)
      SELECT * EXCLUDE (p95_ms) FROM stats""",
    "rollup_minute": f"""WITH {SPANS} SELECT ns // 60000000000 * 60 AS minute, stmt AS statement, sys AS system,
      count(*) AS calls, sum(duration)::BIGINT AS duration_sum, max(duration) AS duration_max,
      quantile_disc(duration, 0.5) AS median FROM spans WHERE name = 'db.query' GROUP BY ALL""",
    "rollup_rank": f"""WITH {SPANS}, stats AS (SELECT {_stats("stmt", "duration")}, min(sys) AS db_system_name
      FROM spans WHERE name = 'db.query' GROUP BY stmt)
      SELECT * EXCLUDE (p95_ms) FROM stats ORDER BY total_ms DESC, key LIMIT 5""",
    "rollup_p95": f"""WITH {SPANS} SELECT {_stats("stmt", "duration", "quantile_disc({d}, 0.95)")}
      FROM spans WHERE name = 'db.query' GROUP BY stmt""",
    "rollup_route": f"""WITH {SPANS} SELECT 'rollup' AS path, stmt AS key, count(*) AS count,
      sum(duration) / 1e6 AS total_ms FROM spans WHERE stmt <> '' GROUP BY stmt UNION ALL
      SELECT 'spans', stmt, count(*), sum(duration) / 1e6 FROM spans WHERE stmt <> '' AND service = 'svc-1'
      GROUP BY stmt""",
    "rollup_retention": """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS calls FROM events
      WHERE event_type = 'purchase' AND CAST(ts AS DATE) >= DATE '2024-02-01' - 15 GROUP BY 1""",
    "gauge_latest": f"""SELECT event_type, {_END}::DOUBLE AS timestamp, arg_max(value, ts) AS value FROM events
      GROUP BY 1""",
    "gauge_latest_global": f"SELECT {_END}::DOUBLE AS timestamp, arg_max(value, ts) AS value FROM events",
    "counter_increase": _increase("service AS service_name, event_type"),
    "counter_rate": _increase("service AS service_name, event_type", factor=f" / {31 * 86400}"),
    "hist_count_increase": f"""WITH {HISTOGRAM} SELECT service AS service_name, {_END}::DOUBLE AS timestamp,
      (max(count) - min(count))::DOUBLE AS value FROM hours GROUP BY 1""",
    "hist_sum_increase": f"""WITH {HISTOGRAM} SELECT service AS service_name, {_END}::DOUBLE AS timestamp,
      round(max(total) - min(total), 6) AS value FROM hours GROUP BY 1""",
    "hist_quantile": _quantile(0.95, "service,", "service").format(
        columns=f"crossing.service AS service_name, {_END}::DOUBLE AS timestamp", on="AND crossing.service = edges.service"
    ),
    "hist_quantile_global": _quantile(0.5, "", "").format(columns=f"{_END}::DOUBLE AS timestamp", on=""),
    "metric_match_eq": _increase("event_type", "service = 'svc-4'"),
    "metric_match_re": _increase("event_type", "event_type IN ('click', 'view')"),
    "metric_match_neq": _increase("event_type", "event_type <> 'view'"),
    "metric_match_nre": _increase("event_type"),
    "metric_match_fragment": _increase("event_type", "NOT regexp_matches(service, 'svc-[0-3]')"),
    "range_gauge_avg": f"""WITH {EVENTS} SELECT event_type, {_slot(3600)} AS t, round(avg(value), 9) AS value FROM ev
      GROUP BY ALL""",
    "range_rate": _range("service AS service_name, event_type", 7200, " / 7200"),
    "range_increase": _range("service AS service_name", 86400),
    "range_auto_step": _range("event_type", 10714),
    "range_rate_scaled": _range("event_type", 43200, " / 43200 * 60"),
    "range_hist_count_rate": f"""WITH {HISTOGRAM} SELECT service AS service_name, {_slot(21600)} AS t,
      round((max(count) - min(count)) / 21600 * 60, 9) AS value FROM hours GROUP BY ALL""",
    "range_hist_sum": f"""WITH {HISTOGRAM} SELECT service AS service_name, {_slot(21600)} AS t,
      round(max(total) - min(total), 9) AS value FROM hours GROUP BY ALL""",
    "range_hist_quantile": _quantile(0.9, "service,", "service, t", f" {_slot(14400)} AS t,", digits=9).format(
        columns="crossing.service AS service_name, crossing.t",
        on="AND crossing.service = edges.service AND crossing.t = edges.t",
    ),
    "counter_increase_per_series": f"""WITH {COUNTERS}, parts AS (
      SELECT service, event_type, max(v) - min(v) AS part FROM counters GROUP BY ALL)
    SELECT event_type, {_END}::DOUBLE AS timestamp, round(sum(part), 6) AS value FROM parts GROUP BY event_type""",
    "range_by_status_code": _range("event_type AS http_response_status_code", 86400),
    "hist_bucket_sum": f"""WITH {HISTOGRAM} SELECT service, pos::BIGINT AS pos, count(*) AS n,
      CASE WHEN service = 'svc-6' THEN 2 ELSE 6 END::BIGINT AS bounds FROM bounded GROUP BY ALL""",
    "range_series": f"""WITH {COUNTERS}, points AS (SELECT service, {_slot(86400)} AS t,
      (max(v) - min(v))::BIGINT AS value FROM counters GROUP BY ALL)
      SELECT service AS service_name, string_agg(t || ':' || value, ',' ORDER BY t) AS points FROM points GROUP BY 1""",
    "metric_label_values": "SELECT DISTINCT event_type AS value FROM events",
}
ORACLES["gauge_named_count"] = ORACLES["gauge_latest"]
ORACLES["rollup_compact"] = ORACLES["rollup_minute"]
_RANKING = f"""WITH {SPANS} SELECT {_stats("stmt", "duration", "quantile_disc({d}, 0.95)")}, min(sys) AS db_system_name
  FROM spans WHERE name = 'db.query' GROUP BY stmt"""
ORACLES |= dict.fromkeys(["rollup_stream", "rollup_backfill", "rollup_stitched"], _RANKING)
ORACLES["rollup_p95_bounds"] = f"""WITH {SPANS} SELECT stmt AS statement, count(*) AS calls, CAST(0 AS BIGINT) AS rank_error,
  true AS within_bound FROM spans WHERE name = 'db.query' GROUP BY stmt"""
ORACLES["log_match_indexed"] = ORACLES["log_line_contains"]
ORACLES["log_label_values_indexed"] = ORACLES["log_label_values"]
ORACLES["trace_by_id_indexed"] = ORACLES["trace_waterfall"]
ORACLES["tag_values_indexed"] = ORACLES["tag_values"]
ORACLES["sink_metrics"] = " UNION ALL ".join(
    f"SELECT '{kind}' AS kind, count(*) AS n FROM ({ORACLES[name]})"
    for kind, name in (("sum", "otlp_metrics_sum"), ("gauge", "otlp_metrics_gauge"), ("histogram", "otlp_metrics_hist"))
)
ORACLES["sink_bounded_files"] = "SELECT count(*) AS n, CAST(0 AS BIGINT) AS files_over FROM events"
ORACLES["sink_empty_write"] = "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1"
ORACLES["sink_clustered"] = "SELECT count(*) AS n, CAST(0 AS BIGINT) AS out_of_order FROM events"
ORACLES["sink_repeated_batches"] = ORACLES["sink_metrics"]
ORACLES["ingest_stream"] = ORACLES["sink_empty_write"]
