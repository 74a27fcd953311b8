"""Independent statement of each registered query for DuckDB, over the same Parquet tables.

The texts use plain windows, joins and aggregates on purpose; none follows the Spark plan.
"""

from __future__ import annotations

from runpulse import schemas
from runpulse.operators import diagnosis
from runpulse.operators.alerts import ANOMALY_COLOUR, COLOUR, EMOJI, LINK, NO_COLOUR, NO_EMOJI
from runpulse.sources.derived import AS_OF, ERROR_TEXTS, TIES_AS_OF


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_q(v) for v in values) + "]"


def _case(key: str, table: dict, default: str) -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in table.items())
    return f"CASE {key} {whens} ELSE {_q(default)} END"


def _fixed(x: str, digits: int = 1) -> str:
    """Decimal text, halves up."""
    return f"CAST(CAST(round(CAST({x} AS DECIMAL(30, 10)), {digits}) AS DECIMAL(28, {digits})) AS VARCHAR)"


def _half_up(x: str, digits: int = 1) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(30, 10)), {digits}) AS DOUBLE)"


T0 = f"TIMESTAMP '{AS_OF}'"

# --- shared tables ----------------------------------------------------------------------------------

CTE: dict[str, str] = {}

CTE["runs"] = f"""
SELECT event_id AS id, 'dag_' || user_id AS pipeline_id, 'team_' || (user_id % 5) AS team,
       'task_' || (event_id % 4) AS task_id, 'run_' || event_id AS run_id,
       ts AS execution_date, ts AS start_date,
       ts + to_microseconds(CAST(round(value / 0.9973::DOUBLE * 1000000) AS BIGINT)) AS end_date,
       value / 0.9973::DOUBLE AS duration_seconds,
       CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'running' ELSE 'success' END AS state,
       CAST(json_extract_string(props, '$.k') AS BIGINT) * 1000 AS row_count,
       CASE WHEN event_type = 'error' THEN event_id % 6 END AS error_id,
       CASE WHEN event_type = 'error' THEN {_list(ERROR_TEXTS)}[event_id % 6 + 1] END AS error_message,
       CASE WHEN event_type = 'error' THEN
         ['MemoryError', 'SchemaMismatch', 'TimeoutError', 'AccessError', 'LookupError',
          'ServiceError'][event_id % 6 + 1] END AS error_type
FROM events"""

CTE["ties"] = """
SELECT o_orderkey AS id, 'dag_' || o_custkey AS pipeline_id, 'run_' || o_orderkey AS run_id,
       o_orderdate AS execution_date, o_totalprice / 997.3::DOUBLE AS duration_seconds,
       CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'P' THEN 'failed' ELSE 'running' END AS state
FROM orders"""

CTE["done"] = "SELECT * FROM runs WHERE state IN ('success', 'failed')"
CTE["done_ties"] = "SELECT * FROM ties WHERE state IN ('success', 'failed')"


def _baselines(source: str, as_of: str, days: int, min_runs: int = 5) -> str:
    return f"""
SELECT pipeline_id, count(*) AS total_runs, coalesce(avg(duration_seconds), 0) AS avg_duration,
       coalesce(stddev_samp(duration_seconds), 0) AS stddev_duration,
       coalesce(avg(duration_seconds) + 2 * stddev_samp(duration_seconds), 0) AS upper_threshold,
       greatest(0, avg(duration_seconds) - 2 * stddev_samp(duration_seconds)) AS lower_threshold,
       max(execution_date) AS last_run, count(*) FILTER (state = 'failed') AS failure_count,
       CAST(round(CAST(100.0 * count(*) FILTER (state = 'success') AS DECIMAL(30, 10)) / count(*), 2) AS DOUBLE) AS success_rate_pct
FROM {source} WHERE execution_date > TIMESTAMP '{as_of}' - INTERVAL {days} DAY
GROUP BY pipeline_id HAVING count(*) >= {min_runs}"""


def _latest(source: str) -> str:
    return f"""
SELECT pipeline_id, run_id, execution_date, coalesce(duration_seconds, 0) AS duration_seconds, state FROM {source}
QUALIFY row_number() OVER (PARTITION BY pipeline_id ORDER BY execution_date DESC, id DESC) = 1"""


def _judged(baselines: str, latest: str) -> str:
    return f"""
SELECT b.*, l.run_id, l.execution_date, l.duration_seconds AS current_duration, l.state,
       round((l.duration_seconds - avg_duration) / greatest(avg_duration, 1) * 100, 1) AS deviation_pct,
       l.duration_seconds > upper_threshold AND upper_threshold > 0 AS is_anomaly
FROM {baselines} b JOIN {latest} l USING (pipeline_id)"""


CTE["baselines"] = _baselines("done", AS_OF, 30)
CTE["latest"] = _latest("done")
CTE["judged"] = _judged("baselines", "latest")
CTE["baselines_ties"] = _baselines("done_ties", TIES_AS_OF, 3650)
CTE["latest_ties"] = _latest("done_ties")
CTE["judged_ties"] = _judged("baselines_ties", "latest_ties")
CTE["anomalies"] = "SELECT * FROM judged WHERE is_anomaly"


def _asof(source: str, days: int, min_runs: int) -> str:
    frame = (
        f"OVER (PARTITION BY pipeline_id ORDER BY execution_date RANGE BETWEEN INTERVAL {days} DAY PRECEDING "
        "AND INTERVAL 1 MICROSECOND PRECEDING)"
    )
    return f"""
SELECT *, prior_avg + 2 * prior_stddev AS prior_upper FROM (
  SELECT pipeline_id, id, run_id, execution_date, coalesce(duration_seconds, 0) AS current_duration,
         count(*) {frame} AS prior_rows, avg(duration_seconds) {frame} AS prior_avg,
         stddev_samp(duration_seconds) {frame} AS prior_stddev
  FROM {source}) WHERE prior_rows >= {min_runs}"""


CTE["prior"] = _asof("done", 30, 5)
CTE["prior_ties"] = _asof("done_ties", 365, 2)
CTE["done_odd"] = """
SELECT * REPLACE (CASE WHEN id % 50 = 0 AND duration_seconds IS NOT NULL THEN 1e9 ELSE duration_seconds END AS duration_seconds) FROM done"""
CTE["prior_odd"] = _asof("done_odd", 3, 2)
CTE["rolling"] = """
SELECT *, round((current_duration - prior_avg) / greatest(prior_avg, 1) * 100, 1) AS deviation_pct
FROM prior WHERE current_duration > prior_upper AND prior_upper > 0"""

CTE["robust"] = f"""
SELECT pipeline_id, count(*) AS total_runs,
       round(100.0 * count(*) FILTER (state = 'failed') / count(*), 2) AS failure_rate_pct,
       quantile_cont(duration_seconds, 0.5) AS median_duration, quantile_cont(duration_seconds, 0.95) AS p95_duration
FROM done WHERE execution_date > {T0} - INTERVAL 30 DAY GROUP BY pipeline_id HAVING count(*) >= 5"""

CTE["ranked"] = """
SELECT *, row_number() OVER (PARTITION BY pipeline_id ORDER BY execution_date DESC, id DESC) AS recency FROM done"""


def _answer(confidence: str, severity: str, prevention: bool = True) -> str:
    middle = """ || '", "prevention": "check ' || error_id""" if prevention else ""
    return f"""'{{"root_cause": "cause ' || error_id || '", "root_cause_category": "' || cat || '", "confidence": ' || {confidence}
    || ', "immediate_fix": "fix ' || error_id{middle} || '", "retry_recommended": '
    || CASE WHEN error_id % 2 = 0 THEN 'true' ELSE 'false' END || ', "estimated_fix_time_minutes": ' || (5 + error_id * 5)
    || ', "severity": "' || {severity} || '", "affected_downstream": "reports", "similar_past_incidents": "none"}}'"""


_PLAIN = _answer("'0.' || (50 + id % 50) || '137'", "sev")

CTE["responses"] = f"""
SELECT *, CASE id % 5 WHEN 0 THEN {_PLAIN}
  WHEN 1 THEN 'The analysis follows.' || chr(10) || {_PLAIN} || chr(10) || 'End of answer.'
  WHEN 2 THEN 'No structured answer was given.'
  WHEN 3 THEN {_answer("'1.7'", "'urgent'", False)}
  ELSE {_answer("'" + '"high"' + "'", 'sev')} END AS response
FROM (SELECT *,
  ['data_issue', 'connectivity', 'resource_exhaustion', 'resource_exhaustion', 'permission_denied', 'connectivity'][error_id + 1] AS cat,
  ['high', 'medium', 'critical', 'high', 'high', 'low'][error_id + 1] AS sev
  FROM runs WHERE state = 'failed')"""

_GET = {
    "root_cause": "VARCHAR", "root_cause_category": "VARCHAR", "confidence": "DOUBLE", "immediate_fix": "VARCHAR",
    "prevention": "VARCHAR", "retry_recommended": "BOOLEAN", "estimated_fix_time_minutes": "INTEGER",
    "severity": "VARCHAR", "affected_downstream": "VARCHAR", "similar_past_incidents": "VARCHAR",
}
CTE["found"] = r"""
SELECT *, CASE WHEN json_valid(response) THEN 'ok'
               WHEN json_valid(regexp_extract(response, '(?s)\{.*\}')) THEN 'extracted' ELSE 'parse_error' END AS status,
       CASE WHEN json_valid(response) THEN response
            WHEN json_valid(regexp_extract(response, '(?s)\{.*\}')) THEN regexp_extract(response, '(?s)\{.*\}') END AS body
FROM responses"""
CTE["parsed"] = (
    "SELECT id, status, "
    + ", ".join(f"TRY_CAST(json_extract_string(body, '$.{c}') AS {t}) AS {c}" for c, t in _GET.items())
    + " FROM found"
)
CTE["filled"] = f"""
SELECT id, status, CASE WHEN status = 'parse_error' THEN 'no diagnosis (parse_error)' ELSE root_cause END AS root_cause,
  CASE WHEN status = 'parse_error' THEN 'configuration' ELSE root_cause_category END AS root_cause_category,
  CASE WHEN status = 'parse_error' THEN 0.0 ELSE confidence END AS confidence,
  CASE WHEN status = 'parse_error' THEN 'read the messages of the run itself' ELSE immediate_fix END AS immediate_fix,
  CASE WHEN status = 'parse_error' THEN 'not known' ELSE prevention END AS prevention,
  CASE WHEN status = 'parse_error' THEN true ELSE retry_recommended END AS retry_recommended,
  CASE WHEN status = 'parse_error' THEN 10 ELSE estimated_fix_time_minutes END AS estimated_fix_time_minutes,
  CASE WHEN status = 'parse_error' THEN 'medium' ELSE severity END AS severity
FROM parsed"""
CTE["diagnosed"] = """
SELECT r.*, r.end_date AS created_at, f.root_cause AS rca_root_cause, f.root_cause_category AS rca_category,
  f.confidence AS rca_confidence, f.immediate_fix AS rca_immediate_fix, f.prevention AS rca_prevention,
  f.severity AS rca_severity, f.retry_recommended AS rca_retry_recommended,
  f.estimated_fix_time_minutes AS rca_estimated_fix_minutes,
  CASE WHEN f.id IS NOT NULL THEN r.end_date END AS rca_generated_at,
  CASE WHEN f.id IS NOT NULL THEN 'rules-1' END AS rca_model_used,
  CASE WHEN f.id IS NOT NULL THEN length(r.error_message) / 9.973::DOUBLE END AS rca_response_time_seconds
FROM runs r LEFT JOIN filled f USING (id)"""

CTE["signed"] = r"""
SELECT *, lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(error_message,
  '0x[0-9a-fA-F]+', '<hex>', 'g'), '(/[A-Za-z0-9_.\-]+)+', '<path>', 'g'), '[0-9]+', '<n>', 'g'), '\s+', ' ', 'g'))) AS signature
FROM runs WHERE state = 'failed'"""


def _history(source: str, days: int) -> str:
    return f"""
SELECT f.id, any_value(f.pipeline_id) AS pipeline_id, count(e.id) AS total_runs,
  coalesce({_half_up('avg(e.duration_seconds)')}, 0) AS avg_duration,
  coalesce(array_to_string((list(e.state ORDER BY e.execution_date DESC, e.id DESC) FILTER (e.id IS NOT NULL))[1:3], ', '), '') AS recent_statuses
FROM {source} f LEFT JOIN {source} e ON e.pipeline_id = f.pipeline_id
  AND e.execution_date > f.execution_date - INTERVAL {days} DAY
  AND (e.execution_date < f.execution_date OR (e.execution_date = f.execution_date AND e.id < f.id))
WHERE f.state = 'failed' GROUP BY f.id"""


CTE["history"] = _history("runs", 30)
CTE["alerts"] = f"""
SELECT id AS alert_id, pipeline_id, task_id, execution_date, upper(rca_severity) AS severity,
  {_case('upper(rca_severity)', EMOJI, NO_EMOJI)} AS emoji, {_case('upper(rca_severity)', COLOUR, NO_COLOUR)} AS colour,
  CAST(trunc(coalesce(rca_confidence, 0) * 100) AS INTEGER) AS confidence_pct,
  array_to_string(list_transform(string_split(rca_category, '_'), lambda w: upper(w[1]) || w[2:]), ' ') AS category,
  rca_root_cause AS root_cause, coalesce(rca_immediate_fix, 'not known') AS immediate_fix,
  coalesce(rca_prevention, 'not known') AS prevention,
  coalesce(CAST(rca_estimated_fix_minutes AS VARCHAR), '?') AS fix_minutes,
  CASE WHEN rca_retry_recommended THEN 'Yes' ELSE 'No' END AS retry, coalesce(rca_model_used, 'unknown') AS model,
  error_message AS error_excerpt, strftime(created_at, '%Y-%m-%d %H:%M UTC') AS generated,
  lower(rca_severity) || ' / ' || pipeline_id || ' / ' || task_id || ' / ' || category AS subject,
  '{LINK}' || pipeline_id AS link
FROM diagnosed WHERE state = 'failed' AND rca_root_cause IS NOT NULL"""
CTE["anomaly_rows"] = f"""
SELECT pipeline_id, run_id, execution_date, 'MEDIUM' AS severity, '{ANOMALY_COLOUR}' AS colour,
  'medium / ' || pipeline_id || ' / slow run' AS subject,
  {_fixed('current_duration', 0)} || ' s instead of ' || {_fixed('avg_duration', 0)} || ' s: not explained' AS text,
  'unknown' AS likely_cause, 'compare this run with the ones before it' AS recommended_action,
  false AS escalate_to_oncall, 'No' AS escalate, current_duration, avg_duration, deviation_pct, '{LINK}' || pipeline_id AS link
FROM anomalies"""

CTE["counter"] = """
SELECT ts, node, mode, (counted % 5000000) / 1000.0 AS value FROM (
  SELECT ts, CAST(user_id % 8 AS VARCHAR) AS node, CASE WHEN event_id % 2 = 0 THEN 'idle' ELSE 'user' END AS mode,
    CAST(sum(CAST(floor(value * 1000) AS BIGINT)) OVER (PARTITION BY user_id % 8, event_id % 2 ORDER BY ts, event_id
      ROWS UNBOUNDED PRECEDING) AS BIGINT) AS counted FROM events)"""
CTE["gauges"] = """
SELECT ts, 'node_memory_total' AS metric, CAST(user_id % 8 AS VARCHAR) AS node, NULL AS pipeline, NULL AS namespace, 1000.0::DOUBLE AS value FROM events
UNION ALL SELECT ts, 'node_memory_available', CAST(user_id % 8 AS VARCHAR), NULL, NULL, 1000.0 - value FROM events
UNION ALL SELECT ts, 'run_success', NULL, 'dag_' || user_id, NULL, CASE WHEN event_type IN ('error', 'signup') THEN 0.0 ELSE 1.0 END FROM events
UNION ALL SELECT ts, 'run_failed', NULL, 'dag_' || user_id, NULL, CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END FROM events
UNION ALL SELECT ts, 'run_duration', NULL, 'dag_' || user_id, 'ns_' || (user_id % 3), value / 0.9973::DOUBLE FROM events"""
CTE["steps"] = "SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 HOUR)) AS step"
CTE["instant"] = """
SELECT step, metric, node, pipeline, namespace, max({'ts': ts, 'value': value}).value AS value
FROM gauges JOIN steps ON ts > step - INTERVAL 6 HOUR AND ts <= step
GROUP BY step, metric, node, pipeline, namespace"""
CTE["rates"] = """
SELECT step, node, mode, sum(CASE WHEN rn > 1 THEN gained ELSE 0 END) / (epoch_us(max(ts)) - epoch_us(min(ts))) * 1000000 AS rate FROM (
  SELECT step, node, mode, ts, row_number() OVER w AS rn,
    CASE WHEN value < lag(value) OVER w THEN value ELSE value - lag(value) OVER w END AS gained
  FROM counter JOIN steps ON ts > step - INTERVAL 6 HOUR AND ts <= step
  WINDOW w AS (PARTITION BY step, node, mode ORDER BY ts, value))
GROUP BY step, node, mode HAVING count(*) >= 2 AND max(ts) > min(ts)"""

CTE["edges"] = """
SELECT DISTINCT 'dag_' || i AS upstream, 'dag_' || j AS downstream FROM (
  SELECT i, unnest([2 * i + 1, 2 * i + 2, CASE WHEN (7 * i + 3) % n > i THEN (7 * i + 3) % n END]) AS j, n
  FROM (SELECT DISTINCT user_id AS i, max(user_id) OVER () + 1 AS n FROM events)) WHERE j < n"""
CTE["limits"] = """
SELECT DISTINCT 'dag_' || user_id AS pipeline_id, 100.0::DOUBLE + user_id % 5 * 50 AS limit_seconds FROM events"""
CTE["drift"] = f"""
SELECT pipeline_id, count(*) AS days, avg(mean) AS mean_duration, regr_slope(mean, day) AS slope_per_day FROM (
  SELECT pipeline_id, date_diff('day', {T0} - INTERVAL 30 DAY, execution_date) AS day, avg(duration_seconds) AS mean
  FROM done WHERE execution_date > {T0} - INTERVAL 30 DAY GROUP BY ALL) GROUP BY pipeline_id HAVING count(*) >= 3"""
CTE["spikes"] = f"""
WITH spine AS (SELECT p.pipeline_id, d.day FROM (SELECT DISTINCT pipeline_id FROM runs) p, (SELECT unnest(range(0, 31)) AS day) d),
daily AS (SELECT pipeline_id, date_diff('day', {T0} - INTERVAL 30 DAY, execution_date) AS day, count(*) AS n FROM runs
  WHERE state = 'failed' AND execution_date > {T0} - INTERVAL 30 DAY GROUP BY ALL),
filled AS (SELECT s.*, coalesce(n, 0) AS failures FROM spine s LEFT JOIN daily USING (pipeline_id, day)),
framed AS (SELECT *, avg(failures) OVER w AS expected, avg(failures) OVER w + 2 * stddev_samp(failures) OVER w AS limit_,
  count(*) OVER w AS seen FROM filled WINDOW w AS (PARTITION BY pipeline_id ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT pipeline_id, {T0} - INTERVAL 30 DAY + to_days(CAST(day AS INTEGER)) AS execution_date, failures, expected, limit_ AS "limit"
FROM framed WHERE seen = 7 AND failures > limit_"""


def _streaks(source: str, least: int) -> str:
    return f"""
SELECT pipeline_id, min(execution_date) AS first_failure, max(execution_date) AS last_failure, count(*) AS length FROM (
  SELECT *, row_number() OVER (PARTITION BY pipeline_id ORDER BY execution_date, id)
          - row_number() OVER (PARTITION BY pipeline_id, state ORDER BY execution_date, id) AS island FROM {source})
WHERE state = 'failed' GROUP BY pipeline_id, island HAVING count(*) >= {least}"""


CTE["streaks"] = _streaks("done", 3)
CTE["low"] = """
SELECT pipeline_id, max(run_id) FILTER (recency = 1) AS run_id, max(execution_date) AS execution_date, count(*) AS runs,
  100.0::DOUBLE * count(*) FILTER (state = 'success') / count(*) AS success_pct
FROM ranked WHERE recency <= 10 GROUP BY pipeline_id
HAVING count(*) >= 10 AND 100.0 * count(*) FILTER (state = 'success') / count(*) < 80"""
CTE["row_counts"] = """
SELECT pipeline_id, run_id, execution_date, 'row_count' AS rule, CAST(rows AS DOUBLE) AS observed, mean_rows AS expected,
  round(100.0 * (rows - mean_rows) / nullif(mean_rows, 0), 1) AS deviation_pct FROM (
  SELECT pipeline_id, max(run_id) FILTER (recency = 1) AS run_id, max(execution_date) FILTER (recency = 1) AS execution_date,
    max(row_count) FILTER (recency = 1) AS rows, avg(row_count) FILTER (recency > 1) AS mean_rows,
    count(*) FILTER (recency > 1) AS earlier FROM ranked WHERE recency <= 11 GROUP BY pipeline_id)
WHERE earlier >= 5 AND abs(rows - mean_rows) > 0.3 * mean_rows"""
CTE["throughput"] = f"""
WITH rated AS (SELECT *, row_count / nullif(duration_seconds, 0) AS rate FROM done WHERE duration_seconds <> 0 AND row_count IS NOT NULL),
normal AS (SELECT pipeline_id, avg(rate) AS mean, stddev_samp(rate) AS sigma FROM rated
  WHERE execution_date > {T0} - INTERVAL 30 DAY GROUP BY pipeline_id HAVING count(*) >= 5),
newest AS (SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY pipeline_id ORDER BY execution_date DESC, id DESC) = 1)
SELECT pipeline_id, run_id, execution_date, 'throughput' AS rule, rate AS observed, mean AS expected,
  round((rate - mean) / greatest(mean, 1) * 100, 1) AS deviation_pct
FROM newest JOIN normal USING (pipeline_id) WHERE abs(rate - mean) > 2 * sigma"""
CTE["above_median"] = """
SELECT pipeline_id, run_id, execution_date, 'above_median' AS rule, duration_seconds AS observed, 1.8 * median_duration AS expected,
  round((duration_seconds - median_duration) / greatest(median_duration, 1) * 100, 1) AS deviation_pct
FROM robust JOIN latest USING (pipeline_id) WHERE duration_seconds > 1.8 * median_duration"""


def _gap_groups(source: str, keys: str) -> str:
    return f"""
SELECT *, sum(fresh) OVER (PARTITION BY {keys} ORDER BY execution_date, id ROWS UNBOUNDED PRECEDING) AS grp FROM (
  SELECT *, CASE WHEN execution_date - lag(execution_date) OVER (PARTITION BY {keys} ORDER BY execution_date, id)
    <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM {source})"""


CTE["alert_events"] = """
SELECT id, pipeline_id, execution_date, 'failure' AS rule, md5(signature) AS fingerprint, 3 AS rank, 0.0::DOUBLE AS deviation_pct FROM signed
UNION ALL SELECT id, pipeline_id, execution_date, 'slow_run', '-', 2, deviation_pct FROM rolling"""

NEEDS = {
    "done": ["runs"], "done_ties": ["ties"], "baselines": ["done"], "latest": ["done"], "judged": ["baselines", "latest"],
    "baselines_ties": ["done_ties"], "latest_ties": ["done_ties"], "judged_ties": ["baselines_ties", "latest_ties"],
    "anomalies": ["judged"], "prior": ["done"], "prior_ties": ["done_ties"], "done_odd": ["done"], "prior_odd": ["done_odd"], "rolling": ["prior"], "robust": ["done"],
    "ranked": ["done"], "responses": ["runs"], "found": ["responses"], "parsed": ["found"], "filled": ["parsed"],
    "diagnosed": ["runs", "filled"], "signed": ["runs"], "history": ["runs"], "alerts": ["diagnosed"],
    "anomaly_rows": ["anomalies"], "instant": ["gauges", "steps"], "rates": ["counter", "steps"], "drift": ["done"],
    "spikes": ["runs"], "streaks": ["done"], "low": ["ranked"], "row_counts": ["ranked"], "throughput": ["done"],
    "above_median": ["robust", "latest"], "alert_events": ["signed", "rolling"],
}


def _sql(body: str, *uses: str) -> str:
    """`body` with the shared tables it uses, and those they use, in front."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in uses:
        add(name)
    head = ",\n".join(f"{name} AS ({CTE[name].strip()})" for name in order)
    return (f"WITH {head}\n" if head else "") + body.strip()


def _r(*cols: str) -> str:
    return ", ".join(f"round({c}, 4) AS {c}" for c in cols)


_BASE = "pipeline_id, total_runs, " + _r("avg_duration", "stddev_duration", "upper_threshold", "lower_threshold") + ", last_run, failure_count, " + _r("success_rate_pct")
_ANOMALY = "pipeline_id, " + _r("current_duration", "avg_duration", "stddev_duration", "upper_threshold", "deviation_pct") + ", run_id, execution_date, total_runs, " + _r("success_rate_pct")
_HIT = "pipeline_id, run_id, execution_date, rule, " + _r("observed", "expected", "deviation_pct")
_ASOF = "pipeline_id, id, " + _r("current_duration") + ", prior_rows, " + _r("prior_avg", "prior_stddev", "prior_upper")


def _change(source: str) -> str:
    return f"""
SELECT pipeline_id, id, execution_date, round(duration_seconds, 4) AS duration_seconds, round(previous_duration, 4) AS previous_duration,
  CASE WHEN previous_duration IS NOT NULL THEN
    round((duration_seconds - previous_duration) / greatest(previous_duration, 1.0) * 100, 1) END AS change_pct
FROM (SELECT *, lag(duration_seconds) OVER (PARTITION BY pipeline_id ORDER BY execution_date, id) AS previous_duration FROM {source})"""


def _violations() -> str:
    parts = [f"CASE WHEN {c} IS NULL THEN 'missing {c}' END" for c in _GET]
    parts += [
        f"CASE WHEN root_cause_category IS NOT NULL AND root_cause_category NOT IN ({', '.join(map(_q, schemas.CATEGORIES))}) THEN 'unknown category' END",
        f"CASE WHEN severity IS NOT NULL AND severity NOT IN ({', '.join(map(_q, schemas.SEVERITIES))}) THEN 'unknown severity' END",
        "CASE WHEN confidence NOT BETWEEN 0 AND 1 THEN 'confidence outside 0..1' END",
    ]
    return "list_filter([" + ", ".join(parts) + "], lambda x: x IS NOT NULL)"


_BLOCKS = " || ',' || ".join(
    f"CAST(json_object('part', {parts}) AS VARCHAR)"
    for parts in (
        "'what', 'emoji', emoji, 'severity', severity, 'pipeline_id', pipeline_id, 'task_id', task_id, 'link', link",
        "'why', 'category', category, 'root_cause', root_cause, 'confidence_pct', CAST(confidence_pct AS VARCHAR), 'model', model",
        "'then', 'immediate_fix', immediate_fix, 'prevention', prevention, 'fix_minutes', fix_minutes, 'retry', retry",
    )
)

_RULE_CASE = lambda field: "CASE " + " ".join(
    f"WHEN regexp_matches(error_message, {_q(rule[0])}) THEN {_q(rule[field])}" for rule in diagnosis.ERROR_RULES
) + f" ELSE {_q(diagnosis.DEFAULT_RULE[field - 1])} END"

_PROMPT = f"""
'Why did `run` fail? Reply with nothing but a JSON object that has the keys of `answer`.' || chr(10) || CAST(json_object(
  'run', json_object('pipeline_id', r.pipeline_id, 'task_id', task_id, 'execution_date', strftime(execution_date, '%Y-%m-%d %H:%M:%S'),
    'duration_seconds', {_fixed('duration_seconds')}, 'error_type', error_type, 'error_message', error_message),
  'before', json_object('total_runs', CAST(total_runs AS VARCHAR), 'avg_duration', {_fixed('avg_duration')}, 'recent_statuses', recent_statuses),
  'log', error_message,
  'answer', json_object('keys', {_q(', '.join(_GET))}, 'root_cause_category', {_q(', '.join(schemas.CATEGORIES))},
    'severity', {_q(', '.join(schemas.SEVERITIES))})) AS VARCHAR)"""

_ANOMALY_PROMPT = f"""
'Why did `run` take so long? Reply with nothing but a JSON object that has the keys of `answer`.' || chr(10) || CAST(json_object(
  'run', json_object('pipeline_id', a.pipeline_id, {', '.join(f"'{c}', {_fixed(c)}" for c in (
      'current_duration', 'avg_duration', 'stddev_duration', 'deviation_pct', 'upper_threshold', 'success_rate_pct'))},
    'total_runs', CAST(total_runs AS VARCHAR)),
  'last_runs', lines,
  'answer', json_object('keys', {_q(', '.join(schemas.ANOMALY_DIAGNOSIS.fieldNames()))}, 'likely_cause', {_q(', '.join(schemas.ANOMALY_CAUSES))})) AS VARCHAR)"""

_RUNBOOK = "(VALUES " + ", ".join(f"({_q(c)}, {_q(a)}, {str(s).lower()})" for c, a, s in diagnosis.RUNBOOK) + ") AS b(category, action, is_safe)"
_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _by_step(value: str, name: str, metric: str, where: str = "true") -> str:
    return f"""
SELECT s.step, round(coalesce(CAST(v AS DOUBLE), 0), 4) AS {name} FROM steps s LEFT JOIN (
  SELECT step, {value} AS v FROM instant WHERE metric = '{metric}' AND {where} GROUP BY step) x USING (step)"""


_RATIO = """
SELECT step, sum(value) FILTER (metric = 'run_success') / (sum(value) FILTER (metric = 'run_success') + sum(value) FILTER (metric = 'run_failed') + 0.001) AS ratio
FROM instant WHERE metric IN ('run_success', 'run_failed') GROUP BY step"""

_FEED = """
SELECT 'failure' AS kind, alert_id, pipeline_id, task_id, execution_date, severity, subject, NULL::VARCHAR AS run_id, NULL::BOOLEAN AS escalate_to_oncall FROM alerts
UNION ALL SELECT 'anomaly', NULL, pipeline_id, NULL, execution_date, severity, subject, run_id, escalate_to_oncall FROM anomaly_rows"""

_FAILED_IN = lambda low, high: f"SELECT DISTINCT pipeline_id FROM runs WHERE state = 'failed' AND execution_date > {T0} - INTERVAL {low} DAY{high}"

ORACLES: dict[str, str] = {
    "scan_runs": _sql("SELECT id, pipeline_id, task_id, run_id, execution_date, end_date, round(duration_seconds, 4) AS duration_seconds, state, error_type FROM runs", "runs"),
    "append_runs": _sql("SELECT id, pipeline_id, strftime(execution_date, '%Y-%m-%d') AS run_date, state, round(duration_seconds, 4) AS duration_seconds, length(error_message) AS message_length FROM runs", "runs"),
    "merge_diagnoses": _sql("SELECT id, state, rca_root_cause, rca_category, round(rca_confidence, 4) AS rca_confidence, rca_immediate_fix, rca_prevention, rca_severity, rca_retry_recommended, rca_estimated_fix_minutes, rca_generated_at, rca_model_used FROM diagnosed", "diagnosed"),
    "stored_diagnoses": _sql("SELECT id, strftime(execution_date, '%Y-%m-%d') AS run_date, state, rca_root_cause, rca_category, round(rca_confidence, 4) AS rca_confidence, rca_immediate_fix, rca_prevention, rca_severity, rca_retry_recommended, rca_estimated_fix_minutes, rca_generated_at, rca_model_used FROM diagnosed", "diagnosed"),
    "current_rows_stream": _sql("SELECT id, pipeline_id, execution_date, CASE WHEN id % 3 = 0 THEN 'reviewed' ELSE state END AS state, round(duration_seconds, 4) AS duration_seconds FROM runs", "runs"),
    "running_anomalies_stream": _sql("""
SELECT pipeline_id, id, run_id, round(duration_seconds, 4) AS duration_seconds, n AS prior_rows, round(mean, 4) AS mean, round(mean + 2 * sigma, 4) AS "upper"
FROM (SELECT *, count(duration_seconds) OVER w AS n, avg(duration_seconds) OVER w AS mean, stddev_samp(duration_seconds) OVER w AS sigma FROM done
  WINDOW w AS (PARTITION BY pipeline_id ORDER BY execution_date RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING))
WHERE n >= 5 AND duration_seconds > mean + 2 * sigma AND mean + 2 * sigma > 0""", "done"),
    "late_rows_stream": _sql("""
SELECT strftime(execution_date, '%Y-%m-%d') AS day, count(*) AS runs, count(*) FILTER (state = 'failed') AS failures
FROM runs WHERE date_diff('day', TIMESTAMP '2024-01-01', execution_date) < 4 GROUP BY ALL""", "runs"),
    "ordered_baselines": _sql(f"SELECT {_BASE} FROM baselines ORDER BY pipeline_id", "baselines"),
    "explained_anomalies": _sql("""
SELECT pipeline_id, run_id, round(current_duration, 4) AS current_duration,
  CASE WHEN n % 3 = 0 THEN 'unknown' WHEN n % 2 = 0 THEN 'data_volume_spike' ELSE 'resource_contention' END AS likely_cause,
  CASE WHEN n % 3 = 0 THEN 'medium' ELSE 'high' END AS severity, n % 3 <> 0 AND n % 2 = 0 AS escalate_to_oncall
FROM (SELECT *, CAST(substr(pipeline_id, 5) AS BIGINT) AS n FROM anomalies)""", "anomalies"),
    "scan_samples": _sql("SELECT ts, metric, node, NULL::VARCHAR AS mode, pipeline, namespace, round(value, 4) AS value FROM gauges UNION ALL SELECT ts, 'node_cpu_seconds_total', node, mode, NULL, NULL, round(value, 4) FROM counter", "gauges", "counter"),
    "retained_samples": _sql(f"SELECT ts, metric, node, NULL::VARCHAR AS mode, pipeline, namespace, round(value, 4) AS value FROM gauges WHERE ts > {T0} - INTERVAL 7 DAY", "gauges"),
    "copy_tables_report": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS source_rows, count(*) AS copied_rows, true AS same_content FROM {t}" for t in _TABLES),
    "finished_runs": _sql("SELECT id, pipeline_id, state, round(duration_seconds, 4) AS duration_seconds FROM done", "done"),
    "runs_in_window": _sql(f"SELECT id, pipeline_id, execution_date, state FROM runs WHERE execution_date > {T0} - INTERVAL 10 DAY", "runs"),
    "sanitized_run_ids": _sql("SELECT id, lower(replace(replace('Manual__' || strftime(execution_date, '%Y-%m-%dT%H:%M:%S') || '+00:00_' || run_id, ':', '-'), '+', '-')) AS safe_run_id FROM runs", "runs"),
    "run_durations": _sql("SELECT id, date_diff('microsecond', start_date, end_date) / 1000000.0::DOUBLE AS seconds, strftime(start_date, '%Y-%m-%d %H:%M UTC') AS started FROM runs", "runs"),
    "recorded_pipelines": _sql("SELECT 'dag_' || c_custkey AS pipeline_id FROM customer WHERE 'dag_' || c_custkey IN (SELECT pipeline_id FROM runs)", "runs"),
    "uncovered_pipelines": _sql("SELECT 'dag_' || c_custkey AS pipeline_id FROM customer WHERE 'dag_' || c_custkey NOT IN (SELECT pipeline_id FROM runs)", "runs"),
    "failures_with_history": _sql("SELECT id, pipeline_id, total_runs, round(avg_duration, 4) AS avg_duration, recent_statuses FROM history", "history"),
    "failures_with_history_ties": _sql(f"SELECT id, pipeline_id, total_runs, round(avg_duration, 4) AS avg_duration, recent_statuses FROM ({_history('ties', 365)})", "ties"),
    "unsent_alerts": _sql("SELECT alert_id, subject FROM alerts WHERE alert_id % 3 <> 0", "alerts"),
    "asof_baseline": _sql(f"SELECT {_ASOF} FROM prior", "prior"),
    "asof_baseline_outliers": _sql(f"SELECT {_ASOF} FROM prior_odd WHERE prior_avg < 1e6", "prior_odd"),
    "asof_baseline_ties": _sql(f"SELECT {_ASOF} FROM prior_ties", "prior_ties"),
    "downstream_impact": "WITH RECURSIVE " + _sql("""
, reach AS (
  SELECT l.pipeline_id AS root, e.downstream, 1 AS depth FROM latest l JOIN edges e ON e.upstream = l.pipeline_id WHERE l.state = 'failed'
  UNION
  SELECT r.root, e.downstream, r.depth + 1 FROM reach r JOIN edges e ON e.upstream = r.downstream)
SELECT root, downstream, CAST(min(depth) AS BIGINT) AS depth FROM reach GROUP BY root, downstream""", "latest", "edges").removeprefix("WITH ").replace("\n, reach", ", reach"),
    "upstream_impact": "WITH RECURSIVE " + _sql("""
, reach AS (
  SELECT l.pipeline_id AS root, e.upstream, 1 AS depth FROM latest l JOIN edges e ON e.downstream = l.pipeline_id WHERE l.state = 'failed'
  UNION
  SELECT r.root, e.upstream, r.depth + 1 FROM reach r JOIN edges e ON e.downstream = r.upstream)
SELECT root, upstream, CAST(min(depth) AS BIGINT) AS depth FROM reach GROUP BY root, upstream""", "latest", "edges").removeprefix("WITH ").replace("\n, reach", ", reach"),
    "copy_differences": """
SELECT o_orderkey, CASE WHEN o_orderkey % 997 = 1 THEN 'missing' ELSE 'changed' END AS status, count(*) AS source_rows,
  CASE WHEN o_orderkey % 997 = 1 THEN 0 ELSE count(*) END AS copy_rows
FROM orders WHERE o_orderkey % 997 = 1 OR o_orderkey % 991 = 2 GROUP BY o_orderkey
UNION ALL SELECT -o_orderkey, 'extra', 0, count(*) FROM orders WHERE o_orderkey % 983 = 3 GROUP BY o_orderkey""",
    "duration_baselines": _sql(f"SELECT {_BASE} FROM baselines", "baselines"),
    "duration_baselines_success_only": _sql(f"SELECT {_BASE} FROM ({_baselines('s', AS_OF, 2, 3)})".replace("FROM s ", "FROM (SELECT * FROM runs WHERE state = 'success' AND task_id = 'task_1') "), "runs"),
    "run_history": _sql(f"""
SELECT pipeline_id, count(*) AS total_runs, {_half_up('avg(duration_seconds)')} AS avg_duration,
  coalesce({_half_up('stddev_samp(duration_seconds)')}, 0) AS stddev_duration,
  array_to_string(list(coalesce(state, 'None') ORDER BY execution_date DESC, id DESC)[1:3], ', ') AS recent_statuses
FROM runs WHERE execution_date > {T0} - INTERVAL 30 DAY GROUP BY pipeline_id""", "runs"),
    "robust_baselines": _sql("SELECT pipeline_id, total_runs, failure_rate_pct, " + _r("median_duration", "p95_duration") + " FROM robust", "robust"),
    "rca_distribution": _sql("SELECT rca_severity, rca_category, count(*) AS failures, round(avg(rca_confidence), 4) AS avg_confidence, round(count(*) / sum(count(*)) OVER (), 4) AS share FROM diagnosed WHERE rca_root_cause IS NOT NULL GROUP BY rca_severity, rca_category", "diagnosed"),
    "top_failing": _sql("SELECT pipeline_id, task_id, count(*) FILTER (state = 'failed') AS failures, count(*) AS runs FROM runs GROUP BY pipeline_id, task_id HAVING count(*) FILTER (state = 'failed') > 0 ORDER BY failures DESC, pipeline_id, task_id LIMIT 20", "runs"),
    "anomalies_per_day": _sql("SELECT CAST(date_trunc('day', execution_date) AS TIMESTAMP) AS day, count(*) AS anomalies, count(DISTINCT pipeline_id) AS pipelines FROM rolling GROUP BY 1", "rolling"),
    "rca_quality_trend": _sql("SELECT CAST(date_trunc('day', rca_generated_at) AS TIMESTAMP) AS day, count(*) AS diagnoses, round(avg(rca_response_time_seconds), 4) AS avg_response_seconds, round(avg(rca_confidence), 4) AS avg_confidence, round(quantile_cont(rca_response_time_seconds, 0.95), 4) AS p95_response_seconds FROM diagnosed WHERE rca_generated_at IS NOT NULL GROUP BY 1", "diagnosed"),
    "seven_day_trend": _sql(f"""
SELECT p.pipeline_id, d.day, count(r.id) AS runs, count(*) FILTER (r.state = 'failed') AS failures, round(avg(r.duration_seconds), 4) AS avg_duration
FROM (SELECT DISTINCT pipeline_id FROM runs WHERE execution_date > {T0} - INTERVAL 7 DAY) p
CROSS JOIN (SELECT unnest(generate_series({T0} - INTERVAL 7 DAY, {T0} - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS day) d
LEFT JOIN runs r ON r.pipeline_id = p.pipeline_id AND r.execution_date > {T0} - INTERVAL 7 DAY AND r.execution_date <= {T0} AND date_trunc('day', r.execution_date) = d.day
GROUP BY ALL""", "runs"),
    "rollup_health": _sql("SELECT team, pipeline_id, CAST(grouping(team, pipeline_id) AS BIGINT) AS level, count(*) AS runs, count(*) FILTER (state = 'failed') AS failures, round(100.0 * count(*) FILTER (state = 'success') / count(*), 4) AS success_rate_pct FROM runs GROUP BY ROLLUP (team, pipeline_id)", "runs"),
    "runtime_attribution": _sql("SELECT team, pipeline_id, count(*) AS runs, round(sum(duration_seconds), 4) AS total_seconds, round(100 * sum(duration_seconds) / sum(sum(duration_seconds)) OVER (), 4) AS share_pct FROM runs GROUP BY team, pipeline_id", "runs"),
    "distinct_signatures": _sql("SELECT pipeline_id, count(*) AS failures, count(DISTINCT signature) AS signatures FROM signed GROUP BY pipeline_id", "signed"),
    "sketched_signatures": _sql("SELECT pipeline_id, count(*) AS failures, count(DISTINCT signature) AS signatures FROM signed GROUP BY pipeline_id", "signed"),
    "latest_runs": _sql("SELECT pipeline_id, run_id, execution_date, round(duration_seconds, 4) AS duration_seconds, state FROM latest", "latest"),
    "latest_runs_ties": _sql("SELECT pipeline_id, run_id, execution_date, round(duration_seconds, 4) AS duration_seconds, state FROM latest_ties", "latest_ties"),
    "recent_runs": _sql("SELECT pipeline_id, recency, run_id, execution_date, round(duration_seconds, 4) AS duration_seconds, state FROM ranked WHERE recency <= 10", "ranked"),
    "low_success_last10": _sql("SELECT pipeline_id, run_id, execution_date, runs, round(success_pct, 4) AS success_pct FROM low", "low"),
    "failure_streaks": _sql("SELECT * FROM streaks", "streaks"),
    "failure_streaks_ties": _sql(_streaks("done_ties", 2), "done_ties"),
    "flaky_pipelines": _sql("""
SELECT pipeline_id, count(*) AS runs, count(*) FILTER (flip) AS flips, round(count(*) FILTER (flip) / count(*), 4) AS flip_rate,
  count(*) FILTER (flip) / count(*) >= 0.3 AS is_flaky
FROM (SELECT pipeline_id, state <> lag(state) OVER (PARTITION BY pipeline_id ORDER BY execution_date, id) AS flip FROM done)
GROUP BY pipeline_id HAVING count(*) >= 5""", "done"),
    "run_over_run_change": _sql(_change("done"), "done"),
    "run_over_run_change_ties": _sql(_change("done_ties"), "done_ties"),
    "duration_drift": _sql("SELECT pipeline_id, days, " + _r("mean_duration", "slope_per_day") + ", round(100 * slope_per_day / greatest(mean_duration, 1), 4) AS slope_pct, 100 * slope_per_day / greatest(mean_duration, 1) >= 2 AS is_drifting FROM drift", "drift"),
    "anomaly_rank": _sql("SELECT pipeline_id, deviation_pct, dense_rank() OVER (ORDER BY deviation_pct DESC) AS place, round(percent_rank() OVER (ORDER BY deviation_pct DESC), 4) AS percent_place FROM judged", "judged"),
    "recent_rca_summary": _sql("SELECT pipeline_id, task_id, execution_date, rca_severity, rca_category, rca_root_cause, round(rca_confidence, 4) AS rca_confidence, rca_immediate_fix, rca_model_used, created_at FROM diagnosed WHERE state = 'failed' AND rca_root_cause IS NOT NULL ORDER BY created_at DESC NULLS FIRST, id DESC LIMIT 50", "diagnosed"),
    "last_diagnoses": _sql("SELECT pipeline_id, task_id, execution_date, rca_severity, rca_category, rca_root_cause, round(rca_confidence, 4) AS rca_confidence, rca_immediate_fix, rca_model_used, created_at FROM diagnosed WHERE state = 'failed' AND rca_root_cause IS NOT NULL ORDER BY created_at DESC NULLS FIRST, id DESC LIMIT 5", "diagnosed"),
    "log_tail": "SELECT 'task_' || doc_id AS task, line_no - 1 AS line_no, line FROM (SELECT doc_id, len(string_split(text, chr(10))) AS n, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents) WHERE line_no > n - 100",
    "duration_anomalies": _sql(f"SELECT {_ANOMALY} FROM anomalies", "anomalies"),
    "duration_anomalies_ties": _sql(f"SELECT {_ANOMALY} FROM judged_ties WHERE is_anomaly", "judged_ties"),
    "judged_runs": _sql(f"SELECT {_BASE}, run_id, execution_date, round(current_duration, 4) AS current_duration, state, deviation_pct, is_anomaly FROM judged", "judged"),
    "rolling_anomalies": _sql("SELECT pipeline_id, id, run_id, execution_date, " + _r("current_duration") + ", prior_rows, " + _r("prior_avg", "prior_stddev", "prior_upper") + ", deviation_pct FROM rolling", "rolling"),
    "fast_run_anomalies": _sql("SELECT pipeline_id, run_id, execution_date, 'fast_run' AS rule, round(current_duration, 4) AS observed, round(lower_threshold, 4) AS expected, deviation_pct FROM judged WHERE current_duration < lower_threshold", "judged"),
    "fast_run_anomalies_ties": _sql("SELECT pipeline_id, run_id, execution_date, 'fast_run' AS rule, round(current_duration, 4) AS observed, round(lower_threshold, 4) AS expected, deviation_pct FROM judged_ties WHERE current_duration < lower_threshold", "judged_ties"),
    "drift_anomalies": _sql("SELECT pipeline_id, run_id, execution_date, 'off_mean' AS rule, round(current_duration, 4) AS observed, round(avg_duration, 4) AS expected, deviation_pct FROM judged WHERE abs(current_duration - avg_duration) > 0.2 * avg_duration", "judged"),
    "median_ratio_anomalies": _sql(f"SELECT {_HIT} FROM above_median", "above_median"),
    "failure_spikes": _sql('SELECT pipeline_id, execution_date, failures, round(expected, 4) AS expected, round("limit", 4) AS "limit" FROM spikes', "spikes"),
    "row_count_deviation": _sql(f"SELECT {_HIT} FROM row_counts", "row_counts"),
    "throughput_anomalies": _sql(f"SELECT {_HIT} FROM throughput", "throughput"),
    "sla_status": _sql("""
SELECT l.pipeline_id, round(limit_seconds, 4) AS limit_seconds, n.run_id, round(n.duration_seconds, 4) AS current_duration, round(p95, 4) AS p95_duration,
  round(mean_duration + slope_per_day, 4) AS next_mean,
  CASE WHEN n.duration_seconds > limit_seconds THEN 'breach'
       WHEN coalesce(mean_duration + slope_per_day, 0) > limit_seconds OR coalesce(p95, 0) > limit_seconds THEN 'warning' ELSE 'ok' END AS status
FROM limits l JOIN latest n USING (pipeline_id)
LEFT JOIN (SELECT pipeline_id, quantile_cont(duration_seconds, 0.95) AS p95 FROM done WHERE execution_date > %s - INTERVAL 30 DAY GROUP BY pipeline_id) USING (pipeline_id)
LEFT JOIN drift USING (pipeline_id)""" % T0, "limits", "latest", "drift"),
    "health_grade": _sql(f"""
SELECT step, round(ratio, 4) AS ratio, CASE WHEN ratio >= 0.9 THEN 'red' WHEN ratio >= 0.8 THEN 'yellow' ELSE 'green' END AS grade,
  CASE WHEN ratio >= 0.9 THEN 'green' WHEN ratio >= 0.8 THEN 'yellow' ELSE 'red' END AS health FROM ({_RATIO})""", "instant"),
    "all_rule_hits": _sql(f"""
SELECT {_HIT} FROM (
  SELECT pipeline_id, run_id, execution_date, 'slow_run' AS rule, current_duration AS observed, upper_threshold AS expected, deviation_pct FROM anomalies
  UNION ALL SELECT pipeline_id, run_id, execution_date, 'fast_run', current_duration, lower_threshold, deviation_pct FROM judged WHERE current_duration < lower_threshold
  UNION ALL SELECT pipeline_id, run_id, execution_date, 'off_mean', current_duration, avg_duration, deviation_pct FROM judged WHERE abs(current_duration - avg_duration) > 0.2 * avg_duration
  UNION ALL SELECT * FROM above_median UNION ALL SELECT * FROM row_counts UNION ALL SELECT * FROM throughput
  UNION ALL SELECT pipeline_id, run_id, execution_date, 'low_success', success_pct, 80, success_pct - 80 FROM low
  UNION ALL SELECT pipeline_id, NULL, execution_date, 'failure_spike', failures, "limit", NULL FROM spikes
    QUALIFY row_number() OVER (PARTITION BY pipeline_id ORDER BY execution_date DESC) = 1
  UNION ALL SELECT pipeline_id, NULL, max(last_failure), 'failure_streak', max(length), 3, NULL FROM streaks GROUP BY pipeline_id
  UNION ALL SELECT pipeline_id, NULL, last_run, 'drift', 100 * slope_per_day / greatest(mean_duration, 1), 2, NULL FROM drift
    JOIN (SELECT pipeline_id, max(execution_date) AS last_run FROM done WHERE execution_date > {T0} - INTERVAL 30 DAY GROUP BY pipeline_id) USING (pipeline_id)
    WHERE 100 * slope_per_day / greatest(mean_duration, 1) >= 2
  UNION ALL SELECT pipeline_id, run_id, execution_date, CASE WHEN breach THEN 'sla_breach' ELSE 'sla_warning' END, seen, limit_seconds,
    round(100 * (seen - limit_seconds) / greatest(limit_seconds, 1), 1) FROM (
      SELECT *, coalesce(n.duration_seconds, 0) > limit_seconds AS breach, CASE WHEN coalesce(n.duration_seconds, 0) > limit_seconds THEN n.duration_seconds
        ELSE greatest(coalesce(mean_duration + slope_per_day, 0), coalesce(p95, 0)) END AS seen
      FROM limits l JOIN latest n USING (pipeline_id)
      LEFT JOIN (SELECT pipeline_id, quantile_cont(duration_seconds, 0.95) AS p95 FROM done WHERE execution_date > {T0} - INTERVAL 30 DAY GROUP BY pipeline_id) USING (pipeline_id)
      LEFT JOIN drift USING (pipeline_id)) WHERE seen > limit_seconds)""",
        "limits", "latest", "drift", "anomalies", "above_median", "row_counts", "throughput", "low", "spikes", "streaks"),
    "newly_failing": _sql(f"{_FAILED_IN(1, '')} EXCEPT {_FAILED_IN(2, f' AND execution_date <= {T0} - INTERVAL 1 DAY')}", "runs"),
    "still_failing": _sql(f"{_FAILED_IN(1, '')} INTERSECT {_FAILED_IN(2, f' AND execution_date <= {T0} - INTERVAL 1 DAY')}", "runs"),
    "alert_feed": _sql(_FEED, "alerts", "anomaly_rows"),
    "alert_routes": _sql(f"SELECT kind, alert_id, pipeline_id, severity, CASE WHEN severity IN ('HIGH', 'CRITICAL') OR coalesce(escalate_to_oncall, false) THEN 'oncall' ELSE 'channel' END AS route FROM ({_FEED})", "alerts", "anomaly_rows"),
    "rca_prompts": _sql(f"SELECT id, prompt, length(prompt) AS prompt_length FROM (SELECT r.id, {_PROMPT} AS prompt FROM runs r JOIN history USING (id))", "runs", "history"),
    "anomaly_prompts": _sql(f"""
SELECT a.pipeline_id, {_ANOMALY_PROMPT} AS prompt FROM anomalies a JOIN (
  SELECT pipeline_id, string_agg({_fixed('duration_seconds')} || ' ' || state, '; ' ORDER BY recency) AS lines
  FROM ranked WHERE recency <= 5 GROUP BY pipeline_id) USING (pipeline_id)""", "anomalies", "ranked"),
    "parsed_diagnoses": _sql("SELECT * REPLACE (round(confidence, 4) AS confidence) FROM parsed", "parsed"),
    "diagnosis_violations": _sql(f"SELECT id, status, len(v) AS n_violations, array_to_string(v, ', ') AS violations FROM (SELECT id, status, CASE WHEN status = 'parse_error' THEN ['no answer'] ELSE {_violations()} END AS v FROM parsed)", "parsed"),
    "diagnoses_with_fallback": _sql("SELECT id, status, root_cause, root_cause_category, round(confidence, 4) AS confidence, severity, retry_recommended, estimated_fix_time_minutes FROM filled", "filled"),
    "diagnosed_failures": _sql(f"""
SELECT id, string_split(error_message, chr(10))[1] AS rca_root_cause, {_RULE_CASE(1)} AS rca_category, 0.6::DOUBLE AS rca_confidence,
  {_RULE_CASE(2)} AS rca_severity, {_RULE_CASE(1)} IN ('connectivity', 'timeout') AS rca_retry_recommended, {T0} AS rca_generated_at
FROM runs WHERE state = 'failed'""", "runs"),
    "failure_alerts": _sql(f"SELECT *, '[' || {_BLOCKS} || ']' AS blocks FROM alerts", "alerts"),
    "anomaly_alerts": _sql("SELECT * REPLACE (" + _r("current_duration", "avg_duration") + ") FROM anomaly_rows", "anomaly_rows"),
    "classified_errors": _sql(f"SELECT id, pipeline_id, error_type, {_RULE_CASE(1)} AS category, {_RULE_CASE(2)} AS severity FROM runs WHERE state = 'failed'", "runs"),
    "classified_by_table": _sql(f"SELECT id, pipeline_id, error_type, {_RULE_CASE(1)} AS category, {_RULE_CASE(2)} AS severity FROM runs WHERE state = 'failed'", "runs"),
    "similar_incidents_lsh": _sql("""
SELECT s.id, s.pipeline_id, md5(s.signature) AS fingerprint, nearest, round(overlap, 4) AS overlap, coalesce(incidents, 0) AS incidents, last_seen
FROM signed s LEFT JOIN (
  SELECT n.signature, o.fingerprint AS nearest, incidents, last_seen,
    len(list_intersect(n.words, o.words)) / len(list_distinct(list_concat(n.words, o.words))) AS overlap
  FROM (SELECT DISTINCT signature, list_distinct(string_split(signature, ' ')) AS words FROM signed WHERE execution_date >= TIMESTAMP '2024-01-16') n
  JOIN (SELECT md5(signature) AS fingerprint, list_distinct(string_split(signature, ' ')) AS words, count(*) AS incidents,
      max(execution_date) AS last_seen FROM signed WHERE execution_date < TIMESTAMP '2024-01-16' AND signature IS NOT NULL GROUP BY signature) o
    ON len(list_intersect(n.words, o.words)) >= 0.6 * len(list_distinct(list_concat(n.words, o.words)))
  QUALIFY row_number() OVER (PARTITION BY n.signature ORDER BY overlap DESC, o.fingerprint) = 1) b ON b.signature = s.signature
WHERE s.execution_date >= TIMESTAMP '2024-01-16'""", "signed"),
    "similar_incidents": _sql("""
SELECT id, pipeline_id, execution_date, md5(signature) AS fingerprint,
  row_number() OVER (PARTITION BY signature ORDER BY execution_date, id) - 1 AS earlier,
  lag(execution_date) OVER (PARTITION BY signature ORDER BY execution_date, id) AS last_seen FROM signed""", "signed"),
    "grouped_alerts": _sql(f"""
SELECT pipeline_id, rule, fingerprint, min(execution_date) AS first_seen, max(execution_date) AS last_seen, count(*) AS alerts,
  round(max(deviation_pct), 4) AS deviation_pct, round(max(rank) * 1000.0 + least(max(deviation_pct), 999.0), 4) AS priority
FROM ({_gap_groups('alert_events', 'pipeline_id, rule, fingerprint')}) GROUP BY pipeline_id, rule, fingerprint, grp""", "alert_events"),
    "recommended_actions": _sql(f"""
SELECT id, pipeline_id, run_id, rca_category, action, is_safe,
  CASE WHEN action IS NULL THEN 'escalate' WHEN NOT is_safe THEN 'needs_approval' WHEN rca_retry_recommended THEN 'propose_retry' ELSE 'propose_fix' END AS decision,
  rca_generated_at AS decided_on
FROM diagnosed LEFT JOIN {_RUNBOOK} ON rca_category = b.category WHERE state = 'failed' AND rca_category IS NOT NULL""", "diagnosed"),
    "counter_rate": _sql("SELECT step, node, mode, round(rate, 4) AS rate FROM rates", "rates"),
    "cpu_utilization": _sql("SELECT step, node, round(1 - avg(rate), 4) AS utilization FROM rates WHERE mode = 'idle' GROUP BY step, node", "rates"),
    "gauge_difference": _sql("SELECT a.step, a.node, round(a.value - b.value, 4) AS value FROM instant a JOIN instant b ON a.step = b.step AND a.node = b.node WHERE a.metric = 'node_memory_total' AND b.metric = 'node_memory_available'", "instant"),
    "success_ratio": _sql(f"SELECT step, round(ratio, 4) AS ratio FROM ({_RATIO})", "instant"),
    "active_failures": _sql(_by_step("sum(value)", "failures", "run_failed"), "steps", "instant"),
    "avg_task_duration": _sql(_by_step("avg(value)", "avg_duration", "run_duration"), "steps", "instant"),
    "matching_series_count": _sql(_by_step("count(*)", "series", "run_duration", "namespace = 'ns_1'"), "steps", "instant"),
    "series_range": _sql("SELECT ts, pipeline, namespace, round(value, 4) AS value FROM gauges WHERE metric = 'run_duration' AND ts > TIMESTAMP '2024-01-15' AND ts <= TIMESTAMP '2024-01-15 12:00:00'", "gauges"),
    "last_values": _sql("SELECT pipeline, max(ts) AS ts, round(max({'ts': ts, 'value': value}).value, 4) AS value FROM gauges WHERE metric = 'run_duration' GROUP BY pipeline", "gauges"),
    "resampled_series": _sql("""
SELECT s.step, n.node, round(i.value, 4) AS value FROM steps s CROSS JOIN (SELECT DISTINCT node FROM gauges WHERE metric = 'node_memory_available') n
LEFT JOIN (SELECT * FROM instant WHERE metric = 'node_memory_available') i ON i.step = s.step AND i.node = n.node""", "instant"),
    "tumbling_health": _sql("SELECT pipeline_id, time_bucket(INTERVAL 30 MINUTE, execution_date) AS window_start, count(*) AS runs, count(*) FILTER (state = 'failed') AS failures, round(avg(duration_seconds), 4) AS avg_duration FROM runs GROUP BY 1, 2", "runs"),
    "sliding_stats": _sql("""
SELECT pipeline_id, d.start AS window_start, count(*) AS runs, count(*) FILTER (state = 'failed') AS failures, round(avg(duration_seconds), 4) AS avg_duration
FROM (SELECT unnest(generate_series(TIMESTAMP '2023-12-01', TIMESTAMP '2024-03-01', INTERVAL 1 DAY)) AS start) d
JOIN runs ON execution_date >= d.start AND execution_date < d.start + INTERVAL 7 DAY GROUP BY 1, 2""", "runs"),
    "incident_sessions": _sql(f"""
SELECT pipeline_id, min(execution_date) AS first_seen, max(execution_date) AS last_seen, count(*) AS runs, count(*) FILTER (state = 'failed') AS failures
FROM ({_gap_groups('runs', 'pipeline_id')}) GROUP BY pipeline_id, grp""", "runs"),
    "word_count": "SELECT word, count(*) AS occurrences FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) WHERE word <> '' GROUP BY word",
    "incomplete_jobs": """
SELECT app, ts, state FROM (SELECT 'app_' || o_custkey AS app, o_orderdate AS ts, o_orderkey,
  CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'RUNNING' ELSE 'FAILED' END AS state FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) WHERE state <> 'COMPLETED'""",
    "row_count_validation": _sql("""
SELECT day, expected_rows, loaded_rows, loaded_rows - expected_rows AS difference,
  CASE WHEN loaded_rows = 0 THEN 'missing' WHEN loaded_rows < expected_rows THEN 'short' WHEN loaded_rows > expected_rows THEN 'extra' ELSE 'ok' END AS status
FROM (SELECT CAST(date_trunc('day', execution_date) AS TIMESTAMP) AS day, count(*) AS expected_rows, count(*) FILTER (state <> 'running') AS loaded_rows FROM runs GROUP BY 1)""", "runs"),
    "partition_gaps": _sql("""
SELECT p.pipeline_id, d.day FROM (SELECT DISTINCT pipeline_id FROM runs) p
CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY)) AS day) d
WHERE (p.pipeline_id, d.day) NOT IN (SELECT pipeline_id, CAST(date_trunc('day', execution_date) AS TIMESTAMP) FROM runs)""", "runs"),
}
