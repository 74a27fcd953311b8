"""Run, sample and side tables derived by expression from a table of timed user events.

They stand for the tables a deployment would hold, and let every operator be tried on whole tables.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from runpulse.functions.text import error_class, lookup
from runpulse.operators.slices import add_slices, micros, running_totals

AS_OF = "2024-01-31 00:00:00"
TIES_AS_OF = "2001-12-31 00:00:00"

# Six kinds of failure text; the position in the list is the error id.
ERROR_TEXTS = (
    "MemoryError: worker 12 ran out of memory while sorting 41 partitions\n"
    "hint: the batch of 2024-03-02 was 9 times its usual size",
    "SchemaMismatch: column net_amount of batch 77 holds words, decimals were expected",
    "TimeoutError: queue writer 4 gave no reply within 900 s",
    "AccessError: Access denied for role loader_2 on table sales.refunds",
    "LookupError: partition day=2024-03-02 not found in https://example.org/inbox/refunds",
    "ServiceError: the price list at example.org:8443 is unreachable\n"
    "Caused by: ssl.SSLError: handshake failure",
)


# Given schemas, so that no file is opened to infer them.
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def source_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the source tables."""
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def duration() -> Column:
    """Seconds of an event's run. The divisor leaves few exact halves, which engines round differently."""
    return F.col("value") / F.lit(0.9973)


def runs_from_events(events: DataFrame) -> DataFrame:
    """Pipeline runs: one per event."""
    text = lambda prefix, expr: F.concat(F.lit(prefix), expr.cast("string"))
    state = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "signup", "running")
    failed = F.col("event_type") == "error"
    error_id = F.when(failed, F.col("event_id") % len(ERROR_TEXTS))
    message = F.when(failed, F.element_at(F.array(*[F.lit(t) for t in ERROR_TEXTS]), (error_id + 1).cast("int")))
    end = F.col("ts") + F.make_dt_interval(secs=duration().cast("decimal(18,6)"))
    return events.select(
        F.col("event_id").alias("id"),
        text("dag_", F.col("user_id")).alias("pipeline_id"),
        text("team_", F.col("user_id") % 5).alias("team"),
        text("task_", F.col("event_id") % 4).alias("task_id"),
        text("run_", F.col("event_id")).alias("run_id"),
        F.col("ts").alias("execution_date"),
        F.col("ts").alias("start_date"),
        end.alias("end_date"),
        duration().alias("duration_seconds"),
        state.otherwise("success").alias("state"),
        (F.get_json_object("props", "$.k").cast("bigint") * 1000).alias("row_count"),
        error_id.alias("error_id"),
        message.alias("error_message"),
        F.when(failed, error_class(message)).alias("error_type"),
        end.alias("created_at"),
    )


def runs_from_orders(orders: DataFrame) -> DataFrame:
    """Runs at day grain, where several runs of a pipeline share a moment."""
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("dag_"), F.col("o_custkey").cast("string")).alias("pipeline_id"),
        F.concat(F.lit("run_"), F.col("o_orderkey").cast("string")).alias("run_id"),
        F.col("o_orderdate").alias("execution_date"),
        (F.col("o_totalprice") / F.lit(997.3)).alias("duration_seconds"),
        lookup("o_orderstatus", {"F": "success", "P": "failed"}, "running").alias("state"),
    )


def responses_from_runs(runs: DataFrame) -> DataFrame:
    """One raw generator answer per failed run, in five forms by `id % 5`."""
    error = F.col("error_id").cast("int")
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), error + 1)
    category = pick(
        ["data_issue", "connectivity", "resource_exhaustion", "resource_exhaustion", "permission_denied", "connectivity"]
    )
    severity = pick(["high", "medium", "critical", "high", "high", "low"])

    def answer(confidence: Column, level: Column, with_prevention: bool = True) -> Column:
        parts = [
            F.lit('{"root_cause": "cause '), error.cast("string"),
            F.lit('", "root_cause_category": "'), category,
            F.lit('", "confidence": '), confidence,
            F.lit(', "immediate_fix": "fix '), error.cast("string"),
        ]
        if with_prevention:
            parts += [F.lit('", "prevention": "check '), error.cast("string")]
        parts += [
            F.lit('", "retry_recommended": '), F.when(error % 2 == 0, "true").otherwise("false"),
            F.lit(', "estimated_fix_time_minutes": '), (5 + error * 5).cast("string"),
            F.lit(', "severity": "'), level,
            F.lit('", "affected_downstream": "reports", "similar_past_incidents": "none"}'),
        ]
        return F.concat(*parts)

    confidence = F.concat(F.lit("0."), (50 + F.col("id") % 50).cast("string"), F.lit("137"))
    plain = answer(confidence, severity)
    form = F.col("id") % 5
    return runs.filter(F.col("state") == "failed").select(
        "id",
        F.when(form == 0, plain)
        .when(form == 1, F.concat(F.lit("The analysis follows.\n"), plain, F.lit("\nEnd of answer.")))
        .when(form == 2, F.lit("No structured answer was given."))
        .when(form == 3, answer(F.lit("1.7"), F.lit("urgent"), with_prevention=False))
        .otherwise(answer(F.lit('"high"'), severity))
        .alias("response"),
        F.lit("rules-1").alias("model"),
        (F.length("error_message") / F.lit(9.973)).alias("response_seconds"),
        F.col("end_date").alias("generated_at"),
    )


COUNTER = "node_cpu_seconds_total"


def samples_from_events(events: DataFrame, with_counter: bool = True) -> DataFrame:
    """Labelled samples: five gauges per event, and where wanted a counter that resets at 5,000."""
    node = (F.col("user_id") % 8).cast("string")
    mode = F.when(F.col("event_id") % 2 == 0, "idle").otherwise("user")
    base = events.select(
        "event_id", "ts", "event_type", "value",
        node.alias("node"), mode.alias("mode"),
        F.concat(F.lit("dag_"), F.col("user_id").cast("string")).alias("pipeline"),
        F.concat(F.lit("ns_"), (F.col("user_id") % 3).cast("string")).alias("namespace"),
    )

    def sample(rows: DataFrame, metric: str, labels: list[str], value: Column) -> DataFrame:
        pairs = [x for name in labels for x in (F.lit(name), F.col(name))]
        return rows.select(
            "ts", F.lit(metric).alias("metric"), F.create_map(*pairs).alias("labels"), value.cast("double").alias("value")
        )

    kind = F.col("event_type")
    out = sample(base, "node_memory_total", ["node"], F.lit(1000.0))
    for part in (
        sample(base, "node_memory_available", ["node"], F.lit(1000.0) - F.col("value")),
        sample(base, "run_success", ["pipeline"], F.when(kind.isin("error", "signup"), 0).otherwise(1)),
        sample(base, "run_failed", ["pipeline"], F.when(kind == "error", 1).otherwise(0)),
        sample(base, "run_duration", ["pipeline", "namespace"], duration()),
    ):
        out = out.unionByName(part)
    if not with_counter:
        return out
    moved = base.select(
        "event_id", "ts", "node", "mode", micros("ts").alias("at"), F.floor(F.col("value") * 1000).alias("millis")
    )
    counted = running_totals(
        add_slices(moved, ["node", "mode"], "at", "event_id"), ["node", "mode"], "at", "event_id", {"counted": F.col("millis")}
    )
    wrapped = (F.col("counted") % 5_000_000) / F.lit(1000.0)
    return out.unionByName(sample(counted, COUNTER, ["node", "mode"], wrapped))


def edges_from_events(events: DataFrame) -> DataFrame:
    """Lineage edges over the pipelines of `events`: i to 2i+1, 2i+2 and (7i+3) mod N when larger than i."""
    ids = events.select(F.col("user_id").alias("i")).distinct()
    size = ids.agg((F.max("i") + 1).alias("n")).scalar()
    i, n = F.col("i"), size
    ends = F.array(2 * i + 1, 2 * i + 2, F.when((7 * i + 3) % n > i, (7 * i + 3) % n))
    name = lambda c: F.concat(F.lit("dag_"), c.cast("string"))
    return (
        ids.select("i", F.explode(F.array_distinct(ends)).alias("j"))
        .filter(F.col("j") < n)
        .select(name(F.col("i")).alias("upstream"), name(F.col("j")).alias("downstream"))
    )


def sla_limits(runs: DataFrame) -> DataFrame:
    """A duration limit for every pipeline."""
    number = F.regexp_extract("pipeline_id", r"(\d+)$", 1).cast("bigint")
    return runs.select("pipeline_id").distinct().withColumn("limit_seconds", (100 + number % 5 * 50).cast("double"))


def job_status_from_orders(orders: DataFrame) -> DataFrame:
    """Status rows of submitted jobs: one app per customer."""
    return orders.select(
        F.concat(F.lit("app_"), F.col("o_custkey").cast("string")).alias("app"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_orderkey").alias("status_id"),
        lookup("o_orderstatus", {"F": "COMPLETED", "O": "RUNNING"}, "FAILED").alias("state"),
    )


def sent_log_from_runs(runs: DataFrame) -> DataFrame:
    """Ids of alerts that went out already."""
    return runs.filter((F.col("state") == "failed") & (F.col("id") % 3 == 0)).select(F.col("id").alias("alert_id"))


def sample_explainer():
    """A generator of anomaly explanations: by the length of the run's name, every third prompt without an answer."""
    causes = ("data_volume_spike", "resource_contention", "unknown")

    def one(prompt: str) -> str:
        name = json.loads(prompt.split("\n", 1)[1])["run"]["pipeline_id"]
        number = int(name.rsplit("_", 1)[1])
        if number % 3 == 0:
            return "no idea"
        said = {"anomaly_explanation": name, "likely_cause": causes[number % 2], "severity": "high", "escalate_to_oncall": number % 2 == 0}
        return json.dumps(said)

    return lambda batch: batch["prompt"].map(one)
