"""What the first round got wrong: cut texts, repeated diagnoses, unknown answer states, very many slices, null keys."""

from pyspark.sql import functions as F

from runpulse import schemas
from runpulse.functions.text import safe_id
from runpulse.operators.diagnosis import parsed_diagnoses, with_fallback
from runpulse.operators.slices import SLICE, add_slices
from runpulse.sources.sinks import append_runs, merge_diagnoses


def test_long_messages_are_stored_whole(spark, fresh):
    text = "x" * 5000 + " OutOfMemoryError"
    runs = spark.range(1).select("id", F.lit("p").alias("pipeline_id"), F.to_timestamp(F.lit("2024-01-02 00:00:00")).alias("execution_date"), F.lit(text).alias("error_message"))
    path = fresh() + "/runs"
    append_runs(runs, path)
    assert spark.read.parquet(path).first().error_message == text


def test_long_ids_stay_different(spark):
    ids = spark.createDataFrame([("a" * 60 + "1",), ("a" * 60 + "2",), ("short",)], "i string")
    got = [r[0] for r in ids.select(safe_id("i", 48)).collect()]
    assert len(set(got)) == 3 and max(map(len, got)) == 48
    assert ids.select(safe_id("i")).first()[0] == "a" * 60 + "1"


def test_the_newest_of_several_diagnoses_counts(spark):
    names = schemas.DIAGNOSIS_COLUMNS.fieldNames()
    blank = {c: F.lit(None).cast(schemas.DIAGNOSIS_COLUMNS[c].dataType).alias(c) for c in names}
    row = lambda cause, day: spark.range(1).select(
        "id",
        *[
            F.lit(cause).alias(c) if c == "rca_root_cause"
            else F.to_timestamp_ntz(F.lit(f"2024-01-0{day} 00:00:00")).alias(c) if c == "rca_generated_at" else blank[c]
            for c in names
        ],
    )
    both = row("old", 1).unionByName(row("new", 2)).unionByName(row("new", 2))
    got = merge_diagnoses(spark.range(2).withColumn("state", F.lit("failed")), both).orderBy("id").collect()
    assert [r.rca_root_cause for r in got] == ["new", None]


def test_unknown_answer_states_get_a_record(spark):
    given = spark.createDataFrame([(1, None, "rate_limited"), (2, None, "timeout")], "id long, response string, status string")
    got = with_fallback(parsed_diagnoses(given)).orderBy("id").collect()
    assert len(got) == 2 and all(r.root_cause for r in got) and got[0].status == "rate_limited"


def test_thousands_of_slices_of_one_moment(spark):
    rows = spark.range(20_000).select("id", F.lit("k").alias("key"), F.lit(7).cast("bigint").alias("at"))
    got = add_slices(rows, ["key"], "at", "id", slices=8_192).groupBy(SLICE).count().agg(F.count("*"), F.max("count")).first()
    assert got[0] >= 4_000 and got[1] <= 20


def test_a_hot_null_key_is_sliced(spark):
    key = F.when(F.col("id") % 2 == 0, F.lit("a"))
    rows = spark.range(2_000).select("id", key.alias("key"), F.col("id").alias("at"))
    got = add_slices(rows, ["key"], "at", "id", slices=16)
    assert got.count() == 2_000
    assert got.filter("key IS NULL").select(SLICE).distinct().count() >= 8
