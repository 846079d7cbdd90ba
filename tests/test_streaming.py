import pytest
from pyspark.sql import functions as F

from rarescan.operators import decisions
from rarescan.plans.queries import MEMBERS, QUERIES
from rarescan.sources.applications import SCORES, applications
from rarescan.streaming import decisions as streams

KEYS = ["application_id", "fraud_bool", *SCORES]


def decide(df):
    return decisions.with_committee(df, MEMBERS)


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return applications(spark, sf_dir).select(*KEYS).cache()


def as_rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_equals_batch_over_several_runs(spark, rows, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    first, second = rows.where("application_id % 2 = 0"), rows.where("application_id % 2 = 1")
    for part in (first, second):  # new files arrive between two runs
        part.repartition(3).write.mode("append").parquet(source)
        stream = streams.read_stream(spark, source, rows.schema, files_per_batch=2)
        streams.finished(streams.write_decisions(stream, decide, "fraud_bool", out, checkpoint))
    columns = ["application_id", "decision", "confidence", "outcome"]
    batch = decide(rows).withColumn("outcome", decisions.outcome("fraud_bool"))
    assert as_rows(spark.read.parquet(out).select(columns)) == as_rows(batch.select(columns))


def test_running_totals_carry_over(spark, rows, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    for part in (rows.where("application_id % 2 = 0"), rows.where("application_id % 2 = 1")):
        part.write.mode("append").parquet(source)
        stream = streams.read_stream(spark, source, rows.schema)
        streams.finished(streams.write_running_totals(stream, decide, "fraud_bool", out, checkpoint))
    want = decisions.outcome_counts(decide(rows), "fraud_bool")
    assert as_rows(spark.read.parquet(out)) == as_rows(want)


def test_error_rows_have_no_outcome(spark):
    df = spark.createDataFrame([(None, 1)], "score_mlp double, y int")
    got = decisions.with_committee(df, MEMBERS).select(decisions.outcome("y").alias("o"), "decision")
    assert tuple(got.first()) == (None, "error")


def test_event_stream_covers_all_events(spark, sf_dir):
    got = QUERIES["stream_event_tiers"](spark, sf_dir)
    assert got.agg(F.sum("n")).first()[0] == spark.read.parquet(f"{sf_dir}/events.parquet").count()
