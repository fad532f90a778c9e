"""The registered retry verdict reaches both of the reference's rules."""

from pyspark.sql import functions as F

from lotgraph.operators import crawl
from lotgraph.plans import catalog

FOLDER = "/root/testdata/sf0.001"


def test_both_rules_fire_and_fail(spark):
    runs = spark.read.parquet(f"{FOLDER}/events.parquet").groupBy(F.expr("event_id div 8").alias("run_id")).agg(F.count_if(F.col("event_type") == "error").alias("failed"))
    got = {(r.n, r.retry) for r in catalog.queries()["retry_verdict"](spark, FOLDER).join(runs, "run_id").select(F.least("failed", F.lit(3)).alias("n"), "retry").collect()}
    assert got == {(0, False), (1, True), (1, False), (2, False), (3, True), (3, False)}


def test_share_of_three_and_more(spark):
    rows = [(run, "failed", crawl.NO_RESULT if i < none else "x") for run, failed, none in (("a", 3, 3), ("b", 5, 4), ("c", 3, 2), ("d", 2, 2)) for i in range(failed)]
    df = spark.createDataFrame(rows, "run_id string, status string, message string")
    assert {r.run_id: r.retry for r in crawl.retry_runs(df).collect()} == {"a": True, "b": True, "c": False, "d": False}
