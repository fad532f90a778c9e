from pyspark.sql import functions as F

from lotgraph.functions import display as D
from lotgraph.operators import manifest as M


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_texts(spark):
    lit = F.lit
    assert one(spark, D.project_title(lit("甲项目"), lit("A1"))) == "甲项目（标段：A1）" and one(spark, D.project_title(lit("甲"), lit(None))) == "甲"
    assert one(spark, D.company_span(lit("a|b"), lit(False), lit(True))) == "a\\|b" and D.WINNER in one(spark, D.company_span(lit("a"), lit(True), lit(True)))
    assert one(spark, D.without(lit("某某项目"), "某某")) == "项目"
    assert one(spark, D.without_stamp(lit("甲公司（盖章）"))) == "甲公司" and one(spark, D.without_label(lit("投标人：甲公司"))) == "甲公司"
    assert one(spark, D.without_stamp(lit("甲公司盖单位章）"))) == "甲公司" and one(spark, D.without_label(lit("参与单_甲公司"))) == "甲公司"
    assert one(spark, D.cover_text(lit("项且建没"))) == "项目建设"
    assert one(spark, D.log_percent(F.array(lit("[阶段 2/5] x"), lit("完成 5/10 个 PDF")))) == 38 and one(spark, D.log_percent(F.array(lit("处理完成 5/10")))) == 22
    assert one(spark, D.is_completion_line(lit("完成 3/9 个 PDF"))) and not one(spark, D.is_completion_line(lit("开始")))
    items = F.array(F.struct(lit("138").alias("display"), lit("b").alias("source")), F.struct(lit("138").alias("display"), lit("a").alias("source")))
    assert one(spark, D.evidence_line(items)) == "138（a、b）"


def test_manifest(spark):
    rows = [("root", "success", ""), ("related", "timeout", ""), ("root", "pending_submission", "invalid_company_name")]
    df = spark.createDataFrame(rows, "company_type string, status string, pending_reason string")
    assert M.name_reviews(df).count() == 1 and M.manifest(df).where("all_types = 1").count() == 3
    assert M.with_finality(spark.range(2), df).where("finality = 'provisional'").count() == 2
    roots = F.array(F.lit("r"))
    assert one(spark, M.related_sources(F.lit('{"rootCompany": "b", "relatedSources": ["a", "b"]}'), roots)) == ["a", "b"] and one(spark, M.related_sources(F.lit("{}"), roots)) == ["r"]
    assert M.queue_pages(250) == [(1, 100), (2, 100), (3, 50)] and M.queue_pages(0) == []
    run = spark.createDataFrame([("r", 1)], "run_id string, done int")
    queue = spark.createDataFrame([("r", "1", "a", "x"), ("r", "2", "b", "y")], "run_id string, company_id string, company_name string, status string")
    prints = {M.progress_fingerprint(run, q, ["done"]).first().fingerprint for q in (queue, queue.orderBy(F.desc("company_id")))}
    assert len(prints) == 1 and M.progress_fingerprint(run, queue.withColumn("status", F.lit("z")), ["done"]).first().fingerprint not in prints


def test_result_table(spark):
    spark.sql("DROP TABLE IF EXISTS lotgraph_results_test")
    try:
        assert "business_key" in M.ensure_table(spark, "lotgraph_results_test") and M.ensure_table(spark, "lotgraph_results_test") == []
    finally:
        spark.sql("DROP TABLE IF EXISTS lotgraph_results_test")
