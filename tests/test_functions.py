import pytest
from pyspark.sql import functions as F

from lotgraph.functions import documents as D
from lotgraph.functions import status as S
from lotgraph.functions import text as X
from lotgraph.operators import responses


def values(spark, column, *inputs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, v string")
    return [r[0] for r in df.select(column(F.col("v")).alias("o"), "i").orderBy("i").select("o").collect()]


def test_keys_and_placeholders(spark):
    assert values(spark, X.clean, None, " a　", "x\x00y") == ["", "a", "xy"]
    assert values(spark, X.key_part, " Ab C ", "Straße", None) == ["abc", "strasse", ""]
    assert values(spark, X.person_key, "张 三", "暂无", "-", "None") == ["张三", "", "", ""]
    assert values(spark, X.nullable, " ", "a") == [None, "a"]


def test_contacts(spark):
    got = values(spark, X.phones, "13800000000 / 0510-12345678", "+86 138 0000 0000，13800000000", "12", None)
    assert [[x["value"] for x in g] for g in got] == [["13800000000", "051012345678"], ["13800000000"], [], []]
    assert got[1][0]["display"] == "+86 138 0000 0000"
    got = values(spark, X.emails, "A@Example.com; a@example.com b@x.org", "none")
    assert [[(x["value"], x["display"]) for x in g] for g in got] == [[("a@example.com", "A@Example.com"), ("b@x.org", "b@x.org")], []]


def test_confidence_and_names(spark):
    assert values(spark, X.confidence, "1.2", "-1", "0.5", "x", "NaN", None) == [1.0, 0.0, 0.5, 0.0, 0.0, 0.0]
    got = values(spark, X.strip_price_prefix, "费率）甲公司", "投标报价：12345", "乙公司", "")
    assert [(x["name"], x["rule"]) for x in got] == [("甲公司", "rate_parenthesis"), ("", "invalid_company_name"), ("乙公司", ""), ("", "invalid_company_name")]
    assert values(spark, X.company_names, "中标人：江苏甲建设有限公司，乙集团有限公司") == [["江苏甲建设有限公司", "乙集团有限公司"]]
    assert values(spark, lambda c: X.company_names(c, True), "本公司委托江苏丙工程有限公司") == [["江苏丙工程有限公司"]]
    assert values(spark, X.shorten, "x" * 501) == ["x" * 500 + "…"]
    assert [(r["project"], r["lot"]) for r in values(spark, X.code_and_lot, "JS2024001-A12", "js—01", "ABC", "WXHS20210908001-S04", "AB_01", "x－1 ")] == [
        ("JS2024001", "JS2024001-A12"), ("JS", "JS-01"), ("ABC", ""), ("WXHS20210908001", "WXHS20210908001-S04"), ("AB_01", ""), ("X", "X-1")]


def test_readable(spark):
    assert values(spark, X.readable, "项目名称农田建设工程施工招标投标文件江苏甲公司", "abc " * 20, "短") == [True, False, False]


def test_classify(spark):
    paths = ["a/中标通知书.pdf", "award_notice/x/1.pdf", "未中标/甲/封面.pdf", "施工组织设计/1.pdf", "投标文件/1.pdf", "x/other.pdf"]
    assert values(spark, lambda c: D.classify(c, F.lit(2), F.lit("")), *paths) == ["award_notice", "award_notice", "tender_cover", "unknown", "tender_cover", "unknown"]
    assert values(spark, D.award_from_path, "未中标单位投标文件/x", "中标单位投标文件/x", "y") == ["否", "是", "未知"]
    assert values(spark, D.is_cover_text, "投标 文件", "项目名称：x 投标人：y", "项目名称") == [True, True, False]


@pytest.mark.parametrize(("raw", "state"), [("not failed", "failed"), ("FINISHED", "success"), ("queued", "running"), ("token", "success"), ("", "waiting")])
def test_entity_state(spark, raw, state):
    assert values(spark, S.entity_state, raw) == [state]


def test_json_states(spark):
    rows = ['{"a": {"Task_Status": "FAILED"}}', '{"data": [{"status": "done"}]}', '{"x": {"hasData": true, "status": "failed"}}', '{"k": 1}']
    made = spark.createDataFrame(list(enumerate(rows)), "id int, value string")
    assert [r.state for r in responses.response_states(made).orderBy("id").collect()] == ["failed", "success", "existing", "unknown"]
    assert values(spark, S.queue_state, '{"status": "ok"}', '{"traversalStatus": "a", "collectionStatus": "b"}', "{}") == ["ok", "traversalStatus=a; collectionStatus=b", ""]
    assert values(spark, S.error_message, '{"error": "", "message": "m"}') == ["m"]
    assert values(spark, S.queue_has_data, '{"hasData": "yes"}', '{"source": "database_reuse"}', "{}") == [True, True, False]


def test_progress(spark):
    got = spark.sql("select 10 as t, 7 as s, 9 as f, 1 as e, -3 as p").select(S.progress(*[F.col(c) for c in "tsfep"]).alias("x"), S.percent(F.lit(7), F.lit(9)).alias("y")).first()
    assert (got.x.success, got.x.failed, got.x.existing, got.x.pending, got.y) == (7, 3, 0, 0, 77)
