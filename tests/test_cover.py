"""Fields of tender covers on the layouts that covers have."""

import pytest
from pyspark.sql import functions as F
from test_extraction import page, run

from lotgraph.operators import cover, pages


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def rows(*texts):
    return F.array(*[F.lit(t) for t in texts])


COVERS = {
    "labelled": (
        ["2021年东湖镇南片区高标准农田建设项目", "施工招标", "投标文件", "项目编号：ABCD20221008001", "项目名称：2021年东湖镇南片区高标准农田建设项目施工", "投 标 人：南城市银湖建筑安装有限公司", "日期：2022年11月3日"],
        ("2021年东湖镇南片区高标准农田建设项目施工", "ABCD20221008001", "ABCD20221008001", "", "南城市银湖建筑安装有限公司"),
    ),
    "hints in the title": (
        ["东园村高标准农田建设项目(二期）【工程名称)", "施工 标段名称)", "参与文件", "交易编号：efgh2021011-01", "参与单位：南城润水市政绿化有限公司盖单位章）"],
        ("东园村高标准农田建设项目(二期)施工", "EFGH2021011", "EFGH2021011-01", "", "南城润水市政绿化有限公司"),
    ),
    "value on the next lines, misread signs": (
        ["投标人：南城才方工程有限公司", "2024年度东湖街道园区高标", "准农田建设改造提升项目施工招标", "投标文件", "项目编号：_", "项目名称：2024年度东湖街道园区高标准", "农田建设改造提升项旦（财政补助）", "投标人：_南城方方工程有公司（盖公章)"],
        ("2024年度东湖街道园区高标准农田建设改造提升项目(财政补助)", "", "", "", "南城才方工程有限公司"),
    ),
    "lot as words": (
        ["西山乡水利基建项目二标段工程施工招标", "投标文件", "参与单位：", "江南甲水务集团", "法定代表人：某"],
        ("西山乡水利基建项目", "", "", "二标段", "江南甲水务集团"),
    ),
    "title before the code": (
        ["商务标", "投标人：西山乙建设有限公司", "西山乡", "日期：2024年", "丙村农田建设项目", "一期施工", "第1页/共2页", "招标编号：XY-2024-07", "投标文件"],
        ("丙村农田建设项目一期施工", "XY", "XY-2024-07", "", "西山乙建设有限公司"),
    ),
    "nothing": (["建设工程", "投标文件", "日期：2024年1月2日"], ("", "", "", "", None)),
}


@pytest.fixture(scope="module")
def read(spark):
    df = spark.createDataFrame([page(k, "tender_cover", 1, t) for k, (t, _) in COVERS.items()], pages.PAGES)
    return {r.doc_path: (r.project_name, r.project_code, r.lot_code, r.lot_name, r.name) for r in cover.fields(pages.lines(df)).collect()}


@pytest.mark.parametrize("layout", COVERS)
def test_layouts(read, layout):
    assert read[layout] == COVERS[layout][1]


def test_rules_of_lines(spark):
    assert [one(spark, cover.is_noise(F.lit(x))) for x in ("投标文件", "2024年1月2日", "第3页/共9页", "新点电子招投标系统", "(工程名称)", "某农田")] == [True] * 5 + [False]
    assert [one(spark, cover.is_title(F.lit(x))) for x in ("建设工程", "投标人:某公司:某高标准农田建设项目", "某高标准农田二期工程", "某建设项目AB12345", "某道路")] == [False, False, True, False, False]
    for text in ("丁村高标准农田建设项目(二期)【工程名称)施工标段名称)", "丁村高标准农田建设项目(二期)(工程名称)施工(标段名称)投标文件内容"):
        assert one(spark, cover.bare_title(F.lit(text))) == "丁村高标准农田建设项目(二期)施工"
    assert one(spark, cover.without_section(F.lit("一标段工程"), F.lit("一标段"))) == "一标段工程"
    assert tuple(one(spark, cover.code_parts(F.lit("ab20231116001－s01")))) == ("AB20231116001", "AB20231116001-S01")


def test_values_behind_labels(spark):
    lines = rows("工程项目名称)x", "编号", "", "投标人:甲", "项目编号:_A-1_")
    assert one(spark, cover.value_of(lines, ("编号",), ("投标人",))) == ""
    assert one(spark, cover.value_of(lines, ("项目编号", "编号"), ("无",), 1)) == "A-1"
    assert one(spark, cover.joined_value(rows("(项目名称)某", "项目名称:甲", "", "乙", "日期:1"), ("项目名称",), ("日期",))) == "甲乙"


def test_record_of_a_cover(spark):
    (r,) = run(spark, "tender_cover", (["某镇高标准农田建设项目", "项目编号：ABC123-02", "投标单位：甲建设有限公司（盖公章）"], {"method": "ocr", "confidence": 0.9}))
    assert (r["project_name"], r["project_code"], r["lot_code"], r["lot_name"], r["company_name"]) == ("某镇高标准农田建设项目", "ABC123", "ABC123-02", "", "甲建设有限公司")
    assert (r["evidence"], r["confidence"], r["extraction_method"]) == ("投标单位：甲建设有限公司（盖公章）", 0.9, "ocr")
    assert [x["company_name"] for x in run(spark, "tender_cover", (["无", ""], {}))] == [""]
