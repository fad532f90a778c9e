import pytest
from pyspark.sql import functions as F

from lotgraph import api
from lotgraph.operators import extraction, pages


def page(doc, category, number, texts, method="text", confidence=0.98, at=None):
    lines = []
    for i, t in enumerate(texts):
        x, y = (at[i] if at else (5, 10 * i))
        lines.append((t, confidence, [[x - 4.0, y - 4.0], [x + 4.0, y - 4.0], [x + 4.0, y + 4.0], [x - 4.0, y + 4.0]]))
    return (doc, category, number, "\n".join(texts), method, 300, "", lines, [])


def run(spark, category, *made):
    df = spark.createDataFrame([page(f"d/{category}.pdf", category, i, t, **more) for i, (t, more) in enumerate(made, 1)], pages.PAGES)
    return [r.asDict() for r in extraction.extract(df, [category]).orderBy("place").collect()]


def test_award_notice(spark):
    (r,) = run(spark, "award_notice", (["JSABC2024-A01", "项目名称：某县农田建设项目", "招标人：建设局公司", "中标人：江苏甲建设有限公司"], {}))
    assert (r["project_name"], r["project_code"], r["lot_code"], r["company_name"], r["award_status"], r["review_status"]) == ("某县农田建设项目", "JSABC2024", "JSABC2024-A01", "江苏甲建设有限公司", "是", "通过")
    assert r["lot_name"] == r["project_name"]


def test_announcement_takes_labelled_lot(spark):
    (r,) = run(spark, "bid_announcement", (["工程名称：某项目一期", "标段编号：ABC123456", "中标单位：乙工程有限公司"], {}))
    assert (r["lot_code"], r["company_name"], r["project_name"]) == ("ABC123456", "乙工程有限公司", "某项目一期")


def test_candidates_and_low_confidence(spark):
    got = run(spark, "bid_candidates", (["某县水利整治工程中标候选人公示", "所有投标人得分汇总表", "序号 投标人名称 排名", "1 甲水利工程有限公司", "2 乙水利工程有限公司", "六、拟定中标人：乙水利工程有限公司"], {"method": "ocr", "confidence": 0.5}))
    assert [(r["company_name"], r["award_status"], r["rank"], r["review_status"]) for r in got] == [("甲水利工程有限公司", "否", "1", "待复核"), ("乙水利工程有限公司", "是", "1", "待复核")]
    assert {r["project_name"] for r in got} == {"某县水利整治工程"}


def test_only_the_score_table(spark):
    one = (["某县农田建设项目中标候选人公示", "投标人名称：丙水利工程有限公司", "五、所有投标人得分汇总表："], {})
    two = (["序号 投标人名称 排名", "1 甲建设有限公司 1", "东县水利电力建筑工程有限责任公      户", "2 18911593.93 2", "司      录", "六、拟定中标人：甲建设有限公司", "征询：丁农业发展有限公司"], {})
    got = run(spark, "bid_candidates", one, two)
    assert [(r["company_name"], r["award_status"], r["rank"]) for r in got] == [("甲建设有限公司", "是", "1"), ("东县水利电力建筑工程有限责任公司", "否", "2")]


def test_cells_by_position(spark):
    first = ["某标准农田建设项目施工中标候选人公", "示交", "五、所有投标人得分汇总表：", "序号", "投标人名称", "投标报价", "1", "甲市澄利建设有限公司", "2", "乙市宏大建设工程有限", "公司"]
    at = [(500, 40), (500, 65), (300, 100), (100, 150), (300, 150), (500, 150), (100, 220), (300, 220), (100, 310), (300, 300), (300, 312)]
    second = ["丙滨海水利建筑工程有", "限公司", "丁市水利工程有限公司", "六、拟定中标人：甲市澄利建设有限公司"]
    got = run(spark, "bid_candidates", (first, {"method": "ocr", "at": at}), (second, {"method": "ocr", "at": [(300, 100), (300, 112), (300, 230), (300, 400)]}))
    assert [r["company_name"] for r in got] == ["甲市澄利建设有限公司", "乙市宏大建设工程有限公司", "丙滨海水利建筑工程有限公司", "丁市水利工程有限公司"]
    assert got[0]["project_name"] == "某标准农田建设项目施工中标候选人公示交"[:11] and [r["rank"] for r in got] == ["1", "2", "3", "4"]


def test_columns_of_the_text_layer(spark):
    layout = ["某县水利整治工程中标候选人公示", "五、所有投标人得分汇总表：", "序号    投标人名称            投标报价", "        甲水利建设工程有限", " 1                            100.00", "        公司", " 2      乙水利有限公司        99.00", "六、拟定中标人：甲水利建设工程有限公司"]
    doc = list(page("d/n.pdf", "bid_candidates", 1, layout))
    doc[6] = "\n".join(layout)
    doc[8] = [("甲水利建设工程有限", 1.0, [[80.0, 700.0]]), ("公司", 1.0, [[80.0, 680.0]])]
    got = extraction.extract(spark.createDataFrame([tuple(doc)], pages.PAGES), ["bid_candidates"]).orderBy("place").collect()
    assert [(r.company_name, r.award_status, r["rank"]) for r in got] == [("甲水利建设工程有限公司", "是", "1"), ("乙水利有限公司", "否", "2")]


def test_without_a_title(spark):
    (r,) = run(spark, "bid_candidates", (["项目名称：表头中的项目名称", "第一中标候选人：甲建设有限公司"], {}))
    assert (r["project_name"], r["company_name"], r["review_status"]) == ("", "", "待复核") and "标题" in r["evidence"]


def test_evaluation_report(spark):
    contents = (["目录", "投标人排序及推荐的中标候选人"], {})
    facts = (["基本情况一览表", "工程名称", "某县农田建设项目施工"], {"at": [(50, 5), (10, 50), (90, 51)]})
    ranking = (["投标人排序及推荐的中标候选人", "投标人名称", "1 甲建设有限公司"], {})
    more = (["2 乙建设有限公司", "推荐的中标候选人", "第一名", "乙建设有限公司", "第二名", "甲建设有限公司", "丙建设有限公司"], {})
    got = run(spark, "bid_evaluation_report", contents, facts, ranking, more, (["丁建设有限公司"], {}))
    assert [(r["company_name"], r["award_status"], r["rank"], r["review_status"]) for r in got] == [("甲建设有限公司", "否", "1", "通过"), ("乙建设有限公司", "是", "2", "通过")]
    assert {r["project_name"] for r in got} == {"某县农田建设项目施工"}


def test_evaluation_report_without_table_or_winner(spark):
    (r,) = run(spark, "bid_evaluation_report", (["投标人排序及推荐的中标候选人", "没有企业"], {}))
    assert r["review_status"] == "待复核" and r["evidence"].startswith("未定位")
    got = run(spark, "bid_evaluation_report", (["投标人排序及推荐的中标候选人", "投标人名称", "1 甲建设有限公司", "推荐的中标候选人", "无"], {}))
    assert [(r["company_name"], r["award_status"], r["review_status"]) for r in got] == [("甲建设有限公司", "未知", "待复核")] and got[0]["evidence"].startswith("未识别推荐")


def test_report_pages_are_scanned_then_read(spark):
    table = ["投标人排序及推荐的中标候选人", "投标人名称", "1 甲建设有限公司", "推荐的中标候选人", "第一名"]
    texts = {("a", 1): ["目录"], ("a", 2): table, ("a", 3): ["附件"], ("b", 1): ["看不清"], ("b", 2): ["也看不清"]}
    made = lambda rows: spark.createDataFrame([page(d, "bid_evaluation_report", n, t) for (d, n), t in rows], pages.PAGES)
    asked = []

    def read(keys):
        asked.extend(tuple(r) for r in keys.collect())
        return made([(k, [*texts[k], "细读"]) for k in asked if k != ("b", 2)])

    got = {(r.doc_path, r.page_number): (r.text.endswith("细读"), r.fallback) for r in extraction.report_pages(made(texts.items()), read).collect()}
    assert sorted(asked) == [("a", 2), ("b", 1), ("b", 2)]
    assert got == {("a", 1): (False, False), ("a", 2): (True, False), ("a", 3): (False, False), ("b", 1): (True, True)}


def test_list_column_and_continuation(spark):
    first = (["序号", "单位名称", "联系人", "1", "甲建设有限公司", "丙公司"], {"at": [(10, 10), (100, 10), (300, 10), (10, 40), (100, 40), (300, 40)]})
    second = (["乙建设有限公司", "丁公司"], {"at": [(100, 20), (300, 20)]})
    got = run(spark, "bid_list", first, second)
    assert [r["company_name"] for r in got] == ["甲建设有限公司", "乙建设有限公司"]


def test_archive_and_cover_and_nothing(spark):
    got = run(spark, "archive_info", (["按时送达投标文件的投标人名单", "甲建设有限公司、乙建设有限公司"], {}), (["中标通知书", "中标人：丙建设有限公司"], {}))
    assert [(r["company_name"], r["award_status"]) for r in got] == [("甲建设有限公司", "否"), ("乙建设有限公司", "否"), ("丙建设有限公司", "是")]
    (cover,) = run(spark, "tender_cover", (["某农田建设项目", "项目编号：ABC123-02", "投标人：甲建设有限公司（盖章）"], {}))
    assert (cover["company_name"], cover["project_code"], cover["lot_code"], cover["review_status"]) == ("甲建设有限公司", "ABC123", "ABC123-02", "待复核")
    (empty,) = run(spark, "bid_list", (["没有内容"], {}))
    assert (empty["company_name"], empty["review_status"]) == ("", "待复核")


def test_notice_sentences_and_head_codes(spark):
    """Values that the extraction has to give for these notices: whole lot codes, the project of the sentence, also over a line's end."""
    cases = (
        (["交易结果通知书", "HSLS20201011-01", "甲建设有限公司：", "甲方的测试农田建设项目施工的评审工作已经结束。"], "测试农田建设项目施工", "HSLS20201011", "HSLS20201011-01", "甲建设有限公司"),
        (["中标通知书", "编号：", "WXHS20210908001-S04", "乙建设有限公司：", "乙方的测试水利建设项目施工的评标工作已经结束。"], "测试水利建设项目施工", "WXHS20210908001", "WXHS20210908001-S04", "乙建设有限公司"),
        (["中标通知书", "", " ", "", "", "", "", "", "", "hsls2020—01", "丙建设有限公司：", "丙方的测试水利建", "设项目施工的交易已", "完成。"], "测试水利建设项目施工", "HSLS2020", "HSLS2020-01", "丙建设有限公司"),
        (["中标通知书", "项目名称：已标明的农田项目", "ABC20_24", "丁建设有限公司：", "丁方的测试水利建设项目施工的评标结束。"], "已标明的农田项目", "ABC20", "", "丁建设有限公司"),
    )
    df = spark.createDataFrame([page(f"d/{i}.pdf", "award_notice", 1, case[0]) for i, case in enumerate(cases)], pages.PAGES)
    got = extraction.extract(df, ["award_notice"]).orderBy("source_path").collect()
    assert len(got) == len(cases)
    for r, (_, project, code, lot, company) in zip(got, cases, strict=True):
        assert (r["project_name"], r["lot_name"], r["project_code"], r["lot_code"], r["company_name"], r["award_status"], r["review_status"]) == (project, project, code, lot, company, "是", "通过")


def test_archive_lists_and_metadata(spark):
    wrapped = ["招投标基本情况报告", "2、按时送达投标文件的投标人名单：", "江苏诣钦工程建设有限公司、江苏翰林工程", "建设有限公司、江苏金隆吉建设工程有限公司、", "3、开标基本情况：", "某见证有限公司"]
    documents = (
        (["工程名称：测试农田建设项目"], ["中标通知书", "中标人：甲建设有限公司"], ["按时送达投标文件的投标人名单", "甲建设有限公司", "乙工程有限公司"]),
        (["工程名称：洛南大道南片高标准农田建设项目"], ["投标人名单", "甲建设有限公司"]),
        (["项目名称：不应被备案资料解析采用的叙述文本", "标段名称：2022年洛社镇镇北村河西高标准农田建设项目施工", "项目编号：HSLS2022014-01"], ["投标人名单", "甲建设有限公司"]),
        (wrapped,),
    )
    df = spark.createDataFrame([page(f"d/{i}.pdf", "archive_info", n, lines) for i, made in enumerate(documents) for n, lines in enumerate(made, 1)], pages.PAGES)
    rows = extraction.extract(df, ["archive_info"]).orderBy("source_path", "place").collect()
    first, second, third, fourth = ([r for r in rows if r.source_path == f"d/{i}.pdf"] for i in range(4))
    assert [(r.company_name, r.award_status) for r in first] == [("甲建设有限公司", "是"), ("乙工程有限公司", "否")]
    assert (first[0].project_name, first[0].lot_name, first[0].review_status) == ("测试农田建设项目", "测试农田建设项目", "待复核")
    assert [(r.company_name, r.project_name, r.lot_name) for r in second] == [("甲建设有限公司", *["洛南大道南片高标准农田建设项目"] * 2)]
    assert [(r.project_name, r.lot_name, r.project_code, r.lot_code) for r in third] == [("2022年洛社镇镇北村河西高标准农田建设项目施工",) * 2 + ("HSLS2022014", "HSLS2022014-01")]
    assert [r.company_name for r in fourth] == ["江苏诣钦工程建设有限公司", "江苏翰林工程建设有限公司", "江苏金隆吉建设工程有限公司"]
    assert "江苏翰林工程建设有限公司" in fourth[1].evidence


def test_list_and_candidates_split_codes(spark):
    cells = ["标段（包）编号：WXHS20210908001-S04", "标段（包）名称：前洲片区生态综合整治项目（农田水利部分）水利基建项目一标段", "序号", "单位名称", "投标联系人", "联系方式", "1", "甲建设有限公司", "联系人建设有限公司", "2", "乙水利工程有限公司", "另一联系人有限公司"]
    at = [(500, 40), (500, 70), (100, 120), (320, 120), (620, 120), (820, 120), (100, 160), (320, 160), (620, 160), (100, 200), (320, 200), (620, 200)]
    got = run(spark, "bid_list", (cells, {"at": at, "method": "ocr"}))
    assert [r["company_name"] for r in got] == ["甲建设有限公司", "乙水利工程有限公司"]
    assert {(r["project_name"], r["lot_name"]) for r in got} == {("前洲片区生态综合整治项目（农田水利部分）水利基建项目", "前洲片区生态综合整治项目（农田水利部分）水利基建项目一标段")}
    assert {(r["project_code"], r["lot_code"], r["award_status"], r["review_status"]) for r in got} == {("WXHS20210908001", "WXHS20210908001-S04", "未知", "通过")}
    listed = ["测试农田建设项目中标候选人公示", "项目编号：ABC20260001-S01", "五、所有投标人得分汇总表：", "序号 投标人名称 排名", "1 甲建设有限公司 1", "2 乙工程有限公司 2", "六、拟定中标人：甲建设有限公司"]
    got = run(spark, "bid_candidates", (listed, {}))
    assert [(r["company_name"], r["award_status"], r["project_code"], r["lot_code"]) for r in got] == [("甲建设有限公司", "是", "ABC20260001", "ABC20260001-S01"), ("乙工程有限公司", "否", "ABC20260001", "ABC20260001-S01")]


def test_selection_and_process(spark):
    assert api.selected(exclude=["bid_list"])[:2] == ("tender_cover", "bid_evaluation_report")
    for bad in ({"include": []}, {"only": "x"}, {"include": ["bid_list"], "only": "bid_list"}):
        with pytest.raises(ValueError):
            api.selected(**bad)
    with pytest.raises(ValueError):
        extraction.extract(spark.createDataFrame([], pages.PAGES), ["x"])
    df = spark.createDataFrame([page("a.pdf", "award_notice", 1, ["项目名称：某项目甲", "中标人：甲建设有限公司"]), page("b.pdf", "bid_announcement", 1, ["项目名称：某项目甲", "中标人：甲建设有限公司"])], pages.PAGES)
    assert api.process(df).where("company_name <> ''").count() >= 1


def test_page_plans(spark):
    df = spark.createDataFrame([("d", i, "中标通知书" if i == 6 else "x") for i in range(1, 10)], "doc_path string, page_number int, text string")
    assert sorted(r.page_number for r in pages.archive_pages(df).collect()) == [1, 2, 3, 5, 6, 7]
    groups = pages.gap_groups(spark.createDataFrame([("a", 1), ("a", 2), ("a", 9), ("a", 10)], "k string, y int"), ["k"], "y", F.col("y") - F.col("previous") > 3)
    assert [r.group for r in groups.orderBy("y").collect()] == [0, 0, 1, 1]
    got = spark.range(1).select(pages.pages_to_read(F.lit("tender_cover"), F.lit(9), F.array().cast("array<int>")).alias("a"), pages.pages_to_read(F.lit("bid_list"), F.lit(2), F.array().cast("array<int>")).alias("b")).first()
    assert (got.a, got.b) == ([1, 2, 3, 4, 5], [1, 2])
