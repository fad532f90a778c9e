import pytest
from pyspark.sql import functions as F

from lotgraph.operators import crawl, keys, risk, statistics

FIELDS = "ord int, project_name string, project_code string, lot_code string, lot_name string, company_name string, award_status string, rank string, category string, source_path string, source_pages string, extraction_method string, evidence string, confidence double, review_status string, generated_at string, record_id string"


def record(ord, **more):
    base = dict(project_name="项目", project_code="P1", lot_code="L1", lot_name="", company_name="甲公司", award_status="未知", rank="", category="bid_list", source_path=f"f{ord}", source_pages="1", extraction_method="text", evidence=f"e{ord}", confidence=0.9, review_status="通过", generated_at=f"2024-01-0{ord}", record_id="")
    base.update(more)
    return (ord, *[base[f.split()[0]] for f in FIELDS.split(", ")[1:]])


def merged(spark, *rows):
    return keys.merge_records(spark.createDataFrame(list(rows), FIELDS)).collect()


def test_merge_conflict_and_priority(spark):
    got = merged(spark, record(1, award_status="是", category="award_notice", rank="1"), record(2, award_status="否", category="bid_candidates"), record(3))
    assert len(got) == 1
    r = got[0]
    assert (r.award_status, r.rank, r.review_status, r.confidence, r.generated_at) == ("是", "1", "冲突待复核", 0.9, "2024-01-03")
    assert r.evidence == "存在中标状态冲突；e1；e2；e3" and r.category == "award_notice；bid_candidates；bid_list" and r.source_pages == "f1#第1页；f2#第1页；f3#第1页"


def test_merge_explicit_over_higher_unknown(spark):
    r = merged(spark, record(1, category="award_notice"), record(2, award_status="否", category="bid_list", review_status="待复核"))[0]
    assert (r.award_status, r.review_status) == ("否", "待复核")


def test_merge_finds_codes_by_name(spark):
    assert len(merged(spark, record(1, lot_code="", lot_name="一标段"), record(2, project_code="", lot_code="", lot_name="一标段"))) == 1
    assert len(merged(spark, record(1, lot_code="A", lot_name="一标段"), record(2, lot_code="", lot_name="一标段"))) == 1
    both = merged(spark, record(1, lot_code="A", lot_name="一标段"), record(2, lot_code="B", lot_name="一标段"), record(3, lot_code="", lot_name="一标段"))
    assert len(both) == 3  # two lots fit, so neither is taken
    assert len(merged(spark, record(1, company_name=""), record(2, company_name=""))) == 2


def test_keys(spark):
    df = spark.createDataFrame([record(1), record(2, project_code=" p1 "), record(3, project_code="", project_name="p1"), record(4, lot_code="", lot_name="")], FIELDS)
    rows = df.orderBy("ord").select(keys.business_key().alias("b"), keys.project_key().alias("p")).collect()
    assert rows[0].b == rows[1].b == rows[2].b != rows[3].b
    assert rows[0].p.key == rows[1].p.key != rows[2].p.key
    assert [r.p.source for r in rows] == ["project_code_lot_code", "project_code_lot_code", "project_name_lot_code", "project_code_fallback"]


def test_upsert_last_wins(spark):
    old = spark.createDataFrame([("a", "run-1"), ("b", "run-1")], "business_key string, run_id string")
    new = spark.createDataFrame([("b", "x", 1), ("b", "run-2", 2), ("c", "run-2", 3)], "business_key string, run_id string, ord int")
    assert sorted(map(tuple, keys.upsert(old, new).collect())) == [("a", "run-1"), ("b", "run-2"), ("c", "run-2")]


def network(spark):
    bids = spark.createDataFrame([record(1, company_name="甲公司"), record(2, company_name="乙公司"), record(3, company_name="丙公司", project_code="P2")], FIELDS)
    relation = "search_value string, company_name string, source_type string, relation_type string, person_name string, position string, holding_ratio string, related_ent_id string, ord int, delete_flag string"
    relations = spark.createDataFrame([
        ("甲公司", "丁公司", "s", "投资", "张三", "", "50%", "9", 1, None), ("甲公司", "丁公司", "s", "投资", "张三", "", "50%", "9", 2, None), ("乙公司", "丁公司", "s", "任职", "李四", "", "", "9", 3, None),
        ("乙公司", "甲公司", "s", "投资", "", "", "", "", 4, None), ("乙公司", "戊公司", "s", "投资", "", "", "", "", 5, "DELETE"), ("乙公司", "乙公司", "s", "", "", "", "", "", 6, None),
    ], relation)
    company = spark.createDataFrame([(1, "甲公司", "甲公司", "13800000000", "a@x.com"), (2, "乙公司", "乙公司", "86 138 0000 0000", "A@X.COM"), (3, "甲公司", "丁公司", "", "")], "record_id int, search_value string, company_name string, phone_number string, email string")
    shareholder = spark.createDataFrame([(1, "甲公司", "王五", "10%"), (2, "乙公司", "王 五", "20%"), (3, "甲公司", "赵六", "")], "record_id int, search_value string, shareholder_name string, subscribed_ratio string")
    staff = spark.createDataFrame([(1, "甲公司", "无", ""), (9, "乙公司", "孙七", "经理"), (8, "甲公司", "孙七", "经理")], "record_id int, search_value string, staff_name string, position string")
    bidders = risk.projects(bids)
    members = risk.entities(bids.select("company_name", "ord"), relations)
    return bidders, members, risk.evidence(members.select("company_name").distinct(), company, shareholder, staff)


def test_risks_of_one_lot(spark):
    bidders, members, facts = network(spark)
    assert members.where("role = 'related'").count() == 3
    assert {r.company_key for r in facts.where("value = '赵六'").collect()} == {"丁公司"}  # by its record, not by the name searched for
    found = risk.detect(bidders, members, facts)
    got = {(r.comparison_type, r.risk_type, r.value) for r in found.collect()}
    assert ("root_root", "shared_phone", "13800000000") in got and ("root_root", "shared_email", "a@x.com") in got
    assert ("root_root", "shared_shareholder", "王五") in got and ("root_root", "shared_senior_staff", "孙七") in got
    assert ("related_related", risk.IDENTITY, "丁公司") in got and ("root_related", risk.IDENTITY, "甲公司") in got
    assert not any("丙公司" in (r.root_a, r.root_b) for r in found.collect())
    assert {len(r.x) for r in found.select(risk.risk_id("r").alias("x")).collect()} == {20}
    assert risk.common_projects(found, bidders).count() == 1


def test_statistics_and_groups(spark):
    rows = [(str(p), c, p == 1 and c == "a") for c, ps in {"a": range(1, 5), "b": range(1, 6), "c": range(2, 6), "d": range(3)}.items() for p in ps]
    records = statistics.bid_records(spark.createDataFrame(rows, "project_key string, company_name string, awarded boolean"))
    per = statistics.company_statistics(records)
    assert {r.company for r in statistics.long_term_losers(per).collect()} == {"b", "c"}
    assert {(r.company, r.win_rate) for r in per.where("wins > 0").collect()} == {("a", 25.0)}
    assert {(tuple(r.companies), r.n_projects) for r in statistics.maximal_groups(records).collect()} == {(("a", "b"), 4), (("b", "c"), 4)}
    kinds = spark.createDataFrame([("shared_phone", "13800000000"), ("shared_phone", "05101234567"), (risk.IDENTITY, "x")], "k string, v string")
    assert [r[0] for r in kinds.select(statistics.report_type(F.col("k"), F.col("v"))).collect()] == ["shared_mobile", "shared_landline", None]


def test_consolidation_follows_order(spark):
    rows = [(1, "root", "", "甲"), (2, "root", "7", "甲"), (3, "root", "7", "甲有限"), (4, "root", "8", "甲"), (5, "related", "7", "甲"), (6, "root", "", "乙")]
    df = spark.createDataFrame(rows, "ord int, company_type string, company_id string, company_name string")
    got = {r.ord: r.entity for r in crawl.consolidate(df).collect()}
    assert got[1] == got[2] == got[3] and len({got[i] for i in (1, 4, 5, 6)}) == 4


def test_fold_counts_and_retries(spark):
    schema = "ord int, run_id string, company_type string, company_name string, status string, attempts int, database_rows int, has_data boolean, message string"
    df = spark.createDataFrame([(1, "r", "root", "甲", "waiting", 1, 0, False, "m1"), (2, "r", "root", "甲", "success", 2, 5, True, "m2"), (3, "r", "root", "甲", "failed", 1, 3, False, "m1"), (4, "q", "related", "乙", "timeout", 1, 0, False, "搜索无结果")], schema)
    one = crawl.fold(df, ["company_name"]).where("company_name = '甲'").first()
    assert (one.status, one.attempts, one.database_rows, one.has_data, one.message) == ("success", 4, 5, True, "m1; m2")
    assert crawl.status_counts(df).where("company_type is null").first().pending == 1
    again = spark.createDataFrame([(1, "a", "failed", "搜索无结果"), (2, "b", "failed", "x"), (3, "c", "ok", "TargetClosedError")], "ord int, run_id string, status string, message string")
    assert {r.run_id: r.retry for r in crawl.retry_runs(again).collect()} == {"a": True, "b": False, "c": True}
    shuffled = df.orderBy(F.desc("ord"))
    assert crawl.signature(df, ["ord", "status"]).first() == crawl.signature(shuffled, ["ord", "status"]).first()


@pytest.mark.parametrize("rows", [0, 3])
def test_history(spark, rows):
    bids = spark.createDataFrame([record(i, project_code=f"P{i % 2}", company_name=f"C{i}") for i in range(1, 4)][: rows or 3], FIELDS)
    names = spark.createDataFrame([("c1",)] if rows else [], "company_name string")
    assert risk.history(bids, names).count() == (2 if rows else 0)


def test_consolidation_by_the_prevailing_name(spark):
    columns = "company_type string, company_id string, company_name string, status string, ord int"
    rows = [("", "X", "A", "failed", 1), ("", "X", "B", "success", 2), ("", "", "B", "waiting", 3), ("", "", "", "success", 4), ("", "", "", "success", 5), ("related", "X", "A", "failed", 6), ("", "Y", "A", "failed", 7)]
    got = {r.ord: r.entity for r in crawl.consolidate(spark.createDataFrame(rows, columns)).collect()}
    assert got[1] == got[2] == got[3] and len({got[i] for i in (1, 4, 5, 6, 7)}) == 5
    low = [("", "X", "A", "success", 1), ("", "X", "B", "failed", 2), ("", "", "B", "waiting", 3)]
    got = {r.ord: r.entity for r in crawl.consolidate(spark.createDataFrame(low, columns)).collect()}
    assert got[1] == got[2] != got[3]
    twice = spark.createDataFrame([("", "X", "A", "failed", 1), ("", "X", "A", "failed", 1)], columns)
    assert crawl.consolidate(twice).count() == 2


def test_typed_results(spark):
    df = spark.createDataFrame([('{"companyName": " 甲 ", "status": "failed", "attempts": "2", "hasData": "是", "queryStatus": "done", "relatedSources": ["a", ""]}',), ("{}",)], "value string")
    one, none = crawl.typed_results(df).collect()
    assert (one.company_name, one.attempts, one.has_data, one.raw_status, one.related_sources, one.company_type) == ("甲", 2, True, "done", ["a"], "root")
    assert (none.company_name, none.database_rows, none.has_data, none.related_sources) == ("", 0, False, [])


def test_reconciled_until_final(spark):
    from lotgraph import api

    columns = "company_type string, company_name string, status string, has_data boolean, database_rows long"
    current = spark.createDataFrame([("root", "甲", "timeout", False, 0), ("root", "乙", "success", True, 3)], columns)
    asked = []

    def refresh(rows):
        asked.append([r.company_name for r in rows.collect()])
        return spark.createDataFrame([("root", "甲", "success" if len(asked) == 2 else "timeout", len(asked) == 2, 0)], columns)

    results, changed, final = api.reconcile_until_final(current, refresh)
    assert asked == [["甲"], ["甲"]] and changed and final and {r.status for r in results.collect()} == {"success"}
