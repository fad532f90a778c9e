"""Steps of the parsers and of the networks that are done once, by the plans, with the rows of their SQL."""

import re

import pytest
from pyspark.sql import functions as F

from lotgraph.functions import text as X
from lotgraph.operators import extraction, risk
from lotgraph.plans import catalog, views
from tests.test_catalog import FOLDER
from tests.test_growth import copies, equal  # noqa: F401


@pytest.mark.parametrize(("category", "most"), [("archive_info", 16), ("bid_candidates", 48), ("bid_evaluation_report", 20)])
def test_lines_are_not_read_again_for_what_is_known(spark, category, most):
    plan = extraction.extract(views.tender_pages(spark, FOLDER, category), [category])._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[", plan)) <= most


def test_names_behind_labels_and_ordinals_are_looked_for_where_an_ending_is(spark):
    texts = ["1 甲建设有限公司", "中标人：乙（集团）有限公司、3.丙研 究所", "无名", "", "我公司委托丁工程公司", "公司", "（1）投标人：戊公司，己集团公司"]
    plain = [["甲建设有限公司"], ["乙(集团", "有限公司"], [], [], ["我公司委托丁工程公司"], [], ["己集团公司"]]
    strict = [["甲建设有限公司"], ["乙(集团"], [], [], [], [], []]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", X.company_names(F.col("t")).alias("n"), X.company_names(F.col("t"), True).alias("s"))
    got = df.orderBy("i").collect()
    assert ([r.n for r in got], [r.s for r in got]) == (plain, strict)
    assert X.A_NAME in df._jdf.queryExecution().optimizedPlan().toString()


def test_names_of_several_nations_have_the_relations_of_all(spark):
    roots = spark.createDataFrame([("A", 1, 1), ("a", 2, 2), ("B", 3, 1)], "company_name string, ord long, `group` int")
    blank = {n: F.lit("") for n in ("source_type", "person_name", "position", "holding_ratio", "related_ent_id")}
    relations = spark.createDataFrame([(1, "X", "r", 1), (1, "x", "r", 2), (2, "X", "q", 3), (2, "Y", "r", 4), (1, "b", "r", 5)], "`group` int, company_name string, relation_type string, ord long").withColumns(blank)
    got = sorted((r.root_key, r.company_key, r.role, [x.relation_type for x in r.relations], r.n_relations) for r in risk.entities_by_group(roots, relations).collect())
    assert got == [("a", "a", "root", [], 0), ("a", "b", "related", ["r"], 1), ("a", "x", "related", ["r", "q"], 2), ("a", "y", "related", ["r"], 1), ("b", "b", "root", [], 0), ("b", "x", "related", ["r"], 1)]
    named = relations.join(roots.select(F.col("company_name").alias("search_value"), "group"), "group")
    same = sorted((r.root_key, r.company_key, r.role, [x.relation_type for x in r.relations], len(r.relations)) for r in risk.entities(roots, named).collect())
    assert same == got


def test_root_networks_rows_are_not_moved_after_the_join(spark, copies):  # noqa: F811
    equal(spark, copies, "root_networks")
    plan = catalog.queries()["root_networks"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    made = [line for line in plan.splitlines() if line.strip()][:3]
    assert "Union" in made[0] and "Project" in made[1] and "Join Inner" in made[2] and "_groups" in made[2]


@pytest.mark.parametrize("common", [1, 3, 1000])
def test_sharing_finds_the_pairs_of_shared_values(spark, common):
    """By bits of words, by values' own pairs and by both; 70 values of many roots take more than one word, and roots that share one company alone don't count."""
    members = [(f"r{i}", f"c{j}", "related") for i in range(9) for j in range(40) if (i * i + j) % 5 == 0 or i == j] + [("p", "only", "related"), ("q", "only", "related"), ("p", "only", "related")]
    facts = [(f"c{j}", "t", f"v{(j * k) % 70}") for j in range(40) for k in (1, 3)] + [("only", "t", "v_only"), ("c0", "t", "v_only")]
    roots = sorted({m[0] for m in members})
    pairs = spark.createDataFrame([(a, b, "1") for a in roots for b in roots if a < b] * 2, "root_a string, root_b string, project_key string")
    m, f = spark.createDataFrame(members, "root_key string, company_key string, role string"), spark.createDataFrame([(*x, x[2]) for x in facts], "company_key string, risk_type string, value string, display string")
    want = {(r.root_a, r.root_b) for r in risk.shared_values(pairs, m, f).select("root_a", "root_b").distinct().collect()}
    got = [(r.root_a, r.root_b) for r in risk.sharing(pairs, m, f, common).collect()]
    assert want and ("p", "q") not in want and len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("name", ["cross_pair_count", "common_projects"])
def test_pairs_are_found_without_a_row_for_each_company(spark, copies, name):  # noqa: F811
    assert "company_a" not in catalog.queries()[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    equal(spark, copies, name)
