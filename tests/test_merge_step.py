"""What merging records asks of the engine: a lookup for those that ask, groups sorted by a number, no distinct counts."""

from lotgraph.operators import keys
from lotgraph.plans import catalog
from tests.test_catalog import FOLDER


def test_only_records_that_ask_are_joined_and_groups_are_sorted_by_a_number(spark):
    merged = keys.merge_records(catalog.bids(spark, FOLDER))
    plan = merged.select("lot_code", "n_records", "first_source", "review_status")._jdf.queryExecution().executedPlan().toString()
    assert "Sort [_gh#" in plan and "distinct" not in plan and "collect_set" not in plan
    coded = catalog.bids(spark, FOLDER).where("project_code <> '' and lot_code <> ''").drop("l_suppkey")
    plan = keys.merge_records(coded)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1  # the supplier's; nobody asks


def test_first_source_is_the_best_sources_path(spark):
    row = dict.fromkeys("project_name project_code lot_code lot_name company_name award_status rank source_pages extraction_method evidence generated_at".split(), "")
    row |= {"project_code": "P", "lot_code": "L", "company_name": "C", "confidence": 1.0, "review_status": "通过"}
    made = [row | {"category": c, "source_path": p, "ord": o} for c, p, o in (("bid_list", "a", "1"), ("award_notice", "", "2"), ("award_notice", " x；y ", "3"), ("tender_cover", "b", "4"))]
    (got,) = keys.merge_records(spark.createDataFrame(made)).collect()
    assert (got.first_source, got.source_path, got.n_records) == ("x；y", "x；y；b；a", 4)
