"""Queries over tables whose copies repeat names under shifted keys, against their SQL."""

import duckdb
import pytest

from lotgraph.operators import risk
from lotgraph.plans import catalog
from tests.test_catalog import FOLDER, TABLES, plain

SHIFTS = {"customer": {"c_custkey": 150}, "supplier": {"s_suppkey": 10}, "orders": {"o_orderkey": 1500, "o_custkey": 150}, "lineitem": {"l_orderkey": 1500, "l_suppkey": 10}, "events": {"event_id": 1000, "user_id": 15}}


def equal(spark, folder, name):
    with duckdb.connect() as db:
        for t in TABLES:
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
        made = db.sql(catalog.oracle_sql()[name])
        order = sorted(made.columns)
        want = sorted(repr([plain(r[made.columns.index(c)]) for c in order]) for r in made.fetchall())
    df = catalog.queries()[name](spark, folder)
    got = sorted(repr([plain(r[c]) for c in order]) for r in df.collect())
    assert got == want
    return got


@pytest.fixture(scope="module")
def copies(tmp_path_factory):
    folder = tmp_path_factory.mktemp("copies")
    for t in TABLES:
        kept = ", ".join(f"{c} + i * {n} AS {c}" for c, n in SHIFTS.get(t, {}).items())
        rows = f"SELECT l.* REPLACE ({kept}) FROM range(3) r(i), '{FOLDER}/{t}.parquet' l" if kept else f"FROM '{FOLDER}/{t}.parquet'"
        duckdb.sql(f"COPY ({rows}) TO '{folder}/{t}.parquet' (FORMAT parquet)")
    return str(folder)


def test_halves_go_to_the_even_row_count(spark, copies, tmp_path):
    duckdb.sql(f"COPY (SELECT * REPLACE (CASE WHEN event_id % 2 = 0 THEN 996.5 ELSE value END AS value) FROM '{copies}/events.parquet') TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    for t in set(TABLES) - {"events"}:
        (tmp_path / f"{t}.parquet").symlink_to(f"{FOLDER}/{t}.parquet")
    assert equal(spark, str(tmp_path), "run_consolidate")


@pytest.mark.parametrize("name", ["risk_ids", "shared_value_risk", "cross_pair_count"])
def test_members_listed_several_times_count_once(spark, copies, name):
    assert len(set(got := equal(spark, copies, name))) == len(got)


def test_values_of_many_roots_are_met_by_pairs_with_equal_rows(spark):
    """Every way to meet gives the same rows: all values by themselves, some by the pairs, all by the pairs."""
    pairs, members, facts = catalog._pairs(spark, FOLDER), catalog.members(spark, FOLDER), catalog.whole_facts(spark, FOLDER)
    for find in (lambda n: risk.shared_values(pairs, members, facts, n), lambda n: risk.shared_identities(pairs, members, n)):
        one, *others = (sorted(map(str, find(n).select("root_a", "root_b", "value", "company_a", "company_b", "role_a", "role_b").collect())) for n in (1, 3, 1000))
        assert one and all(one == x for x in others)


def test_every_customer_and_value_takes_part(spark):
    """Debtors' addresses and all customers' phones are facts of the three whole risk queries, as each round's SQL before had them."""
    whole = catalog.whole_facts(spark, FOLDER).groupBy("risk_type").agg({"company_key": "count"}).collect()
    companies = sum(spark.read.parquet(f"{FOLDER}/{t}.parquet").count() for t in ("customer", "supplier"))
    assert {r[0]: r[1] for r in whole} == {"shared_phone": companies, "shared_email": companies}


def test_stored_runs_are_dealt_by_the_session_not_into_three(spark):
    plan = catalog.queries()["stored_runs"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" not in plan and "REPARTITION_BY_COL" in plan


def test_repeated_names_meet_once_in_root_networks(spark, copies):
    plan = catalog.queries()["root_networks"](spark, copies)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [c_name" in plan
    assert equal(spark, copies, "root_networks")
