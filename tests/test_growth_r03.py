"""Steps that are done once, by what the plans and the written tables show."""

from pyspark.sql import functions as F

from lotgraph.functions import text as X
from lotgraph.operators import responses
from lotgraph.plans import catalog
from tests.test_catalog import FOLDER


def test_responses_are_opened_once_and_only_states_and_containers_are_written(spark, monkeypatch):
    written, keep = [], responses.Scratch.keep

    def noted(self, df, name, **settings):
        kept = keep(self, df, name, **settings)
        written.append((name, set(kept.columns), kept.where("told is null and _v is null").count()))
        return kept

    monkeypatch.setattr(responses.Scratch, "keep", noted)
    df = catalog.queries()["nested_statuses"](spark, FOLDER)
    names = [name for name, _, _ in written]
    assert df.count() and len(names) == len(set(names)) > 3
    assert all(columns == {"_id", "told", "_v"} and not rest for _, columns, rest in written)


def test_listed_values_of_ids_without_any(spark):
    rows = [(1, '{"status":"done","x":[{"msg":"ok"}]}'), (2, "no json"), (3, None), (3, '{"state":""}'), (None, '{"code":5}')]
    got = responses.response_states(spark.createDataFrame(rows, "id long, value string"), listed=True).collect()
    assert {(r.id, r.listed, r.state) for r in got} == {(1, "done|ok", "success"), (2, "", "unknown"), (3, "", "unknown"), (None, "5", "unknown")}


def test_fingerprint_spells_its_parts_in_one_pass_with_equal_digests(spark):
    parts = [" A\x1fb ", "x\x00y", "Straße ΑΣ", "", "　Σ", "Σ", None]
    df = spark.createDataFrame([(a, b) for a in parts for b in parts], "a string, b string")
    before = F.sha2(F.concat_ws("\x1f", *[X.key_part(c) for c in (F.lit("Kind"), F.col("a"), F.col("b"))]), 256)
    made = df.select(X.fingerprint("Kind", F.col("a"), F.col("b")).alias("now"), before.alias("before"))
    assert all(r.now == r.before for r in made.collect())
    plan = made.select("now")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1


def test_projects_are_sorted_by_a_number_first(spark):
    plan = catalog.queries()["build_projects"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Sort [_h#" in plan
