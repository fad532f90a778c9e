"""The risk document and the text report, put together on the driver from small aggregates."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import risk, statistics
from ..operators.graph import Scratch

BLOCK = re.compile(r"\{\{#([^{}#/]+)\}\}(.*?)\{\{/\1\}\}", re.S)
VARIABLE = re.compile(r"\{\{([^{}#/]+)\}\}")
#: All types are listed in a summary, also those that didn't occur.
RISK_TYPES = ("shared_phone", "shared_email", "shared_shareholder", "shared_senior_staff", "shared_company_identity")
COMPARISONS = ("root_root", "root_related", "related_related")


def fill(text: str, values: dict) -> str:
    """Blocks first, then variables. A block over a list is repeated with each item's values, over anything else it is kept if that is true.
    Unknown variables stay as they are."""
    while True:
        done = BLOCK.sub(lambda m: _block(m[2], values.get(m[1].strip()), values), text)
        if done == text:
            return VARIABLE.sub(lambda m: str(values.get(m[1].strip(), m[0])), done)
        text = done


def _block(body: str, value, values: dict) -> str:
    if isinstance(value, list):
        return "".join(fill(body, {**values, **(item if isinstance(item, dict) else {".": item})}) for item in value)
    return body if value else ""


def unresolved(text: str) -> list[str]:
    return sorted(set(re.findall(r"\{\{[^{}]*\}\}", text)))


def check_document(document: dict) -> None:
    """The shape that a report needs; anything else is an error."""
    if not isinstance(document, dict):
        raise ValueError("the document must be an object")
    for name, kind in (("summary", dict), ("projects", list), ("risks", list)):
        if not isinstance(document.get(name), kind):
            raise ValueError(f"{name} must be a {kind.__name__}")


def summary(bidders: DataFrame, members: DataFrame, risks: DataFrame) -> dict:
    """Counts for the document's head: each is one row or one per type."""
    totals = bidders.agg(F.count_distinct("project_key").alias("projects"), F.count_distinct("company_key").alias("companies")).first().asDict()
    related = members.where("role = 'related'").agg(F.count_distinct("company_key").alias("related"), F.count("*").alias("relations")).first().asDict()
    by_type = {r[0]: r[1] for r in risks.groupBy("risk_type").count().collect()}
    by_comparison = {r[0]: r[1] for r in risks.groupBy("comparison_type").count().collect()}
    return {**totals, **related, "risks": sum(by_type.values()), "riskTypes": {t: by_type.get(t, 0) for t in RISK_TYPES}, "comparisonTypes": {t: by_comparison.get(t, 0) for t in COMPARISONS}}


def context(bidders: DataFrame, risks: DataFrame, most: int = 100_000) -> dict:
    """What the template of one report shows: visible risks, losers, winners, recurring groups. A list of more than ``most`` rows is an error, and
    write_context_tables is the way."""
    per = statistics.company_statistics(statistics.bid_records(bidders))

    def rows(df: DataFrame) -> list[dict]:
        got = df.limit(most + 1).collect()
        if len(got) > most:
            raise ValueError(f"more than {most} rows are too many for one report; use write_context_tables")
        return [r.asDict() for r in got]

    losers = rows(statistics.long_term_losers(per).orderBy(F.desc("bids"), "company"))
    winners = rows(statistics.high_win_rate(per).orderBy(F.desc("win_rate"), F.desc("bids"), "company"))
    groups = rows(statistics.maximal_groups(statistics.bid_records(bidders)).orderBy(F.desc("n_projects"), "companies"))
    shown = rows(statistics.visible(risks).orderBy("comparison_type", "risk_type", "value", "root_a", "root_b").select("comparison_type", "report_type", "value", "root_a", "root_b"))
    return {"losers": losers, "no_losers": not losers, "winners": winners, "no_winners": not winners, "groups": groups, "no_groups": not groups, "risks": shown, "no_risks": not shown}


def render(template: str, values: dict, typeset: Callable[[str], bytes] | None = None):
    """The filled template; what typeset makes of it if given. A placeholder that is left is an error."""
    text = fill(template, values)
    if left := unresolved(text):
        raise ValueError(f"unresolved placeholders: {left}")
    return typeset(text) if typeset else text


def risk_tables(run_id: str, bidders: DataFrame, members: DataFrame, facts: DataFrame, generated_at: str, everything: DataFrame | None = None) -> tuple[dict, DataFrame, DataFrame, DataFrame]:
    """(head, projects, risks, common projects) of a run's document. The head holds counts only; the lists stay distributed.

    everything: bidders of current and past projects (risk.with_history), else the run's. Common projects: a row for each pair of roots with risks and each project that both bid for.
    """
    scratch = Scratch(bidders.sparkSession)  # each table is read several times below
    bidders, members, facts = (scratch.keep(df, name) for df, name in ((bidders, "bidders"), (members, "members"), (facts, "facts")))
    everything = bidders if everything is None else scratch.keep(everything, "everything")
    found = scratch.keep(risk.detect(bidders, members, facts).withColumn("risk_id", risk.risk_id(run_id)), "risks")
    coverage = {r["role"]: {"matched": r["matched"], "unmatched": r["unmatched"]} for r in risk.coverage(members, facts).collect()}
    listed = found.select("risk_id", "comparison_type", "risk_type", "value", "root_a", "root_b", "company_a", "company_b", "trigger_projects")
    counted = found.select(F.explode("trigger_projects").alias("projectKey")).groupBy("projectKey").agg(F.count("*").alias("riskCount"))
    common = risk.common_projects(found, everything).join(risk.project_views(everything), "project_key")
    return {"schemaVersion": "2.0", "generatedAt": generated_at, "runId": run_id, "summary": summary(bidders, members, found), "coverage": coverage}, counted, listed, common


def write_risk_tables(run_id: str, bidders: DataFrame, members: DataFrame, facts: DataFrame, generated_at: str, folder: str, everything: DataFrame | None = None) -> dict:
    """The document in parts: projects, risks and common projects as JSON lines below the folder, written by the executors. Returns the head."""
    head, projects, risks, common = risk_tables(run_id, bidders, members, facts, generated_at, everything)
    projects.write.mode("overwrite").json(f"{folder}/projects")
    risks.write.mode("overwrite").json(f"{folder}/risks")
    common.write.mode("overwrite").json(f"{folder}/common_projects")
    return head


def write_context_tables(bidders: DataFrame, risks: DataFrame, folder: str) -> None:
    """The report's lists at any size, as JSON lines below the folder, written by the executors: losers, winners, groups, visible risks."""
    per = statistics.company_statistics(statistics.bid_records(bidders))
    shown = statistics.visible(risks).select("comparison_type", "report_type", "value", "root_a", "root_b")
    for name, df in (("losers", statistics.long_term_losers(per)), ("winners", statistics.high_win_rate(per)), ("groups", statistics.maximal_groups(statistics.bid_records(bidders))), ("risks", shown)):
        df.write.mode("overwrite").json(f"{folder}/{name}")


def risk_document(run_id: str, bidders: DataFrame, members: DataFrame, facts: DataFrame, generated_at: str, most: int = 100_000, everything: DataFrame | None = None) -> dict:
    """The document of a run in one piece: head, projects with risks, and risks with their projects and with all projects common to their roots.

    For runs of a report's size: with more than ``most`` risks or common projects it is an error, and write_risk_tables is the way.
    """
    head, projects, risks, common = risk_tables(run_id, bidders, members, facts, generated_at, everything)
    if head["summary"]["risks"] > most:
        raise ValueError(f"{head['summary']['risks']} risks are too many for one document; use write_risk_tables")
    rows = common.orderBy("root_a", "root_b", "project_key").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} common projects are too many for one document; use write_risk_tables")
    of_pair: dict = {}
    for r in rows:
        of_pair.setdefault((r.root_a, r.root_b), []).append({k: v for k, v in r.asDict().items() if k not in ("root_a", "root_b")})
    listed = risks.orderBy(F.element_at("trigger_projects", 1), "comparison_type", "risk_type", "value", "root_a")
    with_common = [r.asDict() | {"commonProjects": of_pair.get((min(r.root_a, r.root_b), max(r.root_a, r.root_b)), [])} for r in listed.collect()]
    return {**head, "projects": [r.asDict() for r in projects.orderBy("projectKey").collect()], "risks": with_common}
