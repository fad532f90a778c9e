"""Bidding statistics: losers, win rates, recurring groups, report figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean

LOSER_BIDS, RATE_BIDS, RATE, GROUP_PROJECTS = 4, 3, 33.33, 4
#: Risk types that a report shows.
VISIBLE = ("shared_phone", "shared_email", "shared_shareholder", "shared_senior_staff")


def bid_records(bidders: DataFrame) -> DataFrame:
    """(project_key, company, won): one row for each company of a project; won in any of its rows."""
    return bidders.groupBy("project_key", F.col("company_name").alias("company")).agg(F.max(F.col("awarded").cast("int")).alias("won"))


def company_statistics(records: DataFrame) -> DataFrame:
    """Distinct projects, wins, losses and the win rate in percent."""
    per = records.groupBy("company").agg(F.count("*").alias("bids"), F.sum("won").alias("wins"))
    return per.select("company", "bids", "wins", (F.col("bids") - F.col("wins")).alias("losses"), F.round(F.col("wins") * 100 / F.col("bids"), 4).alias("win_rate"))


def long_term_losers(statistics: DataFrame) -> DataFrame:
    return statistics.where((F.col("bids") >= LOSER_BIDS) & (F.col("wins") == 0))


def high_win_rate(statistics: DataFrame) -> DataFrame:
    return statistics.where((F.col("bids") >= RATE_BIDS) & (F.col("wins") * 100 / F.col("bids") >= RATE))


def maximal_groups(records: DataFrame, least: int = GROUP_PROJECTS) -> DataFrame:
    """(companies, projects, n_projects): companies that share all projects of some company, largest groups only.

    Seeds are the distinct project sets of companies with ``least`` projects or more; a seed's group are the companies that were in all of its
    projects. As the seed's own company is among them, one group lies in another just if its seed holds the other's: so the largest groups
    are those of seeds that hold no smaller one, and only these are listed. A seed is filed under its rarest project alone; what
    has that project is compared with it as a set.
    """
    sets = records.groupBy("company").agg(F.array_sort(F.collect_set("project_key")).alias("projects")).where(F.size("projects") >= least)
    seeds = sets.select("projects").distinct()
    spread = lambda df: df.select("*", F.explode("projects").alias("project_key"))
    common = spread(sets).groupBy("project_key").agg(F.count("*").alias("held"))
    rarest = F.min_by("project_key", F.struct("held", "project_key")).alias("project_key")
    filed = spread(seeds).join(common, "project_key").groupBy("projects").agg(rarest).select(F.col("projects").alias("seed"), "project_key")
    holds = F.size(F.array_except("seed", "projects")) == 0
    larger = spread(seeds).join(filed, "project_key").where((F.size("seed") < F.size("projects")) & holds).select(F.col("projects").alias("seed")).distinct()
    smallest = filed.join(larger, "seed", "left_anti")
    members = spread(sets).join(smallest, "project_key").where(holds).select("seed", "company")
    groups = members.groupBy("seed").agg(F.array_sort(F.collect_set("company")).alias("companies")).where(F.size("companies") >= 2)
    return groups.select("companies", F.col("seed").alias("projects"), F.size("seed").alias("n_projects"))


def report_type(kind: Column, value: Column) -> Column:
    """The type a report shows: mobile or landline for phones, null for hidden types."""
    digits = F.regexp_replace(clean(value), r"\D", "")
    return F.when(~kind.isin(*VISIBLE), None).when(kind != "shared_phone", kind).when(F.regexp_like(digits, F.lit(r"^1\d{10}$")), "shared_mobile").otherwise("shared_landline")


def visible(risks: DataFrame) -> DataFrame:
    return risks.withColumn("report_type", report_type(F.col("risk_type"), F.col("value"))).where("report_type is not null")


def pair_statistics(risks: DataFrame, common: DataFrame) -> DataFrame:
    """Distinct pairs of roots over visible risks, and distinct projects that they share."""
    shown = visible(risks).select("root_a", "root_b").distinct()
    return shown.agg(F.count("*").alias("pairs")).join(common.join(shown, ["root_a", "root_b"], "left_semi").agg(F.count_distinct("project_key").alias("projects")))


def project_details(records: DataFrame, wanted: DataFrame) -> DataFrame:
    """(project_key, bidders, winners): sorted names for a set of projects."""
    rows = records.join(wanted.select("project_key").distinct(), "project_key", "left_semi")
    return rows.groupBy("project_key").agg(F.array_sort(F.collect_set("company")).alias("bidders"), F.array_sort(F.collect_set(F.when(F.col("won") == 1, F.col("company")))).alias("winners"))


def two_columns(names: DataFrame, name: str, by: list[str]) -> DataFrame:
    """A list laid out in two columns in order of the name."""
    from pyspark.sql import Window

    at = F.row_number().over(Window.partitionBy(*by).orderBy(name)) - 1
    return names.withColumn("_i", at).groupBy(*by, F.floor(F.col("_i") / 2).alias("line")).agg(
        F.max(F.when(F.col("_i") % 2 == 0, F.col(name))).alias("left_name"), F.coalesce(F.max(F.when(F.col("_i") % 2 == 1, F.col(name))), F.lit("")).alias("right_name")
    )


def people_of(relations: Column) -> Column:
    """Relations grouped by person: array<struct<person, kinds>>, sorted."""
    names = F.array_sort(F.array_distinct(F.transform(relations, lambda r: r["person_name"])))
    return F.transform(names, lambda p: F.struct(p.alias("person"), F.array_sort(F.array_distinct(F.transform(F.filter(relations, lambda r: r["person_name"] == p), lambda r: r["relation_type"]))).alias("kinds")))
