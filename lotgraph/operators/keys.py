"""Stable keys of bid records, merging of records, and idempotent result tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean, fingerprint, nullable

#: Sources by rank, others 0.
PRIORITY = {"award_notice": 6, "bid_announcement": 6, "bid_candidates": 5, "bid_evaluation_report": 5, "archive_info": 4, "tender_cover": 3, "bid_list": 2, "unknown": 1}
CATEGORIES = ("tender_cover", "bid_evaluation_report", "bid_candidates", "award_notice", "bid_announcement", "bid_list", "archive_info")
DECIDED = ("是", "否")
PASSED, REVIEW, CONFLICT = "通过", "待复核", "冲突待复核"


def cleaned(name: str) -> Column:
    return clean(F.col(name))


def either(first: str, second: str, of: Callable[[str], Column] = cleaned) -> tuple[Column, Column]:
    """(value, name) of the first of two columns that isn't blank."""
    a, b = of(first), of(second)
    return F.when(a != "", a).otherwise(b), F.when(a != "", first).otherwise(second)


def business_key() -> Column:
    """The key of the result table: project, lot and company if all are known, else where the record was read."""
    (project, _), (lot, _), company = either("project_code", "project_name"), either("lot_code", "lot_name"), clean(F.col("company_name"))
    return F.when((project != "") & (lot != "") & (company != ""), fingerprint("business", project, lot, company)).otherwise(
        fingerprint("review", F.col("source_path"), F.col("category"), F.col("company_name"), F.col("evidence"))
    )


def with_project_key(records: DataFrame, name: str) -> DataFrame:
    """The records with project_key().key in a column ``name``; texts are cleaned once, in a step before it."""
    used = ("project_code", "project_name", "lot_code", "lot_name", "record_id")
    rows = records.withColumns({f"_cleaned_{c}": cleaned(c) for c in used})
    return rows.withColumn(name, project_key(lambda c: F.col(f"_cleaned_{c}"))["key"]).drop(*[f"_cleaned_{c}" for c in used])


def project_key(of: Callable[[str], Column] = cleaned) -> Column:
    """struct<key, source>: project and lot with the kind of each, the project alone, or the record itself. ``of`` gives a column without blanks around it."""
    (project, p), (lot, q), record = either("project_code", "project_name", of), either("lot_code", "lot_name", of), of("record_id")
    both, alone = F.concat(p, F.lit("_"), q), F.concat(p, F.lit("_fallback"))
    own = F.when(record != "", fingerprint("record_id", record)).otherwise(
        fingerprint("unresolved_record", *[F.col(c) for c in ("source_path", "category", "company_name", "lot_code", "lot_name")])
    )
    return (
        F.when((project != "") & (lot != ""), F.struct(F.concat(F.lit("project_lot:"), fingerprint(both, project, lot)).alias("key"), both.alias("source")))
        .when(project != "", F.struct(F.concat(F.lit("project:"), fingerprint(alone, project)).alias("key"), alone.alias("source")))
        .otherwise(F.struct(F.concat(F.lit("unresolved:"), own).alias("key"), F.lit("unresolved_record").alias("source")))
    )


def source_priority(category: Column) -> Column:
    out = F.lit(0)
    for name, p in PRIORITY.items():
        out = F.when(category == name, p).otherwise(out)
    return out


def ordered_distinct(items: Column, separator: str = "；") -> Column:
    """Non-blank strings of array<struct<..., v>>, in the array's order, each once, joined."""
    values = F.filter(F.transform(F.array_sort(items), lambda x: clean(x["v"])), lambda x: x != "")
    return F.array_join(F.array_distinct(values), separator)


def merge_records(records: DataFrame) -> DataFrame:
    """One record for each project, lot and company. ``ord`` is the order of reading.

    A record without a code goes to the one coded record set that has its names; a coded one without a lot code to the one with its lot
    name; where several fit it stays. Only what such records ask for is looked up, and only they are joined with what is found. Then each group keeps the
    best source's texts, the first decided award with its rank, and notes conflicts. Records without company or project stay alone. first_source is the best source's path.
    Joins and groups have a hash of their key as its first part, so that sorting compares numbers; the key itself still decides.
    """
    c = lambda name: clean(F.col(name))
    rows = records.withColumns({"_code": c("project_code"), "_name": c("project_name"), "_lotc": c("lot_code"), "_lotn": c("lot_name"), "_company": c("company_name")})
    coded = F.col("_code") != ""
    usable = (F.col("_company") != "") & (coded | (F.col("_name") != ""))
    # What few records fulfil comes first, so that a scan for them cleans little else.
    asks = {
        "name": (F.col("_code") == "") & (F.col("_name") != "") & (F.col("_company") != ""),
        "code": (F.col("_lotc") == "") & (F.col("_lotn") != "") & coded & (F.col("_company") != ""),
    }
    key = F.struct(
        F.when(coded, "code").otherwise("name").alias("kind"), F.when(coded, F.upper("_code")).otherwise(F.col("_name")).alias("project"),
        F.when(F.col("_lotc") != "", F.col("_lotc")).otherwise(F.col("_lotn")).alias("lot"), F.col("_company").alias("company"),
    )
    rows = rows.withColumns({"_usable": usable, "_key": key})
    at = ["_h", "_kind", "_p", "_l", "_c"]
    placed = lambda df, kind, p, l: df.withColumns({"_kind": F.lit(kind), "_p": p, "_l": l, "_c": F.col("_company")}).withColumn("_h", F.xxhash64("_p", "_l", "_c"))  # noqa: E731, E741
    full = rows.where(F.col("_usable") & coded & (F.col("_name") != ""))
    fit = {"name": (full, F.col("_name")), "code": (full.where((F.col("_lotc") != "") & (F.col("_lotn") != "")), F.upper("_code"))}
    found = [rows.where(~(asks["name"] | asks["code"])).withColumn("_to", F.col("_key"))]
    for kind, (of, project) in fit.items():
        asking = rows.where(asks[kind])
        if asking.isEmpty():
            continue
        asking = placed(asking, kind, F.col("_key.project"), F.col("_key.lot"))
        asked = placed(of, kind, project, F.col("_lotn")).select(*at, "_key").join(asking.select(*at).distinct(), at, "left_semi")
        lookup = asked.groupBy(*at).agg(F.min("_key").alias("_lo"), F.max("_key").alias("_hi")).where("_lo = _hi").select(*at, F.col("_lo").alias("_to"))
        found.append(asking.join(lookup, at, "left").drop(*at))
    rows = functools.reduce(lambda a, b: a.unionByName(b), found)
    alone = F.struct(F.lit("review").alias("kind"), c("source_path").alias("project"), F.col("ord").cast("string").alias("lot"), F.col("_company").alias("company"))
    rows = rows.withColumn("_group", F.when(~F.col("_usable"), alone).otherwise(F.coalesce("_to", "_key")))
    rank = F.struct((-source_priority(F.col("category"))).alias("p"), F.col("ord").alias("o"))
    rows = rows.withColumns({"_rank": rank, "_gh": F.xxhash64("_group")})
    decided = F.col("award_status").isin(*DECIDED)
    best = lambda name, cleaned: F.min_by(F.col(name), F.when(cleaned != "", F.col("_rank")))
    texts = {"project_name": "_name", "project_code": "_code", "lot_code": "_lotc", "lot_name": "_lotn", "company_name": "_company"}
    listed = lambda value: ordered_distinct(F.collect_set(F.struct(F.col("_rank"), value.alias("v"))))
    chosen = F.struct((~decided).cast("int").alias("d"), F.col("_rank"))
    page = F.when(c("source_pages") != "", F.concat(F.col("source_path"), F.lit("#第"), F.col("source_pages"), F.lit("页"))).otherwise("")
    award = F.when(decided, F.col("award_status"))
    merged = rows.groupBy("_gh", "_group").agg(
        *[F.coalesce(best(x, F.col(y)), F.lit("")).alias(x) for x, y in texts.items()],
        F.min_by("award_status", chosen).alias("award_status"),
        F.min_by("rank", chosen).alias("rank"),
        listed(F.col("category")).alias("category"), listed(F.col("source_path")).alias("source_path"), listed(page).alias("source_pages"),
        listed(F.col("extraction_method")).alias("extraction_method"), listed(F.col("evidence")).alias("evidence"),
        F.coalesce(F.min_by(c("source_path"), F.when(c("source_path") != "", F.col("_rank"))), F.lit("")).alias("first_source"),
        F.max("confidence").alias("confidence"), F.max("generated_at").alias("generated_at"), F.min("ord").alias("ord"),
        F.coalesce(F.min(award) < F.max(award), F.lit(False)).alias("_conflict"),
        F.max((F.col("review_status") != PASSED).cast("int")).alias("_review"), F.count("*").alias("n_records"),
    )
    return merged.withColumns({
        "evidence": F.when(F.col("_conflict"), F.concat(F.lit("存在中标状态冲突；"), F.col("evidence"))).otherwise(F.col("evidence")),
        "review_status": F.when(F.col("_conflict"), CONFLICT).when(F.col("_review") == 1, REVIEW).otherwise(PASSED),
    }).drop("_gh", "_group", "_conflict", "_review")


def latest(rows: DataFrame, key: str = "business_key", order: str = "ord") -> DataFrame:
    """Of each key the last row."""
    window = Window.partitionBy(key).orderBy(F.desc(order))
    return rows.withColumn("_last", F.row_number().over(window)).where("_last = 1").drop("_last")


def upsert(table: DataFrame, batch: DataFrame, key: str = "business_key", order: str = "ord") -> DataFrame:
    """The table after the batch: rows of a known key are replaced, others added; the last of a key in the batch counts.

    Plain parquet has no MERGE, so this is the set form: old rows without a new one, and the new ones.
    """
    new = latest(batch, key, order).drop(order)
    return table.join(new.select(key), key, "left_anti").select(*new.columns).unionByName(new)


def for_database(records: DataFrame, run_id: str) -> DataFrame:
    """The columns of the result table: key, run, texts or null, confidence with four decimals."""
    texts = ("project_name", "project_code", "lot_code", "lot_name", "company_name", "award_status", "rank", "category", "source_path", "source_pages", "extraction_method", "evidence", "review_status", "generated_at")
    return records.select(business_key().alias("business_key"), F.lit(run_id).alias("run_id"), *[nullable(F.col(x)).alias(x) for x in texts], F.col("confidence").cast("decimal(8,4)").alias("confidence"), "ord")


def review_queue(records: DataFrame) -> DataFrame:
    return records.where(F.col("review_status") != PASSED)


def split_by_category(records: DataFrame) -> dict[str, DataFrame]:
    """All seven categories, empty ones too."""
    return {name: records.where(F.col("category") == name) for name in CATEGORIES}
