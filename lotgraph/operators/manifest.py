"""What a run leaves besides its records: name reviews, manifest, finality, cached queue pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.status import counted_as, first_text
from ..functions.text import clean

#: Keys under which a queue row names where it was found.
SOURCE_KEYS = ("rootCompanyName", "rootCompany", "sourceRootCompany", "sourceCompanyName", "relatedFrom", "parentCompanyName", "parentCompany", "discoveredByCompanyName")
SOURCE_LISTS = ("rootCompanyNames", "sourceRootCompanies", "relatedSources")
RESULT_TABLE = """business_key string, run_id string, project_name string, project_code string, lot_code string, lot_name string, company_name string, award_status string, rank string,
category string, source_path string, source_pages string, extraction_method string, evidence string, review_status string, generated_at string, confidence decimal(8,4)"""


def name_reviews(results: DataFrame) -> DataFrame:
    """Lookups that were not sent because the name is no company's."""
    return results.where("status = 'pending_submission' and pending_reason = 'invalid_company_name'")


def manifest(results: DataFrame) -> DataFrame:
    """Counts by state, and by type and state, in one pass."""
    return results.groupingSets([["status"], ["company_type", "status"]], "company_type", "status").agg(F.count("*").alias("n"), F.grouping("company_type").alias("all_types"))


def with_finality(risks: DataFrame, results: DataFrame) -> DataFrame:
    """Risks marked provisional while lookups are open."""
    pending = results.agg(F.count_if(counted_as(F.col("status")) == "pending").alias("pending"))
    return risks.join(F.broadcast(pending)).withColumn("finality", F.when(F.col("pending") > 0, "provisional").otherwise("final"))  # one row


def related_sources(json, roots):
    """Sorted distinct names under the source keys of a queue row; the roots if it has none."""
    single = F.array(*[first_text(json, k) for k in SOURCE_KEYS])
    listed = F.flatten(F.array(*[F.coalesce(F.from_json(F.get_json_object(json, f"$.{k}"), "array<string>"), F.array().cast("array<string>")) for k in SOURCE_LISTS]))
    found = F.array_sort(F.array_distinct(F.filter(F.transform(F.concat(single, listed), clean), lambda x: x != "")))
    return F.when(F.size(found) > 0, found).otherwise(F.array_sort(roots))


def progress_fingerprint(run: DataFrame, queue: DataFrame, counters: list[str]) -> DataFrame:
    """(run_id, fingerprint) of a run's counters and its queue rows, whatever their order."""
    rows = queue.groupBy("run_id").agg(F.count("*").alias("_n"), F.sum(F.xxhash64("company_id", "company_name", "status").cast("decimal(38,0)")).alias("_s"))
    return run.join(rows, "run_id", "left").select("run_id", F.sha2(F.to_json(F.struct(*counters, "_n", "_s")), 256).alias("fingerprint"))


def queue_pages(total: int, size: int = 100) -> list[tuple[int, int]]:
    """(page, rows) of a queue of ``total`` rows."""
    return [(p, min(size, total - size * (p - 1))) for p in range(1, -(-total // size) + 1)]


def ensure_table(spark: SparkSession, name: str) -> list[str]:
    """Create the result table, or add the columns that it lacks; returns the columns added."""
    from pyspark.sql.types import _parse_datatype_string

    wanted = _parse_datatype_string(RESULT_TABLE)
    if not spark.catalog.tableExists(name):
        spark.createDataFrame([], wanted).write.saveAsTable(name)
        return wanted.names
    have = {c.name for c in spark.catalog.listColumns(name)}
    missing = [f for f in wanted if f.name not in have]
    if missing:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'{f.name} {f.dataType.simpleString()}' for f in missing)})")
    return [f.name for f in missing]


def required_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if not f.nullable]
