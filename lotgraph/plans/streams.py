"""Streaming twins of the batch queries, run to the end of the files that are there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.graph import Scratch
from ..streaming import polls, runs, upserts
from .views import table

#: Limits of the registered run queries, in seconds.
LIMITS = polls.Limits(hard=172_800, grace=21_600, stall=86_400, silence=64_800)
#: A landed file has about so many rows; a batch at most so many files, and larger ones beyond.
FILE_ROWS, MOST_FILES = 50_000, 400
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def shared_folder(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, as Scratch has it."""
    return f"{Scratch(spark).root}/stream"


def _events(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """The events as files that landed in a folder, read as a stream."""
    landed = table(spark, sf_dir, "events")
    landed.repartitionByRange("ts").write.parquet(f"{folder}/landed")
    return spark.readStream.schema(landed.schema).parquet(f"{folder}/landed")


def stream_name_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types with tens of their values as names: each once, by a state that is bounded by the watermark and the names stored before."""
    folder = shared_folder(spark)
    rows = _arrivals(spark, sf_dir, folder).select(F.col("ts").cast("timestamp").alias("ts"), F.concat_ws(" ", "event_type", F.floor(F.col("value") / 10)).alias("company_name"))
    names = upserts.names_once(rows, "ts")
    query = names.writeStream.foreachBatch(upserts.store_names(spark, f"{folder}/names")).option("checkpointLocation", f"{folder}/log").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return upserts.stored_names(spark, f"{folder}/names")


def stream_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last state of each user after all batches, and how many batches changed the table, so that analysis ran."""
    folder = shared_folder(spark)
    rows = _arrivals(spark, sf_dir, folder).select("user_id", "event_type", "value", F.struct("ts", "event_id").alias("ord"))
    log = upserts.ResultLog(spark, f"{folder}/results", rows.schema, ["user_id"], "ord")
    analyze = lambda table, number: table.agg(F.count("*").alias("users")).write.mode("overwrite").parquet(f"{folder}/analyses/batch={number}")
    query = upserts.reconcile_stream(rows, log, ["user_id", "event_type", "value"], analyze, f"{folder}/log").trigger(availableNow=True).start()
    query.awaitTermination()
    analyses = spark.read.schema("users long, batch int").parquet(f"{folder}/analyses").agg(F.count("*")).scalar()
    return log.current().select("user_id", "event_type", "value", analyses.alias("analyses"))


def stream_run_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last state of each run after all micro-batches; each batch is written once under its number."""
    folder = shared_folder(spark)
    rows = _events(spark, sf_dir, folder).select(F.col("user_id").alias("run_id"), "ts", "event_type", "event_id")

    def save(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{folder}/out/{number}")

    query = runs.run_states(rows).writeStream.foreachBatch(save).option("checkpointLocation", f"{folder}/log").outputMode("update").trigger(availableNow=True).start()
    query.awaitTermination()
    states = spark.read.schema("run_id long, events long, changes long, last_state string, stalled boolean, batch int").parquet(f"{folder}/out/*")
    last = Window.partitionBy("run_id").orderBy(F.desc("batch"))
    return states.withColumn("_r", F.row_number().over(last)).where("_r = 1").select("run_id", "events", "changes", "last_state", "stalled")


def run_polls(events: DataFrame) -> DataFrame:
    """The events as polls of runs: a run for each user and three days; errors are polls without an answer."""
    kind, value = F.col("event_type"), F.col("value")
    phase = F.when(kind == "purchase", "COMPLETED").when((kind == "signup") & (value > 60), "FAILED").when(kind == "click", "WAITING").otherwise("RUNNING")
    return events.select(
        (F.col("user_id") * 100 + F.floor(F.datediff("ts", F.lit("1970-01-01")) / 3) % 100).alias("run_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("poll_id"), (kind != "error").alias("ok"), phase.alias("phase"), (value > 60).alias("terminal"),
        (kind != "click").cast("int").alias("nodes"), (F.col("event_id") % 2 == 0).alias("begun"), F.concat(kind, F.floor(value / 20).cast("string")).alias("fingerprint"), (F.col("event_id") % 97 == 0).alias("cancel"),
    )


def without_zone(ended: DataFrame) -> DataFrame:
    return ended.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("last_progress", "ended_at")})


def run_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each run ended, by windows over the finished table."""
    return without_zone(polls.outcomes_batch(run_polls(table(spark, sf_dir, "events")), LIMITS))


def _arrivals(spark: SparkSession, sf_dir: str, folder: str, parts: int = 3) -> DataFrame:
    """The events as files that landed one part after the other in the order of time, read as a stream of so many batches.

    A part is as many files as its rows need, four at least; each has rows, so that a batch is a part.
    """
    landed = table(spark, sf_dir, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    found = landed.agg(F.percentile_approx(at, [k / parts for k in range(1, parts)]).alias("c"), F.count("*").alias("n")).first()
    part = F.lit(0)
    for c in found.c or []:
        part = part + (at > c).cast("int")
    files = min(max(4, found.n // parts // FILE_ROWS), MOST_FILES)
    for k in range(parts):
        landed.where(part == k).repartition(files, "event_id").write.mode("append").parquet(f"{folder}/landed")
    return spark.readStream.schema(landed.schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/landed")


def stream_run_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """run_outcomes by the stream's timers: each run that ended is one row of the file sink."""
    folder = shared_folder(spark)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        ended = polls.outcomes(run_polls(_arrivals(spark, sf_dir, folder)), LIMITS)
        query = ended.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/log").outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    return without_zone(spark.read.schema(polls.OUTCOME).parquet(f"{folder}/out"))
