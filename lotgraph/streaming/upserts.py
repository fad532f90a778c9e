"""Results and names kept by streams: each micro-batch is written once under its number, so a batch that is run again changes nothing."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions.text import key_part
from ..operators.crawl import signature
from ..operators.graph import there


class ResultLog:
    """A table of results as the batches that changed it, in a shared folder: of a key the row of the greatest (batch, order) counts."""

    def __init__(self, spark: SparkSession, folder: str, schema: StructType, keys: Sequence[str], order: str):
        self.spark, self.folder, self.schema, self.keys, self.order = spark, folder, schema, list(keys), order

    def write(self, batch: DataFrame, number: int) -> None:
        """The batch's last row of each key, under its number; written again, it replaces itself."""
        rows = batch.groupBy(*self.keys).agg(F.max_by(F.struct(*batch.columns), self.order).alias("_row")).select("_row.*")
        rows.write.mode("overwrite").parquet(f"{self.folder}/log/batch={number}")

    def current(self, upto: int | None = None) -> DataFrame:
        """The table after batch ``upto``, by default after the last: one aggregate, in which a key's rows are combined before they travel."""
        if not there(self.spark, f"{self.folder}/log"):
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(StructType([*self.schema, StructField("batch", IntegerType())])).parquet(f"{self.folder}/log")
        rows = rows if upto is None else rows.where(F.col("batch") <= upto)
        columns = [c for c in rows.columns if c != "batch"]
        return rows.groupBy(*self.keys).agg(F.max_by(F.struct(*columns), F.struct("batch", self.order)).alias("_row")).select("_row.*")

    def digest(self, number: int, columns: Sequence[str]) -> str:
        return signature(self.current(number), list(columns)).first()[0]


def reconcile(log: ResultLog, columns: Sequence[str], analyze: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch body: the batch goes to the log; analysis runs if the digest of ``columns`` over the table differs from that after the batch before.

    The digest is recorded when the analysis has run. A batch that is run again after that does nothing; after a failure before it, it runs analysis again with the same number.
    """
    spark, seen = log.spark, f"{log.folder}/digests"

    def run(batch: DataFrame, number: int) -> None:
        log.write(batch, number)
        known = spark.read.schema("digest string, batch int").parquet(seen) if there(spark, seen) else spark.createDataFrame([], "digest string, batch int")
        now = log.digest(number, columns)
        last = known.where(F.col("batch") <= number).orderBy(F.desc("batch")).limit(1).collect()
        if last and last[0].batch == number and last[0].digest == now:
            return
        before = next((r.digest for r in known.where(F.col("batch") < number).orderBy(F.desc("batch")).limit(1).collect()), None)
        if now != before:
            analyze(log.current(number), number)
        spark.createDataFrame([(now,)], "digest string").coalesce(1).write.mode("overwrite").parquet(f"{seen}/batch={number}")

    return run


def reconcile_stream(stream: DataFrame, log: ResultLog, columns: Sequence[str], analyze: Callable[[DataFrame, int], None], checkpoint: str) -> DataStreamWriter:
    """Refreshed results as a stream into the log. Start it with a trigger of the caller's choice."""
    return stream.writeStream.foreachBatch(reconcile(log, columns, analyze)).option("checkpointLocation", checkpoint).outputMode("append")


def names_once(stream: DataFrame, time: str, delay: str = "1 hour", name: str = "company_name") -> DataFrame:
    """Each name (key) of a stream once within the watermark's delay: what the state holds is bounded by the names of that time, not by all names ever."""
    keyed = stream.withColumn("name_key", key_part(F.col(name))).where("name_key <> ''")
    return keyed.withWatermark(time, delay).dropDuplicatesWithinWatermark(["name_key"])


def store_names(spark: SparkSession, folder: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch body for names_once: names that an earlier batch has stored are left out, the others stored under the batch's number."""

    def run(batch: DataFrame, number: int) -> None:
        new = batch.select("name_key").distinct()
        if there(spark, folder):
            stored = spark.read.schema("name_key string, batch int").parquet(folder).where(F.col("batch") < number)
            new = new.join(stored.select("name_key"), "name_key", "left_anti")
        new.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return run


def stored_names(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("name_key string, batch int").parquet(folder).select("name_key")
