"""Tables that cut a plan in the folder all executors share, and connected components."""

from __future__ import annotations

import atexit
import itertools
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings while a table is written: a job's shuffle files are deleted when it has ended; Python gets small batches.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}
#: Rows of one key are dealt to so many join keys.
SALTS = 8


class Scratch:
    """Tables written under ``spark.checkpoint.dir``, the folder that driver and executors share.

    A table cuts the lineage and survives the loss of executors; the shuffle files of the job that wrote it go at once. Only on
    one machine (tests) a temporary folder stands in for an unset folder; elsewhere that is an error.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
            base = "file://" + tempfile.mkdtemp(prefix="lotgraph-")
            atexit.register(shutil.rmtree, base.removeprefix("file://"), ignore_errors=True)
            spark.conf.set("spark.checkpoint.dir", base)
        self.root = f"{base.rstrip('/')}/lotgraph-{uuid.uuid4().hex}"
        self.paths: dict[str, str] = {}

    def keep(self, df: DataFrame, name: str, **settings: str) -> DataFrame:
        """Write df and read it again. ``settings``: Spark settings (with _ for .) that hold while this table is written, besides WRITING."""
        path = self.paths[name] = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        held = WRITING | {k.replace("_", "."): v for k, v in settings.items()}
        before = {k: self.spark.conf.get(k) for k in held}
        try:
            for k, v in held.items():
                self.spark.conf.set(k, v)
            df.write.option("compression", "zstd").parquet(path)
        finally:
            for k, v in before.items():
                self.spark.conf.set(k, v)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more. The tables that a result reads stay as long as the shared folder."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(conf).delete(path, True)

    def drop_all(self) -> None:
        self.drop(*self.paths)


def there(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, in whichever store it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def salted_join(rows: DataFrame, of: DataFrame, key: str, salt: str) -> DataFrame:
    """rows joined with one row for each key: copies of that row meet the key's rows in SALTS groups, dealt by ``salt``.

    Both sides are shuffled for the join itself, so AQE can split what is hot still.
    """
    copies = of.withColumn("_z", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return rows.withColumn("_z", F.pmod(F.xxhash64(salt), F.lit(SALTS))).join(copies, [key, "_z"]).drop("_z")


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Connected components of undirected edges (a, b): a row (node, component), component the least node.

    Alternating large-star and small-star steps until each node points at a root: minima by node are pre-aggregated, a hub's edges are
    dealt out in the joins. Each round is written to the shared folder.
    """
    edges = scratch.keep(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-0")
    for k in itertools.count(1):
        ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("b", F.lit(0), F.lit(1)))
        moving = ends.groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)")
        if moving.isEmpty():
            break
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = salted_join(both, least, "a", "b").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        root = large.groupBy("a").agg(F.min("b").alias("m"))
        star = salted_join(large, root, "a", "b")
        star = star.select(F.col("b").alias("a"), F.col("m").alias("b")).union(root.select("a", F.col("m").alias("b")))
        edges = scratch.keep(star.where("a <> b").distinct(), f"{name}-{k}")
        scratch.drop(f"{name}-{k - 1}")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
