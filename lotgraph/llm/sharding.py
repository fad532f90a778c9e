"""Sharding by global byte-size prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, ordered_prefix


def byte_shards(docs: DataFrame, n_shards: int, overhead: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Contiguous shards, in the order of the id, of nearly equal bytes.

    A row's size is its UTF-8 bytes plus ``overhead``. Rows are dealt by range of the id; the slices' totals
    give each row the bytes before it, and the row goes to the shard in whose equal share its
    middle byte lies. So each shard differs from its share by less than one row's size at either end.
    Null text: no bytes. Null ids come first. Repeated ids are ordered by size and checksum; equal rows follow each other. Very long texts
    are whole. An empty table gives no rows. Other columns, also named shard, slot or size, are ignored.
    Returns doc_id, size, text_crc32, shard, slot (gapless from 0 in each shard).
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    scratch = Scratch(docs.sparkSession)
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(overhead)).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
    )
    placed = scratch.keep(ordered_prefix(rows, scratch, "slices", ["doc_id", "size", "text_crc32"], ["size"]), "placed")
    total = placed.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("t")).first()["t"] or 1
    twice = F.expr(f"cast(((2 * cast(size_before as decimal(38,0)) + size) * {n_shards}) div {2 * total} as int)")
    cut = placed.withColumn("shard", F.least(twice, F.lit(n_shards - 1)))
    first = F.broadcast(cut.groupBy("shard").agg(F.min("index").alias("_first")))  # at most n_shards rows
    return cut.join(first, "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("index") - F.col("_first")).alias("slot"))
