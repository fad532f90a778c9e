"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, Scratch, ordered_prefix, split_words


def water_level(sources: DataFrame, total: float) -> float | None:
    """The level at which the sum of least(cap, level * weight) is ``total``; None: all sources are at their caps.

    Each round freezes the sources whose share exceeds their cap and deals the rest to the others by weight.
    A round brings one row to the driver.
    """
    level = -1.0
    while True:
        full = F.col("cap") <= F.lit(level) * F.col("weight")
        frozen, weight = sources.agg(
            F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))
        ).first()
        if not weight:
            return None
        new = (total - frozen) / weight
        if new <= level:
            return level
        level = new


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, max_epochs: float = 2.0, seed: int = 9, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Seeded repetitions of whole documents so that each source's words come near its target.

    Sizes are words between blanks. Sources, ordered by code point with null last, weigh ``weights`` over and
    over and share ``share`` times all words; a target stops at ``max_epochs`` times its source's size and the
    excess goes to the others by weight. A document is taken floor(target / size) times; documents in a
    seeded order are taken once more until the rest of the target is met, up to half a document.
    Null or blank text: size 0, taken 0. Very long texts are whole. Repeated rows are documents of their own; ties in the seeded order
    go by id and size. Other columns, whatever their names, are ignored. An empty table gives no rows.
    Returns doc_id, source, size, source_size, target, repeats, taken.
    """
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.size(split_words(F.col(text_col), BLANKS)).cast("long").alias("size"))
    rows = rows.withColumn("draw", F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    placed = scratch.keep(ordered_prefix(rows, scratch, "slices", ["draw", "doc_id", "size"], ["size"], ["source"]), "placed")
    sums = placed.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("last", F.col("source").isNull())
    weigh = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("index") % len(weights) + 1).cast("int"))
    ranked = ordered_prefix(sums, scratch, "sources", ["last", "source"], []).select(
        "source", "source_size", weigh.alias("weight"), (F.col("source_size") * max_epochs).cast("double").alias("cap")
    )
    ranked = scratch.keep(ranked, "weights")
    total = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    level = water_level(ranked, total)
    target = F.col("cap") if level is None else F.least(F.col("cap"), F.lit(level) * F.col("weight"))
    goals = ranked.select(F.col("source").alias("_source"), "source_size", target.alias("target"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    once_more = F.col("size_before") + F.col("size") / 2 < F.col("target") - F.col("whole") * F.col("source_size")
    return (
        placed.join(goals, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("whole", whole.cast("long"))
        .withColumn("repeats", F.col("whole") + once_more.cast("long"))
        .select("doc_id", "source", "size", "source_size", "target", "repeats", (F.col("repeats") * F.col("size")).alias("taken"))
    )
