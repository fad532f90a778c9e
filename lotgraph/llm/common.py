"""Shared pieces of the training-data operators: scratch tables, word rules, prefix sums, components."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.graph import Scratch, components, salted_join

__all__ = ["Scratch", "components", "salted_join"]

#: White space that separates words in the contracts: blank, tab, LF, VT, FF, CR.
BLANKS = r"[\x20\x09-\x0D]+"
#: Everything that is no ASCII letter or digit and below U+0080, after A-Z are lower-cased.
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def need_integers(docs: DataFrame, id_col: str) -> None:
    """An error unless the ids are whole numbers: operators that compare and pack ids as 64-bit numbers say so before any job runs."""
    kind = docs.schema[id_col].dataType.typeName()
    if kind not in ("byte", "short", "integer", "long", "void"):
        raise TypeError(f"column {id_col} has type {kind}; ids must be integers: number other ids, or take xxhash64 of them, first")


def slices(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; all-ASCII texts take the fast built-in."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def split_words(text: Column, separators: str) -> Column:
    """The non-empty pieces between separators; a null text has none."""
    return F.coalesce(F.array_remove(F.split(text, separators), ""), F.array().cast("array<string>"))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once: a lambda variable, which no optimizer rule replaces by its expression."""
    return F.element_at(F.transform(F.array(value), use), 1)


def small(df: DataFrame, rows: int) -> DataFrame:
    """df with a broadcast hint if a count proves that it has at most so many rows, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def shuffled(df: DataFrame) -> DataFrame:
    """df as a side of a sort-merge join at every size: nothing is held in memory whole, and AQE can split hot keys."""
    return df.hint("merge")


def ordered_prefix(df: DataFrame, scratch: Scratch, name: str, order: Sequence[str], values: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """For each row the sums of ``values``, and the number of rows, before it in ``order`` within ``group``.

    Rows are dealt by range over (group, order), so that neither a hot group nor the whole table meets in
    one task. Totals by slice are added up (a row for each slice and group in it), then each slice
    counts on from its offset. Ties in ``order`` are broken by a row number that is written once.
    New columns: ``<value>_before`` and ``index``.
    """
    keys = [*group, *order]
    placed = (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(slices(df.sparkSession), *keys, "_tie")
        .sortWithinPartitions(*keys, "_tie")
        .withColumn("_slice", F.spark_partition_id())
    )
    placed = scratch.keep(placed, name)
    columns = {**{v: F.col(v) for v in values}, "index": F.lit(1).cast("long")}
    totals = placed.groupBy(*group, "_slice").agg(*[F.sum(c).alias(f"_{v}_all") for v, c in columns.items()])
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(g).alias(f"_g_{g}") for g in group],
        F.col("_slice").alias("_of"),
        *[F.coalesce(F.sum(f"_{v}_all").over(earlier), F.lit(0)).alias(f"_{v}_off") for v in columns],
    )
    on = F.col("_slice") == F.col("_of")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    within = Window.partitionBy(*group, "_slice").orderBy(*order, "_tie").rowsBetween(Window.unboundedPreceding, -1)
    joined = placed.join(offsets, on)
    out = [
        (F.coalesce(F.sum(c).over(within), F.lit(0)) + F.col(f"_{v}_off")).alias("index" if v == "index" else f"{v}_before")
        for v, c in columns.items()
    ]
    return joined.select(*df.columns, *out)
