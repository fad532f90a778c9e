"""States that service responses hold at any depth of their JSON."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.status import FAILED, RUNNING, SUCCESS, shows
from ..functions.text import clean
from .graph import Scratch

#: Keys, without underscores and in lower case, whose values tell a state.
STATE_KEYS = ("status", "state", "taskstatus", "crawlstatus", "querystatus", "code", "message", "msg")


def nested_values(responses: DataFrame, id_col: str = "id", json_col: str = "value") -> DataFrame:
    """(id, value): each value of a state-like key at any depth, lower-cased, a container as its JSON; and has_data for each true hasData.

    The documents are exploded level by level: a level is one narrow step over the containers of the level before, written to the shared folder, and the depth of the deepest document
    is the number of steps. Keys and values are parsed, so escapes and punctuation in texts don't matter. Text that is no JSON has no values. Only what tells a state and the containers
    that are still to be opened are written. Responses are dealt out first, as a small file of them is much work.
    """
    spark, scratch = responses.sparkSession, Scratch(responses.sparkSession)
    dealt = responses.select(F.col(id_col).alias("_id"), F.col(json_col).alias("_t")).repartition("_id", "_t")
    level = dealt.select("_id", F.try_parse_json("_t").alias("_v")).where("_v is not null")
    found = None
    for depth in itertools.count():
        parts = level.lateralJoin(spark.tvf.variant_explode(F.col("_v").outer())).select("_id", "key", "value")
        kind = F.schema_of_variant("value")
        holds = kind.startswith("OBJECT") | kind.startswith("ARRAY")
        name = F.lower(F.replace(clean(F.col("key")), F.lit("_"), F.lit("")))
        text = F.lower(clean(F.when(holds, F.to_json("value")).otherwise(F.try_variant_get("value", "$", "string"))))
        there = (F.col("_name") == "hasdata") & F.coalesce(F.try_variant_get("value", "$", "boolean"), F.lit(False)) & (kind == "BOOLEAN")
        told = F.when(F.col("_name").isin(*STATE_KEYS), text).when(there, "has_data")
        parts = parts.withColumn("_name", name).select("_id", told.alias("told"), F.when(holds, F.col("value")).alias("_v")).where("told <> '' or _v is not null")
        parts = scratch.keep(parts, f"level-{depth}")
        told = parts.where("told <> ''").select("_id", F.col("told").alias("value"))
        found = told if found is None else found.union(told)
        level = parts.where("_v is not null").select("_id", "_v")
        if level.isEmpty():
            return found.select(F.col("_id").alias(id_col), "value")


def response_states(responses: DataFrame, id_col: str = "id", json_col: str = "value", listed: bool = False) -> DataFrame:
    """(id, state), with ``listed`` also the values in order, joined by bars: existing if data is there, else failed, success or running, whichever is found first in this order in any of the values, else unknown.

    Flags are added up, so a response of any size is no list of values unless it is asked for. Responses of one id are one. The responses are opened once and grouped once.
    """
    values = nested_values(responses, id_col, json_col)
    values = values.union(responses.select(id_col, F.lit(None).cast("string")).distinct())
    lists = [F.array_join(F.array_sort(F.collect_list("value")), "|").alias("listed")] if listed else []
    flags = values.groupBy(id_col).agg(
        *lists, F.max(F.col("value") == "has_data").alias("_data"), *[F.max(shows(F.col("value"), words)).alias(n) for n, words in (("_failed", FAILED), ("_success", SUCCESS), ("_running", RUNNING))]
    )
    state = F.when(F.col("_data"), "existing").when(F.col("_failed"), "failed").when(F.col("_success"), "success").when(F.col("_running"), "running").otherwise("unknown")
    return flags.select(id_col, *(["listed"] if listed else []), state.alias("state"))
