"""Results of company lookups: folding, consolidation, audit, progress and retries."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.status import TERMINAL, counted_as, priority, truth
from ..functions.text import clean, key_part
from .graph import Scratch, components

#: Faults of the browser after which a run is repeated.
TRANSPORT_FAULTS = ("targetclosederror", "target page, context or browser has been closed", "err_network_changed", "浏览器会话启动失败")
NO_RESULT = "搜索无结果"


def distinct_names(names: DataFrame, name: str = "company_name", order: str = "ord") -> DataFrame:
    """Names in order of appearance, each once whatever its case or spaces; blank ones go."""
    keyed = names.withColumn("name_key", key_part(F.col(name))).where("name_key <> ''")
    return keyed.groupBy("name_key").agg(F.min_by(name, order).alias(name), F.min(order).alias(order))


def precheck(names: DataFrame, verified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(known, missing): names with and without details in the store."""
    return names.join(verified, "name", "left_semi"), names.join(verified, "name", "left_anti")


def fold(results: DataFrame, by: list[str]) -> DataFrame:
    """One row for each entity: the state that prevails (the first of equals), summed attempts, greatest row count, joined messages."""
    rank = F.struct(-priority(F.col("status")), "ord")
    messages = F.transform(F.array_sort(F.collect_list(F.when(F.coalesce("message", F.lit("")) != "", F.struct("ord", "message")))), lambda x: x["message"])
    return results.groupBy(*by).agg(
        F.min_by("status", rank).alias("status"), F.sum("attempts").alias("attempts"), F.max("database_rows").alias("database_rows"), F.max("has_data").alias("has_data"),
        F.array_join(F.array_distinct(messages), "; ").alias("message"), F.min("ord").alias("ord"), F.count("*").alias("n_results"),
    )


#: Fields of an entity's result that the prevailing row fills, else the last one that prevailed before it, else the first that has any.
FILLED = ("effective_fields", "raw_status", "expansion_status", "pending_reason", "submission_time", "last_progress_time")
#: Fields of the first row that has any.
FIRST = ("company_id", "run_id")


def fold_entities(results: DataFrame, entity: str = "entity", preferred: tuple[str, ...] = ("company_type", "company_name", "status"), filled: tuple[str, ...] = FILLED, first: tuple[str, ...] = FIRST) -> DataFrame:
    """One result for each entity, as merging its rows in order of ``ord`` gives: the row whose state prevails (the first of equals), with fields filled from the others.

    Merging goes by the states that prevailed one after the other: of each state's rows only the first can. So rows are combined by (entity, state) before they travel, and an entity
    is folded from one row for each state, however many rows it has. Its distinct messages and sources are lists, as they are shown; its rows stay as the audit (see audit_rows).
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = results.withColumn("_p", priority(F.col("status")))
    per = rows.groupBy(entity, "_p").agg(
        F.min("ord").alias("at"), F.min_by(F.struct(*preferred, *[text(c).alias(c) for c in filled]), "ord").alias("row"),
        *[F.min(F.when(text(c) != "", F.struct("ord", F.col(c).alias("v")))).alias(f"_f_{c}") for c in (*filled, *first)],
        F.sum("attempts").alias("attempts"), F.sum("poll_count").alias("poll_count"), F.max("database_rows").alias("database_rows"), F.max("has_data").alias("has_data"), F.count("*").alias("n_results"),
        F.collect_set("related_sources").alias("_sources"),
    )
    folded = per.groupBy(entity).agg(
        F.array_sort(F.collect_list(F.struct("at", F.col("_p").alias("p"), "row"))).alias("_s"), *[F.min(f"_f_{c}").alias(f"_f_{c}") for c in (*filled, *first)], F.min("at").alias("ord"),
        F.sum("attempts").alias("attempts"), F.sum("poll_count").alias("poll_count"), F.max("database_rows").alias("database_rows"), F.max("has_data").alias("has_data"), F.sum("n_results").alias("n_results"),
        F.array_sort(F.array_distinct(F.flatten(F.flatten(F.collect_list("_sources"))))).alias("related_sources"),
    )
    folded = folded.withColumn("_s", F.filter("_s", lambda x, i: F.forall(F.slice("_s", 1, i), lambda y: y["p"] < x["p"])))
    last = F.element_at("_s", -1)["row"]
    own = lambda c: F.try_element_at(F.filter(F.transform("_s", lambda x: x["row"][c]), lambda v: v != ""), F.lit(-1))
    said = rows.where(text("message") != "").groupBy(entity, "message").agg(F.min("ord").alias("o")).groupBy(entity).agg(F.array_sort(F.collect_list(F.struct("o", "message"))).alias("m"))
    out = folded.join(said, entity, "left").select(
        entity, *[last[c].alias(c) for c in preferred], *[F.coalesce(own(c), F.col(f"_f_{c}.v"), F.lit("")).alias(c) for c in filled], *[F.coalesce(F.col(f"_f_{c}.v"), F.lit("")).alias(c) for c in first],
        "attempts", "poll_count", "database_rows", "has_data", "related_sources", F.coalesce(F.array_join(F.transform("m", lambda x: x["message"]), "; "), F.lit("")).alias("message"), "ord", "n_results",
    )
    return out


def audit_rows(results: DataFrame, entity: str = "entity") -> DataFrame:
    """The rows behind each entity's result, equal ones once: entity, ord of the first, and the audited fields."""
    fields = [c for c in results.columns if c not in (entity, "ord", "related_sources")]
    return results.groupBy(entity, *fields).agg(F.min("ord").alias("ord"))


def consolidate(results: DataFrame) -> DataFrame:
    """results and ``entity``: by type, in order, the same id, or the same name while one side has no id; an id found later is taken over.

    An entity goes by the name of the state that prevails among its rows (the first of equals), so a row may join by a name that only a later
    row brought. The rule depends on order and must be followed row by row; only rows that ids and names connect can meet, so each
    connected component is followed on its own. Rows of equal ``ord`` follow by id and name; rows without both are entities of their own.
    """
    out, columns = results.schema.simpleString(), results.columns
    status = F.col("status") if "status" in results.columns else F.lit("")
    keyed = results.withColumns({
        "_type": F.coalesce(F.nullif("company_type", F.lit("")), F.lit("root")), "_id": key_part(F.col("company_id")), "_name": key_part(F.col("company_name")), "_priority": priority(status),
    })
    node = lambda kind, c: F.when(F.col(c) != "", F.xxhash64(F.lit(kind), "_type", c))
    keyed = keyed.withColumns({"_i": node("id", "_id"), "_n": node("name", "_name")})
    edges = keyed.where("_i is not null and _n is not null").select(F.col("_i").alias("a"), F.col("_n").alias("b"))
    scratch = Scratch(results.sparkSession)
    groups = scratch.keep(components(edges, scratch, "entities"), "entities")
    dealt = keyed.withColumn("_node", F.coalesce("_i", "_n", F.xxhash64("ord"))).join(groups, F.col("_node") == F.col("node"), "left")
    dealt = dealt.withColumn("_home", F.coalesce("component", "_node")).drop("node", "component", "_node", "_i", "_n")

    def follow(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["ord", "_id", "_name"], kind="stable")
        entity, ids, names, state = [], {}, {}, []
        for i, n, p in zip(frame["_id"], frame["_name"], frame["_priority"], strict=True):
            at, by_name = ids.get(i) if i else None, names.get(n) if n else None
            if at is None and by_name is not None and (not i or not state[by_name][0]):
                at = by_name
            if at is None:
                at = len(state)
                state.append((i, n, p))
            else:
                known, name, rank = state[at]
                state[at] = (known or i, *((n, p) if p > rank else (name, rank)))
            entity.append(f"{frame['_type'].iloc[0]}|{frame['_home'].iloc[0]}|{at}")
            if state[at][0]:
                ids[state[at][0]] = at
            if state[at][1]:
                names[state[at][1]] = at
        return frame.assign(entity=entity)[[*columns, "entity"]]

    return dealt.groupBy("_type", "_home").applyInPandas(follow, f"{out[len('struct<'):-1]},entity:string")


#: Names in the audit file and their columns.
AUDIT = {"sourcePdf": "source_pdf", "companyName": "company_name", "requestKeyword": "request_keyword", "status": "status", "message": "message", "runId": "run_id", "companyId": "company_id",
         "expansionStatus": "expansion_status", "pendingReason": "pending_reason", "submissionTime": "submission_time", "lastProgressTime": "last_progress_time"}


def typed_results(audits: DataFrame, json: str = "value") -> DataFrame:
    """Lookup results from the audit file's JSON objects: texts stripped, missing counts 0, the type root unless said."""
    get = lambda name: clean(F.get_json_object(json, f"$.{name}"))
    count = lambda name: F.coalesce(get(name).try_cast("long"), F.lit(0))
    sources = F.filter(F.coalesce(F.from_json(F.get_json_object(json, "$.relatedSources"), "array<string>"), F.array().cast("array<string>")), lambda x: F.coalesce(x, F.lit("")) != "")
    return audits.select(
        *[get(name).alias(column) for name, column in AUDIT.items()], count("attempts").alias("attempts"), count("pollCount").alias("poll_count"), count("databaseRows").alias("database_rows"),
        F.coalesce(F.nullif(get("companyType"), F.lit("")), F.lit("root")).alias("company_type"), F.coalesce(F.nullif(get("rawStatus"), F.lit("")), get("queryStatus")).alias("raw_status"),
        truth(F.get_json_object(json, "$.hasData")).alias("has_data"), sources.alias("related_sources"),
    )


def status_counts(results: DataFrame) -> DataFrame:
    """Counts by company type and in all (type null)."""
    state = results.withColumn("_s", counted_as(F.col("status")))
    return state.rollup("company_type").agg(F.count("*").alias("total"), *[F.count_if(F.col("_s") == s).alias(s) for s in ("success", "failed", "existing", "pending")])


def audit(results: DataFrame) -> DataFrame:
    """provisional while anything is pending; the runs and each run's last expansion state."""
    return results.groupBy("run_id").agg(
        F.max_by("expansion_status", "ord").alias("expansion_status"), F.count_if(counted_as(F.col("status")) == "pending").alias("pending"), F.count("*").alias("results")
    ).withColumn("finality", F.when(F.col("pending") > 0, "provisional").otherwise("final"))


def signature(results: DataFrame, columns: list[str]) -> DataFrame:
    """A digest of the rows whatever their order: the sums of two hashes of each row, so no list of rows is gathered."""
    row = F.struct(*columns)
    low, high = F.xxhash64(row).cast("decimal(38,0)"), F.xxhash64(F.lit(7), row).cast("decimal(38,0)")
    return results.agg(F.sha2(F.concat_ws(":", F.count("*"), F.coalesce(F.sum(low), F.lit(0)), F.coalesce(F.sum(high), F.lit(0))), 256).alias("signature"))


def retry_runs(results: DataFrame, first_try: bool = True) -> DataFrame:
    """(run_id, retry): after transport faults; or at first if a single lookup, or 80 % of three and more, found nothing."""
    message = F.lower(F.coalesce("message", F.lit("")))
    fault = F.lit(False)
    for word in TRANSPORT_FAULTS:
        fault = fault | F.contains(message, F.lit(word))
    failed = F.col("status") == "failed"
    none = failed & F.contains(F.coalesce("message", F.lit("")), F.lit(NO_RESULT))
    per = results.groupBy("run_id").agg(F.max(fault).alias("fault"), F.count_if(failed).alias("failed"), F.count_if(none).alias("none"))
    again = ((F.col("failed") == 1) & (F.col("none") == 1)) | ((F.col("failed") >= 3) & (F.col("none") >= 0.8 * F.col("failed")))
    return per.select("run_id", (F.col("fault") | (F.lit(first_try) & again)).alias("retry"))


def terminal_runs(entities: DataFrame, expected: DataFrame) -> DataFrame:
    """(run_id, terminal): all expected entities are there and in a terminal state."""
    per = entities.groupBy("run_id").agg(F.count("*").alias("n"), F.min(F.col("status").isin(*TERMINAL)).alias("done"))
    return expected.join(per, "run_id", "left").select("run_id", F.coalesce((F.col("n") >= F.col("expected")) & F.col("done"), F.lit(False)).alias("terminal"))


def finalize(entities: DataFrame, unresolved: str) -> DataFrame:
    """Entities that are in no terminal state take the final one."""
    return entities.withColumn("status", F.when(F.col("status").isin(*TERMINAL), F.col("status")).otherwise(unresolved))


def depth_one(queue: DataFrame, roots: DataFrame) -> DataFrame:
    """Related companies of a queue: depth 1, no root, the first row of an id or name."""
    rows = queue.where(F.col("depth") == 1).withColumn("name_key", key_part(F.col("company_name"))).where("name_key <> ''")
    rows = rows.join(roots.select(key_part(F.col("company_name")).alias("name_key")).distinct(), "name_key", "left_anti")
    rows = rows.withColumn("_k", F.coalesce(F.nullif("company_id", F.lit("")), "name_key"))
    first = Window.partitionBy("run_id", "_k").orderBy("ord")
    return rows.withColumn("_r", F.row_number().over(first)).where("_r = 1").drop("_r", "_k")


def match_roots(roots: DataFrame, queue: DataFrame) -> DataFrame:
    """Queue rows of the roots: by name, else by root order, else by position among the rows of depth 0."""
    rows = queue.where("depth = 0").withColumns({"name_key": key_part(F.col("company_name")), "position": F.row_number().over(Window.partitionBy("run_id").orderBy("ord"))})
    base = roots.withColumn("name_key", key_part(F.col("company_name")))
    pick = lambda key, out: rows.where(F.col(key).isNotNull()).groupBy("run_id", key).agg(F.min_by("status", "ord").alias(out))
    by_name = pick("name_key", "s1")
    by_order = pick("root_order", "s2")
    by_place = pick("position", "s3")
    out = base.join(by_name, ["run_id", "name_key"], "left").join(by_order, ["run_id", "root_order"], "left")
    out = out.join(by_place.withColumnRenamed("position", "root_order"), ["run_id", "root_order"], "left")
    return out.withColumn("status", F.coalesce("s1", "s2", "s3")).drop("s1", "s2", "s3", "name_key")


def combine_phases(runs: DataFrame) -> DataFrame:
    """Progress over runs: summed counters; the phase of highest precedence."""
    order = ("COMPLETED", "PENDING_RECONCILIATION", "WAITING", "RUNNING", "FAILED")
    rank = F.lit(0)
    for i, name in enumerate(order):
        rank = F.when(F.col("phase") == name, i).otherwise(rank)
    return runs.agg(F.element_at(F.array(*[F.lit(x) for x in order]), F.max(rank) + 1).alias("phase"), F.sum("completed").alias("completed"), F.sum("discovered").alias("discovered"))
