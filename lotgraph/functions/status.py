"""Crawl and run states: names that differ by source folded into a few classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_empty, clean

#: Words that show a class. They are searched in the text, failure first.
FAILED = ("failed", "fail", "error", "exception", "canceled", "cancelled")
SUCCESS = ("success", "succeeded", "finished", "finish", "completed", "done", "ok")
RUNNING = ("running", "pending", "processing", "started", "queued", "doing", "waiting")
PENDING = ("pending_submission", "pending_reconciliation", "stale_waiting")
TERMINAL = ("success", "failed", "existing")
#: Which state of one entity prevails.
PRIORITY = {"existing": 6, "success": 5, "failed": 4, "pending_reconciliation": 3, "stale_waiting": 3, "pending_submission": 3, "timeout": 3, "empty_result": 2, "running": 1, "waiting": 0}


def shows(text: Column, words) -> Column:
    return F.regexp_like(text, F.lit("|".join(words)))


def entity_state(raw: Column, has_data: Column | None = None, default: str = "waiting") -> Column:
    """existing, failed, success, running or ``default``; "not failed" counts as failed, as words are searched."""
    text = F.lower(clean(raw))
    state = F.when(shows(text, FAILED), "failed").when(shows(text, SUCCESS), "success").when(shows(text, RUNNING), "running").otherwise(default)
    return state if has_data is None else F.when(F.coalesce(has_data, F.lit(False)), "existing").otherwise(state)


def truth(value: Column) -> Column:
    """True for true, numbers other than 0, and the usual yes words."""
    text = F.lower(clean(value))
    number = text.try_cast("double")
    return text.isin("1", "true", "yes", "y", "是") | F.coalesce(number != 0, F.lit(False))


def priority(state: Column) -> Column:
    out = F.lit(-1)
    for name, p in PRIORITY.items():
        out = F.when(state == name, p).otherwise(out)
    return out


def counted_as(state: Column) -> Column:
    """success, failed, existing or pending; null for states that aren't counted. Timeouts are pending, empty results failed."""
    return F.when(state.isin(*PENDING, "timeout"), "pending").when(state == "empty_result", "failed").when(state.isin("success", "failed", "existing"), state)


def first_text(json: Column, *keys: str) -> Column:
    """The first non-blank of some keys of a JSON object."""
    return F.coalesce(*[F.nullif(clean(F.get_json_object(json, f"$.{k}")), F.lit("")) for k in keys], F.lit(""))


def error_message(json: Column) -> Column:
    return first_text(json, "errorMessage", "error", "errorSummary", "failureReason", "message", "msg")


def queue_state(json: Column) -> Column:
    """The raw state of a queue row: its own, else those of traversal and collection."""
    own = first_text(json, "queryStatus", "status")
    part = lambda k: F.when(first_text(json, k) != "", F.concat(F.lit(f"{k}="), first_text(json, k)))
    return F.when(own != "", own).otherwise(F.concat_ws("; ", part("traversalStatus"), part("collectionStatus")))


def queue_has_data(json: Column) -> Column:
    return truth(F.get_json_object(json, "$.hasData")) | F.upper(first_text(json, "source")).isin("DATABASE_REUSE", "CURRENT_RUN_REUSE")


def at_most(part: Column, *limits: Column) -> Column:
    """A count that is no number or negative is 0; none exceeds what is left."""
    return F.greatest(F.lit(0), F.least(F.coalesce(part.cast("long"), F.lit(0)), *limits))


def progress(total: Column, success: Column, failed: Column, existing: Column, pending: Column) -> Column:
    """Counters clamped in order so that the parts never exceed the total."""
    t = F.greatest(F.coalesce(total.cast("long"), F.lit(0)), F.lit(0))
    s = at_most(success, t)
    f = at_most(failed, t - s)
    e = at_most(existing, t - s - f)
    return F.struct(t.alias("total"), s.alias("success"), f.alias("failed"), e.alias("existing"), at_most(pending, t - s - f - e).alias("pending"))


def percent(completed: Column, total: Column) -> Column:
    t = F.greatest(F.coalesce(total.cast("long"), F.lit(0)), F.lit(0))
    return F.when(t > 0, F.floor(at_most(completed, t) * 100 / t)).otherwise(0).cast("int")
