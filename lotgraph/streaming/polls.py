"""How a polled run ends: progress, outages, stalls, limits and cancellation, as a stream with timers and as windows over a finished table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

SECOND = 1_000_000
#: Phases in which a run has failed, and what an end is called.
BROKEN = ("FAILED", "CANCELLED")
OUTCOME = "run_id long, status string, reason string, polls long, last_progress timestamp, ended_at timestamp"
STATE = "started long, last_poll long, progress long, outage long, fingerprint string, polls long, answered boolean, idle boolean, ended boolean, due long, timer long"
STATE_NAMES = [x.split()[0] for x in STATE.split(", ")]


@dataclass(frozen=True)
class Limits:
    """Seconds. hard: a run's whole time. grace: of unanswered polls in a row. stall: of answers without progress. silence: without any poll, when nobody
    asks any more. forget: an ended run's mark is kept so long, then the stream's state of it goes."""

    hard: int = 7200
    grace: int = 300
    stall: int = 1800
    silence: int = 3600
    forget: int = 30 * 86400
    fail_at_hard: bool = True


def pending(answered, idle):
    """The status of a run that ends undecided: not one answer, or waiting without nodes and without a start, or open."""
    return "stale_waiting" if answered and idle else "pending_reconciliation"


class Runs(StatefulProcessor):
    """The state of one run. Polls are handled in order of (at, poll_id) within a batch; a poll that comes after a run's deadline finds it ended at the deadline.

    Each call to the state is a message to the JVM, so a run's state is read and written once for its polls of a batch, and a timer that is armed too early
    stays: when it fires it is armed again for what is due then.
    """

    def __init__(self, limits: Limits):
        self.limits = limits

    def init(self, handle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", STATE)

    def deadline(self, s: dict) -> tuple[int, str]:
        hard, silent = s["started"] + self.limits.hard * SECOND, s["last_poll"] + self.limits.silence * SECOND
        return (hard, "timeout") if hard <= silent else (silent, "silent")

    def decided(self, s: dict, poll) -> tuple[str, str] | None:
        """Take in one poll; (status, reason) if the run ends with it."""
        s["polls"], s["last_poll"] = s["polls"] + 1, poll.at
        if poll.cancel:
            s["polls"] -= 1  # the loop ends before it asks
            return pending(s["answered"], s["idle"]), "cancel_requested"
        if not poll.ok:
            s["outage"] = poll.at if s["outage"] is None else s["outage"]
            if poll.at - s["outage"] >= self.limits.grace * SECOND:
                return pending(s["answered"], s["idle"]), "outage"
            return None
        s["outage"] = None
        if not s["answered"] or poll.fingerprint != s["fingerprint"]:
            s["progress"], s["fingerprint"] = poll.at, poll.fingerprint
        s["answered"], s["idle"] = True, poll.phase == "WAITING" and not poll.nodes and not poll.begun
        if poll.phase in BROKEN:
            return "failed", poll.phase.lower()
        if poll.phase == "COMPLETED" and poll.terminal:
            return "completed", "completed"
        return (pending(True, s["idle"]), "stalled") if poll.at - s["progress"] >= self.limits.stall * SECOND else None

    def end(self, key, s: dict, status: str, reason: str, at: int) -> Row:
        s["ended"], s["due"] = True, at + self.limits.forget * SECOND
        return Row(run_id=key[0], status=status, reason=reason, polls=s["polls"], last_progress=instant(s["progress"]), ended_at=instant(at))

    def at_deadline(self, key, s: dict) -> Row:
        at, reason = self.deadline(s)
        status = "failed" if reason == "timeout" and self.limits.fail_at_hard else pending(s["answered"], s["idle"])
        return self.end(key, s, status, reason, at)

    def recall(self) -> dict | None:
        kept = self.run.get()
        return None if kept is None else dict(zip(STATE_NAMES, kept, strict=True))

    def store(self, s: dict) -> None:
        """Write the state, with one timer a run, in milliseconds and never after what is due."""
        due = -(-s["due"] // 1000)
        if s["timer"] is None or s["timer"] > due:
            if s["timer"] is not None:
                self.handle.deleteTimer(s["timer"])
            self.handle.registerTimer(due)
            s["timer"] = due
        self.run.update(tuple(s[n] for n in STATE_NAMES))

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        s = self.recall()
        if s is not None and s["ended"]:
            return
        out = []
        for poll in sorted(rows, key=lambda r: (r.at, r.poll_id)):
            if s is None:
                s = dict.fromkeys(STATE_NAMES) | {"started": poll.at, "last_poll": poll.at, "progress": poll.at, "fingerprint": "", "polls": 0, "answered": False, "idle": False, "ended": False}
            if poll.at >= self.deadline(s)[0]:
                out.append(self.at_deadline(key, s))
            elif told := self.decided(s, poll):
                out.append(self.end(key, s, *told, poll.at))
            if s["ended"]:
                break
            s["due"] = self.deadline(s)[0]
        if s is not None:
            self.store(s)
        yield from out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        s = self.recall()
        if s is None or expiredTimerInfo.getExpiryTimeInMs() != s["timer"]:
            return
        s["timer"] = None
        reached = -(-s["due"] // 1000) <= timerValues.getCurrentWatermarkInMs()
        if reached and s["ended"]:
            self.run.clear()
            return
        out = [self.at_deadline(key, s)] if reached else []
        self.store(s)
        yield from out

    def close(self) -> None:
        pass


def instant(micros: int):
    import datetime

    return datetime.datetime.fromtimestamp(0, datetime.timezone.utc) + datetime.timedelta(microseconds=micros)


def outcomes(stream: DataFrame, limits: Limits = Limits(), delay: str = "0 seconds") -> DataFrame:
    """One row for each run that ended: OUTCOME. stream: run_id (long), ts, poll_id, ok, phase, terminal, nodes, begun, fingerprint, cancel.

    Polls may be ``delay`` late. Deadlines fire when the watermark passes them, so runs that nobody polls any more end too. Needs the RocksDB state store.
    """
    rows = stream.withWatermark("ts", delay).withColumn("at", F.unix_micros("ts"))
    return rows.groupBy("run_id").transformWithState(Runs(limits), OUTCOME, "append", "EventTime")


def outcomes_batch(polls: DataFrame, limits: Limits = Limits(), now: Column | None = None) -> DataFrame:
    """The same over a finished table, by windows; deadlines up to ``now`` (the last poll of any run) count."""
    by = Window.partitionBy("run_id")
    order = by.orderBy("at", "poll_id")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    seconds = lambda n: F.lit(n * SECOND)
    heard = F.col("ok") & ~F.col("cancel")
    rows = polls.withColumn("at", F.unix_micros("ts")).withColumns({"started": F.min("at").over(by), "n": F.row_number().over(order), "before": F.lag("at").over(order), "after": F.lead("at").over(order)})
    rows = rows.withColumns({"answers": F.coalesce(F.sum(heard.cast("int")).over(upto), F.lit(0)), "known": F.last(F.when(heard, F.col("fingerprint")), True).over(before), "had": F.coalesce(F.max(heard).over(before), F.lit(False))})
    moved = heard & (~F.col("had") | (F.col("known") != F.col("fingerprint")))
    rows = rows.withColumns({
        "outage": F.min(F.when(~F.col("ok") & ~F.col("cancel"), F.col("at"))).over(Window.partitionBy("run_id", "answers").orderBy("at", "poll_id").rowsBetween(Window.unboundedPreceding, 0)),
        "progress": F.coalesce(F.max(F.when(moved, F.col("at"))).over(upto), F.col("started")), "answered": F.max(heard).over(upto),
        "idle": F.last(F.when(heard, (F.col("phase") == "WAITING") & (F.col("nodes") == 0) & ~F.col("begun")), True).over(upto),
    })
    due = lambda since: F.least(F.col("started") + seconds(limits.hard), since + seconds(limits.silence))
    late = lambda since: F.when(F.col("started") + seconds(limits.hard) <= since + seconds(limits.silence), "timeout").otherwise("silent")
    open_ = F.when(F.col("answered") & F.col("idle"), "stale_waiting").otherwise("pending_reconciliation")
    told = lambda status, reason: F.struct(status.alias("status"), reason.alias("reason"))
    ends = (
        F.when(F.col("cancel"), told(open_, F.lit("cancel_requested")))
        .when(~F.col("ok") & (F.col("at") - F.col("outage") >= seconds(limits.grace)), told(open_, F.lit("outage")))
        .when(F.col("ok") & F.col("phase").isin(*BROKEN), told(F.lit("failed"), F.lower("phase")))
        .when(F.col("ok") & (F.col("phase") == "COMPLETED") & F.col("terminal"), told(F.lit("completed"), F.lit("completed")))
        .when(F.col("ok") & (F.col("at") - F.col("progress") >= seconds(limits.stall)), told(open_, F.lit("stalled")))
    )
    # after a poll that doesn't end the run, its deadline does if the next poll comes later or none does
    until = F.coalesce("after", now if now is not None else polls.agg(F.max(F.unix_micros("ts"))).scalar())
    reason = late(F.col("at"))
    status = F.when((reason == "timeout") & F.lit(limits.fail_at_hard), F.lit("failed")).otherwise(open_)
    ended = F.when(ends.isNotNull(), F.struct(ends["status"].alias("status"), ends["reason"].alias("reason"), F.col("at").alias("ended"))).when(due(F.col("at")) <= until, F.struct(status.alias("status"), reason.alias("reason"), due(F.col("at")).alias("ended")))
    polled = F.col("n") - (F.col("cancel") & (F.col("reason") == "cancel_requested")).cast("int")
    first = rows.withColumn("e", ended).where("e is not null").groupBy("run_id").agg(F.min_by(F.struct("e", "n", "cancel", "progress"), F.struct("at", "poll_id")).alias("x")).select("run_id", "x.e.*", "x.n", "x.cancel", "x.progress")
    return first.select("run_id", "status", "reason", polled.cast("long").alias("polls"), F.timestamp_micros("progress").alias("last_progress"), F.timestamp_micros("ended").alias("ended_at"))
