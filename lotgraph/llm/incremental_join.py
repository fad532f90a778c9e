"""Incremental maintenance of a join: row versions as batch intervals, met by key, their endpoints as signed changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffled

KINDS = ("inner", "left", "right", "full")


def states(n_batches: int, key: Column, start: Column, event: Column, part, delete_at: int = 0, update_at: int = 1) -> Column:
    """A row's states at batches 0 to n_batches, as an array of structs (present, key, part).

    ``event`` is an array with a number for each batch from 1 on: ``delete_at`` deletes a present row or inserts an absent one, ``update_at``
    updates a present row; others, and null, leave it. ``key`` and ``part`` are functions of the updates so far.
    """
    first = F.struct(start.alias("present"), F.lit(0).alias("updates"))

    def step(told: Column, t: Column) -> Column:
        last = F.element_at(told, -1)
        code = F.coalesce(F.element_at(event, t), F.lit(-1))
        now = F.struct((last["present"] != (code == delete_at)).alias("present"), (last["updates"] + ((code == update_at) & last["present"]).cast("int")).alias("updates"))
        return F.concat(told, F.array(now))

    told = F.aggregate(F.sequence(F.lit(1), F.lit(n_batches)), F.array(first), step)
    return F.transform(told, lambda x: F.struct(x["present"].alias("present"), key(x["updates"]).alias("key"), part(x["updates"]).alias("part")))


def versions(rows: DataFrame, of: Column) -> DataFrame:
    """Validity intervals (key, part, since, until) of each row's states: present with one key and part from batch since to before until.

    An array has a state for each batch; until is the array's length if the last state still holds. No shuffle.
    """
    same = lambda a, b: (a["present"] == b["present"]) & a["key"].eqNullSafe(b["key"]) & a["part"].eqNullSafe(b["part"])
    held = rows.select(of.alias("s"))
    begins = F.filter(F.sequence(F.lit(0), F.size("s") - 1), lambda t: F.when(t == 0, True).otherwise(~same(F.get("s", t), F.get("s", t - 1))))
    held = held.where(F.size("s") > 0).select("s", begins.alias("b"))
    spans = F.transform("b", lambda t, i: F.struct(F.get("s", t).alias("v"), t.alias("since"), F.coalesce(F.get("b", i + 1), F.size("s")).alias("until")))
    return held.select(F.explode(spans).alias("x")).where("x.v.present").select("x.v.key", "x.v.part", "x.since", "x.until")


def changes_to_versions(changes: DataFrame, id_col: str, batch_col: str, n_batches: int) -> DataFrame:
    """Validity intervals from a change log: rows (id, batch, present, key, part), at most one for each id and batch; the state holds until the id's next one.

    Batches beyond n_batches are still to come. A null id is an id like others.
    """
    following = F.lead(batch_col).over(Window.partitionBy(id_col).orderBy(batch_col))
    upto = F.least(F.coalesce(following, F.lit(n_batches + 1)), F.lit(n_batches + 1))
    made = changes.select(F.col("present"), F.col("key"), F.col("part"), F.col(batch_col).alias("since"), upto.alias("until"))
    return made.where(F.col("present") & (F.col("since") < F.col("until"))).drop("present")


def copies(sides: list[DataFrame], n_batches: int, by: list[str]) -> DataFrame:
    """The numbers of rows that hold at each batch, as array n, for each value of ``by``; columns left and right for two sides.

    Endpoints are added up before the shuffle (an interval is one more at its start and one less at its end), so a hot key is a row for each task at most.
    """
    names = ["left", "right"][: len(sides)] if len(sides) > 1 else ["n"]
    marked = None
    for i, side in enumerate(sides):
        side = side.select(*by, "since", "until", F.lit(i).alias("_side"))
        marked = side if marked is None else marked.union(side)
    ends = lambda i, t: F.sum(F.when(F.col("_side") == i, (F.col("since") == t).cast("long") - (F.col("until") == t).cast("long")).otherwise(F.lit(0).cast("long")))
    sums = marked.groupBy(*by).agg(*[ends(i, t).alias(f"_{i}_{t}") for i in range(len(sides)) for t in range(n_batches + 1)])
    running = [F.array(*[sum((F.col(f"_{i}_{u}") for u in range(1, t + 1)), F.col(f"_{i}_0")) for t in range(n_batches + 1)]).alias(n) for i, n in enumerate(names)]
    return sums.select(*by, *running)


def intervals(n: Column) -> Column:
    """The maximal runs of one number of copies, other than 0, as an array of structs (since, until, n)."""
    size = F.size(n)
    begins = F.filter(F.sequence(F.lit(0), size - 1), lambda t: F.when(t == 0, True).otherwise(F.get(n, t) != F.get(n, t - 1)))
    spans = F.transform(begins, lambda t, i: F.struct(t.alias("since"), F.coalesce(F.get(begins, i + 1), size).alias("until"), F.get(n, t).alias("n")))
    return F.filter(spans, lambda x: x["n"] != 0)


def gaps(n: Column) -> Column:
    """The maximal runs without any row, with one padding copy each."""
    return intervals(F.transform(n, lambda x: (x == 0).cast("long")))


def whole(n_batches: int) -> Column:
    return F.array(F.struct(F.lit(0).alias("since"), F.lit(n_batches + 1).alias("until"), F.lit(1).cast("long").alias("n")))


def moves(spans: str, n_batches: int) -> Column:
    """Whether any endpoint of the intervals lies at a batch from 1 on."""
    return F.exists(spans, lambda x: (x["since"] > 0) | (x["until"] <= n_batches))


def met(n_batches: int) -> Column:
    """Signed changes of one pair of parts: an array of structs (batch, weight, total), batches without change left out."""
    overlap = F.flatten(F.transform("ls", lambda a: F.transform("rs", lambda b: F.struct(
        F.greatest(a["since"], b["since"]).alias("since"), F.least(a["until"], b["until"]).alias("until"), (a["n"] * b["n"]).alias("n")))))
    real = F.filter(overlap, lambda x: x["since"] < x["until"])
    change = lambda t: F.aggregate(real, F.lit(0).cast("long"), lambda s, x: s + F.when(x["since"] == t, x["n"]).otherwise(0) - F.when(x["until"] == t, x["n"]).otherwise(0))
    total = lambda t: F.aggregate(real, F.lit(0).cast("long"), lambda s, x: s + F.when((x["since"] <= t) & (t < x["until"]), x["n"]).otherwise(0))
    told = F.transform(F.sequence(F.lit(1), F.lit(n_batches)), lambda t: F.struct(t.alias("batch"), change(t).alias("weight"), total(t).alias("total")))
    return F.filter(told, lambda x: x["weight"] != 0)


def maintain(left: DataFrame, right: DataFrame, n_batches: int, how: str = "left") -> DataFrame:
    """The changes of a join, batch by batch: (batch, key, left_part, right_part, left_padded, right_padded, weight, total).

    left and right are validity intervals (key, part, since, until), a row each time a row of the source holds (see versions). Batch 0 is the
    state before; batches 1 to n_batches change it. weight: copies of the joined row after the batch minus before; total: after. ``how``: inner, left, right, full.

    Equal parts of a key are one row with its copies by batch, made into intervals again; so each pair of parts meets once, and nothing is
    grouped after the joins: Spark can split a hot key there. Pairs of which neither part moves are never met. Padding meets the gaps that the other side leaves in
    its coverage of the key.
    Null keys meet nothing: their rows are padded. Null parts are parts. Repeated rows are copies. An empty side leaves only padding. Other columns are
    ignored, whatever their names. Very long parts are compared whole.
    """
    if how not in KINDS:
        raise ValueError(f"how must be one of {', '.join(KINDS)}")
    sides = {}
    for name, rows in (("l", left), ("r", right)):
        parts = copies([rows], n_batches, ["key", "part"]).select("key", "part", F.lit(False).alias("padded"), intervals(F.col("n")).alias("spans"))
        sides[name] = parts
    cover = copies([left, right], n_batches, ["key"])
    for name, own, other, wanted in (("r", "left", "right", ("left", "full")), ("l", "right", "left", ("right", "full"))):
        if how in wanted:
            kind = sides[name].schema["part"].dataType
            # the padding of side r: for keys that the left side has, where the right side has none
            there = F.exists(own, lambda x: x > 0)
            open_ = F.when(F.col("key").isNull(), whole(n_batches)).otherwise(gaps(F.col(other)))
            pads = cover.where(there).select("key", F.lit(None).cast(kind).alias("part"), F.lit(True).alias("padded"), open_.alias("spans"))
            sides[name] = sides[name].union(pads.where(F.size("spans") > 0))
    a = sides["l"].select("key", F.col("part").alias("left_part"), F.col("padded").alias("left_padded"), F.col("spans").alias("ls"), moves("spans", n_batches).alias("lm"))
    b = sides["r"].select(F.col("key").alias("_key"), F.col("part").alias("right_part"), F.col("padded").alias("right_padded"), F.col("spans").alias("rs"), moves("spans", n_batches).alias("rm"))
    # a null key meets the padding of null keys alone
    on = F.col("key").eqNullSafe(F.col("_key")) & (F.col("key").isNotNull() | F.col("left_padded") | F.col("right_padded"))
    pairs = a.where("lm").join(shuffled(b), on).union(a.where("not lm").join(shuffled(b.where("rm")), on))
    pairs = pairs.where("not (left_padded and right_padded)").select("key", "left_part", "right_part", "left_padded", "right_padded", F.explode(met(n_batches)).alias("x"))
    return pairs.select(F.col("x.batch").alias("batch"), "key", "left_part", "right_part", "left_padded", "right_padded", F.col("x.weight").alias("weight"), F.col("x.total").alias("total"))
