"""Changes of joins by batch against joins made anew, of all kinds."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from lotgraph.llm import incremental_join as J

N = 4


def alive(rows, t):
    return [(k, p) for k, p, since, until in rows if since <= t < until]


def joined(left, right, how):
    out = Counter()
    met = [(lk, lp, rp) for lk, lp in left for rk, rp in right if lk is not None and lk == rk]
    out.update((k, a, b, False, False) for k, a, b in met)
    lefts, rights = {k for k, _ in left if k is not None}, {k for k, _ in right if k is not None}
    if how in ("left", "full"):
        out.update((k, a, None, False, True) for k, a in left if k not in rights)
    if how in ("right", "full"):
        out.update((k, None, b, True, False) for k, b in right if k not in lefts)
    return out


def plain(left, right, how):
    rows, before = [], joined(alive(left, 0), alive(right, 0), how)
    for t in range(1, N + 1):
        after = joined(alive(left, t), alive(right, t), how)
        rows += [(t, *r, after[r] - before[r], after[r]) for r in {*before, *after} if after[r] != before[r]]
        before = after
    return sorted(map(repr, rows))


LEFT = [
    (1, "a", 0, 5), (1, "a", 2, 3), (1, "b", 0, 2), (1, None, 1, 5), (2, "a", 0, 5), (2, "a", 0, 5), (3, "x", 3, 5), (3, "x", 0, 1), (None, "n", 1, 4), (None, "n", 0, 5), (4, "-", 0, 5), (6, "long" * 5000, 2, 4),
]
RIGHT = [(1, "p", 1, 3), (1, "p", 3, 5), (1, "q", 0, 1), (2, "p", 2, 4), (2, "p", 2, 3), (5, "z", 0, 3), (5, "z", 4, 5), (None, "n", 0, 2), (3, None, 0, 5), (4, "s", 0, 5), (6, "t", 0, 5)]
SCHEMA = "key long, part string, since int, until int"


@pytest.mark.parametrize("how", J.KINDS)
def test_changes_equal_joins_made_anew(spark, how):
    got = J.maintain(spark.createDataFrame(LEFT, SCHEMA), spark.createDataFrame(RIGHT, SCHEMA), N, how).collect()
    assert sorted(repr(tuple(r)) for r in got) == plain(LEFT, RIGHT, how)


def test_many_rows_of_one_key(spark):
    import random

    rng = random.Random(3)
    draw = lambda n, parts: [(rng.choice([7, 7, 7, rng.randrange(20)]), rng.choice(parts), a, rng.randrange(a + 1, N + 2)) for a in (rng.randrange(N) for _ in range(n))]
    left, right = draw(600, "abcd"), draw(500, "xyz")
    got = J.maintain(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), N).collect()
    assert sorted(repr(tuple(r)) for r in got) == plain(left, right, "left")


def test_empty_sides_and_unknown_kinds(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(1, "a", 2, 5)], SCHEMA).withColumn("weight", F.lit(9)).withColumn("spans", F.lit(9))
    assert [tuple(r) for r in J.maintain(some, none, N).collect()] == [(2, 1, "a", None, False, True, 1, 1)]
    assert J.maintain(none, some, N).count() == 0 and J.maintain(none, none, N, "full").count() == 0
    assert [tuple(r) for r in J.maintain(none, some, N, "right").collect()] == [(2, 1, None, "a", True, False, 1, 1)]
    with pytest.raises(ValueError):
        J.maintain(some, none, N, "outer")


def test_versions_of_states_and_of_change_logs(spark):
    rows = spark.createDataFrame([(1, True, [1, 0, 5, 0]), (2, False, [1, 0, None, 1]), (3, True, [5, 5, 5, 5])], "id long, start boolean, event array<int>")
    told = J.states(4, lambda n: F.col("id") + n, F.col("start"), F.col("event"), lambda n: F.concat(F.lit("v"), n.cast("string")))
    got = sorted(tuple(r) for r in J.versions(rows, told).collect())
    assert got == sorted([(1, "v0", 0, 1), (2, "v1", 1, 2), (2, "v1", 4, 5), (2, "v0", 2, 4), (3, "v1", 4, 5), (3, "v0", 0, 5)])
    log = spark.createDataFrame([("r", 0, True, 1, "a"), ("r", 2, True, 1, "b"), ("r", 3, False, 1, "b"), ("s", 1, True, 2, "c"), ("t", 9, True, 2, "c")], "id string, batch int, present boolean, key long, part string")
    assert sorted(tuple(r) for r in J.changes_to_versions(log, "id", "batch", 4).collect()) == [(1, "a", 0, 2), (1, "b", 2, 3), (2, "c", 1, 5)]
