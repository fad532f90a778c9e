import random
import re

import pytest

from lotgraph.llm import jaccard_join

SCHEMA = "doc_id long, text string, n long"


def shingles(rows, k):
    sets = {}
    for doc, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
    return sets


def linked(x, y, percent):
    return 100 * len(x & y) >= percent * len(x | y)


def brute(rows, k, percent):
    sets = shingles(rows, k)
    comp = {d: d for d in sets}

    def root(d):
        while comp[d] != d:
            d = comp[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and sets[a] and linked(sets[a], sets[b], percent):
                x, y = sorted((root(a), root(b)))
                comp[y] = x
    return {d: (len(sets[d]), root(d)) for d in sets}


def corpus(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Bid", "LOT", "É", "ß"]
    text = lambda n: [r.choice(words) for _ in range(n)]
    rows = [text(r.choice([0, 1, 2, 3, 5, 9, 11, 14, 25, 40, 80, 200, 600])) for _ in range(80)]
    for _ in range(220):  # copies with up to a few changes, also of copies
        t = list(r.choice(rows))
        for _ in range(r.choice([0, 0, 1, 1, 2, 3, 6])):
            if t:
                i = r.randrange(len(t))
                t[i : i + r.choice([0, 1, 2])] = text(r.choice([0, 1]))
        rows.append(t)
    common = text(40)
    rows += [text(r.randrange(8)) + common + text(r.randrange(8)) for _ in range(40)]  # documents that share most of their text
    out = [(i, r.choice([" ", "\t", "\n "]).join(t)) for i, t in enumerate(rows)]
    return [*out, (len(out), None), (len(out) + 1, " \n")]


def classes(spark, rows, k, percent):
    df = spark.createDataFrame([(*x, 7) for x in rows], SCHEMA).repartition(4)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link_classes(df, k, percent).collect()}


@pytest.mark.parametrize(("k", "percent", "block"), [(3, 90, 512), (5, 80, 512), (3, 90, 3), (2, 90, 5), (1, 60, 7), (1, 50, 512), (3, 100, 512)])
def test_same_as_brute_force(spark, monkeypatch, k, percent, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rows = corpus(k * percent)
    assert classes(spark, rows, k, percent) == brute(rows, k, percent)


def test_sets_of_8_and_13(spark):
    rows = []
    for i in range(30):
        w = [f"p{i}x{j}" for j in range(13)]
        rows += [(2 * i, " ".join(w[:8])), (2 * i + 1, " ".join(w))]
    assert classes(spark, rows, 1, 60) == brute(rows, 1, 60)


def test_a_large_group_of_near_copies_and_a_common_passage(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    r = random.Random(5)
    base, passage = [f"b{i}" for i in range(60)], [f"c{i}" for i in range(30)]
    rows = []
    for i in range(120):  # all near copies of one text, in part only by way of others
        t = list(base)
        for _ in range(r.randrange(3)):
            t[r.randrange(60)] = f"x{i}"
        rows.append((i, " ".join(t)))
    rows += [(200 + i, " ".join([*passage, *(f"y{i % 40}z{j}" for j in range(5)), f"q{i}"])) for i in range(80)]
    assert classes(spark, rows, 5, 80) == brute(rows, 5, 80)


def test_every_link(spark):
    rows = corpus(11)
    sets = shingles(rows, 2)
    pairs, members = jaccard_join.link_pairs(spark.createDataFrame([(*x, 7) for x in rows], SCHEMA).repartition(3), 2, 70)
    rep = {r.doc_id: r.rep for r in members.collect()}
    assert rep == {d: min((e for e in sets if sets[d] and sets[e] == sets[d]), default=d) for d in sets}
    reps = sorted({rep[d] for d in sets if sets[d]})
    assert {(r.a, r.b) for r in pairs.collect()} == {(a, b) for a in reps for b in reps if a < b and linked(sets[a], sets[b], 70)}


def test_empty_table_null_ids_repeated_rows_and_clashing_names(spark):
    assert jaccard_join.link_classes(spark.createDataFrame([], SCHEMA)).count() == 0
    text = "one two three four five six seven"
    rows = [(None, text, 0), (4, text, 0), (4, text, 0), (2, text, 0), (9, "", 0), (5, text + " eight nine", 0), (5, "other words than those of the rest", 0)]
    for names in ("n", "h1", "doc", "component_id"):
        df = spark.createDataFrame(rows, SCHEMA.replace("n long", f"{names} long"))
        got = sorted(((r.doc_id, r.component_id) for r in jaccard_join.link_classes(df, 3, 70).collect()), key=str)
        assert got == sorted([(None, None), (4, 2), (4, 2), (2, 2), (9, 9), (5, 2), (5, 2)], key=str)


def test_very_long_text(spark):
    words = " ".join(f"w{i * i % 9973}" for i in range(200_000))
    got = jaccard_join.link_classes(spark.createDataFrame([(1, words, 0), (2, words + " end", 0), (3, words[:9000], 0)], SCHEMA)).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 1, 3: 3}


@pytest.mark.parametrize("percent", [0, 101])
def test_refuses_impossible_thresholds(spark, percent):
    with pytest.raises(ValueError, match="percent"):
        jaccard_join.link_classes(spark.createDataFrame([], SCHEMA), 3, percent)
