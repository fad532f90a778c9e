"""Decontamination, quality rules, URL filters, mixing and sharding against plain Python."""

import random
import re
import zlib

import pytest

from lotgraph.llm import decontamination, mixing, quality_rules, sharding, url_filters
from lotgraph.llm.common import Scratch, components

DOCS = "doc_id long, text string, source string, size string, k int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, "clash", 1) for i, t, s in rows], DOCS)


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def alnum(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text)) if w]


def blank(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def brute_hits(rows, items, length):
    grams = {}
    for item, text in items:
        w = alnum(text)
        for s in range(max(len(w) - length + 1, 1) if w else 0):
            grams.setdefault(tuple(w[s : s + length]), set()).add(str(item))
    out = {}
    for doc, text in rows:
        w, hit, found = alnum(text), set(), set()
        for n in {len(g) for g in grams}:
            for s in range(len(w) - n + 1):
                if (g := tuple(w[s : s + n])) in grams:
                    hit |= set(range(s, s + n))
                    found |= grams[g]
        out[doc] = (len(w), len(hit), sorted(found))
    return out


@pytest.mark.parametrize("length", [3, 5])
def test_decontamination(spark, length):
    r = random.Random(length)
    word = lambda: r.choice(["a", "b", "The", "É", "x1", "zeta", "rho", "tau", "phi"])
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate((0, 1, 2, 4, 9, 12))] + [(9, None), (11, "a a a a a a")]
    rows = [(i, "; ".join(word() for _ in range(r.randint(0, 60)))) for i in range(30)] + [(30, None), (31, ""), (32, items[5][1] + ", " + items[5][1]), (33, "A-A a\na")]
    made = decontamination.decontaminate(docs(spark, [(*x, "s") for x in rows]), spark.createDataFrame(items, "item_id long, text string"), length)
    assert {x.doc_id: (x.n_words, x.n_hit, x.item_ids) for x in made.collect()} == brute_hits(rows, items, length)


def test_proximity(spark):
    rows = [(1, "alpha x beta gamma"), (2, "alpha beta x x x x gamma"), (3, "gamma beta alpha")]
    index = decontamination.PositionalIndex(docs(spark, [(*x, "s") for x in rows]), spark.createDataFrame([(7, "alpha beta gamma")], "item_id long, text string"), Scratch(spark))
    key = {x.k: x.doc_id for x in docs(spark, [(*x, "s") for x in rows]).select(decontamination.doc_key("doc_id", "text").alias("k"), "doc_id").collect()}
    assert {key[x.k] for x in index.proximity(3, 1).collect()} == {1}
    assert {key[x.k] for x in index.proximity(3, 4).collect()} == {1, 2, 3}


def test_no_items_and_no_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    one = docs(spark, [(1, "a b", "s"), (1, "a b", "s"), (None, "a", "s")])
    assert sorted((x.n_words, x.n_hit) for x in decontamination.decontaminate(one, none).collect()) == [(1, 0), (2, 0), (2, 0)]
    assert decontamination.decontaminate(docs(spark, []), none).count() == 0


def brute_statistics(text):
    w, t = blank(text), text or ""
    seen = {}
    for s in range(len(w) - 7):
        seen.setdefault(tuple(w[s : s + 8]), []).append(s)
    covered = {p for at in seen.values() if len(at) > 1 for s in at for p in range(s, s + 8)}
    lines = [x for x in t.split("\n") if blank(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


def test_statistics(spark):
    r = random.Random(4)
    texts = [" ".join(r.choice("abc") for _ in range(n)) for n in (0, 3, 7, 8, 9, 30, 200)] + ["w " * 3000, "x\ny\nx\n \n", "😀 É\t#*$\x0b%&|<>", None, "a b c d e f g h " * 2, "q\x85r\xa0s"]
    got = {x.doc_id: tuple(x)[1:] for x in quality_rules.statistics(docs(spark, [(i, t, "s") for i, t in enumerate(texts)])).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()}
    assert got == {i: brute_statistics(t) for i, t in enumerate(texts)}


def test_decision_list(spark):
    r = random.Random(5)
    rows = []
    for _ in range(900):
        x = {"n_words": r.randint(20, 900), "mean_chars": r.uniform(3, 9), "symbol_ratio": r.choice([0.0, 0.0, r.random()]), "dup_line_ratio": r.random() / 4, "repeat_ratio": 0.0}
        rows.append(x | {"bad": int(x["symbol_ratio"] > 0.3 or (x["mean_chars"] > 7 and x["n_words"] < 300))})
    rules = quality_rules.learn(rows)
    fires = lambda x: any(all(c.holds(x) for c in rule) for rule in rules)
    good = [x for x in rows if not x["bad"]]
    assert sum(map(fires, good)) <= 0.05 * len(good) and sum(fires(x) for x in rows if x["bad"]) >= 0.9 * sum(x["bad"] for x in rows)
    df = spark.createDataFrame(rows)
    by_spark = [x.d > 0 for x in df.select(quality_rules.decision(rules).alias("d")).collect()]
    assert by_spark == [fires(x) for x in rows]
    assert quality_rules.learn([]) == [] and quality_rules.learn([x for x in rows if x["bad"]]) == []


def test_quality_without_labels(spark):
    rows = docs(spark, [(1, "word " * 5, "s"), (2, " ".join(f"w{i}" for i in range(50)), "s"), (3, None, "s")])
    rules = quality_rules.fit(rows, spark.createDataFrame([(1, None), (None, 0)], "doc_id long, quality int"))
    assert rules == [] and {x.doc_id: x.kept for x in quality_rules.apply_rules(rows, rules).collect()} == {1: False, 2: True, 3: False}


RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"))
PAGES = "page_id long, url string, html string, verdict string"


def test_url_rules_and_aliases(spark):
    link = lambda u: f'<head><LINK href="{u}" REL=canonical></head>'
    refresh = lambda u: f"<meta http-equiv='Refresh' content='0; URL={u}'>"
    rows = [
        (1, "http://A.Example.com/en/x?q#f", ""), (2, "https://www.example.com/en/x", ""), (3, "http://example.com/fr", None), (4, "http://b.net/es/1", ""), (5, None, "x"), (6, "/relative", link("http://b.net/es/1")),
        (7, "http://c.org/a", link("http://b.net/es/1")), (8, "http://d.org/b", refresh("http://c.org/a")), (9, "http://e.com/c", link("http://d.org/b")), (10, "http://f.org/x/y", link("../z")), (11, "http://g.org", ""),
        (12, "http://example.com", ""), (13, "http://h.org/p", link("//c.org/a")), (13, "http://h.org/p", link("//c.org/a")),
    ]
    got = {x.page_id: x for x in url_filters.judge(spark.createDataFrame([(*x, "clash") for x in rows], PAGES), RULES).collect()}
    assert {i: x.verdict for i, x in got.items()} == {1: "block", 2: "allow", 3: "allow", 4: "block", 5: "allow", 6: "allow", 7: "block", 8: "block", 9: "allow", 10: "allow", 11: "allow", 12: "allow", 13: "block"}
    assert (got[1].host, got[1].path, got[1].rule, got[12].rule, got[5].host, got[9].alias_blocked) == ("a.example.com", "/en/x", "example.com/en/", None, "", True)
    assert url_filters.judge(spark.createDataFrame([], PAGES), RULES).count() == 0


def test_components(spark):
    r = random.Random(6)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(500, x) for x in range(501, 560)]
    parent = list(range(600))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark), "t").collect()}
    assert got == {x: root(x) for x in {y for a, b in edges if a != b for y in (a, b)}}


def test_mixing(spark):
    r = random.Random(9)
    rows = [(i, "w " * r.randint(0, 40), r.choice(["a", "b", "c", "c", "c", "d", None])) for i in range(900)] + [(900, None, "e"), (5, "w w", "a"), (5, "w w", "a")]
    out = mixing.mix(docs(spark, rows)).collect()
    again = mixing.mix(docs(spark, rows).repartition(7)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again)) and len(out) == len(rows)
    size = {s: sum(len(blank(t)) for _, t, x in rows if x == s) for s in ("a", "b", "c", "d", "e", None)}
    weight = dict(zip(size, (5, 2, 1, 5, 2, 1), strict=True))
    free, target, left = set(size), {}, 1.5 * sum(size.values())
    while True:  # plain water-filling
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if 2 * size[s] < level * weight[s]}
        if not full:
            break
        for s in full:
            target[s] = 2 * size[s]
            left -= target[s]
        free -= full
    target |= {s: level * weight[s] for s in free}
    for s, t in target.items():
        mine = [x for x in out if x.source == s]
        assert all(abs(x.target - t) < 1e-6 and x.source_size == size[s] and x.taken <= 2 * x.size and x.taken == x.repeats * x.size for x in mine)
        assert abs(sum(x.taken for x in mine) - t) <= 20
    assert mixing.mix(docs(spark, [])).count() == 0


def test_sharding(spark):
    r = random.Random(10)
    rows = [(r.randrange(10**6), "é" * r.randint(0, 50), "s") for _ in range(800)] + [(None, None, "s"), (3, "x", "s"), (3, "x", "s")]
    out = sharding.byte_shards(docs(spark, rows), 7).collect()
    assert len(out) == len(rows)
    assert sorted((x.doc_id or -1, x.size, x.text_crc32) for x in out) == sorted((i or -1, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    total = sum(x.size for x in out)
    for s in range(7):
        mine = sorted((x for x in out if x.shard == s), key=lambda x: x.slot)
        assert [x.slot for x in mine] == list(range(len(mine))) and abs(sum(x.size for x in mine) - total / 7) <= 116
        assert [x.doc_id or -1 for x in mine] == sorted(x.doc_id or -1 for x in mine)
    order = sorted(out, key=lambda x: (x.shard, x.slot))
    assert [x.doc_id or -1 for x in order] == sorted(x.doc_id or -1 for x in order)
    assert sharding.byte_shards(docs(spark, []), 7).count() == 0 and len({x.shard for x in sharding.byte_shards(docs(spark, rows[:1]), 7).collect()}) == 1




def test_pruning_drops_conditions_that_say_nothing():
    r = random.Random(1)
    rows = []
    for _ in range(900):
        row = {"n_words": r.randrange(20, 500), "mean_chars": r.random() * 10, "symbol_ratio": r.random(), "dup_line_ratio": r.random(), "repeat_ratio": r.random()}
        rows.append({**row, "bad": int(row["mean_chars"] <= 3 and row["symbol_ratio"] >= 0.3)})
    rules = quality_rules.learn(rows)
    assert rules
    for rule in rules:
        for c in rule:  # no condition is implied by the others of its rule
            others = [x for x in rule if x is not c]
            assert not others or quality_rules.counts(rows, others) != quality_rules.counts(rows, rule)
    fired = [any(all(c.holds(x) for c in rule) for rule in rules) for x in rows]
    assert sum(f == bool(x["bad"]) for f, x in zip(fired, rows, strict=True)) >= 0.95 * len(rows)


def test_clashing_names_and_long_texts(spark):
    long = "word " * 200_000
    rows = [(1, long, "s", 5, 6, 7), (None, None, None, 5, 6, 7), (2, "", "s", 5, 6, 7), (2, "", "s", 5, 6, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, shard int, size int, k int")
    shards = sharding.byte_shards(df, 3).collect()
    assert sorted(r["size"] for r in shards) == [16, 16, 16, 1_000_016]
    assert sorted(r.taken for r in mixing.mix(df).collect()) == [0, 0, 0, 200_000]
    items = spark.createDataFrame([(9, "word " * 12)], "item_id long, text string")
    hits = {r.doc_id: r.n_hit for r in decontamination.decontaminate(df.where("doc_id = 2 or doc_id is null"), items).collect()}
    assert hits == {None: 0, 2: 0}
    made = quality_rules.apply_rules(df.withColumnRenamed("k", "n_words"), [])
    assert {(r.n_words, r.kept) for r in made.collect()} == {(200_000, False), (0, False)}
