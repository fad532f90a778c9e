"""Stages of the pipeline on planted documents."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {"en": "the of and to that with this from have which", "de": "der die und nicht sich auf für ist eine über"}


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    r = random.Random(3)
    made = {k: w.split() + ["".join(r.choice(w.split()) for _ in range(3)) for _ in range(300)] for k, w in WORDS.items()}
    text = lambda k, n: " ".join(r.choice(made[k]) for _ in range(n))
    items = [(i, text("en", 30)) for i in range(3)]
    rows = [(i, text(k, r.randint(40, 120)), k, f"s{i % 4}") for i, k in enumerate(["en", "de"] * 60)]
    rows += [(200, rows[5][1], "de", "s0"), (201, rows[6][1] + " end", "en", "s1"), (202, text("en", 50) + " " + items[1][1] + " " + text("en", 40), "en", "s2"), (203, "123 456", "en", "s3"), (204, None, "en", "s0"), (205, "", None, None)]
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(*x, len(x[1] or "")) for x in rows], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    return folder


def test_each_stage_takes_effect(spark, planted, tmp_path):
    docs, seen = spark.read.parquet(f"{planted}/documents.parquet"), []
    for i, (name, stage) in enumerate(cp.STAGES):
        stage(spark, docs, planted).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        assert i == 4 or docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        seen.append({x.doc_id for x in docs.select("doc_id").collect()})
    clean = set(range(120))
    assert seen[0] == clean | {200, 201, 202}
    assert seen[1] == clean | {202} and seen[2] == clean
    assert seen[3] <= clean and seen[4] == seen[3]
    assert docs.agg(F.max("shard")).first()[0] == cp.N_SHARDS - 1


def test_run_equals_its_stages(spark, planted, tmp_path):
    docs = spark.read.parquet(f"{planted}/documents.parquet")
    for i, (_, stage) in enumerate(cp.STAGES):
        stage(spark, docs, planted).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
    rows = lambda df: sorted(tuple(r[c] for c in ("doc_id", "size", "text_crc32", "shard", "slot")) for r in df.collect())
    assert rows(cp.run(spark, planted)) == rows(docs)


def folder(spark, path, docs, items):
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in docs], SCHEMA).write.parquet(f"{path}/documents.parquet")
    return str(path), spark.read.parquet(f"{path}/documents.parquet")


def test_empty_documents(spark, tmp_path):
    path, docs = folder(spark, tmp_path, [], [(1, "a b c")])
    for _, stage in cp.STAGES:
        assert stage(spark, docs, path).count() == 0
    assert cp.run(spark, path).count() == 0


def test_empty_benchmark_clashing_names_and_repeated_ids(spark, tmp_path):
    words = [f"word{i}" for i in range(40)]
    listed = [(1, " ".join(words), "a"), (1, " ".join(reversed(words)), "a"), (2, " ".join(words) + " end", None), (None, "the null id", "b"), (None, "", "b"), (None, None, "b")]
    path, docs = folder(spark, tmp_path, listed, [])
    extra = docs.selectExpr("*", "1 as _k", "2 as _n", "3 as _i", "4 as _times", "5 as k", "6 as id", "7 as found", "8 as size", "9 as repeats")
    assert sorted(map(str, cp.decontaminate(spark, extra, path).collect())) == sorted(map(str, extra.collect()))
    assert sorted(str(r.doc_id) for r in cp.drop_near_duplicates(spark, extra, path).collect()) == ["1", "1", "None", "None", "None"]
    mixed = cp.mix_sources(spark, extra, path)
    assert mixed.columns == extra.columns and {tuple(r) for r in mixed.collect()} <= {tuple(r) for r in extra.collect()}


def test_ids_of_any_type_and_texts_of_one_id(spark, tmp_path):
    """String ids; two texts under one id stay; equal rows are one, the same on each run; a copy under a greater id goes."""
    words = [f"word{i}" for i in range(60)]
    first, second = " ".join(words), " ".join(reversed(words))
    listed = [("b", first, "s2"), ("b", first, "s1"), ("b", second, "s1"), ("a", second + " end", "s1"), ("c", first, "s1"), (None, first, "s1"), ("d", "", "s1"), ("d", "", "s1"), ("e", None, "s1")]
    docs = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in listed], SCHEMA.replace("doc_id long", "doc_id string"))
    want = sorted(map(repr, [("b", first, "s1"), ("a", second + " end", "s1"), ("d", "", "s1"), ("d", "", "s1"), ("e", None, "s1")]))
    for parts in (1, 5):
        got = cp.drop_near_duplicates(spark, docs.repartition(parts), "").select("doc_id", "text", "source").collect()
        assert sorted(repr(tuple(r)) for r in got) == want
    spark.createDataFrame([(1, "zzz yyy xxx")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert cp.decontaminate(spark, docs, str(tmp_path)).count() == len(listed)
    assert cp.shard(spark, cp.mix_sources(spark, docs, ""), "").count() > 0


def test_mixing_takes_equal_rows_as_often_as_the_operator(spark):
    from lotgraph.llm import mixing

    rows = [(7, "one two three", "en", "a", 3)] * 9 + [(i, "four five six seven", "en", "bcd"[i % 3], 4) for i in range(40)] + [(7, None, "en", "a", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = mixing.mix(docs).groupBy("source").agg(F.sum("repeats").alias("n")).where("n > 0")
    got = cp.mix_sources(spark, docs, "").groupBy("source").count()
    own = mixing.mix(docs).where("size > 0").groupBy("source").agg(F.sum("repeats").cast("long").alias("n")).where("n > 0")
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in own.collect()) and want.count() > 0


def test_near_duplicates_against_brute_force(spark, planted):
    from test_jaccard_join import brute

    docs = spark.read.parquet(f"{planted}/documents.parquet")
    classes = brute([(r.doc_id, r.text) for r in docs.collect()], 5, 80)
    assert {r.doc_id for r in cp.drop_near_duplicates(spark, docs, planted).collect()} == {d for d, (_, c) in classes.items() if c == d}


def test_mixing_repeats_rows_as_the_operator_says(spark, planted):
    docs = spark.read.parquet(f"{planted}/documents.parquet").where("text <> ''")
    out = cp.mix_sources(spark, docs, planted)
    size = {r.doc_id: (len(r.text.split()), r.source) for r in docs.collect()}
    total = sum(n for n, _ in size.values())
    taken = {}
    for r in out.collect():
        taken[r.source] = taken.get(r.source, 0) + size[r.doc_id][0]
    own, weights = {}, {}
    for n, s in size.values():
        own[s] = own.get(s, 0) + n
    for i, s in enumerate(sorted(own)):
        weights[s] = (5, 2, 1)[i % 3]
    left, goal, open_ = 1.5 * total, {}, dict(weights)
    while open_:
        full = [s for s in open_ if left * open_[s] / sum(open_.values()) > 2 * own[s]]
        if not full:
            goal |= {s: left * w / sum(open_.values()) for s, w in open_.items()}
            break
        for s in full:
            goal[s] = 2 * own[s]
        left -= sum(goal[s] for s in full)
        open_ = {s: w for s, w in open_.items() if s not in full}
    assert all(abs(taken.get(s, 0) - g) <= 120 for s, g in goal.items())
