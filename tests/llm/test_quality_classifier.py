"""The classifier's parts against plain versions, its cases, and held-out accuracy."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotgraph.llm import quality_classifier as Q
from lotgraph.llm import queries

FOLDER = "/root/testdata/sf0.01"


def encoded(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]).astype(np.int64)


def test_features_are_those_of_each_text_alone():
    texts = ["The cat, the CAT!! saw it.", "", "  ", "a", "ñandú ñandú über", "x " * 500, "one two three four five", "!", "a!b"]
    text, feature = Q.indicators(*encoded(texts))
    for i, t in enumerate(texts):
        own = Q.indicators(*encoded([t]))[1]
        assert sorted(feature[text == i].tolist()) == sorted(own.tolist()) == sorted(set(own.tolist()))
    assert Q.indicators(*encoded([]))[0].size == 0
    # five tokens, the four pairs and two runs of shapes
    assert (text == 6).sum() == 5 + 4 + 1 or (text == 6).sum() == 5 + 4 + 2
    same = Q.indicators(*encoded(["x y", "y x"]))
    assert set(same[1][same[0] == 0].tolist()) != set(same[1][same[0] == 1].tolist())  # order counts in pairs


def test_ratios():
    r = Q.ratios(np.array([8, 0, 2, 40]), np.array([0, 5, 0, 10]), 80, 20)
    assert r[0] > 0 > r[1] and r[2] == 0 and abs(r[3]) < 1e-9  # too rare; as frequent in both


def test_dual_descent_reaches_the_least_loss():
    """The dual's solution has no better neighbour in the primal: the hinge loss with both classes weighed alike."""
    rng = np.random.default_rng(0)
    r = rng.normal(size=30)
    y = np.where(rng.random(120) < 0.3, 1.0, -1.0)
    rows = [np.unique(rng.choice(30, 6, p=np.where(np.arange(30) % 2 == (s > 0), 3.0, 1.0) / np.where(np.arange(30) % 2 == (s > 0), 3.0, 1.0).sum())) for s in y]
    v, bias = Q.dual_descent(rows, y, r, cost=1.0, epochs=400)
    upper = np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum()))
    x = np.zeros((len(y), 31))
    for i, f in enumerate(rows):
        x[i, f] = r[f] / np.linalg.norm(r[f])
        x[i, 30] = 1
    loss = lambda w: 0.5 * w @ w + (upper * np.maximum(0, 1 - y * (x @ w))).sum()
    best = loss(np.append(v, bias))
    assert all(best <= loss(np.append(v, bias) + rng.normal(size=31) * s) + 1e-3 for s in (0.001, 0.01, 0.1, 1) for _ in range(50))


def test_cases(spark):
    good = [f"the calm word {w} goes on here" for w in "abcdefghijklmnop"]
    bad = [f"BUY!! NOW!! {w}!! ###" for w in "abcdefghijklmnop"]
    docs = spark.createDataFrame([(i, t, 5.0) for i, t in enumerate([*good, *bad, "", None, "calm word", "calm word", "BUY!! ### NOW!! " * 40_000])], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, int(i < 16), "x") for i in range(32)] + [(None, 1, "x"), (33, None, "x")], "doc_id long, quality int, text string")
    out = Q.score(docs, Q.fit(docs, labels))
    got = {r.doc_id: r.score for r in out.collect()}
    assert out.columns == ["doc_id", "text", "score"] and len(got) == 37
    assert min(got[i] for i in range(16)) > max(got[i] for i in range(16, 32)) and got[34] == got[35] > 0.5 > got[36] and got[32] == got[33] and all(0 <= s <= 1 for s in got.values())
    assert {r.score for r in Q.score(docs, Q.fit(docs, labels.limit(0))).collect()} == {0.5}
    one = Q.fit(docs, labels.where("quality = 1"))
    assert {round(r.score, 9) for r in Q.score(docs, one).collect()} == {round(17 / 18, 9)}
    assert Q.score(docs.limit(0), one).count() == 0
    # the sample's order is that of the ids' hashes, whatever the partitions
    a, b = Q.fit(docs, labels, max_rows=20), Q.fit(docs.repartition(7), labels.repartition(3), max_rows=20)
    assert np.array_equal(a.weights, b.weights) and (a.bias, a.slope, a.shift) == (b.bias, b.slope, b.shift)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_query_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality")
    out = queries.queries()["op12_quality_classifier"](spark, FOLDER)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    held = out.where("held_out").join(labels, "doc_id").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert held >= 0.95
