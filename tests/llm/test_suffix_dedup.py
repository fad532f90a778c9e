import hashlib
import random

import pytest

from lotgraph.llm import suffix_dedup

SCHEMA = "doc_id long, text string, extra string"


def brute(rows, length):
    """All windows, the earliest of each kept."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            w = data[s : s + length]
            if w in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(w)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out[doc] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed):
    r = random.Random(seed)
    words = ["the", "of", "naïve", "bid", "lot", "Ωmega", "tender", "a", "paper"]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    shared = [text(30), text(60), "x" * 90]
    rows = []
    for i in range(60):
        parts = [text(r.randint(0, 40)) for _ in range(3)]
        if r.random() < 0.6:
            parts.insert(r.randint(0, 3), r.choice(shared))
        rows.append((i, "\n".join(parts)))
    for i in range(60, 80):  # copies and near copies
        t = rows[r.randrange(10)][1]
        k = r.randrange(len(t) + 1)
        rows.append((i, t if i % 2 else t[:k] + "#" + t[k:]))
    rows += [(70 + i, t + "#" + t) for i, t in ((20, text(300)), (21, text(400)))]
    rows += [(80, None), (81, ""), (82, "short"), (83, "ab" * 400), (84, "é" * 300)]
    return rows


@pytest.mark.parametrize(("length", "q", "local"), [(40, 12, 50_000), (100, 32, 50_000), (40, 12, 2), (20, 8, 50_000), (20, 8, 2), (100, 32, 2), (400, 32, 50_000), (600, 32, 50_000)])
def test_same_as_brute_force(spark, monkeypatch, length, q, local):
    monkeypatch.setattr(suffix_dedup, "LOCAL", local)
    rows = corpus(length)
    df = spark.createDataFrame([(*x, "clash") for x in rows], SCHEMA).repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.dedup(df, length, q).collect()}
    assert got == brute(rows, length)


def test_empty_table_and_repeated_rows(spark):
    assert suffix_dedup.dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, "abc " * 60, None), (1, "abc " * 60, None), (None, "z" * 30, None)]
    got = suffix_dedup.dedup(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 3
    assert {r.n_removed for r in got if r.doc_id == 1} == {236}


def test_refuses_what_it_cannot_hold(spark):
    for length, q in ((32, 32), (100, 0), (70_000, 32)):
        with pytest.raises(ValueError, match="length"):
            suffix_dedup.dedup(spark.createDataFrame([], SCHEMA), length, q)
