"""Alignment of two tokenizers against a plain version that encodes whole texts."""

import os
from collections import Counter
from itertools import accumulate, pairwise

import pytest
from pyspark.sql import functions as F

from lotgraph.llm import token_alignment as T

pytestmark = pytest.mark.skipif(not os.path.isdir(T.FOLDER), reason="no vocabulary files")
SCHEMA = "doc_id long, text string, seg string, end int"
TEXTS = [
    "The quick brown fox, it's 3.14  today.\n\n  Next\tline ", "größere Straße über Öl — ñandú, éàü", "漢字とかな交じり文。 한국어 텍스트 123", "🙂🙂 emoji👩‍👩‍👧 x", "<|endoftext|> and <s> </s> <unk>", " ", "   ", "\n", "a", "",
    None, "a b c a b c " * 400, "no break   wide　 space", "tab\t tab \r\n end", "▁ is a sign of its own", "x" * 3000, "á combining é b", "ﬁ ligature ① ½", "The quick brown fox, it's 3.14  today.\n\n  Next\tline ", "\x00 \x1f ctrl", "     x",
]


def plain(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of each text by two running positions."""
    (ea, ba), (eb, bb) = T.byte_bpe().load(), T.piece_bpe().load()
    links, rows = [], []
    for text in texts:
        whole = f" {text}"
        a, b = (ea([whole])[0], eb([whole])[0]) if text else ([], [])  # a text is never empty here, so its blank is no lone one
        if b"".join(ba[i] for i in a) != whole.encode() or b"".join(bb[i] for i in b) != whole.encode():
            a, b = [], []
        ends = [list(accumulate(len(of[i]) for i in ids)) for ids, of in ((a, ba), (b, bb))]
        own = overlaps(a, b, ends)
        if len(a) * len(b) < 10**5:
            starts = [[0, *e] for e in ends]
            assert sorted(own) == sorted((x, y) for i, x in enumerate(a) for j, y in enumerate(b) if max(starts[0][i], starts[1][j]) < min(ends[0][i], ends[1][j]))
        cuts = [0, *sorted({*ends[0]} & {*ends[1]})]
        groups = [(",".join(str(i) for i, e in zip(a, ends[0]) if lo < e <= hi), ",".join(str(i) for i, e in zip(b, ends[1]) if lo < e <= hi)) for lo, hi in pairwise(cuts)]
        links.append(own)
        rows.append((len(a), len(b), len(cuts) - 1, ";".join("|".join(g) for g in groups)))
    counts = Counter(p for own in links for p in set(own))
    best: dict[int, int] = {}
    for (i, _), n in counts.items():
        best[i] = max(best.get(i, 0), n)
    return [(*r[:3], len(own), sum(counts[p] == best[p[0]] for p in own), sum(counts[p] for p in own), r[3]) for r, own in zip(rows, links)]


def overlaps(a, b, ends):
    i = j = 0
    out = []
    while i < len(a):
        out.append((a[i], b[j]))
        x, y = ends[0][i], ends[1][j]
        i, j = i + (x <= y), j + (y <= x)
    return out


def test_alignment_equals_whole_texts(spark):
    """Awkward texts: nulls, blanks of all kinds, repeated rows, scripts without blanks, long words, columns of clashing names, ids that are null or repeated."""
    ids = [*range(len(TEXTS) - 2), None, 0]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in zip(ids, TEXTS)], SCHEMA)
    got = T.align(docs, T.byte_bpe(), T.piece_bpe()).collect()
    want = plain(TEXTS)
    assert sorted(repr(tuple(r)) for r in got) == sorted(repr((i, *w)) for i, w in zip(ids, want))
    assert sum(w[0] > 0 for w in want) > 12 and any(t and not w[0] for t, w in zip(TEXTS, want))


def test_digest_and_empty(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in T.align(docs, T.byte_bpe(), T.piece_bpe(), digest=F.length).collect()}
    assert got[1]["groups"] == len(plain(["one two"])[0][6]) and got[2]["groups"] == 0 and got[2].n_links == 0
    assert T.align(docs.limit(0), T.byte_bpe(), T.piece_bpe()).count() == 0


def test_texts_are_cut_only_between_tokens(spark):
    assert T.byte_bpe().splits() and T.piece_bpe().splits()
    parts = [r.s for r in spark.createDataFrame([(t,) for t in TEXTS if t], "text string").select(T.segments(F.col("text")).alias("s")).collect()]
    assert ["".join(p) for p in parts] == [f" {t}" for t in TEXTS if t] and all(x.startswith(" ") for p in parts for x in p)


def test_documents_are_numbers_of_their_blocks_segments(spark):
    """An occurrence is a number in its document's row; a block lists each segment once, whatever its copies, and takes no more than its bytes."""
    whole = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id long, text string").coalesce(1)
    for most in (1, 1 << 20):
        rows = T.code_texts(whole, True, most).collect()
        listed = [(r.blk, r.base + i, s) for r in rows if r.segs is not None for i, s in enumerate(r.segs)]
        assert len({(b, s) for b, _, s in listed}) == len(listed) == len({(b, i) for b, i, _ in listed})
        named = {(b, i): s for b, i, s in listed}
        docs = [r for r in rows if r.codes is not None]
        assert {r.id: "".join(named[r.blk, c] for c in r.codes) for r in docs} == {i: f" {t}" if t else "" for i, t in enumerate(TEXTS)}
        assert len(docs) == len(TEXTS)


def test_a_long_segment_is_aligned_as_a_whole_text(spark):
    """Text without blanks is one segment of many tokens; its rows add to what is known, from the last end to the first."""
    long = "漢字とかな交じり文。" * 100
    docs = spark.createDataFrame([(0, long), (1, "漢字 x")], "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in T.align(docs, T.byte_bpe(), T.piece_bpe()).collect()}
    assert [got[0], got[1]] == plain([long, "漢字 x"])
