"""Removal of byte strings that occur earlier, by refining q-gram buckets on the identifiers of later offsets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import rolling
from .common import Scratch, need_integers, slices

U = np.uint64
#: Up to so many different surroundings of a q-gram are compared by one task; beyond, their windows are dealt out one by one.
LOCAL = 50_000


def owners(p: np.ndarray, q: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """q-gram hashes, and for each window of ``length`` bytes the place of its least q-gram (the leftmost of equals)."""
    n = len(p) - 1
    at = np.arange(n - q + 1)
    h = rolling.spans(p, at, at + q)
    bits = U(max(1, int(n).bit_length()))
    m = ((h >> bits) << bits) | at.astype(U)
    w, span = length - q + 1, 1
    while span * 2 <= w:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    if w > span:
        m = np.minimum(m[: span - w], m[w - span :])
    return h, (m & ((U(1) << bits) - U(1))).astype(np.int64)


def anchors(data: np.ndarray, offsets: np.ndarray, q: int, length: int) -> tuple[np.ndarray, ...]:
    """For each q-gram that is the least of some window: (document, q-gram hash, hash of all its windows' bytes, first window, windows - 1, place in the first).

    Windows that cross documents are left out.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none.astype(U), none.astype(U), none, none, none
    p = rolling.prefix(data)
    h, own = owners(p, q, length)
    valid, change = np.zeros(len(own) + 1, bool), np.ones(len(own) + 1, bool)
    for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if e - s >= length:
            valid[s : e - length + 1] = True
    change[1:-1] = own[1:] != own[:-1]
    change[1:] |= valid[1:] != valid[:-1]
    change[offsets[:-1][offsets[:-1] < len(own)]] = True
    cut = np.flatnonzero(change)
    runs = np.flatnonzero(valid[cut[:-1]])
    lo, hi = cut[:-1][runs], cut[1:][runs] - 1
    a = own[lo]
    whole = rolling.mix(rolling.spans(p, lo, hi + length) + ((hi - lo).astype(U) << U(8)) + (a - lo).astype(U))
    doc = np.searchsorted(offsets, lo, "right") - 1
    return doc, h[a], whole, lo - offsets[doc], hi - lo, a - lo


def pair(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The identifier of the refined bucket: that of a bucket and of the bucket at a later offset."""
    return rolling.mix(x * U(0x9E3779B97F4A7C15) + y)


def refined(p: np.ndarray, length: int, q: int) -> Iterator[tuple[int, np.ndarray]]:
    """(depth, bucket identifier of each position) from the q-gram buckets down to ``length`` bytes.

    Each level pairs every position's identifier with that at a later offset, which doubles the depth (the last level
    overlaps), and takes the identifiers of the level before as they are.
    """
    place = np.arange(max(len(p) - q, 0))
    ident, depth = rolling.spans(p, place, place + q), q
    yield depth, ident
    while depth < length:
        step = min(depth, length - depth)
        ident = pair(ident[: len(ident) - step], ident[step:])
        depth += step
        yield depth, ident


def window_buckets(p: np.ndarray, start: np.ndarray, group: np.ndarray, length: int, q: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """(windows, identifiers): windows that share their bucket with another after refinement to ``length`` bytes.

    Windows are sorted by identifier at each level; those alone in their bucket are settled and leave.
    """
    left, key = np.arange(len(start)), group
    for _, ident in refined(p, length, q):
        key = pair(group[left], ident[start[left]])
        order = np.argsort(key)
        k = key[order]
        alone = np.ones(len(k), bool)
        if len(k) > 1:
            same = k[1:] == k[:-1]
            alone[1:] &= ~same
            alone[:-1] &= ~same
        keep = np.sort(order[~alone])
        left, key = left[keep], key[keep]
        if not len(left):
            break
    return left, key


def covered_windows(text: np.ndarray, offsets: np.ndarray, group: np.ndarray, length: int, q: int = 32) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the pieces of text, and which of them equal an earlier one of their group.

    Returns (piece, start in the piece, identifier, state): state 0 alone, 1 first of its bucket, 2 later.
    """
    n = np.diff(offsets) - length + 1
    piece = np.repeat(np.arange(len(n)), n)
    inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    start = offsets[:-1][piece] + inner
    left, key = window_buckets(rolling.prefix(text), start, group[piece].astype(U), length, q)
    state, ident = np.zeros(len(piece), np.int8), np.zeros(len(piece), np.int64)
    ident[left] = key.view(np.int64)
    order = np.argsort(key, kind="stable")
    first = np.ones(len(order), bool)
    first[1:] = key[order][1:] != key[order][:-1]
    state[left[order]] = np.where(first, 1, 2)
    return piece, inner, ident, state


def _int(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == U else x.astype(np.int64), pa.int64())


def dedup(docs: DataFrame, length: int = 100, q: int = 32, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove each byte that a ``length``-byte string covers which also starts earlier: in a document of a smaller id, or earlier in its own.

    1. Of each window's q-grams the least by hash stands for it, so equal windows are filed under equal q-grams: about
       one posting for (length - q) / 2 bytes. A posting also has a fingerprint of all bytes of its windows.
    2. Postings that are not the first of their (q-gram, fingerprint) are repeats as a whole. Firsts of q-grams that have several
       fingerprints go on, all others are settled.
    3. Those pieces of text meet by q-gram; their windows' buckets are refined on the identifiers of later offsets, and all
       but the first window of a final bucket are repeats. Of q-grams with more than LOCAL pieces each window goes by
       its final identifier, made by the same levels, to the task of its bucket.
    Buckets are told apart by 64-bit hashes within equal 64-bit q-gram hashes.
    A null text is empty; texts shorter than ``length`` bytes stay whole; ids are integers (others are a TypeError) and identify documents, a null id is the
    smallest; repeated rows of one id are judged alike; very long texts are whole, ties go to the smaller id and offset; other
    columns are ignored, whatever their names; an empty table gives no rows.
    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256.
    """
    if not 0 < q < length or length - q > 65535:
        raise ValueError("length must exceed q, by 65535 at most")
    need_integers(docs, id_col)
    spark = docs.sparkSession
    scratch, lowest = Scratch(spark), -(1 << 63)
    source = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(lowest)).alias("doc"), F.col(text_col).alias("text"))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for a, b, data, offsets in rolling.chunks(batch.column(1)):
                doc, g, whole, lo, more, off = anchors(data, offsets, q, length)
                # What the chunk itself shows to be a later copy needs no partner: it goes to a group of its own, so that hot groups are combined before the shuffle.
                d = ids[a:b][doc]
                at = (lo << 32) | (more << 16) | off
                order = np.lexsort((at, d, whole, g))
                later = np.zeros(len(order), bool)
                x, y = order[1:], order[:-1]
                later[x] = (g[x] == g[y]) & (whole[x] == whole[y]) & ((d[x] != d[y]) | (at[x] != at[y]))
                yield pa.RecordBatch.from_arrays([_int(np.where(later, rolling.mix(g + d.astype(U) * U(31) + at.astype(U)), g)), _int(whole), _int(d), _int(at), pa.array(later)], names=["g", "whole", "doc", "at", "later"])

    posted = source.mapInArrow(post, "g long, whole long, doc long, at long, later boolean").repartition(slices(spark), "g")
    same, gram = Window.partitionBy("g", "whole").orderBy("doc", "at"), Window.partitionBy("g")
    ranked = posted.withColumn("first", F.first(F.struct("doc", "at")).over(same))
    ranked = ranked.withColumn("copy", F.col("later") | (F.col("first") != F.struct("doc", "at"))).withColumn("new", (~F.col("copy")).cast("long"))
    marks = ranked.withColumn("kinds", F.sum("new").over(gram)).where("copy or kinds > 1").select("doc", "g", "at", "copy", "kinds")
    marks = scratch.keep(marks, "marks")
    hot = not marks.where((F.col("kinds") > LOCAL) & ~F.col("copy")).isEmpty()
    del posted, ranked

    run = lambda at: F.struct(F.shiftright(at, 32).alias("f"), (F.shiftright(at, 32) + F.shiftright(at, 16).bitwiseAND(65535) + length).alias("t"))
    by_doc = marks.groupBy("doc").agg(
        F.collect_set(F.when(F.col("copy"), run(F.col("at")))).alias("gone"),
        F.collect_set(F.when(~F.col("copy"), F.struct("g", "at", "kinds"))).alias("open"),
    )
    joined = source.join(by_doc, "doc", "left")
    marked = F.col("gone").isNotNull()
    staged = joined.select(
        "doc", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.when(~marked, F.sha2(F.coalesce("text", F.lit("")), 256)).alias("kept_sha256"), F.when(marked, F.col("text")).alias("text"), "gone", "open",
    )
    staged = scratch.keep(staged, "staged")
    del joined
    scratch.drop("marks")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, text, opened in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                data = text.encode()
                for o in opened:
                    lo, more = o["at"] >> 32, (o["at"] >> 16) & 65535
                    out.append((o["g"], o["kinds"], doc, lo, data[lo : lo + more + length]))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["g", "kinds", "doc", "lo", "piece"])

    pieces = staged.where("size(open) > 0").select("doc", "text", "open").mapInArrow(cut, "g long, kinds long, doc long, lo long, piece binary")
    if hot:
        pieces = scratch.keep(pieces, "pieces")

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def settle(table: pa.Table) -> pa.RecordBatch:
            again = np.zeros(len(table), bool)  # rows of one id that are given twice
            for c in ("g", "doc", "lo"):
                x = table.column(c).to_numpy()
                again[1:] = (x[1:] == x[:-1]) & (again[1:] if c != "g" else True)
            if again.any():
                table = table.filter(pa.array(~again)).combine_chunks()
            g, doc, lo = (table.column(c).to_numpy() for c in ("g", "doc", "lo"))
            outs = []
            for a, b, data, offsets in rolling.chunks(table.column("piece"), 1 << 40):
                piece, inner, _, state = covered_windows(data, offsets, g[a:b].view(U), length, q)
                gone = state == 2
                edge = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)) != 0)
                s, e = edge[::2], edge[1::2] - 1
                # a run may pass from a piece to the next: pieces are cut again where they change
                cuts = np.flatnonzero(gone[1:] & gone[:-1] & (piece[1:] != piece[:-1])) + 1
                s, e = np.sort(np.concatenate((s, cuts))), np.sort(np.concatenate((e, cuts - 1)))
                outs.append((doc[a:b][piece[s]], lo[a:b][piece[s]] + inner[s], lo[a:b][piece[e]] + inner[e] + length))
            return pa.RecordBatch.from_arrays([_int(np.concatenate([o[i] for o in outs])) if outs else pa.array([], pa.int64()) for i in range(3)], names=["doc", "f", "t"])

        rows = 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= 4000:
                table = pa.Table.from_batches(held).combine_chunks()
                g = table.column("g").to_numpy()
                other = g != g[-1]
                edge = len(g) - int(np.argmax(other[::-1])) if other.any() else 0
                if edge:
                    yield settle(table.slice(0, edge).combine_chunks())
                    held = table.slice(edge).combine_chunks().to_batches()
                    rows = len(table) - edge
        if held:
            yield settle(pa.Table.from_batches(held).combine_chunks())

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g, doc, lo = (batch.column(c).to_numpy() for c in ("g", "doc", "lo"))
            for a, b, data, offsets in rolling.chunks(batch.column("piece")):
                n = np.diff(offsets) - length + 1
                piece = np.repeat(np.arange(len(n)), n)
                inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                start = offsets[:-1][piece] + inner
                *_, (_, ident) = refined(rolling.prefix(data), length, q)
                key = pair(g[a:b].view(U)[piece], ident[start])
                yield pa.RecordBatch.from_arrays([_int(key), _int(doc[a:b][piece]), _int(lo[a:b][piece] + inner)], names=["key", "doc", "f"])

    near = pieces.where(F.col("kinds") <= LOCAL).select("g", "doc", "lo", "piece").repartition(slices(spark), "g").sortWithinPartitions("g", "doc", "lo")
    gone = near.mapInArrow(local, "doc long, f long, t long")
    if hot:
        windows = scratch.keep(pieces.where(F.col("kinds") > LOCAL).select("g", "doc", "lo", "piece").mapInArrow(deal, "key long, doc long, f long"), "windows")
        first = windows.groupBy("key").agg(F.min(F.struct("doc", "f")).alias("first"), F.count("*").alias("n")).where("n > 1")
        gone = gone.union(windows.join(first, "key").where(F.struct("doc", "f") != F.col("first")).select("doc", "f", (F.col("f") + length).alias("t")))
    more = gone.groupBy("doc").agg(F.collect_list(F.struct("f", "t")).alias("more"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, a, b in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                data = np.frombuffer(text.encode(), np.uint8)
                depth = np.zeros(len(data) + 1, np.int32)
                for x in (*a, *(b or ())):
                    depth[x["f"]] += 1
                    depth[x["t"]] -= 1
                gone = np.cumsum(depth[:-1]) > 0
                out.append((doc, len(data), int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(data[~gone].tobytes()).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((*[pa.int64()] * 4, pa.string()))], names=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    done = staged.where(F.col("gone").isNotNull()).select("doc", F.coalesce("text", F.lit("")).alias("text"), "gone").join(more, "doc", "left").select("doc", "text", "gone", "more")
    done = done.mapInArrow(finish, "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    rest = staged.where(F.col("gone").isNull()).select("doc", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), "kept_sha256")
    return rest.unionByName(done).select(F.when(F.col("doc") != lowest, F.col("doc")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
