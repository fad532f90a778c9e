"""Alignment of two tokenizers' tokens over whole texts, relationally: each distinct stretch of text between blanks is aligned once.

Neither tokenizer merges across a place where a blank follows a sign that is no blank (see segments), so a text's tokens are those of its segments, and both
tokenizers cut there. Segments are aligned as small documents: exploded tokens, tokens of both sides met by their ends, running counts of
common ends as group numbers, a range join (by windows over the ends) for the links. Documents then add up their segments. Documents are dealt into blocks of bounded bytes;
a document is the numbers of its segments in its block, and what is known of a segment goes once to each block that has it. So occurrences of a segment are never rows.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, let, shuffled, slices

#: Folder of the public vocabulary files.
FOLDER = "/opt/tokenizers"
#: Where a text may be cut: a blank comes next, and what is before is neither white space nor a control or format sign.
CUT = r"(?= )(?<=[^\s\p{Z}\p{C}])"
#: Documents of about so many bytes of text make a block.
BLOCK_BYTES = 24 << 20
#: A block's distinct segments are listed in rows of so many.
LISTED = 4096
#: Sides of a join that are both dealt by some of its keys stay where they are.
CO_LOCATED = {"spark_sql_requireAllClusterKeysForCoPartition": "false"}
#: A task's segments with the blocks that have them (one entry a block) are put together without a sort.
BY_SEGMENT = {"spark_sql_objectHashAggregate_sortBased_fallbackThreshold": "200000"}


@dataclass(frozen=True)
class Encoder:
    """How a task makes ids of texts that begin with a blank. kind: bytes (byte-level BPE in JSON) or pieces (sentencepiece, which adds the blank)."""

    kind: str
    path: str

    def load(self) -> tuple[Callable[[list[str]], list[list[int]]], list[bytes]]:
        """(encode, bytes of each id), loaded once in a worker."""
        return (_byte_bpe if self.kind == "bytes" else _piece_bpe)(self.path)

    def splits(self) -> bool:
        """Whether no entry has a blank where a text may be cut, so that no token crosses a cut. Bytes that are no whole sign count as signs."""
        before = lambda c: c.isspace() or (unicodedata.category(c)[0] in "ZC" and unicodedata.category(c) != "Cs")
        shown = (x.decode("utf-8", "surrogateescape") for x in self.load()[1] if b" " in x.lstrip(b" "))
        return all(before(a) for x in shown for a, b in pairwise(x) if b == " " and a != " ")


def byte_bpe(path: str = f"{FOLDER}/byte_bpe_50k.json") -> Encoder:
    return Encoder("bytes", path)


def piece_bpe(path: str = f"{FOLDER}/piece_bpe_32k.model") -> Encoder:
    return Encoder("pieces", path)


@lru_cache(2)
def _byte_bpe(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the others follow from U+0100
    sign = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    vocabulary = json.load(open(path, encoding="utf-8"))["model"]["vocab"]
    of_id = [b""] * (max(vocabulary.values()) + 1)
    for entry, i in vocabulary.items():
        of_id[i] = bytes(sign[c] for c in entry) if all(c in sign for c in entry) else entry.encode()
    return lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)], of_id


@lru_cache(2)
def _piece_bpe(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    of_id = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        of_id.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    # a lone blank can only be the end of a text: the model adds none to an empty one
    blank = model.encode("a ")[len(model.encode("a")) :]
    return lambda texts: [ids if x != " " else blank for x, ids in zip(texts, model.encode([x[1:] for x in texts], num_threads=1), strict=True)], of_id


def segments(text: Column, cut: bool = True) -> Column:
    """The stretches of a blank and the text, each beginning with a blank; together they are the whole. Null or empty: none."""
    whole = F.concat(F.lit(" "), text)
    parts = F.split(whole, CUT) if cut else F.array(whole)
    return F.when(F.coalesce(F.length(text), F.lit(0)) > 0, parts).otherwise(F.array().cast("array<string>"))


def code_texts(texts: DataFrame, cut: bool, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Texts (id, text) as numbers of segments. Rows of two kinds, by block ``blk``: a document's id and codes; and ``segs``, the block's segments numbered from ``base`` on.

    A block is what a task has read when it comes to so many bytes; a longer text is a block by itself.
    """
    kind = texts.schema["id"].dataType.simpleString()

    def encode(batches: list[pa.RecordBatch], blk: int) -> Iterator[pa.RecordBatch]:
        def rows(n: int, **columns: pa.Array) -> pa.RecordBatch:
            types = {"id": batches[0].schema.field("id").type, "codes": pa.list_(pa.int32()), "base": pa.int32(), "segs": pa.list_(pa.string())}
            all_columns = [columns[c].cast(t) if c in columns else pa.nulls(n, t) for c, t in types.items()]
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, blk)), *all_columns], names=["blk", *types])

        whole = pa.Table.from_batches(batches).combine_chunks()
        segs, flat = (pa.concat_arrays(x.chunks) for x in (whole["segs"], pa.chunked_array([x.flatten() for x in whole["segs"].chunks])))
        known = flat.dictionary_encode()
        cuts = np.concatenate([[0], np.cumsum(segs.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int32)
        codes = pa.ListArray.from_arrays(pa.array(cuts), known.indices)
        for at in range(0, len(codes), 1024):
            n = min(1024, len(codes) - at)
            yield rows(n, id=pa.concat_arrays(whole["id"].chunks).slice(at, n), codes=codes.slice(at, n))
        bases = np.arange(0, len(known.dictionary), LISTED, dtype=np.int32)
        if len(bases):
            listed = pa.ListArray.from_arrays(pa.array(np.append(bases, np.int32(len(known.dictionary)))), known.dictionary)
            yield rows(len(bases), base=pa.array(bases), segs=listed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, blk = [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            held, size = [*held, batch], size + batch.nbytes
            if size >= block_bytes:
                yield from encode(held, blk)
                held, size, blk = [], 0, blk + 1
        if held:
            yield from encode(held, blk)

    return texts.select("id", segments(F.col("text"), cut).alias("segs")).mapInArrow(run, f"blk long, id {kind}, codes array<int>, base int, segs array<string>")


def tokenize(distinct: DataFrame, a: Encoder, b: Encoder) -> DataFrame:
    """Of each segment (s, seg) the ids of both tokenizers and their ends in bytes (a, a_end, b, b_end), and ok: both give the segment's bytes.

    Where they don't, the ids are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        loaded = [x.load() for x in (a, b)]
        lengths = [np.array([len(x) for x in of], np.int32) for _, of in loaded]
        for batch in batches:
            for at in range(0, len(batch), 1024):
                piece = batch.slice(at, 1024)
                texts = piece.column("seg").to_pylist()
                ids = [encode(texts) for encode, _ in loaded]
                raw = [x.encode() for x in texts]
                ok = np.ones(len(texts), bool)
                for (_, of), got in zip(loaded, ids, strict=True):
                    if b"".join([of[i] for x in got for i in x]) != b"".join(raw):
                        ok &= [b"".join([of[i] for i in x]) == r for x, r in zip(got, raw, strict=True)]
                columns = [piece.column("s")]
                for got, length in zip(ids, lengths, strict=True):
                    kept = got if ok.all() else [x if good else [] for x, good in zip(got, ok, strict=True)]
                    cuts = np.cumsum([0, *map(len, kept)]).astype(np.int32)
                    flat = np.fromiter(chain.from_iterable(kept), np.int32)
                    so_far = np.concatenate([[0], np.cumsum(length[flat])])
                    ends = (so_far[1:] - np.repeat(so_far[cuts[:-1]], np.diff(cuts))).astype(np.int32)
                    columns += [pa.ListArray.from_arrays(pa.array(cuts), pa.array(x)) for x in (flat, ends)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(ok)], names=["s", "a", "a_end", "b", "b_end", "ok"])

    return distinct.mapInArrow(run, "s long, a array<int>, a_end array<int>, b array<int>, b_end array<int>, ok boolean")


def tokens(told: DataFrame, key: str = "s") -> DataFrame:
    """A row for each token of either tokenizer: key, end in bytes, and the id in column a or b (the other is null)."""
    rows = told.select(key, F.size("a").alias("n"), F.posexplode(F.arrays_zip(F.concat("a_end", "b_end").alias("end"), F.concat("a", "b").alias("id"))).alias("pos", "t"))
    of = lambda c, own: F.when(own, F.col("t.id")).alias(c)
    return rows.select(key, F.col("t.end").alias("end"), of("a", F.col("pos") < F.col("n")), of("b", F.col("pos") >= F.col("n")))


def boundaries(told: DataFrame, key: str = "s") -> DataFrame:
    """A row for each byte where a token of either tokenizer ends: key, end, a and b (the ids of the tokens that end there, else null), g (less by one for each
    common end from here on: it ascends, and tokens between two common ends are a group), over_a and over_b (the tokens that hold the byte before the end).

    Two tokens overlap in one stretch without an end inside, so each end stands for one link, the pair (over_a, over_b): the range join of the tokens is
    the next end of either side, found by a window, and is never larger than the tokens are many. The window runs from the last end to the first, so each
    row adds to what is known; a frame to the end of the segment would be summed anew for each row.
    """
    dealt = told.where("ok").repartition(4 * slices(told.sparkSession), key)
    met = tokens(dealt, key).groupBy(key, "end").agg(F.max("a").alias("a"), F.max("b").alias("b"))  # where they are: a full join's keys are dealt anew
    onward = Window.partitionBy(key).orderBy(F.desc("end")).rowsBetween(Window.unboundedPreceding, 0)
    common = F.count(F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), 1)).over(onward)
    return met.select("*", (-common).alias("g"), F.last("a", True).over(onward).alias("over_a"), F.last("b", True).over(onward).alias("over_b"))


def pair(a: str, b: str) -> Column:
    """Two ids as one number."""
    return F.shiftleft(F.col(a).cast("long"), 32) + F.col(b)


def align_segments(told: DataFrame, key: str = "s") -> DataFrame:
    """(key, n_a, n_b, n_groups, groups, pairs): tokens and groups by number, the groups as text ``a1,a2|b1;a3|b2,b3``, ids in order, and the pair of ids of each link (see pair)."""
    side = lambda n, c: F.transform(F.filter("x", lambda t: t[c].isNotNull()), lambda t: F.struct(t["g"].alias("g"), F.lit(n).alias("side"), t["end"].alias("end"), t[c].alias("id")))
    ends = boundaries(told, key).groupBy(key).agg(
        F.count("a").alias("n_a"), F.count("b").alias("n_b"), (-F.min("g")).alias("n_groups"),
        F.collect_list(F.struct("g", "end", "a", "b")).alias("x"), F.collect_list(pair("over_a", "over_b")).alias("pairs"),
    )

    def text(listed: Column) -> Column:
        """Ids, each after its sign: the next group, the other side, the same side."""

        def shown(t: Column, i: Column) -> Column:
            last = F.get(listed, i - 1)
            return F.concat(F.when(i == 0, "").when(last["g"] != t["g"], ";").when(last["side"] != t["side"], "|").otherwise(","), t["id"].cast("string"))

        return F.array_join(F.transform(listed, shown), "")

    return ends.select(key, "n_a", "n_b", "n_groups", let(F.sort_array(F.concat(side(0, "a"), side(1, "b"))), text).alias("groups"), "pairs")


class Block:
    """A block's documents as places of their segments among the rows that came for the block; a segment of which none came has no tokens (see tokenize)."""

    def __init__(self, docs: pa.Table, came: pa.Table):
        codes, code = [x for c in docs["codes"].chunks for x in (c.flatten(),)], came["code"].to_numpy()
        flat = pa.chunked_array(codes, pa.int32()).to_numpy()
        place = np.full(max(flat.max(initial=-1), code.max(initial=-1)) + 1, -1)
        place[code] = np.arange(len(code))
        self.rows = place[flat]
        lengths = [c.value_lengths().to_numpy(zero_copy_only=False) for c in docs["codes"].chunks]
        self.cuts = np.concatenate([[0], *lengths]).cumsum().tolist()

    def documents(self) -> Iterator[np.ndarray]:
        """Each document's places; none if one of its segments has no tokens."""
        for lo, hi in pairwise(self.cuts):
            at = self.rows[lo:hi]
            yield at if at.min(initial=0) >= 0 else at[:0]


def pairs_held(docs: pa.Table, came: pa.Table) -> pa.Table:
    """(p, count): how many documents of a block hold a pair. ``came`` has code and pairs of its segments."""
    lists = came["pairs"].combine_chunks()
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    width = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    start = np.cumsum(width) - width
    ids, local = np.unique(lists.flatten().to_numpy(), return_inverse=True)
    count, last = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    for at in Block(docs, came).documents():
        n = width[at]
        ends = np.cumsum(n)
        turn = np.arange(ends[-1] if len(ends) else 0)
        own = local[np.repeat(start[at] - ends + n, n) + turn]
        last[own] = turn
        count[own[last[own] == turn]] += 1  # each pair of the document once, where it is last
    return pa.table({"p": ids[count > 0], "count": count[count > 0]})


#: What documents add up.
SUMMED = ("n_a", "n_b", "n_groups", "n_best", "count_sum")


def summed(docs: pa.Table, came: pa.Table) -> pa.Table:
    """Each document's sums and groups. ``came`` has code, the summed columns and groups of the block's segments."""
    numbers, groups = np.stack([came[c].to_numpy() for c in SUMMED], 1), came["groups"].to_pylist()
    parts, sums, texts = [], [], []
    for at in Block(docs, came).documents():
        sums.append(numbers[at].sum(0))
        texts.append(";".join([groups[i] for i in at.tolist()]))
        if len(texts) == 256:
            parts.append(pa.array(texts, pa.string()))
            texts = []
    parts.append(pa.array(texts, pa.string()))
    columns = np.array(sums, np.int64).reshape(-1, len(SUMMED)).T
    return pa.table({"doc_id": docs["id"], **dict(zip(SUMMED, map(np.ascontiguousarray, columns), strict=True)), "groups": pa.chunked_array(parts)})


def align(docs: DataFrame, a: Encoder, b: Encoder, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] | None = None) -> DataFrame:
    """Each document's tokens under both tokenizers, cut into groups at common ends, and its links, weighed by how many documents hold the pair.

    Returns doc_id, n_a, n_b, n_groups, n_links, n_best (links whose count is the highest that their a-id has anywhere), count_sum (the links' counts added up) and groups (see
    align_segments; or what ``digest`` makes of it, before it is written).
    Null or empty text, and text that either tokenizer doesn't give back byte for byte: zeros and an empty string. Very long texts are whole: one row while their
    groups are put together. Repeated rows are documents of their own, also in counts; null ids are ids. An empty table gives no rows. Other columns are ignored,
    whatever their names.
    """
    scratch = Scratch(docs.sparkSession)
    digest = digest or (lambda x: x)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    coded = scratch.keep(code_texts(texts, a.splits() and b.splits()), "coded")
    dealt = coded.where("codes is not null").select("blk", "id", "codes")
    seen = coded.where("segs is not null").select("blk", "base", F.posexplode("segs").alias("i", "seg")).repartition("seg")
    seen = seen.groupBy("seg").agg(F.collect_list(F.struct("blk", (F.col("base") + F.col("i")).alias("code"))).alias("at"))  # an entry a block
    seen = scratch.keep(seen.withColumn("s", F.monotonically_increasing_id()), "seen", **BY_SEGMENT)
    told = scratch.keep(tokenize(seen.select("s", "seg"), a, b), "tokens")
    aligned = align_segments(told).join(shuffled(seen.select("s", "at")), "s")
    aligned = scratch.keep(aligned, "aligned", **CO_LOCATED, **BY_SEGMENT)
    scratch.drop("tokens", "seen")

    def by_block(docs: DataFrame, of: DataFrame, made: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
        """made() of each block's documents and the rows of its distinct segments, which are no more than its texts' bytes."""
        came = of.withColumn("at", F.explode("at")).select("at.*", *[c for c in of.columns if c != "at"])
        return docs.groupBy("blk").cogroup(came.groupBy("blk")).applyInArrow(made, schema)

    held = by_block(dealt.drop("id"), aligned.select("at", F.array_distinct("pairs").alias("pairs")), pairs_held, "p long, count long")
    counts = scratch.keep(held.groupBy("p").agg(F.sum("count").alias("count")), "counts")
    of_a = F.shiftright("p", 32).alias("a")
    best = counts.groupBy(of_a).agg(F.max("count").alias("best"))
    ranked = counts.select("p", "count", of_a).join(shuffled(best), "a").select("p", "count", (F.col("count") == F.col("best")).cast("long").alias("is_best"))
    links = aligned.select("s", F.explode("pairs").alias("p")).join(shuffled(ranked), "p")
    sums = links.groupBy("s").agg(F.sum("is_best").alias("n_best"), F.sum("count").alias("count_sum"))
    each = scratch.keep(aligned.drop("pairs").join(shuffled(sums), "s").drop("s"), "each")
    scratch.drop("aligned", "counts")
    schema = f"doc_id {texts.schema['id'].dataType.simpleString()}, {', '.join(f'{c} long' for c in SUMMED)}, groups string"
    out = by_block(dealt, each, summed, schema)
    n_links = F.col("n_a") + F.col("n_b") - F.col("n_groups")  # an end of either side is a link, a common end ends both
    out = out.select("doc_id", "n_a", "n_b", "n_groups", n_links.alias("n_links"), "n_best", "count_sum", digest(F.col("groups")).alias("groups"))
    out = scratch.keep(out, "result")
    scratch.drop(*(set(scratch.paths) - {"result"}))
    return out
