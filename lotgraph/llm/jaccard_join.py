"""Similarity self-join on word shingles: inverted lists of the rarest shingles, T-occurrence search with DivideSkip."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import rolling
from .common import Scratch, components, need_integers, shuffled, slices

U = np.uint64
#: Documents of a list are searched in blocks of about so many, or so many shingles; two blocks meet in a task.
BLOCK, BLOCK_SHINGLES = 512, 1 << 20


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the distinct shingles, sorted by document and hash; fewer than k words are one shingle."""
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    begin, end = ~blank, ~blank
    begin[1:] &= blank[:-1]
    end[:-1] &= blank[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begin[inner] |= ~blank[inner]
    end[inner - 1] |= ~blank[inner - 1]
    start, stop = np.flatnonzero(begin), np.flatnonzero(end) + 1
    word = rolling.spans(rolling.prefix(data), start, stop)
    doc = np.searchsorted(offsets, start, "right") - 1
    n = np.bincount(doc, minlength=len(offsets) - 1)
    docs, hashes = [], []
    for size in range(1, k + 1):
        m = max(len(word) - size + 1, 0)
        h = np.full(m, size, U)
        for j in range(size):
            h = rolling.mix(h * U(0x9E3779B97F4A7C15) + word[j : j + m])
        at = doc[: len(h)]
        here = (at == doc[size - 1 : size - 1 + len(h)]) & ((size == k) | (n[at] == size))
        docs.append(at[here])
        hashes.append(h[here])
    doc, h = np.concatenate(docs), np.concatenate(hashes)
    many = len(offsets) - 1
    small = np.uint16 if many <= 1 << 16 else np.uint32
    if len(h) < 32 * many:
        order = np.argsort(h)
        order = order[np.argsort(doc[order].astype(small), kind="stable")]
        doc, h = doc[order], h[order]
    else:  # sorting each document's own is many times faster if they are long
        order = np.argsort(doc.astype(small), kind="stable")
        doc, h = doc[order], h[order]
        ends = np.cumsum(np.bincount(doc, minlength=many)).tolist()
        for a, b in zip([0, *ends], ends, strict=False):
            h[a:b].sort()
    new = np.ones(len(h), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return doc[new], h[new]


def divide_skip(ids: np.ndarray, sets: list[np.ndarray], side: np.ndarray, percent: int, comp: np.ndarray | None = None, every: bool = False, mu: float = 0.01) -> list[tuple[int, int]]:
    """Links between the sets of a task, by T-occurrence search with DivideSkip on its inverted lists.

    Sets stand in order of size, so the partners of a query that are no larger are a range of each list. With T the least overlap
    any of them needs, the L longest of the query's lists are set aside (L = T / (mu log M + 1)); the short ones are merged; what occurs T - L
    times or more is probed in the long ones by binary search and retained if the overlap reaches what the pair needs. Sets of one side
    (0 or 1) are not compared with each other, those of side 2 are. Sets of one ``comp`` are connected already; pairs that are connected,
    also by links of this task, are settled and left out, unless ``every`` link is asked for.
    """
    order = np.lexsort((ids, [len(s) for s in sets]))
    ids, side, sets = ids[order], side[order], [sets[i] for i in order]
    n, m = np.array([len(s) for s in sets]), len(sets)
    terms, where = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(m), n)
    posting = np.sort(where.astype(np.int64) * m + owner)
    own = np.split(where, np.cumsum(n)[:-1])
    parent = np.arange(m)
    if comp is not None:
        parent = np.unique(comp[order], return_index=True, return_inverse=True)
        parent = parent[1][parent[2]]

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    for x in range(m):
        least = -(-percent * int(n[x]) // 100)
        first = int(np.searchsorted(n, least))
        if first >= x:
            continue
        others = np.arange(first, x)
        wanted = (side[others] != side[x]) | (side[x] == 2)
        if not every:
            here = root(x)
            wanted[wanted] = [root(y) != here for y in others[wanted].tolist()]
        if not wanted.any():
            continue
        t = -(-percent * (int(n[x]) + least) // (100 + percent))
        mine = own[x].astype(np.int64)
        a, b = np.searchsorted(posting, mine * m + first), np.searchsorted(posting, mine * m + x)
        length = b - a
        longest = int(length.max(initial=0))
        if not longest:
            continue
        set_aside = min(t - 1, int(t / (mu * math.log2(longest + 1) + 1)))
        by_length = np.argsort(length, kind="stable")
        short, long = by_length[: len(mine) - set_aside], by_length[len(mine) - set_aside :]
        merged = np.concatenate([posting[a[i] : b[i]] for i in short.tolist() if length[i]] or [posting[:0]]) % m
        found, count = np.unique(merged, return_counts=True)
        some = (count >= t - set_aside) & wanted[found - first]
        found, count = found[some], count[some]
        if len(found) and len(long):
            key = mine[long][:, None] * m + found[None, :]
            at = np.minimum(np.searchsorted(posting, key), len(posting) - 1)
            count = count + (posting[at] == key).sum(axis=0)
        need = -(-percent * (n[x] + n[found]) // (100 + percent))
        for y in found[count >= need].tolist():
            p, q = root(x), root(y)
            if every or p != q:
                parent[p] = q
                if ids[x] != ids[y]:
                    links.append((int(ids[x]), int(ids[y])))
    return links


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, rows: int = 2000, size: int = 8 << 20) -> Iterator[pa.Table]:
    """Tables of complete groups, of some rows or bytes, from batches sorted by ``key``."""
    held, have = [], 0
    for batch in batches:
        held.append(batch)
        have += len(batch)
        if have < rows and sum(x.nbytes for x in held) < size:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        g = table.column(key).to_numpy()
        other = g != g[-1]
        edge = len(g) - int(np.argmax(other[::-1])) if other.any() else 0
        if edge:
            yield table.slice(0, edge).combine_chunks()
            held, have = table.slice(edge).combine_chunks().to_batches(), len(table) - edge
    if have:
        yield pa.Table.from_batches(held).combine_chunks()


def digests(h: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit sums of each set, by which equal sets are told."""
    out = []
    for salt in (1, 2):
        y, full = rolling.mix(h + U(salt)), n > 0
        total = np.zeros(len(n), U)
        if len(y):
            total[full] = np.add.reduceat(y, (np.cumsum(n) - n)[full])
        out.append(total)
    return out


def least_overlap(n, percent: int):
    """What a set of n shares with any partner at least."""
    return -(-percent * n // 100)


def head_sizes(n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(l, size): linked sets share l shingles of their heads at least, the ``size`` first ones in the order of the hashes.

    With T the least overlap, l = T / 10 (1 at least) and size = n - T + l: the l-th shared shingle is followed by T - l others.
    The difference of two sets' l is no more than that of their T, so either set may count with its own.
    """
    t = least_overlap(n, percent)
    share = np.where(n > 0, np.maximum(1, t // 10), 0)
    return share, np.where(n > 0, n - t + share, 0)


class Join:
    """The steps of the join over one table of documents. See link_classes."""

    def __init__(self, docs: DataFrame, k: int, percent: int, id_col: str, text_col: str):
        if not 1 <= percent <= 100:
            raise ValueError("percent must be from 1 to 100")
        if k < 1:
            raise ValueError("k must be positive")
        need_integers(docs, id_col)
        self.k, self.percent, self.spark = k, percent, docs.sparkSession
        self.scratch = Scratch(self.spark)
        self.source = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))

    def measure(self) -> tuple[DataFrame, DataFrame]:
        """(sized, open): each row's doc, n, h1, h2; and s (a number), doc, n, grams of each set that may have a partner.

        One pass over the texts writes the digests, and the head of a set at its first appearance in a task. A set stays open if at least l
        shingles of its head are in other sets' heads. Sets are told apart by h1 here: only linked sets whose h1 collide would be lost.
        """
        k, percent, scratch = self.k, self.percent, self.scratch

        def size_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()  # forgotten when it grows: then a head is only filed again
            for batch in batches:
                known = ~np.asarray(batch.column(0).is_null())
                for a, b, data, offsets in rolling.chunks(batch.column(1)):
                    doc, h = shingle_sets(data, offsets, k)
                    n = np.bincount(doc, minlength=b - a)
                    one, two = digests(h, n)
                    _, size = head_sizes(n, percent)
                    if len(seen) > 200_000:
                        seen.clear()
                    for i, s in enumerate(one.tolist()):
                        if s in seen or not known[a + i]:
                            size[i] = 0
                        else:
                            seen.add(s)
                    rank = np.arange(len(h)) - (np.cumsum(n) - n)[doc]
                    head = h[rank < size[doc]].view(np.int64)
                    heads = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))), pa.int32()), pa.array(head, pa.int64()))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(n.astype(np.int64)), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), heads], names=["doc", "n", "h1", "h2", "head"])

        wide = scratch.keep(self.source.mapInArrow(size_up, "doc long, n long, h1 long, h2 long, head array<long>"), "wide")
        sized = scratch.keep(wide.drop("head"), "sized")
        # Equal sets are one: the least id stands for them.
        self.alike = scratch.keep(sized.where("doc is not null and n > 0").groupBy("h1", "h2", "n").agg(F.min("doc").alias("rep"), F.count("*").alias("copies")), "alike")
        if percent == 100:
            return sized, self.alike.limit(0)
        heads = wide.select("doc", "h1", F.explode("head").alias("token"))
        shared = heads.groupBy("token").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).where("lo < hi").select("token")
        shared = scratch.keep(shared, "shared")
        met = heads.join(shared, "token", "left_semi").groupBy("doc", "h1").agg(F.count("*").alias("met"))
        least = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * percent / 100) / 10))
        maybe = met.join(self.alike, "h1").where(F.col("met") >= least).select(F.col("rep").alias("doc"), "n", "h1", "h2").distinct()
        maybe = scratch.keep(maybe, "maybe")
        scratch.drop("wide", "shared")

        def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a, b, data, offsets in rolling.chunks(batch.column("text")):
                    doc, h = shingle_sets(data, offsets, k)
                    n = np.bincount(doc, minlength=b - a)
                    one, two = digests(h, n)
                    grams = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32()), pa.array(h.view(np.int64), pa.int64()))
                    names = ["doc", "n", "h1", "h2"]
                    made = pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in names), grams], names=[*names, "grams"])
                    same = np.array([x.to_numpy().view(U) for x in (made["h1"], made["h2"])]) == np.array([one, two])
                    yield made.filter(pa.array(same.all(axis=0)))

        found = self.source.join(shuffled(maybe), "doc").select("doc", "n", "h1", "h2", "text").mapInArrow(gather, "doc long, n long, h1 long, h2 long, grams array<long>")
        found = found.dropDuplicates(["doc", "h1", "h2"]).select(F.monotonically_increasing_id().alias("s"), "doc", F.col("n").cast("int").alias("n"), "grams")
        return sized, scratch.keep(found, "open")

    def prefixes(self, sets: DataFrame, name: str) -> DataFrame:
        """(token, s, doc, n, comp): of each set the rarest shingles, n - T + 1 of them, without those that no set of another component has.

        Linked sets of different components share one: those with fewer than T such shingles have no rows.
        """
        token = F.explode("grams").alias("token")
        lists = sets.select("comp", token).groupBy("token").agg(F.count("*").alias("df"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        lists = self.scratch.keep(lists.where("lo < hi").select("token", F.least("df", F.lit((1 << 31) - 1)).cast("int").alias("df")), f"lists-{name}")
        own = Window.partitionBy("s")
        ranked = sets.select("s", "n", token).join(lists, "token").withColumns({"c": F.count("*").over(own), "r": F.row_number().over(own.orderBy("df", "token"))})
        ranked = ranked.where(F.col("r") <= F.col("c") - F.ceil(F.col("n") * self.percent / 100) + 1).select("token", "s")
        out = self.scratch.keep(ranked.join(shuffled(sets.select("s", "doc", "n", "comp")), "s").select("token", "s", "doc", "n", "comp"), f"prefixes-{name}")
        self.scratch.drop(f"lists-{name}")
        return out

    def search(self, sets: DataFrame, tasks: DataFrame, every: bool = False) -> DataFrame:
        """Links (a, b) between the sets that meet in a task. tasks: task, s, side, comp."""
        percent = self.percent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table in whole_groups(batches, "task"):
                task, ids, side, comp = (table.column(c).to_numpy() for c in ("task", "doc", "side", "comp"))
                lists = table.column("grams").combine_chunks()
                ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy().view(U)
                grams = [flat[s:e] for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                cut = np.flatnonzero(np.concatenate(([True], task[1:] != task[:-1], [True])))
                found = [x for s, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True) for x in divide_skip(ids[s:e], grams[s:e], side[s:e], percent, comp[s:e], every)]
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

        placed = sets.select("s", "doc", "grams").join(shuffled(tasks), "s").select("task", "doc", "side", "comp", "grams")
        return placed.repartition(slices(self.spark), "task").sortWithinPartitions("task").mapInArrow(run, "a long, b long").distinct()

    def n_blocks(self) -> "F.Column":
        """Blocks for a group of documents: so many sets, or so many shingles, in each at most (about, as they're dealt by hash)."""
        return F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("long")

    def with_component(self, rows: DataFrame, classes: DataFrame | None) -> DataFrame:
        """rows with the component of their document: the document itself as long as it has no link."""
        rows = rows.drop("comp")
        if classes is None:
            return rows.withColumn("comp", F.col("doc"))
        return rows.join(classes, F.col("doc") == F.col("node"), "left").withColumn("comp", F.coalesce("component", "doc")).drop("node", "component")

    def families(self, rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        """(tasks, large): tasks for the families of sets that lists connect, and s, n, comp, family, blocks of those that one task can't search."""
        lists = rows.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("s").alias("least")).where("lo < hi").select("token", "least")
        edges = rows.join(lists, "token").select(F.col("s").alias("a"), F.col("least").alias("b")).distinct()
        found = self.scratch.keep(components(edges, self.scratch, f"families-{name}"), f"family-{name}")
        sets = rows.select("s", "n", "comp").distinct().join(found, F.col("s") == F.col("node")).select("s", "n", "comp", F.col("component").alias("family"))
        sizes = sets.groupBy("family").agg(self.n_blocks().alias("blocks"))
        sets = self.scratch.keep(sets.join(sizes, "family"), f"members-{name}")
        tasks = sets.where("blocks = 1").select(F.xxhash64("family").alias("task"), "s", F.lit(2).alias("side"), "comp")
        return tasks, sets.where("blocks > 1")

    def hub_tasks(self, rows: DataFrame) -> DataFrame:
        """Tasks in which the sets of a list meet its hub, the first by one random order for all lists, so that lists of like documents
        have one hub; its sets are dealt out in blocks."""
        hub = F.min(F.struct(F.xxhash64(F.lit(1), "s").alias("draw"), "s", "n", "comp")).alias("hub")
        lists = rows.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), hub).where("lo < hi").select("token", "hub")
        fits = 100 * F.least("n", "hub.n") >= self.percent * F.greatest("n", "hub.n")
        pairs = rows.join(lists, "token").where((F.col("comp") != F.col("hub.comp")) & fits).select("hub", "s", "n", "comp").distinct()
        pairs = self.scratch.keep(pairs, "pairs")
        sizes = pairs.groupBy("hub").agg(self.n_blocks().alias("blocks"))
        dealt = pairs.join(sizes, "hub").withColumn("task", F.xxhash64("hub.s", F.pmod(F.xxhash64("s"), "blocks")))
        copies = sizes.select("hub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
        ends = copies.select(F.xxhash64("hub.s", "block").alias("task"), "hub.s", F.lit(0).alias("side"), "hub.comp")
        return dealt.select("task", "s", F.lit(1).alias("side"), "comp").union(ends)

    def list_tasks(self, rows: DataFrame, families: DataFrame | None = None) -> DataFrame:
        """Tasks in which all documents of a list meet that aren't connected. Lists of the same documents are one. If ``families`` are given, one
        whose lists hold its sets more often than blocks of it would is dealt out as if it were a list.
        """
        mark = lambda salt: F.sum(F.xxhash64(F.lit(salt), "s").cast("decimal(38,0)")).alias(f"m{salt}")
        lists = rows.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), mark(1), mark(2), F.count("*").alias("size")).where("lo < hi")
        single = lists.groupBy("m1", "m2", "size").agg(F.min("token").alias("token")).select("token")
        live = self.scratch.keep(rows.join(single, "token"), "live")
        grouped = live.select(F.xxhash64(F.lit("list"), "token").alias("key"), "s", "n", "comp")
        if families is not None:
            held = live.join(families.select("s", "family"), "s").groupBy("family").agg(F.sum("n").alias("held"))
            whole = families.groupBy("family").agg((F.sum("n") * F.max("blocks")).alias("whole")).join(held, "family").where("whole <= held").select("family")
            whole = self.scratch.keep(families.join(whole, "family").select(F.xxhash64(F.lit("family"), "family").alias("key"), "s", "n", "comp"), "whole")
            grouped = grouped.join(whole.select("s"), "s", "left_anti").select("key", "s", "n", "comp").union(whole)
        return self.group_tasks(grouped)

    def group_tasks(self, rows: DataFrame) -> DataFrame:
        """Tasks in which all sets of a group (key) meet that aren't connected.

        The largest component needs no comparison within itself: the other sets, in blocks, meet it and each other, block by block.
        """
        count = rows.groupBy("key", "comp").agg(F.count("*").alias("size"), self.n_blocks().alias("b"), F.sum("n").alias("n"))
        least = F.greatest(F.ceil((F.sum("size") - F.max("size")) / BLOCK), F.ceil((F.sum("n") - F.max_by("n", F.struct("size", "comp"))) / BLOCK_SHINGLES)).cast("long")
        plan = count.groupBy("key").agg(F.max_by("comp", F.struct("size", "comp")).alias("mass"), F.max_by("b", F.struct("size", "comp")).alias("major"), F.greatest(F.lit(1).cast("long"), least).alias("minor"))
        dealt = rows.join(plan, "key").withColumn("draw", F.xxhash64("s"))
        small = F.col("comp") != F.col("mass")
        dealt = dealt.withColumn("i", F.when(small, F.pmod("draw", "minor")).otherwise(F.col("minor") + F.pmod("draw", "major")))
        last = F.when(small, F.col("minor") + F.col("major")).otherwise(F.col("minor")) - 1
        dealt = dealt.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        side = F.when(F.col("i") == F.col("j"), 2).when(F.col("i") < F.col("j"), 0).otherwise(1)
        return dealt.select(F.xxhash64("key", F.least("i", "j"), F.greatest("i", "j")).alias("task"), "s", side.alias("side"), "comp")

    def classes(self, sets: DataFrame) -> DataFrame | None:
        """(node, component) over the documents with links; None without any.

        Families that one task can hold are searched whole at once. In larger ones each list's documents meet its hub; the lists of those
        that aren't connected then are made anew, without what is connected. Their families are searched whole, in blocks, or list by list.
        """
        scratch = self.scratch
        rows = self.prefixes(self.with_component(sets, None), "all")
        tasks, large = self.families(rows, "all")
        left = not large.isEmpty()
        if left:
            tasks = tasks.union(self.hub_tasks(scratch.keep(rows.join(large.select("s"), "s", "left_semi"), "rows")))
        links = scratch.keep(self.search(sets, tasks), "links")
        classes = None if links.isEmpty() else scratch.keep(components(links, scratch, "hubs"), "hubs")
        if left:
            now = scratch.keep(sets.join(large.select("s"), "s", "left_semi"), "large")
            rows = self.prefixes(self.with_component(now, classes), "left")
            tasks, large = self.families(rows, "left")
            new = scratch.keep(self.search(now, tasks.union(self.list_tasks(rows.join(large.select("s"), "s", "left_semi"), large))), "more")
            if not new.isEmpty():
                classes = scratch.keep(components(links.union(new), scratch, "classes"), "classes")
        return classes


def link_classes(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Classes of documents connected by links: Jaccard similarity of their shingle sets of ``percent`` / 100 or more (1 to 100).

    Words are runs of other than blanks, A-Z lower-cased; a set has the distinct k-word shingles, told apart by 64-bit hashes.
    1. Equal sets (by two 64-bit sums and the size) are one: the least id stands for them.
    2. Sets whose heads (see head_sizes) share too little with any other set have no partner and leave.
    3. The others' inverted lists: linked sets share one of their rarest shingles (see Join.prefixes).
    4. Documents that lists connect meet in a task, or, if they are too many, meet the hub of each list first, and then in blocks
       those that aren't connected yet. DivideSkip finds the links in each task, and their connected components are the classes.
    No list is capped, and no pair that may link is left out unless it is connected already. Null, empty or blank texts have an
    empty set and link with nothing. Very long texts are whole, in a block of their own size. Rows of one id are one document. Ids are integers; others are a TypeError. Null ids link with
    nothing (component_id null). Other columns, whatever their names, are ignored. An empty table gives no rows.
    Returns doc_id, n_shingles, component_id (the least id of the class).
    """
    join = Join(docs, k, percent, id_col, text_col)
    sized, sets = join.measure()
    classes = None if percent == 100 else join.classes(sets)
    none = join.spark.createDataFrame([], "node long, component long") if classes is None else classes
    ends = join.alike.join(none, F.col("rep") == F.col("node"), "left").where("copies > 1 or component is not null")
    ends = ends.select("h1", "h2", "n", F.coalesce("component", "rep").alias("component"))
    out = sized.join(ends, ["h1", "h2", "n"], "left")
    return out.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("doc").isNotNull(), F.coalesce("component", "doc")).alias("component_id"))


def link_pairs(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(links, members): every link between different sets as (a, b), a < b, and each document's representative (doc_id, rep).

    As link_classes, but nothing is settled by components: all documents of a list meet in blocks, so the work of a list grows
    with the square of its length, as its links may. Documents of one rep have equal sets; one without a set is its own.
    """
    join = Join(docs, k, percent, id_col, text_col)
    sized, sets = join.measure()
    members = sized.where("doc is not null").join(join.alike, ["h1", "h2", "n"], "left").select(F.col("doc").alias("doc_id"), F.coalesce("rep", "doc").alias("rep")).distinct()
    if percent == 100:
        return join.spark.createDataFrame([], "a long, b long"), members
    rows = join.prefixes(join.with_component(sets, None), "pairs")
    found = join.search(sets, join.list_tasks(rows), every=True)
    return join.scratch.keep(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs"), members
