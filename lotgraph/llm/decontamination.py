"""Benchmark decontamination by a positional inverted index."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import NOT_ALNUM, Scratch, lower_ascii, shuffled, small, split_words

#: Broadcast the test set's words and terms up to this many rows; beyond it they are shuffled.
MAX_BROADCAST = 1_000_000


def words(text) -> "F.Column":
    return split_words(lower_ascii(text), NOT_ALNUM)


def doc_key(id_col: str, text_col: str) -> "F.Column":
    """64 bits for a row: rows with one id but different texts are different documents."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


class PositionalIndex:
    """Postings (term, k, pos) of the training tokens that the test set also has, and the test set's own positions.

    Terms that no test item has can't take part in a match, so their postings aren't stored. The table
    is written once, clustered by term; counts, candidates and matches read it, not the texts.
    """

    def __init__(self, docs: DataFrame, items: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text"):
        self.scratch = scratch
        listed = items.select(F.col(item_col).cast("string").alias("item_id"), words(F.col(item_text)).alias("w")).where("item_id is not null and size(w) > 0")
        listed = listed.distinct().withColumn("item", F.xxhash64("item_id", "w"))
        self.items = scratch.keep(listed, "items")
        spelled = self.items.select("item", F.size("w").alias("n"), F.posexplode("w").alias("o", "word"))
        vocabulary = scratch.keep(spelled.select("word").distinct().withColumn("term", F.monotonically_increasing_id()), "vocabulary")
        tokens = docs.select(doc_key(id_col, text_col).alias("k"), F.posexplode(words(F.col(text_col))).alias("pos", "word"))
        postings = tokens.join(small(vocabulary, MAX_BROADCAST), "word").select("term", "k", "pos")
        self.postings = scratch.keep(postings.sortWithinPartitions("term", "k", "pos"), "postings")
        frequency = self.postings.groupBy("term").agg(F.count("*").alias("df"))
        self.item_words = scratch.keep(spelled.join(vocabulary, "word").join(frequency, "term", "left").select("item", "n", "o", "term", F.coalesce("df", F.lit(0)).alias("df")), "item_words")

    def windows(self, length: int) -> DataFrame:
        """(item, s, len, r, o, term, df): the words of each window that starts at s, r = 1 the rarest. Windows with an unseen word are left out."""
        last = F.greatest(F.col("n") - length, F.lit(0))
        starts = F.sequence(F.greatest(F.col("o") - length + 1, F.lit(0)), F.least(F.col("o"), last))
        rows = self.item_words.where("o < n").select("item", "o", "term", "df", F.least(F.col("n"), F.lit(length)).alias("len"), F.explode(F.when(F.least("o", last) >= F.greatest(F.col("o") - length + 1, F.lit(0)), starts)).alias("s"))
        window = Window.partitionBy("item", "s")
        rows = rows.withColumn("least", F.min("df").over(window)).where("least > 0")
        return rows.withColumn("r", F.row_number().over(window.orderBy("df", "o"))).drop("least")

    def candidates(self, length: int) -> DataFrame:
        """(k, item, d): item word 0 would stand at position d, which is negative if a text begins inside the item. The postings of each window's rarest word, intersected, after
        the shift by their offsets, with those of its second rarest."""
        ranked = self.windows(length).where("r <= 2")
        pairs = ranked.groupBy("item", "s").agg(F.min_by(F.struct("o", "term"), "r").alias("x"), F.max_by(F.struct("o", "term"), "r").alias("y"))
        pairs = self.scratch.keep(pairs.select("item", F.col("x.o").alias("o"), F.col("x.term").alias("term"), F.col("y.o").alias("o2"), F.col("y.term").alias("term2")).distinct(), f"pairs{length}")
        first = self.postings.join(small(pairs, MAX_BROADCAST), "term").select("k", "item", (F.col("pos") - F.col("o")).alias("d"), "term2", (F.col("pos") - F.col("o") + F.col("o2")).alias("pos2"))
        partner = self.postings.join(small(pairs.select(F.col("term2").alias("term")).distinct(), MAX_BROADCAST), "term", "left_semi")
        partner = partner.select("k", F.col("term").alias("term2"), F.col("pos").alias("pos2"))
        return first.join(partner, ["k", "term2", "pos2"]).select("k", "item", "d").distinct()

    def phrases(self, length: int = 10) -> DataFrame:
        """(k, item, from_pos, to_pos): maximal runs of words equal to consecutive item words, of at least ``length`` words, or the
        whole item if that is shorter. All remaining lists are intersected for the candidates alone."""
        found = self.scratch.keep(self.candidates(length), f"candidates{length}")
        expected = found.join(small(self.item_words, MAX_BROADCAST), "item").select("k", "item", "d", "n", "o", "term", (F.col("d") + F.col("o")).alias("pos"))
        # only candidates' postings are met, and both sides are sorted, so nothing that grows with the hits is held in memory
        near = self.postings.join(small(found.select("k").distinct(), MAX_BROADCAST), "k", "left_semi")
        met = near.join(shuffled(expected), ["k", "term", "pos"])
        run = F.col("o") - F.row_number().over(Window.partitionBy("k", "item", "d").orderBy("o"))
        runs = met.select("k", "item", "d", "n", "o").distinct().withColumn("run", run).groupBy("k", "item", "d", "n", "run").agg(F.min("o").alias("f"), F.max("o").alias("t"))
        return runs.where(F.col("t") - F.col("f") + 1 >= F.least("n", F.lit(length))).select("k", "item", (F.col("d") + F.col("f")).alias("from_pos"), (F.col("d") + F.col("t")).alias("to_pos"))

    def proximity(self, length: int = 10, slop: int = 2) -> DataFrame:
        """(k, item, s, at): windows all of whose words stand within ``slop`` positions of their place, the rarest word at its place ``at``."""
        listed = self.scratch.keep(self.windows(length), f"near{length}-{slop}")
        first = self.postings.join(small(listed.where("r = 1").select("term", "item", "s", "len", F.col("o").alias("o1")), MAX_BROADCAST), "term").select("k", "item", "s", "len", "o1", F.col("pos").alias("at"))
        wanted = first.join(small(listed.select("item", "s", "o", "term"), MAX_BROADCAST), ["item", "s"])
        wanted = wanted.select("k", "item", "s", "len", "at", "o", "term", F.explode(F.sequence(F.col("at") + F.col("o") - F.col("o1") - slop, F.col("at") + F.col("o") - F.col("o1") + slop)).alias("pos"))
        met = wanted.join(self.postings, ["k", "term", "pos"]).groupBy("k", "item", "s", "len", "at").agg(F.count_distinct("o").alias("c"))
        return met.where("c = len").select("k", "item", "s", "at")


def decontaminate(docs: DataFrame, items: DataFrame, length: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """For each document the words that lie in phrases of ``length`` consecutive words of test items, and those items.

    Words: A-Z lower-cased, runs of other than separators. An item of fewer words is one phrase; one without words is
    none. Null or empty text: no words, no hits. Repeated rows: a row each. Null ids: documents like others. Items
    with a null id are left out. An empty table on either side gives no hits. Very long texts are whole. Of equally rare words the
    first in the window counts as rarer. Other columns, whatever their names, are ignored.
    Documents are told apart by 64 bits of id and text: two that share them share their hits.
    Returns the key k, the id as doc_id, n_words, n_hit, n_items, item_ids (sorted array of strings).
    """
    scratch = Scratch(docs.sparkSession)
    index = PositionalIndex(docs, items, scratch, id_col, text_col, item_col, item_text)
    runs = scratch.keep(index.phrases(length), "phrases")
    hit = runs.select("k", F.explode(F.sequence("from_pos", "to_pos")).alias("pos")).distinct().groupBy("k").agg(F.count("*").alias("n_hit"))
    of = runs.select("k", "item").distinct().join(small(index.items.select("item", "item_id"), MAX_BROADCAST), "item")
    of = of.groupBy("k").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    base = docs.select(doc_key(id_col, text_col).alias("k"), F.col(id_col).alias("doc_id"), F.size(words(F.col(text_col))).cast("long").alias("n_words"))
    found = scratch.keep(hit.join(of, "k"), "found")
    return base.join(found, "k", "left").select(
        "k", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )
