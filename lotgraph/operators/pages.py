"""Pages and lines of documents: page selection, blocks, columns and groups by position, all as window plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.documents import ARCHIVE_KEYWORDS
from ..functions.text import blank_to_empty, clean, compact, compacted, has_any, nfkc, no_space

LINE = "array<struct<text:string,confidence:double,bbox:array<array<double>>>>"
PAGES = f"doc_path string, category string, page_number int, text string, method string, dpi int, layout_text string, lines {LINE}, native_fragments {LINE}"
#: Columns of lines() that come from a line's box.
PLACES = ("boxed", "x", "y", "height", "bottom")


def centre(bbox: Column, axis: int) -> Column:
    """Mean of the corners' coordinate; 0 without a box."""
    values = F.transform(bbox, lambda p: p[axis])
    return F.when(F.size(bbox) > 0, F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(bbox)).otherwise(0.0)


def lines(pages: DataFrame) -> DataFrame:
    """One row for each line: number, text, confidence (1 for native text) and the page's, whether it has a box, centre x and y, height, bottom; nf, the text in NFKC, and c, compact(text)."""
    rows = pages.select("doc_path", "category", "page_number", "method", page_confidence(F.col("method"), F.col("lines")).alias("page_confidence"), F.posexplode("lines").alias("line", "l"))
    ys = F.transform("l.bbox", lambda p: p[1])
    rows = rows.withColumn("nf", nfkc(blank_to_empty(F.col("l.text"))))
    return rows.select(
        "doc_path", "category", "page_number", "method", "page_confidence", "line", F.col("l.text").alias("text"), "nf", compacted(F.col("nf")).alias("c"), F.when(F.col("method") == "ocr", F.col("l.confidence")).otherwise(1.0).alias("confidence"),
        (F.coalesce(F.size("l.bbox"), F.lit(0)) > 0).alias("boxed"), centre(F.col("l.bbox"), 0).alias("x"), centre(F.col("l.bbox"), 1).alias("y"),
        F.greatest(F.coalesce(F.array_max(ys) - F.array_min(ys), F.lit(0.0)), F.lit(3.0)).alias("height"), F.coalesce(F.array_max(ys), F.lit(0.0)).alias("bottom"),
    )


def reading_order(array: Column) -> Column:
    """Lines by rounded row (half to even), then from left to right."""
    keyed = F.transform(array, lambda l: F.struct(F.bround(centre(l["bbox"], 1) / 8).alias("row"), centre(l["bbox"], 0).alias("x"), l["text"].alias("text"), l["confidence"].alias("confidence")))
    return F.array_sort(keyed)


def page_confidence(method: Column, array: Column) -> Column:
    """1 for native text, else the mean over lines that aren't blank, 0 without any."""
    real = F.transform(F.filter(array, lambda l: clean(l["text"]) != ""), lambda l: l["confidence"])
    mean = F.aggregate(real, F.lit(0.0), lambda a, x: a + x) / F.size(real)
    return F.when(method == "text", 1.0).when(F.size(real) > 0, mean).otherwise(0.0)


def with_neighbours(hits: DataFrame, all_pages: DataFrame, doc: str, page: str, distance: int = 1, first: int = 0) -> DataFrame:
    """Pages at most ``distance`` from a hit, and the first ``first`` pages. Hits are spread over their neighbours' numbers: no range join."""
    near = hits.select(doc, F.explode(F.sequence(F.col(page) - distance, F.col(page) + distance)).alias(page))
    if first:
        near = near.unionByName(all_pages.where(F.col(page) <= first).select(doc, page))
    return all_pages.join(near.distinct(), [doc, page], "left_semi")


def archive_pages(pages: DataFrame) -> DataFrame:
    """Pages of archives that may matter: keyword pages with their neighbours, and the first three."""
    return with_neighbours(pages.where(has_any(compact(F.col("text")), ARCHIVE_KEYWORDS)), pages, "doc_path", "page_number", 1, 3)


def pages_to_read(category: Column, page_count: Column, bookmarks: Column) -> Column:
    """Page numbers to read for a document: covers are on page 1, at bookmarks, or among the first five; others are read whole."""
    span = lambda n: F.sequence(F.lit(1), n)
    cover = F.when(page_count <= 3, F.array(F.lit(1))).when(F.size(bookmarks) > 0, bookmarks).otherwise(span(F.least(page_count, F.lit(5))))
    return F.when(page_count < 1, F.array().cast("array<int>")).when(category == "tender_cover", cover).otherwise(span(page_count))


def gap_groups(rows: DataFrame, by: list[str], order: str, gap: Column) -> DataFrame:
    """Add ``group``: rows in order, a new group where ``gap`` (an expression over the row and ``previous``) holds."""
    window = Window.partitionBy(*by).orderBy(order)
    marked = rows.withColumn("previous", F.lag(order).over(window)).withColumn("_new", F.coalesce(gap.cast("int"), F.lit(0)))
    return marked.withColumn("group", F.sum("_new").over(window.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def carried_forward(rows: DataFrame, by: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """The last non-null value up to each row."""
    window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(out, F.last(value, ignorenulls=True).over(window))


def block(rows: DataFrame, by: list[str], order: list[str], begins: Column, ends: Column) -> DataFrame:
    """Rows strictly between the first line where ``begins`` holds and the next where ``ends`` holds."""
    window = Window.partitionBy(*by).orderBy(*order)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    upto = window.rowsBetween(Window.unboundedPreceding, 0)
    marked = rows.withColumn("_in", F.coalesce(F.max(begins.cast("int")).over(before), F.lit(0)))
    marked = marked.withColumn("_out", F.max(((F.col("_in") == 1) & ends).cast("int")).over(upto))
    return marked.where("_in = 1 and _out = 0").drop("_in", "_out")


def value_right_of(rows: DataFrame, label: Column, credible: Column, tolerance: float = 1.8) -> DataFrame:
    """(doc_path, value): the leftmost credible line right of a label line of the same page and row."""
    marks = rows.where(label).select("doc_path", "page_number", F.col("x").alias("lx"), F.col("y").alias("ly"), F.col("height").alias("lh"), F.col("line").alias("lline"))
    met = rows.where(credible).join(marks, ["doc_path", "page_number"]).where((F.col("x") > F.col("lx")) & (F.abs(F.col("y") - F.col("ly")) <= tolerance * F.greatest("height", "lh")))
    return met.groupBy("doc_path").agg(F.min_by(clean(F.col("text")), F.struct("page_number", "lline", "x")).alias("value"))


def column_bounds(rows: DataFrame, headers: list[str], wanted: list[str]) -> DataFrame:
    """(doc_path, page_number, low, high): the column under a wanted header, up to the middle of its neighbours in the header row."""
    text = no_space(clean(F.col("text")))
    heads = rows.where(text.isin(*headers))
    row = Window.partitionBy("doc_path", "page_number").orderBy("x", "line")
    made = heads.withColumns({"_l": F.lag("x").over(row), "_r": F.lead("x").over(row)}).where(text.isin(*wanted))
    found = made.select("doc_path", "page_number", F.coalesce((F.col("x") + F.col("_l")) / 2, F.lit(float("-inf"))).alias("low"), F.coalesce((F.col("x") + F.col("_r")) / 2, F.lit(float("inf"))).alias("high"), F.col("y").alias("header_y"))
    return found.groupBy("doc_path", "page_number").agg(F.min_by(F.struct("low", "high", "header_y"), F.struct("header_y", "low")).alias("c")).select("doc_path", "page_number", "c.*")
