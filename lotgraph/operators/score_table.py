"""Bidders of the score table in a publication of candidates: by the text layer's columns, by line positions, and line by line.

Everything is a window or an aggregate over lines; state such as "inside the table" is a running maximum in reading order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean, compact, company_names, folded, has_any, names_in, no_space
from . import pages as P

#: Titles, the company column, headers and the line that ends the table.
TITLES = ("所有投标人得分汇总表", "所有投标人报价及得分情况", "所有投标人投标报价及得分情况")
COLUMN, NUMBER = "投标人名称", "序号"
HEADERS = ("序号", "投标人名称", "投标报价", "得分情况", "得分总计", "排名")
STOP = "^(?:[一二三四五六七八九十]+|[0-9]+)[、.]?(?:拟定中标人|中标候选人)"
#: Ends of a name that was cut, and what it goes on with.
CUT_ENDS = ("有限责任公", "有限公", "有限", "工程", "有", "公")
CONTINUATIONS = ("有限责任公司", "有限公司", "限公司", "公司", "司")
ONLY_CONTINUED = ("司", "公司", "限公司", "有限公司", "责任公司")
DOC = "doc_path"


def is_title(c: Column) -> Column:
    return has_any(c, TITLES)


def is_stop(c: Column) -> Column:
    return F.regexp_like(c, F.lit(STOP))


def running(flag: Column, window) -> Column:
    """Whether the flag held in any row so far."""
    return F.max(flag.cast("int")).over(window) == 1


def first_name(text: Column) -> Column:
    return F.get(company_names(text, True), F.lit(0))


def found_names(rows: DataFrame, *order: str) -> DataFrame:
    """(doc_path, name, name_key, page_number, line, pos, evidence, confidence, method, place): each name's first row. Names are of texts in NFKC."""
    keyed = rows.where("name is not null and name <> ''").withColumn("name_key", folded(F.col("name"))).where("name_key <> ''").repartition(DOC)
    own = Window.partitionBy(DOC, "name_key").orderBy(*order)
    once = keyed.withColumn("_r", F.row_number().over(own)).where("_r = 1")
    return once.select(DOC, "name", "name_key", "page_number", "line", F.lit(0).alias("pos"), F.left(clean(F.col("evidence")), F.lit(300)).alias("evidence"), "confidence", "method",
                       F.row_number().over(Window.partitionBy(DOC).orderBy(*order)).alias("place"))


def by_position(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(found, located): names in the company column, cells joined from lines that stand close; documents whose column was found."""
    # Without the column's own header a document has no column.
    headed = lines.where(F.col("boxed") & (F.col("c") == COLUMN)).select(DOC).distinct()
    rows = lines.where("boxed").join(headed, DOC, "left_semi")
    reading = Window.partitionBy(DOC).orderBy("page_number", "y", "x", "line")
    upto = reading.rowsBetween(Window.unboundedPreceding, 0)
    started = rows.withColumn("in", running(is_title(F.col("c")), upto))
    started = started.withColumn("title_y", F.min(F.when(is_title(F.col("c")) & (F.coalesce(F.lag("in").over(reading), F.lit(False)) == F.lit(False)), F.col("y"))).over(Window.partitionBy(DOC, "page_number")))
    begun = started.where("in")
    first = begun.groupBy(DOC).agg(F.min("page_number").alias("first_page"))
    stops = begun.where(is_stop(F.col("c")) & ~is_title(F.col("c"))).groupBy(DOC, "page_number").agg(F.min("y").alias("stop_y"))
    pages = rows.select(DOC, "page_number").distinct().join(first, DOC).where("page_number >= first_page")
    inside = started.join(pages, [DOC, "page_number"]).withColumn("top", F.when(F.col("page_number") == F.col("first_page"), F.col("title_y")).otherwise(F.lit(float("-inf"))))
    below = inside.where("y > top")
    mark = below.where(F.col("c") == COLUMN).select(DOC, "page_number", F.col("line").alias("m"), F.col("x").alias("mx"), F.col("y").alias("my"), F.col("height").alias("mh"), F.col("bottom").alias("mb"))
    heads = below.where(F.col("c").isin(*HEADERS)).select(DOC, "page_number", "x", "y").join(mark, [DOC, "page_number"]).where(F.abs(F.col("y") - F.col("my")) <= 3.0 * F.col("mh"))
    sides = heads.groupBy(DOC, "page_number", "m", "mx", "mb").agg(F.max(F.when(F.col("x") < F.col("mx"), F.col("x"))).alias("l"), F.min(F.when(F.col("x") > F.col("mx"), F.col("x"))).alias("r")).where("l is not null and r is not null")
    column = sides.groupBy(DOC, "page_number").agg(F.min_by(F.struct(((F.col("l") + F.col("mx")) / 2).alias("low"), ((F.col("mx") + F.col("r")) / 2).alias("high"), F.col("mb").alias("top")), "m").alias("own"))
    pages = P.carried_forward(pages.join(column, [DOC, "page_number"], "left"), [DOC], ["page_number"], "own", "col").where("col is not null").join(stops, [DOC, "page_number"], "left")
    ended = F.coalesce(F.max(F.col("stop_y").isNotNull().cast("int")).over(Window.partitionBy(DOC).orderBy("page_number").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pages = pages.withColumn("_e", ended).where("_e = 0")
    cells = rows.join(pages.select(DOC, "page_number", "own", "col", "stop_y"), [DOC, "page_number"])
    cells = cells.where((F.col("y") > F.coalesce("own.top", F.lit(float("-inf")))) & (F.col("y") < F.coalesce("stop_y", F.lit(float("inf")))) & (F.col("x") > F.col("col.low")) & (F.col("x") < F.col("col.high")))
    down = Window.partitionBy(DOC, "page_number").orderBy("y", "line")
    far = F.col("y") - F.lag("y").over(down) > 1.8 * F.greatest(F.lag("height").over(down), F.col("height"))
    cells = cells.withColumn("_n", F.coalesce(far.cast("int"), F.lit(0))).withColumn("cell", F.sum("_n").over(down.rowsBetween(Window.unboundedPreceding, 0)))
    listed = F.array_sort(F.collect_list(F.struct("y", "line", "text")))
    cells = cells.groupBy(DOC, "page_number", "cell").agg(listed.alias("parts"), F.min("confidence").alias("confidence"), F.first("method").alias("method"), F.min("line").alias("line"))
    joined = F.array_join(F.transform("parts", lambda p: no_space(p["text"])), "")
    evidence = F.array_join(F.transform("parts", lambda p: clean(p["text"])), " ")
    return found_names(cells.withColumns({"name": first_name(joined), "evidence": evidence}), "page_number", "cell"), column.select(DOC).distinct()


def by_layout(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(found, located): names in the text layer's company column. Pieces of a name go to the nearest numbered line: of two as near, to the
    next, but mere endings to the one before. A piece's height on the page settles the order within a line."""
    text = pages.where(F.coalesce("layout_text", F.lit("")) != "")
    rows = text.select(DOC, "page_number", "method", F.posexplode(F.split(F.regexp_replace("layout_text", r"\r\n?|\n$", "\n"), "\n")).alias("i", "t")).withColumn("c", compact(F.col("t")))
    page = Window.partitionBy(DOC, "page_number")
    rows = rows.withColumn("last_title", F.max(F.when(is_title(F.col("c")), F.col("i"))).over(page))
    first = rows.where("last_title is not null").groupBy(DOC).agg(F.min("page_number").alias("first_page"))
    rows = rows.join(first, DOC).where("page_number >= first_page")
    at = lambda c, word: F.instr(c, word) - 1
    here = F.array(*[F.when(at(F.col("t"), h) >= 0, at(F.col("t"), h)) for h in HEADERS if h not in (NUMBER, COLUMN)])
    near = page.orderBy("i").rowsBetween(-2, 2)
    rows = rows.withColumn("next_heads", F.flatten(F.collect_list(F.filter(here, lambda x: x.isNotNull())).over(near)))
    start, number = at(F.col("t"), COLUMN), at(F.col("t"), NUMBER)
    heads = rows.where((number >= 0) & (start > number) & (F.col("i") > F.coalesce("last_title", F.lit(-1)))).withColumns({"start": start, "number": number})
    after = F.coalesce(F.array_min(F.filter("next_heads", lambda x: x > F.col("start"))), F.col("start") + 24)
    bounds = F.struct(F.greatest(F.lit(0), F.floor((F.col("number") + len(NUMBER) + F.col("start")) / 2) - 1).alias("low"), F.greatest(F.col("start") + len(COLUMN), after + 14).alias("high"), F.col("i").alias("top"))
    column = heads.groupBy(DOC, "page_number").agg(F.min_by(bounds, "i").alias("own"))
    every = rows.select(DOC, "page_number").distinct().join(column, [DOC, "page_number"], "left")
    every = P.carried_forward(every, [DOC], ["page_number"], "own", "col").where("col is not null")
    rows = rows.join(every, [DOC, "page_number"]).where((F.col("i") > F.coalesce("own.top", F.lit(-1))) & (F.col("i") > F.coalesce("last_title", F.lit(-1))))
    rows = rows.withColumn("stop", F.min(F.when(is_stop(F.col("c")), F.col("i"))).over(page))
    done = rows.groupBy(DOC).agg(F.min(F.when(F.col("stop").isNotNull(), F.col("page_number"))).alias("last_page"))
    rows = rows.join(done, DOC).where("(last_page is null or page_number <= last_page) and (stop is null or i < stop)")
    order = page.orderBy("i")
    anchor = F.when(F.regexp_like("t", F.lit(r"^\s*\d{1,3}(?:\s+|$)")), F.col("i"))
    rows = rows.withColumn("a", anchor).withColumns({
        "before": F.last("a", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)),
        "after": F.first("a", ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing)),
    })
    begins = F.filter(F.sequence(F.lit(1), F.greatest(F.length("t"), F.lit(1))), lambda k: ~F.substr("t", k, F.lit(1)).rlike(r"^\s?$") & ((k == 1) | F.substr("t", k - 1, F.lit(1)).rlike(r"^\s?$")))
    pieces = rows.select("*", F.posexplode(F.arrays_zip(begins.alias("at"), F.regexp_extract_all("t", F.lit(r"\S+"), F.lit(0)).alias("p"))).alias("k", "z"))
    pieces = pieces.withColumn("p", F.col("z.p")).withColumn("pc", compact(F.col("p")))
    pieces = pieces.where(F.regexp_like("p", F.lit("[一-鿿]")) & F.col("z.at").between(F.col("col.low") + 1, F.col("col.high") + 1) & ~F.col("pc").isin(*HEADERS) & ~is_title(F.col("pc")) & ~is_stop(F.col("pc")))
    endings = F.min(F.col("pc").isin(*ONLY_CONTINUED).cast("int")).over(Window.partitionBy(DOC, "page_number", "i")) == 1
    back, ahead = F.col("i") - F.col("before"), F.col("after") - F.col("i")
    goes = F.when(F.col("before").isNull(), F.col("after")).when(F.col("after").isNull(), F.col("before")).when(back < ahead, F.col("before")).when(ahead < back, F.col("after"))
    pieces = pieces.withColumn("cell", goes.otherwise(F.when(endings, F.col("before")).otherwise(F.col("after")))).where("cell is not null")
    drawn = text.select(DOC, "page_number", F.posexplode("native_fragments").alias("f", "n")).select(DOC, "page_number", "f", compact(F.col("n.text")).alias("fc"), P.centre(F.col("n.bbox"), 1).alias("fy"))
    drawn = drawn.groupBy(DOC, "page_number").agg(F.array_sort(F.collect_list(F.struct("f", "fc", "fy"))).alias("drawn"))
    pieces = pieces.join(drawn, [DOC, "page_number"], "left")
    height = F.get(F.filter("drawn", lambda d: (F.col("pc") != "") & F.contains(d["fc"], F.col("pc"))), F.lit(0))["fy"]
    pieces = pieces.withColumn("down", -F.coalesce(height, F.lit(float("-inf"))))
    cells = pieces.groupBy(DOC, "page_number", "cell").agg(F.array_sort(F.collect_list(F.struct("i", "down", "k", "p"))).alias("parts"), F.first("method").alias("method"))
    parts = F.transform("parts", lambda x: x["p"])
    cells = cells.withColumns({"name": first_name(F.array_join(parts, "")), "evidence": F.array_join(parts, " "), "confidence": F.lit(1.0), "line": F.col("cell")})
    return found_names(cells, "page_number", "cell"), column.select(DOC).distinct()


def by_line(lines: DataFrame) -> DataFrame:
    """Names on the lines below the column's header up to the stop, and names cut at a line's end that one of the next three lines completes."""
    order = Window.partitionBy(DOC).orderBy("page_number", "line")
    upto, earlier = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    rows = lines.withColumn("begun", F.coalesce(running(is_title(F.col("c")), earlier), F.lit(False)))
    opens = (is_title(F.col("c")) | F.col("begun")) & F.contains("c", F.lit(COLUMN))
    rows = rows.withColumn("table", F.col("begun") & F.coalesce(running(opens, earlier), F.lit(False)))
    rows = rows.withColumn("over", F.coalesce(running(F.col("begun") & is_stop(F.col("c")), upto), F.lit(False))).where(F.col("table") & ~F.col("over"))
    segments = F.transform(F.split(F.btrim("nf"), r"\s{2,}"), lambda x: F.regexp_replace(F.regexp_replace(no_space(x), "^[ ：:，,。]+|[ ：:，,。]+$", ""), r"^\d+", ""))
    ends = lambda x: F.regexp_like(x, F.lit("(?:" + "|".join(CUT_ENDS) + ")$"))
    cut = F.get(F.filter(segments, lambda x: (F.length(x) >= 6) & ends(x) & (F.size(names_in(x, True)) == 0)), F.lit(0))
    rows = rows.withColumns({"cut": cut, "page_confidence": F.when(F.col("method") == "text", 1.0).otherwise(F.col("page_confidence"))})
    for k in (1, 2, 3):
        rows = rows.withColumns({f"t{k}": F.lead("text", k).over(order), f"c{k}": F.lead("c", k).over(order), f"cut{k}": F.lead("cut", k).over(order)})
    rows = rows.withColumn("seq", F.row_number().over(order))
    on_line = rows.select("*", F.posexplode(names_in(F.col("nf"), True)).alias("at", "name")).select(
        DOC, "page_number", "line", "method", F.col("page_confidence").alias("confidence"), "name", F.col("text").alias("evidence"), "seq", "at")
    whole = lambda k: F.coalesce(*[F.when(F.startswith(f"c{k}", F.lit(x)), first_name(F.concat("cut", F.lit(x)))) for x in CONTINUATIONS])
    rows = rows.where("cut is not null").withColumns({f"w{k}": whole(k) for k in (1, 2, 3)})
    k = F.when(F.col("w1").isNotNull(), 1).when(F.col("cut1").isNull() & F.col("w2").isNotNull(), 2).when(F.col("cut1").isNull() & F.col("cut2").isNull() & F.col("w3").isNotNull(), 3)
    pick = lambda x: F.element_at(F.array(*[F.col(f"{x}{i}") for i in (1, 2, 3)]), F.col("k"))
    completed = rows.withColumn("k", k).where("k is not null").select(
        DOC, "page_number", "line", "method", F.col("page_confidence").alias("confidence"), pick("w").alias("name"), F.concat_ws(" ", "text", pick("t")).alias("evidence"), (F.col("seq") + F.col("k")).alias("seq"), F.lit(1 << 20).alias("at"))
    return found_names(on_line.unionByName(completed), "seq", "at")


def occurrences(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """The table's companies in order: those of the text layer's column if a document has one, else those by position; then what lines add."""
    sure, located = by_layout(pages)
    placed, _ = by_position(lines)
    base = sure.join(located, DOC, "left_semi").unionByName(placed.join(located, DOC, "left_anti"))
    both = base.withColumn("late", F.lit(0)).unionByName(by_line(lines).withColumn("late", F.lit(1)))
    return found_names(both.withColumn("rank", F.col("place")).drop("place"), "late", "rank")
