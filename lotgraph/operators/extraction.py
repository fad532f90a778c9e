"""Bid records from the lines of documents: one plan for all documents of a category, no grouped map.

Every rule is a filter, a window or an aggregate over the lines table, so Spark spreads long documents' lines like any rows.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.documents import award_from_path, stem
from ..functions.text import clean, code_and_lot, coded, compact, company_names, fold_brackets, folded, has_any, let, names_in, nfkc, no_space
from . import pages as P
from . import cover, score_table
from .graph import Scratch
from .keys import PASSED, REVIEW

#: Labels of the fields in documents.
PROJECT = ("项目名称", "工程名称", "标段(包)名称", "标段（包）名称")
LOT = ("标段名称", "标段(包)名称", "标段（包）名称")
CODE = ("项目编号", "项目代码", "标段编号", "标段(包)编号", "标段（包）编号", "交易编号")
LOT_CODE = ("标段编号", "标段(包)编号", "标段（包）编号")
OTHERS = ("招标人", "招标代理", "代理机构", "建设单位", "采购人", "监督部门")
BIDDERS = ("投标人", "中标人", "中标单位")
STOPS = ("招标人名称", "招标人", "招标代理", "代理机构", "建设单位", "采购人", "监督部门", "中标人", "中标单位", "中标总价", "中标工期", "项目负责人", "日期")
UNIT_HEADERS = ("单位名称", "投标单位名称", "投标人名称", "投标单位")
LIST_HEADERS = ("序号", *UNIT_HEADERS, "投标联系人", "联系人", "联系方式", "投标时间")
RANKING, RECOMMENDED, CANDIDATES, BASIC_FACTS = "投标人排序及推荐的中标候选人", "推荐的中标候选人", "中标候选人公示", "基本情况一览表"
PROJECT_WORDS = ("项目", "工程", "施工", "监理", "采购")
FACT_LABELS = ("工程名称", "招标范围", "开标时间", "开标地点", "评标时间", "评标地点")
#: Words of a web page around a title, and what may follow it.
TITLE_CHROME = ("首页", "交易分类", "信息发布时间", "阅读次数", "我要打印", "关闭", "用户登录")
TITLE_TAILS = ("用户登录", "交易平台", "曝光台", "用", "户", "登", "录", "交", "易", "平", "台", "曝", "光")
WINNER_PAGES = ("中标通知书", "成交通知书", RECOMMENDED)
PARTICIPANT_PAGES = ("招投标情况书面报告", "招投标基本情况报告", "原件确认签收表", "项目负责人答辩评分表", "按时送达投标文件的投标人名单")
#: What begins a list of participants, what begins the next section, what separates names, and where a lot's name is sought after its own labels.
LIST_MARKERS = ("按时送达投标文件的投标人名单", "投标人名单", "投标单位名单")
A_HEADING = r"^(?:[0-9一二三四五六七八九十百]+)[、.．。]"
SEPARATORS = "[、，,；;]"
LOT_FALLBACK = ("工程名称", "项目名称")
#: The forms of codes, and a notice's sentence on the end of an evaluation.
A_CODE = r"[A-Za-z0-9][A-Za-z0-9_\-/]{5,}"
A_DASHED_CODE = r"[A-Za-z0-9][A-Za-z0-9_\-/－—–]{5,}"
HEAD_CODE = r"(?<![A-Z0-9])[A-Z][A-Z0-9]{4,}(?:-[A-Z]{0,3}\d{1,4})?(?![A-Z0-9])"
HEAD_LINES = 8
TOLD = r"的(?:评标|评审|交易|招标)(?:工作)?(?:已经|已)?(?:结束|完成)"
NARRATIVE = r"(?:^|[：:。；;])[^：:，。；;]{2,80}?的([^，。；;]{4,100}?(?:项目|工程)[^，。；;]{0,40}?)" + TOLD
ORDER = ("page_number", "line")


def spaced(labels) -> str:
    """A pattern of labels whose characters may stand apart."""
    part = lambda w: r"\s*".join("[(（]" if c in "(（" else "[)）]" if c in ")）" else c for c in w)
    return "(?:" + "|".join(part(w) for w in sorted(set(labels), key=lambda w: (-len(w), w))) + ")"


def in_order(lines: DataFrame) -> DataFrame:
    """A document's lines that aren't blank, with the text of the next one and their number."""
    text, order = clean(F.col("text")), Window.partitionBy("doc_path").orderBy(*ORDER)
    return lines.select("doc_path", *ORDER, text.alias("text"), "c").where("text <> ''").withColumns({"_next": F.lead("text").over(order), "_n": F.row_number().over(order)})


def with_words(rows: DataFrame, words) -> DataFrame:
    """Rows of in_order() whose compact text has one of the words, or they couldn't have a label of them: only these are searched by patterns."""
    plain = {compact_word(w) for w in words}
    return rows.where(has_any(F.col("c"), sorted(w for w in plain if not any(x != w and x in w for x in plain))))


def value_behind(labels) -> Column:
    """Over in_order(): what follows a label on the line up to the next label, or the next line. Null without the label."""
    rest = F.regexp_extract("text", spaced(labels) + r"\s*[:：]?\s*(.*)$", 1)
    value = clean(F.regexp_replace(F.element_at(F.split(rest, spaced((*PROJECT, *LOT, *CODE, *STOPS)), 2), 1), r"(?<=\S)\s{2,}\S{1,3}$", ""))
    return F.when(F.regexp_like("text", F.lit(spaced(labels))), F.coalesce(let(value, lambda v: F.nullif(v, F.lit(""))), "_next", F.lit("")))


def first_value(name: str, longest: bool = False) -> Column:
    """An aggregate: the first, or the longest, value of a column of value_behind()."""
    return F.min_by(name, F.when(F.col(name).isNotNull(), F.struct(*([-F.length(name)] if longest else []), *ORDER)))


def plain_project(value: Column) -> Column:
    """A project name without its label, the narrative around it and the notice's name."""
    bare = F.regexp_replace(value, r"^(?:项目名称|工程名称|标段名称|标段[（(]包[）)]名称)\s*[:：]?", "")
    # The narrative's end is looked for first: without it the pattern would be tried from each sign.
    told = lambda v: F.when(F.regexp_like(v, F.lit("的(?:评标|交易|招标)")), F.nullif(F.regexp_extract(v, "(?:^|的)([^，。；;]{4,80}?项目(?:[（(][^）)]+[）)])?(?:施工|监理|采购)?)的(?:评标|交易|招标)", 1), F.lit("")))
    v = let(bare, lambda v: F.coalesce(told(v), v))
    return F.regexp_replace(F.regexp_replace(clean(v), "(?:中标候选人公示|中标人公告|中标公告|中标通知书)$", ""), "^[ ：:，,。]+|[ ：:，,。]+$", "")


def metadata(lines: DataFrame, longest: bool = False, said: bool = False) -> DataFrame:
    """(doc_path, project_name, project_code, lot_name, labelled_lot): labelled values, else the first plausible line of the first 80; with ``said`` the labelled project as _said."""
    c = no_space(F.col("text"))
    likely = (F.col("_n") <= 80) & F.contains(c, F.lit("项目")) & F.length(c).between(6, 100) & ~has_any(c, ("项目编号", "项目负责人", "项目经理", "工程项目管理"))
    rows = with_words(in_order(lines), (*PROJECT, *LOT, *CODE, "项目"))
    rows = rows.withColumns({"_1": value_behind(PROJECT), "_2": value_behind(LOT), "_3": value_behind(CODE), "_4": value_behind(LOT_CODE)})
    found = rows.groupBy("doc_path").agg(
        first_value("_1", longest).alias("_project"), first_value("_2", longest).alias("_lot"), first_value("_3").alias("_code"), first_value("_4").alias("_lot_code"),
        F.min_by("text", F.when(likely, F.col("_n"))).alias("_likely"), *([first_value("_1").alias("_said")] if said else []),
    )
    out = lines.select("doc_path").distinct().join(found, "doc_path", "left")
    text = lambda name: F.coalesce(F.col(name), F.lit(""))
    code = lambda name: F.coalesce(F.nullif(F.regexp_extract(text(name), A_CODE, 0), F.lit("")), no_space(text(name)))
    named = plain_project(text("_project"))
    return out.select("doc_path", F.when(named != "", named).otherwise(plain_project(text("_likely"))).alias("project_name"), code("_code").alias("project_code"), plain_project(text("_lot")).alias("lot_name"), code("_lot_code").alias("labelled_lot"), *([plain_project(F.col("_said")).alias("_said")] if said else []))


def occurrences(lines: DataFrame, strict: bool = False) -> DataFrame:
    """(doc_path, name, name_key, page_number, line, evidence, confidence, method, place): each organisation's first line, in order."""
    return once_each(lines.select("doc_path", *ORDER, F.left(clean(F.col("text")), F.lit(300)).alias("evidence"), "confidence", "method", F.posexplode(names_in(F.col("nf"), strict)).alias("pos", "name")))


def once_each(found: DataFrame) -> DataFrame:
    """occurrences() of rows with a name each; they are dealt out once, by document, for both windows."""
    found = found.withColumn("name_key", folded(F.col("name"))).repartition("doc_path")
    first = Window.partitionBy("doc_path", "name_key").orderBy(*ORDER, "pos")
    once = found.withColumn("_r", F.row_number().over(first)).where("_r = 1")
    return once.select("doc_path", "name", "name_key", "page_number", "line", "pos", "evidence", "confidence", "method", F.row_number().over(Window.partitionBy("doc_path").orderBy(*ORDER, "pos")).alias("place"))


def bidder_lines(lines: DataFrame) -> DataFrame:
    """Lines but those that name the buyer or an agency and no bidder."""
    c = F.col("c")
    return lines.where(~has_any(c, OTHERS) | has_any(c, BIDDERS))


def explicit(lines: DataFrame, labels, strict: bool = False) -> DataFrame:
    """(doc_path, winner...): the first organisation on a line with one of the labels, or on one that ends with a colon."""
    return first_named(with_names(lines, strict).withColumn("_bid", F.lit(False)), labels)


def records(found: DataFrame, documents: DataFrame, meta: DataFrame, threshold: float = 0.8, unknown_needs_review: bool = False) -> DataFrame:
    """A record for each found organisation; one to be reviewed for a document without any. found may have award_status, rank, force_review."""
    for name, kind in (("award_status", "string"), ("rank", "string"), ("force_review", "boolean")):
        if name not in found.columns:
            found = found.withColumn(name, F.lit(None).cast(kind))
    rows = documents.select("doc_path", "category").distinct().join(meta, "doc_path", "left").join(found, "doc_path", "left")
    status = F.coalesce("award_status", F.lit("未知"))
    review = (F.coalesce("project_name", F.lit("")) == "") | F.col("name").isNull() | (F.col("confidence") < threshold) | F.coalesce("force_review", F.lit(False))
    if unknown_needs_review:
        review = review | (status == "未知")
    text = lambda name: F.coalesce(F.col(name), F.lit(""))
    return rows.select(
        text("project_name").alias("project_name"), text("project_code").alias("project_code"), text("lot_code").alias("lot_code") if "lot_code" in rows.columns else F.lit("").alias("lot_code"),
        text("lot_name").alias("lot_name"), text("name").alias("company_name"), status.alias("award_status"), text("rank").alias("rank"), "category", F.col("doc_path").alias("source_path"),
        F.coalesce(F.col("page_number").cast("string"), F.lit("")).alias("source_pages"), text("method").alias("extraction_method"),
        F.coalesce("evidence", F.lit("未提取到企业名称")).alias("evidence"), F.when(review, REVIEW).otherwise(PASSED).alias("review_status"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"), "place",
    )


def with_names(lines: DataFrame, strict: bool = False) -> DataFrame:
    """(doc_path, page_number, line, c, _said, _bid, w...): lines with an organisation and the first one on them; _said: the line ends with a colon, _bid: bidder_lines() has it."""
    c, names = F.col("c"), names_in(F.col("nf"), strict)
    # Exploded, not filtered: a filter would look for the names a second time.
    rows = lines.select("doc_path", *ORDER, "c", "text", "confidence", "method", F.explode(F.filter(F.array(names), lambda x: F.size(x) > 0)).alias("_names"))
    shown = F.left(clean(F.col("text")), F.lit(300))
    return rows.select("doc_path", *ORDER, "c", F.regexp_like(clean(F.col("text")), F.lit("[:：]$")).alias("_said"), (~has_any(c, OTHERS) | has_any(c, BIDDERS)).alias("_bid"), shown.alias("evidence"), "confidence", "method", "_names")


def first_named(rows: DataFrame, labels) -> DataFrame:
    """(doc_path, winner...) of with_names(): the first organisation on a line with a label or that ends with a colon, else the first of a bidder's line. One pass, one row a document."""
    one = F.struct(*ORDER, F.element_at("_names", 1).alias("name"), "evidence", "confidence", "method")
    first = lambda which: F.min(F.when(which, one))
    said = has_any(F.col("c"), labels) | F.col("_said")
    found = rows.where(said | F.col("_bid")).groupBy("doc_path").agg(F.coalesce(first(said), first(F.col("_bid"))).alias("w"))
    return found.select("doc_path", "w.name", folded(F.col("w.name")).alias("name_key"), "w.page_number", "w.line", F.lit(0).alias("pos"), "w.evidence", "w.confidence", "w.method")


def _winner(lines: DataFrame) -> DataFrame:
    """The labelled winner, else the first bidder."""
    return first_named(with_names(lines), ("中标人", "中标单位")).withColumns({"award_status": F.lit("是"), "place": F.lit(1)})


def narrative_project(pages: DataFrame) -> DataFrame:
    """(doc_path, narrative): the project in a sentence that its evaluation has ended; a page is read as one text, so the sentence may go over lines."""
    flat = no_space(F.coalesce("text", F.lit("")))
    told = let(flat, lambda x: F.when(F.regexp_like(x, F.lit(TOLD)), plain_project(F.regexp_extract(x, NARRATIVE, 1))))
    return pages.select("doc_path", "page_number", told.alias("_t")).where("_t <> ''").groupBy("doc_path").agg(F.min_by("_t", "page_number").alias("narrative"))


def head_code(lines: DataFrame) -> DataFrame:
    """(doc_path, _c): the first code in the first HEAD_LINES lines that aren't blank of a page, split into project and lot."""
    real = lines.where(clean(F.col("text")) != "").withColumn("_n", F.row_number().over(Window.partitionBy("doc_path", "page_number").orderBy("line")))
    head = real.where(F.col("_n") <= HEAD_LINES).withColumn("_code", F.regexp_extract(coded(F.col("nf")), HEAD_CODE, 0)).where("_code <> ''")
    return head.groupBy("doc_path").agg(F.min_by("_code", F.struct(*ORDER)).alias("_code")).select("doc_path", code_and_lot(F.col("_code")).alias("_c"))


def award_notice(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """The winner; a labelled project, else one told by a sentence, else a likely line; codes in a page's head override labelled ones; the lot is named like the project."""
    meta = metadata(lines, said=True).join(narrative_project(pages), "doc_path", "left").join(head_code(lines), "doc_path", "left")
    named = F.coalesce(F.nullif(F.col("_said"), F.lit("")), "narrative", "project_name")
    meta = meta.select("doc_path", named.alias("project_name"), F.coalesce(F.nullif(F.col("_c.project"), F.lit("")), "project_code").alias("project_code"), F.coalesce("_c.lot", F.lit("")).alias("lot_code"), named.alias("lot_name"))
    return records(_winner(lines), lines, meta)


def bid_announcement(lines: DataFrame) -> DataFrame:
    """The winner; the lot code is the labelled one, also if there is none."""
    return records(_winner(lines), lines, metadata(lines).withColumnRenamed("labelled_lot", "lot_code"))


def bid_list(lines: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Organisations in the unit column, carried on to pages without a header; where none is sure, all bidders, to be reviewed."""
    bounds = P.column_bounds(lines, list(LIST_HEADERS), list(UNIT_HEADERS))
    pages = lines.select("doc_path", "page_number").distinct().join(bounds, ["doc_path", "page_number"], "left").withColumn("_b", F.when(F.col("low").isNotNull(), F.struct("low", "high")))
    pages = P.carried_forward(pages, ["doc_path"], ["page_number"], "_b", "_c").select("doc_path", "page_number", "_c", "header_y")
    inside = lines.join(pages, ["doc_path", "page_number"]).where((F.col("x") >= F.col("_c.low")) & (F.col("x") <= F.col("_c.high")) & (F.col("y") > F.coalesce("header_y", F.lit(float("-inf")))))
    sure = occurrences(inside.select(*lines.columns))
    good = sure.groupBy("doc_path").agg(F.min("confidence").alias("_m")).where(F.col("_m") >= threshold).select("doc_path")
    rest = occurrences(bidder_lines(lines)).join(good, "doc_path", "left_anti").withColumn("force_review", F.lit(True))
    found = sure.join(good, "doc_path", "left_semi").withColumn("force_review", F.lit(False)).unionByName(rest)
    split = code_and_lot(F.col("labelled_lot"))
    meta = metadata(lines).withColumn("_s", split).select(
        "doc_path", F.regexp_replace("project_name", "(?:第?[一二三四五六七八九十百千万零〇0-9]+标段|标段)$", "").alias("project_name"),
        F.coalesce(F.nullif(F.col("_s.project"), F.lit("")), "project_code").alias("project_code"), F.col("_s.lot").alias("lot_code"), "lot_name",
    )
    return records(found, lines, meta, threshold)


def _marked(c: Column, marker: str) -> Column:
    """The line has the marker, or begins it, as when recognition broke it."""
    return F.contains(c, F.lit(marker)) | ((F.length(c) >= 4) & F.startswith(F.lit(marker), c))


def ranking_pages(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc_path, page_number, title_y, rec_y): the first page with the ranking's title, companies and a table (there or on the next two pages), and
    its continuation up to the recommendation or a page with neither companies nor table."""
    c, of_page = F.col("c"), F.col("_c")
    page = Window.partitionBy("doc_path", "page_number")
    heights = lines.where(_marked(c, RANKING) | _marked(c, RECOMMENDED)).withColumn("title_y", F.max(F.when(_marked(c, RANKING), F.col("y"))).over(page)).groupBy("doc_path", "page_number").agg(
        F.max("title_y").alias("title_y"), F.min(F.when(_marked(c, RECOMMENDED) & (F.col("y") > F.coalesce("title_y", F.lit(float("-inf"))) + 1), F.col("y"))).alias("rec_y"))
    read = pages.select("doc_path", "page_number", compact(F.col("text")).alias("_c"), (F.size(company_names(F.col("text"))) > 0).alias("named"))
    known = read.select("doc_path", "page_number", F.contains(of_page, F.lit(RANKING)).alias("title"), "named", F.contains(of_page, F.lit("投标人名称")).alias("column"), F.contains(of_page, F.lit(RECOMMENDED)).alias("told"))
    rows = known.join(heights, ["doc_path", "page_number"], "left").withColumn("table", F.col("column") | F.col("rec_y").isNotNull())
    order = Window.partitionBy("doc_path").orderBy("page_number")
    ahead = lambda k: F.coalesce(F.lead(F.col("named") & F.col("table"), k).over(order), F.lit(False))
    begins = F.col("title") & F.col("named") & (F.col("table") | ahead(1) | ahead(2))
    rows = rows.withColumn("_b", F.when(begins, F.col("page_number"))).withColumn("start", F.min("_b").over(Window.partitionBy("doc_path"))).where("page_number >= start")
    ends = F.coalesce(F.max(F.col("rec_y").isNotNull().cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bare = F.max(((F.col("page_number") > F.col("start")) & ~F.col("named") & ~F.col("column") & ~F.col("told")).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumns({"_e": ends, "_n": bare}).where("_e = 0 and _n = 0").select("doc_path", "page_number", "title_y", "rec_y")


def report_pages(scan: DataFrame, read: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Pages of evaluation reports: those of a coarse scan, with the ranking's pages read again in detail; a document whose ranking the scan does not show is read again whole.

    ``scan`` is a stored table of pages, as it is used more than once. ``read`` takes (doc_path, page_number) and returns pages; it is
    evaluated once. A page that it does not return stays as scanned, or goes if its document was to be read whole. The column fallback tells such documents.
    """
    key = ["doc_path", "page_number"]
    wanted = ranking_pages(P.lines(scan), scan).select(*key, F.lit(True).alias("_wanted"))
    located = wanted.select("doc_path", F.lit(True).alias("_located")).distinct()
    plan = scan.select(*key).join(wanted, key, "left").join(located, "doc_path", "left").select(*key, F.col("_located").isNull().alias("fallback"), F.coalesce("_wanted", F.col("_located").isNull()).alias("_again"))
    others = [c for c in scan.columns if c not in key]
    detail = read(plan.where("_again").select(*key)).select(*key, F.struct(*others).alias("_d"))
    rows = scan.join(plan, key).join(detail, key, "left").where(~F.col("fallback") | F.col("_d").isNotNull())
    return rows.select(*key, *[F.when(F.col("_d").isNotNull(), F.col(f"_d.{c}")).otherwise(F.col(c)).alias(c) for c in others], "fallback").select(*scan.columns, "fallback")


def recommended_winner(lines: DataFrame) -> DataFrame:
    """(doc_path, winner...): the first company at most two lines, and 2.5 line heights, from the first mark of the first rank below the recommendation."""
    low = lines.where(F.col("y") >= F.col("rec_y") - 1)
    order = Window.partitionBy("doc_path", "page_number").orderBy("line")
    low = low.withColumn("_i", F.row_number().over(order))
    marks = low.where(F.regexp_like("c", F.lit("第?[1一]名"))).select("doc_path", "page_number", F.col("_i").alias("_m"), F.col("y").alias("my"), F.col("height").alias("mh"), F.col("boxed").alias("mboxed"), F.explode(F.sequence(F.col("_i") - 2, F.col("_i") + 2)).alias("_i"))
    near = low.join(marks, ["doc_path", "page_number", "_i"]).where(~(F.col("boxed") & F.col("mboxed")) | (F.abs(F.col("y") - F.col("my")) <= 2.5 * F.greatest("height", "mh")))
    named = near.withColumn("name", F.get(names_in(F.col("nf")), F.lit(0))).where("name is not null")
    best = F.struct("page_number", "_m", "_i")
    kept = F.struct("name", "page_number", "line", F.lit(0).alias("pos"), F.left(clean(F.col("text")), F.lit(300)).alias("evidence"), "confidence", "method")
    return named.groupBy("doc_path").agg(F.min_by(kept, best).alias("w")).select("doc_path", "w.*").withColumn("name_key", folded(F.col("name")))


def bid_evaluation_report(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """Bidders between the ranking's title and the recommendation, ranked as listed; the recommendation's first rank won.

    The project is the value right of its label in the table of basic facts. What is missing is said in the evidence and reviewed.
    """
    # The ranking's pages, the winner and the table's project are read several times, so they are written.
    scratch = Scratch(lines.sparkSession)
    targets = scratch.keep(ranking_pages(lines, pages), "targets")
    own = lines.join(targets, ["doc_path", "page_number"])
    listed = occurrences(own.where((F.col("y") > F.coalesce("title_y", F.lit(float("-inf")))) & (F.col("y") < F.coalesce(F.col("rec_y") - 1, F.lit(float("inf"))))).select(*lines.columns))
    won = scratch.keep(recommended_winner(own), "won")
    # A winner that is listed anyway is that row; rows of a document are dealt out once for both windows.
    rows = listed.withColumn("_w", F.lit(False)).unionByName(won.withColumns({"place": F.lit(1 << 30), "_w": F.lit(True)})).repartition("doc_path")
    rows = rows.withColumn("_won", F.max(F.when(F.col("_w"), F.col("name_key"))).over(Window.partitionBy("doc_path"))).withColumn("_listed", F.min("_w").over(Window.partitionBy("doc_path", "name_key")))
    found = rows.where("not _w or _listed").withColumns({
        "award_status": F.when(F.col("_won").isNull(), "未知").when(F.col("name_key") == F.col("_won"), "是").otherwise("否"),
        "rank": F.when(F.col("place") == 1 << 30, "1").otherwise(F.col("place").cast("string")),
    }).drop("_won", "_w", "_listed")
    basic = lines.join(pages.where(F.contains(compact(F.col("text")), F.lit(BASIC_FACTS))).select("doc_path", "page_number"), ["doc_path", "page_number"], "left_semi")
    squeezed = no_space(clean(F.col("text")))
    credible = F.length(squeezed).between(6, 120) & has_any(squeezed, PROJECT_WORDS) & ~has_any(squeezed, FACT_LABELS)
    right = scratch.keep(P.value_right_of(basic, F.col("c") == "工程名称", credible), "right")
    meta = metadata(lines).join(right, "doc_path", "left").withColumn("project_name", F.coalesce(plain_project(F.col("value")), "project_name"))
    made = records(found, lines, meta.drop("value"), unknown_needs_review=True)
    known = lines.select(F.col("doc_path").alias("source_path")).distinct()
    for df, name in ((right, "_basic"), (targets, "_table"), (won, "_first")):
        known = known.join(df.select(F.col("doc_path").alias("source_path")).distinct().withColumn(name, F.lit(True)), "source_path", "left")
    note = F.concat(
        F.when(F.col("_table").isNull(), "未定位投标人排序及推荐的中标候选人表；").when(F.col("_first").isNull(), "未识别推荐的中标候选人第一名；").otherwise(""),
        F.when(F.col("_basic").isNull(), "未从基本情况一览表工程名称提取项目名称；").otherwise(""),
    )
    out = made.join(known, "source_path").withColumn("_note", note)
    return out.withColumns({
        "evidence": F.when(F.col("_note") != "", F.left(F.concat("_note", "evidence"), F.lit(300))).otherwise(F.col("evidence")),
        "review_status": F.when(F.col("_note") != "", REVIEW).otherwise(F.col("review_status")),
    }).select(*made.columns)


def title_project(lines: DataFrame) -> DataFrame:
    """(doc_path, project_name): the title before the publication's name, among the first page's first 40 lines; on one line, or else on two.

    A title that goes on from another candidate has residue of the layout and goes; then one line before two, and the nearest to a code's label.
    """
    # One order for all windows; what can't hold the publication's name, with the next line, is not searched by patterns.
    first = Window.partitionBy("doc_path").orderBy(*ORDER)
    rows = lines.select("doc_path", *ORDER, "text", "c").withColumn("_p", F.first("page_number").over(first)).where(F.col("page_number") == F.col("_p")).where(clean(F.col("text")) != "")
    rows = rows.withColumn("_n", F.row_number().over(first)).where("_n <= 40")
    coded_at = F.collect_list(F.when(has_any(F.col("c"), [compact_word(x) for x in CODE]), F.col("_n"))).over(first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = rows.withColumns({"codes": coded_at, "next": F.lead("text").over(first), "_c": F.concat("c", F.coalesce(F.lead("c").over(first), F.lit("")))}).where(F.contains("_c", F.lit(CANDIDATES)))
    squeeze = lambda x: F.regexp_replace(no_space(x), "^[ ：:，,。]+|[ ：:，,。]+$", "")
    printed = lambda x: F.regexp_replace(squeeze(F.regexp_replace(x, r"^\s*\d{4}/\d{1,2}/\d{1,2}\s+\d{1,2}:\d{2}\s*", "")), r"^\d{4}/\d{1,2}/\d{1,2}\d{1,2}:\d{2}(?=\D|$)", "")
    rows = rows.withColumn("own", squeeze(F.col("text")))
    joined = F.when(~F.contains("own", F.lit(CANDIDATES)) & (F.length("own") > 1) & F.col("next").isNotNull(), printed(F.concat_ws("\n", "text", "next")))
    both = F.filter(F.array(F.struct(F.lit(0).alias("two"), printed(F.col("text")).alias("t")), F.struct(F.lit(1).alias("two"), joined.alias("t"))), lambda x: F.contains(x["t"], F.lit(CANDIDATES)))
    made = rows.select("doc_path", "_n", "codes", F.explode(both).alias("z")).select(
        "doc_path", "_n", "codes", "z.two", F.substring_index("z.t", CANDIDATES, 1).alias("body"), squeeze(F.regexp_replace("z.t", f"^.*?{CANDIDATES}", "")).alias("tail"))
    plain = (F.col("tail") == "") | F.col("tail").isin(*TITLE_TAILS) | F.regexp_like("tail", F.lit("^[（(]二次[）)]$"))
    fits = (F.length(squeeze(F.col("body"))) >= 6) & F.regexp_like("body", F.lit("[一-鿿]")) & ~F.contains("body", F.lit(">")) & ~has_any(F.col("body"), TITLE_CHROME)
    gap = F.coalesce(F.array_min(F.transform("codes", lambda x: F.abs(x - F.col("_n")))), F.lit(1000))
    bodies = made.where(plain & fits).groupBy("doc_path", "body").agg(F.min(F.struct("two", gap.alias("gap"))).alias("at"))
    others = bodies.select("doc_path", F.col("body").alias("shorter"))
    residue = bodies.join(others, "doc_path").where((F.col("body") != F.col("shorter")) & F.startswith("body", "shorter")).select("doc_path", "body").distinct()
    best = bodies.join(residue, ["doc_path", "body"], "left_anti")
    return best.groupBy("doc_path").agg(F.min_by("body", F.struct("at", F.length("body"))).alias("project_name"))


def compact_word(word: str) -> str:
    """A label as compact() leaves it."""
    return word.translate({ord(c): None for c in "()（）"})


def bid_candidates(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """The score table's companies; the one said to win, else the first, won. Records without a title are to be reviewed."""
    listed = score_table.occurrences(lines, pages)
    said = explicit(lines, ("拟定中标人", "第一中标候选人")).select("doc_path", F.col("name_key").alias("_said"))
    first = F.max(F.when(F.col("place") == 1, F.col("name_key"))).over(Window.partitionBy("doc_path"))
    found = listed.withColumn("_first", first).join(said, "doc_path", "left").withColumn("_won", F.coalesce("_said", "_first"))
    found = found.withColumns({"award_status": F.when(F.col("name_key") == F.col("_won"), "是").otherwise("否"), "rank": F.when(F.col("name_key") == F.col("_won"), "1").otherwise(F.col("place").cast("string"))}).drop("_won", "_said", "_first")
    meta = metadata(lines).drop("project_name").join(title_project(lines), "doc_path", "left").withColumn("_s", code_and_lot(F.col("project_code")))
    made = records(found, lines, meta.select("doc_path", "project_name", F.col("_s.project").alias("project_code"), F.col("_s.lot").alias("lot_code"), "lot_name"))
    untitled = F.left(F.concat(F.lit("未识别到首页中标候选人公示标题；"), F.col("evidence")), F.lit(300))
    return made.withColumn("evidence", F.when(F.col("project_name") == "", untitled).otherwise(F.col("evidence")))


def archive_list(lines: DataFrame) -> DataFrame:
    """Participants (as occurrences) of the lists in archives: on each page the text from the first list marker up to the next heading, put together over its lines, so
    that names broken at a line's end are whole, then cut at separators. Each name once, in order; its evidence is the list's lines."""
    c = F.col("c")
    order = Window.partitionBy("doc_path", "page_number").orderBy("line")
    before, upto = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    marker = F.coalesce(*[F.when(F.contains(c, F.lit(m)), F.lit(m)) for m in LIST_MARKERS])
    rows = lines.withColumns({"_c": c, "_flat": no_space(F.coalesce("text", F.lit("")))}).withColumn("_m", marker)
    rows = rows.withColumn("_in", F.coalesce(F.max(F.col("_m").isNotNull()).over(before), F.lit(False)))
    rows = rows.withColumn("_out", F.max(F.col("_in") & F.regexp_like("_c", F.lit(A_HEADING))).over(upto))
    first = F.expr("substring(_flat, locate(_m, _c) + length(_m))")
    rows = rows.withColumn("_part", F.when(F.col("_in"), F.col("_flat")).otherwise(first)).where("(_in or _m is not null) and not _out")
    shown = F.when(F.col("_in") | (F.col("_part") != ""), clean(F.col("text"))).otherwise("")
    parts = F.array_sort(F.collect_list(F.struct("line", F.col("_part").alias("part"), shown.alias("shown"))))
    lists = rows.groupBy("doc_path", "page_number").agg(parts.alias("p"), F.min("line").alias("line"), F.first("method").alias("method"))
    whole = lambda name: F.array_join(F.transform("p", lambda x: x[name]), "")
    joined = F.regexp_replace(whole("part"), "^[ ：:]+|[ ：:]+$", "")
    trust = lines.where(clean(F.col("text")) != "").groupBy("doc_path", "page_number").agg(F.min("confidence").alias("confidence"))
    lists = lists.select("doc_path", "page_number", "line", "method", F.left(whole("shown"), F.lit(300)).alias("evidence"), F.split(nfkc(joined), SEPARATORS).alias("f")).join(trust, ["doc_path", "page_number"])
    found = lists.select("*", F.posexplode(F.flatten(F.transform("f", lambda x: names_in(x, True)))).alias("pos", "name")).withColumn("name_key", folded(F.col("name"))).where("name_key <> ''")
    once = found.withColumn("_r", F.row_number().over(Window.partitionBy("doc_path", "name_key").orderBy(*ORDER, "pos"))).where("_r = 1")
    return once.select("doc_path", "name", "name_key", "page_number", "line", "pos", "evidence", "confidence", "method", F.row_number().over(Window.partitionBy("doc_path").orderBy(*ORDER, "pos")).alias("place"))


def archive_metadata(lines: DataFrame) -> DataFrame:
    """(doc_path, project_name, project_code, lot_code, lot_name): the lot's name is the project's too; the code is the lot's, else the project's."""
    wanted = ((LOT, "_lot"), (LOT_FALLBACK, "_other"), (LOT_CODE, "_code"), (CODE, "_any"))
    rows = with_words(in_order(lines), [w for labels, _ in wanted for w in labels]).withColumns({name: value_behind(labels) for labels, name in wanted})
    found = rows.groupBy("doc_path").agg(*[first_value(name).alias(name) for _, name in wanted])
    out = lines.select("doc_path").distinct().join(found, "doc_path", "left")
    filled = lambda *names: F.coalesce(*[F.nullif(F.col(n), F.lit("")) for n in names], F.lit(""))
    named = F.coalesce(F.nullif(plain_project(filled("_lot")), F.lit("")), plain_project(filled("_other")))
    raw = filled("_code", "_any")
    code = code_and_lot(F.coalesce(F.nullif(F.regexp_extract(raw, A_DASHED_CODE, 0), F.lit("")), raw))
    return out.withColumn("_s", code).select("doc_path", named.alias("project_name"), F.col("_s.project").alias("project_code"), F.col("_s.lot").alias("lot_code"), named.alias("lot_name"))


def archive_info(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """Participants of an archive's lists, else the bidders on participants' pages, and the winner, each once, names held to the strict form."""
    key, scratch = ["doc_path", "page_number"], Scratch(lines.sparkSession)
    kinds = pages.select(*key, compact(F.col("text")).alias("_c")).select(*key, has_any(F.col("_c"), WINNER_PAGES).alias("_w"), has_any(F.col("_c"), PARTICIPANT_PAGES).alias("_t"))
    kinds = kinds.groupBy(*key).agg(F.max("_w").alias("_w"), F.max("_t").alias("_t")).where("_w or _t")
    named = scratch.keep(with_names(lines, True).join(kinds, key), "named")
    won = scratch.keep(first_named(named.where("_w"), ("中标人", "中标单位")), "won")
    listed = scratch.keep(archive_list(lines), "listed")
    other = once_each(named.where("_t and _bid").select(*key, "line", "evidence", "confidence", "method", F.posexplode("_names").alias("pos", "name")).join(listed.select("doc_path").distinct(), "doc_path", "left_anti"))
    took = listed.unionByName(other).withColumn("_w", F.lit(False))
    # A winner that took part anyway is that row; rows of a document are dealt out once for both windows.
    rows = took.unionByName(won.withColumns({"place": F.lit(1 << 30), "_w": F.lit(True)})).repartition("doc_path")
    rows = rows.withColumn("_won", F.max(F.when(F.col("_w"), F.col("name_key"))).over(Window.partitionBy("doc_path"))).withColumn("_also", F.min("_w").over(Window.partitionBy("doc_path", "name_key")))
    found = rows.where("not _w or _also").withColumn("award_status", F.when(F.col("_won").isNull(), "未知").when(F.col("name_key") == F.col("_won"), "是").otherwise("否")).drop("_won", "_w", "_also")
    made = records(found, lines, archive_metadata(lines), unknown_needs_review=True)
    uncoded = (F.col("project_code") == "") & (F.col("lot_code") == "")
    return made.withColumn("review_status", F.when(uncoded, REVIEW).otherwise(F.col("review_status")))


def tender_cover(lines: DataFrame) -> DataFrame:
    """One record: the cover's bidder, else the first organisation, else one in the file's name; the award is told by the path."""
    read = cover.fields(lines)
    key = fold_brackets(F.col("name"))
    bidder = read.where("name is not null").select("doc_path", "name", key.alias("name_key"), F.left("company", F.lit(300)).alias("_company"))
    seen = F.contains(folded(F.col("nf")), F.col("name_key"))
    at = F.struct((~seen).alias("unseen"), *ORDER)
    said = lines.join(bidder, "doc_path").groupBy("doc_path", "name", "name_key", "_company").agg(F.min(F.struct(at.alias("at"), F.left(clean(F.col("text")), F.lit(300)).alias("evidence"), "confidence", "page_confidence", "method")).alias("m"))
    unseen = F.col("m.at.unseen")
    said = said.select("doc_path", "name", "name_key", F.col("m.at.page_number").alias("page_number"), F.col("m.at.line").alias("line"), F.lit(0).alias("pos"), F.when(unseen, F.col("_company")).otherwise(F.col("m.evidence")).alias("evidence"),
                       F.when(unseen, F.col("m.page_confidence")).otherwise(F.col("m.confidence")).alias("confidence"), F.col("m.method").alias("method"))
    first = occurrences(lines).where("place = 1").drop("place").join(said.select("doc_path"), "doc_path", "left_anti")
    found = said.unionByName(first)
    named = lines.select("doc_path").distinct().join(found.select("doc_path"), "doc_path", "left_anti").withColumn("_n", F.get(company_names(stem(F.col("doc_path"))), F.lit(0))).where("_n is not null")
    named = named.select("doc_path", F.col("_n").alias("name"), fold_brackets(F.col("_n")).alias("name_key"), F.lit(1).alias("page_number"), F.lit(0).alias("line"), F.lit(0).alias("pos"), stem(F.col("doc_path")).alias("evidence"), F.lit(0.85).alias("confidence"), F.lit("filename").alias("method"))
    found = found.unionByName(named).withColumns({"award_status": award_from_path(F.col("doc_path")), "place": F.lit(1)})
    own = read.select("doc_path", F.col("project_name").alias("_p"), F.col("project_code").alias("_c"), F.col("lot_code").alias("_l"), F.col("lot_name").alias("_s"))
    either = lambda a, b: F.when(F.col(a) != "", F.col(a)).otherwise(F.col(b))
    meta = metadata(lines).join(own, "doc_path").select(
        "doc_path", either("_p", "project_name").alias("project_name"), either("_c", "project_code").alias("project_code"), F.col("_l").alias("lot_code"),
        F.when((F.col("_c") != "") | (F.col("_s") != ""), F.col("_s")).otherwise(F.col("lot_name")).alias("lot_name"),
    )
    return records(found, lines, meta, unknown_needs_review=True)


#: The extension point: a category and its plan over the lines table.
REGISTRY = {f.__name__: f for f in (tender_cover, bid_evaluation_report, bid_candidates, award_notice, bid_announcement, bid_list, archive_info)}

#: Plans that don't look at where on a page a line is.
UNPLACED = (tender_cover, award_notice, bid_announcement, archive_info)


def extract(pages: DataFrame, categories=None, registry=None) -> DataFrame:
    """Records of all documents, each category by its plan. An unknown category is an error."""
    registry = registry or REGISTRY
    wanted = list(registry) if categories is None else list(categories)
    if unknown := set(wanted) - set(registry):
        raise ValueError(f"unknown categories: {sorted(unknown)}")
    # Each plan reads the lines several times, so they are made once and written; pages only where a plan reads them too.
    scratch, out = Scratch(pages.sparkSession), None
    several = [name for name in wanted if "pages" in inspect.signature(registry[name]).parameters]
    pages = scratch.keep(pages, "pages") if several else pages
    rows = P.lines(pages).where(F.col("category").isin(wanted))
    if all(registry[name] in UNPLACED for name in wanted):
        rows = rows.drop(*P.PLACES)
    rows = scratch.keep(rows, "lines")
    for name in wanted:
        plan, own = registry[name], rows.where(F.col("category") == name)
        made = plan(own, pages.where(F.col("category") == name)) if len(inspect.signature(plan).parameters) > 1 and "pages" in inspect.signature(plan).parameters else plan(own)
        out = made if out is None else out.unionByName(made)
    return out


def failures(documents: DataFrame, error: str = "error") -> DataFrame:
    """Documents that could not be read become records to be reviewed."""
    return documents.where(F.col(error).isNotNull()).select(F.col("doc_path").alias("source_path"), F.lit("unknown").alias("category"), F.lit(REVIEW).alias("review_status"), F.col(error).alias("evidence"))
