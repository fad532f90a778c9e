"""Fields of tender covers: project, codes, lot and bidder, read from the lines of a cover as one array.

A cover is at most five pages (``pages.pages_to_read``), so its lines fit a row; every rule is an expression over that array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.display import cover_text, without_label, without_stamp
from ..functions.documents import BIDDER_LABELS, CODE_LABELS, PROJECT_LABELS
from ..functions.text import let, names_in, nfkc, no_space

#: Words of project titles, titles that say nothing, and what a title never has.
TITLE_WORDS = ("高标准农田建设改造提升项目", "高标准农田建设工程", "高标准农田建设项目", "建设改造提升项目", "生态综合整治项目", "水利基建项目", "农田建设项目", "改造提升项目", "建设项目", "建设工程", "水利工程", "整治工程")
GENERIC_TITLES = ("建设工程", "建设项目", "水利工程", "整治工程", "施工")
TITLE_STOPS = ("投标文件", "参与文件", *BIDDER_LABELS, "法定代表人", "其委托代理人", "日期")
#: Hints of a form's blanks, kinds of document, and labels that end a title.
HINTS = ("(工程项目名称)", "(工程名称)", "(标段名称)", "工程项目名称", "标段名称")
KINDS = ("投标文件", "参与文件", "商务标", "技术标", "资格审查资料")
TITLE_ENDS = ("投标文件内容", "投标文件", "参与文件", "投标人名称", "投标人", "参与单位", "法定代表人", "其委托代理人", "日期")
#: The forms of hints, codes, sections and organisation names on covers.
HINT = r"[（(【\[]?(?:工程项目名称|工程名称|项目名称|标段名称)[）)】\]]?"
A_CODE = r"[A-Za-z0-9][A-Za-z0-9_\-/]{5,}"
SECTION = r"第?[一二三四五六七八九十0-9]{1,3}(?:标段|合同段|施工标)"
COMPANY = r"[一-鿿A-Za-z0-9（）()·&\-]{2,80}?(?:有限责任公司|股份有限公司|集团有限公司|有限公司|研究院|研究所|集团|公司)"


def trimmed(value: Column) -> Column:
    return F.regexp_replace(value, "^[_:：]+|[_:：]+$", "")


def starts(value: Column, words) -> Column:
    return F.regexp_like(value, F.lit("^(?:" + "|".join(words) + ")"))


def has_any(value: Column, words) -> Column:
    return F.regexp_like(value, F.lit("|".join(words)))


def is_code(value: Column) -> Column:
    return F.regexp_like(value, F.lit(f"^{A_CODE}$"))


def is_hint(line: Column) -> Column:
    """A blank's hint that stands on a line of its own."""
    return line.isin(*HINTS)


def is_noise(line: Column) -> Column:
    """A line that is no part of a title: kind of document, field, hint, page number, date, name of the bidding system."""
    system = F.regexp_like(line, F.lit("新点网|网上招投标系统|新点.*招投标系统|招投标系统.*新点"))
    return system | line.isin("", *KINDS) | starts(line, TITLE_STOPS) | is_hint(line) | F.regexp_like(line, F.lit(r"^(?:第?\d+页[/／共\d页+]*|\d{4}年\d{1,2}月\d{1,2}日)$"))


def has_title_word(value: Column) -> Column:
    return ~value.isin(*GENERIC_TITLES) & (has_any(value, TITLE_WORDS) | F.regexp_like(value, F.lit("高标准农田.*(?:项目|工程)")))


def is_title(value: Column) -> Column:
    """A whole project name: a title's word, and neither a bidder, a kind of document nor a code."""
    return let(value, lambda v: has_title_word(v) & ~has_any(v, TITLE_STOPS) & ~F.regexp_like(v, F.lit(A_CODE)))


def if_title(value: Column) -> Column:
    """The value if it is a title, else null."""
    return let(value, lambda v: F.when(is_title(v), v))


def filled(value: Column) -> Column:
    """The value if it is not empty, else null."""
    return let(value, lambda v: F.when(v != "", v))


def bare_title(value: Column) -> Column:
    """A title without hints, labels, what follows it, and the kind of document."""
    out = trimmed(no_space(value))
    for label in TITLE_ENDS:
        out = F.regexp_replace(out, f"^(?!{label})(.+?){label}.*$", "$1")
    for rest in (HINT, "^(?:项目名称|工程名称|招标项目名称)[:：]*", "(?:工程)?施工招标$", "招标文件$", "(?:投标|参与)文件$", "(?:商务标|技术标)$"):
        out = F.regexp_replace(out, rest, "")
    return trimmed(out)


def hits(lines: Column, labels, first_only: bool) -> Column:
    """array<struct<at,tail>>: lines with a label and what follows it, by line and label. A label that is a hint's part does not count."""
    before = lambda w: f"(?:(?!{w}).)*" if first_only else ".*?"
    pattern = {w: f"^{before(w)}(?<!工程|标段){w}(?![)）])(.*)$" for w in labels}

    def of_line(x: Column, i: Column) -> Column:
        found = [F.when(F.regexp_like(x, F.lit(p)), F.struct(i.alias("at"), trimmed(F.regexp_extract(x, p, 1)).alias("tail"))) for p in pattern.values()]
        return F.filter(F.array(*found), lambda h: h.isNotNull())

    return F.flatten(F.transform(lines, of_line))


def after(lines: Column, at: Column, n: int) -> Column:
    """What is on the ``n`` lines after a hit, but for blank ones."""
    return F.filter(F.transform(F.slice(lines, at + 2, n), trimmed), lambda x: x != "")


def value_of(lines: Column, labels, stops=(), n: int = 2) -> Column:
    """What follows a label on its line, else the next line of ``n``; empty if that is another field."""
    def of_hit(h: Column) -> Column:
        following = let(F.get(after(lines, h["at"], n), F.lit(0)), lambda x: F.when(starts(x, stops), "").otherwise(x))
        return F.when(h["tail"] != "", h["tail"]).otherwise(following)

    return F.coalesce(F.get(F.filter(F.transform(hits(lines, labels, False), of_hit), lambda x: x.isNotNull()), F.lit(0)), F.lit(""))


def joined_value(lines: Column, labels, stops=(), n: int = 3) -> Column:
    """What follows a label on its line and up to ``n`` lines more, until another field."""
    empty = F.struct(F.lit(False).alias("done"), F.lit("").alias("text"))

    def more(a: Column, x: Column) -> Column:
        done = a["done"] | starts(x, stops)
        return F.struct(done.alias("done"), F.when(done, a["text"]).otherwise(F.concat(a["text"], x)).alias("text"))

    values = F.transform(F.slice(hits(lines, labels, True), 1, 1), lambda h: F.concat(h["tail"], F.aggregate(after(lines, h["at"], n), empty, more, lambda a: a["text"])))
    return F.coalesce(F.get(values, F.lit(0)), F.lit(""))


def top_title(lines: Column) -> Column:
    """The title above the kind of document or the code; empty if it is none."""
    def step(a: Column, x: Column) -> Column:
        done = a["done"] | starts(x, KINDS[:2]) | has_any(x, CODE_LABELS) | is_code(x) | (is_noise(x) & ~is_hint(x) & (a["text"] != ""))
        return F.struct(done.alias("done"), F.when(done | is_noise(x), a["text"]).otherwise(F.concat(a["text"], x)).alias("text"))

    text = F.aggregate(F.filter(lines, lambda x: x != ""), F.struct(F.lit(False).alias("done"), F.lit("").alias("text")), step, lambda a: bare_title(a["text"]))
    return F.coalesce(if_title(text), F.lit(""))


def title_before_code(lines: Column, limit: int = 40) -> Column:
    """The first title that can be joined from the lines above a code's label, going up to the nearest line with a title's word."""
    full = F.filter(lines, lambda x: x != "")
    places = F.filter(F.transform(full, lambda x, i: F.when(has_any(x, CODE_LABELS), i)), lambda i: i.isNotNull())

    def step(a: Column, x: Column) -> Column:
        stop = has_any(x, (*BIDDER_LABELS, "法定代表人", "日期"))
        skip = is_noise(x) | (F.length(x) <= 3) | is_code(x)
        done = a["done"] | stop | (~skip & has_title_word(x))
        return F.struct(done.alias("done"), F.when(a["done"] | stop | skip, a["text"]).otherwise(F.concat(x, a["text"])).alias("text"))

    def above(i: Column) -> Column:
        up = F.reverse(F.slice(full, F.greatest(i - limit, F.lit(0)) + 1, F.least(i, F.lit(limit))))
        return F.aggregate(up, F.struct(F.lit(False).alias("done"), F.lit("").alias("text")), step, lambda a: bare_title(a["text"]))

    return F.coalesce(F.get(F.filter(F.transform(places, above), is_title), F.lit(0)), F.lit(""))


def project_name(lines: Column) -> Column:
    """The labelled name, else the title at the top, else the one before a code."""
    stops = (*CODE_LABELS, "投标文件内容", "投标文件", "参与文件", *BIDDER_LABELS, "法定代表人", "日期")
    made = [bare_title(x) for x in (joined_value(lines, PROJECT_LABELS, stops), top_title(lines), title_before_code(lines))]
    return F.coalesce(*[if_title(x) for x in made], F.lit(""))


def chinese_section(lines: Column) -> Column:
    """The lot as words: of a labelled name, of the title, of any text."""
    stops = ("投标文件内容", "投标文件", "参与文件", "投标人", "参与单位", "日期")
    texts = (joined_value(lines, ("标段名称", "项目名称", "工程名称"), stops), top_title(lines), F.array_join(lines, ""))
    return F.coalesce(*[filled(F.regexp_extract(x, SECTION, 0)) for x in texts], F.lit(""))


def section(lines: Column) -> Column:
    """The labelled code, else the lot as words."""
    stops = ("项目名称", "工程名称", "投标文件", "参与文件", "投标人", "参与单位", "日期")
    code = F.regexp_extract(value_of(lines, CODE_LABELS, stops), A_CODE, 0)
    return F.coalesce(filled(code), chinese_section(lines))


def without_section(name: Column, lot: Column) -> Column:
    """A project name without its lot and what follows that; the name itself if nothing else is left."""

    def cut(n: Column, s: Column) -> Column:
        ends = [F.concat(s, F.lit(end)) for end in ("工程施工招标", "施工招标", "工程", "")]
        short = F.coalesce(*[F.when(F.endswith(n, e), F.left(n, F.length(n) - F.length(e))) for e in ends])
        return F.when(F.regexp_like(s, F.lit(f"^{SECTION}$")), F.coalesce(filled(short), n)).otherwise(n)

    return let(bare_title(name), lambda n: cut(n, no_space(lot)))


def code_parts(value: Column) -> Column:
    """struct<project, lot>: the code before the first dash, and the whole code; upper case, one kind of dash."""
    lot = F.translate(F.upper(no_space(value)), "－—–", "---")
    return F.struct(F.substring_index(lot, "-", 1).alias("project"), lot.alias("lot"))


def company(lines: Column) -> Column:
    """The organisation behind a bidder's label, else on the first line that has one."""
    name = lambda x: F.regexp_extract(without_label(without_stamp(x)), COMPANY, 0)
    labelled = name(value_of(lines, BIDDER_LABELS, ("法定代表人", "其委托代理人", "日期"), 1))
    rest = F.get(F.filter(F.transform(lines, name), lambda x: x != ""), F.lit(0))
    return F.coalesce(filled(labelled), rest, F.lit(""))


def fields(lines: DataFrame) -> DataFrame:
    """(doc_path, project_name, project_code, lot_code, lot_name, company, name) of each cover; empty text for what is not found, a null name for no bidder."""
    text = F.replace(no_space(nfkc(cover_text(F.coalesce("text", F.lit(""))))), F.lit("\x00"), F.lit(""))
    rows = lines.select("doc_path", "page_number", "line", text.alias("t"))
    docs = rows.groupBy("doc_path").agg(F.array_sort(F.collect_list(F.struct("page_number", "line", "t"))).alias("l"))
    docs = docs.select("doc_path", F.transform("l", lambda x: x["t"]).alias("l"))
    read = docs.select("doc_path", project_name(F.col("l")).alias("_title"), section(F.col("l")).alias("_section"), company(F.col("l")).alias("company"))
    coded, parts = is_code(F.col("_section")), code_parts(F.col("_section"))
    return read.select(
        "doc_path", without_section(F.col("_title"), F.col("_section")).alias("project_name"), F.when(coded, parts["project"]).otherwise("").alias("project_code"),
        F.when(coded, parts["lot"]).otherwise("").alias("lot_code"), F.when(coded, "").otherwise(F.col("_section")).alias("lot_name"), "company", F.get(names_in(F.col("company")), F.lit(0)).alias("name"),
    )
