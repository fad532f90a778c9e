"""Texts of the report: project names, coloured companies, evidence lines; progress read from log lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean, markdown_cell, no_space

#: Percent at the start of a stage.
STAGE_PERCENT = (8, 38, 62, 76, 90)
#: Colours by whether a company won.
WINNER, LOSER = "#c00000", "#1f4e79"


def without(value: Column, hidden: str) -> Column:
    """The text without a configured part."""
    return F.replace(clean(value), F.lit(hidden), F.lit("")) if hidden else clean(value)


def project_title(name: Column, lot: Column) -> Column:
    """The project's name with its lot's code, if it has one."""
    n, code = clean(name), clean(lot)
    return F.when(code != "", F.concat(n, F.lit("（标段："), code, F.lit("）"))).otherwise(n)


def company_span(name: Column, at_risk: Column, won: Column) -> Column:
    """A company in a risk is coloured by whether it won; others are plain."""
    cell = markdown_cell(name)
    span = lambda colour: F.concat(F.lit(f'<span style="color:{colour}">'), cell, F.lit("</span>"))
    return F.when(~F.coalesce(at_risk, F.lit(False)), cell).when(F.coalesce(won, F.lit(False)), span(WINNER)).otherwise(span(LOSER))


def evidence_line(items: Column) -> Column:
    """Distinct values and, in brackets, distinct sources of array<struct<display, source>>."""
    values = F.array_distinct(F.filter(F.transform(items, lambda x: clean(x["display"])), lambda x: x != ""))
    sources = F.array_sort(F.array_distinct(F.transform(items, lambda x: x["source"])))
    return F.concat(F.array_join(values, "、"), F.lit("（"), F.array_join(sources, "、"), F.lit("）"))


def log_percent(lines: Column, start: int = 0) -> Column:
    """The furthest progress that log lines show: stages, and files done within the first."""
    stage = lambda l: F.get(F.array(*[F.lit(p) for p in STAGE_PERCENT]), F.regexp_extract(l, r"\[阶段\s+([1-5])/5\]", 1).try_cast("int") - 1)
    part = lambda l, k: F.regexp_extract(l, r"(?:处理完成|完成)\s+(\d+)/(\d+)", k).try_cast("long")
    files = lambda l: F.when(part(l, 2) > 0, F.least(F.lit(36), 8 + F.floor(28 * part(l, 1) / part(l, 2))))
    best = F.array_max(F.transform(lines, lambda l: F.greatest(F.coalesce(stage(l), F.lit(0)), F.coalesce(files(l), F.lit(0)))))
    return F.least(F.lit(100), F.greatest(F.lit(start), F.coalesce(best, F.lit(0)))).cast("int")


def is_completion_line(line: Column) -> Column:
    """A line that tells that a file of a parallel run is done, and nothing else."""
    return F.regexp_like(line, F.lit(r"^\s*(?:\[[^\]]*\]\s*)?(?:处理完成|完成)\s+\d+/\d+(?:\s+个\s+PDF)?.*$"))


def without_stamp(value: Column) -> Column:
    """A name without the marks of seals."""
    return F.regexp_replace(no_space(clean(value)), r"[（(](?:盖章|公章|单位公章|盖单位章|电子签章|签章)[）)]|[（(]?盖?(?:公章|单位章)[）)]?|(?:盖章|电子签章)$", "")


def without_label(value: Column) -> Column:
    """A name without the bidder's label before it, the label's last character misread or lost included."""
    bare = F.regexp_replace(no_space(clean(value)), "^[_:：]+|[_:：]+$", "")
    return F.regexp_replace(bare, r"^(?:投标人名称|投标单位名称|投标单位|投标人|参与单位|参与单[位立]?|投标单[位立]?)[_:：]*", "")


def cover_text(value: Column) -> Column:
    """Cover text with the usual confusions of recognition set right."""
    text = F.replace(value, F.lit("\r"), F.lit("\n"))
    for wrong, right in {"项且": "项目", "项日": "项目", "项口": "项目", "项旦": "项目", "建没": "建设", "健设": "建设", "高标准农日": "高标准农田", "高标淮农田": "高标准农田", "注苏": "江苏"}.items():
        text = F.replace(text, F.lit(wrong), F.lit(right))
    return text
