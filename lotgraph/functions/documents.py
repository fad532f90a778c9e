"""What a file or a page is, from its path and its text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .display import without_label, without_stamp
from .text import clean, compact, has_any, no_space, readable

#: File names by category, in order of precedence.
FILE_KEYWORDS = (
    ("award_notice", ("中标通知书", "awardnotice")),
    ("bid_announcement", ("中标人公告", "bidannouncement")),
    ("bid_candidates", ("中标候选人", "中标公示", "bidcandidates")),
    ("bid_evaluation_report", ("评标报告", "bidevaluationreport")),
    ("bid_list", ("投标单位名单", "bidlist")),
    ("archive_info", ("备案", "归档", "archiveinfo", "archivedinfo")),
)
#: Folder names by category.
FOLDERS = {"tender_cover": "tender_cover", "bid_evaluation_report": "bid_evaluation_report", "bid_candidates": "bid_candidates", "award_notice": "award_notice",
           "bid_announcement": "bid_announcement", "bid_list": "bid_list", "archive_info": "archive_info", "archived_info": "archive_info"}
#: Names, folders, titles and fields of covers.
COVER_STEMS = ("封面", "1")
COVER_PATH = ("第一信封", "第一封信", "投标文件", "中标单位", "未中标")
COVER_TITLES = ("投标文件", "参与文件")
COVER_FIELDS = ("项目名称", "项目编号", "投标人", "参与单位")
#: Marks of a cover page, by kind.
PROJECT_LABELS = ("项目名称", "工程名称", "招标项目名称")
CODE_LABELS = ("标段编号", "项目编号", "招标编号", "交易编号", "编号")
BIDDER_LABELS = ("投标人名称", "投标单位名称", "投标人", "参与单位")
#: What the pages of an archive that matter have.
ARCHIVE_KEYWORDS = ("中标通知书", "成交通知书", "推荐的中标候选人", "招投标情况书面报告", "招投标基本情况报告", "原件确认签收表", "项目负责人答辩评分表", "按时送达投标文件的投标人名单")
#: Endings of complete organisation names and their scores.
ENDING_SCORES = (("有限责任公司", 50.0), ("股份有限公司", 50.0), ("集团有限公司", 48.0), ("有限公司", 45.0), ("股份公司", 42.0), ("集团公司", 42.0), ("研究院", 38.0), ("研究所", 38.0), ("集团", 32.0), ("公司", 25.0))


def stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def folders(path: Column, root: str = "") -> Column:
    """The folders between the root and the file."""
    inside = F.when(path.startswith(root), F.substr(path, F.lit(len(root) + 1))).otherwise(path)
    parts = F.filter(F.split(inside, "/"), lambda x: x != "")
    return F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))


def is_cover_text(text: Column) -> Column:
    t = compact(text)
    fields = sum((F.contains(t, F.lit(w)).cast("int") for w in COVER_FIELDS), F.lit(0))
    return has_any(t, COVER_TITLES) | (fields >= 2)


def classify(path: Column, page_count: Column, first_page: Column, root: str = "") -> Column:
    """The category of a file: by name, by the innermost known folder, as a short cover, or unknown."""
    name = F.lower(clean(stem(path)))
    target = compact(name)
    by_name = F.lit(None).cast("string")
    for category, words in reversed(FILE_KEYWORDS):
        by_name = F.when(has_any(target, words), category).otherwise(by_name)
    inside = folders(path, root)
    alias = F.create_map(*[F.lit(x) for kv in FOLDERS.items() for x in kv])
    by_folder = F.get(F.filter(F.transform(F.reverse(inside), lambda x: F.element_at(alias, F.lower(x))), lambda x: x.isNotNull()), F.lit(0))
    joined = compact(F.array_join(inside, "/"))
    cover = (
        F.when(~name.isin(*COVER_STEMS) | ~page_count.between(1, 3), "unknown").when(name == "封面", "tender_cover")
        .when(F.coalesce(F.element_at(inside, -1), F.lit("")) == "施工组织设计", "unknown")
        .when(has_any(joined, COVER_PATH) | is_cover_text(first_page), "tender_cover").otherwise("unknown")
    )
    return F.coalesce(by_name, by_folder, cover)


def award_from_path(path: Column) -> Column:
    """否 before 是, as the word for lost contains the word for won."""
    t = compact(path)
    return F.when(F.contains(t, F.lit("未中标")), "否").when(has_any(t, ("中标单位投标文件", "中标资料")), "是").otherwise("未知")


def cover_marks(text: Column) -> Column:
    t = no_space(clean(text))
    return sum((F.contains(t, F.lit(w)).cast("int") for w in (*PROJECT_LABELS, *CODE_LABELS, "投标文件", *BIDDER_LABELS)), F.lit(0))


def needs_ocr(text: Column) -> Column:
    return (F.length(no_space(clean(text))) < 30) | (cover_marks(text) == 0)


def bare_name(name: Column) -> Column:
    """A name without seals, labels and spaces."""
    return without_label(without_stamp(name))


def complete_company(name: Column) -> Column:
    """The name ends like an organisation's; the plain ending for companies is no proof."""
    return F.regexp_like(bare_name(name), F.lit("(?:" + "|".join(w for w, _ in ENDING_SCORES if w != "公司") + ")$"))


def fragmented(text: Column, mean_score: Column, company: Column) -> Column:
    return needs_ocr(text) | ~complete_company(company) | (mean_score < 0.45)


def cover_score(text: Column, mean_score: Column, company: Column) -> Column:
    return cover_marks(text) * 20 + F.when(clean(company) != "", 15).otherwise(0) + F.least(F.length(no_space(clean(text))), F.lit(240)) * 0.2 + mean_score * 10


def company_score(name: Column, confidence: Column) -> Column:
    n = bare_name(name)
    ending = F.lit(0.0)
    for word, score in reversed(ENDING_SCORES):
        ending = F.when(n.endswith(word), score).otherwise(ending)
    return ending + F.least(F.length(n), F.lit(30)) * 0.2 + F.greatest(F.lit(0.0), F.least(confidence, F.lit(1.0))) * 20


def native_is_enough(text: Column) -> Column:
    """The text layer is readable, so the page needs no recognition."""
    return readable(text)
