"""Text, key and contact expressions. All are built-in column expressions but for NFKC, which Spark lacks."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

#: One explicit class for Unicode white space, so that no engine's idea of \s matters.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0  -     　]"
BLANK_SIGNS = "".join(c for c in map(chr, range(0x3001)) if re.match(SPACE, c))
#: Placeholders that stand for no value.
PLACEHOLDERS = ("", "-", "--", "/", "无", "暂无", "未知", "未披露", "null", "none")
#: Organisation endings, the longest first.
COMPANY_ENDINGS = ("有限责任公司", "股份有限公司", "集团有限公司", "有限公司", "工程公司", "集团公司", "研究院", "研究所", "集团", "公司")
COMPANY = r"[一-鿿A-Za-z0-9（）()·&\-]{2,80}?(?:" + "|".join(COMPANY_ENDINGS) + ")"
#: What every organisation ending has: a text without it has no name, and COMPANY is not tried from each of its signs.
A_NAME = "公司|集团|研究院|研究所"
#: What plain_company cuts off.
NAME_LABEL = r"^.*?(?:中标人|中标单位|投标人名称|投标人|参与单位|单位名称)[:：]?"
ORDINAL = r"^[\d一二三四五六七八九十、.．()（）-]+"
EMAIL = r"(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}"
#: Prices and rates that were read as part of a name.
PRICE_PREFIXES = (
    ("rate_parenthesis", r"费率{s}*[)）]"),
    ("quoted_rate", r"报价费率{s}*[:：]"),
    ("bid_price_unit", r"投标报价{s}*[（(]{s}*元{s}*[)）]{s}*[:：]?"),
    ("bid_price", r"投标报价{s}*[:：]"),
    ("discount_rate", r"下浮率{s}*[:：]"),
)
#: What a name must end with after such a prefix is cut.
NAME_ENDINGS = ("公司", "集团", "企业", "事务所", "中心")


@pandas_udf(StringType())
def nfkc(value: pd.Series) -> pd.Series:
    """Unicode compatibility composition, batch by batch; null stays null."""
    return value.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


def blank_to_empty(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def clean(value: Column) -> Column:
    """Null to empty, NUL removed, white space stripped at both ends."""
    return F.btrim(without_nul(value), F.lit(BLANK_SIGNS))


def without_nul(value: Column) -> Column:
    return F.replace(blank_to_empty(value), F.lit("\x00"), F.lit(""))


def nullable(value: Column) -> Column:
    return F.nullif(clean(value), F.lit(""))


def no_space(value: Column) -> Column:
    return F.regexp_replace(value, f"{SPACE}+", "")


def key_part(value: Column) -> Column:
    """What two spellings of one key share: no white space, lower case, ß as ss."""
    return _same_spelling(without_nul(value))


def _same_spelling(text: Column) -> Column:
    return F.replace(F.lower(no_space(text)), F.lit("ß"), F.lit("ss"))


def person_key(value: Column) -> Column:
    key = key_part(value)
    return F.when(key.isin(*PLACEHOLDERS), "").otherwise(key)


def fingerprint(*parts: Column | str) -> Column:
    """sha256 over the parts' keys, separated by U+001F. Parts are never null, as concat_ws would skip nulls.

    The parts are brought to one spelling in one pass; NUL, which no part has then, keeps them apart until U+001F, which is white space, may stand there.
    """
    joined = F.concat_ws("\x00", *[without_nul(F.lit(p) if isinstance(p, str) else p) for p in parts])
    known = F.sha2(F.replace(_same_spelling(joined), F.lit("\x00"), F.lit("\x1f")), 256)
    return F.coalesce(known, F.lit(""))  # never null, so a join on it needs no filter that computes it again


def confidence(value: Column) -> Column:
    """A number in 0..1; what is no number counts 0."""
    number = F.expr("double(null)") if value is None else value.try_cast("double")
    return F.when(F.isnan(number) | number.isNull(), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), number)))


def first_by_value(items: Column) -> Column:
    """Of array<struct<value,display>> the first element for each value."""
    values = F.transform(items, lambda x: x["value"])
    return F.filter(items, lambda x, i: F.array_position(values, x["value"]) == i + 1)


def phones(value: Column) -> Column:
    """array<struct<value,display>>: 7 to 12 digits each, a leading 86 of 13 digits dropped."""
    digits = lambda p: F.regexp_replace(p, r"(?U)\D", "")
    local = lambda d: F.when((F.length(d) == 13) & d.startswith("86"), F.substring(d, 3, 11)).otherwise(d)
    found = F.transform(F.split(clean(value), r"[,，;；/、|\n]+"), lambda p: F.struct(local(digits(p)).alias("value"), clean(p).alias("display")))
    return first_by_value(F.filter(found, lambda x: F.length(x["value"]).between(7, 12)))


def emails(value: Column) -> Column:
    """array<struct<value,display>>: addresses, lower-cased for comparison."""
    return first_by_value(F.transform(F.regexp_extract_all(clean(value), F.lit(EMAIL), F.lit(0)), lambda x: F.struct(F.lower(x).alias("value"), x.alias("display"))))


def strip_price_prefix(value: Column) -> Column:
    """struct<name, rule>: the name without the first price or rate prefix that it has. Only a cut name must end like an organisation's."""
    name = clean(value)
    out = F.struct(name.alias("name"), F.when(name == "", "invalid_company_name").otherwise("").alias("rule"))
    for rule, pattern in reversed(PRICE_PREFIXES):
        full = f"^{SPACE}*" + pattern.replace("{s}", SPACE) + f"{SPACE}*"
        rest = clean(F.regexp_replace(name, full, ""))
        fits = F.regexp_like(rest, F.lit("(?:" + "|".join(NAME_ENDINGS) + ")$"))
        cut = F.struct(F.when(fits, rest).otherwise("").alias("name"), F.when((rest == "") | fits, rule).otherwise("invalid_company_name").alias("rule"))
        out = F.when(F.regexp_like(name, F.lit(full)) & (rest != name), cut).otherwise(out)
    return out


def shorten(value: Column, limit: int = 500) -> Column:
    text = clean(value)
    return F.when(F.length(text) > limit, F.concat(F.left(text, F.lit(limit)), F.lit("…"))).otherwise(text)


def fold_brackets(value: Column) -> Column:
    """NFKC, ASCII brackets, no white space, no punctuation at the ends: how project and lot texts are compared."""
    return folded(nfkc(blank_to_empty(value)))


def folded(value: Column) -> Column:
    """fold_brackets of a text that is in NFKC already, as names found in such a text are."""
    return F.regexp_replace(no_space(F.translate(value, "（）", "()")), "^[，,。；;:：]+|[，,。；;:：]+$", "")


def compact(value: Column) -> Column:
    """For keyword tests: NFKC without white space, colons, commas, stops, brackets, dashes and underscores."""
    return compacted(nfkc(blank_to_empty(value)))


def compacted(value: Column) -> Column:
    """compact of a text that is in NFKC already."""
    return F.regexp_replace(no_space(value), r"[:：,，。；;()（）\-_]", "")


def company_names(value: Column, strict: bool = False) -> Column:
    """Distinct organisation names in order of appearance."""
    return names_in(nfkc(blank_to_empty(value)), strict)


def names_in(value: Column, strict: bool = False) -> Column:
    """company_names of a text that is in NFKC already; fit for higher-order functions."""
    text = F.replace(value, F.lit(" "), F.lit(""))
    found = F.transform(F.regexp_extract_all(text, F.lit(COMPANY), F.lit(0)), plain_company)
    if strict:
        found = F.transform(found, strict_company)
    return F.when(F.regexp_like(text, F.lit(A_NAME)), F.array_distinct(F.filter(found, lambda x: x != ""))).otherwise(F.array().cast("array<string>"))


def plain_company(name: Column) -> Column:
    """The first organisation name after labels and ordinals; the text itself if that leaves none. ``name`` is a match of COMPANY, so uncut it is its own first name."""

    def found(cut: Column) -> Column:
        return F.when(cut == name, name).otherwise(F.coalesce(F.nullif(F.regexp_extract(cut, COMPANY, 0), F.lit("")), name))

    return F.translate(let(F.regexp_replace(F.regexp_replace(name, NAME_LABEL, ""), ORDINAL, ""), found), "（）", "()")


def strict_company(name: Column) -> Column:
    """Empty for generic words; what follows the last narrative word otherwise."""

    def held(cut: Column, stem: Column) -> Column:
        fits = (stem != cut) & (F.length(stem) >= 2) & F.regexp_like(stem, F.lit(r"[一-鿿A-Za-z0-9]")) & ~cut.isin("我公司", "本公司", "该公司")
        return F.when(fits, cut).otherwise("")

    ending = "(?:" + "|".join(COMPANY_ENDINGS) + ")$"
    return let(F.regexp_replace(name, "^.*(?:委托|代理的|须在|合同经|依法|协调|见证)", ""), lambda cut: let(F.regexp_replace(cut, ending, ""), lambda stem: held(cut, stem)))


def readable(value: Column, least: int = 20) -> Column:
    """Enough text, no replacement character, six CJK letters and 12 % of them at least."""
    text = no_space(blank_to_empty(value))
    cjk = F.length(text) - F.length(F.regexp_replace(text, r"[一-鿿]", ""))
    return (F.length(text) >= least) & ~F.contains(text, F.lit("�")) & (cjk >= 6) & (cjk >= 0.12 * F.length(text))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value as a lambda's variable, so that a long expression stands in the plan once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def has_any(text: Column, words) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(text, F.lit(w))
    return out


def code_and_lot(value: Column) -> Column:
    """struct<project, lot>: a code with a trailing lot like -A12 is the lot's, whole, and the project's without it; other codes have no lot."""
    suffix = r"-[A-Z]{0,3}\d{1,4}$"

    def split(text: Column) -> Column:
        has = F.regexp_like(text, F.lit(suffix))
        return F.struct(F.regexp_replace(text, suffix, "").alias("project"), F.when(has, text).otherwise("").alias("lot"))

    return let(plain_code(value), split)


def plain_code(value: Column) -> Column:
    """A code or a line with one in comparable form: NFKC, capitals, no white space, one kind of dash."""
    return coded(nfkc(blank_to_empty(value)))


def coded(value: Column) -> Column:
    """plain_code of a text that is in NFKC already."""
    return F.translate(F.upper(folded(value)), "－—–", "---")


def markdown_cell(value: Column, default: str = "-") -> Column:
    text = clean(value)
    return F.when(text == "", default).otherwise(F.replace(F.replace(text, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" ")))
