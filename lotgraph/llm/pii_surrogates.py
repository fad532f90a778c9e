"""Personal data replaced by keyed surrogates of the same type, format, gender and script."""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, shuffled

#: Honorifics by gender: fixed values.
MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία")
#: Given names by script and gender: fixed values.
GIVEN = {
    ("latin", "m"): "Adrian Bruno Carl David Emil Felix Gustav Henri Ivan Jonas Kurt Lucas Marco Noel Oscar Pablo Rafael Simon Thomas Victor".split(),
    ("latin", "f"): "Alice Berta Clara Diana Emma Flora Greta Helena Irene Julia Karla Laura Maria Nora Olivia Paula Rosa Sofia Teresa Vera".split(),
    ("cyrillic", "m"): "Алексей Борис Виктор Григорий Дмитрий Егор Иван Кирилл Леонид Михаил Николай Олег Павел Роман Сергей".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Ксения Лариса Мария Надежда Ольга Полина Светлана".split(),
    ("greek", "m"): "Αλέξανδρος Βασίλης Γιώργος Δημήτρης Ηλίας Κώστας Νίκος Πέτρος Σπύρος Χρήστος".split(),
    ("greek", "f"): "Άννα Βασιλική Γεωργία Δήμητρα Ελένη Ιωάννα Κατερίνα Μαρία Σοφία Χριστίνα".split(),
}
#: Syllables of surnames by script: fixed values.
SURNAME = {
    "latin": "bal ber cor dan del fer gar hol kar lan mar mon nel per ros sal tor val ven wil".split(),
    "cyrillic": "бал вер гор дан жел зар кар лом мар нов пет рож сол тар хол".split(),
    "greek": "βαλ γερ δαν ζερ καρ λον μαρ νικ παπ ροδ σολ ταν φιλ χορ".split(),
}
TITLE = "|".join(sorted(MALE + FEMALE, key=len, reverse=True))
PATTERN = re.compile(
    r"(?P<email>[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})"
    r"|(?P<secret>\bAKIA[0-9A-Z]{16}\b|(?=[pPtT])(?:(?i:password)[\"']?[ \t]*[=:][ \t]*(?:(?P<quote>[\"'])(?P<quoted>(?:(?!(?P=quote))[^\n]){6,})(?P=quote)|[\"']?(?P<bare>[^\s\"']{6,}))"
    r"|(?i:token)[\"']?[ \t]*[=:][ \t]*[\"']?(?P<token>[0-9a-fA-F]{16,}(?![\w.+/=~-])|(?=[^\s\"']*\d)[\w.+/=~-]{16,})))"
    r"|(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<phone>(?<![\w+])\+\d{1,3}[ -]?\(?\d{2,4}\)?[ -]?\d{3,4}[ -]?\d{3,4}(?!\d)|(?<![\w(])\(\d{3}\) \d{3}-\d{4}(?!\d)"
    r"|(?<![\w+])\+(?=(?:[ ().-]*\d){9})\d{1,3}(?:[ .-]\(?\d{1,4}\)?){3,5}(?!\d)"
    r"|(?<![\w(])\(\d{2,5}\)[ -]?\d{3,4}[ -]?\d{3,5}(?!\w)"
    r"|(?<![\w.+/-])(?:0\d{2,4}[ /-]\d{3,4}[ -]?\d{3,5}|[2-9]\d{2}[ .-]\d{3}[ .-]\d{4})(?!\w|[.-]\d| \d{4}(?!\d)))"
    r"|(?P<card>(?<![\d.])\d{4}(?:[ -]?\d{4}){3}(?!\d)(?!\.\d))"
    rf"|(?P<name>\b(?P<title>{TITLE})\b\.? +(?P<parts>[^\W\d_a-zа-яα-ωß-ÿ]\w+(?: [^\W\d_a-zа-яα-ωß-ÿ]\w+){{0,2}}))"
)
#: A text without any of these has no entity.
HINT = re.compile(rf"[@\d]|(?i:password|token)|\b(?:{TITLE})\b")


def script(word: str) -> str:
    """latin, cyrillic, greek, or other: that of the word's greatest letter."""
    name = unicodedata.name(max(word), "").split(" ")[0].lower()
    return name if name in SURNAME else "other"


@lru_cache(4096)
def alike(sign: str) -> str:
    """The letters beside a letter that are of its script and category, itself among them; empty for what is no letter."""
    kind = unicodedata.category(sign)
    if kind[0] != "L":
        return ""
    of = lambda c: (unicodedata.category(c), unicodedata.name(c, "").split(" ")[0])
    start = ord(sign) & ~63
    return "".join(c for c in map(chr, range(start, start + 64)) if of(c) == of(sign))


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, value) of the entities, left to right. A person's names are entities of their own: the last is a
    surname, the others given names with the title's gender, so a full name and a later surname agree."""
    out = []
    for m in PATTERN.finditer(text) if HINT.search(text) else ():
        kind = m.lastgroup if m.lastgroup not in ("title", "parts") else "name"
        part = next((x for x in ("quoted", "bare", "token") if m[x] is not None), None)
        if part:
            out.append((m.start(part), m.end(part), "secret", m[part]))
            continue
        if kind != "name":
            out.append((m.start(), m.end(), kind, m[0]))
            continue
        gender, at = "m" if m["title"] in MALE else "f", m.start("parts")
        parts = m["parts"].split(" ")
        for i, part in enumerate(parts):
            out.append((at, at + len(part), "surname" if i == len(parts) - 1 else f"given_{gender}", part))
            at += len(part) + 1
    return out


def canonical(kind: str, value: str) -> str:
    """What mentions of one entity share: country code and digits of numbers, lower case of names and addresses."""
    if kind in ("phone", "card", "ssn"):
        country = re.match(r"\+\d{1,3}(?=[ (-])", value)
        digits = re.sub(r"\D", "", value)
        return f"{country[0]} {digits[len(country[0]) - 1 :]}" if country else digits
    return value if kind == "secret" else value.lower()


#: So many draws of a length keep the format; after them it is taken to have no value left.
WIDEN = 6


def luhn(digits: str) -> bool:
    total = sum(int(d) if i % 2 == 0 else (int(d) * 2 - 9 if d > "4" else int(d) * 2) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def surrogate(key: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """The replacement of a canonical value: characters keep their class; addresses and cards stay valid; names keep gender and script.

    Names in Latin, Cyrillic and Greek letters come from lists by gender; those in any other script have each letter replaced by one beside it in its script, as gender isn't told by
    letters there. From attempt WIDEN on the format is taken to be full and grows: two letters or digits for each WIDEN attempts, for addresses other octets.
    """
    stream = hmac.new(key, f"{kind}\x1f{value}\x1f{attempt}".encode(), hashlib.sha512).digest()
    while len(stream) < 2 * len(value) + 16 + attempt:
        stream += hashlib.sha512(stream).digest()
    pick = lambda i, n: int.from_bytes(stream[2 * i : 2 * i + 2], "big") % n
    if (kind == "surname" or kind.startswith("given_")) and script(value) == "other":
        drawn = "".join(alike(c)[pick(i, len(alike(c)))] if alike(c) else c for i, c in enumerate(value))
        first = next(alike(c) for c in value if alike(c))
        return drawn + "".join(first[b % len(first)] for b in stream[len(stream) - attempt // WIDEN :]) if attempt >= WIDEN else drawn
    if kind.startswith("given_"):
        names = GIVEN[script(value), kind[-1]]
        # beyond the list a syllable is added, so any number of people stay apart
        tail = "".join(SURNAME[script(value)][pick(i + 1, len(SURNAME[script(value)]))] for i in range(attempt // 2))
        return (names[pick(0, len(names))] + tail).lower()
    if kind == "surname":
        syllables = SURNAME[script(value)]
        return "".join(syllables[pick(i, len(syllables))] for i in range(3 + attempt // 2))
    if kind == "ip" and attempt >= WIDEN:
        return ".".join(str(1 + pick(i, 254)) for i in range(4))
    if kind == "ip":
        return ".".join(str((1, 10, 100)[len(o) - 1] + pick(i, (9, 90, 155)[len(o) - 1])) for i, o in enumerate(value.split(".")))

    upper_hex = kind == "secret" and re.fullmatch("[0-9A-F]{16,}", value) is not None

    def shift(i: int, c: str) -> str:
        if c.isdigit():
            return str(pick(i, 10))
        if "a" <= c <= "f" and kind == "secret":
            return "abcdef"[pick(i, 6)]
        if upper_hex:
            return "ABCDEF"[pick(i, 6)]
        return chr(97 + pick(i, 26)) if "a" <= c <= "z" else chr(65 + pick(i, 26)) if "A" <= c <= "Z" else c

    fixed = 4 if kind == "secret" and value.startswith("AKIA") else value.find(" ") + 1 or int(value.startswith("0")) if kind == "phone" else 0
    end = value.rfind(".") if kind == "email" else len(value)
    out = value[:fixed] + "".join(shift(i, c) for i, c in enumerate(value[fixed:end])) + value[end:]
    more = attempt // WIDEN
    tail = lambda signs: "".join(signs[b % len(signs)] for b in stream[len(stream) - 2 * more :])
    if more and kind == "email":
        out = tail("abcdefghijklmnopqrstuvwxyz") + out
    elif more:
        out += tail("abcdefghijklmnopqrstuvwxyz" if kind == "secret" else "0123456789")
    if kind == "card" and luhn(value):
        out = next(out[:-1] + d for d in "0123456789" if luhn(out[:-1] + d))
    return out


def dress(kind: str, value: str, mention: str) -> str:
    """The surrogate in the format of this mention: its punctuation, country code and case."""
    if kind in ("phone", "card", "ssn"):
        digits = iter(re.sub(r"\D", "", value))
        return "".join([*(next(digits) if c.isdigit() else c for c in mention), *digits])
    if kind == "surname" or kind.startswith("given_"):
        return value.upper() if mention.isupper() else value.capitalize()
    if kind != "email":
        return value
    longer = len(value) - len(mention)
    return value[:longer] + "".join(v.upper() if m.isupper() else v for v, m in zip(value[longer:], mention, strict=True))


def resolve(found: DataFrame, key: bytes, scratch: Scratch) -> DataFrame:
    """(kind, value, replacement) for the distinct entities: no two of a kind share a replacement, and none is another entity's value.

    Of entities that collide the least keeps its replacement, the others take the next attempt; each round works on the open ones. A full
    format grows (see surrogate), so rounds end. Only if more than 2**32 addresses are asked for is there an error.
    """

    def draw(attempt: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kinds, values = (batch.column(i).to_pylist() for i in (0, 1))
                made = [surrogate(key, a, b, attempt) for a, b in zip(kinds, values, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.string())], names=["kind", "value", "replacement"])

        return run

    everyone = scratch.keep(found.select("kind", "value").distinct(), "entities")
    left, settled = everyone, None
    for attempt in range(1000):
        drawn = scratch.keep(left.mapInArrow(draw(attempt), "kind string, value string, replacement string"), f"drawn{attempt}")
        taken = everyone.select("kind", F.col("value").alias("replacement"))
        if settled is not None:
            taken = taken.union(settled.select("kind", "replacement"))
        fresh = drawn.join(taken, ["kind", "replacement"], "left_anti")
        first = fresh.groupBy("kind", "replacement").agg(F.min("value").alias("value")).select("kind", "value", "replacement")
        settled = scratch.keep(first if settled is None else settled.union(first), f"settled{attempt}")
        left = scratch.keep(left.join(settled, ["kind", "value"], "left_anti"), f"left{attempt}")
        if left.isEmpty():
            return settled
    raise RuntimeError("there are more IP addresses than replacements")


def replace(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts with every entity replaced; the same entity gets the same surrogate in all documents, different ones different surrogates.

    Entities: e-mail addresses, secrets, IPv4 addresses, social security, phone and card numbers, and names behind a title (no others), in any script (see surrogate). Secrets stand
    behind password or token in any case, with = or : and with or without quotes; phones have a country code, an area code in
    brackets, a leading zero or the form ddd-ddd-dddd. Surrogates
    depend on the key, the type and the entity alone, but for collisions (see resolve). A null text stays null; an empty one empty.
    Repeated rows: a row each; rows of one id need not have one text. Very long texts are whole. Other columns, whatever their names, are
    ignored. An empty table gives no rows.
    Returns doc_id, text, n_entities, kinds (sorted, joined by commas).
    """
    scratch = Scratch(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k, k2, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                out += [(k, k2, s, e, kind, canonical(kind, value)) for s, e, kind, value in entities(text or "")]
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(types)], names=["k", "k2", "s", "e", "kind", "value"])

    # two hashes tell the texts apart: mentions and texts meet by both
    keyed = source.withColumns({"k": F.xxhash64("doc_id", "text"), "k2": F.xxhash64(F.lit(2), "text", "doc_id")})
    mentions = scratch.keep(keyed.select("k", "k2", "text").mapInArrow(detect, "k long, k2 long, s int, e int, kind string, value string").distinct(), "mentions")
    mapping = resolve(mentions, key, scratch)
    spans = mentions.join(mapping, ["kind", "value"]).groupBy("k", "k2").agg(F.array_sort(F.collect_list(F.struct("s", "e", "kind", "replacement"))).alias("spans"))
    joined = keyed.join(shuffled(spans), ["k", "k2"], "left").select("doc_id", "text", "spans")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, kinds = [], [], []
            for text, listed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                listed = listed or []
                if listed:
                    out, at = [], 0
                    for x in listed:
                        out += [text[at : x["s"]], dress(x["kind"], x["replacement"], text[x["s"] : x["e"]])]
                        at = x["e"]
                    text = "".join([*out, text[at:]])
                texts.append(text)
                counts.append(len(listed))
                kinds.append(",".join(sorted({x["kind"] for x in listed})))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, batch.column(1).type), pa.array(counts, pa.int64()), pa.array(kinds, pa.string())], names=["doc_id", "text", "n_entities", "kinds"])

    return joined.mapInArrow(rewrite, f"doc_id {kind}, text string, n_entities long, kinds string")
