"""Quality rules: text statistics, and decision lists learned by sequential covering."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, Scratch, let, split_words

FEATURES = ("n_words", "mean_chars", "symbol_ratio", "dup_line_ratio", "repeat_ratio")
WINDOW = 8


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of each text, within the row: no shuffle, no explode.

    n_repeat_words: eight-word windows are compared by 64-bit hashes of the words' hashes. Texts whose windows
    are all different stop there; the others sort (hash, position) and add up what equal windows cover.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    made = docs.select(
        F.col(id_col).alias("doc_id"),
        let(F.transform(split_words(text, BLANKS), lambda x: F.xxhash64(x)), lambda h: F.struct(F.size(h).alias("n"), repeat_words(h).alias("r"))).alias("w"),
        F.length(F.regexp_replace(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("d"))).alias("l"),
    )
    whole = lambda c, name: F.col(c).cast("long").alias(name)
    return made.select("doc_id", whole("w.n", "n_words"), "word_chars", "n_symbols", whole("l.n", "n_lines"), whole("l.d", "n_dup_lines"), whole("w.r", "n_repeat_words"))


def repeat_words(h: Column) -> Column:
    """How many words lie in windows that the array of word hashes has twice or more."""
    windows = F.transform(F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(h, i, WINDOW)))
    same = lambda s, i, x: F.coalesce(F.get(s, i)["g"] == x["g"], F.lit(False))
    equal = lambda s: F.array_sort(F.transform(F.filter(s, lambda x, j: same(s, j - 1, x) | same(s, j + 1, x)), lambda x: x["i"]))
    covered = lambda p: F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW))))
    total = lambda p: F.aggregate(covered(p), F.lit(0), lambda a, x: a + x)
    pairs = lambda g: F.array_sort(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))
    count = lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(let(pairs(g), lambda s: let(equal(s), total)))
    return F.when(F.size(h) < WINDOW, 0).otherwise(let(windows, count))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def features() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    ratio = lambda c: F.round(c / n, 6)
    return {
        "mean_chars": ratio(F.col("word_chars")),
        "symbol_ratio": ratio(F.col("n_symbols")),
        "dup_line_ratio": F.round(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)), 6),
        "repeat_ratio": ratio(F.col("n_repeat_words")),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def holds(self, row: dict) -> bool:
        return row[self.feature] >= self.threshold if self.at_least else row[self.feature] <= self.threshold

    def column(self) -> Column:
        return F.col(self.feature) >= self.threshold if self.at_least else F.col(self.feature) <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<='} {self.threshold:g}"


def counts(rows: list[dict], conditions) -> tuple[int, int]:
    """Bad and good rows that meet all conditions."""
    met = [r for r in rows if all(c.holds(r) for c in conditions)]
    bad = sum(r["bad"] for r in met)
    return bad, len(met) - bad


def learn(rows: list[dict], names=FEATURES, n_thresholds: int = 24, max_conditions: int = 3, max_rules: int = 8, precision: float = 0.95, support: int = 5) -> list[tuple[Condition, ...]]:
    """Sequential covering: grow a conjunction by FOIL's gain on two thirds of the rows, drop each condition without which it is no worse on the rest, and
    keep it if on both parts it is bad in at least ``precision`` of what it covers. Rows are dicts of the features and bad (0 or 1).

    Rows come in a seeded order; every third is for pruning. Without bad or without good rows there are no rules.
    """
    import math

    rules: list[tuple[Condition, ...]] = []
    grow, prune = [r for i, r in enumerate(rows) if i % 3], rows[::3]
    candidates = []
    for name in names:
        values = sorted(r[name] for r in rows)
        cuts = sorted({values[min(len(values) - 1, len(values) * q // n_thresholds)] for q in range(n_thresholds + 1)}) if values else []
        edges = sorted({*cuts, *((a + b) / 2 for a, b in zip(cuts, cuts[1:], strict=False))})
        candidates += [Condition(name, side, t) for t in edges for side in (True, False)]
    while len(rules) < max_rules and sum(r["bad"] for r in grow) >= support:
        rule: tuple[Condition, ...] = ()
        covered = grow
        while len(rule) < max_conditions:
            p0, n0 = counts(covered, ())
            if not n0:
                break
            best = (1e-9, None)
            for c in candidates:
                p, n = counts(covered, (c,))
                if p >= support:
                    gain = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))
                    best = max(best, (gain, c), key=lambda x: x[0])
            if best[1] is None:
                break
            rule, covered = (*rule, best[1]), [r for r in covered if best[1].holds(r)]
        if not rule:
            break

        def worth(conditions):
            p, n = counts(prune, conditions)
            return ((p - n) / (p + n) if p + n else -1.0, p)

        while len(rule) > 1:
            shorter = max((rule[:i] + rule[i + 1 :] for i in reversed(range(len(rule)))), key=worth)
            if worth(shorter) < worth(rule):
                break
            rule = shorter
        (p, n), (pp, pn) = counts(grow, rule), counts(prune, rule)
        if p < precision * (p + n) or pp < precision * (pp + pn) or not pp:
            break
        rules.append(rule)
        grow, prune = ([r for r in part if not all(c.holds(r) for c in rule)] for part in (grow, prune))
    return rules


def decision(rules: list[tuple[Condition, ...]]) -> Column:
    """The ordered list as one conditional expression: the number (from 1) of the first rule that fires, 0 if none."""
    out = F.lit(0)
    for k, rule in reversed(list(enumerate(rules, 1))):
        test = rule[0].column()
        for c in rule[1:]:
            test = test & c.column()
        out = F.when(test, k).otherwise(out)
    return out


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 4000, seed: int = 4, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> list[tuple[Condition, ...]]:
    """Learn on at most ``max_labelled`` labelled documents, the first in a seeded order of the ids. Only their texts are counted.

    Null labels and ids are left out; repeated ids are rows of their own. Other columns of either table may have any name.
    """
    drawn = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), (F.col(label_col) == 0).cast("int").alias("bad"))
    drawn = drawn.withColumn("_draw", F.xxhash64(F.lit(seed), "_id")).orderBy("_draw", "_id", "bad").limit(max_labelled)
    sample = docs.select(id_col, text_col).join(F.broadcast(drawn), F.col(id_col) == F.col("_id")).select(F.struct(id_col, "_draw", "bad").alias("_key"), F.col(text_col))
    sample = Scratch(docs.sparkSession).keep(sample, "sample")  # else the optimizer counts all texts before it joins
    made = statistics(sample, "_key", text_col).withColumns(features()).where(~base_failed())
    rows = made.select(*FEATURES, F.col("doc_id.bad").alias("bad"), F.col("doc_id._draw").alias("_draw")).orderBy("_draw", *FEATURES, "bad").limit(2 * max_labelled)
    return learn([r.asDict() for r in rows.collect()])


def apply_rules(docs: DataFrame, rules: list[tuple[Condition, ...]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics, base_failed, the number of the rule that fired, and kept.

    Null or empty text: all counts 0, base_failed. Very long texts are whole. Repeated rows: a row each. Other columns, whatever their
    names, are ignored. An empty table gives no rows.
    """
    made = statistics(docs, id_col, text_col).withColumn("base_failed", base_failed())
    made = made.withColumns(features()).withColumn("rule_fired", decision(rules))
    return made.withColumn("kept", ~F.col("base_failed") & (F.col("rule_fired") == 0))
