"""Language of words and documents by a linear-chain conditional random field."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

BUCKETS = 1 << 15
#: So many signs of a text are taken for each word that is learned from.
SIGNS = 64
UNKNOWN = "und"
#: Runs of scripts written without blanks: Thai, Lao, Tibetan (to the syllable mark), Burmese, Khmer, kana, Han. Digits aren't among them.
UNSPACED = re.compile("([\u0e01-\u0e3a\u0e40-\u0e4e\u0e81-\u0ecf\u0edc-\u0edf\u0f40-\u0fbc\u1000-\u103f\u1050-\u108f\u1780-\u17d3\u3005-\u3007\u3041-\u309f\u30a1-\u30fa\u30fc-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9d\U00020000-\U0003ffff]+)")


def letters(token: str) -> str:
    """A token without what stands around its letters, lower-cased; empty if it has none."""
    a, b = 0, len(token)
    while a < b and not token[a].isalpha():
        a += 1
    while b > a and not token[b - 1].isalpha():
        b -= 1
    return token[a:b].lower()


def elements(token: str) -> list[str]:
    """The chain elements of a token: its letters; each letter of a run without blanks with its marks and the letter after it."""
    if token.isascii() or not UNSPACED.search(token):
        word = letters(token)
        return [word] if word else []
    out = []
    for i, run in enumerate(UNSPACED.split(token)):
        if i % 2:
            signs: list[str] = []
            for c in run:
                if c.isalpha():
                    signs.append(c)
                elif signs:
                    signs[-1] += c
            out += [a + b for a, b in zip(signs, [*signs[1:], ""], strict=True)]
        elif word := letters(run):
            out.append(word)
    return out


class Hashes(dict):
    """Buckets of the features of one kind, kept up to a bound: affixes and trigrams come again and again."""

    def __init__(self, kind: str):
        self.kind = kind

    def __missing__(self, value: str) -> int:
        if len(self) > 100_000:
            self.clear()
        at = self[value] = zlib.crc32(f"{self.kind}{value}".encode()) % BUCKETS
        return at


PREFIX, SUFFIX, GRAM = Hashes("p"), Hashes("s"), Hashes("g")


def features(word: str, lexicons: list[set[str]]) -> list[int]:
    """Hashed affixes of one to three letters, letter trigrams, the word, its script, and the lexicons that have it."""
    made = [f"w{word}", "a" if word.isascii() else f"u{max(word) >= 'Ͱ'}", *(f"l{k}" for k, lexicon in enumerate(lexicons) if word in lexicon)]
    padded = f"^{word}$"
    return [
        *(zlib.crc32(x.encode()) % BUCKETS for x in made),
        PREFIX[word[:1]], PREFIX[word[:2]], PREFIX[word[:3]], SUFFIX[word[-1:]], SUFFIX[word[-2:]], SUFFIX[word[-3:]],
        *[GRAM[padded[i : i + 3]] for i in range(len(padded) - 2)],
    ]


def signs(word: str) -> list[str]:
    """What tells whether a word can be of a language: its letter trigrams; in a script without blanks its first letter."""
    return [word[0]] if UNSPACED.match(word) else [f"^{word}$"[i : i + 3] for i in range(len(word))]


@dataclass
class Field:
    """The model: labels, feature weights by label, transition weights, each language's lexicon of frequent words, and the signs
    of all words learned from."""

    labels: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    lexicons: list[set[str]] = field(default_factory=list)
    seen: set[str] = field(default_factory=set)

    def familiar(self, word: str) -> float:
        """Share of a word's signs that some learned language has."""
        found = signs(word)
        return sum(x in self.seen for x in found) / max(1, len(found))

    def emissions(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros((0, len(self.labels)))
        listed = [features(w, self.lexicons) for w in words]
        sizes = np.array([len(x) for x in listed])
        flat = np.fromiter((f for x in listed for f in x), np.int64, int(sizes.sum()))
        return np.add.reduceat(self.weights[flat], np.cumsum(sizes) - sizes, axis=0)


def forward_backward(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of each word, expected transitions, and the log partition, over chains laid end to end.

    Chains are ordered by length, so one step handles the t-th word of all chains that are long enough.
    """
    total, k = scores.shape
    order = np.argsort(-lengths, kind="stable")
    start = (np.cumsum(lengths) - lengths)[order]
    size = lengths[order]
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(1, longest + 1), "right")
    top = scores.max(axis=1, keepdims=True)
    e, tr = np.exp(scores - top), np.exp(transitions)
    alpha, beta, scale = np.empty_like(e), np.ones_like(e), np.empty(total)
    for t in range(longest):
        at = start[: active[t]] + t
        a = e[at] if t == 0 else (alpha[at - 1] @ tr) * e[at]
        s = a.sum(axis=1)
        alpha[at], scale[at] = a / s[:, None], s
    expected = np.zeros((k, k))
    for t in range(longest - 1, 0, -1):
        at = start[: active[t]] + t
        right = e[at] * beta[at] / scale[at][:, None]
        expected += tr * (alpha[at - 1].T @ right)
        beta[at - 1] = right @ tr.T
    return alpha * beta, expected, float(np.log(scale).sum() + top.sum())


def train(lines: list[tuple[list[str], int]], labels: list[str], rounds: int = 30, rate: float = 0.25, decay: float = 1e-4, seed: int = 2, lexicon: int = 200) -> Field:
    """Maximum likelihood by Adam. Lines carry their document's label; half of the chains are spliced from lines of two
    documents, so that transitions between languages are learned too."""
    rng, k = np.random.default_rng(seed), len(labels)
    often = [Counter() for _ in labels]
    for words, y in lines:
        often[y].update(words)
    share = [{w: c / max(1, sum(o.values())) for w, c in o.items()} for o in often]
    lexicons = [{w for w, _ in Counter({w: c for w, c in s.items() if c > 2 * max((t.get(w, 0) for j, t in enumerate(share) if j != i), default=0)}).most_common(lexicon)} for i, s in enumerate(share)]
    vocabulary: dict[str, int] = {}
    rows, ys, lengths = [], [], []
    order = rng.permutation(len(lines))
    for i, a in enumerate(order.tolist()):
        parts = [lines[a]]
        if i % 2 and i:
            parts.append(lines[order[i - 1]])
        chain = [(vocabulary.setdefault(w, len(vocabulary)), y) for words, y in parts for w in words[: 60 if len(parts) > 1 else None]]
        if chain:
            rows += [c[0] for c in chain]
            ys += [c[1] for c in chain]
            lengths.append(len(chain))
    rows, ys, lengths = np.array(rows, np.int64), np.array(ys, np.int64), np.array(lengths, np.int64)
    listed = [features(w, lexicons) for w in vocabulary]
    sizes = np.array([len(x) for x in listed], np.int64)
    flat = np.fromiter((f for x in listed for f in x), np.int64, int(sizes.sum()))
    of = np.repeat(np.arange(len(listed)), sizes)
    model = Field(labels, np.zeros((BUCKETS, k)), np.zeros((k, k)), lexicons, {x for w in vocabulary for x in signs(w)})
    if not len(rows):
        return model
    follows = np.ones(len(rows), bool)
    follows[(np.cumsum(lengths) - lengths)] = False
    seen = np.zeros((k, k))
    np.add.at(seen, (ys[np.flatnonzero(follows) - 1], ys[follows]), 1)
    onehot = np.eye(k)[ys]
    state = [np.zeros_like(x) for x in (model.weights, model.weights, model.transitions, model.transitions)]
    for r in range(1, rounds + 1):
        emission = np.add.reduceat(model.weights[flat], np.cumsum(sizes) - sizes, axis=0)
        marginal, expected, _ = forward_backward(emission[rows], lengths, model.transitions)
        gap = onehot - marginal
        by_word = np.stack([np.bincount(rows, gap[:, j], len(listed)) for j in range(k)], axis=1)
        gradient = np.stack([np.bincount(flat, by_word[of, j], BUCKETS) for j in range(k)], axis=1) / len(rows) - decay * model.weights
        steps = ((model.weights, gradient, 0), (model.transitions, (seen - expected) / len(rows) - decay * model.transitions, 2))
        for x, g, i in steps:
            state[i] = 0.9 * state[i] + 0.1 * g
            state[i + 1] = 0.99 * state[i + 1] + 0.01 * g * g
            x += rate * (state[i] / (1 - 0.9**r)) / (np.sqrt(state[i + 1] / (1 - 0.99**r)) + 1e-8)
    model.weights = model.weights.astype(np.float32)
    return model


def remainder(id_col: str) -> Column:
    """crc32 of the id as text, modulo 3; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3


def fit(docs: DataFrame, learn: Column, per_label: int = 120, words: int = 250, seed: int = 2, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_labels: int = 1000) -> Field:
    """Learn from at most ``per_label`` documents of each language, the first in a seeded order of the ids, and their first lines
    up to ``words`` words. Only rows where ``learn`` is true and text, language and id aren't null are used.

    The counts of all labelled rows fix what share of each language is looked at, so no group is ever gathered whole. Only the beginnings of texts, of SIGNS for each of the words, reach
    the driver; more than ``max_labels`` languages are an error, as a language's weights are part of the model. Repeated rows count as often as they are there.
    """
    usable = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    counted = {r[0]: r[1] for r in usable.groupBy(lang_col).count().limit(max_labels + 1).collect()}
    if len(counted) > max_labels:
        raise ValueError(f"more than {max_labels} labels; a larger max_labels must be asked for")
    labels = sorted(counted)
    if not labels:
        return Field([], np.zeros((BUCKETS, 0), np.float32), np.zeros((0, 0)))
    share = F.create_map(*(F.lit(x) for label in labels for x in (label, min(1.0, 3.0 * per_label / counted[label]))))[F.col(lang_col)]
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    small = usable.withColumn("_draw", draw).where(F.conv(F.substring("_draw", 1, 8), 16, 10).cast("double") / 2.0**32 < share)
    ranked = small.select(lang_col, text_col, "_draw", F.row_number().over(Window.partitionBy(lang_col).orderBy("_draw", text_col)).alias("_r"))
    lines = []
    for row in ranked.where(F.col("_r") <= per_label).orderBy(lang_col, "_r").select(lang_col, F.left(text_col, F.lit(SIGNS * words))).collect():
        left = words
        for line in row[1].split("\n"):
            chain = [w for token in line.split() for w in elements(token)][:left]
            left -= len(chain)
            if chain:
                lines.append((chain, labels.index(row[0])))
    return train(lines, labels, seed=seed)


class Tagger:
    """Marginals for whole texts; the scores of words seen are kept up to a bound. ``familiar``: sum the words' familiarity too."""

    def __init__(self, model: Field, keep: int = 300_000, familiar: bool = False):
        self.model, self.keep, self.familiar = model, keep, familiar
        self.reset()

    def reset(self) -> None:
        self.of_token: dict[str, int] = {}
        self.of_word: dict[str, int] = {"": 0}
        self.new: list[str] = []
        self.table = np.zeros((1, len(self.model.labels)))
        self.met = np.zeros(1)

    def at(self, word: str) -> int:
        at = self.of_word.get(word)
        if at is None:
            at = self.of_word[word] = len(self.of_word)
            self.new.append(word)
        return at

    def row(self, token: str) -> int:
        at = self.of_token[token] = self.at(letters(token))
        return at

    def tag(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(words with letters, sum of their marginals by label) of each text; the chains are its lines."""
        return self.read(texts)[:2]

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As tag, and the sum of the words' familiarity (0 unless asked for)."""
        if max(len(self.of_token), len(self.of_word)) > self.keep:
            self.reset()
        rows, lengths, owner = [], [], []
        known, row, at = self.of_token, self.row, self.at
        for i, text in enumerate(texts):
            for line in (text or "").split("\n"):
                tokens = line.split()
                if tokens:
                    if line.isascii() or not UNSPACED.search(line):
                        got = [known[t] if t in known else row(t) for t in tokens]
                    else:
                        got = [at(w) for t in tokens for w in elements(t)] or [0]
                    rows += got
                    lengths.append(len(got))
                    owner.append(i)
        if self.new:
            self.table = np.concatenate((self.table, self.model.emissions(self.new)))
            self.met = np.concatenate((self.met, [self.model.familiar(w) if self.familiar else 0.0 for w in self.new]))
            self.new = []
        rows, lengths, owner = np.array(rows, np.int64), np.array(lengths, np.int64), np.array(owner, np.int64)
        chain = np.repeat(np.arange(len(lengths)), lengths)
        real = rows > 0
        rows, chain = rows[real], chain[real]
        lengths = np.bincount(chain, minlength=len(lengths))
        k = len(self.model.labels)
        if not len(rows) or not k:
            return np.bincount(owner[chain], minlength=len(texts)), np.zeros((len(texts), k)), np.zeros(len(texts))
        marginal, _, _ = forward_backward(self.table[rows], lengths[lengths > 0], self.model.transitions)
        doc = owner[chain]
        total = np.stack([np.bincount(doc, marginal[:, j], len(texts)) for j in range(k)], axis=1)
        return np.bincount(doc, minlength=len(texts)), total, np.bincount(doc, self.met[rows], len(texts))


def predict(docs: DataFrame, model: Field, text_col: str = "text", at_once: int = 1 << 20, familiar: bool = False) -> DataFrame:
    """All columns of ``docs`` and lang_pred, score, n_letter_words, lang_shares; if asked, familiar.

    Words are split at blanks, and runs of scripts without blanks into their letters (see elements); those with a letter are labelled
    in the chain of their line, by all of their trigrams. The document's language is the label
    with the greatest mean marginal, which is its score; ``und`` with score 0 for null or letterless texts, or without any label.
    familiar: mean share of the words' signs that any learned language has, whichever label wins (0 for und).
    lang_shares: mean marginal by label, sorted as the labels (empty for und). An input column of one of these names is replaced.
    Repeated rows: a row each. An empty table gives no rows.
    """
    made = {"lang_pred": T.StringType(), "score": T.DoubleType(), "n_letter_words": T.LongType(), "lang_shares": T.ArrayType(T.DoubleType())}
    if familiar:
        made["familiar"] = T.DoubleType()
    docs = docs.drop(*(set(made) - {text_col}))
    schema = T.StructType([*docs.schema.fields, *(T.StructField(name, kind) for name, kind in made.items())])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = list(model.labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(shared.value, familiar=familiar)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            sizes = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            a = 0
            while a < len(batch):
                b = min(len(batch), max(a + 1, int(np.searchsorted(sizes, (sizes[a - 1] if a else 0) + at_once, "right"))))
                n, total, met = tagger.read(texts.slice(a, b - a).to_pylist())
                mean = total / np.maximum(n, 1)[:, None]
                best = mean.argmax(axis=1) if names else np.zeros(b - a, np.int64)
                named = [names[j] if c and names else UNKNOWN for j, c in zip(best.tolist(), n.tolist(), strict=True)]
                score = np.clip(mean[np.arange(b - a), best], 0, 1) if names else np.zeros(b - a)
                shares = [x if c else [] for x, c in zip(mean.tolist(), n.tolist(), strict=True)]
                piece = batch.slice(a, b - a)
                extra = [pa.array(met / np.maximum(n, 1))] if familiar else []
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(named, pa.string()), pa.array(score), pa.array(n.astype(np.int64)), pa.array(shares, pa.list_(pa.float64())), *extra], names=schema.names)
                a = b

    return docs.mapInArrow(run, schema)


def label_words(docs: DataFrame, model: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each word with a letter: id, line, place (in the line, from 0), word, lang, probability.

    The label with the greatest marginal in the chain of the word's line, so words of a code-switched text have labels of their own. Scripts
    without blanks are labelled letter by letter (see elements). Null and letterless texts have no rows, nor has any text without
    labels learned. Repeated rows: their words again. Very long texts are whole; other columns are ignored, whatever their names.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["id", "line", "place", "word", "lang", "probability"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in batches:
            for at, text in enumerate(batch.column(1).to_pylist()):
                lines = [[w for token in line.split() for w in elements(token)] for line in (text or "").split("\n")]
                lengths = np.array([len(x) for x in lines], np.int64)
                words = [w for x in lines for w in x]
                if not words or not field.labels:
                    continue
                marginal, _, _ = forward_backward(field.emissions(words), lengths[lengths > 0], field.transitions)
                best = marginal.argmax(axis=1)
                line = np.repeat(np.arange(len(lines)), lengths)
                place = np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                ids = batch.column(0).take(pa.array(np.full(len(words), at)))
                yield pa.RecordBatch.from_arrays([ids, pa.array(line), pa.array(place), pa.array(words), pa.array([field.labels[j] for j in best.tolist()]), pa.array(marginal[np.arange(len(words)), best].astype(np.float64))], names=names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, line long, place long, word string, lang string, probability double")
