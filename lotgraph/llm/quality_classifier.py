"""Quality of whole texts by support vectors over n-gram indicators scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import rolling
from .common import Scratch

#: n-grams are hashed into so many features.
BUCKETS = 1 << 18

#: Kind of each byte: 0 blank, 1 letter, digit or part of a sign beyond ASCII, 2 other sign.
KIND = np.full(256, 1, np.int8)
KIND[:33] = 0
KIND[[b for b in range(33, 128) if not chr(b).isalnum()]] = 2
CAPITAL = np.zeros(256, np.int64)
CAPITAL[65:91] = 1
#: Shapes are taken in runs of so many tokens.
SHAPES = 4
ODD = np.uint64(0x9E3779B97F4A7C15)


def indicators(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) pairs, each once, of concatenated UTF-8 texts.

    Tokens are runs of letters and digits and runs of other signs. Features: a token, two in a row, and the shapes of SHAPES in a row (kind, length class,
    capitals, whether it is one of the two tokens before again), so that repetition and layout are n-grams too.
    """
    kind = KIND[data]
    change = np.ones(len(data), bool)
    change[1:] = kind[1:] != kind[:-1]
    change[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:], len(data))
    real = kind[starts] > 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[real], ends[real]
    text = np.searchsorted(offsets, starts, "right") - 1
    one = rolling.spans(rolling.prefix(data), starts, ends)
    together = lambda n: text[n:] == text[: max(0, len(text) - n)]  # noqa: E731  token i and the n-th after it are of one text
    capitals = np.append(0, np.cumsum(CAPITAL[data]))
    again = np.zeros(len(one), bool)
    for back in (1, 2):
        again[back:] |= (one[back:] == one[:-back]) & together(back) if len(one) > back else False
    shape = kind[starts] - 1 + 2 * again + 4 * np.minimum(2, (ends - starts) // 2) + 12 * np.minimum(2, capitals[ends] - capitals[starts])
    run = np.zeros(max(0, len(one) - SHAPES + 1), np.uint64)
    for k in range(SHAPES):
        run = run * np.uint64(36) + shape[k : len(one) - SHAPES + 1 + k].astype(np.uint64)
    two = one[:-1] * ODD + one[1:]
    whole = together(SHAPES - 1)
    made = ((text, one), (text[:-1][together(1)], rolling.mix(two[together(1)])), (text[: len(run)][whole], rolling.mix(run[whole] + ODD)))
    keys = np.concatenate([t.astype(np.int64) * BUCKETS + (h >> np.uint64(40)).astype(np.int64) % BUCKETS for t, h in made])
    keys = np.unique(keys)
    return keys // BUCKETS, keys % BUCKETS


@dataclass
class Model:
    """weights: of each feature's indicator, its log-count ratio included; lengths: the ratios' squares, whose root over a text's features
    its values are divided by; the margin becomes a score by slope and shift."""

    weights: np.ndarray
    lengths: np.ndarray
    bias: float
    slope: float
    shift: float

    def scores(self, text: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
        """Of n texts with these (text, feature) pairs."""
        size = np.sqrt(np.bincount(text, self.lengths[feature], n))
        margins = np.bincount(text, self.weights[feature], n) / np.where(size > 0, size, 1.0)
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * (margins + self.bias) + self.shift, -500, 500)))


def ratios(good: np.ndarray, bad: np.ndarray, n_good: int, n_bad: int, smooth: float = 1.0, least: int = 3) -> np.ndarray:
    """Log ratio of the shares of good and bad texts that have a feature; 0 for features of fewer than ``least`` texts.

    Each class is smoothed in proportion to its size, so a feature without evidence has ratio 0 however uneven the classes are.
    """
    n = n_good + n_bad
    r = np.log((good + smooth * n_good / n) / n_good) - np.log((bad + smooth * n_bad / n) / n_bad)
    return np.where(good + bad >= least, r, 0.0)


def dual_descent(rows: list[np.ndarray], y: np.ndarray, r: np.ndarray, cost: float = 1.0, epochs: int = 15, seed: int = 12) -> tuple[np.ndarray, float]:
    """Linear support vectors with hinge loss by coordinate descent on the dual (projected Newton steps, rows in a new order each epoch).

    A row's values are the ratios of its features, made one long, and 1 for the bias. The rarer class weighs as much as the other. Returns (v, bias).
    """
    rng = np.random.default_rng(seed)
    upper = np.where(y > 0, cost * len(y) / (2 * max(1, (y > 0).sum())), cost * len(y) / (2 * max(1, (y < 0).sum())))
    values = [r[x] / (np.linalg.norm(r[x]) or 1.0) for x in rows]
    square = np.array([v @ v + 1.0 for v in values])
    v, bias, alpha = np.zeros(len(r)), 0.0, np.zeros(len(y))
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            gradient = y[i] * (v[rows[i]] @ values[i] + bias) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), upper[i])
            step = (new - alpha[i]) * y[i]
            if step:
                alpha[i] = new
                v[rows[i]] += step * values[i]
                bias += step
    return v, bias


def sigmoid_of(margins: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of the logistic curve through held-out margins, by Newton steps on smoothed targets."""
    good, bad = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    scale = max(1e-9, float(np.abs(margins).mean()))
    x = np.stack((margins / scale, np.ones(len(y))), axis=1)
    at = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -500, 500)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (target - p) - 1e-3 * at)
        at = at + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(at[0], 0.0) / scale), float(at[1])


def learn(rows: list[np.ndarray], y: np.ndarray, r: np.ndarray, folds: int = 3, blend: float = 0.25, **options) -> Model:
    """The blend of the mean weight and the learned one (v'), times the ratios; the score's curve is fitted on margins of folds left out."""

    def fitted(part: np.ndarray) -> tuple[np.ndarray, float]:
        v, bias = dual_descent([rows[i] for i in part], y[part], r, **options)
        used = v != 0
        mean = np.abs(v[used]).mean() if used.any() else 0.0
        return np.where(r != 0, (1 - blend) * mean + blend * v, 0.0) * r, bias * blend

    at = np.arange(len(y))
    margins = np.zeros(len(y))
    for k in range(folds):
        out = at % folds == k
        w, bias = fitted(at[~out])
        margins[out] = [w[rows[i]].sum() / (np.linalg.norm(r[rows[i]]) or 1.0) + bias for i in at[out]]
    w, bias = fitted(at)
    return Model(w.astype(np.float32), (r * r).astype(np.float32), bias, *sigmoid_of(margins, y))


def by_text(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``features``, the sorted distinct features of each whole text."""
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("features", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in rolling.chunks(batch.column(batch.schema.get_field_index(text_col))):
                text, feature = indicators(data, offsets)
                cut = np.searchsorted(text, np.arange(b - a + 1)).astype(np.int32)
                listed = pa.ListArray.from_arrays(pa.array(cut), pa.array(feature.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(c)).slice(a, b - a) for c in keep], listed], names=schema.names)

    return docs.select(*keep, text_col).mapInArrow(run, schema)


def fit(
    docs: DataFrame, labels: DataFrame, learn_from: Column | None = None, max_rows: int = 4000, max_bytes: int = 64 << 20, seed: int = 12,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
) -> Model:
    """Learn on at most ``max_rows`` labelled documents, the first in a seeded order of the ids, up to ``max_bytes`` of text together.

    learn_from: a condition on the id column that labelled rows have to meet. A label of 1 is good, any other is bad. Null labels and ids are left out;
    repeated ids are rows of their own. Other columns of either table may have any name. Without labels every score is 0.5, with
    one class alone its smoothed share. Only the sample's ids are broadcast, only its features reach the driver.
    """
    known = labels.where(learn_from) if learn_from is not None else labels
    known = known.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    drawn = known.select(F.col(id_col).alias("_id"), (F.col(label_col) == 1).cast("int").alias("_good"), F.xxhash64(F.lit(seed), F.col(id_col)).alias("_draw"))
    drawn = drawn.orderBy("_draw", "_id", "_good").limit(max_rows)
    scratch = Scratch(docs.sparkSession)
    found = docs.select(F.col(id_col).alias("_at"), F.col(text_col).alias("_text")).join(F.broadcast(drawn), F.col("_at") == F.col("_id"))
    found = scratch.keep(found.select("_draw", "_good", "_text"), "sample")
    order = ["_draw", "_text", "_good"]
    upto = F.sum(F.coalesce(F.octet_length("_text"), F.lit(0))).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))  # the sample alone
    bounded = found.orderBy(*order).limit(2 * max_rows).withColumn("_upto", upto).where(F.col("_upto") <= max_bytes)
    got = by_text(bounded, "_text", ["_draw", "_good"]).toArrow().combine_chunks()
    scratch.drop("sample")
    good = got.column("_good").to_numpy()
    listed = got.column("features").combine_chunks()
    flat, cut = listed.values.to_numpy(), listed.offsets.to_numpy()
    rows = [flat[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
    order_ = np.argsort(got.column("_draw").to_numpy(), kind="stable")
    rows, y = [rows[i] for i in order_], np.where(good[order_] == 1, 1.0, -1.0)
    n_good, n_bad = int((y > 0).sum()), int((y < 0).sum())
    if not n_good or not n_bad:
        share = (n_good + 1) / (n_good + n_bad + 2)
        return Model(np.zeros(BUCKETS, np.float32), np.zeros(BUCKETS, np.float32), 0.0, 0.0, float(np.log(share / (1 - share))))
    has = [np.bincount(np.concatenate([x for x, c in zip(rows, y, strict=True) if c == side]), minlength=BUCKETS) for side in (1.0, -1.0)]
    return learn(rows, y, ratios(*has, n_good, n_bad), seed=seed)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and score (0 to 1, higher: good is likelier).

    Each whole text is read. Null and empty texts have the score of a text without features. Repeated rows: a row each, with equal scores. Words that
    the sample hasn't often enough count for nothing. An input column named score is replaced. An empty table gives no rows.
    """
    docs = docs.drop(*({"score"} - {text_col}))
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = shared.value
        for batch in batches:
            for a, b, data, offsets in rolling.chunks(batch.column(batch.schema.get_field_index(text_col))):
                text, feature = indicators(data, offsets)
                piece = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(told.scores(text, feature, b - a))], names=schema.names)

    return docs.mapInArrow(run, schema)
