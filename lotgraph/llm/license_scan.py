"""License notices by MinHash bands over overlapping windows, verified by exact shingle containment."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rolling
from .license_texts import NOTICES, TEXTS

U = np.uint64
TEMPLATES = NOTICES + TEXTS


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of each run of ASCII letters or digits and bytes from 0x80, A-Z lower-cased."""
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    part = ((data >= 48) & (data <= 57)) | ((data >= 97) & (data <= 122)) | (data >= 128)
    begin, end = part.copy(), part.copy()
    begin[1:] &= ~part[:-1]
    end[:-1] &= ~part[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begin[inner] |= part[inner]
    end[inner - 1] |= part[inner - 1]
    start, stop = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return rolling.spans(rolling.prefix(data), start, stop), np.searchsorted(offsets, start, "right") - 1


def shingles(word: np.ndarray, k: int) -> np.ndarray:
    n = max(len(word) - k + 1, 0)
    h = np.full(n, k, U)
    for j in range(k):
        h = rolling.mix(h * U(0x9E3779B97F4A7C15) + word[j : j + n])
    return h


def n_bands(similarity: float, probability: float) -> int:
    """Bands of one row so that sets of this Jaccard similarity collide in a band with this probability at least."""
    return 1 if similarity >= 1 else math.ceil(math.log(1 - probability) / math.log(1 - similarity))


class Templates:
    """Templates by class (k, m): k-word shingles, up to m of them, m a power of two. Windows of a class have 2 m shingles and start
    every m, so any m shingles in a row lie in one window. The worst case of a class, a template of m / 2 shingles of which
    ``containment`` are met in a window of other text, sets the number of bands."""

    def __init__(self, listed: Sequence[tuple[str, str]], k: int, containment: float, probability: float):
        self.names = [name for name, _ in listed]
        self.classes: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = defaultdict(list)
        for i, (_, text) in enumerate(listed):
            data = np.frombuffer(text.encode(), np.uint8)
            word, _ = words(data, np.array([0, len(data)]))
            if len(word):
                h = np.unique(shingles(word, min(k, len(word))))
                self.classes[min(k, len(word)), 1 << (len(h) - 1).bit_length()].append((i, h))
        self.factors = {}
        for (size, m), group in self.classes.items():
            fewest = min(math.ceil(containment * len(h)) for _, h in group)
            largest = max(len(h) for _, h in group)
            b = n_bands(fewest / (2 * m + largest - fewest), probability)
            self.factors[size, m] = rolling.mix(np.arange(1, b + 1, dtype=U) + U(size << 32)) | U(1)


def scan_chunk(data: np.ndarray, offsets: np.ndarray, templates: Templates, containment: float) -> list[dict[int, float]]:
    """For each text the templates found and the largest containment."""
    found: list[dict[int, float]] = [{} for _ in range(len(offsets) - 1)]
    word, doc = words(data, offsets)
    for (k, m), group in templates.classes.items():
        h = shingles(word, k)
        whole = np.flatnonzero(doc[: len(h)] == doc[k - 1 : k - 1 + len(h)])
        h, of = h[whole], doc[whole]
        if not len(h):
            continue
        first = np.searchsorted(of, np.arange(len(found)))
        rank = np.arange(len(h)) - first[of]
        block = np.flatnonzero(rank % m == 0)
        after = np.append(block[1:], len(h))
        owner = of[block]
        joined = np.append(owner[1:] == owner[:-1], False)  # the next block is of the same text
        stop = np.where(joined, np.append(after[1:], len(h)), after)
        hit = defaultdict(set)
        for factor in templates.factors[k, m]:
            low = np.minimum.reduceat(h * factor, block)
            low = np.where(joined, np.minimum(low, np.append(low[1:], U(0))), low)
            for i, t in group:
                for w in np.flatnonzero(low == (t * factor).min()).tolist():
                    hit[w].add(i)
        sets = dict(group)
        for w, names in hit.items():
            window = h[block[w] : stop[w]]
            for i in names:
                share = np.isin(sets[i], window).mean()
                if share >= containment:
                    found[owner[w]][i] = max(found[owner[w]].get(i, 0.0), float(share))
    return found


def scan(docs: DataFrame, listed: Sequence[tuple[str, str]] = TEMPLATES, k: int = 5, containment: float = 0.8, probability: float = 0.9999, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The licenses whose notice a text has: ``containment`` of its distinct k-word shingles or more within one window.

    Shorter notices are one shingle. Each text is scanned within its row, so there is no shuffle and no task depends on another.
    Null or empty text: no licenses. Null ids: rows like others. Repeated rows: a row each. Very long texts are whole. Other columns,
    whatever their names, are ignored. Templates without words match nothing. An empty table
    gives no rows.
    Returns doc_id, n_licenses, licenses (sorted, joined by commas), containment (the largest, null if none).
    """
    templates = Templates(listed, k, containment, probability)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in rolling.chunks(batch.column(1)):
                found = scan_chunk(data, offsets, templates, containment)
                names = [sorted({templates.names[i] for i in x}) for x in found]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array([len(x) for x in names], pa.int64()), pa.array([",".join(x) for x in names], pa.string()),
                    pa.array([max(x.values(), default=None) for x in found], pa.float64()),
                ], names=["doc_id", "n_licenses", "licenses", "containment"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, n_licenses long, licenses string, containment double")
