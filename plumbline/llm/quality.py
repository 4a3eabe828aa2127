"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature is cut into bins. Cyclic boosting visits the features in turn; each time a shallow
tree of few leaves over the feature's bins takes a small step along the residuals, and all trees
of a feature add up to one lookup table. Then the pairs of features whose four-quadrant trees
explain most of what is left are boosted in the same way into two-way tables. A text's score is
the logistic of a sum of table entries, found by adding one entry for each table to a vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as wt
from .rules import SYMBOLS, _per_text, _repeats
from .store import bound_batches
from .toxicity import labelled_sample

#: At most about so many labelled rows are learned from, drawn by a hash of their id.
SAMPLE = 20_000
BINS, PAIR_BINS, PAIRS, ROUNDS, PAIR_ROUNDS, RATE, LEAVES = 32, 8, 6, 150, 80, 0.1, 3
FEATURES = ["words", "word_length", "upper", "symbols", "digits", "ends", "same_next", "repeated_runs", "repeated_lines", "distinct_words", "line_words", "signs_alone", "exclaims"]
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def features(column: pa.Array) -> np.ndarray:
    """FEATURES of each text, (texts, features); of whole texts, nulls as empty."""
    data, offsets = wt.texts(column)
    out = np.zeros((len(offsets) - 1, len(FEATURES)))
    for lo, hi in wt.groups(offsets):
        raw, at = wt.group_bytes(data, offsets, lo, hi)
        starts, ends, first = wt.word_bounds(raw, at)
        n = np.diff(first)
        some, size = np.maximum(n, 1), np.maximum(np.diff(at), 1)
        names = wt.slice_names(raw, starts, ends)
        doc = np.repeat(np.arange(hi - lo), n)
        flags = wt.IS_WORD[raw] & ((raw & 0xC0) != 0x80)
        letters = np.maximum(_per_text(_LETTER[raw] & ((raw & 0xC0) != 0x80), at), 1)
        same = np.zeros(len(names), bool)
        same[1:] = (names[1:] == names[:-1]) & (doc[1:] == doc[:-1])
        later, _ = _repeats(names, doc)
        runs = wt.run_starts(first, 3)
        run_doc = doc[runs]
        again, _ = _repeats(wt.runs_names(names, 3)[runs], run_doc)
        breaks = _per_text(raw == 10, at)
        begin = np.union1d(at[:-1][np.diff(at) > 0], np.flatnonzero(raw == 10) + 1)
        begin = begin[begin < len(raw)]
        stop = np.append(begin[1:], len(raw))
        line_doc = np.searchsorted(at, begin, "right") - 1
        line_again, _ = _repeats(wt.slice_names(raw, begin, stop), line_doc)
        alone = np.zeros(len(starts), bool) if not len(starts) else (ends - starts == 1) & SYMBOLS[raw[starts]]
        closing = np.isin(raw[ends - 1], list(b".!?,;:")) if len(ends) else np.zeros(0, bool)
        for j, v in enumerate([
            np.log1p(n),
            _per_text(flags, at) / some,
            _per_text(_UPPER[raw], at) / letters,
            _per_text(SYMBOLS[raw], at) / size,
            _per_text(_DIGIT[raw], at) / size,
            _per_text(closing, first) / some,
            _per_text(same, first) / some,
            np.bincount(run_doc[again], minlength=hi - lo) / some,
            np.bincount(line_doc[line_again], minlength=hi - lo) / (breaks + 1),
            1 - _per_text(later, first) / some,
            np.log1p(n / (breaks + 1)),
            _per_text(alone, first) / some,
            _per_text(raw == 33, at) / some,
        ]):
            out[lo:hi, j] = v
    return out


def _tree(gain_g: np.ndarray, gain_h: np.ndarray, leaves: int) -> np.ndarray:
    """Newton values of a tree over ordered bins with sums of residuals and weights: best cuts first."""
    cuts = [0, len(gain_g)]
    g, h = np.concatenate([[0], np.cumsum(gain_g)]), np.concatenate([[0], np.cumsum(gain_h)])
    worth = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1.0)
    while len(cuts) <= leaves:
        best = (1e-9, None)
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b - a > 1:
                k = np.arange(a + 1, b)
                gain = worth(a, k) + worth(k, b) - worth(a, b)
                i = int(np.argmax(gain))
                if gain[i] > best[0]:
                    best = (float(gain[i]), int(k[i]))
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(gain_g))
    for a, b in zip(cuts, cuts[1:], strict=False):
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + 1.0)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best two-cut tree over a grid: its gain and its values in each cell."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    tg, th = cg[-1, -1], ch[-1, -1]
    parts = []
    for c, t in ((cg, tg), (ch, th)):
        a, left, top = c[:-1, :-1], c[:-1, -1:], c[-1:, :-1]
        parts.append((a, left - a, top - a, t - left - top + a))
    gain = sum(pg**2 / (ph + 1.0) for pg, ph in zip(*parts, strict=True)) - tg**2 / (th + 1.0)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    v = [float(pg[i, j] / (ph[i, j] + 1.0)) for pg, ph in zip(*parts, strict=True)]
    out = np.empty_like(g)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = v
    return float(gain[i, j]), out


class Additive:
    """Bin edges, a table for each feature, and tables of pairs."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        n, self.width = x.shape
        spread = np.linspace(0, 1, BINS + 1)[1:-1]
        self.edges = [np.unique(np.quantile(x[:, j], spread)) if n else np.zeros(0) for j in range(self.width)]
        self.pair_edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, PAIR_BINS + 1)[1:-1])) if n else np.zeros(0) for j in range(self.width)]
        self.bias = float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: list[tuple[int, int, np.ndarray]] = []
        if n:
            self._boost(x, y)

    @staticmethod
    def _bins(x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]

    def _boost(self, x: np.ndarray, y: np.ndarray) -> None:
        bins, z = self._bins(x, self.edges), np.full(len(y), self.bias)
        for _ in range(ROUNDS):
            for j, b in enumerate(bins):
                p = 1 / (1 + np.exp(-z))
                k = len(self.tables[j])
                step = RATE * _tree(np.bincount(b, y - p, k), np.bincount(b, p * (1 - p), k), LEAVES)
                self.tables[j] += step
                z += step[b]
        coarse = self._bins(x, self.pair_edges)
        p = 1 / (1 + np.exp(-z))

        def grid(i: int, j: int, v: np.ndarray) -> np.ndarray:
            a, b = len(self.pair_edges[i]) + 1, len(self.pair_edges[j]) + 1
            return np.bincount(coarse[i] * b + coarse[j], v, a * b).reshape(a, b)

        usable = [j for j, e in enumerate(self.pair_edges) if len(e)]
        found = sorted(((-_quadrants(grid(i, j, y - p), grid(i, j, p * (1 - p)))[0], i, j) for i, j in combinations(usable, 2)))[:PAIRS]
        self.pairs = [(i, j, np.zeros((len(self.pair_edges[i]) + 1, len(self.pair_edges[j]) + 1))) for _, i, j in found]
        for _ in range(PAIR_ROUNDS):
            for i, j, table in self.pairs:
                p = 1 / (1 + np.exp(-z))
                step = RATE * _quadrants(grid(i, j, y - p), grid(i, j, p * (1 - p)))[1]
                table += step
                z += step[coarse[i], coarse[j]]

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for table, b in zip(self.tables, self._bins(x, self.edges), strict=True):
            z += table[b]
        coarse = self._bins(x, self.pair_edges)
        for i, j, table in self.pairs:
            z += table[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-z))


def train(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Additive:
    """Learn from labelled rows for which ``learn`` holds. Without labels of both kinds the score is their share."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            yield pa.RecordBatch.from_arrays([*map(pa.array, features(x.column(0)).T), x.column(1)], [*FEATURES, "y"])

    rows = labelled_sample(docs, labels, label, learn, sample, id_col, text_col)
    table = rows.mapInArrow(run, ", ".join(f"{f} double" for f in FEATURES) + ", y int").toPandas()  # at most 2 * sample rows
    table = table.sort_values([*FEATURES, "y"])  # sums then don't depend on the order of rows
    return Additive(table[FEATURES].to_numpy(float), table.y.to_numpy(float))


def score(docs: DataFrame, model: Additive, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score`` of each row, of whole texts; null texts score as empty ones."""
    bound_batches(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            yield pa.RecordBatch.from_arrays([x.column(0), pa.array(shipped.value.scores(features(x.column(1))))], [id_col, "score"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, f"`{id_col}` {source.schema['id'].dataType.simpleString()}, score double")
