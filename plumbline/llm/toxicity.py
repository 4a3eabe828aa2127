"""Toxicity by noisy-channel deobfuscation.

Insults hide behind look-alike signs (``1d10t``), separators (``i.d.i.o.t``, ``i d i o t``) and
repeated letters (``idiooot``). A suspicious word spans a lattice: each sign may stand for itself,
for letters it looks like, or for nothing, and repeats may collapse. A Viterbi search finds the
path that is likeliest under a trigram model of letters, counted over all documents and raised by
the words that the labels point out. Other words have one path only, themselves, so restoring
them costs nothing. Texts are scored after restoring, by a logistic model over the six-byte
pieces of words that tell the labelled documents apart best.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as wt
from .store import bound_batches, stash

U = np.uint64
#: At most about so many labelled rows are learned from, drawn by a hash of their id.
SAMPLE = 6000
#: Pieces that the model weighs; values that a piece is hashed to; bytes of a piece.
PIECES, SPACE_BITS, PIECE = 512, 20, 6
#: What signs may stand for: fixed values of leetspeak.
LOOKS = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c"}
#: Costs in nats: a look-alike, a repeat that goes, a separator, a sign that stands for nothing.
LOOK_COST, REPEAT_COST, SEPARATOR_COST, NOTHING_COST = 1.0, 1.5, 0.5, 6.0

LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True
SIGN = np.zeros(256, bool)
SIGN[[ord(c) for c in LOOKS]] = True
#: Signs that are suspicious at a word's end too; others are punctuation there.
END_SIGN = np.zeros(256, bool)
END_SIGN[[ord(c) for c in "0134578"]] = True
SYMBOL = np.zeros(256, np.int32)  # 0 a boundary, 1 to 26 letters, 27 other bytes of letters
SYMBOL[97:123] = SYMBOL[65:91] = np.arange(1, 27)
SYMBOL[128:] = 27
K = 28


def lowered(raw: np.ndarray) -> np.ndarray:
    """Lower case for A-Z and the capitals of Latin-1, in UTF-8."""
    out = wt.LOWER[raw]
    second = np.flatnonzero((raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)) + 1
    out[second] += 0x20
    return out


def letter_counts(column: pa.Array) -> np.ndarray:
    """Trigrams of letter symbols of all texts (K^3), each text between boundaries of its own."""
    total = np.zeros(K**3, np.int64)
    for lo, hi, raw, at, _ in wt.parts(column, 0):
        s = np.zeros(len(raw) + 2 * (hi - lo + 1), np.int32)
        s[np.arange(len(raw)) + np.repeat(2 * np.arange(1, hi - lo + 1), np.diff(at))] = SYMBOL[raw]
        total += np.bincount((s[:-2] * K + s[1:-1]) * K + s[2:], minlength=K**3)
    return total


class Restorer:
    """Viterbi search under trigram counts; words found before are remembered."""

    def __init__(self, counts: np.ndarray, lexicon: list[str] = ()):
        c = counts.astype(np.float64).reshape(K, K, K) + 0.01
        for word in lexicon:
            s = [0, 0, *(int(SYMBOL[b]) for b in word.encode()), 0]
            for a, b, d in zip(s, s[1:], s[2:], strict=False):
                c[a, b, d] += 0.02 * c[a, b].sum()
        self.logp = np.log(c / c.sum(axis=2, keepdims=True)).tolist()
        self.known: dict[str, str] = {}

    def restore(self, word: str) -> str:
        if word not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[word] = self._search(word.lower())
        return self.known[word]

    def _search(self, word: str) -> str:
        logp = self.logp
        # state: last two symbols and the last letter read -> (score, letters so far as a linked list)
        states: dict[tuple, tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        before = ""
        for ch in word:
            symbol = int(SYMBOL[ord(ch)]) if ord(ch) < 128 else 27
            if symbol:
                options = [(ch, symbol, 0.0)]
                if ch == before:
                    options.append(("", 0, REPEAT_COST))
            elif ch in LOOKS:
                options = [(x, ord(x) - 96, LOOK_COST) for x in LOOKS[ch]]
                options.append(("", 0, REPEAT_COST if ch == before else NOTHING_COST))
            else:
                options = [("", 0, SEPARATOR_COST)]
            before = ch
            new: dict[tuple, tuple[float, tuple | None]] = {}
            for (a, b), (score, path) in states.items():
                for letter, s, cost in options:
                    if letter:
                        key, value = (b, s), score + logp[a][b][s] - cost
                    else:
                        key, value = (a, b), score - cost
                    if key not in new or value > new[key][0]:
                        new[key] = value, (path, letter) if letter else path
            states = new
        _, path = max(((score + logp[a][b][0], path) for (a, b), (score, path) in states.items()), key=lambda x: x[0])
        out = []
        while path is not None:
            path, letter = path
            out.append(letter)
        return "".join(reversed(out))


def _suspects(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> list[tuple[int, int]]:
    """Slices of the bytes whose lattice has more than one path."""
    letter = LETTER[raw]
    before = np.concatenate([[0], np.cumsum(letter, dtype=np.int64)])
    at = np.flatnonzero(letter)
    n_letters = before[ends] - before[starts]
    some = np.flatnonzero(n_letters > 0)
    if not len(some):
        return []
    s, e = starts[some], ends[some]
    a, b = at[before[s]], at[before[e] - 1] + 1  # from the first letter to the last
    odd = (b - a) > n_letters[some]
    odd |= (a > s) & SIGN[raw[np.maximum(a - 1, 0)]]
    odd |= (b < e) & END_SIGN[raw[np.minimum(b, len(raw) - 1)]]
    tail = e - b
    odd |= (tail > 0) & (tail < 3) & np.isin(raw[np.minimum(b, len(raw) - 1)], [ord("$"), ord("@")])
    thrice = np.flatnonzero(letter[2:] & (raw[2:] == raw[1:-1]) & (raw[1:-1] == raw[:-2]) & (raw[2:] < 128))
    if len(thrice):
        hit = np.searchsorted(starts, thrice, "right") - 1
        odd |= np.isin(some, hit)
    out = list(zip(s[odd].tolist(), e[odd].tolist(), strict=True))
    # three or more single letters or signs in a row
    single = (ends - starts == 1) & (letter[starts] | SIGN[raw[starts]])
    single = np.concatenate([[False], single, [False]])
    up, down = np.flatnonzero(single[1:] & ~single[:-1]), np.flatnonzero(single[:-1] & ~single[1:])
    for i, j in zip(up.tolist(), down.tolist(), strict=True):
        for lo, hi in _within_texts(i, j, first):
            if hi - lo >= 3:
                out.append((int(starts[lo]), int(ends[hi - 1])))
    return sorted(out)


def _within_texts(i: int, j: int, first: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = [i, *first[np.searchsorted(first, i, "right") : np.searchsorted(first, j, "left")].tolist(), j]
    yield from zip(cuts, cuts[1:], strict=False)


def restored(raw: np.ndarray, at: np.ndarray, restorer: Restorer) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case letters of the texts, restored, all else spaces; offsets; and words of each text."""
    starts, ends, first = wt.word_bounds(raw, at)
    plain = lowered(raw)
    plain[~LETTER[raw]] = 32
    parts, places, lo = [], [], 0
    shift = np.zeros(len(at), np.int64)
    for a, b in _suspects(raw, starts, ends, first):
        if a < lo:
            continue
        new = restorer.restore(raw[a:b].tobytes().decode("utf-8", "replace")).encode()
        new = lowered(np.frombuffer(b" " + new + b" ", np.uint8))
        parts += [plain[lo:a], new]
        places.append((b, len(new) - (b - a)))
        lo = b
    parts.append(plain[lo:])
    if places:
        where = np.array([p for p, _ in places])
        shift = np.concatenate([[0], np.cumsum([d for _, d in places])])[np.searchsorted(where, at, "right")]
    return np.concatenate(parts), at + shift, np.diff(first)


def pieces(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed pieces of the texts and the text of each; a text is read with a space on both sides."""
    n = len(at) - 1
    size = np.diff(at)
    joined = np.full(len(data) + 2 * n + 8, 32, np.uint8)
    new_at = at[:-1] + 2 * np.arange(n) + 1
    inside = np.arange(len(data)) + np.repeat(2 * np.arange(n) + 1, size)
    joined[inside] = data
    view = np.lib.stride_tricks.as_strided(joined[:8].view("<u8"), (len(joined) - 7,), (1,))
    count = np.maximum(size + 2 - PIECE + 1, 0)
    ends = np.cumsum(count)
    text = np.repeat(np.arange(n), count)
    pos = np.arange(ends[-1] if n else 0) + np.repeat(new_at - 1 - (ends - count), count)
    gram = view[pos] & U(2 ** (8 * PIECE) - 1)
    return (wt.mix64(gram) >> U(64 - SPACE_BITS)).astype(np.int64), text


def _counted(column: pa.Array, restorer: Restorer, place: np.ndarray | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts lo .. hi-1: text, piece and number of each piece that a text has, and words of each text.

    With ``place`` pieces come as their places in it, those without one not at all. A text of over a
    megabyte is read in segments that end behind a word.
    """
    held, words, done = np.zeros(0, np.int64), np.zeros(1, np.int64), None

    def whole() -> tuple:
        piece = np.flatnonzero(held)
        return done, done + 1, np.zeros(len(piece), np.int64), piece, held[piece], words

    for lo, hi, raw, at, _ in wt.parts(column, 0, 1 << 20):
        if done is not None and lo != done:  # the long text before is complete
            yield whole()
            done = None
        text, new_at, n_words = restored(raw, at, restorer)
        piece, doc = pieces(text, new_at)
        if place is not None:
            piece = place[piece]
            doc, piece = doc[piece >= 0], piece[piece >= 0]
        if lo == done:
            held, words = held + np.bincount(piece, minlength=1 << SPACE_BITS), words + n_words
        elif hi - lo == 1 and len(raw) > 1 << 19:
            held, words, done = np.bincount(piece, minlength=1 << SPACE_BITS), n_words, lo
        else:
            cell, count = np.unique(doc << SPACE_BITS | piece, return_counts=True)
            yield lo, hi, cell >> SPACE_BITS, cell & ((1 << SPACE_BITS) - 1), count, n_words
    if done is not None:
        yield whole()


def _values(hit: np.ndarray, text: np.ndarray, count: np.ndarray, n_words: np.ndarray, n: int) -> np.ndarray:
    """Model inputs: whether a piece occurs, and its density; (texts, 2 x pieces)."""
    table = np.zeros((len(n_words), n))
    table[text, hit] = count
    density = np.log1p(200 * table / np.maximum(n_words, 20)[:, None])
    return np.concatenate([np.minimum(table, 1), density], axis=1).astype(np.float32)


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 400, rate: float = 0.05, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the whole batch with a ridge."""
    w, m, v, b, mb, vb = np.zeros(x.shape[1]), 0.0, 0.0, 0.0, 0.0, 0.0
    if len(y):
        b = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    for t in range(1, steps + 1 if len(y) else 1):
        error = 1 / (1 + np.exp(-np.clip(x @ w.astype(np.float32) + b, -30, 30))) - y
        g, gb = x.T @ error.astype(np.float32) / len(y) + decay * w, error.mean()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        b = b - rate * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.999**t)) + 1e-8)
    return w, b


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """About ``sample`` labelled rows ``text, y`` that may be learned from, by a hash of their id.

    They are written once, so documents are scanned once however often the rows are read. Of rows
    that repeat an id, and of labels that do, one counts.
    """
    own = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & learn).select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("y"))
    n = own.count()
    some = own.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, sample / max(n, 1)) + 1)).limit(2 * sample)
    # at most 2 * sample rows of 12 bytes
    found = stash(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(some), "_id"), "sample")
    # rows that repeat an id are one, so what is learned from is bounded by labels
    if found.count() > found.select("_id").distinct().count():
        found = stash(found.groupBy("_id").agg(F.min(F.struct(F.xxhash64("text"), "text", "y")).alias("x")).select("_id", "x.text", "x.y"), "sample")
    return found.select("text", "y")


def learn_letters(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Letter trigrams of all documents; at most K^3 sums reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(K**3, np.int64)
        for x in batches:
            total += letter_counts(x.column(0))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["k", "n"])

    out = np.zeros(K**3, np.int64)
    rows = docs.select(text_col).mapInArrow(run, "k bigint, n bigint").groupBy("k").agg(F.sum("n").alias("n"))
    for k, n in rows.toLocalIterator():
        out[k] = n
    return out


class Model:
    """Letter counts, pieces, weights."""

    def __init__(self, letters: np.ndarray, chosen: np.ndarray, weights: np.ndarray, bias: float, lexicon: list[str]):
        self.letters, self.chosen, self.weights, self.bias, self.lexicon = letters, chosen, weights, bias, lexicon
        self.place = np.full(1 << SPACE_BITS, -1, np.int32)
        self.place[chosen] = np.arange(len(chosen))

    def scores(self, column: pa.Array, restorer: Restorer) -> np.ndarray:
        out = np.zeros(len(column))
        for lo, hi, doc, k, count, n_words in _counted(column, restorer, self.place):
            density = np.log1p(200 * count / np.maximum(n_words[doc], 20))
            z = np.bincount(doc, self.weights[k] + density * self.weights[k + len(self.chosen)], minlength=hi - lo) + self.bias
            out[lo:hi] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return out


def train(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from labelled rows for which ``learn`` holds. Without labels of both kinds the score is their share."""
    spark = docs.sparkSession
    bound_batches(spark)
    letters = learn_letters(docs, text_col)
    rows = labelled_sample(docs, labels, label, learn, sample, id_col, text_col)
    shipped = spark.sparkContext.broadcast(letters)

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shipped.value)
        counts = np.zeros((2, 1 << SPACE_BITS), np.int32)
        n = np.zeros(2, np.int64)
        for x in batches:
            y = x.column(1).to_numpy()
            n += [np.sum(y == 0), np.sum(y == 1)]
            for lo, hi, text, piece, _, _ in _counted(x.column(0), restorer):
                kind = y[lo:hi][text]
                for k in (0, 1):
                    counts[k] += np.bincount(piece[kind == k], minlength=1 << SPACE_BITS).astype(np.int32)
        at = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(counts[0][at], n[0]).astype(np.int64)), pa.array(np.append(counts[1][at], n[1]).astype(np.int64))], ["k", "n0", "n1"])

    found = rows.coalesce(6).mapInArrow(presence, "k bigint, n0 bigint, n1 bigint").groupBy("k").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    found = found.where("k = -1 or n1 >= 3").toPandas()
    total = found[found.k == -1]
    n0, n1 = (int(total.n0.sum()), int(total.n1.sum())) if len(total) else (0, 0)
    found = found[found.k >= 0]
    a, b = found.n1.to_numpy(float), found.n0.to_numpy(float)
    # likelihood ratio of a piece being as common among toxic as among other texts
    rate1, rate0, both = (a + 0.5) / (n1 + 1), (b + 0.5) / (n0 + 1), (a + b + 0.5) / (n0 + n1 + 1)
    gain = np.where(rate1 > rate0, a * np.log(rate1 / both) + b * np.log(rate0 / both), -1)
    best = np.argsort(-gain, kind="stable")[:PIECES]
    chosen = np.sort(found.k.to_numpy()[best[gain[best] > 0]])

    place = np.full(1 << SPACE_BITS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    n = len(chosen)

    def inputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shipped.value)
        for x in batches:
            for lo, hi, text, hit, count, n_words in _counted(x.column(0), restorer, place):
                v = _values(hit, text, count, n_words, n)
                yield pa.RecordBatch.from_arrays([pa.array([r.astype(np.float16).tobytes() for r in v], pa.binary()), x.column(1).slice(lo, hi - lo)], ["x", "y"])

    table = rows.mapInArrow(inputs, "x binary, y int").toPandas()  # at most 2 * sample rows of 2 KB
    x = np.frombuffer(b"".join(table.x), np.float16).reshape(len(table), 2 * n).astype(np.float32)
    y = table.y.to_numpy(np.float32)
    if n == 0:
        return Model(letters, chosen, np.zeros(0), float(fit_logistic(x, y)[1]), [])
    weights, bias = fit_logistic(x, y)
    return Model(letters, chosen, weights, bias, _lexicon(rows, place, weights[:n] + weights[n:], shipped))


def _lexicon(rows: DataFrame, place: np.ndarray, weight: np.ndarray, letters) -> list[str]:
    """Words of toxic rows whose pieces all weigh much: at most 200, by how many texts have them."""
    heavy = float(np.quantile(weight[weight > 0], 0.5)) if (weight > 0).any() else np.inf

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(letters.value)
        for x in batches:
            out = []
            for lo, hi, raw, at, _ in wt.parts(x.column(0), 0, 1 << 20):
                text, new_at, _ = restored(raw, at, restorer)
                for i in range(hi - lo):
                    own = sorted({w for w in text[new_at[i] : new_at[i + 1]].tobytes().split(b" ") if 4 <= len(w) <= 16 and w.isalpha()})
                    if own:
                        padded = np.frombuffer(b"".join(b" " + w + b" " for w in own), np.uint8)
                        ends = np.cumsum([len(w) + 2 for w in own])
                        piece, word = pieces_of_slices(padded, ends)
                        w8 = np.where(place[piece] >= 0, weight[np.maximum(place[piece], 0)], 0.0)
                        least = np.full(len(own), np.inf)
                        np.minimum.at(least, word, w8)
                        out += [own[j].decode() for j in np.flatnonzero((least >= heavy) & np.isfinite(least))]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["w"])

    words = rows.where("y = 1").select("text").mapInArrow(run, "w string").groupBy("w").count().where("count >= 3")
    return [r.w for r in words.orderBy(F.desc("count"), "w").limit(200).collect()]


def pieces_of_slices(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces that lie wholly in the slices with these ends, and the slice of each."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    view = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (len(data) + 1,), (1,))
    size = np.diff(np.concatenate([[0], ends]))
    count = np.maximum(size - PIECE + 1, 0)
    stop = np.cumsum(count)
    word = np.repeat(np.arange(len(ends)), count)
    pos = np.arange(stop[-1]) + np.repeat(ends - size - (stop - count), count)
    return (wt.mix64(view[pos] & U(2 ** (8 * PIECE) - 1)) >> U(64 - SPACE_BITS)).astype(np.int64), word


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score`` of each row; nulls and blank texts get the score of a text without pieces."""
    bound_batches(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        restorer = Restorer(m.letters, m.lexicon)
        for x in batches:
            yield pa.RecordBatch.from_arrays([x.column(0), pa.array(m.scores(x.column(1), restorer))], [id_col, "score"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, f"`{id_col}` {source.schema['id'].dataType.simpleString()}, score double")
