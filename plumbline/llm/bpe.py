"""Byte-level BPE as a streaming transducer with bounded lookahead, and its decoder.

A text is read in windows; pre-tokens end at places that no later text can move. How far a later
byte can reach back into the tokens of a pre-token follows from the merge list. Let two inputs
agree up to a place. Their tokens differ left of it only through merges across the frontier, each
of a higher rank than the one before, and the right part of a later one must begin with the left
part of the earlier one, because tokens only grow. The longest such chain of left parts is the
sufficient lookahead: tokens that end so many bytes before the end of what was read are stable,
and may be emitted and forgotten. So memory is bounded however long a text or pre-token is.

Pre-tokens of less than 64 bytes are whole in the window; those not met before are merged together,
round by round, in vectors. Longer ones run through the transducer, and those longer than a window
straight from the text, so white space is not needed for memory to stay bounded.

The decoder feeds token bytes through an incremental UTF-8 state machine.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import bound_batches

#: The pre-tokenizer's pattern: a fixed value of this kind of vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Places that end a pre-token whatever follows: before white space, and where a run of letters or of numbers ends.
BOUNDARY = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=[^\s\p{L}])|(?<=\p{N})(?=[^\s\p{N}])")
#: Settings without which a file is refused: fixed values of this kind of vocabulary.
SETTINGS = {
    "normalizer": (None,),
    "pre_tokenizer": ({"type": "ByteLevel", "add_prefix_space": False, "use_regex": True},),
    "post_processor": (None,),
    "decoder": ({"type": "ByteLevel"},),
    "model": ({"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "byte_fallback": False, "ignore_merges": False},),
}
TOKEN_FLAGS = ("single_word", "lstrip", "rstrip", "normalized")
#: Characters read at a time; bytes from which a pre-token runs through the transducer; pre-tokens remembered.
WINDOW, LONG, KNOWN = 1 << 18, 64, 200_000
NONE = np.int32(2**31 - 1)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary's strings: printable Latin-1 bytes as they are, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _refuse_others(spec: dict) -> None:
    """ValueError for a file that asks for what is not done here."""
    for name, (want,) in SETTINGS.items():
        own = spec.get(name)
        if want is None and own is not None or want is not None and (own is None or any(own.get(k, v) != v for k, v in want.items())):
            raise ValueError(f"{name} of the vocabulary file is not supported: {str(own)[:200]}")
    for token in spec.get("added_tokens", []):
        if any(token.get(k) for k in TOKEN_FLAGS):
            raise ValueError(f"flags of the added token {token.get('content')!r} are not supported")


class Vocabulary:
    """Tokens, merges and the lookahead of one vocabulary file."""

    def __init__(self, content: str):
        spec = json.loads(content)
        _refuse_others(spec)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token: list[bytes] = [b""] * size
        for name, i in vocab.items():
            self.token[i] = name.encode() if name in self.special else bytes(letters[c] for c in name)
        for name, i in self.special.items():
            self.token[i] = name.encode()
        self.byte_id = np.array([vocab[c] for c in sorted(letters, key=letters.get)], np.int32)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.merge = {(vocab[a], vocab[b]): (r, vocab[a + b]) for r, (a, b) in reversed(list(enumerate(pairs)))}
        self.pairs = [(self.token[vocab[a]], self.token[vocab[b]]) for a, b in pairs]
        self.lookahead = self._lookahead()
        self._table()
        lengths = np.array([len(t) for t in self.token], np.int64)
        self.token_at = np.concatenate([[0], np.cumsum(lengths)])
        self.token_bytes = np.frombuffer(b"".join(self.token), np.uint8)

    def _lookahead(self) -> int:
        """Bytes of the longest chain of merges that can carry a difference to the left."""
        reach: dict[bytes, int] = {}  # of later merges whose right part begins with the key
        most = 0
        for a, b in reversed(self.pairs):
            own = len(a) + reach.get(a, 0)
            most = max(most, own)
            for i in range(1, len(b) + 1):
                if reach.get(b[:i], 0) < own:
                    reach[b[:i]] = own
        return most

    def _table(self) -> None:
        """A hash table of the merges in cells of four: key, rank, merged id."""
        keys = np.array([a << 32 | b for a, b in self.merge], np.uint64)
        rank = np.array([r for r, _ in self.merge.values()], np.int32)
        new = np.array([i for _, i in self.merge.values()], np.int32)
        self.bits, self.factor = 17, 0x9E3779B97F4A7C15
        while True:
            cell = self._cell(keys)
            order = np.argsort(cell, kind="stable")
            place = np.arange(len(keys)) - np.searchsorted(cell[order], cell[order])
            if not len(keys) or place.max() < 4:
                break
            self.factor = (self.factor * 0xD1342543DE82EF95 + 2) % 2**64 | 1
        self.keys = np.full((1 << self.bits, 4), 2**64 - 1, np.uint64)
        self.ranks, self.news = np.full((1 << self.bits, 4), NONE), np.zeros((1 << self.bits, 4), np.int32)
        self.keys[cell[order], place], self.ranks[cell[order], place], self.news[cell[order], place] = keys[order], rank[order], new[order]

    def _cell(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(self.factor)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE if there is no merge) and merged id of each pair."""
        key = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)
        cell = self._cell(key)
        rank, new = np.full(len(key), NONE), np.zeros(len(key), np.int32)
        for j in range(4):
            hit = np.flatnonzero(self.keys[cell, j] == key)
            rank[hit], new[hit] = self.ranks[cell[hit], j], self.news[cell[hit], j]
        return rank, new

    def merge_many(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of many pre-tokens given as joined bytes: all ids, and how many each has."""
        n = len(lengths)
        sym, word = self.byte_id[data], np.repeat(np.arange(n), lengths)
        out_sym, out_word = [], []
        rank, new = self._pair_ranks(sym, word)
        while len(sym):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(sym)))
            if (least == NONE).any():  # these have all their tokens
                over = np.repeat(least == NONE, size)
                out_sym.append(sym[over])
                out_word.append(word[over])
                sym, word, rank, new = sym[~over], word[~over], rank[~over], new[~over]
                size, least = size[least != NONE], least[least != NONE]
                if not len(sym):
                    break
            hit = rank == np.repeat(least, size)
            at = np.flatnonzero(hit)
            if len(at) > 1 and (at[1:] == at[:-1] + 1).any():  # in a run of equal letters every other pair merges
                run = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1] + 1]))
                nth = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
                at = at[nth % 2 == 0]
            sym[at] = new[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            # only pairs that touch a merged token change
            moved = np.cumsum(keep) - 1
            sym, word, rank, new = sym[keep], word[keep], rank[keep], new[keep]
            touched = moved[at]
            near = np.zeros(len(sym), bool)
            near[touched] = near[touched[touched > 0] - 1] = True
            touched = np.flatnonzero(near)
            rank[touched] = NONE
            inner = touched[touched + 1 < len(sym)]
            inner = inner[word[inner] == word[inner + 1]]
            rank[inner], new[inner] = self.look_up(sym[inner], sym[inner + 1])
        sym, word = np.concatenate([np.zeros(0, np.int32), *out_sym]), np.concatenate([np.zeros(0, np.int64), *out_word])
        return sym[np.argsort(word, kind="stable")], np.bincount(word, minlength=n)

    def _pair_ranks(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, new = np.full(len(sym), NONE), np.zeros(len(sym), np.int32)
        inner = np.flatnonzero(word[:-1] == word[1:])
        rank[inner], new[inner] = self.look_up(sym[inner], sym[inner + 1])
        return rank, new

    def merge_one(self, data: bytes) -> list[int]:
        """Tokens of one pre-token: a queue of merges over a linked list."""
        sym, n = self.byte_id[np.frombuffer(data, np.uint8)].tolist(), len(data)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        queue = [(m[0], i, sym[i], sym[i + 1]) for i in range(n - 1) if (m := self.merge.get((sym[i], sym[i + 1])))]
        heapq.heapify(queue)
        while queue:
            _, i, a, b = heapq.heappop(queue)
            j = after[i]
            if sym[i] != a or j < 0 or sym[j] != b:
                continue
            sym[i], sym[j] = self.merge[a, b][1], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
                if m := self.merge.get((sym[i], sym[after[i]])):
                    heapq.heappush(queue, (m[0], i, sym[i], sym[after[i]]))
            if before[i] >= 0 and (m := self.merge.get((sym[before[i]], sym[i]))):
                heapq.heappush(queue, (m[0], before[i], sym[before[i]], sym[i]))
        return [x for x in sym if x >= 0]

    def stream(self, chunks: Iterator[bytes]) -> Iterator[int]:
        """Tokens of one pre-token that comes in chunks, each emitted once it is stable."""
        kept = b""
        for chunk in chunks:
            kept += chunk
            if len(kept) <= 2 * self.lookahead:
                continue
            done, stable = 0, len(kept) - self.lookahead
            for i in self.merge_one(kept):
                if done + len(self.token[i]) > stable:
                    break
                done += len(self.token[i])
                yield i
            kept = kept[done:]
        yield from self.merge_one(kept)


class Decoder:
    """Ids to text, a batch at a time: bytes that end inside a character wait for the next batch."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: np.ndarray, last: bool = False) -> str:
        v = self.vocabulary
        return self.state.decode(_ragged(v.token_bytes, v.token_at[ids], v.token_at[ids + 1] - v.token_at[ids]).tobytes(), last)


def _ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """values[start : start + length] of all slices, joined."""
    ends = np.cumsum(lengths)
    if not len(ends):
        return values[:0]
    return values[np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)]


class Run(NamedTuple):
    """One pre-token, ``text[a:b]``, that is longer than a window."""

    text: str
    a: int
    b: int

    def ids(self, vocabulary: Vocabulary) -> Iterator[np.ndarray]:
        """Its tokens, some thousands at a time."""
        stream = vocabulary.stream(self.text[k : min(k + 4096, self.b)].encode() for k in range(self.a, self.b, 4096))
        while len(own := np.fromiter(islice(stream, 1 << 16), np.int32)):
            yield own


class Encoder:
    """Texts to ids, a window at a time."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.pattern = regex.compile(PATTERN)
        self.find = self.pattern.findall
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True))) + ")") if vocabulary.special else None
        self._forget()

    def _forget(self) -> None:
        self.known: defaultdict[str, int] = defaultdict()
        self.known.default_factory = self.known.__len__  # new ones are numbered in turn
        self.ids, self.at, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def windows(self, text: str) -> Iterator[str | Run]:
        """Parts of a text that can be encoded alone; pre-tokens of over a window come as runs."""
        lo, n = 0, len(text)
        while n - lo > WINDOW:
            hi = self._boundary(text, lo + WINDOW)
            if hi - lo <= 4 * WINDOW:
                yield text[lo:hi]
            else:
                yield from self._runs(text, lo, hi)
            lo = hi
        yield text[lo:]

    def _boundary(self, text: str, at: int) -> int:
        """The first place from ``at`` on that ends a pre-token and is in no special token."""
        for m in BOUNDARY.finditer(text, at):
            hi = m.start()
            if hi > at and not any(text.find(s, max(0, hi - len(s) + 1), hi + len(s) - 1) >= 0 for s in self.v.special):
                return hi
        return len(text)

    def _runs(self, text: str, lo: int, hi: int) -> Iterator[str | Run]:
        if self.specials and (m := self.specials.search(text, lo, hi)):
            yield from self._runs(text, lo, m.start())
            yield m[0]
            yield from self._runs(text, m.end(), hi)
            return
        for m in self.pattern.finditer(text, lo, hi):
            if m.end() - m.start() > WINDOW:
                yield text[lo : m.start()]
                yield Run(text, *m.span())
                lo = m.end()
        yield text[lo:hi]

    def encode(self, parts: list[str]) -> list[np.ndarray]:
        """The ids of each part."""
        if len(self.known) > KNOWN:
            self._forget()
        tokens, counts, find = [], [], self.find
        for part in parts:
            before = len(tokens)
            if any(s in part for s in self.v.special):
                for piece in self.specials.split(part):
                    tokens += [(piece,)] if piece in self.v.special else find(piece)
            else:
                tokens += find(part)
            counts.append(len(tokens) - before)
        known, old = self.known, len(self.known)
        codes = np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
        if len(known) > old:
            self._learn(list(known)[old:])
        size = self.size[codes]
        ids = _ragged(self.ids, self.at[codes], size)
        ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum(counts)] if len(codes) else np.zeros(len(parts), np.int64)
        return np.split(ids, ends[:-1]) if parts else []

    def _learn(self, new: list) -> None:
        raw = [b"" if isinstance(t, tuple) else t.encode() for t in new]
        odd = {i: [self.v.special[t[0]]] for i, t in enumerate(new) if isinstance(t, tuple)}
        for i, b in enumerate(raw):
            if len(b) >= LONG:
                odd[i] = list(self.v.stream(b[k : k + 4096] for k in range(0, len(b), 4096)))
                raw[i] = b""
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        ids, size = self.v.merge_many(np.frombuffer(b"".join(raw), np.uint8), lengths)
        at = np.cumsum(size) - size
        if odd:
            tail, place = [], len(ids)
            for i, own in odd.items():
                at[i], size[i] = place, len(own)
                place += len(own)
                tail += own
            ids = np.concatenate([ids, np.array(tail, np.int32)])
        self.at = np.concatenate([self.at, at + len(self.ids)])
        self.size, self.ids = np.concatenate([self.size, size]), np.concatenate([self.ids, ids])


_LOADED: dict[str, tuple[Vocabulary, Encoder]] = {}


def loaded(content: str) -> tuple[Vocabulary, Encoder]:
    """Vocabulary and encoder of a file's content, kept by the worker."""
    key = hashlib.sha256(content.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        v = Vocabulary(content)
        _LOADED[key] = v, Encoder(v)
    return _LOADED[key]


def _rows(encoder: Encoder, vocabulary: Vocabulary, column: list[str | None], with_ids: bool) -> Iterator[tuple]:
    """For each text: tokens, digest of ids, digest of the decoded text, and ids if asked."""
    waiting: list[tuple[int, str]] = []
    states: dict[int, list] = {}

    def put(s: list, ids: np.ndarray) -> None:
        s[0] += len(ids)
        s[1].update(ids.astype("<u4").tobytes())
        s[2].update(s[3].feed(ids).encode())
        if with_ids:
            s[4].append(ids)

    def flush() -> None:
        for (row, _), ids in zip(waiting, encoder.encode([p for _, p in waiting]), strict=True):
            put(states[row], ids)
        waiting.clear()

    held = 0
    for row, text in enumerate(column):
        states[row] = [0, hashlib.sha256(), hashlib.sha256(), Decoder(vocabulary), []]
        for part in encoder.windows(text or ""):
            if isinstance(part, Run):
                flush()
                held = 0
                for ids in part.ids(vocabulary):
                    put(states[row], ids)
                continue
            waiting.append((row, part))
            held += len(part)
            if held >= WINDOW:
                flush()
                held = 0
    flush()
    for row in range(len(column)):
        n, ids_sha, text_sha, decoder, ids = states[row]
        text_sha.update(decoder.feed(np.zeros(0, np.int64), True).encode())
        yield n, ids_sha.hexdigest(), text_sha.hexdigest(), np.concatenate([np.zeros(0, np.int32), *ids])


def encode(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256`` of each row, and its ``ids`` if asked.

    Null and empty texts have no tokens. Special tokens' strings in a text become their ids. Digests
    are of the ids as little-endian 32-bit integers and of the decoded text in UTF-8. Each row is
    encoded on its own, so repeated rows, null ids and further columns play no part. The
    vocabulary is a file of fixed size on the driver, shipped with the tasks; one with another
    normaliser, pre-tokenizer, model or kind of added token is a ValueError.
    """
    spark = docs.sparkSession
    bound_batches(spark, rows=1000, megabytes=8)
    with open(vocabulary_path, encoding="utf-8") as f:
        read = f.read()
    _refuse_others(json.loads(read))
    content = spark.sparkContext.broadcast(read)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, encoder = loaded(content.value)
        for x in batches:
            n, ids_sha, text_sha, ids = zip(*_rows(encoder, vocabulary, x.column(1).to_pylist(), with_ids), strict=True) if x.num_rows else ((), (), (), ())
            columns = [x.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                columns, names = [*columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"`{id_col}` {source.schema['id'].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return source.mapInArrow(run, schema)


def decode(rows: DataFrame, vocabulary_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col, text``: the text of each list of ids; null and empty lists give the empty text, bytes that are no UTF-8 U+FFFD."""
    spark = rows.sparkSession
    with open(vocabulary_path, encoding="utf-8") as f:
        content = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, _ = loaded(content.value)
        for x in batches:
            texts = []
            for ids in x.column(1).to_pylist():
                decoder, own = Decoder(vocabulary), np.array(ids or [], np.int64)
                texts.append("".join([decoder.feed(own[k : k + WINDOW]) for k in range(0, len(own), WINDOW)]) + decoder.feed(own[:0], True))
            yield pa.RecordBatch.from_arrays([x.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    source = rows.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return source.mapInArrow(run, f"`{id_col}` {source.schema['id'].dataType.simpleString()}, text string")
