"""SHA-256 over the rows of a table in order, of any size: a digest whose state goes from range to range.

A flat digest has one reading order, so it can't be added up from parts. Rows are sorted by ranges on
all executors and written; then each range in turn is digested by one task, which gets the state that
the range before left, 40 bytes and what is left of a block. No place holds more than a range, nothing
but states passes through the driver, and a lost executor costs the range that it was at.
"""

from __future__ import annotations

import ctypes
import ctypes.util
import hashlib
import json
import math
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..tables import stash, unstash


class _Context(ctypes.Structure):
    """The state of the system library's digest."""

    _fields_ = [("h", ctypes.c_uint32 * 8), ("low", ctypes.c_uint32), ("high", ctypes.c_uint32), ("data", ctypes.c_uint8 * 64), ("num", ctypes.c_uint32), ("size", ctypes.c_uint32)]


def _library() -> ctypes.CDLL | None:
    """The system's crypto library, if it has a digest whose state can be read and agrees with Python's."""
    try:
        lib = ctypes.CDLL(ctypes.util.find_library("crypto") or "libcrypto.so.3")
        c, out = _Context(), ctypes.create_string_buffer(32)
        lib.SHA256_Update.argtypes = [ctypes.c_void_p, ctypes.c_char_p, ctypes.c_size_t]
        lib.SHA256_Init(ctypes.byref(c))
        lib.SHA256_Update(ctypes.byref(c), b"a" * 150, 150)
        agrees = (c.num, c.low, bytes(c.data[:22])) == (22, 1200, b"a" * 22)
        lib.SHA256_Final(out, ctypes.byref(c))
        return lib if agrees and out.raw == hashlib.sha256(b"a" * 150).digest() else None
    except (OSError, AttributeError):
        return None


def _roots() -> tuple[list[int], list[int]]:
    """The first 32 bits behind the point of square roots of 8, and of cube roots of 64 primes."""
    primes = [p for p in range(2, 312) if all(p % q for q in range(2, math.isqrt(p) + 1))][:64]

    def cube(n: int) -> int:
        x = round(n ** (1 / 3))
        while x**3 > n:
            x -= 1
        while (x + 1) ** 3 <= n:
            x += 1
        return x

    return [math.isqrt(p << 64) & 0xFFFFFFFF for p in primes[:8]], [cube(p << 96) & 0xFFFFFFFF for p in primes]


_START, _ROUND = _roots()


def _compress(h: list[int], block: bytes) -> list[int]:
    """One block of the digest, where there is no library: right, and slow."""
    turn = lambda x, n: (x >> n | x << 32 - n) & 0xFFFFFFFF
    w = list(struct.unpack(">16I", block))
    for i in range(16, 64):
        s, t = w[i - 15], w[i - 2]
        w.append((w[i - 16] + w[i - 7] + (turn(s, 7) ^ turn(s, 18) ^ s >> 3) + (turn(t, 17) ^ turn(t, 19) ^ t >> 10)) & 0xFFFFFFFF)
    v = list(h)
    for k, x in zip(_ROUND, w, strict=True):
        a, b, c, d, e, f, g, last = v
        one = last + (turn(e, 6) ^ turn(e, 11) ^ turn(e, 25)) + (e & f ^ ~e & g) + k + x
        two = (turn(a, 2) ^ turn(a, 13) ^ turn(a, 22)) + (a & b ^ a & c ^ b & c)
        v = [(one + two) & 0xFFFFFFFF, a, b, c, (d + one) & 0xFFFFFFFF, e, f, g]
    return [(x + y) & 0xFFFFFFFF for x, y in zip(h, v, strict=True)]


class Sha256:
    """SHA-256 that can be put away and gone on with elsewhere: ``Sha256(state)``."""

    library = _library()

    def __init__(self, state: bytes | None = None):
        self.h, self.n, self.rest = list(_START), 0, b""
        if state is not None:
            *self.h, self.n = struct.unpack(">8IQ", state[:40])
            self.rest = state[40:]

    def state(self) -> bytes:
        return struct.pack(">8IQ", *self.h, self.n) + self.rest

    def update(self, data: bytes) -> Sha256:
        self.n += len(data)
        data = self.rest + data
        whole = len(data) // 64 * 64
        self.rest = data[whole:]
        if self.library is not None and whole:
            c = _Context(h=(ctypes.c_uint32 * 8)(*self.h), size=32)
            self.library.SHA256_Update(ctypes.byref(c), data[:whole], whole)
            self.h = list(c.h)
        else:
            for at in range(0, whole, 64):
                self.h = _compress(self.h, data[at : at + 64])
        return self

    def hexdigest(self) -> str:
        end = Sha256(self.state())
        end.update(b"\x80" + bytes((55 - self.n) % 64) + struct.pack(">Q", 8 * self.n))
        return struct.pack(">8I", *end.h).hex()


def chained_sha256(rows: DataFrame, piece: Column, order: list[Column], head: bytes = b"", between: bytes = b"", tail: bytes = b"") -> tuple[int, str]:
    """Number of rows, and the digest of ``head``, the pieces (text or bytes) in order with ``between`` them, and ``tail``.

    Rows that ``order`` doesn't tell apart should have equal pieces. Null pieces are left out.
    """
    keyed = rows.select(*[c.alias(f"_k{i}") for i, c in enumerate(order)], piece.cast("binary").alias("_piece")).where("_piece IS NOT NULL")
    keys = [f"_k{i}" for i in range(len(order))]
    sorted_ = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stash(sorted_.select(F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_at"), "_piece"), "pieces")
    ranges = placed.groupBy("_range").agg(F.count("*").alias("n")).orderBy("_range").collect()  # a row for each range
    state, begun = Sha256().update(head).state(), False
    for r in ranges:
        state, begun = _step(placed.where(F.col("_range") == r["_range"]), state, begun, between), True
    unstash(placed)
    return sum(r.n for r in ranges), Sha256(state).update(tail).hexdigest()


def _step(part: DataFrame, state: bytes, begun: bool, between: bytes) -> bytes:
    """The state after one range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, first = Sha256(state), not begun
        for x in batches:
            pieces = x.column(0).to_pylist()
            digest.update((b"" if first or not pieces else between) + between.join(pieces))
            first = first and not pieces
        yield pa.RecordBatch.from_arrays([pa.array([digest.state()], pa.binary())], ["state"])

    return bytes(part.coalesce(1).sortWithinPartitions("_at").select("_piece").mapInArrow(run, "state binary").first().state)


def json_pieces(rows: DataFrame, order: list[str], columns: list[str], ensure_ascii: bool = True) -> DataFrame:
    """``order`` and ``piece``: each row as JSON with sorted keys and no spaces, as Python's encoder writes it."""
    names = sorted(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            own = zip(*(x.column(len(order) + i).to_pylist() for i in range(len(names))), strict=True)
            text = [json.dumps(dict(zip(names, v, strict=True)), separators=(",", ":"), ensure_ascii=ensure_ascii) for v in own]
            yield pa.RecordBatch.from_arrays([*x.columns[: len(order)], pa.array(text, pa.string())], [*(f"_o{i}" for i in range(len(order))), "piece"])

    source = rows.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], *[F.col(c).alias(f"_c{i}") for i, c in enumerate(names)])
    kinds = "".join(f"_o{i} {source.schema[f'_o{i}'].dataType.simpleString()}, " for i in range(len(order)))
    return source.mapInArrow(run, kinds + "piece string")
