"""Image audit: header, bounds, digests, and pixels of PNG files; letterboxed pixels for features.

The pixel boundary is Python: headers of PNG and JPEG are parsed, and eight-bit PNG without
interlacing is decoded here. Other files get their header's figures and no pixel digest.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Limits on pixels: what may be asked for at most, and the usual guard (fixed values).
MAX_PIXELS, USUAL_PIXELS = 300_000_000, 89_478_485
SCHEMA = (
    "path string, original_width int, original_height int, original_mode string, format string, large_image_override boolean, max_pixels int,"
    " image_sha256 string, pixel_sha256 string, width int, height int, exif_transposed boolean, alpha_composited boolean, error string"
)
#: What a damaged file may lead to while it is read.
FAULTS = (ValueError, OSError, LookupError, ArithmeticError, struct.error, zlib.error, MemoryError)
_MODES = {0: ("L", 1), 2: ("RGB", 3), 3: ("P", 1), 4: ("LA", 2), 6: ("RGBA", 4)}  # PNG colour types: fixed values


def _png_chunks(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    at = 8
    while at < len(data):
        (size,) = struct.unpack(">I", data[at : at + 4])
        kind, body = data[at + 4 : at + 8], data[at + 8 : at + 8 + size]
        if len(body) != size or zlib.crc32(kind + body) != struct.unpack(">I", data[at + 8 + size : at + 12 + size])[0]:
            raise ValueError("a chunk is damaged")
        yield kind, body
        at += 12 + size
        if kind == b"IEND":
            return
    raise ValueError("the file ends early")


def _png(data: bytes) -> dict:
    chunks: dict[bytes, list[bytes]] = {}
    for kind, body in _png_chunks(data):
        chunks.setdefault(kind, []).append(body)
    width, height, depth, colour, _, _, interlace = struct.unpack(">IIBBBBB", chunks[b"IHDR"][0])
    return {"width": width, "height": height, "mode": _MODES[colour][0], "format": "PNG", "depth": depth, "colour": colour, "interlace": interlace, "orientation": _orientation(chunks[b"eXIf"][0]) if b"eXIf" in chunks else 1, "chunks": chunks}


def _jpeg(data: bytes) -> dict:
    at, orientation = 2, 1
    while at + 4 <= len(data):
        if data[at] != 0xFF:
            raise ValueError("a marker is missing")
        kind, (size,) = data[at + 1], struct.unpack(">H", data[at + 2 : at + 4])
        body = data[at + 4 : at + 2 + size]
        if kind == 0xE1 and body[:6] == b"Exif\0\0":
            orientation = _orientation(body[6:])
        if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            height, width, parts = struct.unpack(">HHB", body[1:6])
            if data[-2:] != b"\xff\xd9":
                raise ValueError("the file ends early")
            return {"width": width, "height": height, "mode": {1: "L", 3: "RGB", 4: "CMYK"}[parts], "format": "JPEG", "orientation": orientation}
        at += 2 + size
    raise ValueError("no frame header")


def _orientation(tiff: bytes) -> int:
    order = "<" if tiff[:2] == b"II" else ">"
    (at,) = struct.unpack(order + "I", tiff[4:8])
    (n,) = struct.unpack(order + "H", tiff[at : at + 2])
    for i in range(n):
        entry = tiff[at + 2 + 12 * i : at + 14 + 12 * i]
        if struct.unpack(order + "H", entry[:2])[0] == 0x0112:
            return struct.unpack(order + "H", entry[8:10])[0]
    return 1


def header(data: bytes) -> dict:
    """Size, mode and format of a PNG or JPEG file; ValueError for others and damaged ones."""
    try:
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            return _png(data)
        if data[:2] == b"\xff\xd8":
            return _jpeg(data)
    except (struct.error, KeyError, IndexError) as e:
        raise ValueError(f"the header is damaged: {e}") from e
    raise ValueError("neither PNG nor JPEG")


def _paeth(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Whichever of left, up and up-left is nearest to a + b - c; in this order where several are."""
    near_b, near_a, near_c = np.abs(a - c), np.abs(b - c), np.abs(a + b - 2 * c)
    return np.where((near_a <= near_b) & (near_a <= near_c), a, np.where(near_b <= near_c, b, c))


def _wavefront(raw: np.ndarray, kinds: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Rows (height, width, step) of any filter kinds below the row ``above``.

    A byte depends on those left, up and up-left of it, so all bytes of an anti-diagonal can be had at
    once; in a buffer with a margin of one pixel it is a slice with a constant stride.
    """
    height, width, step = raw.shape
    out = np.zeros((height + 1, width + 1, step), np.int16)
    out[0, 1:], out[1:, 1:] = above, raw
    flat, row = out.reshape(-1, step), width + 1
    plain = (kinds == 4).all()
    for d in range(height + width - 1):
        lo, hi = max(0, d - width + 1), min(height - 1, d)
        first, stop = (lo + 1) * row + d - lo + 1, (hi + 1) * row + d - hi + 2
        here = slice(first, stop, width)
        a, b, c = flat[first - 1 : stop - 1 : width], flat[first - row : stop - row : width], flat[first - row - 1 : stop - row - 1 : width]
        if plain:
            guess = _paeth(a, b, c)
        else:
            kind = kinds[lo : hi + 1, None]
            guess = np.select([kind == 0, kind == 1, kind == 2, kind == 3], [0, a, b, (a + b) >> 1], _paeth(a, b, c))
        flat[here] = (flat[here] + guess) & 255
    return out[1:, 1:].astype(np.uint8)


def _unfilter(raw: bytes, width: int, height: int, step: int) -> np.ndarray:
    stride = width * step
    rows = np.frombuffer(raw, np.uint8, height * (stride + 1)).reshape(height, stride + 1)
    kinds, lines = rows[:, 0].astype(np.int16), rows[:, 1:].reshape(height, width, step)
    if kinds.max(initial=0) > 4:
        raise ValueError("an unknown filter")
    out = np.zeros((height + 1, width, step), np.uint8)
    hard = np.flatnonzero(kinds > 2)
    lo, hi = (int(hard[0]), int(hard[-1]) + 1) if len(hard) else (height, height)
    for y in [*range(lo), *range(hi, height)]:  # rows that need no pixel of their own row's but by a sum
        if y == hi < height:
            out[lo + 1 : hi + 1] = _wavefront(lines[lo:hi], kinds[lo:hi], out[lo])
        out[y + 1] = np.cumsum(lines[y], axis=0, dtype=np.uint8) if kinds[y] == 1 else lines[y] + out[y] * np.uint8(kinds[y] == 2)
    if hi == height and lo < hi:
        out[lo + 1 :] = _wavefront(lines[lo:hi], kinds[lo:hi], out[lo])
    return out[1:]


def _inflated(parts: list[bytes], size: int) -> bytes:
    """The first ``size`` bytes of a compressed stream; no more is ever inflated, whatever it holds."""
    if not parts:
        raise ValueError("the file has no pixels")
    out = zlib.decompressobj().decompress(b"".join(parts), size)
    if len(out) < size:
        raise ValueError("the pixels end early")
    return out


#: How EXIF orientations turn pixels upright: transposed or not, then flipped along rows, along columns (fixed values).
_TURNS = {2: (False, False, True), 3: (False, True, True), 4: (False, True, False), 5: (True, False, False), 6: (True, False, True), 7: (True, True, True), 8: (True, True, False)}


def upright(px: np.ndarray, orientation: int) -> np.ndarray:
    """Pixels (height, width, ..) as EXIF asks to show them."""
    swap, rows, columns = _TURNS.get(orientation, (False, False, False))
    px = px.swapaxes(0, 1) if swap else px
    return px[:: -1 if rows else 1, :: -1 if columns else 1]


def png_rgb(info: dict, composite: bool = True) -> tuple[np.ndarray, bool]:
    """Upright RGB pixels and whether transparency was laid on white; without ``composite`` it is dropped."""
    if info["depth"] != 8 or info["interlace"]:
        raise ValueError("only eight-bit PNG without interlacing is decoded")
    chunks, step, (w, h) = info["chunks"], _MODES[info["colour"]][1], (info["width"], info["height"])
    px = upright(_unfilter(_inflated(chunks.get(b"IDAT", []), h * (w * step + 1)), w, h, step), info["orientation"])
    alpha, clear = None, chunks.get(b"tRNS", [None])[0]
    if info["colour"] == 3:
        if b"PLTE" not in chunks:
            raise ValueError("the palette is missing")
        palette = np.frombuffer(chunks[b"PLTE"][0], np.uint8).reshape(-1, 3)
        if px.max(initial=0) >= len(palette):
            raise ValueError("a colour is not in the palette")
        if clear is not None:
            levels = np.full(256, 255, np.uint8)
            levels[: len(clear)] = np.frombuffer(clear[:256], np.uint8)
            alpha = levels[px[:, :, 0]]
        rgb = palette[px[:, :, 0]]
    elif step in (2, 4):
        rgb, alpha = (np.repeat(px[:, :, :1], 3, axis=2) if step == 2 else px[:, :, :3]), px[:, :, -1]
    else:
        rgb = np.repeat(px, 3, axis=2) if step == 1 else px
        if clear is not None:  # one colour is clear; a sample has two bytes there
            if len(clear) != 2 * step:
                raise ValueError("the clear colour is damaged")
            alpha = np.where((px == np.frombuffer(clear, ">u2")).all(axis=2), 0, 255).astype(np.uint8)
    if alpha is None or not composite:
        return np.ascontiguousarray(rgb), False
    a = alpha[:, :, None].astype(np.uint32)
    # the usual exact rounding of x / 255
    both = rgb * a + 255 * (255 - a) + 128
    return ((both + (both >> 8)) >> 8).astype(np.uint8), True


def pixel_sha256(rgb: np.ndarray) -> str:
    """Digest of size and row-major RGB bytes, whatever the stripes it is fed in."""
    h = hashlib.sha256(f"RGB:{rgb.shape[1]}:{rgb.shape[0]}:".encode())
    for y in range(0, len(rgb), 64):
        h.update(np.ascontiguousarray(rgb[y : y + 64]).tobytes())
    return h.hexdigest()


def lanczos(size: int, to: int, taps: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``to`` places the first of the ``size`` that it is made of, and their weights in units of 2^-22 (to, n).

    Weights are a windowed sinc, as wide as the scale where the picture shrinks; places over the edge weigh nothing.
    """
    scale = size / to
    wide = max(scale, 1.0)
    centre = (np.arange(to) + 0.5) * scale
    first = np.maximum((centre - taps * wide + 0.5).astype(np.int64), 0)
    end = np.minimum((centre + taps * wide + 0.5).astype(np.int64), size)
    at = first[:, None] + np.arange(int((end - first).max()))
    x = (at - centre[:, None] + 0.5) / wide
    weight = np.where((np.abs(x) < taps) & (at < end[:, None]), np.sinc(x) * np.sinc(x / taps), 0.0)
    weight /= weight.sum(axis=1, keepdims=True)
    return first, np.trunc(weight * (1 << 22) + np.copysign(0.5, weight)).astype(np.int32)


def _resampled_rows(px: np.ndarray, to: int) -> np.ndarray:
    """Pixels (height, width, channels) with ``to`` rows, a tap of the kernel at a time."""
    if len(px) == to:
        return px
    first, weight = lanczos(len(px), to)
    out = np.full((to, *px.shape[1:]), 1 << 21, np.int32)
    for k in range(weight.shape[1]):
        out += px[np.minimum(first + k, len(px) - 1)] * weight[:, k, None, None]
    return np.clip(out >> 22, 0, 255).astype(np.uint8)


def resample(rgb: np.ndarray, width: int, height: int) -> np.ndarray:
    """An image of another size by separable Lanczos kernels: along rows first, rounded, then along columns."""
    across = _resampled_rows(np.ascontiguousarray(rgb.swapaxes(0, 1)), width).swapaxes(0, 1)
    return _resampled_rows(np.ascontiguousarray(across), height)


def contained_size(width: int, height: int, size: int) -> tuple[int, int]:
    """Width and height of an image whose longer side is ``size``; the other is rounded, halves to even."""
    return (size, max(1, round(height / width * size))) if width >= height else (max(1, round(width / height * size)), size)


def letterboxed(rgb: np.ndarray, size: int) -> np.ndarray:
    """An image resampled to fit, centred on a white square, as float32 in [-1, 1], channels first."""
    w, h = contained_size(rgb.shape[1], rgb.shape[0], size)
    square = np.full((size, size, 3), 255, np.uint8)
    top, left = (size - h) // 2, (size - w) // 2
    square[top : top + h, left : left + w] = resample(rgb, w, h)
    return (square.astype(np.float32) / 127.5 - 1).transpose(2, 0, 1)


#: Pixels (height, width, 3) of a file's bytes, given its header's figures.
Decoder = Callable[[bytes, dict], np.ndarray]


def inspect(path: str, data: bytes, max_pixels: int = USUAL_PIXELS, composite: bool = True, expected_sha256: str | None = None, decoder: Decoder | None = None) -> dict:
    """The audit of one file; faults come back as ``error``.

    PNG is decoded here. For other formats ``decoder(data, info)`` gives the pixels, upright and in RGB, as
    ``info["orientation"]`` asks for; without one they have no pixel digest.
    """
    if not 1 <= max_pixels <= MAX_PIXELS:
        raise ValueError(f"max_pixels must be in 1 .. {MAX_PIXELS}")
    out = {"path": path, "max_pixels": max_pixels, "image_sha256": hashlib.sha256(data).hexdigest(), "error": None}
    try:
        if expected_sha256 and expected_sha256 != out["image_sha256"]:
            raise ValueError("the file has changed")
        info = header(data)
        w, h = info["width"], info["height"]
        if w * h == 0 or w * h > max_pixels:
            raise ValueError(f"{w} x {h} pixels are not allowed")
        turned = 5 <= info.get("orientation", 1) <= 8
        out |= {"original_width": w, "original_height": h, "original_mode": info["mode"], "format": info["format"], "large_image_override": w * h > USUAL_PIXELS, "exif_transposed": info.get("orientation", 1) != 1, "alpha_composited": False}
        out |= {"width": h if turned else w, "height": w if turned else h}
        if info["format"] == "PNG":
            rgb, out["alpha_composited"] = png_rgb(info, composite)
            out["pixel_sha256"] = pixel_sha256(rgb)
        elif decoder is not None:
            rgb = np.asarray(decoder(data, info), np.uint8)
            if rgb.shape != (out["height"], out["width"], 3):
                raise ValueError(f"decoded to {rgb.shape}, not to {out['width']} x {out['height']} RGB")
            out["pixel_sha256"] = pixel_sha256(rgb)
    except FAULTS as e:
        return {k: out[k] for k in ("path", "max_pixels", "image_sha256")} | {"error": f"{type(e).__name__}: {e}"}
    return out


def upright_rgb(data: bytes, max_pixels: int = USUAL_PIXELS, decoder: Decoder | None = None) -> np.ndarray:
    """The pixels that ``inspect`` digests."""
    info = header(data)
    if not 0 < info["width"] * info["height"] <= max_pixels:
        raise ValueError(f"{info['width']} x {info['height']} pixels are not allowed")
    if info["format"] == "PNG":
        return png_rgb(info)[0]
    if decoder is None:
        raise ValueError(f"no decoder for {info['format']}")
    return np.asarray(decoder(data, info), np.uint8)


def letterbox_images(files: DataFrame, size: int, max_pixels: int = USUAL_PIXELS, decoder: Decoder | None = None) -> DataFrame:
    """``path, pixels, error`` of rows ``path, content``: float32 bytes (3, size, size) of each letterboxed image, little-endian."""

    def one(data: bytes) -> tuple[bytes | None, str | None]:
        try:
            return letterboxed(upright_rgb(data, max_pixels, decoder), size).astype("<f4").tobytes(), None
        except FAULTS as e:
            return None, f"{type(e).__name__}: {e}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for lo in range(0, x.num_rows, 8):  # a few squares at a time
                made = [one(c) for c in x.column(1).slice(lo, 8).to_pylist()]
                yield pa.RecordBatch.from_arrays([x.column(0).slice(lo, 8), pa.array([p for p, _ in made], pa.binary()), pa.array([e for _, e in made], pa.string())], ["path", "pixels", "error"])

    return files.select("path", "content").mapInArrow(run, "path string, pixels binary, error string")


def inspect_images(files: DataFrame, max_pixels: int = USUAL_PIXELS, composite: bool = True, decoder: Decoder | None = None) -> DataFrame:
    """Audits of rows ``path, content``, each path once; faults are rows too, with ``error``. ``decoder`` as in ``inspect``."""
    names = [x.split()[0] for x in SCHEMA.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            rows = [inspect(p, c, max_pixels, composite, decoder=decoder) for p, c in zip(x.column(0).to_pylist(), x.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_pylist([{n: r.get(n) for n in names} for r in rows], schema=pa.schema([(n, types[n]) for n in names]))

    types = {n: {"int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}[k] for n, k in (x.split() for x in SCHEMA.split(","))}
    return files.select("path", "content").dropDuplicates(["path"]).mapInArrow(run, SCHEMA)
