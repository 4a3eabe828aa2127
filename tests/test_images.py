"""PNG files of every filter, turn and clear colour, damaged ones, and resampling."""

import math
import struct
import time
import tracemalloc
import zlib

import numpy as np
import pytest

from plumbline.sources import images as im


def chunk(kind, body):
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def png(px, colour=2, extra=b"", kinds=None, raw=None):
    a = np.asarray(px, np.uint8)
    h, w = a.shape[:2]
    raw = filtered(a.reshape(h, w, -1), kinds if kinds is not None else [0] * h) if raw is None else raw
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, colour, 0, 0, 0)) + extra + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def filtered(a, kinds):
    """Scan lines as an encoder writes them, byte by byte."""
    out, (h, w, step) = b"", a.shape
    for y, kind in enumerate(kinds):
        line = []
        for x in range(w):
            for s in range(step):
                left = int(a[y, x - 1, s]) if x else 0
                up = int(a[y - 1, x, s]) if y else 0
                corner = int(a[y - 1, x - 1, s]) if x and y else 0
                p = left + up - corner
                nearest = min((abs(p - left), 0, left), (abs(p - up), 1, up), (abs(p - corner), 2, corner))[2]
                line.append((int(a[y, x, s]) - (0, left, up, (left + up) // 2, nearest)[kind]) % 256)
        out += bytes([kind, *line])
    return out


@pytest.mark.parametrize(("h", "w", "step"), [(1, 1, 1), (9, 5, 3), (5, 11, 4), (30, 2, 2), (2, 30, 1), (13, 13, 3)])
def test_rows_of_any_filters(h, w, step):
    r = np.random.RandomState(h)
    for kinds in ([4] * h, [3] * h, r.randint(0, 5, h).tolist(), [1] * h, sorted(r.randint(0, 5, h).tolist()), sorted(r.randint(0, 5, h).tolist(), reverse=True)):
        px = r.randint(0, 256, (h, w, step)).astype(np.uint8)
        assert (im._unfilter(filtered(px, kinds), w, h, step) == px).all(), kinds


def test_a_megapixel_takes_a_moment():
    raw = np.random.RandomState(2).randint(0, 256, (1000, 3001)).astype(np.uint8)
    raw[:, 0] = 4
    began = time.time()
    im._unfilter(raw.tobytes(), 1000, 1000, 3)
    assert time.time() - began < 3  # 0.2 s alone on a machine; a loop over bytes takes 8


def turned(px, orientation):
    """Where each pixel of the shown image comes from, by definition."""
    h, w = px.shape[:2]
    at = {1: lambda y, x: (y, x), 2: lambda y, x: (y, w - 1 - x), 3: lambda y, x: (h - 1 - y, w - 1 - x), 4: lambda y, x: (h - 1 - y, x)}
    at |= {5: lambda y, x: (x, y), 6: lambda y, x: (h - 1 - x, y), 7: lambda y, x: (h - 1 - x, w - 1 - y), 8: lambda y, x: (x, w - 1 - y)}
    shape = (w, h) if orientation > 4 else (h, w)
    return np.array([[px[at[orientation](y, x)] for x in range(shape[1])] for y in range(shape[0])])


@pytest.mark.parametrize("orientation", range(1, 9))
def test_png_is_turned_as_its_exif_asks(orientation):
    px = np.random.RandomState(3).randint(0, 256, (3, 5, 3)).astype(np.uint8)
    exif = chunk(b"eXIf", b"II*\0\x08\0\0\0\x01\0" + struct.pack("<HHIHH", 0x0112, 3, 1, orientation, 0) + b"\0\0\0\0")
    want = turned(px, orientation)
    got = im.inspect("x", png(px, extra=exif))
    assert got["error"] is None and (got["width"], got["height"]) == (want.shape[1], want.shape[0]) and got["original_width"] == 5
    assert got["pixel_sha256"] == im.pixel_sha256(want) and got["exif_transposed"] == (orientation != 1)


def test_clear_colours_of_grey_and_rgb():
    grey = np.array([[[7], [8]]], np.uint8)
    got, laid = im.png_rgb(im.header(png(grey, 0, extra=chunk(b"tRNS", struct.pack(">H", 7)))))
    assert laid and got.tolist() == [[[255] * 3, [8] * 3]]
    rgb = np.array([[[1, 2, 3], [1, 2, 4]]], np.uint8)
    got, laid = im.png_rgb(im.header(png(rgb, 2, extra=chunk(b"tRNS", struct.pack(">HHH", 1, 2, 3)))))
    assert laid and got.tolist() == [[[255] * 3, [1, 2, 4]]]
    assert im.inspect("x", png(rgb, 2, extra=chunk(b"tRNS", b"\0")))["error"]
    # two bytes of a sample: 256 + 7 is not 7
    assert im.png_rgb(im.header(png(grey, 0, extra=chunk(b"tRNS", struct.pack(">H", 263)))))[0].tolist() == [[[7] * 3, [8] * 3]]


def damaged():
    px = np.zeros((2, 2), np.uint8)
    palette = chunk(b"PLTE", bytes(6))
    good = png(np.zeros((2, 2, 3)))
    yield "index out of range", png(px + 9, 3, extra=palette)
    yield "no palette", png(px, 3)
    yield "no pixels", good.replace(chunk(b"IDAT", zlib.compress(filtered(np.zeros((2, 2, 3), np.uint8), [0, 0]))), b"")
    yield "unknown filter", png(np.zeros((2, 2, 3)), kinds=None, raw=bytes([9] + [0] * 13))
    yield "short", png(np.zeros((2, 2, 3)), raw=b"\0")
    yield "not compressed", good[:33] + chunk(b"IDAT", b"xx") + chunk(b"IEND", b"")
    yield "odd palette", png(px, 3, extra=chunk(b"PLTE", bytes(5)))
    yield "bad exif", png(np.zeros((2, 2, 3)), extra=chunk(b"eXIf", b"II"))
    yield "unknown colour type", good[:25] + b"\x05" + good[26:29] + struct.pack(">I", zlib.crc32(good[12:25] + b"\x05" + good[26:29])) + good[33:]
    yield "empty", b""
    yield "jpeg without end", b"\xff\xd8\xff\xc0\0\x11\x08\0\x08\0\x08\x03" + bytes(9)
    for cut in range(1, len(good), 5):
        yield f"cut at {cut}", good[:cut]


def test_damaged_files_are_errors_and_never_exceptions(spark):
    files = list(damaged())
    for name, data in files:
        got = im.inspect(name, data)
        assert got["error"] and "pixel_sha256" not in got, name
    rows = spark.createDataFrame([(n, bytearray(d)) for n, d in [*files, ("fine", png(np.zeros((2, 2, 3))))]], "path string, content binary")
    assert {r.path for r in im.inspect_images(rows).where("error is null").collect()} == {"fine"}
    boxed = im.letterbox_images(rows, 4)
    assert {r.path: len(r.pixels) for r in boxed.where("error is null").collect()} == {"fine": 4 * 3 * 16}


def test_a_stream_is_never_inflated_beyond_its_pixels():
    bomb = png(np.zeros((1, 1, 3)), raw=bytes(300_000_000))
    tracemalloc.start()
    got = im.inspect("x", bomb)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got["error"] is None and peak < 5 * len(bomb), peak


def kernel_sum(line, to):
    """One line of samples at another size, by the definition of the kernel."""
    n, out = len(line), []
    wide = max(n / to, 1.0)
    sinc = lambda x: 1.0 if x == 0 else math.sin(math.pi * x) / (math.pi * x)
    for i in range(to):
        centre = (i + 0.5) * n / to
        lo, hi = max(0, int(centre - 3 * wide + 0.5)), min(n, int(centre + 3 * wide + 0.5))
        ws = []
        for j in range(lo, hi):
            x = (j - centre + 0.5) / wide
            ws.append(sinc(x) * sinc(x / 3) if -3 <= x < 3 else 0.0)
        fixed = [int(w / sum(ws) * (1 << 22) + math.copysign(0.5, w)) for w in ws]
        out.append(min(255, max(0, (sum(int(line[j]) * w for j, w in zip(range(lo, hi), fixed, strict=True)) + (1 << 21)) >> 22)))
    return out


@pytest.mark.parametrize(("w", "h", "to_w", "to_h"), [(10, 10, 5, 5), (10, 7, 20, 14), (3, 3, 17, 2), (50, 40, 7, 6), (1, 9, 4, 9), (16, 16, 16, 16), (64, 3, 8, 1), (5, 90, 3, 31), (31, 33, 32, 32), (100, 2, 99, 3)])
def test_resampling_is_the_sum_of_the_kernel(w, h, to_w, to_h):
    px = np.random.RandomState(w).randint(0, 256, (h, w, 3)).astype(np.uint8)
    rows = px if w == to_w else np.stack([np.stack([kernel_sum(px[y, :, c], to_w) for c in range(3)], axis=1) for y in range(h)])
    want = rows if h == to_h else np.stack([np.stack([kernel_sum(rows[:, x, c], to_h) for c in range(3)], axis=1) for x in range(to_w)], axis=1)
    assert (im.resample(px, to_w, to_h) == want).all()


def test_letterbox_of_any_size():
    assert im.contained_size(8, 4, 16) == (16, 8) and im.contained_size(3, 1000, 10) == (1, 10) and im.contained_size(5, 2, 1) == (1, 1)
    for w, h in ((40, 10), (10, 40), (4, 2), (16, 16)):
        box = im.letterboxed(np.zeros((h, w, 3), np.uint8), 16)
        size = im.contained_size(w, h, 16)
        assert box.shape == (3, 16, 16) and (box == -1).sum() == 3 * size[0] * size[1] and (box == 1).sum() == 3 * (256 - size[0] * size[1])
