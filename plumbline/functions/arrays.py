"""Closed forms around cached features: masks, padding, mixing, losses, geometry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def attended(mask: Column) -> Column:
    """Length up to the last 1 of a mask, 1 at least."""
    n = F.size(mask)
    return F.when(F.array_contains(mask, 1), n - F.array_position(F.reverse(mask), 1).cast("int") + 1).otherwise(F.lit(1))


def trim_to_mask(values: Column, mask: Column) -> Column:
    """Values up to the last attended place; gaps within stay."""
    return F.slice(values, F.lit(1), attended(mask))


def pad(values: Column, size: Column, zero: Column) -> Column:
    """Values with ``zero`` to the right up to ``size``."""
    return F.concat(values, F.array_repeat(zero, F.greatest(size - F.size(values), F.lit(0))))


def guidance(positive: Column, positive_mask: Column, negative: Column, negative_mask: Column, zero: Column) -> Column:
    """Both sequences and masks padded to the longer one; lengths that differ from their masks raise an error."""
    size = F.greatest(F.size(positive), F.size(negative))
    fits = (F.size(positive) == F.size(positive_mask)) & (F.size(negative) == F.size(negative_mask))
    out = F.struct(
        pad(positive, size, zero).alias("positive"),
        pad(positive_mask, size, F.lit(0)).alias("positive_mask"),
        pad(negative, size, zero).alias("negative"),
        pad(negative_mask, size, F.lit(0)).alias("negative_mask"),
    )
    return F.when(fits, out).otherwise(F.raise_error(F.lit("a sequence and its mask differ in length")))


def all_finite(values: Column) -> Column:
    inf = F.lit(float("inf"))
    return F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != inf))


def valid_text_features(embedding: Column, mask: Column) -> Column:
    """Whether cached text features hold: equal lengths over 0, finite, a mask of 0 and 1 with a 1."""
    ok = (F.size(embedding) == F.size(mask)) & (F.size(mask) > 0) & F.forall(mask, lambda m: m.isin(0, 1)) & F.array_contains(mask, 1) & F.forall(embedding, lambda r: (F.size(r) > 0) & all_finite(r))
    return F.coalesce(ok, F.lit(False))


def flow_noisy(clean: Column, noise: Column, sigma: Column) -> Column:
    """(1 - sigma) clean + sigma noise."""
    return F.zip_with(clean, noise, lambda c, n: (1 - sigma) * c + sigma * n)


def flow_target(clean: Column, noise: Column) -> Column:
    """noise - clean."""
    return F.zip_with(clean, noise, lambda c, n: n - c)


def mse(a: Column, b: Column) -> Column:
    """Mean squared difference."""
    total = F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y) * (x.cast("double") - y)), F.lit(0.0), lambda s, x: s + x)
    return total / F.size(a)


def scaled(values: Column, factor: float, shift: float = 0.0) -> Column:
    """Latents times a factor; a shift is refused."""
    if shift:
        raise ValueError("a nonzero shift is not supported")
    return F.transform(values, lambda x: x * F.lit(factor))


def letterbox(width: Column, height: Column, size: int) -> Column:
    """Fitted size and offsets of an image centred on a square, sides 1 at least."""
    ratio = F.least(F.lit(size) / width, F.lit(size) / height)
    fit = lambda side: F.greatest(F.lit(1), F.least(F.lit(size), F.bround(side * ratio).cast("int")))
    w, h = fit(width), fit(height)
    return F.struct(w.alias("width"), h.alias("height"), F.floor((size - w) / 2).cast("int").alias("left"), F.floor((size - h) / 2).cast("int").alias("top"))


def latent_bytes(tokens: Column, channels: int, resolution: int) -> Column:
    """Estimated size of a row's features on disk, in bytes."""
    return tokens.cast("long") * channels * 2 + 32 * (resolution // 32) ** 2 * 2 + 8192
