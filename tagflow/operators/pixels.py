"""Pixels: decode, pad, resize, statistics, normalise. The numpy work runs inside Spark tasks."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Channel means and deviations that the CLIP profile uses instead of channel_stats.
CLIP_STATS = ([0.48145466, 0.4578275, 0.40821073], [0.26862954, 0.26130258, 0.27577711])
ROWS = 512  # of an image that are resized at a time
PIXEL_SCHEMA = "name string, height int, width int, pixels binary, sums array<double>, squares array<double>"


@functools.lru_cache(64)
def _weights(source: int, target: int) -> np.ndarray:
    """(target, source) float32 weights of one axis: shares of area when shrinking, linear when enlarging."""
    out = np.zeros((target, source))
    scale = source / target
    for i in range(target):
        if scale >= 1:
            low, high = i * scale, (i + 1) * scale
            for j in range(int(low), min(source, int(np.ceil(high)))):
                out[i, j] = max(0.0, min(high, j + 1) - max(low, j)) / scale
        else:
            x = min(max((i + 0.5) * scale - 0.5, 0), source - 1)
            j = int(x)
            out[i, j] += 1 - (x - j)
            out[i, min(j + 1, source - 1)] += x - j
    return out.astype(np.float32)


def square_pixels(data: bytes, height: int, width: int, channels: int, size: int) -> np.ndarray:
    """(size, size, 3) float32 RGB: gray repeated, alpha dropped, padded to a square with white, centred, resized."""
    img = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    img = np.repeat(img, 3, 2) if channels == 1 else img[:, :, 2::-1]
    side = max(height, width)
    top, left = (side - height) // 2, (side - width) // 2
    w = _weights(side, size)
    # the padding is never made: white is added with the weight that the picture leaves
    down, across = w[:, top : top + height], w[:, left : left + width]
    out = np.zeros((size, size, 3), np.float32)
    for begin in range(0, height, ROWS):
        rows = img[begin : begin + ROWS].astype(np.float32)
        narrow = np.stack([rows[:, :, c] @ across.T for c in range(3)], 2)
        out += np.tensordot(down[:, begin : begin + ROWS], narrow, 1)
    return out + 255 * (1 - np.outer(down.sum(1), across.sum(1)))[:, :, None].astype(np.float32)


def prepare_pixels(images: DataFrame, size: int = 224) -> DataFrame:
    """name, height, width, pixels (float32 HWC bytes) and the channel sums of decoded images; invalid ones are left out."""

    def prepare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for r in frame.itertuples():
                px = square_pixels(r.data, r.height, r.width, r.channels, size)
                wide = px.astype(np.float64)
                rows.append((r.name, size, size, px.tobytes(), wide.mean((0, 1)).tolist(), (wide**2).mean((0, 1)).tolist()))
            yield pd.DataFrame(rows, columns=["name", "height", "width", "pixels", "sums", "squares"])

    return images.where("height > 0").select("name", "height", "width", "channels", "data").mapInPandas(prepare, PIXEL_SCHEMA)


def channel_stats(means: DataFrame, channels: int = 3) -> DataFrame:
    """One row, arrays mean and std: std from the mean of images' mean squares, at least 1e-8.

    means: sums (channel means of an image) and squares (channel mean squares).
    """
    mean = [F.avg(F.get("sums", F.lit(c))) for c in range(channels)]
    var = [F.avg(F.get("squares", F.lit(c))) - mean[c] * mean[c] for c in range(channels)]
    return means.agg(F.array(*mean).alias("mean"), F.array(*[F.sqrt(F.greatest(v, F.lit(1e-16))) for v in var]).alias("std"))


def normalise_array(pixels: np.ndarray, mean: np.ndarray, std: np.ndarray) -> np.ndarray:
    return ((pixels - mean) / (std + 1e-8)).astype(np.float32).transpose(2, 0, 1)


def normalise_pixels(pixels: DataFrame, mean: list[float], std: list[float]) -> DataFrame:
    """name and pixels as float32 CHW bytes, normalised by channel."""

    def normalise(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [normalise_array(np.frombuffer(r.pixels, np.float32).reshape(r.height, r.width, 3), np.array(mean), np.array(std)).tobytes() for r in frame.itertuples()]
            yield pd.DataFrame({"name": frame.name, "pixels": out})

    return pixels.select("name", "height", "width", "pixels").mapInPandas(normalise, "name string, pixels binary")
