"""Resize image rows to a fixed size (aspect ratio not kept) with bicubic
convolution (Keys kernel, a = -0.5), widened by the scale factor when
shrinking so every source pixel contributes (area-aware downsampling).

The weights are a table (``weight_rows``) in fixed point, ``2**BITS`` to one:
columns first, then rows, each pass rounded to whole grey values, so the result
is exact integer arithmetic and equal in any engine.  Resizing runs as an
Arrow-batched ``mapInPandas`` over image rows: each row is one image, so work
is spread with the rows and no group is ever formed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Target size of the stored thumbnails and the kernel parameter.
TARGET_SIZE = (128, 128)
CUBIC_A = -0.5
#: Fraction bits of a weight.
BITS = 14


def _cubic(x: np.ndarray, a: float = CUBIC_A) -> np.ndarray:
    x = np.abs(x)
    return np.where(x < 1, ((a + 2) * x - (a + 3)) * x * x + 1,
                    np.where(x < 2, (((x - 5) * x + 8) * x - 4) * a, 0.0))


@lru_cache(maxsize=64)
def resample_matrix(n_in: int, n_out: int) -> np.ndarray:
    """(n_out, n_in) weights for one axis as whole numbers, normalised before rounding."""
    scale = n_in / n_out
    stretch = max(scale, 1.0)
    centres = (np.arange(n_out) + 0.5) * scale
    weights = _cubic((np.arange(n_in)[None, :] + 0.5 - centres[:, None]) / stretch)
    sums = weights.sum(axis=1, keepdims=True)
    return np.floor(weights / np.where(sums == 0, 1.0, sums) * (1 << BITS) + 0.5).astype(np.int64)


def weight_rows(n_in: int, n_out: int) -> list[tuple[int, int, int]]:
    """(out, in, weight) of the weights that are not zero: the matrix as a sparse table."""
    matrix = resample_matrix(n_in, n_out)
    out, in_ = np.nonzero(matrix)
    return list(zip(out.tolist(), in_.tolist(), matrix[out, in_].tolist()))


def _grey(sums: np.ndarray) -> np.ndarray:
    """Whole grey values of fixed-point sums, rounded half up."""
    return np.clip((sums + (1 << (BITS - 1))) >> BITS, 0, 255)


def _weighed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of whole numbers, in doubles, which hold sums of grey values times weights exactly."""
    return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)


def resize_array(img: np.ndarray, height: int, width: int) -> np.ndarray:
    """(h, w, c) uint8 → (height, width, c) uint8."""
    wide = _grey(_weighed(img.transpose(0, 2, 1), resample_matrix(img.shape[1], width).T))           # (h, c, width)
    out = _grey(_weighed(resample_matrix(img.shape[0], height), wide.reshape(img.shape[0], -1)))      # (height, c * width)
    out = out.reshape(height, img.shape[2], width)
    return out.transpose(0, 2, 1).astype(np.uint8)


def resize_images(images: DataFrame, size: tuple[int, int] = TARGET_SIZE, keep: Sequence[str] = ()) -> DataFrame:
    """Every image row (filename, height, width, nChannels, mode, data) with its resized pixels and a status.

    ``keep`` names further columns to carry.  A row that was not decoded, or
    whose data does not fit its size, has a status other than ``ok`` and no pixels.
    """
    th, tw = size

    def run(batches):
        for pdf in batches:
            out, status = [], []
            for h, w, c, data in zip(pdf["height"], pdf["width"], pdf["nChannels"], pdf["data"]):
                if not h > 0:
                    out.append(None)
                    status.append("undecodable")
                elif len(data) != h * w * c:
                    out.append(None)
                    status.append("wrong pixel data")
                else:
                    out.append(resize_array(np.frombuffer(data, np.uint8).reshape(int(h), int(w), int(c)), th, tw).tobytes())
                    status.append("ok")
            yield pdf[["filename", *keep, "nChannels", "mode"]].assign(status=status, height=th, width=tw, data=out)

    first = images.select("filename", *keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in first.schema.fields)
    schema += ", status string, height int, width int, nChannels int, mode int, data binary"
    rows = images.select("filename", *keep, F.coalesce("height", F.lit(-1)).alias("height"), "width",
                         F.coalesce("nChannels", F.lit(-1)).alias("nChannels"), F.coalesce("mode", F.lit(-1)).alias("mode"),
                         F.coalesce("data", F.lit(b"")).alias("data"))
    return rows.mapInPandas(run, schema)
