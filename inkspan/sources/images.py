"""Scanned pages made ready for reading: gray, contrast, median, sharpening, threshold, size; PNG in and out, by Arrow batches."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from inkspan.sources.pdf import _predicted

MODES = {"none": (), "contrast": ("gray", "contrast"), "standard": ("gray", "contrast", "median", "sharpen"), "light": ("gray", "contrast", "sharpen"), "binary": ("gray", "contrast", "median", "threshold")}
THRESHOLD = 185
_MAGIC = b"\x89PNG\r\n\x1a\n"
PREPARED = "path string, status string, error string, width int, height int, operations array<string>, png binary"


def decoded(png: bytes) -> np.ndarray:
    """Height by width by channels of a PNG of eight bits a channel, not interlaced."""
    if png[:8] != _MAGIC:
        raise ValueError("not a PNG")
    at, head, data = 8, None, b""
    while at + 8 <= len(png):
        size, kind = struct.unpack(">I4s", png[at : at + 8])
        body = png[at + 8 : at + 8 + size]
        head = struct.unpack(">IIBBBBB", body) if kind == b"IHDR" else head
        data += body if kind == b"IDAT" else b""
        at += size + 12
    if not head or head[2] != 8 or head[6] or head[3] not in (0, 2, 4, 6):
        raise ValueError("only eight bits a channel, gray or true colour, not interlaced")
    channels = {0: 1, 2: 3, 4: 2, 6: 4}[head[3]]
    raw = _predicted(zlib.decompress(data), {"Columns": head[0], "Colors": channels})
    out = np.frombuffer(raw, np.uint8, head[0] * head[1] * channels).reshape(head[1], head[0], channels)
    return out[:, :, : channels - 1] if channels in (2, 4) else out


def encoded(image: np.ndarray) -> bytes:
    """A PNG of a gray (height by width by 1) or true colour image."""
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    high, wide, channels = image.shape
    rows = np.zeros((high, wide * channels + 1), np.uint8)
    rows[:, 1:] = image.reshape(high, -1)
    return _MAGIC + chunk(b"IHDR", struct.pack(">IIBBBBB", wide, high, 8, 0 if channels == 1 else 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b"")


def _around(x: np.ndarray) -> np.ndarray:
    """The nine neighbours of each pixel, edges repeated: 9 by height by width."""
    p = np.pad(x, 1, mode="edge")
    return np.stack([p[i : i + x.shape[0], j : j + x.shape[1]] for i in range(3) for j in range(3)])


def applied(image: np.ndarray, operation: str) -> np.ndarray:
    if operation == "gray":
        x = image.astype(np.int64)
        return image if image.shape[2] == 1 else ((x[:, :, 0] * 299 + x[:, :, 1] * 587 + x[:, :, 2] * 114) // 1000).astype(np.uint8)[:, :, None]
    if operation == "contrast":
        lo, hi = int(image.min()), int(image.max())
        return image if lo == hi else np.round((image.astype(np.float64) - lo) * 255 / (hi - lo)).astype(np.uint8)
    if operation == "median":
        return np.stack([np.median(_around(image[:, :, c]), axis=0).astype(np.uint8) for c in range(image.shape[2])], axis=2)
    if operation == "sharpen":
        mean = np.stack([_around(image[:, :, c].astype(np.float64)).mean(axis=0) for c in range(image.shape[2])], axis=2)
        return np.clip(np.round(image + 1.35 * (image - mean)), 0, 255).astype(np.uint8)
    if operation == "threshold":
        return np.where(image >= THRESHOLD, 255, 0).astype(np.uint8)
    raise ValueError(f"no operation {operation}")


def shrunk(image: np.ndarray, most: int) -> np.ndarray:
    """Sides of at most so many pixels, by means over blocks of a whole number of pixels."""
    k = -(-max(image.shape[:2]) // most) if most > 0 else 1
    if k <= 1:
        return image
    padded = np.pad(image, ((0, -image.shape[0] % k), (0, -image.shape[1] % k), (0, 0)), mode="edge").astype(np.float64)
    return np.round(padded.reshape(padded.shape[0] // k, k, padded.shape[1] // k, k, -1).mean(axis=(1, 3))).astype(np.uint8)


def prepared(images: DataFrame, mode: str = "standard", max_side: int = 0) -> DataFrame:
    """(path, status, error, width, height, operations, png) of images (path, content); one that can't be read is an error row."""
    if mode not in MODES:
        raise ValueError(f"unknown mode: {mode}")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, content in zip(b["path"], b["content"]):
                try:
                    image, done = decoded(bytes(content)), list(MODES[mode])
                    for operation in MODES[mode]:
                        image = applied(image, operation)
                    if max_side and max(image.shape[:2]) > max_side:
                        image = shrunk(image, max_side)
                        done.append(f"max_side_{max_side}")
                    rows.append((path, "ok", None, image.shape[1], image.shape[0], done, encoded(image)))
                except Exception as e:  # an image's fault is its row's status
                    rows.append((path, "error", f"{type(e).__name__}: {e}", 0, 0, [], None))
            yield pd.DataFrame(rows, columns=["path", "status", "error", "width", "height", "operations", "png"])

    return images.select("path", "content").mapInPandas(run, PREPARED)
