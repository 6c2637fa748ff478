"""Image functions on bytes.

No imaging library is assumed: JPEG, PNG and PNM are decoded here with zlib
and numpy, and any other format by a ``decode`` function the caller brings
(``bytes -> array of height x width x 3``, or None).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.jpeg import decode_jpeg

Decode = Callable[[bytes], "np.ndarray | None"]


def _png(data: bytes) -> np.ndarray | None:
    at, packed, palette, clear = 8, [], None, None
    width = height = depth = kind = interlace = 0
    while at + 8 <= len(data):
        size, name = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + size]
        if name == b"IHDR":
            width, height, depth, kind, _, _, interlace = struct.unpack(">IIBBBBB", body)
        elif name == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif name == b"tRNS":
            clear = np.frombuffer(body, np.uint8)
        elif name == b"IDAT":
            packed.append(body)
        at += 12 + size
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[kind]
    if depth != 8 or interlace:
        return None
    raw = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, 1 + width * channels)
    out = np.zeros((height, width * channels), np.uint8)
    above = np.zeros(width * channels, np.int32)
    for y in range(height):
        filter_kind, line = raw[y, 0], raw[y, 1:].astype(np.int32)
        if filter_kind == 2:
            line = line + above
        elif filter_kind:
            for x in range(len(line)):
                left = line[x - channels] if x >= channels else 0
                up, corner = above[x], above[x - channels] if x >= channels else 0
                if filter_kind == 1:
                    guess = left
                elif filter_kind == 3:
                    guess = (left + up) // 2
                else:
                    p = left + up - corner
                    guess = min((abs(p - left), 0, left), (abs(p - up), 1, up), (abs(p - corner), 2, corner))[2]
                line[x] = (line[x] + guess) & 255
        above = line & 255
        out[y] = above
    pixels = out.reshape(height, width, channels)
    if kind == 3:
        alpha = None if clear is None else np.append(clear, np.full(256 - len(clear), 255, np.uint8))[pixels[..., 0]]
        rgb = palette[pixels[..., 0]]
    else:
        rgb = pixels[..., :1].repeat(3, 2) if channels < 3 else pixels[..., :3]
        alpha = pixels[..., -1] if channels in (2, 4) else None
    return rgb if alpha is None else on_white(np.dstack([rgb, alpha]))


def _pnm(data: bytes) -> np.ndarray | None:
    parts = data.split(None, 4)
    channels = {b"P5": 1, b"P6": 3}.get(parts[0])
    if channels is None or parts[3] != b"255":
        return None
    width, height = int(parts[1]), int(parts[2])
    raw = data[len(data) - width * height * channels :]
    return np.frombuffer(raw, np.uint8).reshape(height, width, channels).repeat(4 - channels if channels == 1 else 1, 2)[..., :3]


def decode_image(data: bytes, other: Decode | None = None) -> np.ndarray | None:
    """RGB pixels of an image's bytes; None for what can't be read."""
    try:
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            return _png(data)
        if data[:2] == b"\xff\xd8":
            return decode_jpeg(data)
        if data[:2] in (b"P5", b"P6"):
            return _pnm(data)
        return other(data) if other else None
    except Exception:
        return None


def on_white(rgba: np.ndarray) -> np.ndarray:
    """Transparent pixels composed on white."""
    alpha = rgba[..., 3:].astype(np.float64) / 255
    return np.rint(rgba[..., :3] * alpha + 255 * (1 - alpha)).astype(np.uint8)


def resized(pixels: np.ndarray, height: int, width: int) -> np.ndarray:
    """Area mean or, when growing, linear interpolation; the aspect isn't kept."""

    def weights(old: int, new: int) -> np.ndarray:
        scale = max(old / new, 1.0)
        centre = (np.arange(new) + 0.5) * old / new
        w = np.maximum(0, 1 - np.abs((np.arange(old) + 0.5)[None, :] - centre[:, None]) / scale)
        return w / w.sum(1, keepdims=True)

    x = pixels.astype(np.float64)
    flat = x.reshape(x.shape[0], x.shape[1], -1)
    down = np.tensordot(weights(x.shape[0], height), flat, (1, 0))
    out = np.tensordot(down, weights(x.shape[1], width), (1, 1)).swapaxes(1, 2)
    return np.clip(np.rint(out), 0, 255).astype(np.uint8).reshape((height, width, *x.shape[2:]))


def unique_colors(pixels: np.ndarray, size: int = 64, bits: int = 8) -> int:
    """Distinct colours of the image at ``size`` x ``size``, with the lower bits masked."""
    small = resized(pixels, size, size).reshape(-1, 3).astype(np.int64) >> (8 - bits)
    return len(np.unique(small @ np.array([1 << 16, 1 << 8, 1])))


_DCT = np.cos(np.pi * np.outer(np.arange(8), 2 * np.arange(32) + 1) / 64)


def phash(pixels: np.ndarray) -> str:
    """64-bit perceptual hash: grey, 32 x 32, the low 8 x 8 of the DCT against its median, in hex."""
    grey = pixels.astype(np.float64) @ np.array([0.299, 0.587, 0.114])
    low = _DCT @ resized(grey, 32, 32) @ _DCT.T
    bits = (low > np.median(low)).ravel()
    return f"{int(''.join('1' if b else '0' for b in bits), 2):016x}"


def _over_bytes(one: Callable[[np.ndarray], object], kind: T.DataType, decode: Decode | None):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = [None if b is None else decode_image(bytes(b), decode) for b in batch]
            yield pd.Series([None if p is None else one(p) for p in found], dtype=object if isinstance(kind, T.StringType) else "Int32")

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, kind)


def color_count(data: Column | str, size: int = 64, bits: int = 8, decode: Decode | None = None) -> Column:
    """Distinct colours of an image's bytes; NULL if they can't be read."""
    return _over_bytes(lambda p: unique_colors(p, size, bits), T.IntegerType(), decode)(data)


def phash_of(data: Column | str, decode: Decode | None = None) -> Column:
    """Perceptual hash of an image's bytes in 16 hex digits; NULL if they can't be read."""
    return _over_bytes(phash, T.StringType(), decode)(data)


def distinct_colors(pixels: Column, bits: int = 8) -> Column:
    """Distinct values of an array of pixels (arrays of channels), lower bits masked, in the JVM."""
    shift = 8 - bits
    masked = F.transform(pixels, lambda p: F.transform(p, lambda v: F.shiftleft(F.shiftright(v, shift), shift)))
    return F.size(F.array_distinct(masked))
