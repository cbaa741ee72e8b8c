"""Compressed frames: payload search and PNG decoding, batch by batch in Python.

Spark's image source gives 8-bit pictures only, so 16-bit depth frames have their own decoder (grey, RGB, 8 and 16 bits, not
interlaced).  A payload that can't be read gives its error instead of failing its batch.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

SIGNATURE = b"\x89PNG\r\n\x1a\n"
HEADER = 12  # bytes before the picture where no signature is found


def payload(data: bytes) -> bytes:
    """The picture inside a depth message: from the PNG signature on, else after the 12-byte header."""
    at = data.find(SIGNATURE)
    return data[at:] if at >= 0 else data[HEADER:]


def decode_png(data: bytes) -> np.ndarray:
    """Height by width (by channels) of uint8 or uint16."""
    if not data.startswith(SIGNATURE):
        raise ValueError("no PNG signature")
    at, packed, head = 8, b"", None
    while at + 8 <= len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + n]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            packed += body
        elif kind == b"IEND":
            break
        at += 12 + n
    if head is None:
        raise ValueError("no header chunk")
    width, height, depth, color, _, _, interlace = head
    channels = {0: 1, 2: 3, 4: 2, 6: 4}.get(color)
    if channels is None or depth not in (8, 16) or interlace:
        raise ValueError(f"unsupported PNG: colour {color}, depth {depth}, interlace {interlace}")
    step = channels * depth // 8
    stride = width * step
    raw = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(height, stride + 1)
    out = np.zeros((height, stride), np.uint8)
    above = np.zeros(stride, np.uint8)
    for y in range(height):
        out[y] = above = _unfilter(int(raw[y, 0]), raw[y, 1:], above, step)
    image = out.view(">u2").astype(np.uint16) if depth == 16 else out
    return image.reshape(height, width) if channels == 1 else image.reshape(height, width, channels)


def _unfilter(kind: int, line: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    if kind == 0:
        return line.copy()
    if kind == 2:
        return line + above
    if kind == 1:
        return np.cumsum(line.reshape(-1, step), axis=0, dtype=np.uint8).ravel()
    if kind not in (3, 4):
        raise ValueError(f"unknown filter {kind}")
    out = [0] * step + line.tolist()
    up = [0] * step + above.tolist()
    for i in range(step, len(out)):
        a, b, c = out[i - step], up[i], up[i - step]
        if kind == 3:
            guess = (a + b) // 2
        else:
            pa, pb, pc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
            guess = a if pa <= pb and pa <= pc else b if pb <= pc else c
        out[i] = (out[i] + guess) & 255
    return np.array(out[step:], np.uint8)


FRAME = StructType([StructField("width", IntegerType()), StructField("height", IntegerType()), StructField("encoding", StringType()), StructField("data", BinaryType()), StructField("error", StringType())])


@F.pandas_udf(FRAME)
def decode_depth(data: pd.Series) -> pd.DataFrame:
    """Depth messages as little-endian pixels; `error` is set and the rest null where one can't be read."""
    rows = []
    for d in data:
        try:
            image = decode_png(payload(bytes(d)))
            kind = "16UC1" if image.dtype == np.uint16 else "mono8" if image.ndim == 2 else f"8UC{image.shape[2]}"
            rows.append((image.shape[1], image.shape[0], kind, image.astype(image.dtype.newbyteorder("<")).tobytes(), None))
        except Exception as e:
            rows.append((None, None, None, None, f"{type(e).__name__}: {e}"))
    out = pd.DataFrame(rows, columns=["width", "height", "encoding", "data", "error"])
    return out.astype({"width": "Int32", "height": "Int32"})


@F.pandas_udf(BinaryType())
def bgr_to_rgb(data: pd.Series) -> pd.Series:
    """Swap the first and third channel of 3-byte pixels, as Spark's image source orders them."""
    return pd.Series([None if d is None else np.frombuffer(d, np.uint8).reshape(-1, 3)[:, ::-1].tobytes() for d in data])


def encode_png(image: np.ndarray, filters: list[int] | None = None) -> bytes:
    """A PNG of a grey image, each row with the filter named for it (0 if none is): for fixtures and sinks."""
    depth = 16 if image.dtype == np.uint16 else 8
    step = depth // 8
    rows = image.astype(">u2" if depth == 16 else np.uint8).view(np.uint8).reshape(image.shape[0], -1)
    above, body = np.zeros(rows.shape[1], np.int64), b""
    for y, row in enumerate(rows.astype(np.int64)):
        left, corner = np.concatenate([np.zeros(step, np.int64), row[:-step]]), np.concatenate([np.zeros(step, np.int64), above[:-step]])
        kind = filters[y % len(filters)] if filters else 0
        p = left + above - corner
        pa, pb, pc = abs(p - left), abs(p - above), abs(p - corner)
        guess = (np.zeros_like(row), left, above, (left + above) // 2, np.where((pa <= pb) & (pa <= pc), left, np.where(pb <= pc, above, corner)))[kind]
        body += bytes([kind]) + ((row - guess) & 255).astype(np.uint8).tobytes()
        above = row
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", image.shape[1], image.shape[0], depth, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(body)) + chunk(b"IEND", b"")


@F.pandas_udf(BinaryType())
def encode_depth(data: pd.Series) -> pd.Series:
    """Bytes as a depth message: pairs of them are 16-bit pixels in rows of 512, padded with zeros; no bytes make a message without a picture."""
    out = []
    for d in data:
        d = bytes(d or b"")
        image = np.frombuffer(d + bytes(-len(d) % 1024), ">u2").reshape(-1, 512).astype(np.uint16)
        out.append(b"\0" * HEADER + (encode_png(image, [0, 1, 2]) if d else b"none"))
    return pd.Series(out)


@F.pandas_udf(LongType())
def pixel_sum(data: pd.Series) -> pd.Series:
    """The sum of 16-bit pixels."""
    return pd.Series([None if d is None else int(np.frombuffer(d, "<u2").sum(dtype=np.int64)) for d in data], dtype="Int64")
