"""Media columns: Netpbm and BMP to numpy arrays, area resizing by integral images, NPY tiles and difference hashes.

Arrays are uint8 of shape (height, width) or (height, width, 3). A picture is resized by area: each target sample is the
mean of the source area that it covers, fractions of pixels included, looked up in the integral image. A tile is the resized
picture as an NPY file; a difference hash has a bit for every pair of neighbours in a row of a grey tile.

Defined results: bytes that are no whole picture of a known format raise ValueError; null text is an empty payload, which is
padded like any other; a payload of any length becomes one picture.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Payloads are padded to a multiple of this: a row of the stored picture.
ROW_BYTES = 192
#: Side of the tile that features come from, and size of the difference hash.
TILE, HASH = 16, 8


def _netpbm_numbers(data: bytes, at: int, count: int) -> tuple[list[int], int]:
    """The next numbers of a header, past white space and comments, and where the last one ends."""
    found = []
    while len(found) < count:
        m = re.compile(rb"(?:\s|#[^\n]*\n)*(\d+)").match(data, at)
        if not m:
            raise ValueError("a Netpbm header is not whole")
        found.append(int(m[1]))
        at = m.end()
    return found, at


def decode_netpbm(data: bytes) -> np.ndarray:
    """P1 to P6 with at most 8 bits a sample."""
    if not re.match(rb"P[1-6]\s", data[:3]):
        raise ValueError("not Netpbm")
    kind = data[1] - 48
    numbers, at = _netpbm_numbers(data, 2, 2 if kind in (1, 4) else 3)
    width, height, most = *numbers, *([1] if kind in (1, 4) else [])
    if most > 255 or most < 1:
        raise ValueError("more than 8 bits a sample")
    shape = (height, width, 3) if kind in (3, 6) else (height, width)
    n = int(np.prod(shape))
    if kind == 1:
        bits = np.frombuffer(re.sub(rb"\s|#[^\n]*", b"", data[at:]), np.uint8)[:n]
        raw = 1 - (bits - 48)
    elif kind in (2, 3):
        raw = np.array(re.sub(rb"#[^\n]*", b"", data[at:]).split()[:n], np.int64)
    elif kind == 4:
        row = (width + 7) // 8
        packed = np.frombuffer(data, np.uint8, offset=at + 1)[: row * height]
        if packed.size < row * height:
            raise ValueError("the samples end early")
        raw = 1 - np.unpackbits(packed.reshape(height, row), axis=1)[:, :width].reshape(-1)
    else:
        raw = np.frombuffer(data, np.uint8, offset=at + 1)[:n]
    if raw.size != n:
        raise ValueError("the samples end early")
    raw = raw.astype(np.uint8) if most == 255 else (raw.astype(np.int64) * 255 // most).astype(np.uint8)
    return raw.reshape(shape)


def encode_netpbm(pixels: np.ndarray) -> bytes:
    """P5 or P6."""
    height, width = pixels.shape[:2]
    return b"P%d\n%d %d\n255\n" % (6 if pixels.ndim == 3 else 5, width, height) + pixels.tobytes()


def decode_bmp(data: bytes) -> np.ndarray:
    """Uncompressed BMP of 8 bits with a palette, 24 or 32 bits, from the bottom up or from the top down."""
    if data[:2] != b"BM" or len(data) < 54:
        raise ValueError("not BMP")
    start, header, width, height, _, bits, packing = struct.unpack_from("<IIiiHHI", data, 10)
    colours = struct.unpack_from("<I", data, 46)[0]
    if packing not in (0, 3) or bits not in (8, 24, 32) or width < 0:
        raise ValueError("a BMP of another kind")
    row = (width * bits // 8 + 3) // 4 * 4
    raw = np.frombuffer(data, np.uint8, offset=start)[: row * abs(height)]
    if raw.size < row * abs(height):
        raise ValueError("the samples end early")
    raw = raw.reshape(abs(height), row)[:, : width * bits // 8]
    if bits == 8:
        palette = np.frombuffer(data, np.uint8, offset=14 + header)[: 4 * (colours or 256)].reshape(-1, 4)
        out = palette[raw][..., 2::-1]
    else:
        out = raw.reshape(abs(height), width, bits // 8)[..., 2::-1]
    return np.ascontiguousarray(out[::-1] if height > 0 else out)


def encode_bmp(pixels: np.ndarray) -> bytes:
    """24 bits, from the bottom up."""
    rgb = pixels if pixels.ndim == 3 else np.repeat(pixels[..., None], 3, 2)
    height, width = rgb.shape[:2]
    row = (width * 3 + 3) // 4 * 4
    raw = np.zeros((height, row), np.uint8)
    raw[:, : width * 3] = rgb[::-1, :, ::-1].reshape(height, width * 3)
    return struct.pack("<2sIHHI", b"BM", 54 + raw.size, 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, width, height, 1, 24, 0, raw.size, 2835, 2835, 0, 0) + raw.tobytes()


def decode(data: bytes) -> np.ndarray:
    return decode_bmp(data) if data[:2] == b"BM" else decode_netpbm(data)


def area_resize(pixels: np.ndarray, height: int, width: int) -> np.ndarray:
    """float64 means over the areas that the target samples cover; an empty picture is black."""
    if pixels.size == 0:
        return np.zeros((height, width, *pixels.shape[2:]))
    integral = np.zeros((pixels.shape[0] + 1, pixels.shape[1] + 1, *pixels.shape[2:]))
    np.cumsum(np.cumsum(pixels, 0, dtype=np.float64), 1, out=integral[1:, 1:])

    def lines(table: np.ndarray, n: int) -> np.ndarray:
        """The integral at n + 1 evenly spaced places of the first axis."""
        at = np.arange(n + 1) * (table.shape[0] - 1) / n
        low = np.minimum(at.astype(np.int64), table.shape[0] - 2)
        part = (at - low).reshape(-1, *[1] * (table.ndim - 1))
        return table[low] * (1 - part) + table[low + 1] * part

    rows = np.diff(lines(integral, height), axis=0)
    cells = np.diff(lines(rows.swapaxes(0, 1), width), axis=0).swapaxes(0, 1)
    return cells * (height * width / (pixels.shape[0] * pixels.shape[1]))


def grey(pixels: np.ndarray) -> np.ndarray:
    return pixels if pixels.ndim == 2 else pixels.astype(np.float64) @ np.array([0.299, 0.587, 0.114])


def npy_tile(pixels: np.ndarray, side: int = TILE) -> bytes:
    """The picture resized to side x side, rounded to uint8, as an NPY file."""
    out = io.BytesIO()
    np.save(out, np.rint(area_resize(pixels, side, side)).clip(0, 255).astype(np.uint8), allow_pickle=False)
    return out.getvalue()


def difference_hash(pixels: np.ndarray, side: int = HASH) -> str:
    """side * side bits in hex: is a sample lighter than its left neighbour in the grey picture of side rows?"""
    small = area_resize(grey(pixels), side, side + 1)
    return np.packbits(np.diff(small, axis=1) > 1e-9).tobytes().hex()


def pack(payload: bytes) -> tuple[np.ndarray, int]:
    """The payload, padded by spaces to whole rows, as a picture of 64 RGB pixels a row; and the padded length."""
    padded = payload.ljust(max(1, -(-len(payload) // ROW_BYTES)) * ROW_BYTES, b" ")
    return np.frombuffer(padded, np.uint8).reshape(-1, ROW_BYTES // 3, 3), len(padded)


def media_column(text: Column) -> Column:
    """Each text stored as a P6 picture: its bytes, the payload read back from them, an NPY tile and a feature string."""

    @F.pandas_udf("n_bytes long, media binary, payload binary, tile binary, feature string")
    def media(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([_stored(t) for t in texts], columns=["n_bytes", "media", "payload", "tile", "feature"], index=texts.index)

    return media(text)


def _stored(text: str | None) -> tuple[int, bytes, bytes, bytes, str]:
    raw = (text or "").encode()
    stored = encode_netpbm(pack(raw)[0])
    read = decode(stored)
    tile = npy_tile(read)
    return len(raw), stored, read.tobytes(), tile, f"dhash={difference_hash(read)};tile={zlib.crc32(tile):08x};rows={read.shape[0]}"


def digest_column(text: Column) -> Column:
    """What ``media_column`` makes, as sizes and digests."""

    @F.pandas_udf("n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
        for texts in batches:
            rows = []
            for t in texts:
                n, stored, payload, _, feature = _stored(t)
                rows.append((n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), feature))
            yield pd.DataFrame(rows, columns=names, index=texts.index)

    return digests(text)
