"""Netpbm and BMP images as columns: decoded to numpy, area-resized by integral images, NPY tiles, difference hashes.

media_tiles() takes any table with a binary column of Netpbm (P1-P6) or uncompressed 8, 24 or 32 bit BMP files. The
digest query stores each text's bytes as the samples of a binary graymap, reads the stored file back and derives the
features from what it read. A file that can't be decoded gives nulls, not a failed task.

Null or empty text: one block of 576 bytes 255. Repeated rows: equal values. A null doc_id is returned as it is.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusloom.llm.common import id_text, row_map, written

BLOCK = 576
WIDTH = 24
TILE = (8, 9)  # rows, columns: a difference hash has 8 x 8 bits

_TOKEN = re.compile(rb"(?:\s|#[^\n\r]*[\n\r])*([^\s#]+)")


def encode_pgm(samples: np.ndarray) -> bytes:
    height, width = samples.shape
    return b"P5\n%d %d\n255\n" % (width, height) + samples.tobytes()


def encode_ppm(samples: np.ndarray) -> bytes:
    height, width, _ = samples.shape
    return b"P6\n%d %d\n255\n" % (width, height) + samples.tobytes()


def encode_bmp(samples: np.ndarray) -> bytes:
    """8-bit gray or 24-bit RGB, bottom row first."""
    height, width = samples.shape[:2]
    gray = samples.ndim == 2
    rows = samples if gray else samples[:, :, ::-1].reshape(height, -1)
    pad = -rows.shape[1] % 4
    body = np.pad(rows, ((0, 0), (0, pad)))[::-1].tobytes()
    palette = np.repeat(np.arange(256, dtype=np.uint8)[:, None], 4, axis=1) * np.array([1, 1, 1, 0], np.uint8) if gray else np.zeros(0, np.uint8)
    start = 54 + palette.size
    return struct.pack("<2sIHHI", b"BM", start + len(body), 0, 0, start) + struct.pack("<IiiHHIIiiII", 40, width, height, 1, 8 if gray else 24, 0, len(body), 2835, 2835, 256 * gray, 0) + palette.tobytes() + body


def decode_netpbm(data: bytes) -> np.ndarray:
    kind, at, numbers = data[:2], 2, []
    for _ in range(2 if kind in (b"P1", b"P4") else 3):
        m = _TOKEN.match(data, at)
        if not m:
            raise ValueError("Netpbm header ends early")
        numbers.append(int(m[1]))
        at = m.end()
    width, height = numbers[:2]
    top = numbers[2] if len(numbers) > 2 else 1
    depth = 3 if kind in (b"P3", b"P6") else 1
    n = width * height * depth
    if width < 1 or height < 1 or not 0 < top < 65536:
        raise ValueError("Netpbm sizes out of range")
    if n > 8 * len(data):
        raise ValueError("Netpbm samples end early")
    if kind == b"P4":
        rows = np.frombuffer(data, np.uint8, height * ((width + 7) // 8), at + 1).reshape(height, -1)
        out = 255 * (1 - np.unpackbits(rows, axis=1)[:, :width])
    elif kind in (b"P5", b"P6"):
        out = np.frombuffer(data, np.uint8 if top < 256 else ">u2", n, at + 1)
    elif kind == b"P1":
        out = 255 * (1 - np.array([c - 48 for c in re.sub(rb"#[^\n]*|\s", b"", data[at:])][:n]))
    elif kind in (b"P2", b"P3"):
        out = np.array(re.sub(rb"#[^\n]*", b"", data[at:]).split()[:n], dtype=np.int64)
    else:
        raise ValueError("not Netpbm")
    if out.size != n:
        raise ValueError("Netpbm samples end early")
    if kind not in (b"P1", b"P4") and top != 255:
        out = (out.astype(np.int64) * 255 + top // 2) // top
    out = out.astype(np.uint8, copy=False)
    return out.reshape((height, width, 3) if depth == 3 else (height, width))


def decode_bmp(data: bytes) -> np.ndarray:
    start, (size, width, height, _, bits, packing) = struct.unpack_from("<I", data, 10)[0], struct.unpack_from("<IiiHHI", data, 14)
    if packing not in (0, 3) or bits not in (8, 24, 32):
        raise ValueError("BMP form not supported")
    if width < 1 or height == 0:
        raise ValueError("BMP sizes out of range")
    stride = (width * bits // 8 + 3) // 4 * 4
    rows = np.frombuffer(data, np.uint8, stride * abs(height), start).reshape(abs(height), stride)[:, : width * bits // 8]
    rows = rows[::-1] if height > 0 else rows
    if bits == 8:
        palette = np.frombuffer(data, np.uint8, 1024, 14 + size).reshape(256, 4)[:, 2::-1]
        return palette[:, 0][rows] if (palette == palette[:, :1]).all() else palette[rows]
    return rows.reshape(abs(height), width, bits // 8)[:, :, 2::-1]


def decode(data: bytes) -> np.ndarray:
    return decode_bmp(data) if data[:2] == b"BM" else decode_netpbm(data)


def luma(image: np.ndarray) -> np.ndarray:
    return image if image.ndim == 2 else ((image.astype(np.uint32) @ np.array([299, 587, 114], np.uint32) + 500) // 1000).astype(np.uint8)


def area_resize(image: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """Mean of the area behind each target pixel, fractions included, from the integral image."""
    height, width = image.shape
    integral = np.zeros((height + 1, width + 1))
    np.cumsum(image, axis=0, out=integral[1:, 1:], dtype=np.float64)
    np.cumsum(integral[1:, 1:], axis=1, out=integral[1:, 1:])

    def at(edge: np.ndarray, axis: int, table: np.ndarray) -> np.ndarray:
        low = np.minimum(edge.astype(np.int64), table.shape[axis] - 2)
        part = (edge - low).reshape((-1, 1) if axis == 0 else (1, -1))
        return np.take(table, low, axis) * (1 - part) + np.take(table, low + 1, axis) * part

    ys, xs = np.linspace(0, height, shape[0] + 1), np.linspace(0, width, shape[1] + 1)
    corner = at(xs, 1, at(ys, 0, integral))
    sums = corner[1:, 1:] - corner[:-1, 1:] - corner[1:, :-1] + corner[:-1, :-1]
    return np.clip(np.rint(sums / ((height / shape[0]) * (width / shape[1]))), 0, 255).astype(np.uint8)


def npy(tile: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array(out, tile, version=(1, 0), allow_pickle=False)
    return out.getvalue()


def difference_hash(tile: np.ndarray) -> str:
    return np.packbits(tile[:, 1:] > tile[:, :-1]).tobytes().hex()


def features(data: bytes) -> tuple[np.ndarray, bytes, str]:
    """Samples, NPY tile and difference hash of a stored file."""
    image = decode(data)
    tile = area_resize(luma(image), TILE)
    return image, npy(tile), difference_hash(tile)


def media_tiles(df: DataFrame, column: str = "media") -> DataFrame:
    """Per row of a table with `column` (binary): width, height, tile (NPY file), dhash; nulls where it can't be decoded."""
    schema = pa.schema([("media_id", pa.int64()), ("width", pa.int32()), ("height", pa.int32()), ("tile", pa.binary()), ("dhash", pa.string())])

    def one(media_id: int, data: bytes | None) -> Iterator[tuple]:
        try:
            image, tile, mark = features(data or b"")
        except (ValueError, struct.error, IndexError, OverflowError):
            yield media_id, None, None, None, None
        else:
            yield media_id, image.shape[1], image.shape[0], tile, mark

    return df.select(df[df.columns[0]].cast("long"), df[column].cast("binary")).mapInArrow(row_map(one, schema), "media_id long, width int, height int, tile binary, dhash string")


def stored(text: str) -> tuple[int, bytes]:
    """Bytes of the text, and the graymap file that holds them padded."""
    raw = text.encode("utf-8", "surrogatepass")
    padded = raw + b"\xff" * (max(1, -(-len(raw) // BLOCK)) * BLOCK - len(raw))
    return len(raw), encode_pgm(np.frombuffer(padded, np.uint8).reshape(-1, WIDTH))


def text_files(df: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the graymap file (media) of each text."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())])
    return id_text(df).mapInArrow(row_map(lambda doc_id, text: [(doc_id, *stored(text))], schema), "doc_id long, n_bytes long, media binary")


def text_media(df: DataFrame) -> DataFrame:
    """Each text stored as a graymap in a table of the shared folder, read back from it, with its tile and hash."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("tile", pa.binary())])

    def one(doc_id: int, n: int, data: bytes) -> Iterator[tuple]:
        image, tile, mark = features(data)
        payload = image.tobytes()
        yield doc_id, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(data), hashlib.sha256(data).hexdigest(), mark, tile

    return written(text_files(df), "media").mapInArrow(row_map(one, schema), "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, tile binary")
