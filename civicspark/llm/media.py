"""Media columns: texts' bytes as PNG images, read back with checks, with a low-frequency hash."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: A row of pixels holds this many bytes: 64 pixels of three 8-bit samples.
ROW, PIXEL = 192, 3
SIDE, LOW = 32, 8


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def pad(data: bytes) -> bytes:
    """data with spaces up to a positive multiple of ROW."""
    return data.ljust(max(1, -(-len(data) // ROW)) * ROW, b" ")


def filter_rows(rows: np.ndarray, kind: int) -> np.ndarray:
    """The rows' bytes as PNG filter 0 (none), 1 (sub), 2 (up), 3 (average) or 4 (Paeth) leaves them."""
    left, up, corner = np.zeros_like(rows), np.zeros_like(rows), np.zeros_like(rows)
    left[:, PIXEL:], up[1:] = rows[:, :-PIXEL], rows[:-1]
    corner[1:, PIXEL:] = rows[:-1, :-PIXEL]
    if kind == 3:
        return rows - ((left.astype(np.uint16) + up) // 2).astype(np.uint8)
    if kind == 4:
        return rows - _paeth(left.astype(np.int16), up.astype(np.int16), corner.astype(np.int16))
    return rows - (0, left, up)[kind] if kind else rows


def _paeth(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    to_a, to_b, to_c = np.abs(b - c), np.abs(a - c), np.abs(a + b - 2 * c)
    return np.where((to_a <= to_b) & (to_a <= to_c), a, np.where(to_b <= to_c, b, c)).astype(np.uint8)


#: c log2 c for a byte that a row holds c times.
_BITS = np.arange(ROW + 1) * np.log2(np.maximum(1, np.arange(ROW + 1)))


def _entropy(rows: np.ndarray) -> np.ndarray:
    """Of each row, the bits that its bytes need when each value has a code of its own, but for a constant."""
    counts = np.bincount((rows + 256 * np.arange(len(rows))[:, None]).ravel(), minlength=256 * len(rows))
    return -_BITS[counts].reshape(len(rows), 256).sum(axis=1)


def chosen_filters(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The filter, none, sub or up, that leaves each row with the least entropy, none in a tie; and the rows so
    filtered. Prose is mostly best as it is; runs, tables and repeated lines aren't."""
    tried = np.stack([filter_rows(rows, k) for k in (0, 1, 2)])
    kinds = np.argmin(np.stack([_entropy(t) for t in tried]).round(6), axis=0)
    return kinds, tried[kinds, np.arange(len(rows))]


def unfilter(rows: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """The reverse, for any kind on any row: sums along a row or a run of rows where all filters are linear;
    with the other two, all pixels of a diagonal at once, since each needs those to its left and above."""
    if not kinds.any():
        return rows
    if kinds.max() > 4:
        raise ValueError(f"filter {kinds.max()} is unknown")
    if kinds.max() > 2:
        return _unfilter_by_diagonals(rows, kinds)
    out = rows.copy()
    edges = np.flatnonzero(np.diff(kinds)) + 1
    for start, stop in zip([0, *edges], [*edges, len(kinds)], strict=True):
        if kinds[start] == 1:
            out[start:stop] = np.cumsum(rows[start:stop].reshape(stop - start, -1, PIXEL), axis=1, dtype=np.uint8).reshape(stop - start, -1)
        elif kinds[start] == 2:
            base = out[start - 1 : start] if start else np.zeros_like(rows[:1])
            out[start:stop] = np.cumsum(np.concatenate([base, rows[start:stop]]), axis=0, dtype=np.uint8)[1:]
    return out


def _unfilter_by_diagonals(rows: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    high, wide = len(rows), rows.shape[1] // PIXEL
    pixels = rows.reshape(high, wide, PIXEL).astype(np.int16)
    out = np.zeros((high + 1, wide + 1, PIXEL), np.int16)  # with zeros above and to the left
    for d in range(high + wide - 1):
        y = np.arange(max(0, d - wide + 1), min(high, d + 1))
        x = d - y
        left, up, corner = out[y + 1, x], out[y, x + 1], out[y, x]
        guesses = [np.zeros_like(left), left, up, (left + up) // 2, _paeth(left, up, corner).astype(np.int16)]
        out[y + 1, x + 1] = (pixels[y, x] + np.choose(kinds[y, None], guesses)) & 255
    return out[1:, 1:].astype(np.uint8).reshape(high, -1)


def to_png(payload: bytes, kind: int | None = None, level: int = 3) -> bytes:
    """An 8-bit RGB image, 64 pixels wide, whose samples are the payload's bytes in order; without a kind each
    row has the filter that suits it."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, ROW)
    lines = np.empty((len(rows), ROW + 1), np.uint8)
    lines[:, 0], lines[:, 1:] = chosen_filters(rows) if kind is None else (kind, filter_rows(rows, kind))
    head = struct.pack(">IIBBBBB", ROW // PIXEL, len(rows), 8, 2, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), level)) + _chunk(b"IEND", b"")


def from_png(media: bytes) -> bytes:
    """The samples of an image that to_png() has made; raises ValueError if any check fails."""
    if media[:8] != SIGNATURE:
        raise ValueError("no PNG signature")
    at, head, data, ended = 8, None, [], False
    while at < len(media):
        (size,) = struct.unpack_from(">I", media, at)
        kind, body = media[at + 4 : at + 8], media[at + 8 : at + 8 + size]
        if len(body) < size or struct.unpack_from(">I", media, at + 8 + size)[0] != zlib.crc32(kind + body):
            raise ValueError(f"chunk {kind!r} fails its checksum")
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            data.append(body)
        ended |= kind == b"IEND"
        at += 12 + size
    if head is None or not ended or head[0] * PIXEL != ROW or head[2:] != (8, 2, 0, 0, 0):
        raise ValueError("not a whole image of the kind stored here")
    lines = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8)
    if len(lines) != head[1] * (ROW + 1):
        raise ValueError("the image has not as many rows as it declares")
    lines = lines.reshape(-1, ROW + 1)
    return unfilter(lines[:, 1:], lines[:, 0]).tobytes()


def _cosines() -> np.ndarray:
    k, x = np.arange(LOW)[:, None], np.arange(SIDE)[None, :]
    return np.cos(np.pi * (2 * x + 1) * k / (2 * SIDE))


def low_frequency_hash(payload: bytes, basis: np.ndarray = _cosines()) -> bytes:  # noqa: B008
    """64 bits: which of the 8 x 8 lowest cosine terms of the image, brought to 32 x 32 grey cells by
    block means, lie above their median."""
    grey = np.frombuffer(payload, np.uint8).reshape(-1, ROW // PIXEL, PIXEL).sum(axis=2, dtype=np.int64)
    edges = np.linspace(0, len(grey), SIDE + 1).astype(np.int64)
    down = np.concatenate([np.zeros((1, grey.shape[1]), np.int64), np.cumsum(grey, axis=0)])
    starts = np.minimum(edges[:-1], len(grey) - 1)
    stops = np.maximum(edges[1:], starts + 1)
    cells = (down[stops] - down[starts]) / (stops - starts)[:, None]
    cells = cells.reshape(SIDE, SIDE, -1).mean(axis=2)
    terms = (basis @ cells @ basis.T).round(6).ravel()
    return np.packbits(terms > np.median(terms[1:])).tobytes()


def encode_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kind: int | None = None) -> DataFrame:
    """id, n_bytes and media (binary PNG) for each row; null counts as empty, which is one row of spaces."""
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, n_bytes long, media binary"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(x.as_buffer().to_pybytes() if x.is_valid else b"") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([to_png(pad(t), kind) for t in texts], pa.binary())], ["id", "n_bytes", "media"])

    return docs.select(id_col, text_col).mapInArrow(encode, schema).withColumnRenamed("id", id_col)


def decode_media(media: DataFrame, id_col: str = "doc_id", with_payload: bool = False) -> DataFrame:
    """What the stored bytes hold: payload sizes and digests, and the hash as a binary column.

    A broken image raises; a null one gives nulls."""
    schema = f"id {media.schema[id_col].dataType.simpleString()}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, low_hash binary" + ", payload binary" * with_payload

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x in batch.column(2):
                if not x.is_valid:
                    rows.append((None,) * 7)
                    continue
                stored = x.as_buffer().to_pybytes()
                data = from_png(stored)
                rows.append((len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), low_frequency_hash(data), data if with_payload else None))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary()]
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds[: 6 + with_payload])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "low_hash", "payload"][: 8 + with_payload])

    return media.select(id_col, "n_bytes", "media").mapInArrow(decode, schema).withColumnRenamed("id", id_col)


def media_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stores every text as an image in a table with a binary column, reads that table and describes what it holds.

    Rows pass one to one: repeated rows, null ids and very long texts alike; an empty table gives no rows."""
    stored = materialise(encode_media(docs, id_col, text_col), "media")
    return decode_media(stored, id_col).withColumn("feature", F.lower(F.hex("low_hash")))
