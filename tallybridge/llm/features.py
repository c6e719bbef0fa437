"""Hashed features of whole texts, computed over byte arrays rather than word by word.

Texts are taken in chunks of rows; a text longer than ``BYTES`` is taken in pieces that end
after white space where the last 4 KB of a piece have some, so memory stays bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import kept

BYTES = 1 << 20
ROWS = 256
BASE = 0x9E3779B97F4A7C15
SPREAD = np.uint64(0xD6E8FEB86659FD93)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null is empty."""
    column = column.fill_null("") if column.null_count else column
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None and len(body) else np.empty(0, np.uint8)
    return data, (offsets - offsets[0]).astype(np.int64)


def chunks(column: pa.Array) -> Iterator[tuple[int, int, Iterator[tuple[np.ndarray, np.ndarray]]]]:
    """(first row, row after the last, pieces); a piece is its bytes and the offsets of the rows."""
    data, offsets = utf8(column)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + BYTES, side="right")) - 1
        last = max(first + 1, min(last, first + ROWS, len(column)))
        yield first, last, _pieces(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    if len(data) <= BYTES:
        yield data, offsets
        return
    at = 0  # one long row
    while at < len(data):
        end = min(at + BYTES, len(data))
        if end < len(data):
            blank = np.flatnonzero(data[max(at, end - 4096) : end] <= 0x20)
            end = max(at, end - 4096) + int(blank[-1]) + 1 if len(blank) else end
        yield data[at:end], np.array([0, end - at])
        at = end


def _lower() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


def _letters() -> np.ndarray:
    out = np.zeros(256, bool)
    out[65:91] = out[97:123] = out[128:] = True
    return out


def _shapes() -> np.ndarray:
    """Lower case and all beyond ASCII 0, upper case 1, digits 2, controls 3, then each sign."""
    out = np.zeros(256, np.uint64)
    out[65:91], out[48:58], out[:32] = 1, 2, 3
    signs = [b for b in range(32, 128) if not chr(b).isalnum()]
    out[signs] = np.arange(4, 4 + len(signs))
    return out


LOWER, LETTER, SHAPE = _lower(), _letters(), _shapes()


def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, for the bytes of a piece."""

    def make():
        inverse = pow(BASE, -1, 1 << 64)
        return tuple(np.cumprod(np.full(BYTES + 1, b, np.uint64)) for b in (BASE, inverse))

    return kept("powers", make)


def spread(values: np.ndarray, bits: int) -> np.ndarray:
    """The top bits of a mixed 64-bit hash."""
    values = (values ^ (values >> np.uint64(32))) * SPREAD
    return ((values ^ (values >> np.uint64(29))) * SPREAD) >> np.uint64(64 - bits)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every run of letters; A-Z count as a-z, all bytes beyond ASCII as letters."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    letter = LETTER[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = letter.copy()
    starts[1:] &= ~letter[:-1] | edge[1:-1]
    ends = letter
    ends[:-1] &= ~letter[1:] | edge[1:-1]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends)
    power, inverse = powers()
    summed = np.cumsum((LOWER[data].astype(np.uint64) + np.uint64(1)) * power[: len(data)])
    before = np.where(first > 0, summed[first - 1], np.uint64(0))
    return np.searchsorted(offsets, first, side="right") - 1, (summed[last] - before) * inverse[first]


def shape_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every three neighbouring bytes of one text, by the kind of each."""
    if len(data) < 3:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    kind = SHAPE[data]
    code = (kind[:-2] * np.uint64(64) + kind[1:-1]) * np.uint64(64) + kind[2:]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = row[:-2] == row[2:]
    return row[:-2][inside], code[inside]
