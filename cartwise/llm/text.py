"""Vectorised work on the bytes of Arrow strings, shared by the batch functions.

A batch is cut into pieces of whole rows; a piece is two numpy arrays, the UTF-8 bytes
and the row offsets. Nulls count as empty texts. Nothing here keeps more than a piece
and its words, whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words as runs of everything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
PIECE_BYTES = 1 << 20

_ALL = np.arange(256)
LOWER = np.where((_ALL >= 65) & (_ALL <= 90), _ALL + 32, _ALL).astype(np.uint8)
#: Bytes of words between white space.
SPACED = ~((_ALL == 32) | ((_ALL >= 9) & (_ALL <= 13)))
#: Bytes of words made of digits, lower-case letters and everything beyond ASCII.
ALNUM = ((_ALL >= 48) & (_ALL <= 57)) | ((_ALL >= 97) & (_ALL <= 122)) | (_ALL >= 128)


def lowered(column: Column | str) -> Column:
    """A-Z in lower case, everything else as it is; null as empty text."""
    column = F.col(column) if isinstance(column, str) else column
    return F.translate(F.coalesce(column, F.lit("")), UPPER, UPPER.lower())


def fold(doc_id: Column | str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % parts


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (from 0) of an Arrow string array."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def pieces(texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with about ``limit`` bytes."""
    data, at = raw(texts)
    first, rows = 0, len(at) - 1
    while first < rows:
        end = int(np.searchsorted(at, at[first] + limit, "right")) - 1
        end = min(rows, max(first + 1, end))
        yield first, end, data[at[first] : at[end]], at[first : end + 1] - at[first]
        first = end


def words_at(data: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all rows, and the number of words before each row.

    ``inside`` says of each byte value whether it belongs to words.
    """
    mask = inside[data]
    n = len(data)
    before = np.empty(n + 1, bool)
    before[0] = False
    before[1:] = mask
    edges = at[:-1]
    before[edges] = False
    starts = np.flatnonzero(mask & ~before[:n])
    after = np.empty(n + 1, bool)
    after[:n] = mask
    after[n] = False
    after[edges] = False
    ends = np.flatnonzero(mask & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, at, "left")


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (two rounds of multiplication and shift)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_STEP = 0x9E3779B97F4A7C15
_BYTE_CODES = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(_STEP))
_BASE = 0xD6E8FEB86659FD93


@lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2**64."""
    found = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        out = np.ones(1 << bits, np.uint64)
        for k in range(bits):
            out[1 << k : 2 << k] = out[: 1 << k] * np.uint64(pow(base, 1 << k, 1 << 64))
        found.append(out)
    return found[0], found[1]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word; equal words agree in every piece and task.

    Works through spans of about ``PIECE_BYTES``, so a very long row needs no more memory
    than a short one besides its words.
    """
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        low = int(starts[first])
        end = max(first + 1, int(np.searchsorted(ends, low + PIECE_BYTES, "right")))
        high = int(ends[end - 1])
        forth, back = _powers(max(12, (high - low).bit_length()))
        total = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_BYTE_CODES[data[low:high]] * forth[: high - low], out=total[1:])
        a, b = starts[first:end] - low, ends[first:end] - low
        out[first:end] = mix((total[b] - total[a]) * back[a] + (b - a).astype(np.uint64) * np.uint64(_STEP))
        first = end
    return out


def word_strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, inside: np.ndarray) -> pa.Array:
    """The words as one Arrow string array."""
    lengths = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    body = data[inside[data]] if len(starts) else data[:0]
    return pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(body))
    )


def shingles(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and the number of runs before each row.

    ``first`` is the number of words before each row. A row with fewer words, but at
    least one, has its whole sequence as its only run.
    """
    counts = np.diff(first)
    runs = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    before = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(runs, out=before[1:])
    begin = np.repeat(first[:-1] - before[:-1], runs) + np.arange(before[-1])
    last = np.repeat(first[1:], runs)
    code = np.zeros(len(begin), np.uint64)
    for k in range(size):
        there = begin + k < last
        word = hashes[np.minimum(begin + k, len(hashes) - 1)] if len(hashes) else code
        code = np.where(there, mix(code * np.uint64(_BASE) + word + np.uint64(k + 1)), code)
    return code, before
