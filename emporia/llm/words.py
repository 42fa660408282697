"""Words, n-grams and their 64-bit hashes for Arrow columns of texts.

Words are maximal runs of bytes other than space and 0x09-0x0D.  All steps work
on the UTF-8 bytes of many texts at once; texts are taken in slices of about
``SLICE`` bytes, so memory does not follow the size of an Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE = 2_000_000
_U = np.uint64
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=_U)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Texts(NamedTuple):
    """Texts ``first`` .. ``first + len(offsets) - 1`` of a batch, as bytes."""

    first: int
    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """Word spans of ``Texts``; text t owns words bounds[t] .. bounds[t + 1]."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over the result."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def slices(column: pa.Array, lower: bool = False, size: int = SLICE) -> Iterator[Texts]:
    """Cut a string column into ``Texts``; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        part = data[offsets[at] : offsets[to]]
        yield Texts(at, _LOWER[part] if lower else part, offsets[at : to + 1] - offsets[at])
        at = to


def words_of(texts: Texts) -> Words:
    data, offsets = texts.data, texts.offsets
    if len(data) == 0:
        none = np.empty(0, np.int64)
        return Words(none, none, np.zeros(len(offsets), np.int64))
    inside = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return Words(starts, ends, np.searchsorted(starts, offsets))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [starts, ends), eight bytes at a time."""
    value = (ends - starts).astype(_U) * _U(0x9E3779B97F4A7C15)
    if len(starts) == 0:
        return value
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    two = padded[:-1].astype(np.uint16) | padded[1:].astype(np.uint16) << np.uint16(8)
    four = two[:-2].astype(np.uint32) | two[2:].astype(np.uint32) << np.uint32(16)
    eight = four[:-4].astype(_U) | four[4:].astype(_U) << _U(32)
    del padded, two, four
    live, at, left = np.arange(len(starts)), starts, ends - starts
    while True:
        chunk = eight[at] & _MASK[np.minimum(left, 8)]
        if len(live) == len(starts):
            value = mix(value ^ chunk)
        else:
            value[live] = mix(value[live] ^ chunk)
        more = left > 8
        if not more.any():
            return value
        live, at, left = live[more], at[more] + 8, left[more] - 8


def word_hashes(texts: Texts, words: Words) -> np.ndarray:
    return span_hashes(texts.data, words.starts, words.ends)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on; the last n - 1 are left out."""
    count = max(0, len(hashes) - n + 1)
    value = np.zeros(count, _U)
    for i in range(n):
        value = value * _U(0xD6E8FEB86659FD93) + hashes[i : i + count]
    return mix(value)
