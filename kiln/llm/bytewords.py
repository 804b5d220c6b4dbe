"""Words of an Arrow text column as ranges of its UTF-8 bytes.

All separators are ASCII, so words are cut on bytes without making Python
strings, for many texts at once.  Columns are handled in slices of about
``SLICE_BYTES`` (a longer text forms a slice of its own), so the memory of a
task is set by the slice and the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


@dataclass
class ByteSlice:
    """Consecutive texts of a column, A-Z lower-cased: text d is
    data[offsets[d]:offsets[d + 1]]; ``first`` is the number of text 0."""
    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


def byte_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[ByteSlice]:
    """Cut a text column (null counts as empty) into slices."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield ByteSlice(at, _LOWER[data[offsets[at]:offsets[end]]], offsets[at:end + 1] - offsets[at])
        at = end


def byte_set(chars: str) -> np.ndarray:
    """Membership table of ASCII characters."""
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


@dataclass
class ByteWords:
    """Words in text order: byte ranges of the slice, text numbers, and the
    words themselves as numbers into ``names``, the slice's distinct words."""
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    number: np.ndarray
    names: pa.LargeStringArray


def cut(s: ByteSlice, inside: np.ndarray) -> ByteWords:
    """The maximal runs of ``inside`` bytes within each text."""
    full = np.flatnonzero(np.diff(s.offsets))
    before, after = np.ones(len(inside), bool), np.ones(len(inside), bool)
    before[1:] = ~inside[:-1]
    after[:-1] = ~inside[1:]
    before[s.offsets[full]] = True
    after[s.offsets[full + 1] - 1] = True
    starts, ends = np.flatnonzero(inside & before), np.flatnonzero(inside & after) + 1
    places = np.concatenate(([0], np.cumsum(ends - starts)))
    words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(s.data[inside])])
    coded = words.dictionary_encode()
    return ByteWords(starts, ends, np.searchsorted(s.offsets, starts, "right") - 1,
                     np.asarray(coded.indices).astype(np.int64), coded.dictionary)
