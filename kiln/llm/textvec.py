"""Texts of an Arrow batch as numpy arrays: code points, words, word hashes
and word n-grams, all computed for many documents at once.

A *word* is a maximal run of letters or digits, lower-cased.  Hashes are 64
bit, the same in every task and run.  Texts are handled in slices of about
``SLICE_CHARS`` code points (a longer text forms a slice of its own), so the
memory of a task is set by the slice and the longest text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_CHARS = 500_000
PART_ROWS = 1000
CODE_POINTS = 0x110000

# Odd multipliers of the polynomial hashes, and of the splitmix64 finaliser.
BASE = 0x9E3779B97F4A7C15 | 1
SEQ_BASES = (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h *= MIX_1
    h ^= h >> np.uint64(27)
    h *= MIX_2
    h ^= h >> np.uint64(31)
    return h


@lru_cache(maxsize=1)
def char_tables() -> tuple[np.ndarray, np.ndarray]:
    """(lower, letter): per code point the lower-cased code point of a letter
    or digit (0 for anything else), and whether it is a letter.  A letter
    whose lower case is several code points stands for itself."""
    lower = np.zeros(CODE_POINTS, np.uint32)
    letter = np.zeros(CODE_POINTS, bool)
    for cp in range(0x323B0):                       # no letters above the third ideographic plane
        c = chr(cp)
        if c.isalnum():
            low = c.lower()
            lower[cp] = ord(low) if len(low) == 1 else cp
            letter[cp] = c.isalpha()
    return lower, letter


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, base, np.uint64)
    down = np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse modulo 2**64, at least n of each."""
    return _powers(base, max(1 << 19, 1 << (n - 1).bit_length()))


def parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of ``PART_ROWS``, so that only as many texts are
    Python strings at a time.  Arrow's spare memory is given back at the end:
    a worker may idle for long between tasks."""
    for b in batches:
        for at in range(0, b.num_rows, PART_ROWS):
            yield b.slice(at, PART_ROWS)
    pa.default_memory_pool().release_unused()


@dataclass
class Slice:
    """Consecutive texts of a batch: ``codes`` are their code points with a
    line feed after each; text d is codes[starts[d]:starts[d] + lengths[d]]."""
    first: int
    texts: list[str]
    codes: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray

    @property
    def n(self) -> int:
        return len(self.texts)


def slices(texts: list[str | None], limit: int = SLICE_CHARS) -> Iterator[Slice]:
    """Cut a batch of texts (null counts as empty) into slices."""
    texts = [t or "" for t in texts]
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) < limit):
            size += len(texts[end]) + 1
            end += 1
        part = texts[at:end]
        lengths = np.fromiter(map(len, part), np.int64, len(part))
        codes = np.frombuffer(("\n".join(part) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
        yield Slice(at, part, codes, starts, lengths)
        at = end


@dataclass
class Words:
    """Words of a slice in text order: code point offsets in the slice, hash,
    text number; ``counts`` and ``firsts`` are per text."""
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    text: np.ndarray
    counts: np.ndarray
    firsts: np.ndarray


def words(s: Slice) -> Words:
    lower, _ = char_tables()
    x = lower[s.codes]
    inside = x != 0
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]           # the slice ends with a line feed
    if len(starts):
        up, down = powers(BASE, len(x))
        h = mix(np.add.reduceat(x * up[:len(x)], starts) * down[starts])
    else:
        h = np.zeros(0, np.uint64)
    text = np.searchsorted(s.starts, starts, "right") - 1
    counts = np.bincount(text, minlength=s.n)
    firsts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    return Words(starts, ends, h, text, counts, firsts)


def ngrams(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of every n-word shingle, in text order.  A text of
    1 to n - 1 words has one shingle, all its words; one without words has
    none."""
    h, count = w.hashes, len(w.hashes)
    out, at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if count >= n:
        g = np.zeros(count - n + 1, np.uint64)
        for k in range(n):
            g *= np.uint64(BASE)
            g += h[k:count - n + 1 + k]
        at = np.flatnonzero(w.text[:count - n + 1] == w.text[n - 1:])
        out = mix(g[at])
    short = np.flatnonzero((w.counts > 0) & (w.counts < n))
    if len(short):
        extra = []
        for d in short:
            v = 0
            for k in range(w.firsts[d], w.firsts[d] + w.counts[d]):
                v = (v * BASE + int(h[k])) % (1 << 64)
            extra.append(v)
        out = np.concatenate((out, mix(np.array(extra, np.uint64))))
        at = np.concatenate((at, w.firsts[short]))
        order = np.argsort(at, kind="stable")
        out, at = out[order], at[order]
    return out, at


def sequence_keys(w: Words) -> np.ndarray:
    """128-bit key of each text's word sequence, as (texts, 2) uint64: texts
    with the same words in the same order get the same key."""
    keys = np.zeros((len(w.counts), 2), np.uint64)
    full = np.flatnonzero(w.counts)
    if len(full):
        firsts = w.firsts[full]
        for lane, base in enumerate(SEQ_BASES):
            up, down = powers(base, len(w.hashes))
            keys[full, lane] = mix(np.add.reduceat(w.hashes * up[:len(w.hashes)], firsts) * down[firsts]
                                   + w.counts[full].astype(np.uint64))
    return keys


def minhash(hashes: np.ndarray, firsts: np.ndarray, n_perm: int, seed: int) -> np.ndarray:
    """(sets, n_perm) uint32 signatures: the minimum over each set of the
    multiply-add hashes a*x + b (mod 2**32), one (a, b) per permutation.
    Sets are the runs of ``hashes`` that begin at ``firsts`` (none empty)."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 31, n_perm, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    b = rng.integers(0, 1 << 32, n_perm, dtype=np.uint32)
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    sig = np.empty((len(firsts), n_perm), np.uint32)
    if len(firsts):
        y = np.empty_like(x)
        for j in range(n_perm):
            np.multiply(x, a[j], out=y)
            y += b[j]
            sig[:, j] = np.minimum.reduceat(y, firsts)
    return sig


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(sets, bands) uint64: one hash per band of ``rows`` signature values."""
    out = np.empty((len(sig), bands), np.uint64)
    for band in range(bands):
        h = np.full(len(sig), band + 1, np.uint64)
        for k in range(band * rows, band * rows + rows):
            h *= np.uint64(BASE)
            h += sig[:, k]
        out[:, band] = mix(h)
    return out


def choose_bands(threshold: float, recall: float, rows_at_least: int = 1, most: int = 512) -> tuple[int, int]:
    """(bands, rows) with the most rows per band (fewest chance candidates)
    such that a pair at ``threshold`` shares a band with probability
    ``recall`` or more and bands * rows <= ``most``."""
    best = None
    for rows in range(rows_at_least, most + 1):
        p = threshold ** rows
        bands = int(np.ceil(np.log1p(-recall) / np.log1p(-p))) if p < 1 else 1
        if bands * rows <= most:
            best = (bands, rows)
    if best is None:
        raise ValueError(f"no banding of {most} permutations reaches recall {recall} at {threshold}")
    return best
