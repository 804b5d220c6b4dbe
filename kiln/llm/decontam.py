"""Benchmark decontamination: rare n-gram seeds join documents to benchmark
items, Smith-Waterman alignment of the words around the seeds scores exact,
edited and paraphrased copies.

1. The documents that hold each n-gram of the benchmark are counted over the
   whole corpus (one scan; a task sends at most one count per n-gram).
2. An n-gram is a seed if at most ``rare_share`` of the documents hold it and
   it brings a document ``CANDIDATES`` items or fewer on average.  A more common
   one is a seed only of items whose n-grams that are about as common (half its
   share or more) cover the words that a leak needs: then copies of the item
   may be that common, however many they are.  A phrase that many texts and
   items share covers less, and is none.
3. A second scan looks the seeds up in each document; where a rare one hits,
   or two common ones on near diagonals, and the words around hold enough of the item's to reach the score, the item is
   aligned with the surrounding words (+1 a match, ``-gap`` a change,
   insertion or deletion).  The score is the best local alignment's value per
   word of the item, 1 for a verbatim copy; a long passage of a longer item is
   a leak by its own length.

The benchmark is the stated query set: it is taken in blocks of about
``BLOCK_CHARS`` characters, each broadcast and held against all documents.
Texts aren't shuffled.

Defined results: null, empty and wordless texts and items match nothing;
items of fewer words than a seed match only texts of just these words; equal items are all
reported; of several copies in one document the best (then the first) is
reported; repeated rows each get their result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm import textvec

BLOCK_CHARS = 20_000_000

#: A leak scores ``LEAST_SCORE`` per word of the item or more, and
#: ``LEAST_WORDS`` in all or the whole of a shorter item; or it is worth
#: ``LONG_WORDS``, which clean texts don't share, of an item of any length.
SEED_WORDS, RARE_SHARE, GAP, LEAST_SCORE, LEAST_WORDS, LONG_WORDS = 3, 0.001, 0.5, 0.4, 8, 30

#: Items that a rare n-gram may bring to a document on average.
CANDIDATES = 4

LEAKS = "doc_id bigint, item_id bigint, score double, start bigint, end bigint"


@dataclass
class Items:
    """A block of benchmark items: word hashes of item k are
    ``words[first[k]:first[k + 1]]``; gram g starts at word ``at[g]``."""
    ids: list
    words: np.ndarray
    first: np.ndarray
    grams: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, ids: list, texts: list[str | None], seed_words: int) -> Items:
        hashes, grams, at, counts, n = [], [], [], [], 0
        for s in textvec.slices(texts):
            w = textvec.words(s)
            g, a = textvec.ngrams(w, seed_words)
            hashes.append(w.hashes)
            grams.append(g)
            at.append(a + n)
            counts.append(w.counts)
            n += len(w.hashes)
        empty = [np.zeros(0, np.uint64)]
        return cls(ids, np.concatenate(hashes or empty), np.concatenate(([0], np.cumsum(np.concatenate(counts or [[]])))).astype(np.int64),
                   np.concatenate(grams or empty), np.concatenate(at or [np.zeros(0, np.int64)]))


class Lookup:
    """Positions of hashes in a sorted set, most misses told by a bitmap."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self.mask = np.uint64((1 << max(16, int(len(self.keys) * 16).bit_length())) - 1)
        self.bits = np.zeros(int(self.mask) + 1, bool)
        self.bits[(self.keys & self.mask).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which hashes are keys, which key)."""
        maybe = np.flatnonzero(self.bits[(hashes & self.mask).astype(np.int64)])
        if not len(self.keys):
            return maybe[:0], maybe[:0]
        k = np.minimum(np.searchsorted(self.keys, hashes[maybe]), len(self.keys) - 1)
        hit = self.keys[k] == hashes[maybe]
        return maybe[hit], k[hit]


def gram_shares(docs: DataFrame, grams: np.ndarray, seed_words: int, text_col: str = "text") -> dict[int, float]:
    """Share of the documents that hold each of the n-grams, over the whole corpus."""
    shared = docs.sparkSession.sparkContext.broadcast(Lookup(grams))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = shared.value
        n = np.zeros(len(look.keys) + 1, np.int64)             # the last one counts documents
        for b in textvec.parts(batches):
            n[-1] += b.num_rows
            for s in textvec.slices(b.column(0).to_pylist()):
                w = textvec.words(s)
                g, at = textvec.ngrams(w, seed_words)
                which, key = look.find(g)
                once = np.unique(w.text[at[which]] * np.int64(len(n)) + key)
                np.add.at(n, once % len(n), 1)
        k = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(n[k])], ["gram", "n"])

    rows = docs.select(text_col).mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    n, keys = {r["gram"]: r["n"] for r in rows}, np.unique(grams)
    whole = n.pop(len(keys), 1)
    return {int(keys[k]): v / whole for k, v in n.items()}


def least_value(words: int, least_score: float, least_words: int, long_words: int) -> float:
    """Alignment value from which an item of so many words is leaked."""
    return min(max(least_score * words, min(least_words, words)), long_words)


def choose_seeds(items: Items, shares: dict[int, float], rare_share: float, seed_words: int = SEED_WORDS, least_score: float = LEAST_SCORE,
                 least_words: int = LEAST_WORDS, long_words: int = LONG_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(gram numbers of the seeds of each item, whether they are rare), among
    the n-grams that occur.  Items of the same words count once."""
    share = np.array([shares.get(int(g), 0.0) for g in items.grams])
    if not len(share):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    item = np.searchsorted(items.first, items.at, "right") - 1
    _, kind = np.unique([items.words[a:z].tobytes() for a, z in zip(items.first, items.first[1:])], return_inverse=True)
    _, gram = np.unique(items.grams, return_inverse=True)
    pairs = np.unique(np.stack([gram, kind[item]]), axis=1)
    brings = share * np.bincount(pairs[0])[gram]
    rare = (share > 0) & (share <= rare_share) & (brings <= CANDIDATES)
    seed = rare.copy()
    others = np.flatnonzero((share > 0) & ~rare)
    owners, cut = np.unique(item[others], return_index=True)
    for k, own in zip(owners, np.split(others, cut[1:])):
        words = int(items.first[k + 1] - items.first[k])
        need = least_value(words, least_score, least_words, long_words)
        every = np.arange(*np.searchsorted(item, [k, k + 1]))
        every = every[share[every] > 0]
        for level in np.unique(share[own]):
            covered = np.zeros(words + seed_words, bool)
            for at in (items.at[every[share[every] >= level / 2]] - items.first[k]).tolist():
                covered[at:at + seed_words] = True
            if covered[:words].sum() >= need:
                seed[own[share[own] == level]] = True
    seeds = np.flatnonzero(seed)
    return seeds, rare[seeds]


def align(item: np.ndarray, words: np.ndarray, gap: float) -> tuple[float, int, int]:
    """Best local alignment value and where it ends (item words, words), row
    by row; a run of insertions is a running maximum."""
    step = np.arange(len(words) + 1) * gap
    row = np.zeros(len(words) + 1)
    best = (0.0, 0, 0)
    for i, w in enumerate(item, 1):
        new = np.zeros_like(row)
        new[1:] = np.maximum(0, row[:-1] + np.where(words == w, 1.0, -gap))
        new = np.maximum(new, row - gap)
        row = np.maximum.accumulate(new + step) - step
        j = int(row.argmax())
        if row[j] > best[0]:
            best = (float(row[j]), i, j)
    return best


class Matcher:
    """Finds the leaks of a block of items in texts."""

    def __init__(self, items: Items, seeds: np.ndarray, rare: np.ndarray, seed_words: int, gap: float, least_score: float, least_words: int,
                 long_words: int):
        self.items, self.seed_words, self.gap = items, seed_words, gap
        self.least_score, self.least_words, self.long_words = least_score, least_words, long_words
        self.look = Lookup(items.grams[seeds])
        key = np.searchsorted(self.look.keys, items.grams[seeds])
        order = np.argsort(key, kind="stable")
        self.word = items.at[seeds][order]                    # item words of key k: word[first[k]:first[k + 1]]
        self.item = np.searchsorted(items.first, self.word, "right") - 1
        # an item with a single n-gram can't have two
        self.rare = rare[order] | (np.diff(items.first)[self.item] <= seed_words)
        self.first = np.searchsorted(key[order], np.arange(len(self.look.keys) + 1))

    def leaks(self, texts: list[str | None]) -> list[tuple[int, int, float, int, int]]:
        """(text number, item number, score, start, end), in order."""
        out = []
        for s in textvec.slices(texts):
            w = textvec.words(s)
            g, at = textvec.ngrams(w, self.seed_words)
            which, key = self.look.find(g)
            d, item, diagonal, rare = self.hits(w.text[at[which]], at[which], key)
            cut = np.flatnonzero(np.diff(d, prepend=-1) | np.diff(item, prepend=-1))
            for a, z in zip(cut.tolist(), [*cut[1:].tolist(), len(d)]):
                own = diagonal[a:z]
                if not rare[a:z].any() and not (np.diff(own) <= self.pad(int(item[a]))).any():
                    continue
                text = int(d[a])
                if leak := self.best(w, text, int(item[a]), np.unique(own).tolist()):
                    score, begin, end = leak
                    out.append((s.first + text, int(item[a]), score, int(w.starts[begin] - s.starts[text]), int(w.ends[end - 1] - s.starts[text])))
        return out

    def hits(self, text: np.ndarray, at: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, ...]:
        """(text, item, diagonal, whether the seed is rare) of every place of
        an item that a seed found, ordered by text, item and diagonal."""
        n = self.first[key + 1] - self.first[key]
        which = np.repeat(np.arange(len(key)), n)
        place = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[key], n)
        item = self.item[place]
        diagonal = at[which] - (self.word[place] - self.items.first[item])
        order = np.lexsort((diagonal, item, text[which]))
        return text[which][order], item[order], diagonal[order], self.rare[place][order]

    def pad(self, item: int) -> int:
        """How far a copy may be off its diagonal."""
        return int(self.items.first[item + 1] - self.items.first[item]) // 4 + 2

    def best(self, w: textvec.Words, d: int, item: int, diagonals: list[int]) -> tuple[float, int, int] | None:
        """Best alignment of an item near the diagonals: (score, word range)."""
        own = self.items.words[self.items.first[item]:self.items.first[item + 1]]
        m, pad = len(own), self.pad(item)
        low, high = int(w.firsts[d]), int(w.firsts[d] + w.counts[d])
        regions: list[list[int]] = []
        for x in diagonals:
            begin, end = max(low, x - pad), min(high, x + m + pad)
            if regions and begin <= regions[-1][1]:
                regions[-1][1] = max(end, regions[-1][1])
            else:
                regions.append([begin, end])
        least = least_value(m, self.least_score, self.least_words, self.long_words)
        top, where = 0.0, None
        for begin, end in regions:
            if np.isin(own, w.hashes[begin:end]).sum() < max(least, top):      # no alignment can reach it
                continue
            value, i, j = align(own, w.hashes[begin:end], self.gap)
            if value > top:
                top, where = value, (begin, i, j)
            if top == m:
                break
        if where is None or top < least:
            return None
        begin, i, j = where                                   # backwards from its end for where it begins
        _, _, back = align(own[:i][::-1], w.hashes[begin:begin + j][::-1], self.gap)
        return top / m, begin + j - back, begin + j


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[tuple[list, list[str]]]:
    """The benchmark in blocks of bounded size."""
    items = benchmark.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).where("text is not null")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-size // BLOCK_CHARS)
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("text", "id"), F.lit(n)) == k).orderBy("id", "text").collect()
        yield [r["id"] for r in rows], [r["text"] for r in rows]


def _matchers(docs: DataFrame, benchmark: DataFrame, item_col: str, text_col: str, seed_words: int, rare_share: float, gap: float,
              least_score: float, least_words: int, long_words: int):
    for ids, texts in _blocks(benchmark, item_col, text_col):
        items = Items.of(ids, texts, seed_words)
        shares = gram_shares(docs, items.grams, seed_words, text_col)
        seeds, rare = choose_seeds(items, shares, rare_share, seed_words, least_score, least_words, long_words)
        yield docs.sparkSession.sparkContext.broadcast(Matcher(items, seeds, rare, seed_words, gap, least_score, least_words, long_words))


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text",
               seed_words: int = SEED_WORDS, rare_share: float = RARE_SHARE, gap: float = GAP, least_score: float = LEAST_SCORE,
               least_words: int = LEAST_WORDS, long_words: int = LONG_WORDS) -> DataFrame:
    """(doc_id, item_id, score, start, end): every document with a copy of an
    item, its score and its span (code points, end exclusive)."""
    out = None
    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))

    for shared in _matchers(docs, benchmark, item_col, text_col, seed_words, rare_share, gap, least_score, least_words,
                            long_words):
        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            m = shared.value
            for b in textvec.parts(batches):
                ids = b.column(0).to_pylist()
                rows = [(ids[d], m.items.ids[i], score, start, end) for d, i, score, start, end in m.leaks(b.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], pa.float64() if k == 2 else pa.int64()) for k in range(5)],
                    ["doc_id", "item_id", "score", "start", "end"])

        leaks = narrow.mapInArrow(run, LEAKS)
        out = out.unionByName(leaks) if out else leaks
    return out or docs.sparkSession.createDataFrame([], LEAKS)


def remove_leaks(docs: DataFrame, benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text",
                 seed_words: int = SEED_WORDS, rare_share: float = RARE_SHARE, gap: float = GAP, least_score: float = LEAST_SCORE,
                 least_words: int = LEAST_WORDS, long_words: int = LONG_WORDS) -> DataFrame:
    """The documents without a copy of an item, all columns, in the task that reads them."""
    at, out = docs.columns.index(text_col), docs
    for shared in _matchers(docs, benchmark, item_col, text_col, seed_words, rare_share, gap, least_score, least_words,
                            long_words):
        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in textvec.parts(batches):
                keep = np.ones(b.num_rows, bool)
                keep[[leak[0] for leak in shared.value.leaks(b.column(at).to_pylist())]] = False
                yield b.filter(pa.array(keep))

        out = out.mapInArrow(run, docs.schema)
    return out
