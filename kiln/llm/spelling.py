"""Spelling variants by permuterm rotations.

Every word gets a terminator, and all its rotations are sorted.  Words that
differ from ``x c y`` by another letter in place of ``c`` have a rotation
that begins ``y$x`` and one letter more; the word ``x y`` is the rotation
``y$x`` itself.  So a rotation without its last letter (the one skipped) and
a whole rotation meet under one key, and all words that meet there are near
each other: they differ by exactly one inserted, deleted or replaced code
point.  A key's group has at most one word per letter of the alphabet and
one whole rotation, whatever the input; a scan over the sorted keys tells
each of its words how many others there are and which has the largest count,
so no pairs are made.

1. Words are counted (partial counts per task, then a shuffle by word).
2. Distinct words are range-sorted and numbered in code point order; the
   numbered table is written, and the later steps move numbers.
3. Rotations are range-partitioned and sorted by key and scanned.  A word of
   L letters has 2L + 1 entries; keys of over ``LONG_KEY`` letters are
   replaced by 124-bit hashes, so an entry's size is bounded.
4. Links to the chosen form are followed by doubling (counts grow at every
   link, so there are no circles).

Defined results: null and empty texts have no words; a null id counts as an
empty one; a pair that several edits explain (``ab``, ``aab``) counts once;
ties of count go to the word that is smallest in code point order; repeated
rows each count; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm import bytewords, textvec
from kiln.session import materialize, partitions_for

#: The terminator of rotations: not a character, so it occurs in no word.
END = "\uffff"
LONG_KEY = 64

#: Bytes of a rotation entry per byte of a written word, about.
ENTRY_FACTOR = 32

ENTRIES = "key string, no bigint, n bigint, skipped boolean, fresh boolean"
NEAR = "no bigint, near_n bigint, near_no bigint, n_near bigint"


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", typo_every: int | None = None,
                least_length: int = 1, least_count: int = 1) -> DataFrame:
    """(word, n): the distinct runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z
    lower-cased, of ``least_length`` code points or more that occur
    ``least_count`` times or more.

    ``typo_every``: each run whose crc32 of ``<id>:<run>`` is divisible by it
    loses the code point that the crc32 modulo its length points at, so that
    variants with a known origin occur."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in textvec.parts(batches):
            ids = b.column(0).cast(pa.string()).fill_null("").to_pylist()
            heads = np.fromiter((zlib.crc32(f"{i}:".encode()) for i in ids), np.uint32, len(ids))
            for s in bytewords.byte_slices(b.column(1)):
                w = bytewords.cut(s, _letters(s))
                size = np.asarray(pc.utf8_length(w.names)).astype(np.int64)
                number, text = w.number, w.text
                if least_length > 1:
                    keep = np.flatnonzero(size[number] >= least_length)
                    number, text = number[keep], text[keep]
                edited: list[str] = []
                if typo_every:
                    h = joined_crc32(heads[s.first + text], number, w.names)
                    hit = np.flatnonzero(h % np.uint32(typo_every) == 0)
                    for word, k in zip(w.names.take(number[hit]).to_pylist(), h[hit].tolist()):
                        at = k % len(word)
                        edited.append(word[:at] + word[at + 1:])
                    number = np.delete(number, hit)
                n = np.bincount(number, minlength=len(w.names))
                seen = np.flatnonzero(n)
                edited = [e for e in edited if len(e) >= least_length]
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([w.names.take(seen).cast(pa.string()), pa.array(edited, pa.string())]),
                     pa.array(np.concatenate((n[seen], np.ones(len(edited), np.int64))), pa.int64())], ["word", "n"])

    rows = docs.select(F.col(id_col).cast("string"), F.col(text_col)).mapInArrow(run, "word string, n bigint")
    return rows.where("word <> ''").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _letters(s: bytewords.ByteSlice) -> np.ndarray:
    """Bytes of a-z and of U+00C0 to U+00FF (a lead byte C3 and the one after it)."""
    lead = s.data == 0xC3
    inside = ((s.data >= ord("a")) & (s.data <= ord("z"))) | lead
    inside[1:] |= lead[:-1]
    return inside


@lru_cache(maxsize=1)
def _crc_shifts(longest: int = 64) -> np.ndarray:
    """(length, byte place, byte value): what a byte of a crc32 becomes when
    that many bytes follow."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & np.uint32(1), (step >> np.uint32(1)) ^ np.uint32(0xEDB88320), step >> np.uint32(1))
    out = np.empty((longest + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (np.uint32(8) * np.arange(4, dtype=np.uint32)[:, None])
    for k in range(longest):
        out[k + 1] = (out[k] >> np.uint32(8)) ^ step[out[k] & np.uint32(255)]
    return out


def joined_crc32(heads: np.ndarray, number: np.ndarray, names: pa.LargeStringArray) -> np.ndarray:
    """crc32 of a head followed by a word, from the crc32 of each: the head's
    moves on by the word's length, which is linear in its bits."""
    words = [w.encode() for w in names.to_pylist()]
    own = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    size = np.fromiter(map(len, words), np.int64, len(words))
    shifts = _crc_shifts()
    length = size[number]
    short = np.minimum(length, len(shifts) - 1)
    out = own[number]
    for place in range(4):
        out = out ^ shifts[short, place, (heads >> np.uint32(8 * place)) & np.uint32(255)]
    for k in np.flatnonzero(length >= len(shifts)).tolist():
        out[k] = zlib.crc32(words[number[k]], int(heads[k]))
    return out


#: Modulus, bases and weights of the hashes of long keys.
MODULUS = (1 << 31) - 1
LANES = ((1103515245, 12345677, 69069313), (1664525113, 22695477, 134775813),
         (214013277, 1140671485, 1812433253), (1566083941, 1289706101, 630360017))


def entries(word: str) -> Iterator[tuple[str, bool, bool]]:
    """(key, skipped, fresh) of a word: its rotations, and its rotations
    without their last letter; fresh: that letter isn't the one before it."""
    n = len(word)
    if n > LONG_KEY:
        keys, skips = _hashed_keys(word)
        if n - 1 <= LONG_KEY:
            twice = f"{word}{END}" * 2
            skips = [twice[i + 1:i + 1 + n] for i in range(n)]
    else:
        twice = f"{word}{END}" * 2
        keys = [twice[i:i + n + 1] for i in range(n + 1)]
        skips = [twice[i + 1:i + 1 + n] for i in range(n)]
    for key in keys:
        yield key, False, False
    for i, key in enumerate(skips):
        yield key, True, i == 0 or word[i] != word[i - 1]


def _hashed_keys(word: str) -> tuple[list[str], list[str]]:
    """Keys of whole rotations and of those without a letter, as hashes of
    the parts before and after the cut, in time linear in the word."""
    x = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    n, p = len(x), np.uint64(MODULUS)
    place = np.arange(n + 1, dtype=np.uint64)
    whole, skipped = [], []
    for base, head, size in LANES:
        up, down = _mod_powers(base % MODULUS, n + 1), _mod_powers(pow(base, -1, MODULUS), n + 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x * up[:n] % p) % p))   # of the letters before each place
        rest = (sums[n] + p - sums) % p * down % p                                       # of those from each place on
        before = sums * np.uint64(head % MODULUS) % p + place % p * np.uint64(size % MODULUS) % p
        whole.append((before + rest) % p)
        skipped.append((before[:n] + rest[1:]) % p)
    def text(lanes: list[np.ndarray]) -> list[str]:
        return [f"{END}{a:08x}{b:08x}{c:08x}{d:08x}" for a, b, c, d in zip(*(lane.tolist() for lane in lanes))]

    return text(whole), text(skipped)


def _mod_powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have:have + more] = out[:more] * np.uint64(pow(base, have, MODULUS)) % np.uint64(MODULUS)
        have += more
    return out


def _rotations(numbered: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in textvec.parts(batches):
            rows, size = [], 0
            for word, no, n in zip(*(c.to_pylist() for c in b.columns)):
                for key, skipped, fresh in entries(word):
                    rows.append((key, no, n, skipped, fresh))
                    if len(rows) == 50_000:
                        yield _batch(rows)
                        rows = []
            yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                                          ["key", "no", "n", "skipped", "fresh"])

    return numbered.select("word", "no", "n").mapInArrow(run, ENTRIES)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of equal keys in sorted rows; the last group of a batch waits
    for the next batch."""
    waiting = None
    for b in batches:
        if not b.num_rows:
            continue
        table = pa.Table.from_batches([b] if waiting is None else [waiting, b]).combine_chunks()
        keys = table.column("key").combine_chunks()
        new = np.concatenate(([0], np.flatnonzero(np.asarray(pc.not_equal(keys[1:], keys[:-1]))) + 1))
        whole = table.to_batches()[0]
        waiting = whole.slice(int(new[-1]))
        yield _near(whole.slice(0, int(new[-1])), new[:-1])
    if waiting is not None:
        yield _near(waiting, np.zeros(1, np.int64))


def _near(rows: pa.RecordBatch, firsts: np.ndarray) -> pa.RecordBatch:
    """For every row whose group has others: the other with the largest n
    (then the smallest number), and how many near words the group adds."""
    sizes = np.diff(np.append(firsts, rows.num_rows))
    member = np.flatnonzero(np.repeat(sizes > 1, sizes))
    no, n, skipped, fresh = (rows.column(k).to_numpy(zero_copy_only=False)[member] for k in (1, 2, 3, 4))
    sizes = sizes[sizes > 1]
    group = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((no, -n, group))
    at = np.cumsum(sizes) - sizes
    top, second = order[at], order[at + 1] if len(at) else order[at]
    other = np.where(top[group] == np.arange(len(no)), second[group], top[group]) if len(no) else np.zeros(0, np.int64)
    n_skipped = np.bincount(group, skipped, len(sizes)).astype(np.int64)
    n_fresh = np.bincount(group, fresh, len(sizes)).astype(np.int64)
    has_whole = n_skipped < sizes
    count = np.where(skipped, n_skipped[group] - 1 + (has_whole[group] & fresh), n_fresh[group])
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (no, n[other], no[other], count)],
                                      ["no", "near_n", "near_no", "n_near"])


def group_spellings(words: DataFrame, least_ratio: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for a table (word, n) of distinct,
    non-empty words.  ``n_near``: how many words are near; ``form``: the near
    word of largest n, if that is ``least_ratio`` times the word's or more;
    ``root``: where following forms ends."""
    numbered = materialize(
        words.repartitionByRange(partitions_for(words), "word").sortWithinPartitions("word")
        .withColumn("no", F.monotonically_increasing_id()), "words")            # in code point order
    spread = ENTRY_FACTOR * partitions_for(numbered, least=1)
    spread = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), spread if spread > ENTRY_FACTOR else 1)
    near = (_rotations(numbered).repartitionByRange(spread, "key").sortWithinPartitions("key")
            .mapInArrow(_scan, NEAR))
    own = numbered.select("no", F.lit(None).cast("bigint").alias("near_n"), F.lit(None).cast("bigint").alias("near_no"),
                          F.lit(0).cast("bigint").alias("n_near"), "n")
    found = (own.unionByName(near.withColumn("n", F.lit(None).cast("bigint")))
             .groupBy("no").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"),
                                F.min(F.when(F.col("near_no").isNotNull(), F.struct((-F.col("near_n")).alias("less"), "near_no"))).alias("best")))
    is_form = -F.col("best.less") >= least_ratio * F.col("n")
    found = materialize(found.select("no", "n_near", F.when(is_form, F.col("best.near_no")).alias("form_no"),
                                     F.when(is_form, -F.col("best.less")).alias("form_n")), "near")
    roots = _follow(found.where("form_no is not null").select("no", F.col("form_no").alias("root_no")))
    names = numbered.select(F.col("no").alias("_no"), F.col("word").alias("_word"))
    linked = (found.where("form_no is not null").join(roots, "no")
              .join(names.withColumnsRenamed({"_no": "form_no", "_word": "form"}), "form_no")
              .join(names.withColumnsRenamed({"_no": "root_no", "_word": "root"}), "root_no")
              .select("no", "form", "root", "form_n"))
    return (numbered.join(found.select("no", "n_near"), "no").join(linked, "no", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def _follow(links: DataFrame) -> DataFrame:
    """(no, root_no): where chains of links end.  Each round doubles how far
    a row has followed, and is written."""
    links = materialize(links, "links")
    while True:
        on = links.select(F.col("no").alias("root_no"), F.col("root_no").alias("further"))
        step = materialize(links.join(on, "root_no", "left")
                           .select("no", F.coalesce("further", "root_no").alias("root_no"), F.col("further").isNotNull().alias("moved")), "links")
        links = step.select("no", "root_no")
        if step.where("moved").isEmpty():
            return links
