"""Phrase collocations by dynamic itemset counting.

The corpus is dealt into shards, written once, and scanned in a cycle, one
shard a stop.  Words are counted from the first stop on.  A longer phrase is
counted from the stop after the one at which both its subphrases (without its
last word, without its first) had reached the threshold, through one full
cycle; so phrases of all lengths are counted side by side, and few are counted
that can't be frequent.  A phrase that occurs often enough has subphrases that
do, so it is activated at the latest when their cycles end, and its count is
exact.

*When* a phrase reached the threshold is held in a table of ``1 << bits`` bytes
per length, by hash: a size set by parameters, whatever the vocabulary, and it
is all that the driver gathers and (compressed) broadcasts.  A place of the table belongs to
the first phrase that reaches the threshold there and isn't changed again, so
phrases that share one are at most counted earlier than needed, always through
a full cycle.  Counts are keyed by the phrases themselves: each stop groups the
open counts with the shard's (partial counts per task) and writes them; those
that end below the threshold are dropped.

Definitions: texts are lower-cased (A-Z), cut at ``. , ; : ! ?`` and U+000A to
U+000D into pieces, and those at blanks and tabs into words.  Everything is
per language; a null language is ``und``.  A null or empty text has no words;
repeated rows each count; ids aren't used; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kiln.llm import bytewords, textvec
from kiln.operators.joins import join_on, join_small
from kiln.session import materialize, scratch_path

BREAKS, BLANKS = ".,;:!?\n\x0b\x0c\r", " \t"
NEVER = 255
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
COUNTS = "size tinyint, lang string, phrase string, since smallint, n bigint"


def word_hashes(names: pa.LargeStringArray) -> np.ndarray:
    """64-bit hashes of non-empty words."""
    if not len(names):
        return np.zeros(0, np.uint64)
    _, offsets, data = names.buffers()
    offsets = np.frombuffer(offsets, np.int64)[names.offset:names.offset + len(names) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]
    up, down = textvec.powers(textvec.BASE, len(data))
    firsts = offsets[:-1] - offsets[0]
    return textvec.mix(np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], firsts) * down[firsts])


def lang_hashes(langs: list[str]) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "big") for name in langs], np.uint64)


def longer(first: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Hash of a phrase from those of its part without the last word and of its last word."""
    return textvec.mix(first * np.uint64(textvec.BASE) + rest)


def places(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def count_slice(s: bytewords.ByteSlice, lang_of: np.ndarray, langs: pa.Array, lang_hash: np.ndarray,
                tables: list[np.ndarray], bits: int, stop: int, shards: int) -> Iterator[pa.RecordBatch]:
    """Counts of the phrases that are active at a stop, in one slice.
    ``lang_of``: language number of each text; ``tables[k]``: stops at which
    phrases of k + 1 words reached the threshold."""
    breaks = bytewords.byte_set(BREAKS)[s.data]
    w = bytewords.cut(s, ~(breaks | bytewords.byte_set(BLANKS)[s.data]))
    if not len(w.number):
        return
    lang = lang_of[w.text]
    piece = np.cumsum(breaks)[w.starts]
    linked = (piece[1:] == piece[:-1]) & (w.text[1:] == w.text[:-1])
    words = textvec.mix(word_hashes(w.names)[w.number] + lang_hash[lang])

    def batch(size: int, at: np.ndarray, since: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        parts = [w.names.take(w.number[at + k]) for k in range(size)]
        phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if size > 1 else parts[0]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), size, np.int8)), langs.take(lang[at]).cast(pa.string()), phrase.cast(pa.string()),
             pa.array(since.astype(np.int16)), pa.array(n, pa.int64())], ["size", "lang", "phrase", "since", "n"])

    if stop < shards:                                       # words, and how many there are
        n = np.bincount(lang, minlength=len(langs))
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.zeros(len(seen), np.int8)), langs.take(seen).cast(pa.string()), pa.array([""] * len(seen), pa.string()),
             pa.array(np.full(len(seen), -1, np.int16)), pa.array(n[seen], pa.int64())], ["size", "lang", "phrase", "since", "n"])
        first, n = _distinct(w.number, lang, np.arange(len(lang)), 1, len(w.names))
        yield batch(1, first, np.full(len(first), -1), n)
    h, whole = words, np.ones(len(words), bool)             # of the phrases that begin at each word
    for size, table in enumerate(tables, 2):
        if len(h) < 2:
            return
        reached = table[places(h, bits)].astype(np.int16)
        since = np.maximum(reached[:-1], reached[1:])
        whole = whole[:-1] & linked[size - 2:]
        at = np.flatnonzero(whole & (since < stop) & (stop <= since + shards))
        if len(at):
            first, n = _distinct(w.number, lang, at, size, len(w.names))
            yield batch(size, first, since[first], n)
        h = longer(h[:-1], words[size - 1:])


def _distinct(number: np.ndarray, lang: np.ndarray, at: np.ndarray, size: int, n_names: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, count) of the distinct (language, ``size`` words) at the places."""
    key, bound = lang[at].astype(np.int64), int(lang.max()) + 1
    for k in range(size):
        if bound * n_names >= 1 << 62:
            found, key = np.unique(key, return_inverse=True)
            bound = len(found)
        key = key * n_names + number[at + k]
        bound *= n_names
    _, first, n = np.unique(key, return_index=True, return_counts=True)
    return at[first], n


def phrase_places(langs: pa.Array, phrases: pa.Array, bits: int) -> np.ndarray:
    """Table places of phrases of any length, as ``count_slice`` has them."""
    rows = pc.split_pattern(phrases.cast(pa.large_string()), " ")
    sizes = np.diff(np.asarray(rows.offsets))
    coded, first = langs.dictionary_encode(), np.asarray(rows.offsets)[:-1]
    words = textvec.mix(word_hashes(rows.values) + np.repeat(lang_hashes(coded.dictionary.to_pylist())[np.asarray(coded.indices)], sizes))
    h = words[first]
    for k in range(1, int(sizes.max(initial=0))):
        more = np.flatnonzero(sizes > k)
        h[more] = longer(h[more], words[first[more] + k])
    return places(h, bits)


def count_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 3, least: int = 10,
                  shards: int = 4, bits: int = 24) -> DataFrame:
    """(size, lang, phrase, n): the exact counts of all phrases of 1 to
    ``max_words`` words with ``least`` occurrences or more in a language, and
    per language a row of size 0 with the number of its words.  Words of a
    phrase are joined by a blank."""
    if shards * max_words >= NEVER:
        raise ValueError(f"shards * max_words must be below {NEVER}")
    spark = docs.sparkSession
    path = scratch_path(spark, "shards")
    (docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"),
                 F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int").alias("shard"))
     .where("text is not null").write.option("compression", "zstd").partitionBy("shard").parquet(path))
    corpus = spark.read.schema("lang string, text string, shard int").parquet(path)

    tables = [np.full(1 << bits, NEVER, np.uint8) for _ in range(max_words - 1)]
    still_open, closed = None, []
    stop, last_reached = 0, -1
    while True:
        shared = spark.sparkContext.broadcast([zlib.compress(t, 1) for t in tables])
        counts = corpus.where(F.col("shard") == stop % shards).select("lang", "text").mapInArrow(_counter(shared, bits, stop, shards), COUNTS)
        counts = counts.withColumn("fresh", F.col("n"))
        if still_open is not None:
            counts = counts.unionByName(still_open.withColumn("fresh", F.lit(0).cast("bigint")))
        ended = F.col("since") + shards <= stop
        merged = _written(
            counts.groupBy("size", "lang", "phrase").agg(F.min("since").alias("since"), F.sum("n").alias("n"), F.sum("fresh").alias("fresh"))
            .where(~ended | (F.col("n") >= least) | (F.col("size") == 0)))
        shared.destroy()                                    # the counts are written
        if _note_reached(merged.where((F.col("n") >= least) & (F.col("n") - F.col("fresh") < least)), tables, bits, stop):
            last_reached = stop
        still_open = merged.where(~ended).drop("fresh")
        closed.append(merged.where(ended).select("size", "lang", "phrase", "n"))
        if stop >= shards - 1 and stop >= last_reached + shards:
            break
        stop += 1
    out = closed[0]
    for more in closed[1:]:
        out = out.unionByName(more)
    return _written(out)


@contextmanager
def _shuffles_cleaned(spark: SparkSession):
    """What runs inside gives its shuffle files back at its end: a written
    table doesn't need them, and stops would pile them up."""
    old = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, old)


def _written(df: DataFrame) -> DataFrame:
    """Written in the shared folder, packed tighter than by default: a stop's
    counts are read once or twice."""
    path = scratch_path(df.sparkSession, "phrases")
    with _shuffles_cleaned(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def _counter(shared, bits: int, stop: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.frombuffer(zlib.decompress(t), np.uint8) for t in shared.value]
        for b in batches:
            coded = b.column(0).dictionary_encode()
            lang_of, langs = np.asarray(coded.indices).astype(np.int64), coded.dictionary
            lang_hash = lang_hashes(langs.to_pylist())
            for s in bytewords.byte_slices(b.column(1)):
                yield from count_slice(s, lang_of[s.first:s.first + s.n], langs, lang_hash, tables, bits, stop, shards)
        pa.default_memory_pool().release_unused()

    return run


def _note_reached(reached: DataFrame, tables: list[np.ndarray], bits: int, stop: int) -> bool:
    """Enter the stop in the places of phrases that have reached the
    threshold; whether any place was new."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(phrase_places(b.column(1), b.column(2), bits), pa.int32())], ["size", "place"])

    rows = (reached.where(F.col("size").between(1, len(tables))).select("size", "lang", "phrase")
            .mapInArrow(run, "size tinyint, place int").distinct().toArrow())
    size, place = (np.asarray(rows.column(k).combine_chunks()) for k in (0, 1))
    new = False
    for k, table in enumerate(tables, 1):
        at = place[size == k]
        at = at[table[at] == NEVER]
        table[at] = stop
        new |= bool(len(at))
    return new


def _joined(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(counts: DataFrame, max_words: int = 3, least: int = 10, cover_percent: int = 50, top: int = 2000,
                 scale: int = 1_000_000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases
    of two words or more by score, then count, then the phrase.

    Cutting a phrase of count a into parts of counts l and r gives
    floor(scale * a * a / (l * r)); the lowest cut counts, then the first.  The
    arithmetic is in whole decimals of 38 digits, exact for counts below
    10^15, and fails beyond.  Phrases inside a longer one that has
    ``cover_percent`` or more of their count are dropped, whether or not the
    longer one is."""
    phrases = counts.where(F.col("size") >= 1).select("lang", "phrase", "size", "n")
    whole = phrases.where((F.col("size") >= 2) & (F.col("n") >= least)).withColumn("words", F.split("phrase", " "))
    cuts = (whole.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size").cast("int") - 1)))
            .select("lang", "phrase", F.col("n").alias("a"), "k", _joined(F.col("words"), F.lit(1), F.col("k")).alias("head"),
                    _joined(F.col("words"), F.col("k") + 1, F.col("size").cast("int")).alias("rest")))
    parts = phrases.where(F.col("size") < max_words)
    cuts = join_small(cuts, parts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l")), ["lang", "head"])
    cuts = join_small(cuts, parts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    for name in ("a", "l", "r"):
        cuts = cuts.withColumn(f"{name}_", F.col(name).cast("decimal(16,0)"))
    cuts = cuts.withColumn("score", F.expr(f"cast({scale} as decimal(7,0)) * a_ * a_ div (l_ * r_)"))
    scored = (cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.max("a").alias("a"))
              .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))

    inner = (whole.where("size > 2")
             .withColumn("length", F.explode(F.sequence(F.lit(2), F.col("size").cast("int") - 1)))
             .withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size").cast("int") - F.col("length") + 1)))
             .groupBy("lang", _joined(F.col("words"), F.col("at"), F.col("length")).alias("phrase")).agg(F.max("n").alias("cover")))
    kept = join_on(scored, inner, ["lang", "phrase"], "left").where(
        F.col("cover").isNull() | (100 * F.col("cover") < cover_percent * F.col("a"))).drop("cover")
    kept = materialize(kept, "scored")

    # the best of each part first, so that no task ranks a whole language
    parts_of_lang = max(1, int((kept.count() / top) ** 0.5))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = (kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts_of_lang)))
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top))
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    totals = counts.where(F.col("size") == 0).select("lang", F.col("n").alias("total"))
    return join_small(ranked, totals, ["lang"]).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"),
        F.col("score").cast("bigint").alias("score"))
