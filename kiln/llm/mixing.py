"""Mixing sources to target weights, in DataFrame operations only.

1. *Pack*: the documents of a source, in a fixed pseudorandom order, form one
   stream of words, cut into blocks of ``block_words``.
2. *Targets*: sources share a total by weight; no target is above
   ``most_repeats`` times its source's size, the excess goes to the others.
3. *Draw*: the mix is a sequence of slots dealt to output shards.  Each slot
   draws a source with the targets' probabilities, which gives every shard
   multinomial source counts.  So that the mix meets its targets, draws of a
   source beyond its quota are handed to sources that stayed short.
4. *Map*: the n-th slot of a source goes through a pseudorandom permutation of
   the source's block numbers, another one each time all blocks were taken.
5. *Join*: slots meet blocks by (source, block number).

A third of all rows may be of one source: positions in a source are counted
in about sqrt(rows) chunks and then over the chunks' sums, slots are counted
per shard and then over the shards' sums, and the joins are on block numbers.

Defined results: null text has no words; documents without words are in no
block and are taken 0 times; the null source is a source, the last in order;
without any words all targets are 0; repeated rows are separate documents;
extra columns are kept by ``mixed_documents`` and ignored by ``mix``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.session import materialize

WORD, SPACED_WORD = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"
WEIGHTS, MOST_REPEATS, BLOCK_WORDS, SHARD_SLOTS, SEED = (5, 2, 1), 3, 128, 1024, 1

#: Intervals of [0, 1) that source shares are looked up by.
BINS = 1024


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def row_key(id_col: str, source_col: str, text_col: str) -> Column:
    """Equal for repeated rows only."""
    return F.concat(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")), F.lit(":"),
                    F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"),
                    F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit("")))


# -- pseudorandom permutations ----------------------------------------------

def permute(df: DataFrame, out: str, i: Column, n: Column, *key: Column, back: bool = False) -> DataFrame:
    """Adds ``out``: where a pseudorandom permutation of 0 to n - 1, one per
    ``key``, sends i (with ``back``: what it sends to i).

    Four rounds of an unbalanced Feistel network permute the least grid of
    a x b >= n places with a about sqrt(n).  It is repeated while the value is
    n or more: such places number fewer than a, so a repeats are enough.  The
    grid and the first value are columns of their own, so that expressions
    stay small.
    """
    a, b, once = F.col("_a"), F.col("_b"), F.col("_once")

    def turn(x: Column, by: Column, size: Column, k: int) -> Column:
        return F.pmod(x + (-1 if back else 1) * F.pmod(F.xxhash64(F.lit(k), by, *key), size), size)

    def step(x: Column) -> Column:
        left, right = F.pmod(x, a), F.floor(x / a)
        for k in reversed(range(4)) if back else range(4):
            if k % 2 == 0:
                left = turn(left, right, a, k)
            else:
                right = turn(right, left, b, k)
        return right * a + left

    walk = F.aggregate(F.sequence(F.lit(1).cast("bigint"), a), once, lambda x, _: F.when(x < n, x).otherwise(step(x)))
    return (df.withColumn("_a", F.ceil(F.sqrt(n))).withColumn("_b", F.ceil(n / a)).withColumn("_once", step(i))
            .withColumn(out, F.when(once < n, once).otherwise(walk)).drop("_a", "_b", "_once"))


# -- sources, positions, slots ----------------------------------------------

def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """(source, src, source_size, weight, target) of each source.  ``src``
    numbers sources by code point, null last; weights repeat in that order.
    Filling up by rising cap per weight, a source is capped if its cap is
    below its share of what is left; the others share the rest by weight."""
    rank = Window.orderBy(F.col("source").isNull(), "source")
    every = Window.partitionBy()
    rising = Window.orderBy(F.col("cap") / F.col("weight"), "src")
    rest = F.col("total") - F.coalesce(F.sum("cap").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sharing = F.sum("weight").over(rising.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    left = F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(every), F.lit(0))
    return (sized.groupBy("source").agg(F.sum("size").alias("source_size"))
            .withColumn("src", F.row_number().over(rank))
            .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("src") - 1) % len(weights) + 1))
            .withColumns({"cap": F.col("source_size") * F.lit(most_repeats), "total": F.sum("source_size").over(every)})
            .withColumn("capped", F.col("cap") * sharing <= F.col("weight") * rest)
            .withColumn("target", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
                F.col("weight") * left / F.sum(F.when(~F.col("capped"), F.col("weight"))).over(every)))
            .select("source", "src", "source_size", "weight", "target"))


def quotas(targets: DataFrame, block_words: int) -> DataFrame:
    """Adds ``blocks`` of the source, ``rounds`` in which all are taken,
    ``rest`` words of the last round, and ``quota`` of slots.  (The last
    round may need one more slot than its words fill, as the source's last
    block is shorter.)"""
    words = F.round("target").cast("bigint")
    rest = F.col("rest")
    return (targets.where("source_size > 0").withColumn("blocks", F.ceil(F.col("source_size") / block_words))
            .withColumn("rounds", F.floor(words / F.col("source_size")))
            .withColumn("rest", words - F.col("rounds") * F.col("source_size"))
            .withColumn("quota", F.col("rounds") * F.col("blocks")
                        + F.when(rest > 0, F.least("blocks", F.ceil(rest / block_words) + 1)).otherwise(0)))


def positions(sized: DataFrame) -> DataFrame:
    """Adds (chunk, nth), which with src names a row, and ``start``, the words
    of the source before it."""
    chunks = int(sized.count() ** 0.5) + 1
    chunked = sized.withColumn("chunk", F.pmod(F.xxhash64("row_key"), F.lit(chunks)))
    order = Window.partitionBy("src", "chunk").orderBy("row_key")
    before = Window.partitionBy("src").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = (chunked.groupBy("src", "chunk").agg(F.sum("size").alias("words"))
            .select("src", "chunk", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("words_before")))
    return (chunked.withColumns({
                "nth": F.row_number().over(order),
                "start": F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")})
            .join(sums, ["src", "chunk"]).withColumn("start", F.col("start") + F.col("words_before")).drop("words_before"))


def draw_slots(shares: DataFrame, shard_slots: int | None, seed: int) -> DataFrame:
    """(shard, slot, src, use): a source for every slot, and the number of
    the slot among the source's; ``use`` is 0 to quota - 1, each once.
    Shards have ``shard_slots`` slots; if none are given, ``SHARD_SLOTS`` or
    the square root of all, if that is more, so that a source's counts per
    shard, which are summed in order, grow as slowly."""
    spark = shares.sparkSession
    total = shares.agg(F.sum("quota")).first()[0] or 0
    shard_slots = shard_slots or max(SHARD_SLOTS, math.isqrt(total))
    running = Window.orderBy("src").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # the share of a source is an interval of [0, 1), listed under every bin it touches
    high = F.sum("quota").over(running)
    bins = materialize(
        shares.where("quota > 0").select("src", "quota", ((high - F.col("quota")) / total).alias("low"), (high / total).alias("high"))
        .select("*", F.explode(F.sequence(F.floor(F.col("low") * BINS), F.least(F.lit(BINS - 1), F.floor(F.col("high") * BINS)))).alias("bin")),
        "shares")
    uniform = F.pmod(F.xxhash64(F.lit(seed), F.col("slot")), F.lit(1 << 53)) / F.lit(float(1 << 53))
    drawn = (spark.range(total).select(F.col("id").alias("slot"), F.floor(F.col("id") / shard_slots).alias("shard"))
             .withColumn("draw", uniform).withColumn("bin", F.floor(F.col("draw") * BINS))
             .join(bins, "bin").where("draw >= low and draw < high").select("shard", "slot", "src", "quota"))
    counts = drawn.groupBy("shard", "src").agg(F.count("*").alias("n"))                   # multinomial
    by_source = Window.partitionBy("src")
    before = by_source.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumns({"n_before": F.coalesce(F.sum("n").over(before), F.lit(0)), "drawn": F.sum("n").over(by_source)})
    within = F.row_number().over(Window.partitionBy("shard", "src").orderBy("slot"))
    numbered = permute(drawn.withColumn("within", within).join(counts, ["shard", "src"]), "use",
                       F.col("n_before") + F.col("within") - 1, F.col("drawn"), F.lit(seed), F.col("src"))
    kept = numbered.where("use < quota").select("shard", "slot", "src", "use")
    # draws beyond a quota fill what other sources lack, one to one
    whole = (shares.select("src", "quota").join(counts.groupBy("src").agg(F.max("drawn").alias("drawn")), "src", "left")
             .withColumn("drawn", F.coalesce("drawn", F.lit(0))))
    def number_before(n: Column) -> Column:
        return F.sum(n).over(running) - n
    whole = materialize(whole.withColumns({"over": F.greatest(F.col("drawn") - F.col("quota"), F.lit(0)),
                                           "short": F.greatest(F.col("quota") - F.col("drawn"), F.lit(0))})
                        .withColumns({"over_before": number_before(F.col("over")), "short_before": number_before(F.col("short"))}), "draws")
    surplus = (numbered.where("use >= quota").join(whole.select("src", "over_before"), "src")
               .select("shard", "slot", (F.col("over_before") + F.col("use") - F.col("quota")).alias("number")))
    lacking = (whole.where("short > 0").select("src", "drawn", F.posexplode(F.sequence(F.col("short_before"), F.col("short_before") + F.col("short") - 1))
                                               .alias("nth", "number"))
               .select("number", "src", (F.col("drawn") + F.col("nth")).alias("use")))
    return kept.unionByName(surplus.join(lacking, "number").select("shard", "slot", "src", "use"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights: tuple[float, ...] = WEIGHTS, most_repeats: int = MOST_REPEATS, block_words: int = BLOCK_WORDS,
        shard_slots: int | None = None, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(documents, pieces).  Documents: (doc_id, source, row_key, size, src,
    chunk, nth, start, source_size, target).  Pieces, the mix: (shard, slot,
    round, src, chunk, nth, from_word, to_word), the words of a document that
    a slot takes; (src, chunk, nth) names the document."""
    sized = materialize(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                                    row_key(id_col, source_col, text_col).alias("row_key"), word_count(F.col(text_col)).alias("size")), "sized")
    targets = materialize(source_targets(sized, weights, most_repeats), "targets")
    named = targets.select(F.col("source").alias("of"), "src", "source_size", "target")
    documents = materialize(positions(sized.join(named, F.col("source").eqNullSafe(F.col("of"))).drop("of")), "positions")

    shares = materialize(quotas(targets, block_words), "quotas")
    slots = materialize(draw_slots(shares, shard_slots, seed), "slots")
    n = F.lit(block_words)
    order = (F.lit(seed), F.col("src"), F.col("round"))
    last = F.col("source_size") - (F.col("blocks") - 1) * n                                # words of the source's last block
    took = (slots.join(shares.select("src", "source_size", "blocks", "rounds", "rest"), "src")
            .withColumns({"round": F.floor(F.col("use") / F.col("blocks")), "place": F.col("use") % F.col("blocks")}))
    took = permute(took, "block", F.col("place"), F.col("blocks"), *order)
    took = permute(took, "last_at", F.col("blocks") - 1, F.col("blocks"), *order, back=True)     # the place of the last block
    whole = F.when(F.col("block") == F.col("blocks") - 1, last).otherwise(n)
    before = F.col("place") * n - F.when(F.col("last_at") < F.col("place"), n - last).otherwise(0)
    words = F.when(F.col("round") < F.col("rounds"), whole).otherwise(F.least(whole, F.col("rest") - before))
    took = took.withColumn("words", words).where("words > 0").select("shard", "slot", "round", "src", "block", "words")

    first, behind = F.col("start"), F.col("start") + F.col("size")
    blocks = (documents.where("size > 0").select("src", "chunk", "nth", "start", "size", F.explode(
                  F.sequence(F.floor(first / n), F.floor((behind - 1) / n))).alias("block")))
    begin, end = F.greatest(first, F.col("block") * n), F.least(behind, F.col("block") * n + F.col("words"))
    pieces = (took.join(blocks, ["src", "block"]).withColumns({"from_word": begin - first, "to_word": end - first})
              .where("from_word < to_word").select("shard", "slot", "round", "src", "chunk", "nth", "from_word", "to_word"))
    return documents, pieces


def taken_words(documents: DataFrame, pieces: DataFrame) -> DataFrame:
    """The documents with ``taken``, the words that the mix takes of them."""
    key = ["src", "chunk", "nth"]
    taken = pieces.groupBy(*key).agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    return documents.join(taken, key, "left").withColumn("taken", F.coalesce("taken", F.lit(0)))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """The mix as documents, all columns of ``docs``: one row per document and
    round in which some of its words are taken, whose text is those words
    with the white space before each.  Texts are shuffled once; a document's
    pieces are gathered, as many as it has blocks and rounds."""
    documents, pieces = mix(docs, id_col, source_col, text_col, **options)
    key = ["src", "chunk", "nth"]
    copy = F.row_number().over(Window.partitionBy("row_key").orderBy(*key))
    piece = F.struct("round", "from_word", "to_word")
    parts = (pieces.join(documents.withColumn("copy", copy).select(*key, "row_key", "copy"), key)
             .groupBy("row_key", "copy").agg(F.collect_list(piece).alias("pieces")))
    text = F.col("row").getField(text_col)
    ranges = F.array_sort(F.transform(F.filter("pieces", lambda p: p["round"] == F.col("round")),
                                      lambda p: F.struct(p["from_word"].alias("a"), p["to_word"].alias("z"))))
    whole = F.aggregate("ranges", F.lit(0).cast("bigint"), lambda n, r: n + r["z"] - r["a"]) == word_count(text)
    words = F.regexp_extract_all(text, F.lit(SPACED_WORD), F.lit(0))
    some = F.array_join(F.transform("ranges", lambda r: F.array_join(
        F.slice("words", (r["a"] + 1).cast("int"), (r["z"] - r["a"]).cast("int")), "")), "")
    chosen = (docs.select(F.struct("*").alias("row"), row_key(id_col, source_col, text_col).alias("row_key"))
              .withColumn("copy", F.row_number().over(Window.partitionBy("row_key").orderBy("row_key")))
              .join(parts, ["row_key", "copy"])
              .withColumn("round", F.explode(F.array_distinct(F.transform("pieces", lambda p: p["round"]))))
              .withColumn("ranges", ranges).withColumn("whole", whole).withColumn("words", F.when(~F.col("whole"), words)))
    return chosen.select(*((F.when(F.col("whole"), text).otherwise(some) if c == text_col else F.col("row").getField(c)).alias(c)
                           for c in docs.columns))
