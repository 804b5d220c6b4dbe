"""N-gram Jaccard join: MinHash bands find candidates, full n-gram sets
verify them.

1. One scan turns each text into a class key (its word sequence), its number
   of words and its band hashes; bands and rows are chosen for the target
   recall at the threshold.  Texts of one class have equal n-gram sets, so
   only one text per class goes on.
2. A shuffle on band hashes links each class to the least class of its band
   (a star, not all pairs), and the connected components of these links are
   the candidate groups.
3. The texts of candidates join their group, and every group is dealt into
   tiles of classes.  Each pair of tiles meets in one task, where the n-gram
   sets are compared exactly.  A task sends only sums and a spanning forest
   of its links, never the pairs.
4. Connected components of the verified links are the result's groups.

A pair is missed only if no chain of shared bands joins it; a pair that is
not similar is never reported.

Defined results: a null, empty or wordless text has no n-grams, is linked to
nothing and is its own group; texts of fewer words than ``n`` have one n-gram,
all their words; repeated rows and equal texts under several ids are members
of one class; null ids are kept, and never the group's id unless all are
null; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm import textvec
from kiln.llm.groups import components
from kiln.operators.joins import join_small, lookup
from kiln.session import materialize

N, THRESHOLD, RECALL, PERMUTATIONS, SEED = 5, 0.8, 0.9995, 256, 8

#: Least classes in a tile; larger groups get tiles of about the square root
#: of their size, so that tiles and what a task holds grow alike.
TILE = 64

SKETCH = "doc_id bigint, text_md5 string, class binary, n_words bigint, bands array<bigint>"


def sketch(docs: DataFrame, id_col: str, text_col: str, n: int, bands: int, rows: int, seed: int,
           permutations: int = 0) -> DataFrame:
    """(doc_id, text_md5, class, n_words, bands) of every text; the bands are
    of a signature of ``permutations`` values, or as many as they need."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in textvec.parts(batches):
            for s in textvec.slices(b.column(1).to_pylist()):
                w = textvec.words(s)
                g, at = textvec.ngrams(w, n)
                full = np.flatnonzero(w.counts)
                firsts = np.searchsorted(w.text[at], full)
                keys = np.zeros((s.n, bands), np.uint64)
                keys[full] = textvec.band_keys(textvec.minhash(g, firsts, max(permutations, bands * rows), seed), bands, rows)
                size = np.where(w.counts > 0, bands, 0)
                offsets = pa.array(np.concatenate(([0], np.cumsum(size))), pa.int32())
                classes = textvec.sequence_keys(w)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(s.first, s.n), b.column(2).slice(s.first, s.n),
                     pa.array([c.tobytes() if k else None for c, k in zip(classes, w.counts)], pa.binary()),
                     pa.array(w.counts), pa.ListArray.from_arrays(offsets, pa.array(keys[full].ravel().view(np.int64)))],
                    ["doc_id", "text_md5", "class", "n_words", "bands"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"),
                       F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_md5")).mapInArrow(run, SKETCH)


def candidates(classes: DataFrame) -> DataFrame:
    """(class, group): classes that share bands with others, and the least
    class of their chain of shared bands."""
    hashed = classes.select("class", F.posexplode("bands").alias("band", "hash"))
    star = hashed.groupBy("band", "hash").agg(F.min("class").alias("centre"), F.count("*").alias("n")).where("n > 1").drop("n")
    links = hashed.join(star, ["band", "hash"]).where("class <> centre").select(F.col("centre").alias("u"), F.col("class").alias("v"))
    return components(links).select(F.col("node").alias("class"), F.col("component").alias("group"))


def ngram_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """(class, group, n_docs, n_classes, grams): the n-gram set of each wanted
    class, as sorted 64-bit hashes packed in bytes, from the text of its named
    document.  Id and digest name it, so that null and shared ids fetch no
    other texts."""
    named = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"),
                        F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_md5"))
    texts = join_small(named, wanted, ["doc_id", "text_md5"]).select("class", "group", "n_docs", "n_classes", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in textvec.parts(batches):
            classes = b.column(0).to_pylist()
            for s in textvec.slices(b.column(4).to_pylist()):
                w = textvec.words(s)
                g, at = textvec.ngrams(w, n)
                own = np.searchsorted(w.text[at], np.arange(s.n + 1))
                keys = textvec.sequence_keys(w)
                use = [d for d in range(s.n) if w.counts[d] and keys[d].tobytes() == classes[s.first + d]]
                rows = pa.array([s.first + d for d in use], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [b.column(k).take(rows) for k in range(4)]
                    + [pa.array([np.unique(g[own[d]:own[d + 1]]).tobytes() for d in use], pa.binary())],
                    ["class", "group", "n_docs", "n_classes", "grams"])

    return texts.mapInArrow(run, "class binary, group binary, n_docs bigint, n_classes bigint, grams binary")


def tile_links(sets: DataFrame, threshold: float, tile: int) -> DataFrame:
    """(class, links, peer): per class the documents of similar classes,
    in parts to be summed, and links of a spanning forest as (class, peer)."""
    tiles = F.greatest(F.lit(1), F.ceil(F.col("n_classes") / F.greatest(F.lit(tile), F.ceil(F.sqrt("n_classes"))))).cast("int")
    placed = (sets.withColumn("tiles", tiles)
              .withColumn("tile", F.pmod(F.xxhash64("class"), F.col("tiles")).cast("int"))
              .withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
              .select("class", "group", "n_docs", "grams", "tile",
                      F.least("tile", "other").alias("row_tile"), F.greatest("tile", "other").alias("col_tile")))

    def compare(key: tuple, t: pa.Table) -> pa.Table:
        classes = np.array(t["class"].to_pylist(), object)
        _, once = np.unique(classes.astype("S16"), return_index=True)         # a class can come from repeated rows
        once.sort()
        classes, n_docs = classes[once], t["n_docs"].to_numpy()[once]
        side = t["tile"].to_numpy()[once]
        packed = t["grams"].to_pylist()
        pairs = similar([np.frombuffer(packed[k], np.uint64) for k in once], threshold)
        if key[1].as_py() != key[2].as_py():                                   # the pairs within a tile have a task of their own
            pairs = pairs[side[pairs[:, 0]] != side[pairs[:, 1]]]
        links = np.zeros(len(classes), np.int64)
        np.add.at(links, pairs[:, 0], n_docs[pairs[:, 1]])
        np.add.at(links, pairs[:, 1], n_docs[pairs[:, 0]])
        forest = spanning_forest(pairs, len(classes))
        some = np.flatnonzero(links)
        return pa.table({
            "class": pa.array([*classes[some], *classes[forest[:, 0]]], pa.binary()),
            "links": pa.array(np.concatenate((links[some], np.zeros(len(forest), np.int64)))),
            "peer": pa.array([None] * len(some) + list(classes[forest[:, 1]]), pa.binary())})

    return placed.groupBy("group", "row_tile", "col_tile").applyInArrow(compare, "class binary, links bigint, peer binary")


def similar(sets: list[np.ndarray], threshold: float, block: int = 1 << 22) -> np.ndarray:
    """(pairs, 2) of the sets whose Jaccard similarity is ``threshold`` or
    more.  Common n-grams are counted by products of 0/1 matrices whose
    columns are the n-grams that two or more sets have, a block at a time."""
    m = len(sets)
    size = np.array([len(x) for x in sets], np.int64)
    owner = np.repeat(np.arange(m), size)
    _, number, count = np.unique(np.concatenate(sets) if m else np.zeros(0, np.uint64), return_inverse=True, return_counts=True)
    shared = count > 1
    column = np.cumsum(shared) - 1
    use = shared[number]
    owner, column = owner[use], column[number[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((m, m), np.float32)
    columns = int(shared.sum())
    width = max(1, min(columns, block // max(1, m)))
    for first in range(0, columns, width):
        a, z = np.searchsorted(column, (first, first + width))
        has = np.zeros((m, width), np.float32)
        has[owner[a:z], column[a:z] - first] = 1
        common += has @ has.T
    # exact: |common| * (1 + t) >= t * (|a| + |b|), in integers up to float rounding of t
    enough = common.astype(np.float64) >= threshold * (size[:, None] + size[None, :] - common) - 1e-9
    i, j = np.nonzero(np.triu(enough, 1))
    return np.stack([i, j], axis=1)


def spanning_forest(pairs: np.ndarray, n: int) -> np.ndarray:
    """(links, 2): pairs that connect what all pairs connect."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for a, b in pairs.tolist():
        ra, rb = find(a), find(b)
        if ra != rb:
            root[max(ra, rb)] = min(ra, rb)
            out.append((a, b))
    return np.array(out, np.int64).reshape(-1, 2)


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, threshold: float = THRESHOLD,
                 recall: float = RECALL, permutations: int = PERMUTATIONS, seed: int = SEED, tile: int = TILE) -> DataFrame:
    """(doc_id, text_md5, class, group_key, group_id, n_links): every document
    with its class of equal texts (hex), its group of linked documents (least
    class, and least id), and the number of documents it is linked to, copies
    included."""
    bands, rows = textvec.choose_bands(threshold, recall, most=permutations)
    sketched = materialize(sketch(docs, id_col, text_col, n, bands, rows, seed), "sketch")
    return link(docs, sketched, id_col, text_col, n, threshold, tile)


def link(docs: DataFrame, sketched: DataFrame, id_col: str, text_col: str, n: int, threshold: float, tile: int = TILE) -> DataFrame:
    """The join's result from the sketches of ``docs``."""
    per_class = class_links(docs, sketched, id_col, text_col, n, threshold, tile).drop("n_docs")
    every = sketched.select("doc_id", "text_md5", "class")
    hexed = F.lower(F.hex("class")).alias("class")
    return (every.join(per_class, "class").select("doc_id", "text_md5", hexed, "group_key", "group_id", "n_links")
            .unionByName(every.where("class is null").select(
                "doc_id", "text_md5", hexed, F.lit(None).cast("string").alias("group_key"),
                F.col("doc_id").alias("group_id"), F.lit(0).cast("bigint").alias("n_links"))))


def class_links(docs: DataFrame, sketched: DataFrame, id_col: str, text_col: str, n: int, threshold: float,
                tile: int = TILE) -> DataFrame:
    """(class, group_id, group_key, n_links, n_docs) of every class."""
    classes = (sketched.where("class is not null").groupBy("class")
               .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_md5")).alias("named"), F.count("*").alias("n_docs"),
                    F.first("bands").alias("bands"))
               .select("class", "named.doc_id", "named.text_md5", "n_docs", "bands"))
    near = materialize(candidates(classes), "near")
    sizes = near.groupBy("group").agg(F.count("*").alias("n_classes")).withColumn("rows", F.col("n_classes"))
    wanted = materialize(lookup(near, sizes, ["group"], "rows").join(classes.drop("bands"), "class"), "wanted")
    found = materialize(tile_links(ngram_sets(docs, wanted, id_col, text_col, n), threshold, tile), "found")
    linked = components(found.where("peer is not null"), "class", "peer")
    sums = found.groupBy("class").agg(F.sum("links").alias("links"))
    per_class = (classes.drop("bands", "text_md5").join(linked.select(F.col("node").alias("class"), "component"), "class", "left")
                 .join(sums, "class", "left").withColumn("component", F.coalesce("component", "class")))
    least = per_class.groupBy("component").agg(F.min("doc_id").alias("group_id"))
    return per_class.join(least, "component").select(
        "class", "group_id", F.lower(F.hex("component")).alias("group_key"),
        (F.coalesce("links", F.lit(0)) + F.col("n_docs") - 1).alias("n_links"), "n_docs")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, all columns, with one of each group: the least id (then
    text digest).  Rows that repeat an id and its text are one document."""
    def key(doc_id, digest):
        return F.concat_ws(":", digest, doc_id.cast("string"))

    joined = jaccard_join(docs, id_col, text_col, **options)
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_md5")
    best = joined.where("class is not null").groupBy("group_key").agg(F.min(order).alias("k")).select("k.doc_id", "k.text_md5")
    alone = joined.where("class is null").select("doc_id", "text_md5")
    kept = best.unionByName(alone).select(key(F.col("doc_id"), F.col("text_md5")).alias("kept")).distinct()
    digest = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    return (docs.select(F.struct("*").alias("row"), key(F.col(id_col).cast("bigint"), digest).alias("kept"))
            .join(kept, "kept").dropDuplicates(["kept"]).select("row.*"))
