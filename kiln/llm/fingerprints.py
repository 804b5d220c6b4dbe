"""Document fingerprints: MinHash signatures of word shingles, many universal
hash permutations at once in numpy; neighbours in id order compared; near
copies found by signature bands joined in Spark and verified on full sets.

A fingerprint is the low 16 bits of each of ``PERMUTATIONS`` minima, as
hexadecimal text.  The *likeness* of two fingerprints, the share of equal
values, estimates the Jaccard similarity of their shingle sets.

``edited_neighbours`` needs each document next to its successor.  Texts are
shuffled once: ids are cut at quantiles into buckets, a bucket's first
document is also sent, as an extra row, to the bucket before, and each bucket
is read in order as a stream, so a task holds one batch.

Defined results: null counts as the empty text; wordless texts share one
fingerprint, unlike any other; texts of fewer words than ``n`` have one
shingle, all their words; documents are ordered by descending id, null ids
last, and equal ids by text (rows of one id stay in one bucket); a lone
document is its own successor; repeated rows each get their result; extra
columns are ignored; a wordless text is its own group, linked to nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm import jaccard_join, textvec
from kiln.operators.joins import lookup
from kiln.session import materialize, partitions_for

N, PERMUTATIONS, SEED = 5, 128, 9
THRESHOLD, RECALL = 0.8, 0.9995
WORDLESS = 0xFFFF

#: Ids are cut into four buckets a partition, at quantiles of so many sampled
#: ids a bucket, about: that sample, and the buckets' first ids for every task,
#: are all that the driver holds.  The cuts affect only how even buckets are.
CUT_SAMPLE = 20
#: Buckets in all, instead of four a partition.
BUCKETS = None
NULL_ID = -(1 << 63)

RESULT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def signatures(texts: list[str | None], n: int, permutations: int, seed: int) -> np.ndarray:
    """(texts, permutations) uint16 fingerprints."""
    out = np.full((len(texts), permutations), WORDLESS, np.uint16)
    for s in textvec.slices(texts):
        w = textvec.words(s)
        g, at = textvec.ngrams(w, n)
        full = np.flatnonzero(w.counts)
        out[s.first + full] = textvec.minhash(g, np.searchsorted(w.text[at], full), permutations, seed)
    return out


def classes(texts: list[str]) -> list[bytes | None]:
    """Key of each text's word sequence (no words: None)."""
    out: list[bytes | None] = []
    for s in textvec.slices(texts):
        w = textvec.words(s)
        out += [k.tobytes() if c else None for k, c in zip(textvec.sequence_keys(w), w.counts)]
    return out


def edited(text: str, successor: str) -> str:
    """The last half of the code points replaced by as many first ones of the
    successor, or all that it has."""
    half = len(text) // 2
    return text[:len(text) - half] + successor[:half]


def edited_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N,
                      permutations: int = PERMUTATIONS, seed: int = SEED, with_class: bool = False) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next) of every document, and the class of its word
    sequence if asked for."""
    result = RESULT + ", class binary" * with_class
    named = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = partitions_for(docs)
    wanted = BUCKETS or 4 * parts
    key = F.coalesce("doc_id", F.lit(NULL_ID))
    rows, most = named.agg(F.count("*"), F.max(key)).first()
    if not rows:
        return docs.sparkSession.createDataFrame([], result)
    # quantiles of a sample of the ids, by their hashes: the same in every run
    share = min(1.0, CUT_SAMPLE * wanted / rows)
    chance = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    sample = np.sort(np.array([r[0] for r in named.where(chance < share).select(key).collect()], np.int64))
    cuts = sample[np.arange(1, wanted) * len(sample) // wanted] if len(sample) else sample
    # bucket b holds the ids from firsts[b] down to above firsts[b + 1]
    firsts = np.unique(np.append(cuts, most))[::-1]
    shared = docs.sparkSession.sparkContext.broadcast(firsts)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        down = -1 - shared.value                              # ascending, and no overflow
        for b in textvec.parts(batches):
            ids = -1 - b.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False)
            sig = signatures(b.column(1).to_pylist(), n, permutations, seed)
            bucket = np.maximum(np.searchsorted(down, ids, "right") - 1, 0)
            head = np.flatnonzero(down[bucket] == ids)
            rows = np.concatenate((np.arange(len(ids)), head))
            to = np.concatenate((bucket, (bucket[head] - 1) % len(down)))
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(to, pa.int32()), pa.array(np.arange(len(rows)) >= len(ids)), b.column(0).take(take), b.column(1).take(take),
                 pa.array([sig[k].tobytes() for k in rows], pa.binary())],
                ["bucket", "head", "doc_id", "text", "sig"])

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []                                # the last row waits for its successor
        for b in textvec.parts(batches):
            rows = held + list(zip(*(b.column(k).to_pylist() for k in range(1, 5))))
            pairs = [(a, z) for a, z in zip(rows, rows[1:]) if not a[0]]
            held = rows[-1:]
            changed = [edited(a[2], z[2]) for a, z in pairs]
            sig = signatures(changed, n, permutations, seed)
            own = np.frombuffer(b"".join(a[3] for a, _ in pairs), np.uint16).reshape(-1, permutations)
            after = np.frombuffer(b"".join(z[3] for _, z in pairs), np.uint16).reshape(-1, permutations)
            yield pa.RecordBatch.from_arrays(
                [pa.array([a[1] for a, _ in pairs], pa.int64()), pa.array([len(a[2]) for a, _ in pairs], pa.int64()),
                 pa.array([hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in changed], pa.string()),
                 pa.array([a[3].hex() for a, _ in pairs], pa.string()), pa.array([x.tobytes().hex() for x in sig], pa.string()),
                 pa.array((own == sig).mean(axis=1)), pa.array((own == after).mean(axis=1))]
                + [pa.array(classes([a[2] for a, _ in pairs]), pa.binary())] * with_class,
                [c.split()[0] for c in result.split(", ")])

    return (named.mapInArrow(place, "bucket int, head boolean, doc_id bigint, text string, sig binary")
            .repartition(parts, "bucket").sortWithinPartitions("bucket", "head", F.desc_nulls_last("doc_id"), "text")
            .mapInArrow(follow, result))


def signature_bands(docs: DataFrame, id_col: str, text_col: str, n: int, threshold: float, recall: float, permutations: int,
                    seed: int) -> DataFrame:
    """Classes and signature bands of all documents, written."""
    bands, rows = textvec.choose_bands(threshold, recall, most=permutations)
    return materialize(jaccard_join.sketch(docs, id_col, text_col, n, bands, rows, seed, permutations), "fingerprints")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, threshold: float = THRESHOLD,
                recall: float = RECALL, permutations: int = PERMUTATIONS, seed: int = SEED) -> DataFrame:
    """(doc_id, text_md5, class, group_key, group_id, n_links): documents
    linked to others by Jaccard similarity of ``threshold`` or more.  The
    signature is cut into bands, the bands are joined in Spark and every
    candidate is verified on its full shingle set."""
    sketched = signature_bands(docs, id_col, text_col, n, threshold, recall, permutations, seed)
    return jaccard_join.link(docs, sketched, id_col, text_col, n, threshold)


def fingerprint_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, threshold: float = THRESHOLD,
                     recall: float = RECALL, permutations: int = PERMUTATIONS, seed: int = SEED) -> DataFrame:
    """The rows of ``edited_neighbours`` with (group_id, n_links) of their
    near copies.  What is known per class of equal word sequences joins on the
    class, so that null and repeated ids need no care; classes without a copy
    or a link aren't sent."""
    sketched = signature_bands(docs, id_col, text_col, n, threshold, recall, permutations, seed)
    linked = materialize(jaccard_join.class_links(docs, sketched, id_col, text_col, n, threshold).where("n_links > 0")
                         .select("class", "group_id", "n_links", F.col("n_docs").alias("rows")), "near_copies")
    rows = edited_neighbours(docs, id_col, text_col, n, permutations, seed, with_class=True)
    return lookup(rows, linked, ["class"], "rows", "left").select(
        *[c for c in rows.columns if c != "class"],
        F.when(F.col("n_links").isNull(), F.col("doc_id")).otherwise(F.col("group_id")).alias("group_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))
