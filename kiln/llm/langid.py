"""Language identification of whole, possibly mixed texts.

Script ranges narrow each word's candidate languages; character trigrams
score the word under each candidate; Viterbi with a penalty for switching
labels every word, and runs of equal labels are the text's spans.

Fitting counts hashed trigrams per language over *all* labelled rows given
(one scan, partial counts per task, a shuffle of at most tasks x languages x
``buckets`` counts); the model is languages x ``buckets`` numbers, a size set
by parameters, and is broadcast.  Prediction is one scan without a shuffle.

Defined results: a null text or one without a letter is ``und`` with score 0
and no spans; rows with a null label don't take part in fitting; without any
labelled row every text is ``und``; ties go to the first language by name;
repeated rows each get their result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm import textvec

UNDETERMINED = "und"

#: First code point and name of Unicode script ranges; a range
#: ends where the next begins.
SCRIPT_RANGES = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "Syriac"), (0x0750, "Arabic"), (0x0780, "Other"), (0x0900, "Devanagari"),
    (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Oriya"), (0x0B80, "Tamil"),
    (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"),
    (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"),
    (0x1200, "Ethiopic"), (0x1380, "Other"), (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, "Other"),
    (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"), (0x2C60, "Latin"), (0x2C80, "Other"),
    (0x3040, "Kana"), (0x3100, "Han"), (0x3130, "Hangul"), (0x3190, "Han"), (0xA000, "Other"),
    (0xAC00, "Hangul"), (0xD800, "Other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB1D, "Hebrew"),
    (0xFB50, "Arabic"), (0xFE00, "Other"), (0xFE70, "Arabic"), (0xFF00, "Latin"), (0xFF66, "Kana"),
    (0xFFA0, "Hangul"), (0x10000, "Other"), (0x20000, "Han"), (0x32000, "Other"),
)
SCRIPTS = sorted({name for _, name in SCRIPT_RANGES})

COUNTS = "lang string, slot int, n bigint"
PREDICTED = "doc_id bigint, lang_pred string, score double, spans array<struct<lang:string,start:bigint,end:bigint>>"


@lru_cache(maxsize=1)
def script_table() -> np.ndarray:
    """Script number of each code point."""
    first = np.array([cp for cp, _ in SCRIPT_RANGES])
    number = np.array([SCRIPTS.index(name) for _, name in SCRIPT_RANGES], np.uint8)
    return number[np.searchsorted(first, np.arange(textvec.CODE_POINTS), "right") - 1]


@lru_cache(maxsize=1)
def lower_letters() -> np.ndarray:
    lower, letter = textvec.char_tables()
    return np.where(letter, lower, 0).astype(np.uint32)


def trigrams(codes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slot, word starts, word ends) of a slice.  ``slot`` has, for every
    position in a word and the one after it, the bucket of the trigram that
    ends there (word edges count as blanks), else ``buckets``."""
    x = lower_letters()[codes]
    inside = x != 0
    edge = np.flatnonzero(np.diff(inside, prepend=False))
    starts, ends = edge[0::2], edge[1::2]
    one = np.zeros_like(x)
    one[1:] = x[:-1]
    two = np.zeros_like(x)
    two[2:] = x[:-2]
    two[one == 0] = 0
    h = two * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    h += one
    h *= np.uint32(0x85EBCA77)
    h ^= h >> np.uint32(13)
    h += x
    h *= np.uint32(0xC2B2AE3D)
    slot = (h >> np.uint32(8)) % np.uint32(buckets)
    slot[~(inside | (one != 0))] = buckets
    return slot, starts, ends


@dataclass
class LanguageModel:
    """``log_p``: (buckets + 1, languages) log probability of each trigram
    bucket, last row 0; ``fits``: (scripts, languages) whether a language is
    a candidate for words of a script."""
    langs: list[str]
    buckets: int
    log_p: np.ndarray
    fits: np.ndarray


def fit(rows: DataFrame, lang_col: str = "lang", text_col: str = "text", buckets: int = 1 << 15,
        smoothing: float = 0.5, script_share: float = 0.005) -> LanguageModel:
    """Learn from rows with a language and a text.  A language is a candidate
    for a script that has ``script_share`` or more of its words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for b in textvec.parts(batches):
            labels = np.array(b.column(0).to_pylist(), object)
            texts = b.column(1).to_pylist()
            for lang in sorted(set(labels)):
                into = totals.setdefault(lang, np.zeros(buckets + 1 + len(SCRIPTS), np.int64))
                for s in textvec.slices([texts[i] for i in np.flatnonzero(labels == lang)]):
                    slot, starts, _ = trigrams(s.codes, buckets)
                    into[:buckets + 1] += np.bincount(slot, minlength=buckets + 1)
                    into[buckets + 1:] += np.bincount(script_table()[s.codes[starts]], minlength=len(SCRIPTS))
        for lang, n in totals.items():
            n[buckets] = 0
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at])], ["lang", "slot", "n"])

    labelled = (rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
                .where("lang is not null and text is not null"))
    counts = labelled.mapInArrow(count, COUNTS).groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counts["lang"].unique())
    n = np.zeros((buckets + 1 + len(SCRIPTS), len(langs)))
    n[counts["slot"], counts["lang"].map({k: i for i, k in enumerate(langs)})] = counts["n"]
    grams, scripts = n[:buckets] + smoothing, n[buckets + 1:]
    log_p = np.zeros((buckets + 1, len(langs)), np.float32)
    log_p[:buckets] = np.log(grams / grams.sum(axis=0))
    return LanguageModel(langs, buckets, log_p, scripts >= script_share * scripts.sum(axis=0))


def word_scores(model: LanguageModel, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(scores, starts, ends): log probability of each word in each language;
    languages that aren't candidates for the word's script get a large
    malus, unless none is one."""
    slot, starts, ends = trigrams(codes, model.buckets)
    scores = np.empty((len(starts), len(model.langs)), np.float32)
    if len(starts):
        for k in range(len(model.langs)):
            scores[:, k] = np.add.reduceat(np.ascontiguousarray(model.log_p[:, k])[slot], starts)
        fits = model.fits[script_table()[codes[starts]]]
        scores[~fits & fits.any(axis=1, keepdims=True)] -= np.float32(1e4)
    return scores, starts, ends


def viterbi(scores: np.ndarray, firsts: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each word, where a change of label between neighbours
    costs ``penalty``.  Text d has ``counts[d]`` words from ``firsts[d]``; all
    texts are decoded side by side, the longest first, so step t works on
    those that have more than t words."""
    order = np.argsort(-counts, kind="stable")
    at, n = firsts[order], counts[order]
    at, n = at[n > 0], n[n > 0]
    labels = np.zeros(len(scores), np.int16)
    if not len(n):
        return labels
    live = np.searchsorted(-n, -np.arange(n[0]), "left")     # texts with more than t words
    stay = np.ones(scores.shape, bool)
    jump = np.zeros(len(scores), np.int16)
    best = scores[at]
    for t in range(1, n[0]):
        a = live[t]
        now, pos = best[:a], at[:a] + t
        top = now.argmax(axis=1)
        leap = now[np.arange(a), top] - np.float32(penalty)
        keep = now >= leap[:, None]
        stay[pos], jump[pos] = keep, top
        best[:a] = np.where(keep, now, leap[:, None]) - now[np.arange(a), top][:, None] + scores[pos]      # rebased: sums stay small
    state = best.argmax(axis=1)
    for t in range(n[0] - 1, -1, -1):
        a = live[t]
        pos = at[:a] + t
        labels[pos] = state[:a]
        state[:a] = np.where(stay[pos, state[:a]], state[:a], jump[pos])
    return labels


@dataclass
class Labelled:
    """Result for the texts of a group: language number (-1: undetermined),
    its share of the letters, and the spans, text by text."""
    group: textvec.Slice
    lang: np.ndarray
    score: np.ndarray
    span_text: np.ndarray
    span_lang: np.ndarray
    span_start: np.ndarray
    span_end: np.ndarray


def label(model: LanguageModel, texts: list[str | None], penalty: float, group_chars: int) -> Iterator[Labelled]:
    for g in textvec.slices(texts, group_chars):
        scores, starts, ends = _group_words(model, g)
        text = np.searchsorted(g.starts, starts, "right") - 1
        if not model.langs:
            text, starts, ends = text[:0], starts[:0], ends[:0]
        counts = np.bincount(text, minlength=g.n)
        labels = viterbi(scores, np.cumsum(counts) - counts, counts, penalty) if model.langs else np.zeros(0, np.int16)
        share = np.zeros((g.n, max(1, len(model.langs))))
        np.add.at(share, (text, labels), ends - starts)
        whole = share.sum(axis=1)
        # a span runs from a change of text or label to the last word before the next
        new = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(labels, prepend=-1) != 0))
        last = np.append(new[1:], len(starts))[:len(new)] - 1
        base = g.starts[text[new]]
        yield Labelled(g, np.where(whole > 0, share.argmax(axis=1), -1), share.max(axis=1) / np.maximum(whole, 1),
                       text[new], labels[new], starts[new] - base, ends[last] - base)


PENALTY, GROUP_CHARS = 12.0, 3_000_000


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text",
            penalty: float = PENALTY, group_chars: int = GROUP_CHARS) -> DataFrame:
    """(doc_id, lang_pred, score, spans): the language with most letters of
    each text, its share of them, and the spans (code points, end exclusive).
    ``group_chars``: about how much text a task decodes side by side."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span_type = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*shared.value.langs, UNDETERMINED], object)
        for b in textvec.parts(batches):
            for r in label(shared.value, b.column(1).to_pylist(), penalty, group_chars):
                spans = pa.StructArray.from_arrays(
                    [pa.array(names[r.span_lang], pa.string()), pa.array(r.span_start), pa.array(r.span_end)], ["lang", "start", "end"])
                offsets = np.concatenate(([0], np.cumsum(np.bincount(r.span_text, minlength=r.group.n))))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(r.group.first, r.group.n), pa.array(names[r.lang], pa.string()), pa.array(r.score),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans).cast(span_type)],
                    ["doc_id", "lang_pred", "score", "spans"])

    return docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, PREDICTED)


def keep_identified(docs: DataFrame, model: LanguageModel, least_score: float, text_col: str = "text",
                    penalty: float = PENALTY, group_chars: int = GROUP_CHARS) -> DataFrame:
    """The documents, all columns, whose language is known and covers
    ``least_score`` of the letters or more, in the task that reads them."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in textvec.parts(batches):
            for r in label(shared.value, b.column(at).to_pylist(), penalty, group_chars):
                keep = (r.lang >= 0) & (r.score >= least_score)
                yield b.slice(r.group.first, r.group.n).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def _group_words(model: LanguageModel, group: textvec.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word scores of a group, slice by slice: trigrams take many bytes a character."""
    parts, at = [], 0
    for s in textvec.slices(group.texts):
        scores, starts, ends = word_scores(model, s.codes)
        parts.append((scores, starts + at, ends + at))
        at += len(s.codes)
    return tuple(np.concatenate(x) for x in zip(*parts))
