"""Toxicity scores of obfuscated text: a noisy-channel decoder restores
words hidden by leetspeak, spacing and repetition, and the restored text is
scored with learned word weights.

* *Language model*: counts of letter trigrams over **all** documents (one
  scan; each task sends at most 28**3 counts).
* *Decoder*: a token that looks obfuscated becomes a lattice: each character
  stands for itself or, at a cost, for the letters it imitates; a run of one
  letter may be one or two; a separator between single letters is dropped or
  ends a word.  Viterbi picks the path with the best language-model score.
  Other tokens have one path and stay as they are.
* *Weights*: log odds of each word between toxic and clean training texts,
  counted once per distinct (previous word, next word) context, so that the
  words of near copies of one text count once.  Only clear ones are kept.

Training takes a bounded sample of labelled rows (``FIT_ROWS``); the language
model and the scoring cover all documents.  Scoring is one scan.

Defined results: a null, empty or wordless text gets the score of the prior;
a document labelled several times counts as toxic if any label says so; null
ids and labels are not trained on; repeated rows each get their result; extra
columns are ignored.
"""

from __future__ import annotations

import unicodedata
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm import textvec

#: Most labelled rows the word weights are fitted on (lowest hashes of the id).
#: They bound the number of words that can have a weight, too.
FIT_ROWS = 20_000

#: What characters imitate.
IMITATES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "*": "aeiou", "€": "e", "£": "l",
}
SEPARATORS = " .-_*~"

#: Costs in nats: reading a character as an imitation, a run of a letter as
#: fewer letters, a separator as dropped or as the end of a word.
LEET_COST, REPEAT_COST, DROP_COST, BREAK_COST = 1.0, 0.5, 0.5, 4.0

#: Most choices of a lattice position, and the longest tokens kept decoded.
CHOICES, MEMO_CHARS = 16, 64

#: Symbols of the language model: 0 word edge, 1-26 a-z, 27 other letters.
SYMBOLS = 28


@lru_cache(maxsize=1)
def symbol_table() -> np.ndarray:
    """Language-model symbol of each code point; accents are folded."""
    _, letter = textvec.char_tables()
    out = np.where(letter, SYMBOLS - 1, 0).astype(np.uint8)
    for cp in range(0x250):
        base = unicodedata.normalize("NFKD", chr(cp))[0].lower()
        if letter[cp] and "a" <= base <= "z":
            out[cp] = ord(base) - 96
    return out


def fit_letters(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """(28, 28, 28) costs -log p(third | first two) over all texts, smoothed
    by the pairs and single letters."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(SYMBOLS ** 3, np.int64)
        for b in textvec.parts(batches):
            for s in textvec.slices(b.column(0).to_pylist()):
                x = symbol_table()[s.codes].astype(np.int32)
                x = np.concatenate(([0, 0], x))
                a, m, z = x[:-2], x[1:-1], x[2:]
                use = (m != 0) | (z != 0)                    # what precedes a word edge is forgotten
                n += np.bincount(np.where(m == 0, z, (a * SYMBOLS + m) * SYMBOLS + z)[use], minlength=SYMBOLS ** 3)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[at])], ["gram", "n"])

    rows = docs.select(text_col).mapInArrow(count, "gram int, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(SYMBOLS ** 3)
    n[rows["gram"].to_numpy(int)] = rows["n"]
    n = n.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    one = (n.sum(axis=(0, 1)) + 1) / (n.sum() + SYMBOLS)
    two = (n.sum(axis=0) + 5 * one) / (n.sum(axis=(0, 2))[:, None] + 5)
    three = (n + 2 * two) / (n.sum(axis=2)[:, :, None] + 2)
    return -np.log(three)


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """Per position the (text, cost) choices; '' drops it, ' ' ends a word."""
    out: list[list[tuple[str, float]]] = []
    runs = [len(list(g)) for c, g in groupby(token) if c.isalpha()]
    doubled = len(runs) > 1 and min(runs) >= 2
    ending = len(token.rstrip(TRAILING))                    # from here on it may be punctuation
    at = 0
    while at < len(token):
        c = token[at]
        if c.isalpha():
            end = at
            while end < len(token) and token[end] == c:
                end += 1
            if end - at == 2 and doubled:
                out.append([(c, 0.0), (c + c, REPEAT_COST)])
            elif end - at >= 3:
                out.append([(c, REPEAT_COST), (c + c, REPEAT_COST)])
            else:
                out += [[(c, 0.0)]] * (end - at)
            at = end
            continue
        choices = [(x, LEET_COST) for x in IMITATES.get(c, "")]
        if c in TRAILING and c != "$" and choices and at >= ending:
            choices.append((" ", 0.0))
        if c in SEPARATORS:
            choices += [("", DROP_COST), (" ", BREAK_COST)]
        out.append(choices or [(" ", BREAK_COST)])
        at += 1
    return out


def decode(token: str, cost: np.ndarray) -> str:
    """The words of the cheapest path through the token's lattice, joined by
    blanks.  A state is the last two symbols; costs are those of the channel
    plus the language model.  Each step keeps, per state, which state and
    choice it came from, so time and memory grow with the token's length."""
    symbols = symbol_table()
    steps = lattice(token)
    best: dict[tuple[int, int], float] = {(0, 0): 0.0}
    came: list[array] = []
    for choices in steps:
        nxt: dict[tuple[int, int], float] = {}
        origin: dict[tuple[int, int], int] = {}
        for source, ((a, b), total) in enumerate(best.items()):
            for k, (piece, extra) in enumerate(choices):
                p, q, c = a, b, total + extra
                for ch in piece:
                    z = int(symbols[ord(ch)])
                    if z or q:                       # a second blank adds nothing
                        c += cost[p, q, z]
                    p, q = (q, z) if z else (0, 0)
                if (p, q) not in nxt or c < nxt[p, q]:
                    nxt[p, q] = c
                    origin[p, q] = source * CHOICES + k
        best = nxt
        came.append(array("H", origin.values()))

    def path(state: int) -> str:
        pieces = []
        for choices, back in zip(reversed(steps), reversed(came)):
            state, k = divmod(back[state], CHOICES)
            pieces.append(choices[k][0])
        return "".join(reversed(pieces))

    ends = [c + (cost[a, b, 0] if b else 0.0) for (a, b), c in best.items()]
    least = min(ends)
    return " ".join(min(path(k) for k, c in enumerate(ends) if c == least).split())


#: Taken off the end of a token before it is decoded.
TRAILING = ".,;:?!%&#*$|\"')]}("


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """1 letter, 2 imitation, 4 separator, per code point."""
    _, letter = textvec.char_tables()
    out = letter.astype(np.uint8)
    for c in IMITATES:
        out[ord(c)] |= 2
    for c in SEPARATORS:
        out[ord(c)] |= 4
    return out


@lru_cache(maxsize=1)
def _blank_table() -> np.ndarray:
    out = np.zeros(textvec.CODE_POINTS, bool)
    out[[cp for cp in range(0x3001) if chr(cp).isspace()]] = True         # no white space beyond
    return out


def suspects(s: textvec.Slice) -> list[tuple[int, int, int]]:
    """(text, start, end) of the tokens of a slice that the decoder has to
    look at, found on the code points of the whole slice; a token's bounds
    are looked up for all its marks at once, so a long one costs no more."""
    kind = _kinds()[s.codes]
    letter, imitation = (kind & 1) > 0, (kind & 2) > 0
    separator = ((kind & 4) > 0) & (s.codes > 32)
    edge = ((kind & 4) > 0) | (s.codes <= 32)
    n = len(s.codes)
    mark = np.zeros(n, bool)
    mark[:-1] |= imitation[:-1] & letter[1:]                           # 1diot, id1ot
    mark[1:] |= imitation[1:] & letter[:-1]                            # idio7, a$$
    mark[1:-1] |= separator[1:-1] & letter[:-2] & letter[2:]           # mo-ron
    mark[3:] |= letter[3:] & (s.codes[3:] == s.codes[2:-1]) & (s.codes[1:-2] == s.codes[:-3]) & letter[1:-2]  # iiddiioott
    mark[2:] |= letter[2:] & (s.codes[2:] == s.codes[1:-1]) & (s.codes[1:-1] == s.codes[:-2])
    single = (letter | imitation) & np.append(edge[1:], True) & np.append(True, edge[:-1])
    chained = np.zeros(n, bool)                                        # to the single two before, in one text
    chained[2:] = single[2:] & single[:-2]
    chained[s.starts[s.lengths > 0]] = False
    spelled = chained.copy()                                           # f u k
    spelled[:2] = False
    spelled[2:] &= chained[:-2]
    mark |= spelled
    at = np.flatnonzero(mark)
    text = np.searchsorted(s.starts, at, "right") - 1
    blanks = np.flatnonzero(_blank_table()[s.codes])
    place = np.searchsorted(blanks, at)
    begin = np.append(-1, blanks)[place] + 1                           # the token, between white space
    begin = np.maximum(begin, s.starts[text])
    end = np.minimum(np.append(blanks, n)[place], s.starts[text] + s.lengths[text])
    first, last = _chains(chained)
    alone = spelled[at]
    begin = np.where(alone, first[at], begin)
    end = np.where(alone, last[at] + 1, end)
    out: dict[tuple[int, int], int] = {}
    for d, b, e in zip(text.tolist(), (begin - s.starts[text]).tolist(), (end - s.starts[text]).tolist()):
        if e > out.get((d, b), 0):
            out[d, b] = e
    return [(d, b, e) for (d, b), e in sorted(out.items())]


def _chains(chained: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last member of each position's chain, where a position is
    chained to the one two before."""
    n = len(chained)
    first, last = np.empty(n, np.int64), np.empty(n, np.int64)
    for parity in (0, 1):
        link = chained[parity::2]
        m = np.arange(len(link))
        first[parity::2] = np.maximum.accumulate(np.where(link, -1, m)) * 2 + parity
        goes_on = np.append(link[1:], False)
        last[parity::2] = np.minimum.accumulate(np.where(goes_on, len(link), m)[::-1])[::-1] * 2 + parity
    return first, last


def restore(text: str, spans: list[tuple[int, int]], cost: np.ndarray, memo: dict[str, str]) -> list[tuple[int, int, str]]:
    """(start, end, restored) for the spans, in order, without overlaps.
    ``memo`` keeps decoded tokens; it is emptied when it gets large."""
    out, done = [], 0
    for begin, end in spans:
        whole = text[begin:end].lower()
        token = whole.rstrip(TRAILING)
        if begin < done or not token:
            continue
        if (tail := whole[len(token):]) and tail[0] in IMITATES:      # a$$: or punctuation, as the language model has it
            tail = tail[:len(tail) - len(tail.lstrip("".join(IMITATES)))]
            token += tail
        word = memo.get(token)
        if word is None:
            word = decode(token, cost)
            if len(token) <= MEMO_CHARS:
                if len(memo) > 200_000:
                    memo.clear()
                memo[token] = word
        out.append((begin, begin + len(token), word))
        done = begin + len(token)
    return out


def word_hashes(text: str) -> np.ndarray:
    return textvec.words(next(textvec.slices([text]))).hashes


@dataclass
class ToxicityModel:
    bias: float
    letters: np.ndarray
    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))    # sorted hashes
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: float = 1.0


def fit_sample(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic", rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, toxic): one row per labelled document, ``rows`` at most."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    one = known.groupBy(F.col(id_col).cast("bigint").alias("doc_id")).agg(F.max(label_col).cast("int").alias("toxic"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        fit_rows: int = FIT_ROWS, smoothing: float = 0.5, least_z: float = 3.2) -> ToxicityModel:
    """Language model from all of ``docs``; word weights from the documents
    that ``labels`` (already without held-out rows) names."""
    spark = docs.sparkSession
    letters = fit_letters(docs, text_col)
    shared = spark.sparkContext.broadcast(letters)

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per text and word its contexts, each once: (word, toxic, context)."""
        memo: dict[str, str] = {}
        for b in textvec.parts(batches):
            texts, toxic = b.column(0).to_pylist(), b.column(1).to_numpy(zero_copy_only=False)
            for s in textvec.slices(texts):
                spans: dict[int, list[tuple[int, int]]] = {}
                for d, begin, end in suspects(s):
                    spans.setdefault(d, []).append((begin, end))
                restored = list(s.texts)
                for d, at in spans.items():
                    pieces, done = [], 0
                    for begin, end, word in restore(s.texts[d], at, shared.value, memo):
                        pieces += [s.texts[d][done:begin], word]
                        done = end
                    restored[d] = "".join([*pieces, s.texts[d][done:]])
                for r in textvec.slices(restored):
                    w = textvec.words(r)
                    if not len(w.hashes):
                        continue
                    before = np.where(np.diff(w.text, prepend=-1) == 0, np.roll(w.hashes, 1), np.uint64(0))
                    after = np.where(np.diff(w.text, append=-1) == 0, np.roll(w.hashes, -1), np.uint64(0))
                    label = toxic[s.first + r.first + w.text]
                    rows = np.unique(np.stack([w.hashes, label.astype(np.uint64), textvec.mix(before * np.uint64(3) + after)]), axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows[0].view(np.int64)), pa.array(rows[1].astype(np.int32)), pa.array(rows[2].view(np.int64))],
                        ["word", "toxic", "context"])

    sample = fit_sample(labels, label_col=label_col, rows=fit_rows)          # at most fit_rows pairs of numbers
    train = (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
             .join(F.broadcast(sample), "doc_id"))
    toxic, clean = F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") != 1).alias("c")
    seen = train.select("text", "toxic").mapInArrow(contexts, "word bigint, toxic int, context bigint").distinct().groupBy("word").agg(toxic, clean)
    whole = sample.agg(toxic, clean).first()
    bias = float(np.log((whole["t"] + 1) / (whole["c"] + 1)))
    total = seen.agg(F.sum("t").alias("t"), F.sum("c").alias("c")).first()
    if not total["t"]:
        return ToxicityModel(bias, letters)
    # log odds of a word against all words, and how many deviations they are from none
    t, c = F.col("t") + smoothing, F.col("c") + smoothing
    odds = F.log(t / c) - float(np.log((total["t"] + 1) / (total["c"] + 1)))
    z = F.col("w") / F.sqrt(1 / t + 1 / c)
    kept = (seen.where("t >= 3").withColumn("w", odds).where((z >= least_z) & (F.col("w") > 1.5))
            .select("word", "w").toPandas())
    words = kept["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(words)
    model = ToxicityModel(bias, letters, words[order], kept["w"].to_numpy(float)[order])
    # words of one text aren't independent: fit how far their sum can be trusted
    known = (score(train, model).join(F.broadcast(sample), "doc_id").select("score", "toxic").toPandas())
    p = known["score"].clip(1e-9, 1 - 1e-9).to_numpy()
    scale, shift = logistic_fit(np.log(p / (1 - p)) - bias, (known["toxic"] == 1).to_numpy(float))
    if scale > 0:
        model.scale, model.bias = scale, shift
    return model


def logistic_fit(x: np.ndarray, y: np.ndarray, steps: int = 50, ridge: float = 1e-2) -> tuple[float, float]:
    """(scale, shift) of p(y = 1) = sigmoid(scale * x + shift), by Newton steps."""
    a = np.stack([x, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (y - p) - ridge * w
        hessian = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, restored): probability of the toxic label, and what
    the decoder read as (start, end, text), code points of the original."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    restored_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        memo: dict[str, str] = {}
        weighed: dict[str, list[int]] = {}
        known = np.zeros(1 << 20, bool)                      # most words miss here
        known[(m.words & np.uint64((1 << 20) - 1)).astype(int)] = True

        def find(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Which of the hashes have a weight, and which weight."""
            maybe = np.flatnonzero(known[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
            if not len(m.words):
                return maybe[:0], maybe[:0]
            at = np.minimum(np.searchsorted(m.words, hashes[maybe]), len(m.words) - 1)
            hit = m.words[at] == hashes[maybe]
            return maybe[hit], at[hit]

        for b in textvec.parts(batches):
            for s in textvec.slices(b.column(1).to_pylist()):
                w = textvec.words(s)
                which, weight = find(w.hashes)
                hits = {(int(d), int(k)) for d, k in zip(w.text[which], weight)}     # a word counts once a text
                read: list[list[dict]] = [[] for _ in s.texts]
                spans: dict[int, list[tuple[int, int]]] = {}
                for d, begin, end in suspects(s):
                    spans.setdefault(d, []).append((begin, end))
                for d, at in spans.items():
                    for begin, end, word in restore(s.texts[d], at, m.letters, memo):
                        if word and word != s.texts[d][begin:end].lower():
                            read[d].append({"start": begin, "end": end, "text": word})
                            if word not in weighed:
                                if len(weighed) > 200_000:
                                    weighed.clear()
                                weighed[word] = find(word_hashes(word))[1].tolist()
                            hits.update((d, k) for k in weighed[word])
                total = np.full(s.n, m.bias)
                for d, k in sorted(hits):
                    total[d] += m.scale * m.weights[k]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(s.first, s.n), pa.array(1 / (1 + np.exp(-np.clip(total, -500, 500)))), pa.array(read, restored_type)],
                    ["doc_id", "score", "restored"])

    return docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(
        run, "doc_id bigint, score double, restored array<struct<start:bigint,end:bigint,text:string>>")
