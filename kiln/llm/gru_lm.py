"""Gated recurrent language model over words, and the word-frequency base.

A text is its words (lower-cased A-Z, cut at white space) and one end token.
The network reads the previous token and carries a gated recurrent state; it
predicts the class of the next token, then the token within its class (classes
are runs of the tokens by frequency, about the square root of their number).
Its vocabulary is the ``WORDS`` most frequent tokens, the end, and one token
that stands for all others; a rare word's probability is that token's times
the word's smoothed share of the rare words, so that the probabilities of all
texts add up whatever the vocabulary.

1. Tokens of the training texts are counted, all of them (partial counts per
   task, a shuffle by token, a written table).
2. Training texts are written as token ids, dealt over ``ROUNDS`` rounds.  In a
   round every task goes through its part of the texts with truncated
   backpropagation: lanes of texts side by side, windows of ``WINDOW`` steps,
   the state carried from window to window.  The tasks' weights are averaged
   by the tokens that they saw, in slices of the weight vector, and broadcast
   for the next round.  Each text is seen once; if the training texts have
   fewer than ``LEAST_TOKENS`` tokens, they are gone through as often as that
   takes.
3. Scoring is one scan: texts side by side, the state carried through each
   whole text.  The most frequent tokens, ``LISTED`` at most, and their counts
   are broadcast; what a text has of other words is joined with the table of
   counts.

Defined results: a null text counts as empty and has only its end token; a
token that training texts lack has count 0; without training texts every
token's base probability is 1 and the network is untrained; repeated rows each
get their result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm import bytewords
from kiln.session import materialize, scratch_path

BLANKS = "\t\n\x0b\x0c\r "
#: The end of a text among the counted tokens; no word is empty.
END = ""

WORDS, LISTED, HIDDEN, EMBEDDED = 2048, 1 << 17, 16, 16
ROUNDS, LANES, WINDOW, RATE = 4, 256, 32, 0.1
#: Tokens a task sees in a round, about, and tokens that training sees at least.
PART_TOKENS, LEAST_TOKENS = 6_000_000, 500_000
#: Tokens that a task holds side by side (in scoring: bytes of texts), and
#: slices of the weight vector.
GROUP_TOKENS, GROUP_BYTES, CHUNKS = 4_000_000, 12 << 20, 64
#: Texts side by side in scoring, where the weights stay the same, so that this changes no result.
SCORING_LANES = 512
SMOOTHING = 0.1
#: What sums of squared gradients begin with.
FIRST_SQUARE = 1e-7

SCORED = ("doc_id bigint, n_tokens bigint, n_listed bigint, base double, score double, "
          "others array<struct<token:string,n:bigint>>")


def cut(s: bytewords.ByteSlice) -> bytewords.ByteWords:
    return bytewords.cut(s, ~bytewords.byte_set(BLANKS)[s.data])


def count_tokens(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(token, n): how often each token occurs, the end of texts included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = 0
        for b in batches:
            texts += b.num_rows
            for s in bytewords.byte_slices(b.column(0)):
                w = cut(s)
                yield _counts(w.names.cast(pa.string()), np.bincount(w.number, minlength=len(w.names)))
        if texts:
            yield _counts(pa.array([END], pa.string()), np.array([texts]))
        pa.default_memory_pool().release_unused()

    def _counts(tokens: pa.Array, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([tokens, pa.array(n, pa.int64())], ["token", "n"])

    return docs.select(text_col).mapInArrow(run, "token string, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """``tokens``: the end and the most frequent tokens, with counts and
    network ids; ids are in order of frequency, ``id_counts`` theirs."""
    tokens: pa.LargeStringArray
    counts: np.ndarray
    ids: np.ndarray
    end: int
    rare: int
    id_counts: np.ndarray
    n: int
    distinct: int
    rare_n: int
    rare_distinct: int

    @classmethod
    def of(cls, counts: DataFrame, words: int, listed: int) -> Vocabulary:
        n, distinct, ends = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"),
                                       F.coalesce(F.max(F.when(F.col("token") == END, F.col("n"))), F.lit(0))).first()
        rows = sorted(_most_frequent(counts.where(F.col("token") != END), listed, words), key=lambda r: (-r["n"], r["token"]))
        tokens, count = [END] + [r["token"] for r in rows], np.array([ends] + [r["n"] for r in rows], np.int64)
        own = count[:words + 1]                              # the end and the words of the network
        rare_n = int(n - own.sum())
        by_count = np.argsort(-np.append(own, rare_n), kind="stable")
        place = np.empty(len(by_count), np.int64)
        place[by_count] = np.arange(len(by_count))
        ids = np.full(len(tokens), place[-1])
        ids[:len(own)] = place[:-1]
        return cls(pa.array(tokens, pa.large_string()), count, ids, int(place[0]), int(place[-1]),
                   np.append(own, rare_n)[by_count], int(n), int(distinct), rare_n,
                   max(0, int(distinct) - int((own > 0).sum())))

    def base(self, counts: np.ndarray) -> np.ndarray:
        """log10 of the smoothed share of tokens with these counts."""
        return np.log10((counts + SMOOTHING) / (self.n + SMOOTHING * (self.distinct + 1)))

    def among_rare(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + SMOOTHING) / (self.rare_n + SMOOTHING * (self.rare_distinct + 1)))

    def find(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``tokens`` or -1, network id) of words."""
        place = np.asarray(pc.index_in(names, value_set=self.tokens).fill_null(-1)).astype(np.int64)
        return place, np.where(place >= 0, self.ids[place], self.rare)


def _most_frequent(counts: DataFrame, listed: int, words: int) -> list:
    """The tokens from a count on that at most ``listed`` reach, found from
    the numbers of tokens per eighth of a power of two; if they are fewer than
    ``words`` (very many have the same count), the first ``words``."""
    level = F.floor(F.log2("n") * 8).cast("int")
    per_level = dict(counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect())
    total, least = 0, None
    for k in sorted(per_level, reverse=True):
        total += per_level[k]
        if total > listed:
            break
        least = k
    found = 0 if least is None else sum(n for k, n in per_level.items() if k >= least)
    if found < min(words, sum(per_level.values())):
        return counts.orderBy(F.desc("n"), "token").limit(words).collect()
    return counts.where(level >= F.lit(least)).collect() if found else []


# ---------------------------------------------------------------- network

@dataclass
class Network:
    """Weights, the sums of their squared gradients, and the class layout."""
    weights: dict[str, np.ndarray]
    squares: dict[str, np.ndarray]
    class_size: int

    @classmethod
    def new(cls, id_counts: np.ndarray, hidden: int = HIDDEN, embedded: int = EMBEDDED, seed: int = 1) -> Network:
        """Random weights; the output biases are the tokens' frequencies."""
        rng = np.random.default_rng(seed)
        k = len(id_counts)
        size = max(1, int(np.ceil(np.sqrt(k))))
        firsts = np.arange(0, k, size)
        count = id_counts + SMOOTHING
        of_class = np.add.reduceat(count, firsts)

        def normal(*shape: int) -> np.ndarray:
            return rng.normal(0, 1 / np.sqrt(shape[-1]), shape)

        weights = {
            "embed": rng.normal(0, 0.3, (k, embedded)), "input": normal(embedded, 3 * hidden) * np.sqrt(3.0), "state": normal(hidden, 3 * hidden) * np.sqrt(3.0),
            "gates": np.concatenate((np.ones(hidden), np.zeros(2 * hidden))),      # at first the state is kept
            "classes": normal(len(firsts), hidden) * 0.1, "class_bias": np.log(of_class / of_class.sum()),
            "members": normal(k, hidden) * 0.1, "member_bias": np.log(count / of_class[np.arange(k) // size])}
        weights = {name: w.astype(np.float32) for name, w in weights.items()}
        return cls(weights, {name: np.full(w.shape, FIRST_SQUARE, np.float32) for name, w in weights.items()}, size)

    def vector(self) -> np.ndarray:
        return np.concatenate([part[name].ravel() for part in (self.weights, self.squares) for name in self.weights])

    def with_vector(self, v: np.ndarray) -> Network:
        out, at = ({}, {}), 0
        for part in out:
            for name, w in self.weights.items():
                part[name] = v[at:at + w.size].reshape(w.shape).astype(np.float32)
                at += w.size
        return Network(*out, self.class_size)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def gate_inputs(w: dict[str, np.ndarray]) -> np.ndarray:
    """What each id as the previous token adds to the gates."""
    return w["embed"] @ w["input"] + w["gates"]


@np.errstate(over="ignore")                                 # 1 / infinity is the right limit
def forward(w: dict[str, np.ndarray], previous: np.ndarray, keep: np.ndarray, h: np.ndarray, by_id: np.ndarray | None = None):
    """States of a window, and what the gradients need.  ``previous``: (steps,
    lanes) ids; ``keep``: (steps, lanes) 0 where a text begins, else 1; ``h``:
    state before.  ``by_id``: ``gate_inputs`` of weights that stay the same;
    then the states only."""
    steps, size, trace = len(previous), h.shape[1], by_id is None
    if trace:
        x = w["embed"][previous.ravel()]
        gx = x @ w["input"]
        gx += w["gates"]
    else:
        x, gx = None, by_id.take(previous.ravel(), axis=0)
    gx = gx.reshape(steps, -1, 3 * size)
    before, gates, own = (np.empty((steps if trace else 1, len(h), n), np.float32) for n in (size, 2 * size, size))
    fresh, states = (np.empty((steps, len(h), size), np.float32) for _ in range(2))
    gh = np.empty((len(h), 3 * size), np.float32)
    for t in range(steps):
        k = t if trace else 0
        h = np.multiply(h, keep[t, :, None], out=before[k])
        np.matmul(h, w["state"], out=gh)
        zr = _sigmoid(np.add(gx[t, :, :2 * size], gh[:, :2 * size], out=gates[k]))
        own[k] = gh[:, 2 * size:]
        n = np.multiply(zr[:, size:], own[k], out=fresh[t])
        n += gx[t, :, 2 * size:]
        np.tanh(n, out=n)
        after = np.subtract(h, n, out=states[t])
        after *= zr[:, :size]
        after += n
        h = after
    return states, (x, before, gates, fresh, own)


def _shares(states: np.ndarray, w: np.ndarray, bias: np.ndarray, training: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(exponentials, their sums) of the states' logits; rows with very large
    logits are scaled down first.  Training, which would carry another rounding
    on, adds in numpy's order; scoring by a product, as sums of short rows are slow."""
    def logits() -> np.ndarray:
        z = states @ w.T
        z += bias
        return z

    def sums_of(e: np.ndarray) -> np.ndarray:
        return e.sum(axis=1) if training else e @ np.ones(len(bias), bias.dtype)

    e = logits()
    sums = sums_of(np.exp(e, out=e))
    if not (sums.min(initial=1.0) >= 1e-30 and sums.max(initial=1.0) < np.inf):
        e = logits()
        e -= e.max(axis=1, keepdims=True)
        sums = sums_of(np.exp(e, out=e))
    return e, sums


@np.errstate(over="ignore")                                 # such rows are scaled down
def outputs(net: Network, states: np.ndarray, targets: np.ndarray, grads: dict[str, np.ndarray] | None = None, scale: float = 0.0):
    """(log probability of each target, gradient of the states): the class,
    then the member of the class, whose rows are taken class by class.  With
    ``grads``, gradients of minus the log probabilities times ``scale``."""
    w, size = net.weights, net.class_size
    cls = targets // size
    order = np.argsort(cls, kind="stable")
    cuts = np.searchsorted(cls[order], np.arange(int(cls.max(initial=-1)) + 2))
    states, member, cls = states[order], (targets - cls * size)[order], cls[order]
    e, sums = _shares(states, w["classes"], w["class_bias"], grads is not None)
    rows = np.arange(len(cls))
    share, back = e[rows, cls] / sums, None

    def wrong(e: np.ndarray, sums: np.ndarray, at: np.ndarray) -> np.ndarray:
        e *= (scale / sums)[:, None]
        e[rows[:len(at)], at] -= scale
        return e

    if grads is not None:
        d = wrong(e, sums, cls)
        grads["classes"], grads["class_bias"] = d.T @ states, d.sum(axis=0)
        back = d @ w["classes"]
        grads["members"], grads["member_bias"] = np.zeros_like(w["members"]), np.zeros_like(w["member_bias"])
    for c in np.flatnonzero(np.diff(cuts)):
        at, block = slice(cuts[c], cuts[c + 1]), slice(c * size, (c + 1) * size)
        own = states[at]
        e, sums = _shares(own, w["members"][block], w["member_bias"][block], grads is not None)
        share[at] *= e[rows[:len(own)], member[at]] / sums
        if grads is not None:
            d = wrong(e, sums, member[at])
            grads["members"][block], grads["member_bias"][block] = d.T @ own, d.sum(axis=0)
            back[at] += d @ w["members"][block]
    out = np.empty_like(share)
    out[order] = np.log(share)
    if back is not None:
        d, back = back, np.empty_like(back)
        back[order] = d
    return out, back


def gradients(net: Network, previous: np.ndarray, targets: np.ndarray, keep: np.ndarray, live: np.ndarray, h: np.ndarray):
    """(log probabilities of the live targets, state after, gradients of their
    negative mean) of a window; the gradients stop at its first step.  The
    embedding's are (ids, rows)."""
    w, size = net.weights, h.shape[1]
    states, (x, before, gates, fresh, own) = forward(w, previous, keep, h)
    at = np.flatnonzero(live.ravel())
    grads: dict[str, np.ndarray] = {}
    logs, back = outputs(net, states.reshape(-1, size)[at], targets.ravel()[at], grads, 1 / max(1, len(at)))
    ds = np.zeros((states.size // size, size), np.float32)
    ds[at] = back
    ds = ds.reshape(states.shape)
    z, r = gates[:, :, :size], gates[:, :, size:]
    rest, to_fresh, to_z, to_r = 1 - z, fresh * fresh, before - fresh, own * r       # slopes of the state by each input
    np.subtract(1, to_fresh, out=to_fresh)
    to_fresh *= rest
    to_z *= z
    to_z *= rest
    to_r *= np.subtract(1, r, out=rest)
    d_in, d_state = (np.empty((len(states), len(h), 3 * size), np.float32) for _ in range(2))
    dh, back_state = np.zeros_like(h), np.ascontiguousarray(w["state"].T)
    for t in range(len(states) - 1, -1, -1):
        dh += ds[t]
        dn = np.multiply(dh, to_fresh[t], out=d_in[t, :, 2 * size:])
        np.multiply(dh, to_z[t], out=d_in[t, :, :size])
        np.multiply(dn, to_r[t], out=d_in[t, :, size:2 * size])
        d_state[t, :, :2 * size] = d_in[t, :, :2 * size]
        np.multiply(dn, r[t], out=d_state[t, :, 2 * size:])
        dh *= z[t]
        dh += d_state[t] @ back_state
        dh *= keep[t, :, None]
    d_in, d_state = d_in.reshape(-1, 3 * size), d_state.reshape(-1, 3 * size)
    grads["state"] = before.reshape(-1, size).T @ d_state
    grads["input"], grads["gates"] = x.T @ d_in, d_in.sum(axis=0)
    ids = previous.ravel()
    order = np.argsort(ids, kind="stable")
    firsts = np.flatnonzero(np.diff(ids[order], prepend=-1))
    grads["embed"] = (ids[order][firsts], np.add.reduceat((d_in @ w["input"].T)[order], firsts, axis=0))
    return logs, states[-1], grads


def update(net: Network, grads: dict, rate: float) -> None:
    """A step of every weight, by the root of its summed squared gradients."""
    for name, g in grads.items():
        if name == "embed":
            ids, g = g
            net.squares[name][ids] += g * g
            net.weights[name][ids] -= rate * g / np.sqrt(net.squares[name][ids])
        else:
            net.squares[name] += g * g
            net.weights[name] -= rate * g / np.sqrt(net.squares[name])


@dataclass
class Lanes:
    """Texts laid end to end on lanes, the fullest lane first.  A text's end
    is the token before the next one, so that a text begins where the previous
    token is the end."""
    targets: np.ndarray                                     # (lanes, steps) ids
    loads: np.ndarray
    starts: np.ndarray                                      # of each text, in the flattened targets
    sizes: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, offsets: np.ndarray, lanes: int, order: np.ndarray, filler: int) -> Lanes:
        """Texts in the given order, each on the emptiest lane."""
        sizes = np.diff(offsets)
        heap = [(0, k) for k in range(min(lanes, len(sizes)))]
        place = np.empty((len(sizes), 2), np.int64)
        for d, n in zip(order.tolist(), sizes[order].tolist()):
            load, lane = heapq.heappop(heap)
            place[d] = lane, load
            heapq.heappush(heap, (load + n, lane))
        loads = np.zeros(len(heap), np.int64)
        for load, lane in heap:
            loads[lane] = load
        rank = np.empty(len(loads), np.int64)
        by_load = np.argsort(-loads, kind="stable")
        rank[by_load] = np.arange(len(loads))
        targets = np.full((len(loads), int(loads.max(initial=0))), filler, np.uint16)
        for d, (lane, at) in enumerate(place.tolist()):
            targets[rank[lane], at:at + sizes[d]] = ids[offsets[d]:offsets[d + 1]]
        return cls(targets, loads[by_load], rank[place[:, 0]] * targets.shape[1] + place[:, 1], sizes)

    def windows(self, end: int, window: int) -> Iterator[tuple]:
        """(first step, previous, targets, keep, live), steps first, of the
        lanes that aren't at their end."""
        for t in range(0, self.targets.shape[1], window):
            n = int(np.searchsorted(-self.loads, -t, "left"))
            targets = self.targets[:n, t:t + window].astype(np.int64).T
            previous = np.empty_like(targets)
            previous[1:] = targets[:-1]
            previous[0] = self.targets[:n, t - 1] if t else end
            live = (t + np.arange(len(targets)))[:, None] < self.loads[:n]
            yield t, previous, targets, (previous != end).astype(np.float32), live


def train(net: Network, ids: np.ndarray, offsets: np.ndarray, end: int, rng: np.random.Generator, lanes: int, window: int, rate: float) -> float:
    """Go through texts once; the sum of log probabilities before each step."""
    most = max(1, len(ids) // int(np.diff(offsets).max()))  # more lanes than that would be empty for long
    laid = Lanes.of(ids, offsets, min(lanes, most), rng.permutation(len(offsets) - 1), end)
    h, total = np.zeros((len(laid.loads), net.weights["state"].shape[0]), np.float32), 0.0
    for _, previous, targets, keep, live in laid.windows(end, window):
        logs, h, grads = gradients(net, previous, targets, keep, live, h[:previous.shape[1]])
        update(net, grads, rate)
        total += float(logs.sum())
    return total


def log_probabilities(net: Network, ids: np.ndarray, offsets: np.ndarray, end: int, lanes: int = SCORING_LANES, window: int = WINDOW) -> np.ndarray:
    """Natural log probability of each whole text."""
    sizes = np.diff(offsets)
    laid = Lanes.of(ids, offsets, lanes, np.argsort(-sizes, kind="stable"), end)
    logs = np.zeros(laid.targets.shape, np.float64)
    h, by_id = np.zeros((len(laid.loads), net.weights["state"].shape[0]), np.float32), gate_inputs(net.weights)
    for t, previous, targets, keep, live in laid.windows(end, window):
        states, _ = forward(net.weights, previous, keep, h[:previous.shape[1]], by_id)
        h = states[-1]
        at = np.flatnonzero(live.ravel())
        values = np.zeros(live.size)
        values[at], _ = outputs(net, states.reshape(-1, h.shape[1])[at], targets.ravel()[at])
        logs[:live.shape[1], t:t + len(live)] = values.reshape(live.shape).T
    sums = np.concatenate(([0.0], np.cumsum(logs.ravel())))
    return sums[laid.starts + sizes] - sums[laid.starts]


# ---------------------------------------------------------------- on Spark

@dataclass
class LanguageModel:
    counts: DataFrame                                       # (token, n) of the training texts, written
    vocabulary: Vocabulary
    network: Network


def _encode(s: bytewords.ByteSlice, vocabulary: Vocabulary):
    """(words, place of each name among the listed tokens, ids, offsets):
    token ids of the texts with their ends."""
    w = cut(s)
    place, id_of = vocabulary.find(w.names)
    sizes = np.bincount(w.text, minlength=s.n) + 1
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    ids = np.full(offsets[-1], vocabulary.end, np.uint16)
    ids[np.arange(len(w.number)) + w.text] = id_of[w.number]
    return w, place, ids, offsets


def fit(docs: DataFrame, text_col: str = "text", words: int = WORDS, listed: int = LISTED, hidden: int = HIDDEN, embedded: int = EMBEDDED,
        rounds: int = ROUNDS, lanes: int = LANES, window: int = WINDOW, rate: float = RATE, part_tokens: int = PART_TOKENS,
        least_tokens: int = LEAST_TOKENS, seed: int = 1) -> LanguageModel:
    """Learn from all the texts given."""
    if not 0 < words <= min(listed, (1 << 16) - 2):
        raise ValueError("words must be positive, at most listed, and leave ids of 16 bits")
    spark = docs.sparkSession
    counts = materialize(count_tokens(docs, text_col), "tokens")
    vocabulary = Vocabulary.of(counts, words, listed)
    net = Network.new(vocabulary.id_counts, hidden, embedded, seed)
    if not vocabulary.n:
        return LanguageModel(counts, vocabulary, net)
    shared = spark.sparkContext.broadcast(vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in bytewords.byte_slices(b.column(0)):
                _, _, ids, offsets = _encode(s, shared.value)
                column = pa.Array.from_buffers(pa.large_binary(), s.n, [None, pa.py_buffer(offsets * 2), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([column.cast(pa.binary())], ["ids"])
        pa.default_memory_pool().release_unused()

    path = scratch_path(spark, "ids")
    (docs.select(text_col).mapInArrow(encode, "ids binary")
     .withColumn("round", F.pmod(F.monotonically_increasing_id(), F.lit(rounds)).cast("int")).write.partitionBy("round").parquet(path))
    encoded = spark.read.schema("ids binary, round int").parquet(path)
    passes = -(-least_tokens // vocabulary.n)
    parts = -(-vocabulary.n // (rounds * part_tokens))
    for k in range(rounds):
        average = _average(encoded.where(F.col("round") == k).select("ids").coalesce(parts)
                           .mapInArrow(_trainer(spark.sparkContext.broadcast(net), vocabulary.end, passes, lanes, window, rate, seed + k),
                                       "chunk int, weight double, part binary"))
        if average is not None:
            net = net.with_vector(average)
    return LanguageModel(counts, vocabulary, net)


def _trainer(shared, end: int, passes: int, lanes: int, window: int, rate: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value.with_vector(shared.value.vector().copy())
        rng = np.random.default_rng(seed)
        tokens = 0
        for ids, offsets in _groups(batches):
            tokens += len(ids)
            for _ in range(passes):
                train(net, ids, offsets, end, rng, lanes, window, rate)
        if tokens:
            parts = np.array_split(net.vector(), CHUNKS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(CHUNKS), pa.int32()), pa.array([float(tokens)] * CHUNKS), pa.array([p.tobytes() for p in parts], pa.binary())],
                ["chunk", "weight", "part"])

    return run


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, offsets) of about ``GROUP_TOKENS`` tokens of texts."""
    texts, size = [], 0
    for b in batches:
        for ids in b.column(0):
            texts.append(np.frombuffer(ids.as_buffer(), np.uint16))
            size += len(texts[-1])
            if size >= GROUP_TOKENS:
                yield np.concatenate(texts), np.concatenate(([0], np.cumsum([len(t) for t in texts])))
                texts, size = [], 0
    if texts:
        yield np.concatenate(texts), np.concatenate(([0], np.cumsum([len(t) for t in texts])))


def _average(rows: DataFrame) -> np.ndarray | None:
    """Weighted mean of the tasks' vectors, slice by slice; a task that adds
    holds sums of its slices only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for b in batches:
            for chunk, weight, part in zip(*(c.to_pylist() for c in b.columns)):
                v = np.frombuffer(part, np.float32).astype(np.float64) * weight
                have = sums.setdefault(chunk, [0.0, 0.0])
                have[0] += weight
                have[1] = have[1] + v
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(sums, pa.int32()), pa.array([(v / n).astype(np.float32).tobytes() for n, v in sums.values()], pa.binary())], ["chunk", "part"])

    found = rows.repartition(CHUNKS, "chunk").mapInArrow(run, "chunk int, part binary").collect()
    return np.concatenate([np.frombuffer(r["part"], np.float32) for r in sorted(found, key=lambda r: r["chunk"])]) if found else None


def score(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every
    text: its tokens, those that training texts have, and log10 probabilities
    by word frequency and by the network."""
    spark, v = docs.sparkSession, model.vocabulary
    shared = spark.sparkContext.broadcast((v, model.network))
    one = pa.struct([("token", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, net = shared.value
        base, rare = v.base(v.counts), np.where(v.ids == v.rare, v.among_rare(v.counts), 0.0)
        for b in batches:
            for s in bytewords.byte_slices(b.column(1), GROUP_BYTES):
                w, place, ids, offsets = _encode(s, v)
                value = log_probabilities(net, ids, offsets, v.end) / np.log(10)
                at = place[w.number]
                hit = at >= 0

                def per_text(values: np.ndarray) -> np.ndarray:
                    return np.bincount(w.text[hit], values[at[hit]], s.n)

                other = np.flatnonzero(~hit)
                key, n = np.unique(w.text[other] * np.int64(len(w.names) + 1) + w.number[other], return_counts=True)
                text, name = key // (len(w.names) + 1), key % (len(w.names) + 1)
                others = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(text, np.arange(s.n + 1)), pa.int32()),
                    pa.StructArray.from_arrays([w.names.take(name).cast(pa.string()), pa.array(n, pa.int64())], ["token", "n"]))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(s.first, s.n), pa.array(np.diff(offsets)), pa.array(np.bincount(w.text[hit], minlength=s.n) + int(v.counts[0] > 0)),
                     pa.array(per_text(base) + base[0]), pa.array(value + per_text(rare)), others.cast(pa.list_(one))],
                    ["doc_id", "n_tokens", "n_listed", "base", "score", "others"])
        pa.default_memory_pool().release_unused()

    scored = materialize(
        docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCORED)
        .withColumn("row", F.monotonically_increasing_id()), "scored")
    c, n = F.coalesce(F.col("c"), F.lit(0)), F.col("n")

    def logs(total: int, distinct: int) -> Column:
        return F.sum(n * F.log10((c + SMOOTHING) / (total + SMOOTHING * (distinct + 1))))

    # tokens that aren't listed have at most the count of the last one that is
    unlisted = model.counts.where(F.col("n") <= (int(v.counts[-1]) if len(v.counts) > 1 else 0)).select("token", F.col("n").alias("c"))
    others = (scored.select("row", F.explode("others").alias("other")).select("row", "other.token", "other.n")
              .join(unlisted, "token", "left").groupBy("row")
              .agg(F.sum(F.when(c > 0, n).otherwise(0)).alias("n_more"), logs(v.n, v.distinct).alias("base_more"),
                   logs(v.rare_n, v.rare_distinct).alias("score_more")))
    zero = F.lit(0)
    return scored.join(others, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_listed") + F.coalesce("n_more", zero)).alias("n_known"), F.lit(v.n).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_more", zero)).alias("base_score"), (F.col("score") + F.coalesce("score_more", zero)).alias("score"))
