"""Language model: gradients against differences, scores against plain loops,
the base against brute force, held-out gain, and defined cases."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.llm import gru_lm
from llm_cases import MESSY, documents

LOWER = {c: c + 32 for c in range(65, 91)}


def tokens_of(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER)) + [""]


def small(k=11, hidden=5, embedded=4, seed=3):
    net = gru_lm.Network.new(np.arange(k, 0, -1) * 3, hidden, embedded, seed)
    return net


def texts_of(rng, k, n):
    sizes = rng.integers(1, 30, n)
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    ids = rng.integers(1, k, offsets[-1]).astype(np.uint16)
    ids[offsets[1:] - 1] = 0                                # the end
    return ids, offsets


def plain(net, ids, offsets):
    """One text after another, one token after another, in double precision."""
    w = {name: x.astype(float) for name, x in net.weights.items()}
    size, out = w["state"].shape[0], []
    for a, b in zip(offsets, offsets[1:]):
        h, previous, total = np.zeros(size), 0, 0.0
        for token in ids[a:b].tolist():
            gx, gh = w["embed"][previous] @ w["input"] + w["gates"], h @ w["state"]
            z, r = (1 / (1 + np.exp(-(gx + gh)[k * size:(k + 1) * size])) for k in (0, 1))
            n = np.tanh(gx[2 * size:] + r * gh[2 * size:])
            h = (1 - z) * n + z * h
            c = token // net.class_size
            block = slice(c * net.class_size, (c + 1) * net.class_size)
            for logits, k in ((w["classes"] @ h + w["class_bias"], c), (w["members"][block] @ h + w["member_bias"][block], token - block.start)):
                total += logits[k] - np.log(np.exp(logits).sum())
            previous = token
        out.append(total)
    return np.array(out)


@pytest.mark.parametrize("lanes, window", [(1, 1), (3, 4), (16, 64)])
def test_whole_texts_as_a_plain_loop(lanes, window):
    net, (ids, offsets) = small(), texts_of(np.random.default_rng(0), 11, 20)
    assert np.allclose(gru_lm.log_probabilities(net, ids, offsets, 0, lanes, window), plain(net, ids, offsets), rtol=1e-4)


def test_outputs_are_a_distribution():
    net = small()
    h = np.random.default_rng(1).normal(size=(1, 5)).astype(np.float32)
    logs, _ = gru_lm.outputs(net, np.repeat(h, 11, axis=0), np.arange(11))
    assert abs(np.exp(logs).sum() - 1) < 1e-5


def test_gradients_as_differences():
    net, rng = small(), np.random.default_rng(2)
    ids, offsets = texts_of(rng, 11, 6)
    laid = gru_lm.Lanes.of(ids, offsets, 3, np.arange(6), 0)
    _, previous, targets, keep, live = next(laid.windows(0, 12))
    h = rng.normal(size=(previous.shape[1], 5)).astype(np.float32)
    _, _, grads = gru_lm.gradients(net, previous, targets, keep, live, h)
    rows, values = grads["embed"]
    grads["embed"] = np.zeros_like(net.weights["embed"])
    grads["embed"][rows] = values

    def loss():
        states, _ = gru_lm.forward(net.weights, previous, keep, h)
        at = np.flatnonzero(live.ravel())
        return -float(gru_lm.outputs(net, states.reshape(-1, 5)[at], targets.ravel()[at])[0].astype(float).mean())

    for name, w in net.weights.items():
        flat = w.reshape(-1)
        for k in rng.choice(len(flat), min(8, len(flat)), replace=False):
            old, step = flat[k], np.float32(2e-2)
            flat[k] = old + step
            up = loss()
            flat[k] = old - step
            down = loss()
            flat[k] = old
            assert abs((up - down) / (2 * step) - grads[name].reshape(-1)[k]) < 2e-3, name


def test_training_learns_an_order():
    """Each token follows from the one before."""
    rng = np.random.default_rng(5)
    sizes = rng.integers(2, 40, 400)
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    ids = np.zeros(offsets[-1], np.uint16)
    for a, b in zip(offsets, offsets[1:]):
        ids[a:b - 1] = 1 + (rng.integers(10) + 3 * np.arange(b - a - 1)) % 10
    net = small()
    before = gru_lm.log_probabilities(net, ids, offsets, 0).sum() / len(ids)
    for _ in range(30):
        gru_lm.train(net, ids, offsets, 0, rng, 16, 8, 0.1)
    after = gru_lm.log_probabilities(net, ids, offsets, 0).sum() / len(ids)
    assert before < -2 and after > -0.6


def test_query_base_and_gain(result, fixture_table):
    got = result("op12_language_model").set_index("doc_id")
    docs = fixture_table("documents").toPandas()
    assert len(got) == len(docs)
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d in docs.doc_id}
    tokens = {d: tokens_of(t) for d, t in zip(docs.doc_id, docs.text)}
    counts = Counter(t for d, ts in tokens.items() if not held[d] for t in ts)
    n = sum(counts.values())
    for d, ts in tokens.items():
        row = got.loc[d]
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (held[d], len(ts), sum(t in counts for t in ts), n)
        assert math.isclose(row.base_score, sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (len(counts) + 1))) for t in ts), rel_tol=1e-9)
    out = got[got.held_out]
    assert (got.score < 0).all()
    assert out.score.sum() / out.n_tokens.sum() > out.base_score.sum() / out.n_tokens.sum() + 0.15


def test_listed_or_joined_tokens_give_the_same(spark, fixture_table):
    """Words beyond the listed ones get their counts by a join, with the same result."""
    docs = fixture_table("documents").limit(60)
    few = gru_lm.fit(docs, words=50, listed=60, least_tokens=1, rounds=1)
    many = gru_lm.LanguageModel(few.counts, gru_lm.Vocabulary.of(few.counts, 50, 100_000), few.network)
    a, b = ({r.doc_id: r for r in gru_lm.score(docs, m).collect()} for m in (few, many))
    for d, r in a.items():
        assert (r.n_known, r.n_tokens) == (b[d].n_known, b[d].n_tokens)
        assert math.isclose(r.base_score, b[d].base_score, rel_tol=1e-9) and math.isclose(r.score, b[d].score, rel_tol=1e-6)


def test_probabilities_of_words_add_up(spark):
    """Over all one-word texts of known words, rare ones included, and what is left for unknown ones."""
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(["a a a b b c d", "a b e f"])], "doc_id bigint, text string")
    model = gru_lm.fit(docs, words=2, listed=3, least_tokens=1, rounds=1)
    words = ["", *"abcdef", "unknown"]
    texts = spark.createDataFrame([(k, w) for k, w in enumerate(words)], "doc_id bigint, text string")
    end = gru_lm.score(texts.where("doc_id = 0"), model).first().score      # of the end at once
    v = model.vocabulary
    rows = gru_lm.score(texts.where("doc_id > 0"), model).collect()
    assert v.distinct == 7 and v.rare_distinct == 4
    states, _ = gru_lm.forward(model.network.weights, np.array([[v.end]]), np.zeros((1, 1), np.float32), np.zeros((1, gru_lm.HIDDEN), np.float32))
    ids = np.arange(len(v.id_counts))
    first = np.exp(gru_lm.outputs(model.network, np.repeat(states[0], len(ids), axis=0), ids)[0])
    assert abs(first.sum() - 1) < 1e-5 and math.isclose(math.log10(first[v.end]), end, rel_tol=1e-4)
    shares = sum(10 ** float(v.among_rare(np.array([c]))[0]) for c in (1, 1, 1, 1, 0))
    assert abs(shares - 1) < 1e-9 and len(rows) == 7


def test_parts_are_averaged_by_tokens(spark):
    rows = [(k, w, np.full(3, v, np.float32).tobytes()) for k in (1, 0) for w, v in ((1.0, 2.0 + k), (3.0, 6.0))]
    df = spark.createDataFrame([(k, w, bytearray(p)) for k, w, p in rows], "chunk int, weight double, part binary")
    assert gru_lm._average(df).tolist() == [5.0] * 3 + [5.25] * 3
    assert gru_lm._average(df.where("false")) is None


def test_several_parts_and_rounds(spark, fixture_table):
    docs = fixture_table("documents").repartition(5, "doc_id")
    model = gru_lm.fit(docs, part_tokens=3_000)
    got = gru_lm.score(docs, model).agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert got[0] / got[2] > got[1] / got[2] + 0.1


def test_messy_rows(spark, messy, nothing):
    model = gru_lm.fit(messy, least_tokens=1)
    rows = gru_lm.score(messy, model).collect()
    assert len(rows) == len(MESSY)
    for r in rows:
        assert r.score < 0 and r.base_score < 0
    by_text = {(d, t): len(tokens_of(t)) for d, t, _, _ in MESSY}
    assert sorted(r.n_tokens for r in rows) == sorted(len(tokens_of(t)) for _, t, _, _ in MESSY) and by_text
    assert [r.n_tokens for r in rows if r.doc_id in (1, 2, 3)] == [1, 1, 1]
    empty = gru_lm.fit(nothing)
    rows = gru_lm.score(messy, empty).collect()
    assert {(r.n_known, r.train_tokens) for r in rows} == {(0, 0)} and all(abs(r.base_score) < 1e-9 and math.isfinite(r.score) for r in rows)
    assert gru_lm.score(nothing, model).count() == 0


def test_a_long_token(spark):
    docs = documents(spark, [(1, "x" * 3_000_000, "en", "a"), (2, "x " * 30_000, "en", "a")])
    rows = {r.doc_id: r.n_tokens for r in gru_lm.score(docs, gru_lm.fit(docs, least_tokens=1)).collect()}
    assert rows == {1: 2, 2: 30_001}


def test_scoring_takes_the_gates_by_id():
    """Unchanged weights are multiplied once per id, not once per token; large logits are scaled down."""
    rng = np.random.default_rng(3)
    net = gru_lm.Network.new(np.array([50, 30, 20, 10, 5, 5, 2, 1]), 4, 3)
    previous, keep, h = rng.integers(0, 8, (5, 6)), np.ones((5, 6), np.float32), rng.normal(size=(6, 4)).astype(np.float32)
    plain, _ = gru_lm.forward(net.weights, previous, keep, h)
    by_id, _ = gru_lm.forward(net.weights, previous, keep, h, gru_lm.gate_inputs(net.weights))
    np.testing.assert_allclose(by_id, plain, rtol=0, atol=1e-6)
    states = rng.normal(size=(9, 4)).astype(np.float32)
    net.weights["classes"] *= np.float32(1e4)
    z = states.astype(float) @ net.weights["classes"].T.astype(float) + net.weights["class_bias"]
    e, sums = gru_lm._shares(states, net.weights["classes"], net.weights["class_bias"])
    want = np.exp(z - z.max(axis=1, keepdims=True))
    np.testing.assert_allclose(e / sums[:, None], want / want.sum(axis=1, keepdims=True), atol=1e-2)
