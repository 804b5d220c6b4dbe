"""Toxicity: the decoder on known disguises and against all paths, held-out accuracy."""

import itertools
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.llm import textvec, toxicity
from llm_cases import MESSY


@pytest.fixture(scope="module")
def letters(fixture_table):
    return toxicity.fit_letters(fixture_table("documents"))


def read(text, letters):
    s = next(textvec.slices([text]))
    return [w for *_, w in toxicity.restore(text, [(b, e) for _, b, e in toxicity.suspects(s)], letters, {})]


@pytest.mark.parametrize("hidden, word", [
    ("id1ot", "idiot"), ("1diot", "idiot"), ("st*pid", "stupid"), ("$tupid", "stupid"), ("stuuupid", "stupid"), ("m0r0n", "moron"),
    ("tr4sh", "trash"), ("s t u p i d", "stupid"), ("s.c.u.m", "scum"), ("s-t-u-p-i-d", "stupid"),
    ("d i s g u s t i n g", "disgusting"), ("w.o.r.t.h.l.e.s.s", "worthless")])
def test_disguises(hidden, word, letters):
    assert read(f"of the {hidden} in it.", letters) == [word]


@pytest.mark.parametrize("hidden, word", [
    ("worthle$$", "worthless"), ("w0rthle$$", "worthless"), ("mo-ron", "moron"), ("id.iot", "idiot"), ("iiddiioott", "idiot"), ("s u m", "sum")])
def test_more_disguises(hidden, word, letters):
    assert read(f"of the {hidden} in it.", letters) == [word]
    assert read("Oh the idiot! And the end.", letters) in ([], ["idiot"])


def test_clean_text_has_one_path(letters):
    assert read("The theory of it, and so on. 12 of 30 a b", letters) == []


def test_decode_equals_all_paths(letters):
    def cost(pieces):
        a = b = 0
        total = 0.0
        for text, extra in pieces:
            total += extra
            for ch in text:
                z = toxicity.symbol_table()[ord(ch)]
                if z or b:
                    total += letters[a, b, z]
                a, b = (b, z) if z else (0, 0)
        return total + (letters[a, b, 0] if b else 0)

    for token in ("1d10t", "st*pid", "a.b.c", "ooops", "l0$er", "x-y z"):
        best = min(cost(p) for p in itertools.product(*toxicity.lattice(token)))
        text = toxicity.decode(token, letters)
        same = [p for p in itertools.product(*toxicity.lattice(token)) if " ".join("".join(t for t, _ in p).split()) == text]
        assert min(map(cost, same)) == pytest.approx(best)


def test_held_out(spark):
    from kiln.llm.queries import QUERIES
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op5_toxicity"](spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert len(got) == 10_000 and got.score.between(0, 1).all()
    hit = held.predicted[held.toxic == 1].mean()
    assert hit > 0.85 and held.predicted[held.toxic == 0].mean() < 0.02


def test_messy_rows(spark, messy, nothing):
    labels = spark.createDataFrame([(4, 1, "z"), (4, 0, "z"), (6, 0, None), (None, 1, "z"), (9, None, "z")], "doc_id bigint, toxic int, word string")
    model = toxicity.fit(messy, labels)
    rows = toxicity.score(messy, model).collect()
    assert [r.doc_id for r in rows] == [r[0] for r in MESSY]
    assert all(0 <= r.score <= 1 for r in rows)
    blank = toxicity.fit(nothing, labels.limit(0))
    assert np.isfinite(toxicity.score(messy, blank).agg(F.sum("score")).first()[0])
    assert toxicity.score(nothing, model).count() == 0


def slow_suspects(s):
    """Token by token and character by character, as the rule is stated."""
    kinds = toxicity._kinds()
    out = set()
    for d, text in enumerate(s.texts):
        kind = [int(kinds[ord(c)]) for c in text]
        letter, imitation = [k & 1 for k in kind], [k & 2 for k in kind]
        edge = [bool(k & 4) or ord(c) <= 32 for k, c in zip(kind, text)]
        n = len(text)
        single = [(letter[i] or imitation[i]) and (i == n - 1 or edge[i + 1]) and (i == 0 or edge[i - 1]) for i in range(n)]
        found = {}
        for i in range(n):
            spelled = i >= 4 and single[i] and single[i - 2] and single[i - 4]
            marked = spelled or (imitation[i] and (i + 1 < n and letter[i + 1] or i and letter[i - 1])) \
                or (kind[i] & 4 and ord(text[i]) > 32 and 0 < i < n - 1 and letter[i - 1] and letter[i + 1]) \
                or (i >= 3 and letter[i] and text[i] == text[i - 1] and text[i - 2] == text[i - 3] and letter[i - 2]) \
                or (i >= 2 and letter[i] and text[i] == text[i - 1] == text[i - 2])
            if not marked:
                continue
            a, z = i, i + 1
            if spelled:
                while a >= 2 and single[a - 2]:
                    a -= 2
                while z + 1 < n and single[z + 1]:
                    z += 2
            else:
                while a and not text[a - 1].isspace():
                    a -= 1
                while z < n and not text[z].isspace():
                    z += 1
            found[a] = max(found.get(a, 0), z)
        out |= {(d, a, z) for a, z in found.items()}
    return sorted(out)


def test_suspects_as_stated():
    rng = np.random.default_rng(3)
    letters = list("aab1$ .-_*!é\n\t\u00a0")
    for _ in range(300):
        texts = ["".join(rng.choice(letters, rng.integers(0, 25))) for _ in range(4)]
        s = next(textvec.slices(texts))
        assert toxicity.suspects(s) == slow_suspects(s), texts


@pytest.mark.parametrize("token", ["a" * 1_000_000, "a b c d e " * 100_000, "ab-" * 333_333, "QUJDREVGR0hJ" * 83_333, "1!" * 500_000, "-" * 1_000_000 + "a1"],
                         ids=["one letter", "spaced", "hyphens", "base64", "imitations", "separators"])
def test_a_token_of_a_million_characters(token, letters):
    begin = time.process_time()
    read(f"of the {token} in it", letters)
    assert time.process_time() - begin < 60


def test_weights_as_counted(spark, fixture_table, letters):
    """Word weights from plain counts of contexts over the same texts."""
    rows = [(k, "the fool is here" if k % 2 else f"the {w} is here", k % 2) for k, w in enumerate(["cat", "dog", "sun", "sky"] * 10)]
    name = lambda k: "".join(("ba", "ce", "di", "fo", "gu", "ha", "je", "ki", "lo", "mu")[int(d)] for d in str(k))
    rows += [(1000 + k, f"{name(k)} fool {name(k + 500)}", 1) for k in range(150)] + [(2000 + k, f"{name(k)} tree {name(k + 500)}", 0) for k in range(150)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    seen = {}
    for _, text, toxic in rows:
        words = text.split()
        for i, w in enumerate(words):
            context = (words[i - 1] if i else None, words[i + 1] if i + 1 < len(words) else None)
            seen.setdefault(w, set()).add((toxic, context))
    t = {w: sum(x for x, _ in c) for w, c in seen.items()}
    c = {w: len(v) - t[w] for w, v in seen.items()}
    whole = np.log((sum(t.values()) + 1) / (sum(c.values()) + 1))
    want = {}
    for w in seen:
        odds = np.log((t[w] + 0.5) / (c[w] + 0.5)) - whole
        if t[w] >= 3 and odds > 1.5 and odds / np.sqrt(1 / (t[w] + 0.5) + 1 / (c[w] + 0.5)) >= 3.2:
            want[int(toxicity.word_hashes(w)[0])] = odds
    assert want and dict(zip(model.words.tolist(), model.weights.tolist())) == pytest.approx(want)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    for d, text, _ in rows:
        total = model.bias + model.scale * sum({w: want.get(int(toxicity.word_hashes(w)[0]), 0.0) for w in set(text.split())}.values())
        assert got[d] == pytest.approx(1 / (1 + np.exp(-total)))
