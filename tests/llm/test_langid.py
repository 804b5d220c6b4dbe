"""Language ID: Viterbi against enumeration, held-out accuracy, defined cases."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from kiln.llm import langid
from llm_cases import MESSY


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(0)
    for _ in range(40):
        counts = rng.integers(0, 6, 4)
        scores = rng.normal(0, 3, (counts.sum(), 3)).astype(np.float32)
        firsts = np.cumsum(counts) - counts
        got = langid.viterbi(scores, firsts, counts, 2.0)
        for a, n in zip(firsts, counts):
            def value(path):
                return sum(scores[a + t, k] for t, k in enumerate(path)) - 2.0 * sum(x != y for x, y in zip(path, path[1:]))
            if n:
                best = max(value(p) for p in itertools.product(range(3), repeat=int(n)))
                assert abs(value(got[a:a + n]) - best) < 1e-4


def test_viterbi_of_many_labels_and_steps():
    """Over 127 labels, and sums beyond what single precision resolves."""
    scores = np.full((600, 300), -5.0, np.float32)
    scores[:300, 299] = scores[300:, 150] = 0.0
    got = langid.viterbi(scores, np.array([0]), np.array([600]), 12.0)
    assert (got[:300] == 299).all() and (got[300:] == 150).all()
    n = 400_000
    scores = np.full((n, 2), -60.0, np.float32)             # both sums reach -24 million, where steps are 2
    scores[:, 0] += 0.25
    scores[n // 2:, 1] += 0.5
    got = langid.viterbi(scores, np.array([0]), np.array([n]), 12.0)
    assert (got[:n // 2] == 0).all() and (got[n // 2:] == 1).all()


def test_held_out_accuracy(result, fixture_table):
    got = result("op3_language_id").merge(fixture_table("documents").toPandas()[["doc_id", "lang"]], on="doc_id")
    assert len(got) == fixture_table("documents").count()
    held = got[got.held_out & got.lang.notna()]
    assert len(held) > 30 and (held.lang_pred == held.lang).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_spans_of_mixed_text(spark, fixture_table):
    docs = fixture_table("documents")
    model = langid.fit(docs)
    en, fr = (docs.where(F.col("lang") == k).orderBy(F.desc("n_chars")).first().text[:400] for k in ("en", "fr"))
    r = langid.predict(spark.createDataFrame([(1, f"{en} {fr}")], "doc_id bigint, text string"), model).first()
    assert [s.lang for s in r.spans][0] == "en" and [s.lang for s in r.spans][-1] == "fr"
    assert abs(r.spans[-1].start - len(en)) < 40


def test_scripts_narrow_candidates(spark):
    train = spark.createDataFrame([("ru", "это русский текст для обучения"), ("en", "this is english text to learn from")], "lang string, text string")
    model = langid.fit(train)
    r = langid.predict(spark.createDataFrame([(1, "щука"), (2, "zebra"), (3, "漢字")], "doc_id bigint, text string"), model).collect()
    assert [x.lang_pred for x in r][:2] == ["ru", "en"] and r[2].lang_pred in ("ru", "en")


def test_messy_rows(messy, nothing):
    model = langid.fit(messy)
    rows = langid.predict(messy, model).collect()
    assert len(rows) == len(MESSY)
    for r, (doc_id, text, _, _) in zip(rows, MESSY):
        assert r.doc_id == doc_id
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text or ""))
        assert 0 <= r.score <= 1 and (r.lang_pred != "und" or (r.score == 0 and r.spans == []))
        assert all(0 <= s.start < s.end <= len(text) for s in r.spans)
    kept = langid.keep_identified(messy, model, 1 / 3)
    assert kept.columns == messy.columns and kept.count() == sum(any(c.isalpha() for c in r[1] or "") for r in MESSY)
    empty = langid.fit(nothing)
    assert {r.lang_pred for r in langid.predict(messy, empty).collect()} == {"und"}
    assert langid.predict(nothing, model).count() == 0
