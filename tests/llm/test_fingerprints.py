"""Fingerprints: neighbours and edits against plain Python, likeness against Jaccard."""

import hashlib
import random

import numpy as np
import pytest

from kiln.llm import fingerprints
from llm_cases import MESSY, documents
from test_jaccard_join import brute as brute_links
from test_jaccard_join import near_copies, shingles


def brute(rows):
    """(doc_id, text, edited) in the defined order."""
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: ((r[0] is None, -(r[0] or 0)), r[1]))
    return [(d, t, t[:len(t) - len(t) // 2] + rows[(k + 1) % len(rows)][1][:len(t) // 2]) for k, (d, t) in enumerate(rows)]


def as_found(rows):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_chars, r.edited_sha256) for r in rows)


def as_wanted(rows):
    return sorted((d is None, d or 0, len(t), hashlib.sha256(e.encode()).hexdigest()) for d, t, e in rows)


@pytest.mark.parametrize("buckets", [1, 3, 1 << 16])
def test_neighbours(spark, fixture_table, monkeypatch, buckets):
    monkeypatch.setattr(fingerprints, "BUCKETS", buckets)
    docs = fixture_table("documents")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert as_found(fingerprints.edited_neighbours(docs.repartition(9)).collect()) == as_wanted(want)


def test_likeness_estimates_jaccard(result, fixture_table):
    got = result("op9_fingerprints").set_index("doc_id")
    rows = brute([(r.doc_id, r.text) for r in fixture_table("documents").collect()])
    error = []
    for d, text, edited in rows:
        a, b = shingles(text), shingles(edited)
        error.append(got.near_edited[d] - len(a & b) / len(a | b))
    assert np.abs(error).mean() < 0.05 and abs(np.mean(error)) < 0.02
    texts = {}
    for d, text, _ in rows:
        assert texts.setdefault(text, got.fingerprint[d]) == got.fingerprint[d]


def test_query_finds_near_copies_that_are_no_neighbours(result, fixture_table):
    got = result("op9_fingerprints")
    links, group = brute_links([(r.doc_id, r.text) for r in fixture_table("documents").collect()])
    assert dict(zip(got.doc_id, got.n_links)) == links and dict(zip(got.doc_id, got.group_id)) == group


def test_default_recall_links_pairs_at_the_threshold(spark):
    rng = random.Random(12)
    docs = near_copies(rng, 300, [1], 95)
    for d, text in docs[:300]:                             # two changed words: 81 of 101 shingles shared
        words = text.split()
        words[20], words[60] = "changed", "too"
        docs.append((1000 + d, " ".join(words)))
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    links, group = brute_links(docs)
    assert sum(links.values()) == 600
    got = {r.doc_id: r.n_links for r in fingerprints.near_copies(table).collect()}
    assert sum(got.values()) >= 598                        # with 16 bands of 8 rows some 30 are missed


def test_joined_columns_of_messy_rows(spark, messy, nothing):
    rows = fingerprints.fingerprint_join(messy).collect()
    assert as_found(rows) == as_wanted(brute([r[:2] for r in MESSY]))
    assert sorted((r.doc_id or 0, r.group_id or 0, r.n_links) for r in rows) == sorted(
        (r.doc_id or 0, r.group_id or 0, r.n_links) for r in fingerprints.near_copies(messy).collect())
    assert fingerprints.fingerprint_join(nothing).count() == 0


def test_messy_rows(spark, messy, nothing):
    rows = fingerprints.edited_neighbours(messy).collect()
    assert as_found(rows) == as_wanted(brute([r[:2] for r in MESSY]))
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert fingerprints.edited_neighbours(nothing).count() == 0
    only = fingerprints.edited_neighbours(documents(spark, [(7, "abcd", None, None)])).first()
    assert only.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and only.near_next == 1
    null = fingerprints.edited_neighbours(documents(spark, [(None, "abcd", None, None), (None, None, None, None)]))
    assert as_found(null.collect()) == as_wanted(brute([(None, "abcd"), (None, "")]))


def test_buckets_are_even(spark):
    """Cut at sampled quantiles, whatever the ids look like; a row's successor is still found."""
    ids = [k * k * k for k in range(3000)]
    docs = spark.createDataFrame([(i, f"text number {i}") for i in ids], "doc_id bigint, text string").repartition(5)
    rows = {r.doc_id: r for r in fingerprints.edited_neighbours(docs).collect()}
    assert len(rows) == 3000
    for k in (0, 1, 700, 2999):
        successor = f"text number {ids[k - 1]}"
        text = fingerprints.edited(f"text number {ids[k]}", successor)
        assert rows[ids[k]].edited_sha256 == hashlib.sha256(text.encode()).hexdigest()
