"""Jaccard join and components against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.llm import fingerprints, groups, jaccard_join, textvec
from llm_cases import MESSY


def shingles(text, n=5):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return frozenset(tuple(words[k:k + n]) for k in range(max(1, len(words) - n + 1))) if words else frozenset()


def brute(docs, threshold=0.8):
    """({id: links}, {id: least id of its group})."""
    sets = {d: shingles(t) for d, t in docs}
    ids, root = sorted(sets), {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = dict.fromkeys(ids, 0)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and len(x & y) >= threshold * len(x | y) - 1e-9:
                links[a] += 1
                links[b] += 1
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return links, {d: find(d) for d in ids}


def check(rows, docs):
    links, group = brute(docs)
    assert {r.doc_id: r.n_links for r in rows} == links
    assert {r.doc_id: r.group_id for r in rows} == group


def near_copies(rng, n_groups, sizes, words):
    docs = []
    for _ in range(n_groups):
        base = [f"w{rng.randrange(4000)}" for _ in range(words)]
        for _ in range(rng.choice(sizes)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 4])):
                copy[rng.randrange(words)] = f"x{rng.randrange(9000)}"
            docs.append(" ".join(copy))
    rng.shuffle(docs)
    return list(enumerate(docs))


def test_groups_and_links(spark):
    docs = near_copies(random.Random(4), 40, [1, 2, 3, 8], 90)
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    check(jaccard_join.jaccard_join(table).collect(), docs)
    check(fingerprints.near_copies(table, recall=0.99).collect(), docs)


def test_large_group_is_tiled(spark):
    docs = near_copies(random.Random(6), 1, [150], 120)
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    check(jaccard_join.jaccard_join(table, tile=16).collect(), docs)


def test_exact_at_the_threshold():
    a, b = np.arange(9, dtype=np.uint64), np.arange(1, 10, dtype=np.uint64)          # 8 of 10
    assert jaccard_join.similar([a, b], 0.8).tolist() == [[0, 1]]
    assert jaccard_join.similar([a, b], 0.81).tolist() == []
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 30, rng.integers(1, 25)).astype(np.uint64)) for _ in range(40)]
    want = [[i, j] for i in range(40) for j in range(i + 1, 40)
            if len(np.intersect1d(sets[i], sets[j])) >= 0.5 * len(np.union1d(sets[i], sets[j]))]
    assert jaccard_join.similar(sets, 0.5).tolist() == want == jaccard_join.similar(sets, 0.5, block=64).tolist()


def test_bands_reach_the_recall():
    bands, rows = textvec.choose_bands(0.8, 0.9995, most=256)
    assert bands * rows <= 256 and 1 - (1 - 0.8 ** rows) ** bands >= 0.9995
    with pytest.raises(ValueError):
        textvec.choose_bands(0.1, 0.999999, rows_at_least=3, most=64)


@pytest.mark.parametrize("links", [[(k, k + 1) for k in range(60)], [(0, k) for k in range(1, 50)], [(1, 1)], [(5, 3), (3, 5), (9, 8), (None, 4)], []])
def test_components(spark, links):
    table = spark.createDataFrame(links, "u bigint, v bigint")
    root = {}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and b is not None:
            root.setdefault(a, a), root.setdefault(b, b)
            ra, rb = find(a), find(b)
            root[max(ra, rb)] = min(ra, rb)
    got = {r.node: r.component for r in groups.components(table).collect()}
    want = {x: find(x) for x in root}
    assert got == {x: c for x, c in want.items() if sum(v == c for v in want.values()) > 1}


def test_fixture(result, fixture_table):
    docs = [(r.doc_id, r.text) for r in fixture_table("documents").collect()]
    got = result("op8_jaccard_join")
    links, group = brute(docs)
    assert dict(zip(got.doc_id, got.n_links)) == links and dict(zip(got.doc_id, got.class_id)) == group
    assert max(links.values()) > 0


def test_messy_rows(spark, messy, nothing):
    rows = jaccard_join.jaccard_join(messy).collect()
    assert len(rows) == len(MESSY)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert all(r.n_links == 0 and r.group_id == i for i in (1, 2, 3) for r in by_id[i])
    assert [r.n_links for r in by_id[6]] == [2, 2] and by_id[7][0].n_links == 2 and by_id[7][0].group_id == 6
    assert by_id[4][0].group_id == by_id[11][0].group_id == 4
    kept = jaccard_join.keep_one(messy)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == messy.columns and sorted(x for x in ids if x is not None) == [1, 2, 3, 4, 5, 6, 8, 9, 10, 10, 12, 13]
    assert jaccard_join.jaccard_join(nothing).count() == 0 and jaccard_join.keep_one(nothing).count() == 0


def test_many_null_ids_fetch_only_their_own_texts(spark):
    """Classes whose ids are all null: each fetches one text, not every text without an id."""
    n = 400
    texts = [" ".join(f"w{k}x{i}" for i in range(60)) for k in range(n // 2)]
    rows = [(None, t) for t in texts] + [(None, t + " more") for t in texts]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    bands, per_band = jaccard_join.textvec.choose_bands(0.8, 0.9995, most=256)
    sketched = jaccard_join.materialize(jaccard_join.sketch(docs, "doc_id", "text", 5, bands, per_band, 8))
    wanted = (sketched.groupBy("class").agg(F.min(F.struct("doc_id", "text_md5")).alias("d")).select("class", "d.*")
              .selectExpr("class", "doc_id", "text_md5", "class as group", "1L as n_docs", "1L as n_classes"))
    assert jaccard_join.ngram_sets(docs, wanted, "doc_id", "text", 5).count() == n
    assert [r.n_links for r in jaccard_join.jaccard_join(docs).collect()] == [1] * n
