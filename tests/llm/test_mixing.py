"""Mixing: targets against iterated resharing, taken words, permutations,
multinomial shard counts, the mix as documents."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.llm import mixing
from llm_cases import MESSY, documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """{source: target} by resharing the excess until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    out, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        above = [s for s in free if left * weight[s] / total > 3 * sizes[s]]
        if not above:
            out |= {s: left * weight[s] / total for s in free}
            break
        for s in above:
            out[s] = 3.0 * sizes[s]
            free.discard(s)
        left = sum(sizes.values()) - sum(out.values())
    return out


def check(rows, docs):
    sizes = {}
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    want, taken = targets(sizes), {}
    assert len(rows) == len(docs)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]], rel=1e-9, abs=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert sorted((r["doc_id"] or -1, r["size"]) for r in rows) == sorted((d or -1, len(WORD.findall(t or ""))) for d, t, _ in docs)
    for source, n in taken.items():
        assert abs(n - want[source]) <= 1


def rows_of(docs, **options):
    return [r.asDict() for r in mixing.taken_words(*mixing.mix(docs, **options)).collect()]


def test_fixture(spark, fixture_table):
    docs = [(r.doc_id, r.text, r.source) for r in fixture_table("documents").collect()]
    first = rows_of(fixture_table("documents"))
    check(first, docs)
    again = rows_of(fixture_table("documents").repartition(5), shard_slots=64)
    key = lambda rows: sorted((r["doc_id"], r["target"]) for r in rows)
    assert key(first) == key(again)


def test_reruns_agree(spark, fixture_table):
    a, b = (sorted((r["doc_id"], r["taken"]) for r in rows_of(fixture_table("documents").repartition(n))) for n in (3, 11))
    assert a == b


@pytest.mark.parametrize("sizes", [{"a": 1000, "b": 3, "c": 1}, {"a": 10, "b": 4000, "c": 10, "d": 10}, {None: 50, "é": 7, "z": 900, "𝒳": 20}])
def test_hot_and_tiny_sources(spark, sizes):
    docs, k = [], 0
    for source, n in sizes.items():
        while n > 0:
            m = min(n, 1 + k % 37)
            docs.append((k, " ".join(["w"] * m), source))
            n, k = n - m, k + 1
    table = spark.createDataFrame(docs, "doc_id bigint, text string, source string").repartition(6)
    check(rows_of(table, block_words=8, shard_slots=16), docs)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation(spark, n):
    df = spark.range(n).withColumn("n", F.lit(n).cast("bigint"))
    df = mixing.permute(df, "to", F.col("id"), F.col("n"), F.lit(7))
    rows = mixing.permute(df, "back", F.col("to"), F.col("n"), F.lit(7), back=True).collect()
    assert sorted(r["to"] for r in rows) == list(range(n)) and all(r["back"] == r["id"] for r in rows)
    if n >= 1000:
        assert abs(np.corrcoef([r["id"] for r in rows], [r["to"] for r in rows])[0, 1]) < 0.1


def test_shard_counts_are_multinomial(spark):
    shares = spark.createDataFrame([(1, 30_000), (2, 10_000), (3, 2_000)], "src int, quota bigint")
    slots = mixing.draw_slots(shares, 100, 5).toPandas()
    assert len(slots) == 42_000 and slots.slot.is_unique
    for src, quota in ((1, 30_000), (2, 10_000), (3, 2_000)):
        assert sorted(slots[slots.src == src].use) == list(range(quota))
    counts = slots.groupby(["shard", "src"]).size().unstack(fill_value=0)
    p = np.array([30, 10, 2]) / 42
    assert np.allclose(counts.var() / (100 * p * (1 - p)), 1, atol=0.35)


def test_mixed_documents(spark, fixture_table):
    docs = fixture_table("documents")
    documents_, pieces = mixing.mix(docs)
    taken = {r["doc_id"]: r["taken"] for r in mixing.taken_words(documents_, pieces).collect()}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    texts, got = {r.doc_id: r.text for r in docs.collect()}, {}
    for r in out.collect():
        words = WORD.findall(r.text)
        got[r.doc_id] = got.get(r.doc_id, 0) + len(words)
        own = iter(WORD.findall(texts[r.doc_id]))
        assert all(w in own for w in words)                            # in order
    assert got == {d: n for d, n in taken.items() if n}


def test_messy_rows(spark, messy, nothing):
    check(rows_of(messy), [(d, t, s) for d, t, _, s in MESSY])
    out = mixing.mixed_documents(messy)
    assert out.columns == messy.columns and out.count() > 0
    assert rows_of(nothing) == [] and mixing.mixed_documents(nothing).count() == 0
    wordless = documents(spark, [(1, None, None, "a"), (2, " ", None, None)])
    assert [(r["target"], r["taken"]) for r in rows_of(wordless)] == [(0.0, 0)] * 2
