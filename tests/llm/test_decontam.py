"""Decontamination: alignment against plain dynamic programming, planted
verbatim, edited and partial copies, no clean document."""

import random
import time

import numpy as np
import pytest

from kiln.llm import decontam
from llm_cases import MESSY


def brute_align(a, b, gap):
    h = np.zeros((len(a) + 1, len(b) + 1))
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (1.0 if a[i - 1] == b[j - 1] else -gap), h[i - 1, j] - gap, h[i, j - 1] - gap)
    return h.max()


def test_alignment_value():
    rng = np.random.default_rng(1)
    for _ in range(60):
        a, b = (rng.integers(0, 4, rng.integers(1, 14)).astype(np.uint64) for _ in range(2))
        assert decontam.align(a, b, 0.5)[0] == pytest.approx(brute_align(a, b, 0.5))


def prose(rng, n):
    return [f"{rng.choice('bcdfghklmnprst')}{rng.choice('aeiou')}{rng.choice('lmnrst')}{rng.choice('aeiou')}{rng.choice(['', 'n', 'ra'])}" for _ in range(n)]


def test_planted_copies(spark):
    rng = random.Random(5)
    items = [(k, " ".join(prose(rng, 40))) for k in range(30)]
    docs, want = [], set()
    for d in range(200):
        words = prose(rng, rng.randint(5, 300))
        if d < 90:
            k, copy = d % 30, items[d % 30][1].split()
            if d >= 60:                                    # every fifth word replaced, one dropped, one added
                copy = [prose(rng, 1)[0] if i % 5 == 2 else w for i, w in enumerate(copy)]
                del copy[11]
                copy.insert(21, "zzz")
            elif d >= 30:
                copy = [w.upper() + "," for w in copy]     # other case and punctuation
            at = rng.randint(0, len(words))
            words[at:at] = copy
            want.add((d, k))
        docs.append((d, " ".join(words)))
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontam.find_leaks(table, bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want
    for r in rows:
        text = dict(docs)[r.doc_id][r.start:r.end]
        if r.doc_id < 60:
            assert r.score == 1 and text.replace(",", "").lower() == items[r.item_id][1].lower()
        else:
            assert 0.4 <= r.score < 1
    left = decontam.remove_leaks(table, bench)
    assert {r.doc_id for r in left.collect()} == set(range(90, 200)) and left.columns == table.columns


def test_common_passage_keeps_its_seeds(spark):
    passage = " ".join(prose(random.Random(2), 30))
    docs = spark.createDataFrame([(k, f"start {passage} end{k}") for k in range(300)], "doc_id bigint, text string")
    assert decontam.find_leaks(docs, spark.createDataFrame([(1, passage)], "item_id bigint, text string")).count() == 300


def changed(rng, words, every):
    return [prose(rng, 1)[0] + "x" if i % every == every - 1 else w for i, w in enumerate(words)]


@pytest.mark.parametrize("form", ["every 4th changed", "every 5th changed", "first part"])
@pytest.mark.parametrize("rows, copies", [(200, 1), (600, 200)])
def test_edited_and_partial_copies_without_a_verbatim_one(spark, form, rows, copies):
    rng = random.Random(11)
    item = prose(rng, 40)
    copy = item[:18] if form == "first part" else changed(rng, item, int(form.split()[1][0]))
    stock = [" ".join(item[k:k + 3]) for k in range(0, 38, 3)] if copies > 1 else []       # rarer than the copies
    docs = []
    for d in range(rows):
        words = prose(rng, 30)
        words[10:10] = copy if d < copies else [stock[d % len(stock)]] if stock and d < copies + 40 else []
        docs.append((d, " ".join(words)))
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(prose(rng, 40)))], "item_id bigint, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.find_leaks(table, bench).collect()} == {(d, 1) for d in range(copies)}
    assert decontam.remove_leaks(table, bench).count() == rows - copies


def test_long_passage_of_a_longer_item(spark):
    rng = random.Random(8)
    item = prose(rng, 400)
    passages = {0: item[100:250], 1: item[300:360], 2: changed(rng, item[20:120], 5), 3: item[200:220]}
    docs = [(d, " ".join([*prose(rng, 80), *passages.get(d, []), *prose(rng, 80)])) for d in range(40)]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    rows = {r.doc_id: r for r in decontam.find_leaks(table, bench).collect()}
    assert set(rows) == {0, 1, 2}
    assert dict(docs)[0][rows[0].start:rows[0].end] == " ".join(passages[0]) and rows[0].score == pytest.approx(150 / 400)
    assert {r.doc_id for r in decontam.remove_leaks(table, bench).collect()} == set(range(3, 40))


PHRASE = "which of the following words is the best answer to this"


def test_seeds_of_many_items_with_a_common_phrase():
    rng = random.Random(4)
    items = decontam.Items.of(list(range(50)), [f"{PHRASE} " + " ".join(prose(rng, 30)) for _ in range(50)], 3)
    n = len(PHRASE.split()) - 2
    common = set(items.grams[:n].tolist())
    shares = {int(g): 0.5 if int(g) in common else 0.0005 for g in items.grams}
    seeds, rare = decontam.choose_seeds(items, shares, 0.001)
    assert not common & set(items.grams[seeds].tolist()) and len(seeds) == len(items.grams) - 50 * n and rare.all()
    seeds, _ = decontam.choose_seeds(items, {g: 0.5 for g in common}, 0.001)
    assert not len(seeds)                                   # clean items, whose other n-grams don't occur


def test_a_clean_templated_block_costs_little(spark):
    """1,000 clean items that open with a phrase that a third of the documents hold."""
    rng = random.Random(6)
    items = [(k, f"{PHRASE} " + " ".join(x + "q" for x in prose(rng, 30))) for k in range(1000)]
    docs = [(d, " ".join([*prose(rng, 40), *(PHRASE.split() if d % 3 == 0 else []), *prose(rng, 40)])) for d in range(300)]
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(2)
    block = decontam.Items.of([k for k, _ in items], [t for _, t in items], 3)
    shares = decontam.gram_shares(table, block.grams, 3)
    seeds, rare = decontam.choose_seeds(block, shares, decontam.RARE_SHARE)
    assert len(seeds) < 20
    matcher = decontam.Matcher(block, seeds, rare, 3, 0.5, 0.4, 8, 30)
    begin = time.process_time()
    assert matcher.leaks([t for _, t in docs]) == []
    assert time.process_time() - begin < 1
    copies = [(1000 + d, " ".join([*prose(rng, 40), *items[7][1].split(), *prose(rng, 40)])) for d in range(150)]
    found = decontam.find_leaks(table.unionByName(spark.createDataFrame(copies, table.schema)), spark.createDataFrame(items, "item_id bigint, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(1000 + d, 7) for d in range(150)}


def test_equal_items_and_a_hot_copy(spark):
    """Twenty items of the same words, a copy in half of the documents."""
    rng = random.Random(12)
    item = " ".join(prose(rng, 25))
    docs = spark.createDataFrame([(d, f"{' '.join(prose(rng, 20))} {item if d % 2 else ''}") for d in range(60)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(k, item) for k in range(20)], "item_id bigint, text string")
    assert decontam.find_leaks(docs, bench).count() == 30 * 20


def test_all_pairs_by_plain_alignment(spark):
    """Every pair of a small set of edited copies and clean texts, aligned plainly."""
    rng = random.Random(21)
    items = [prose(rng, rng.randint(9, 60)) for _ in range(12)]
    docs = []
    for d in range(80):
        words = prose(rng, rng.randint(0, 60))
        if d % 4:
            copy = list(items[d % 12])
            for _ in range(rng.randint(0, len(copy) // 5)):
                edit, at = rng.randrange(3), rng.randrange(len(copy))
                copy[at:at + (edit != 1)] = [] if edit == 0 else ["new" + prose(rng, 1)[0]]
            words[len(words) // 2:len(words) // 2] = copy[:rng.randint(len(copy) // 3, len(copy))]
        docs.append(words)
    number = {w: k for k, w in enumerate(sorted({w for t in items + docs for w in t}))}
    want = {}
    for d, t in enumerate(docs):
        for i, item in enumerate(items):
            value = brute_align([number[w] for w in item], [number[w] for w in t], 0.5)
            if value >= decontam.least_value(len(item), 0.4, 8, 30):
                want[d, i] = value / len(item)
    got = decontam.find_leaks(spark.createDataFrame([(d, " ".join(t)) for d, t in enumerate(docs)], "doc_id bigint, text string").repartition(3),
                              spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id bigint, text string"))
    assert len(want) > 30 and {(r.doc_id, r.item_id): r.score for r in got.collect()} == pytest.approx(want)


def test_blocks_of_the_benchmark(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 400)
    rng = random.Random(3)
    items = [(k, " ".join(prose(rng, 30))) for k in range(12)]
    docs = spark.createDataFrame([(k, f"x {t} y") for k, t in items], "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    assert sorted((r.doc_id, r.item_id) for r in decontam.find_leaks(docs, bench).collect()) == [(k, k) for k in range(12)]
    assert decontam.remove_leaks(docs, bench).count() == 0


def test_fixture_leaks_are_the_documents_that_hold_an_item(result, fixture_table):
    got = result("op7_decontamination")
    docs, bench = fixture_table("documents").toPandas(), fixture_table("benchmark").toPandas()
    want = {(d, i) for d, text in zip(docs.doc_id, docs.text) for i, item in zip(bench.item_id, bench.text) if item.strip() in text}
    assert want and {(d, i) for d, i in zip(got.doc_id, got.item_id)} == want


def test_messy_rows(spark, messy, nothing):
    bench = spark.createDataFrame([(1, None, "q"), (2, "", "q"), (None, "one two three four", "q"), (3, "one two three four", "q"),
                                   (4, "one two", None), (5, "...", "q")], "item_id bigint, text string, doc_id string")
    got = sorted((r.doc_id, r.item_id or 0, r.score) for r in decontam.find_leaks(messy, bench).collect())
    assert got == [(6, 0, 1.0)] * 2 + [(6, 3, 1.0)] * 2 + [(7, 0, 1.0), (7, 3, 1.0)]
    assert decontam.remove_leaks(messy, bench).count() == len(MESSY) - 3
    assert decontam.find_leaks(nothing, bench).count() == 0
    assert decontam.find_leaks(messy, bench.limit(0)).count() == 0 and decontam.remove_leaks(messy, bench.limit(0)).count() == len(MESSY)
