"""Spelling variants against brute force over all pairs, and defined cases."""

import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kiln.llm import spelling
from llm_cases import documents

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute_words(rows, typo_every, least_length, least_count):
    n = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if typo_every and h % typo_every == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1:]
            n[word] += 1
    return {w: k for w, k in n.items() if len(w) >= least_length and k >= least_count}


def are_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_groups(n, near, ratio):
    """``near``: word -> its near words."""
    out, form = {}, {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def brute_near(words):
    """Near words of each by the words one deletion away from both."""
    shorter = {}
    for w in words:
        for i in range(len(w)):
            shorter.setdefault(w[:i] + w[i + 1:], set()).add(w)
    near = {w: set() for w in words}
    for less, group in shorter.items():
        group = group | ({less} if less in near else set())
        for a in group:
            near[a] |= {b for b in group if b != a and are_near(a, b)}
    return near


def rows_of(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def grouped(spark, n, ratio=5):
    return rows_of(spelling.group_spellings(spark.createDataFrame(list(n.items()), "word string, n bigint"), ratio))


def test_query_equals_brute_force(result, fixture_table):
    docs = fixture_table("documents").toPandas()
    n = brute_words(zip(docs.doc_id.tolist(), docs.text), 199, 6, 5)
    want = brute_groups(n, brute_near(n), 5)
    got = result("op13_spelling_variants")
    none = got.astype(object).where(got.notna(), None)
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in none.itertuples()} == want
    assert sum(v[3] > 0 for v in want.values()) > 10


def test_all_pairs_of_a_small_alphabet(spark):
    """Every word of one to six letters over two: many near words and repeats of letters."""
    words = [format(k, f"0{size}b").replace("0", "a").replace("1", "é") for size in range(1, 7) for k in range(1 << size)]
    n = {w: 1 + zlib.crc32(w.encode()) % 400 for w in words}
    near = {w: {v for v in words if v != w and are_near(v, w)} for w in words}
    assert grouped(spark, n) == brute_groups(n, near, 5)


def test_chains_and_ties(spark):
    n = {"abcdef": 1, "abcdeg": 5, "abcdhg": 25, "abcihg": 125, "abjihg": 625, "akjihg": 3125, "lkjihg": 3125, "bcdef": 5}
    got = grouped(spark, n)
    assert got["abcdef"][:2] == ("abcdeg", "akjihg")        # as many: the first in code point order
    assert got["akjihg"][:2] == (None, "akjihg") and got["lkjihg"][0] is None


@pytest.mark.parametrize("size", [63, 64, 65, 66, 67, 300])
def test_long_words(spark, size):
    """Around the length from which keys are hashed."""
    base = "".join(chr(97 + (k * k + k // 7) % 26) for k in range(size))
    words = [base, base[1:], base[:-1], base[:40] + base[41:], base[:40] + "é" + base[41:], base[:40] + "é" + base[40:], base[:2] + "zz" + base[4:]]
    n = {w: 3 ** k for k, w in enumerate(dict.fromkeys(words))}
    near = {w: {v for v in n if v != w and are_near(v, w)} for w in n}
    assert grouped(spark, n) == brute_groups(n, near, 5)


def test_a_million_letters(spark):
    text = "ab" * 500_000
    docs = spark.createDataFrame([(k, text if k < 5 else text[1:]) for k in range(30)], "doc_id bigint, text string")
    got = rows_of(spelling.group_spellings(spelling.count_words(docs, least_length=6, least_count=5)))
    assert got[text] == (text[1:], text[1:], 5, 1, 25) and got[text[1:]] == (None, text[1:], 25, 1, None)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**32 - 1), st.text("abÀÿ", min_size=1, max_size=70)), min_size=1, max_size=8))
def test_joined_crc32(pairs):
    import numpy as np
    import pyarrow as pa
    heads = [str(h).encode() for h, _ in pairs]
    got = spelling.joined_crc32(np.array([zlib.crc32(h) for h in heads], np.uint32), np.arange(len(pairs)),
                                pa.array([w for _, w in pairs], pa.large_string()))
    assert got.tolist() == [zlib.crc32(h + w.encode()) for h, (_, w) in zip(heads, pairs)]


def test_messy_rows(spark, messy, nothing):
    rows = [(r.doc_id, r.text) for r in messy.select("doc_id", "text").collect()]
    for every in (None, 1, 2):
        n = brute_words(rows, every, 2, 1)
        words = spelling.count_words(messy, typo_every=every, least_length=2)
        assert {r.word: r.n for r in words.collect()} == n
    n = brute_words(rows, None, 2, 2)
    got = rows_of(spelling.group_spellings(spelling.count_words(messy, least_length=2, least_count=2)))
    assert got == brute_groups(n, brute_near(n), 5)
    assert spelling.group_spellings(spelling.count_words(nothing)).count() == 0
    assert spelling.count_words(documents(spark, [(1, "a-b × ÷ Ÿ ÿ ÀB", "en", "a")])).count() == 6
