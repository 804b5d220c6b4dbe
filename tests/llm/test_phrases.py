"""Phrase counts against plain counting, the report against its SQL twin and
against whole-number arithmetic, and defined cases."""

import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from kiln.llm import phrases, queries
from llm_cases import FIXTURE_SF, documents

LOWER = {c: c + 32 for c in range(65, 91)}


def brute_counts(rows, max_words, least):
    n = Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            if words:
                n[0, lang or "und", ""] += len(words)
            for size in range(1, max_words + 1):
                for i in range(len(words) - size + 1):
                    n[size, lang or "und", " ".join(words[i:i + size])] += 1
    return {k: v for k, v in n.items() if v >= least or k[0] == 0}


def counted(docs, **options):
    rows = phrases.count_phrases(docs, bits=options.pop("bits", 16), **options).collect()
    assert len(rows) == len({(r.size, r.lang, r.phrase) for r in rows})
    return {(r.size, r.lang, r.phrase): r.n for r in rows}


def test_query_equals_sql(result):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{FIXTURE_SF}/documents.parquet')")
    want = con.execute(queries.ORACLE_SQL["op11_phrase_collocations"]).df()
    got = result("op11_phrase_collocations")[list(want.columns)]
    assert len(got) > 50
    key = ["lang", "rank"]
    assert got.sort_values(key).values.tolist() == want.sort_values(key).values.tolist()


@pytest.mark.parametrize("shards, bits, max_words", [(1, 16, 3), (2, 16, 3), (5, 16, 4), (3, 2, 3)])
def test_counts_equal_plain_counting(spark, shards, bits, max_words):
    """Also with a table of four places, which prunes nothing."""
    rng = np.random.default_rng(shards)
    vocabulary = [f"w{k}" for k in range(40)]
    rows = []
    for k in range(300):
        words = rng.choice(vocabulary, rng.integers(0, 30), p=(p := 1 / np.arange(1, 41)) / p.sum())
        rows.append((k, "".join(w + rng.choice([" ", "  ", "\t", ", ", "\n"], p=[.7, .1, .1, .05, .05]) for w in words), rng.choice(["en", "de"]), "a"))
    docs = documents(spark, [(*r[:2], str(r[2]), r[3]) for r in rows]).repartition(4)
    got = counted(docs, shards=shards, bits=bits, max_words=max_words, least=10)
    assert got == brute_counts([(r[1], r[2]) for r in rows], max_words, 10)


def test_pruned_phrases_are_not_counted(spark):
    """From the second stop on only phrases of frequent words are counted."""
    tables = [np.full(1 << 16, phrases.NEVER, np.uint8) for _ in range(2)]
    s = next(phrases.bytewords.byte_slices(pa.array(["a b c a b d"])))
    at = phrases.phrase_places(pa.array(["en", "en"]), pa.array(["a", "b"]), 16)
    tables[0][at] = 0
    langs = pa.array(["en"])

    def seen(stop):
        out = [b.to_pylist() for b in phrases.count_slice(s, np.zeros(1, np.int64), langs, phrases.lang_hashes(["en"]), tables, 16, stop, 4)]
        return {r["phrase"]: (r["n"], r["since"]) for rows in out for r in rows if r["size"] > 1}

    assert seen(0) == {} and seen(1) == {"a b": (2, 0)} == seen(4) and seen(5) == {}


def test_scores_beyond_64_bits(spark):
    big = 3 * 10**12
    rows = [(0, "en", "", 10**14), (1, "en", "x", big + 7), (1, "en", "y", big + 1), (1, "en", "z", big + 9),
            (2, "en", "x y", big - 1), (2, "en", "y z", big), (3, "en", "x y z", 1_400_000_000_000)]
    counts = spark.createDataFrame(rows, "size tinyint, lang string, phrase string, n bigint")
    got = {r.phrase: r for r in phrases.collocations(counts).collect()}
    n = {r[2]: r[3] for r in rows}
    assert got["x y"].score == 10**6 * n["x y"] ** 2 // (n["x"] * n["y"])
    cuts = [(10**6 * n["x y z"] ** 2 // (n[a] * n[b]), k, n[a], n[b]) for k, (a, b) in enumerate((("x", "y z"), ("x y", "z")))]
    assert (got["x y z"].score, got["x y z"].l, got["x y z"].r) == (min(cuts)[0], *min(cuts)[2:])
    covered = rows[:-1] + [(3, "en", "x y z", big // 2)]        # half of "y z" exactly, and of "x y" or more
    got = phrases.collocations(spark.createDataFrame(covered, "size tinyint, lang string, phrase string, n bigint")).collect()
    assert [r.phrase for r in got] == ["x y z"]


def test_top_by_parts(spark):
    rows = [(0, "en", "", 9)] + [(1, "en", f"w{k}", 100) for k in range(60)]
    rows += [(2, "en", f"w{a} w{b}", 10 + (a * b) % 17) for a in range(60) for b in range(60)]
    counts = spark.createDataFrame(rows, "size tinyint, lang string, phrase string, n bigint")
    want = sorted(((-(10**6 * n * n // 10**4), -n, p) for s, _, p, n in rows if s == 2))[:50]
    got = sorted(phrases.collocations(counts, top=50).collect(), key=lambda r: r["rank"])
    assert [(-r.score, -r.a, r.phrase) for r in got] == want and [r["rank"] for r in got] == list(range(1, 51))


def test_messy_rows(spark, messy, nothing):
    rows = [(r.text, r.lang) for r in messy.select("text", "lang").collect()]
    got = counted(messy, least=2, shards=2)
    assert got == brute_counts(rows, 3, 2)
    assert phrases.collocations(phrases.count_phrases(messy, least=2, bits=16), least=2).count() > 0
    assert phrases.count_phrases(nothing, bits=16).count() == 0
    assert phrases.collocations(phrases.count_phrases(nothing, bits=16)).count() == 0


def test_a_long_word_and_a_long_piece(spark):
    text = "x" * 3_000_000 + " " + "a b " * 500_000
    got = counted(spark.createDataFrame([(text, None)] * 2, "text string, lang string"), shards=2, least=2)
    assert got[2, "und", "a b"] == 1_000_000 and got[3, "und", "b a b"] == 999_998 and got[1, "und", "x" * 3_000_000] == 2
