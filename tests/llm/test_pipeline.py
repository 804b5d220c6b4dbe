"""The pipeline against a brute-force version, its stages one by one, and that
nothing else in the library imports the subpackage."""

import pathlib
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from kiln.session import scratch_path
from llm_cases import FIXTURE_SF, MESSY, documents
from test_jaccard_join import brute as near_groups
from test_mixing import WORD, targets
from test_token_store import ids_of

ROOT = pathlib.Path(__file__).parents[2]


@pytest.fixture(scope="module")
def stages(spark):
    """Rows after each stage, the tables first."""
    docs = spark.read.parquet(f"{FIXTURE_SF}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, f"test-{name}")
        stage(spark, docs, FIXTURE_SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.collect())
    return out


def test_language_rejects_only_what_has_none(stages):
    assert {r.doc_id for r in stages[1]} == {r.doc_id for r in stages[0] if any(c.isalpha() for c in r.text or "")}


def test_near_copies_keep_one(stages):
    rows = [(r.doc_id, r.text) for r in stages[1]]
    _, group = near_groups(rows)
    assert sorted(r.doc_id for r in stages[2]) == sorted(set(group.values()))


def test_leaks_go(spark, stages):
    items = [r.text.strip() for r in spark.read.parquet(f"{FIXTURE_SF}/benchmark.parquet").collect()]
    assert {r.doc_id for r in stages[3]} == {r.doc_id for r in stages[2] if not any(x in r.text for x in items)}


def test_mix_meets_targets(stages):
    size, source, taken = {}, {}, {}
    for r in stages[3]:
        size[r.doc_id], source[r.doc_id] = len(WORD.findall(r.text)), r.source
    of = {s: sum(size[d] for d in size if source[d] == s) for s in set(source.values())}
    for r in stages[4]:
        assert r.n_chars == len(r.text)
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(WORD.findall(r.text))
    assert all(n <= 3 * size[d] for d, n in taken.items())
    for s, want in targets(of).items():
        assert abs(sum(n for d, n in taken.items() if source[d] == s) - want) <= 1


def test_tokens_round_trip(stages):
    want, at = [], 0
    for d, text in sorted((r.doc_id, r.text) for r in stages[4]):
        ids = ids_of(text)
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, stages[5])) == want


def test_run_agrees_with_the_stages(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, FIXTURE_SF).collect())) == sorted(map(tuple, stages[5]))


def test_stages_keep_the_columns(spark, messy, nothing):
    for docs in (messy, nothing, documents(spark, MESSY[:1])):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, FIXTURE_SF)
            assert out.columns == docs.columns, name
            out.count()


def test_only_the_entry_imports_the_subpackage():
    for path in [*(ROOT / "kiln").rglob("*.py"), ROOT / "bench.py", *(ROOT / "tests").glob("*.py"), *(ROOT / "tools").glob("*.py")]:
        if "llm" not in path.relative_to(ROOT).parts:
            assert not re.search(r"kiln\.llm|corpus_pipeline", path.read_text()), path
