"""Secret scan against plain searches of each kind, and its checksums."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kiln.llm import secrets

ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def brute(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans)


def base(text):
    return [(s, secrets.KINDS.index(k), e) for s, e, k in secrets.scan(text) if k in secrets.BASE_KINDS]


PIECES = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", '"', "'", " ", "=", ":", "abcdefgh1234", "AKIA", "AKIAABCDEFGH1234",
          "0123456789abcdef", "deadbeef", "K", "İ", "ſecret", "é", "\n", "ghp_", "x"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14))
def test_base_kinds_as_searched(pieces):
    text = "".join(pieces)
    assert base(text) == brute(text)


def test_checksummed_tokens():
    body = "a1B2" * 7 + "zz"
    good = "ghp_" + body + secrets.crc32_base62(body)
    bad = good[:-1] + ("0" if good[-1] != "0" else "1")
    assert [k for _, _, k in secrets.scan(f"x {good} y")] == ["github"]
    assert secrets.scan(f"x {bad} y") == []
    assert [k for _, _, k in secrets.scan("IBAN: GB82 WEST 1234 5698 7654 32.")] == ["iban"]
    assert secrets.scan("IBAN: GB83 WEST 1234 5698 7654 32.") == []
    assert [k for _, _, k in secrets.scan("-----BEGIN RSA PRIVATE KEY-----")] == ["key"]


def test_query_equals_brute_force(result, fixture_table):
    got = result("op10_secret_scan").set_index("doc_id")
    docs = fixture_table("documents").toPandas()
    assert len(got) == len(docs)
    names = secrets.BASE_KINDS
    for doc_id, text in zip(docs.doc_id, docs.text):
        spans = brute(text or "")
        joined = ",".join(f"{names[k]}:{s}:{e}" for s, k, e in spans)
        assert got.base_sha256[doc_id] == hashlib.sha256(joined.encode()).hexdigest()
        assert [got[f"n_{n}"][doc_id] for n in names] == [sum(k == i for _, k, _ in spans) for i in range(3)]


def test_messy_rows(spark, messy, nothing):
    rows = secrets.find_secrets(messy).collect()
    assert len(rows) == messy.count()
    assert {k.kind for r in rows if r.doc_id == 12 for k in r.spans} == {"assign", "access", "hex"}
    assert all(r.spans == [] for r in rows if r.doc_id in (1, 2, 3))
    assert secrets.find_secrets(nothing).count() == 0


@pytest.mark.parametrize("text", ["", None])
def test_empty(text):
    assert secrets.scan(text) == []
