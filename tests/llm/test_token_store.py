"""Token store: exact round trip against the tokenizers library, the perfect
hash, keyed access, missing keys."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.errors import PySparkException
from tokenizers import Tokenizer

from kiln.llm import token_store
from kiln.session import scratch_path
from llm_cases import MESSY

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


NULL = -(1 << 64)


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [2]


def brute(rows):
    """(key, start, n, crc) in ascending key order, null first, ties by text."""
    out, at = [], 0
    for d, t in sorted(((NULL if d is None else d, t or "") for d, t in rows)):
        ids = ids_of(t)
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def found(df):
    return sorted((NULL if r.doc_id is None else r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.collect())


def test_fixture_round_trip(result, fixture_table):
    got = result("op4_token_store")
    want = brute([(r.doc_id, r.text) for r in fixture_table("documents").collect()])
    assert sorted(map(tuple, got[["doc_id", "start", "n_tokens", "ids_crc32"]].values.tolist())) == want


def test_pieces_equal_whole_texts():
    enc = token_store.Encoder(PATH)
    rng = random.Random(2)
    letters = [chr(c) for c in [*range(0x530), *range(0x2000, 0x2070), 0x3000, 0x4E00, 0x1F600]] + list("  \n\t abcABC'_12é") * 40
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert enc.encode(text) == enc.whole(text), text
    assert np.frombuffer(enc.encode("a<|endoftext|>b"), enc.dtype).tolist() == TOKENIZER.encode("a<|endoftext|>b").ids


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 50_000])
def test_perfect_hash_is_minimal(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64))
    h = token_store.KeyHash.of(keys)
    assert sorted(h.slots(keys).tolist()) == list(range(len(keys)))
    if n >= 1000:
        assert sum(h.sizes) < 6 * n                                       # bits, three to four a key


def test_index_bytes_and_unknown_keys():
    keys = np.sort(np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 5000))
    index = token_store.ShardIndex.of(keys, np.arange(5000), "<u2")
    again = token_store.ShardIndex.from_bytes(index.to_bytes())
    slots = again.find(keys)
    assert (keys[again.first[slots]] == keys).all() and (again.offsets == index.offsets).all()
    assert (again.find(keys + 1) >= 0).mean() < 0.001
    with pytest.raises(ValueError):
        token_store.ShardIndex.from_bytes(b"something else")


def test_keyed_access_and_messy_rows(spark, messy, nothing):
    path = scratch_path(spark, "tokens-test")
    token_store.write_store(messy, path, PATH, 2)
    assert found(token_store.read_records(messy, path)) == brute([r[:2] for r in MESSY])
    store = token_store.Shards.of(spark, path)
    assert [x.tolist() for x in store.get(6)] == [ids_of("one two three four")] * 2
    assert [x.tolist() for x in store.get(None)] == [ids_of(""), ids_of("the null id document is here")]
    assert store.get(5)[0].tolist() == ids_of("one") and store.get(999_999) == [] and store.get(-5) == []
    missing = spark.createDataFrame([(1,), (424242,)], "doc_id bigint")
    with pytest.raises(PySparkException, match="424242"):
        token_store.read_records(missing, path).collect()
    assert token_store.encode_and_read(nothing, PATH, 2).count() == 0


def test_extreme_keys_aren_t_null(spark):
    rows = [(-(1 << 63), "least"), (None, "none"), ((1 << 63) - 1, "most"), (0, "zero")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    path = scratch_path(spark, "tokens-test")
    token_store.write_store(docs, path, PATH, 2)
    assert found(token_store.read_records(docs, path)) == brute(rows)
    store = token_store.Shards.of(spark, path)
    assert [[x.tolist() for x in store.get(k)] for k, _ in rows] == [[ids_of(t)] for _, t in rows]
    with pytest.raises(PySparkException, match="without a key"):
        some = scratch_path(spark, "tokens-test")
        token_store.write_store(docs.where("doc_id is not null"), some, PATH, 2)
        token_store.read_records(docs, some).collect()


def test_hot_keys_span_shards_and_shards_have_tasks(spark, monkeypatch):
    """A third of the rows has one id, a third none; repeated rows of one text among them."""
    rng = random.Random(9)
    rows = [((7, None, k)[k % 3], "same text" if k % 2 else f"text {rng.random()}") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    monkeypatch.setattr(token_store, "partitions_for", lambda df: 12)
    path = scratch_path(spark, "tokens-test")
    manifest = token_store.write_store(docs, path, PATH, 2).collect()
    assert len(manifest) >= 10 and max(r.n_docs for r in manifest) < 700 and sum(r.n_docs for r in manifest) == 3000
    records = token_store.read_records(docs, path)
    assert records.rdd.getNumPartitions() == len(manifest)
    got, want = records.collect(), brute(rows)
    starts = sorted((r.start, r.n_tokens) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
    assert sorted((NULL if r.doc_id is None else r.doc_id, r.ids_crc32) for r in got) == sorted((w[0], w[3]) for w in want)
    store = token_store.Shards.of(spark, path)
    assert len(store.get(7)) == len(store.get(None)) == 1000
