"""Token ids as binary shard files with constant-time keyed access.

A store is a folder in the shared file system:

* ``payload-<shard>.bin``: the ids of the shard's documents one after another,
  raw little-endian, 16 bits if the vocabulary allows, else 32; documents in
  ascending order of their key, null first, shards too.
* ``index-<shard>.bin``: a minimal perfect hash of the shard's keys (levels of
  bit arrays; a key that is alone at its place in a level is settled there,
  the rest go on to the next; its slot is the rank of its bit), and per slot a
  32-bit fingerprint of the key, its first document and its number of
  documents; then the payload offset of each document.  Keys aren't stored: a
  key that isn't in the store fails the fingerprint, but for one in 2**32.
* ``manifest``: a Parquet table of the shards with key ranges and sizes.

Writing shuffles the texts once, by ranges of (key, first characters); a key
with very many rows spans several shards, but for those of its rows whose
first ``TIE_CHARS`` characters are equal.  A task streams its
texts into its payload and keeps only keys and lengths.  Files get their
names when complete, and a repeated task writes the same bytes, so lost
executors and repeated attempts do no harm.  Records are read back with one
task per shard, so a task reads as much payload as one wrote.

Defined results: null text is empty; rows of equal key, and those of the null
key, are separate documents, ordered by text; any 64-bit number can be a key; an empty table gives a store
without shards; a text that holds an added token's own string is encoded as
the tokenizer does.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from kiln.llm import textvec
from kiln.session import partitions_for, scratch_path

MAGIC = b"KILNTOK1"
LOAD, BLOCK_BITS = 2.0, 512

#: Characters that part documents of one key; the sample that cuts the ranges holds no more of a text.
TIE_CHARS = 64
FINGERPRINT_SEED = np.uint64(0xD6E8FEB86659FD93)

#: Encoded pieces a task keeps at most, half of them those met last.
MEMO_PIECES = 500_000

MANIFEST = "shard int, n_docs bigint, n_null bigint, n_ids bigint, first_key bigint, last_key bigint"
RECORDS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
RECORD_ROWS = 10_000


# -- encoding ---------------------------------------------------------------

#: Fixed value: the word pattern of byte-level tokenizers, in Python's classes.
#: Of ``plain`` characters the classes hold the same ones: a letter is a word
#: character that is neither a decimal digit nor an underscore.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"


#: Fixed rule of byte-level tokenizers: a printable byte stands for itself, the
#: others, in order, for the code points from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_SYMBOLS = {b: 256 + i for i, b in enumerate(sorted({*range(256)} - {*_PRINTABLE}))}
SPACE = chr(BYTE_SYMBOLS[32])


def plain(c: str) -> bool:
    return unicodedata.category(c) not in ("No", "Nl", "Cn", "Cc") or c in "\t\n\v\f\r"


@lru_cache(maxsize=1)
def unusual() -> re.Pattern:
    """Finds a character that isn't plain, or not of the scripts up to
    Cyrillic and general punctuation, whose classes are long settled."""
    usual = [c for c in map(chr, [*range(0x530), *range(0x2010, 0x2028), *range(0x2030, 0x205F)]) if plain(c)]
    return re.compile("[^" + "".join(map(re.escape, usual)) + "]")


class Encoder(dict):
    """Texts to raw ids with a tokenizer file.  A byte-level tokenizer without
    normalizer encodes each piece of its word pattern by itself, so the ids of
    a piece are kept: this dict maps pieces to raw ids.  Texts with unusual
    characters are given to the tokenizer whole."""

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        pre = self.tokenizer.pre_tokenizer
        self.by_piece = (self.tokenizer.normalizer is None and isinstance(pre, ByteLevel) and pre.use_regex
                         and not pre.add_prefix_space)
        self.pieces = re.compile(PIECES).findall
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.older: dict[str, bytes] = {}
        self.met = bytearray(1 << 23)
        self.model = self.tokenizer.model

    def __missing__(self, piece: str) -> bytes:
        out = self.older.get(piece)
        if out is None:
            out = self.one(piece)
            at = hash(piece) % len(self.met)
            if not self.met[at]:                         # most pieces are met once, they aren't kept
                self.met[at] = 1
                return out
        if len(self) >= MEMO_PIECES // 2:                # pieces not met again before the next time are dropped
            self.older = dict(self)
            self.clear()
        self[piece] = out
        return out

    def forget(self) -> None:
        """Free the kept pieces: between tasks a worker may idle for long."""
        self.clear()
        self.older = {}

    def one(self, piece: str) -> bytes:
        """The ids of a piece of the pattern: its bytes, as the model's symbols."""
        symbols = piece.replace(" ", SPACE) if piece.isascii() and piece.isprintable() else \
            piece.encode().decode("latin-1").translate(BYTE_SYMBOLS)
        return array("H" if self.dtype == "<u2" else "I", [t.id for t in self.model.tokenize(symbols)]).tobytes()

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def encode(self, text: str) -> bytes:
        if not self.by_piece or self.added and self.added.search(text) or unusual().search(text):
            return self.whole(text)
        return b"".join(map(self.__getitem__, self.pieces(text)))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


# -- minimal perfect hash ---------------------------------------------------

def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (textvec.mix(keys + np.uint64((level * textvec.BASE) % (1 << 64))) % np.uint64(size)).astype(np.int64)


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (textvec.mix(keys ^ FINGERPRINT_SEED) >> np.uint64(32)).astype(np.uint32)


@dataclass
class KeyHash:
    """Minimal perfect hash of distinct 64-bit keys: ``sizes`` bits per level,
    ``bits`` of all levels packed, ``ranks`` the set bits before each block."""
    sizes: list[int]
    bits: np.ndarray
    ranks: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray) -> KeyHash:
        sizes, bits, left = [], [], keys
        while len(left):
            size = -(-int(LOAD * len(left)) // BLOCK_BITS) * BLOCK_BITS
            at = _place(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            bits.append(np.packbits(alone, bitorder="little"))
            left = left[~alone[at]]
        packed = np.concatenate(bits) if bits else np.zeros(0, np.uint8)
        per_block = np.bitwise_count(packed).reshape(-1, BLOCK_BITS // 8).sum(axis=1, dtype=np.uint64)
        return cls(sizes, packed, np.cumsum(per_block) - per_block)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, 0 to n - 1; -1 for some keys that aren't in the set."""
        out = np.full(len(keys), -1, np.int64)
        left, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = base + _place(keys[left], level, size)
            hit = (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            out[left[hit]] = self._rank(at[hit])
            left, base = left[~hit], base + size
        return out

    def _rank(self, at: np.ndarray) -> np.ndarray:
        block, within = at // BLOCK_BITS, at % BLOCK_BITS
        bytes_ = self.bits.reshape(-1, BLOCK_BITS // 8)[block]
        before = np.arange(BLOCK_BITS // 8) < (within // 8)[:, None]
        count = np.where(before, np.bitwise_count(bytes_), 0).sum(axis=1, dtype=np.int64)
        last = bytes_[np.arange(len(at)), within // 8] & ((1 << (within % 8)) - 1).astype(np.uint8)
        return self.ranks[block].astype(np.int64) + count + np.bitwise_count(last)


@dataclass
class ShardIndex:
    """Keys of a shard to its documents: documents ``first[s]`` to
    ``first[s] + count[s]`` belong to the key in slot s, and the first
    ``n_null`` to none; document d has the ids ``offsets[d]`` to
    ``offsets[d + 1]`` of the payload."""
    hash: KeyHash
    fingerprints: np.ndarray
    first: np.ndarray
    count: np.ndarray
    offsets: np.ndarray
    dtype: str
    n_null: int = 0

    @classmethod
    def of(cls, keys: np.ndarray, lengths: np.ndarray, dtype: str, n_null: int = 0) -> ShardIndex:
        """From the numbers of ids of the documents, and the ascending keys of
        those after the first ``n_null``."""
        distinct, first, count = np.unique(keys, return_index=True, return_counts=True)
        distinct = distinct.view(np.uint64)
        h = KeyHash.of(distinct)
        order = np.argsort(h.slots(distinct))
        return cls(h, _fingerprint(distinct)[order], (first[order] + n_null).astype(np.uint32), count[order].astype(np.uint32),
                   np.concatenate(([0], np.cumsum(lengths))).astype(np.uint64), dtype, n_null)

    def documents(self, keys: np.ndarray) -> list[range]:
        """The documents of each key that the shard has (int64); an empty
        range if it has none."""
        slots = self.find(keys)
        return [range(int(self.first[s]), int(self.first[s]) + int(self.count[s])) if s >= 0 else range(0) for s in slots]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slots of int64 keys; -1 if the shard doesn't have the key."""
        keys = keys.view(np.uint64)
        slots = self.hash.slots(keys)
        if not len(self.fingerprints):
            return slots
        return np.where((slots >= 0) & (self.fingerprints[slots] == _fingerprint(keys)), slots, -1)

    def to_bytes(self) -> bytes:
        parts = [self.hash.bits, self.hash.ranks, self.fingerprints, self.first, self.count, self.offsets]
        head = json.dumps({"levels": self.hash.sizes, "dtype": self.dtype, "n_null": self.n_null,
                           "parts": [[p.dtype.str, len(p)] for p in parts]}).encode()
        return b"".join([MAGIC, struct.pack("<Q", len(head)), head, *(p.tobytes() for p in parts)])

    @classmethod
    def from_bytes(cls, raw: bytes) -> ShardIndex:
        if raw[:8] != MAGIC:
            raise ValueError("not an index file of a token store")
        size = struct.unpack_from("<Q", raw, 8)[0]
        head, at, parts = json.loads(raw[16:16 + size]), 16 + size, []
        for dtype, n in head["parts"]:
            parts.append(np.frombuffer(raw, dtype, n, at))
            at += parts[-1].nbytes
        return cls(KeyHash(head["levels"], parts[0], parts[1]), *parts[2:], head["dtype"], head["n_null"])


# -- files ------------------------------------------------------------------

def open_folder(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a folder given as Spark gives it."""
    if "://" in path and not path.startswith("file:"):
        return pyarrow.fs.FileSystem.from_uri(path)
    return pyarrow.fs.LocalFileSystem(), re.sub("^file:/+", "/", path)


def _put(fs: pyarrow.fs.FileSystem, made: str, name: str) -> None:
    """Give a complete file its name; an earlier attempt's equal file may be there."""
    if not isinstance(fs, pyarrow.fs.LocalFileSystem) and fs.get_file_info(name).type != pyarrow.fs.FileType.NotFound:
        fs.delete_file(name)
    fs.move(made, name)


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text, append ``end_id``, write the store, return its manifest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = open_folder(path)
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.dtype).tobytes()
        task = TaskContext.get()
        shard, attempt = task.partitionId(), task.taskAttemptId()
        keys, n_null, lengths, out = [], 0, [], None
        for b in textvec.parts(batches):
            if out is None:
                fs.create_dir(folder, recursive=True)
                out = fs.open_output_stream(f"{folder}/payload-{shard:06d}.{attempt}.part", buffer_size=1 << 20)
            n_null += b.column(0).null_count
            keys.append(b.column(0).drop_null().to_numpy())
            for text in b.column(1).to_pylist():
                ids = enc.encode(text) + end
                lengths.append(len(ids) // len(end))
                out.write(ids)
        enc.forget()
        if out is None:
            return
        out.close()
        keys = np.concatenate(keys)
        index = ShardIndex.of(keys, np.array(lengths, np.int64), enc.dtype, n_null)
        with fs.open_output_stream(f"{folder}/index-{shard:06d}.{attempt}.part") as f:
            f.write(index.to_bytes())
        for kind in ("payload", "index"):
            _put(fs, f"{folder}/{kind}-{shard:06d}.{attempt}.part", f"{folder}/{kind}-{shard:06d}.bin")
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), *(pa.array([x], pa.int64()) for x in (len(lengths), n_null, sum(lengths))),
             *(pa.array([int(k) for k in own], pa.int64()) if len(own) else pa.array([None], pa.int64()) for own in (keys[:1], keys[-1:]))],
            ["shard", "n_docs", "n_null", "n_ids", "first_key", "last_key"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).cast("bigint").alias("key"), text.alias("text"), F.substring(text, 1, TIE_CHARS).alias("begin"))
    (keyed.repartitionByRange(partitions_for(docs), "key", "begin").sortWithinPartitions("key", "text").select("key", "text")
     .mapInArrow(run, MANIFEST).write.parquet(f"{path}/manifest"))
    return docs.sparkSession.read.parquet(f"{path}/manifest")


@dataclass
class Shards:
    """The manifest, one entry per shard in key order; sent to every task
    (some 50 bytes a shard).  ``keyed`` are the entries with keys, ``first_key``
    and ``last_key`` theirs; ``unkeyed`` those with documents without a key."""
    path: str
    shard: np.ndarray
    start: np.ndarray
    keyed: np.ndarray
    first_key: np.ndarray
    last_key: np.ndarray
    unkeyed: np.ndarray

    @classmethod
    def of(cls, spark: SparkSession, path: str) -> Shards:
        m = spark.read.parquet(f"{path}/manifest").orderBy("shard").collect()
        n = np.array([r["n_ids"] for r in m], np.int64)
        keyed = [k for k, r in enumerate(m) if r["first_key"] is not None]
        first, last = (np.array([m[k][c] for k in keyed], np.int64) for c in ("first_key", "last_key"))
        return cls(path, np.array([r["shard"] for r in m], np.int64), np.cumsum(n) - n, np.array(keyed, np.int64), first, last,
                   np.array([k for k, r in enumerate(m) if r["n_null"]], np.int64))

    def of_keys(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the key, entry) of the shards whose ranges have the
        keys, one row for each; a key in no range has none."""
        low = np.searchsorted(self.last_key, keys, "left")
        n = np.maximum(np.searchsorted(self.first_key, keys, "right") - low, 0)
        which = np.repeat(np.arange(len(keys)), n)
        at = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        return which, self.keyed[at]

    def index(self, entry: int) -> ShardIndex:
        fs, folder = open_folder(self.path)
        with fs.open_input_file(f"{folder}/index-{self.shard[entry]:06d}.bin") as f:
            return ShardIndex.from_bytes(f.read())

    def payload(self, entry: int) -> pa.NativeFile:
        fs, folder = open_folder(self.path)
        return fs.open_input_file(f"{folder}/payload-{self.shard[entry]:06d}.bin")

    def get(self, key: int | None) -> list[np.ndarray]:
        """The ids of each document of a key, read by their byte ranges."""
        out = []
        for entry in self.unkeyed if key is None else self.of_keys(np.array([key], np.int64))[1]:
            index = self.index(entry)
            with self.payload(entry) as f:
                out += [_ids(index, f, d) for d in (range(index.n_null) if key is None else index.documents(np.array([key], np.int64))[0])]
        return out


def _ids(index: ShardIndex, payload: pa.NativeFile, d: int) -> np.ndarray:
    a, z, size = int(index.offsets[d]), int(index.offsets[d + 1]), np.dtype(index.dtype).itemsize
    return np.frombuffer(payload.read_at((z - a) * size, a * size), index.dtype)


def read_records(keys: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of the keys,
    read from the store: the keys, dealt by shard, go through the shard's
    perfect hash to payload ranges.  ``start`` counts the ids of all
    documents before; a key that the store doesn't have is an error."""
    spark = keys.sparkSession
    stored = Shards.of(spark, path)
    shared = spark.sparkContext.broadcast(stored)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = shared.value
        for b in textvec.parts(batches):
            named = b.column(0).drop_null()
            which, entry = shards.of_keys(named.to_numpy())
            if (lost := np.setdiff1d(np.arange(len(named)), which)).size:
                raise KeyError(f"no shard has the key {named[int(lost[0])]}")
            yield pa.RecordBatch.from_arrays([pa.array(entry, pa.int32()), named.take(pa.array(which))], ["entry", "key"])
            if b.column(0).null_count:
                if not len(shards.unkeyed):
                    raise KeyError("no shard has documents without a key")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shards.unkeyed, pa.int32()), pa.nulls(len(shards.unkeyed), pa.int64())], ["entry", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, opened = shared.value, None
        for b in textvec.parts(batches):
            entries = b.column(0).to_numpy()
            for entry in np.unique(entries):
                if opened is None or opened[0] != entry:
                    if opened:
                        opened[2].close()
                    opened = (entry, shards.index(entry), shards.payload(entry))
                own = b.column(1).filter(pa.array(entries == entry))
                yield from _records(opened[1], opened[2], int(shards.start[entry]), own)

    named = keys.select(F.col(id_col).cast("bigint").alias("key")).distinct()
    # a task for each shard: what it reads is the shard's payload, not its keys
    return (named.mapInArrow(place, "entry int, key bigint").repartitionById(max(1, len(stored.shard)), "entry")
            .sortWithinPartitions("entry", "key").mapInArrow(run, RECORDS))


def _records(index: ShardIndex, payload: pa.NativeFile, base: int, keys: pa.Array) -> Iterator[pa.RecordBatch]:
    """Records of the documents of a shard's keys, at most a few thousand at
    a time: a key may have very many."""
    named = keys.drop_null()
    documents = index.documents(named.to_numpy())
    if not all(documents):
        raise KeyError(f"the store doesn't have the key {named[[len(d) for d in documents].index(0)]}")
    rows: list[tuple] = []
    for key, own in [(None, range(index.n_null))] * bool(keys.null_count) + list(zip(named.to_pylist(), documents)):
        for d in own:
            ids = _ids(index, payload, d)
            rows.append((key, base + int(index.offsets[d]), len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
            if len(rows) == RECORD_ROWS:
                yield _record_batch(rows)
                rows = []
    yield _record_batch(rows)


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(4)],
                                      ["doc_id", "start", "n_tokens", "ids_crc32"])


def encode_and_read(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write a store in the shared folder and read all its records back."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_store(docs, path, tokenizer, end_id, id_col, text_col)
    return read_records(docs, path, id_col)
