"""Secret scans: Aho-Corasick keyword prefilter, anchored regular expressions
only where a keyword was hit, checksum validation of the tokens that carry one.

Every text is scanned whole, in the task that reads it; there is no shuffle.

* Keywords of all kinds form one automaton, run once over the lower-cased
  text.  At each hit the kind's pattern is matched anchored there.
* ``hex`` has no literal to look for: its prefilter is the run itself (16 or
  more of 0-9a-f), found by one search.
* ``github``, ``npm`` and ``iban`` count only if their embedded checksum
  holds; ``key`` is a private key's header line.

Defined results: a null or empty text has no spans; offsets are code points,
end exclusive; spans of a kind do not overlap, different kinds may; repeated
rows each get their result; extra columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re
import string
import zlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from kiln.llm import textvec

#: Fixed by the contract of the base kinds, in the order of ties.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "github", "npm", "iban", "key")
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 12, 18, 16

PATTERNS = {
    "assign": re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                         re.IGNORECASE | re.ASCII),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "github": re.compile(r"gh[oprsu]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
    "npm": re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
    "iban": re.compile(r"iban:?\x20*([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Z0-9])", re.IGNORECASE | re.ASCII),
    "key": re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
}
HEX = re.compile(r"[0-9a-f]{%d,}" % HEX_LENGTH)
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "api_key", "apikey"),
    "access": ("akia",),
    "github": ("gho_", "ghp_", "ghr_", "ghs_", "ghu_"),
    "npm": ("npm_",),
    "iban": ("iban",),
    "key": ("-----begin ",),
}
BASE62 = string.digits + string.ascii_uppercase + string.ascii_lowercase
LOWER_ASCII = {ord(c): c.lower() for c in string.ascii_uppercase}

SCHEMA = "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint>>"


def crc32_base62(body: str) -> str:
    """Six base-62 digits of the body's CRC-32, the tail of such tokens."""
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, digit = divmod(n, 62)
        out = BASE62[digit] + out
    return out


def iban_holds(value: str) -> bool:
    """ISO 7064 mod 97: country and check digits moved to the end, letters as
    10 to 35."""
    value = value.replace(" ", "").upper()
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def keeps(kind: str, m: re.Match) -> bool:
    if kind == "assign":
        return len(m[1]) >= ASSIGN_VALUE
    if kind == "access":
        return len(m[0]) >= ACCESS_LENGTH
    if kind in ("github", "npm"):
        return crc32_base62(m[1]) == m[2]
    if kind == "iban":
        return iban_holds(m[1])
    return True


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for kind, literals in KEYWORDS.items():
        for w in literals:
            a.add_word(w, (kind, len(w)))
    a.make_automaton()
    return a


def scan(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all spans, by start and then kind as listed."""
    if not text:
        return []
    low = text.lower()
    if len(low) != len(text):                       # a letter whose lower case is longer
        low = text.translate(LOWER_ASCII)
    found = [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    hits = sorted((end + 1 - size, kind) for end, (kind, size) in automaton().iter(low))
    done: dict[str, int] = {}
    for at, kind in hits:
        # As a search would: leftmost first, what a match took is used up
        # whether or not it is kept.
        if at >= done.get(kind, 0) and (m := PATTERNS[kind].match(text, at)):
            done[kind] = m.end()
            if keeps(kind, m):
                found.append((at, m.end(), kind))
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): every text with its secret spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in textvec.parts(batches):
            spans = [[{"kind": k, "start": s, "end": e} for s, e, k in scan(t)] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, kind)], ["doc_id", "spans"])

    return docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, SCHEMA)


def digest(spans: str) -> str:
    return hashlib.sha256(spans.encode()).hexdigest()
