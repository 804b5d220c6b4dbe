"""URL rules indexed by their rarest literal token.

Every rule is a regular expression with known literal tokens (runs of ASCII
letters and digits that can't be part of a longer run in a matching URL).
One scan counts how many URLs hold each token that occurs in a rule; each
rule is then filed under the rarest of its tokens.  A URL's own tokens fetch
the rules filed under them, and only those run their expression.  Rules
without a token are tried on every URL.

* ``HostRule``: a host, with all subdomains, and a path prefix.  The longest
  rule that fits decides.
* ``PatternRule``: a URL pattern where ``*`` stands for anything, for URLs no
  host rule fits: block if a blocking pattern matches and no allowing one.

The rules are a configuration: they are sent to every task.  URLs aren't
shuffled.

Defined results: the host is what follows the first ``://`` up to ``/``,
``?``, ``#`` or the end, A-Z lower-cased, the path what follows up to ``?``,
``#`` or the end; both are empty for a null URL or one without ``://``, which
no rule fits; such a URL is allowed; of equally long rules the first listed
decides; repeated rows each get their result; extra columns are ignored.
"""

from __future__ import annotations

import re
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTS = re.compile(r"://([^/?#]*)([^?#]*)")
TOKEN = re.compile(r"[a-z0-9]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)

JUDGED = "page_id bigint, host string, path string, rule string, verdict string"


@dataclass(frozen=True)
class HostRule:
    action: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def regex(self) -> re.Pattern:
        """Matched from the start of host, NUL, path."""
        return re.compile(rf"(?:[^\0]*\.)?{re.escape(self.host)}\0{re.escape(self.path)}")

    def tokens(self) -> set[str]:
        path = self.path.translate(LOWER)
        return set(TOKEN.findall(self.host)) | {m[0] for m in TOKEN.finditer(path) if m.end() < len(path)}


@dataclass(frozen=True)
class PatternRule:
    action: str
    pattern: str

    @property
    def name(self) -> str:
        return self.pattern

    def regex(self) -> re.Pattern:
        """Matched on the whole URL, lower-cased."""
        return re.compile(".*".join(map(re.escape, self.pattern.split("*"))) + r"\Z", re.DOTALL)

    def tokens(self) -> set[str]:
        """Runs that don't touch a wildcard."""
        p = self.pattern
        return {m[0] for m in TOKEN.finditer(p) if p[m.start() - 1:m.start()] != "*" and p[m.end():m.end() + 1] != "*"}


Rule = HostRule | PatternRule


def split_url(url: str | None) -> tuple[str, str]:
    m = PARTS.search(url or "")
    return (m[1].translate(LOWER), m[2]) if m else ("", "")


def token_counts(urls: DataFrame, tokens: set[str], url_col: str = "url") -> dict[str, int]:
    """URLs that hold each of the tokens, over the whole table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()
        for b in batches:
            for url in b.column(0).to_pylist():
                n.update(tokens.intersection(TOKEN.findall((url or "").translate(LOWER))))
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], ["token", "n"])

    rows = urls.select(url_col).mapInArrow(run, "token string, n bigint").groupBy("token").agg(F.sum("n").alias("n")).collect()
    return {r["token"]: r["n"] for r in rows}


class RuleIndex:
    """Rule numbers by their rarest token; ``always`` have none."""

    def __init__(self, rules: list[Rule], counts: dict[str, int]):
        self.rules = rules
        self.by_token: dict[str, list[int]] = {}
        self.always: list[int] = []
        for k, rule in enumerate(rules):
            if tokens := rule.tokens():
                rarest = min(tokens, key=lambda t: (counts.get(t, 0), -len(t), t))
                self.by_token.setdefault(rarest, []).append(k)
            else:
                self.always.append(k)

    def judge(self, url: str | None, regexes: list[re.Pattern]) -> tuple[str, str, str | None, str]:
        """(host, path, host rule that decides, verdict)."""
        host, path = split_url(url)
        if not host and not path:
            return host, path, None, "allow"
        low = url.translate(LOWER)
        subject = f"{host}\0{path}"
        candidates = {k for t in set(TOKEN.findall(low)) for k in self.by_token.get(t, ())}.union(self.always)
        best, patterns = None, set()
        for k in sorted(candidates):
            rule = self.rules[k]
            if isinstance(rule, HostRule):
                if (best is None or len(rule.name) > len(best.name)) and regexes[k].match(subject):
                    best = rule
            elif regexes[k].match(low):
                patterns.add(rule.action)
        if best:
            return host, path, best.name, best.action
        return host, path, None, "block" if patterns == {"block"} else "allow"


def judge_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page."""
    index = RuleIndex(rules, token_counts(pages, set().union(*(r.tokens() for r in rules)), url_col))
    shared = pages.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared.value
        regexes = [r.regex() for r in ix.rules]
        for b in batches:
            rows = [ix.judge(url, regexes) for url in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array([r[k] for r in rows], pa.string()) for k in range(4))],
                ["page_id", "host", "path", "rule", "verdict"])

    return pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url")).mapInArrow(run, JUDGED)
