"""URL filter: host and path rules first, then a weighted vocabulary.

The vocabulary is a file or table of terms with whole-number weights; a term of weight
``LIMIT`` or more is strict, all others are soft. One Aho-Corasick automaton finds all of them
in one pass over the url; a hit counts when no ASCII letter or digit stands directly before or
after it. One strict term rejects, and so do several different soft terms whose weights
together reach the limit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from pathlib import Path

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wanderlake.llm.common import scored

VOCABULARY = Path(__file__).with_name("url_terms.tsv")
LIMIT = 100
SEVERAL = 2


@dataclass(frozen=True)
class Rule:
    """Decides for ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_WORD = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def split_url(url: str | None) -> tuple[str, str]:
    """Host with A-Z in lower case and path; both empty without ``://``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    after = rest[end:]
    stop = min((i for i in map(after.find, "?#") if i >= 0), default=len(after))
    return rest[:end].translate(_LOWER), after[:stop]


def read_vocabulary(path: str | Path = VOCABULARY) -> dict[str, int]:
    """Terms and weights of a file of the driver: one term a line, a tab, its weight."""
    lines = Path(path).read_text("utf-8").splitlines()
    return {term: int(weight) for term, weight in (line.split("\t") for line in lines if line.strip())}


def vocabulary_of(table: DataFrame, most: int = 1_000_000) -> dict[str, int]:
    """Terms and weights of a table ``term, weight``: the largest weight of a term, no blank ones.

    The automaton is made in every task, so a table of more than ``most`` terms raises.
    """
    rows = table.filter((F.trim("term") != "") & F.col("weight").isNotNull()).groupBy(F.lower(F.trim("term")).alias("term"))
    rows = rows.agg(F.max("weight").cast("int").alias("weight")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"the vocabulary has more than {most} terms")
    return {r["term"]: r["weight"] for r in rows}


class UrlJudge:
    """Rules by host suffix and the vocabulary's automaton."""

    def __init__(self, rules: Sequence[Rule], terms: Mapping[str, int], limit: int = LIMIT):
        self.by_host: dict[str, list[Rule]] = {}
        for rule in sorted(rules, key=lambda r: -len(r.name)):
            self.by_host.setdefault(rule.host, []).append(rule)
        self.limit = limit
        self.terms = ahocorasick.Automaton()
        for term, weight in terms.items():
            self.terms.add_word(term, (term, weight))
        if terms:
            self.terms.make_automaton()

    def rule_for(self, host: str, path: str) -> Rule | None:
        """The longest rule that fits; every suffix of the host at a dot is looked up once."""
        best, at = None, 0
        while host and at >= 0:
            for rule in self.by_host.get(host[at:], ()):
                if path.startswith(rule.path) and (best is None or len(rule.name) > len(best.name)):
                    best = rule
            dot = host.find(".", at)
            at = dot + 1 if dot >= 0 else -1
        return best

    def hits(self, url: str | None) -> dict[str, int]:
        """Different terms that stand alone in the url, with their weights."""
        text, found = (url or "").translate(_LOWER), {}
        for end, (term, weight) in self.terms.iter(text) if len(self.terms) else ():
            start = end + 1 - len(term)
            if text[start - 1 : start] not in _WORD and text[end + 1 : end + 2] not in _WORD:
                found[term] = weight
        return found

    def judge(self, url: str | None) -> tuple[str, str, str | None, str, int, int, int]:
        host, path = split_url(url)
        rule, found = self.rule_for(host, path), self.hits(url)
        soft = [w for w in found.values() if w < self.limit]
        strict = len(found) - len(soft)
        rejected = strict > 0 or (len(soft) >= SEVERAL and sum(soft) >= self.limit)
        by_terms = "block" if rejected else "allow"
        return host, path, rule and rule.name, rule.verdict if rule else by_terms, strict, len(soft), sum(soft)


def judge_urls(df: DataFrame, url: str = "url", rules: Sequence[Rule] = RULES, terms: Mapping[str, int] | None = None, limit: int = LIMIT) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``verdict``, ``strict_terms``, ``soft_terms`` and ``soft_weight``.

    ``verdict`` is that of the longest fitting rule, else the vocabulary's: ``block`` with a
    strict term, or with several different soft terms whose weights reach ``limit``, else
    ``allow``. ``terms`` maps lower-case terms to weights (``read_vocabulary`` or
    ``vocabulary_of``; the package's own file if none are given). A null url has an empty host
    and path, no terms, and is allowed. Each row is judged alone: repeated rows stay, an empty
    table stays empty. Columns of the added names are replaced.
    """
    names = ("host", "path", "rule", "verdict", "strict_terms", "soft_terms", "soft_weight")
    kinds = (T.StringType(),) * 4 + (T.IntegerType(),) * 3
    fields = [T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]
    terms = read_vocabulary() if terms is None else dict(terms)

    def scorer():
        judge = UrlJudge(rules, terms, limit).judge
        return lambda urls: list(zip(*map(judge, urls), strict=True)) or [[]] * len(names)

    return scored(df, url, fields, scorer)
