"""URL filters: a weighted vocabulary, after an ordered list of host and path rules."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import batch_of, map_batches, rows_of

# The rules of the production list, as (verdict, rule).
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)

# One strict term is enough to reject.
STRICT_TERMS = (
    "adult", "casino", "malware", "phishing", "porn", "spam", "viagra", "warez", "xxx",
)

# Soft terms only count together.
SOFT_TERMS = (
    "ads", "bet", "bets", "bonus", "cheap", "coupon", "deals", "farm", "free", "loan",
    "pills", "poker", "promo", "sex", "track", "win",
)

SOFT_HITS = 2

_ASCII_LOWER = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}
_HOST = re.compile(r"[^/?#]*")
_PATH = re.compile(r"[^?#]*")
_ALNUM = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def split_url(url: str | None) -> tuple[str, str]:
    """Lower-cased host and path; both empty without ``://``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    host = _HOST.match(rest)[0]
    return host.translate(_ASCII_LOWER), _PATH.match(rest, len(host))[0]


class Rules:
    """Rules by host; the longest that fits decides, the first of equals."""

    def __init__(self, rules: Iterable[tuple[str, str]]):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, rule in rules:
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host.translate(_ASCII_LOWER), []).append(
                (slash + path, rule, verdict)
            )

    def decide(self, host: str, path: str) -> tuple[str | None, str | None]:
        best: tuple[str | None, str | None] = (None, None)
        name = host
        while name:
            for start, rule, verdict in self.by_host.get(name, ()):
                if path.startswith(start) and (best[0] is None or len(rule) > len(best[0])):
                    best = rule, verdict
            name = name.partition(".")[2]
        return best


@dataclass(frozen=True)
class Vocabulary:
    """Strict and soft terms; a term counts where no letter or digit adjoins it."""

    strict: tuple[str, ...] = STRICT_TERMS
    soft: tuple[str, ...] = SOFT_TERMS
    soft_hits: int = SOFT_HITS

    def automaton(self) -> ahocorasick.Automaton | None:
        machine = ahocorasick.Automaton()
        for strict, terms in ((False, self.soft), (True, self.strict)):
            for term in terms:
                if term:
                    machine.add_word(term.translate(_ASCII_LOWER), (strict, term, len(term)))
        if not len(machine):
            return None
        machine.make_automaton()
        return machine


def term_hits(machine: ahocorasick.Automaton | None, url: str | None) -> tuple[int, int, int]:
    """Strict hits, distinct soft terms, all soft hits."""
    text = (url or "").translate(_ASCII_LOWER)
    if machine is None or not text:
        return 0, 0, 0
    strict, soft, n_soft = 0, set(), 0
    for last, (is_strict, term, length) in machine.iter(text):
        first = last - length + 1
        if first and text[first - 1] in _ALNUM or text[last + 1 : last + 2] in _ALNUM:
            continue
        if is_strict:
            strict += 1
        else:
            soft.add(term)
            n_soft += 1
    return strict, len(soft), n_soft


_SCHEMA = pa.schema(
    [
        ("page_id", pa.int64()),
        ("host", pa.string()),
        ("path", pa.string()),
        ("rule", pa.string()),
        ("verdict", pa.string()),
        ("n_strict", pa.int64()),
        ("n_soft", pa.int64()),
        ("n_soft_hits", pa.int64()),
    ]
)


def filter_urls(
    pages: DataFrame,
    rules: Iterable[tuple[str, str]] = RULES,
    vocabulary: Vocabulary = Vocabulary(),
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """One verdict per row, ``allow`` or ``block``.

    A rule decides if one fits the host (or a domain above it) and the start of the path.
    Otherwise one strict term blocks, and so do ``soft_hits`` different soft terms. A null or
    empty url has an empty host and path, no rule and no term, so it is allowed. Repeated rows
    stay, each with its verdict; only the two named columns are read. No shuffle.
    """
    rules = tuple(rules)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_host, machine = Rules(rules), vocabulary.automaton()
        for batch in batches:
            out = []
            for page, url in rows_of(batch):
                host, path = split_url(url)
                rule, verdict = by_host.decide(host, path)
                strict, soft, soft_all = term_hits(machine, url)
                if verdict is None:
                    bad = strict > 0 or soft >= vocabulary.soft_hits
                    verdict = "block" if bad else "allow"
                out.append((page, host, path, rule, verdict, strict, soft, soft_all))
            yield batch_of(out, _SCHEMA)

    return map_batches(
        pages.select(id_column, url_column),
        judge,
        "page_id long, host string, path string, rule string, verdict string,"
        " n_strict long, n_soft long, n_soft_hits long",
    )
