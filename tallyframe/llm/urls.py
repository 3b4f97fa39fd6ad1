"""URL filtering by a weighted vocabulary of terms, after host and path rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyframe.llm.rowwise import per_text

#: One of these is enough to reject an address.
STRICT_TERMS = ("casino", "porn", "xxx", "viagra", "gambling", "spam", "malware", "phishing", "hentai", "escorts")
#: Several different ones reject it.
SOFT_TERMS = (
    "ads", "adult", "bet", "bets", "bonus", "cheap", "coupon", "dating", "deal", "discount", "farm", "free", "jackpot", "loan",
    "pills", "poker", "promo", "sexy", "slots", "track", "tracker", "win", "x")

FIELDS = [
    T.StructField("host", T.StringType()), T.StructField("path", T.StringType()), T.StructField("rule", T.StringType()),
    T.StructField("verdict", T.StringType()), T.StructField("strict_hits", T.LongType()),
    T.StructField("soft_hits", T.LongType()), T.StructField("terms", T.ArrayType(T.StringType()))]


@dataclass(frozen=True)
class Rule:
    """A verdict for a host, its subdomains, and the paths that start with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def parts(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of an address; both empty for NULL or without `://`."""
    before, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, rest = rest[:end], rest[end:]
    end = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    return host.encode().lower().decode(), rest[:end]


class Rules:
    """Longest fitting rule, looked up by host suffix: the work depends on the labels of a host, not on the rules."""

    def __init__(self, rules: Sequence[Rule]):
        self.by_host: dict[str, list[Rule]] = {}
        for rule in rules:
            self.by_host.setdefault(rule.host, []).append(rule)

    def fitting(self, host: str, path: str) -> Rule | None:
        labels, found = host.split("."), []
        for i in range(len(labels)):
            found += [r for r in self.by_host.get(".".join(labels[i:]), ()) if path.startswith(r.path)]
        return max(found, key=lambda r: (len(r.name), r.verdict == "block"), default=None)


class Vocabulary:
    """Strict and soft terms in one Aho-Corasick automaton; a hit needs a boundary on both sides."""

    def __init__(self, strict: Sequence[str], soft: Sequence[str]):
        self.strict = frozenset(strict)
        self.automaton = ahocorasick.Automaton()
        for term in {*strict, *soft}:
            self.automaton.add_word(term, term)
        self.automaton.make_automaton()

    def hits(self, url: str) -> tuple[int, list[str]]:
        """Number of strict hits, and the different soft terms hit, in order of the alphabet."""
        low, strict, soft = url.encode().lower().decode(), 0, set()
        for last, term in self.automaton.iter(low):
            before, after = low[last - len(term):last - len(term) + 1] if last >= len(term) else "", low[last + 1:last + 2]
            if _inside(before) or _inside(after):
                continue
            if term in self.strict:
                strict += 1
            else:
                soft.add(term)
        return strict, sorted(soft)


def _inside(character: str) -> bool:
    """An ASCII letter or digit continues a word; anything else, and the end, is a boundary."""
    return character.isascii() and character.isalnum()


def judge_urls(
    df: DataFrame, key: str | Sequence[str] = "page_id", url: str = "url", rules: Sequence[Rule] = (),
    strict: Sequence[str] = STRICT_TERMS, soft: Sequence[str] = SOFT_TERMS, soft_limit: int = 2,
) -> DataFrame:
    """One row per row of `df`: the key, host, path, the longest fitting rule's name or NULL, the verdict, and the hits.

    Without a fitting rule an address is blocked on one strict hit or `soft_limit` different soft terms. The terms are
    sought in the whole address, A-Z lower-cased, between characters that are no ASCII letter or digit. A term in both
    lists is strict. NULL and empty addresses have empty host and path, no hits, and are allowed. Equal rows are judged
    alike; an empty table gives no rows; other columns are not read. Rules and terms are parameters held by each task,
    never gathered from the data. No shuffle.
    """
    rules, strict, soft = tuple(rules), tuple(strict), tuple(soft)

    def setup():
        book, vocabulary = Rules(rules), Vocabulary(strict, soft)

        def work(urls):
            rows = []
            for address in urls:
                host, path = parts(address)
                rule = book.fitting(host, path)
                hard, terms = vocabulary.hits(address or "")
                verdict = rule.verdict if rule else "block" if hard or len(terms) >= soft_limit else "allow"
                rows.append((host, path, rule.name if rule else None, verdict, hard, len(terms), terms))
            return list(zip(*rows, strict=True))

        return work

    return per_text(df, key, url, FIELDS, setup)
