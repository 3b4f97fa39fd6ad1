"""Line-first cleaning: lines are judged and removed one by one, then documents that lost too much are rejected."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyframe.llm.rowwise import per_text, shingle_hashes, word_hashes

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
_SPACES = re.compile("[\x20\x09-\x0d]")
_SYMBOLS = re.compile(r"[#*$%&|<>]")
#: Endings of a finished sentence or a heading.
_ENDINGS = (".", "!", "?", ":", ";", "…", "\"", "'", "”", "’", "»", ")", "]", "。", "！", "？", "،", "؟", "।")
#: Words whose lines are page furniture when they make up the line.
_NAVIGATION = frozenset(
    "home menu login logout register search contact about sitemap next previous back share tweet print subscribe "
    "newsletter cart checkout account help faq rss".split())
#: Phrases of notices, sought in the lower-cased line.
_BOILERPLATE = re.compile(
    r"all rights reserved|terms of (?:use|service)|privacy policy|cookie policy|use of cookies|uses cookies|accept cookies|"
    r"click here|read more|javascript (?:is|must)|lorem ipsum|skip to (?:main )?content|powered by|sign up for|"
    r"licensed under the|released under the|spdx-license-identifier|copyright \(c\)|©")
_SENTENCE_END = re.compile(r"[.!?…][\"'”’»)\]]*[ \t]")
_SHOUTED = re.compile(r"!!|\?\?")


@dataclass(frozen=True)
class Limits:
    """Thresholds; shares are of the characters or words of a line or document."""

    symbol_share: float = 0.1  #: a line with more symbols than this fails
    separators: int = 3  #: a line of items with at least so many ` | ` between them fails
    upper_share: float = 0.7  #: a line of three words or more, with more capitals among its letters than this, fails
    shouted_share: float = 0.3  #: a line with more words ending in !! or ?? than this fails
    same_word_share: float = 0.4  #: a line of ten words or more, with one of them more often than this, fails
    lost_share: float = 0.5  #: a document that loses more of its word characters than this is rejected


def failing(line: str, limits: Limits = Limits()) -> str | None:
    """The rule a line fails, or NULL; the line has at least one word."""
    words = line.split()
    if not words:  # only white space beyond ASCII
        return None
    size = sum(map(len, words))
    if len(_SYMBOLS.findall(line)) > limits.symbol_share * size:
        return "navigation" if line.count(" | ") >= limits.separators else "symbols"
    if line.count(" | ") >= limits.separators:
        return "navigation"
    low = line.lower()
    if _BOILERPLATE.search(low):
        return "boilerplate"
    if all(w.strip(".,:;!?>»|-") in _NAVIGATION for w in low.split()):
        return "navigation"
    if sum(bool(_SHOUTED.search(w)) for w in words) > limits.shouted_share * len(words):
        return "punctuation"
    letters = [c for c in line if c.isalpha()]
    if len(words) >= 3 and sum(map(str.isupper, letters)) > limits.upper_share * max(1, len(letters)):
        return "shouting"
    if len(words) >= 10 and Counter(words).most_common(1)[0][1] > limits.same_word_share * len(words):
        return "repetition"
    if not line.rstrip().endswith(_ENDINGS) and not _SENTENCE_END.search(line):
        return "punctuation"
    return None


def measures(text: str) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines, and words in 3-word windows found at least twice."""
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    repeated = 0
    if len(words) >= 3:
        windows = shingle_hashes(word_hashes(words), 3)
        _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
        twice = counts[inverse] >= 2
        covered = np.zeros(len(words), bool)
        for i in range(3):
            covered[i:i + len(twice)] |= twice
        repeated = int(covered.sum())
    return (
        len(words), len(text) - len(_SPACES.findall(text)), len(_SYMBOLS.findall(text)),
        len(lines) - len(set(lines)), repeated)


FIELDS = [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [
    T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
    T.StructField("lost_share", T.DoubleType()), T.StructField("n_removed_lines", T.LongType()),
    T.StructField("removed_by", T.MapType(T.StringType(), T.LongType())), T.StructField("clean_text", T.StringType())]


def clean_lines(
    df: DataFrame, key: str = "doc_id", text: str = "text", limits: Limits = Limits(), min_words: int = 50,
    repeat_percent: int = 50, with_text: bool = True,
) -> DataFrame:
    """One row per row of `df`: base measures, whether the document stays, what was removed and the text left.

    Every line (split at \\n) with a word is judged by itself; failing lines go, lines without a word stay. `kept` is
    false below `min_words` words, when more than `repeat_percent` per cent of the words are in repeated 3-word windows,
    or when more than `limits.lost_share` of the word characters were lost. NULL and empty texts have zero measures, an
    empty clean text, and are not kept. Equal rows are judged alike; an empty table gives no rows; other columns are not
    read. Whole texts, one pass, no shuffle. `with_text=False` leaves `clean_text` NULL.
    """

    def setup():
        def work(texts):
            rows = []
            for t in texts:
                t = t or ""
                n, chars, symbols, doubled, repeated = measures(t)
                base = n < min_words or 100 * repeated > repeat_percent * n
                removed, kept, lost = Counter(), [], 0
                for line in t.split("\n"):
                    rule = failing(line, limits) if line.strip(SPACE) else None
                    if rule:
                        removed[rule] += 1
                        lost += len(line) - len(_SPACES.findall(line))
                    else:
                        kept.append(line)
                share = lost / chars if chars else 0.0
                rows.append((
                    n, chars, symbols, doubled, repeated, base, not base and share <= limits.lost_share, share,
                    sum(removed.values()), list(removed.items()), "\n".join(kept) if with_text else None))
            return list(zip(*rows, strict=True))

        return work

    return per_text(df, key, text, FIELDS, setup)
