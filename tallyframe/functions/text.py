from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The marks stripped from both ends of a word, and the characters that separate words, which are all of
# Unicode's white space and four separators beside it.
MARKS = ".,!?;:'\"()-"
_ASCII_SPACES = r"[\t-\r\x1C-\x20]+"
_SPACES = r"[\t-\r\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]+"


def clean(text: Column) -> Column:
    """Spaces off both ends."""
    return F.trim(text)


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def cased(text: Column, renamed: dict[str, str]) -> Column:
    """Replace the listed values, pass every other value through."""
    out = None
    for old, new in renamed.items():
        out = F.when(text == old, new) if out is None else out.when(text == old, new)
    return text if out is None else out.otherwise(text)


def strip_space(text: Column) -> Column:
    """Every kind of white space off both ends, not only spaces."""
    return F.regexp_replace(text, f"^{_SPACES}|{_SPACES}$", "")


def strip_marks(word: Column) -> Column:
    return F.btrim(word, F.lit(MARKS))


def words(text: Column) -> Column:
    """The words of a text as an array, split at any white space; no empty words."""
    return F.filter(split_words(text), lambda w: F.length(w) > 0)


def split_words(text: Column) -> Column:
    """As `words`, but white space at either end of the text leaves an empty word there. A text of ASCII only is split by the
    plain class, which is quicker."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.split(text, _ASCII_SPACES)).otherwise(F.split(text, _SPACES))


def part_before(text: Column, mark: str) -> Column:
    return F.split_part(text, F.lit(mark), F.lit(1))
