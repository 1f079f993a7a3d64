"""Text expressions: line clean-up, word splitting, content checks."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the letters that make up a word in the word reports.
REPORT_LETTERS = "а-яА-Яa-zA-Z"
# Pass this instead to count words of every script.
ANY_SCRIPT = r"\p{L}"

_LAST_CODE_POINT = 0x10FFFF


def _others(letters: str, keep: str = "") -> str:
    """A character class of everything but the given letters.

    It lists the other code points instead of negating the class: Java matches
    `[^а-яА-Яa-zA-Z]` five to ten times slower than the equal positive class.
    """
    if letters == ANY_SCRIPT:
        return f"[\\P{{L}}&&[^{keep}]]" if keep else r"\P{L}"
    pairs = re.findall(r"(.)(?:-(.))?", letters + keep, re.DOTALL)
    gaps, start = [], 0
    for low, high in sorted((ord(a), ord(b or a)) for a, b in pairs):
        if low > start:
            gaps.append((start, low - 1))
        start = max(start, high + 1)
    gaps.append((start, _LAST_CODE_POINT))
    return "[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in gaps) + "]"


def one_line(text: Column) -> Column:
    """Line breaks become spaces; spaces at both ends go."""
    spaced = F.replace(F.replace(text, F.lit("\n"), F.lit(" ")), F.lit("\r"), F.lit(" "))
    return F.trim(spaced)


def space_words(text: Column) -> Column:
    """The pieces between single spaces."""
    return F.split(text, " ")


def lower_space_words(text: Column) -> Column:
    """The pieces between single spaces, lower case."""
    return F.split(F.lower(text), " ")


def letter_words(text: Column, letters: str = REPORT_LETTERS) -> Column:
    """Lower-case runs of letters; anything else separates."""
    return F.split(F.lower(text), f"{_others(letters)}+")


def stripped_words(text: Column, letters: str = REPORT_LETTERS) -> Column:
    """The pieces between spaces with their non-letters taken out, lower case.

    The text is cleaned once as a whole, which gives the same pieces as
    cleaning each of them, with one regular-expression pass per row.
    """
    return F.split(F.lower(F.regexp_replace(text, f"{_others(letters, ' ')}+", "")), " ")


def is_content(text: Column) -> Column:
    """Not null, not the number NaN, and longer than one character when trimmed."""
    as_number = text.try_cast("double")
    not_nan = F.coalesce(~F.isnan(as_number), F.lit(True))
    return text.isNotNull() & not_nan & (F.length(F.trim(text)) > 1)


def preview(text: Column, chars: int = 80) -> Column:
    """The start of a text, for reports."""
    return F.substring(text, 1, chars)
