"""Scalar text functions as column expressions, with Python's meaning of white space, digits and line ends."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space that ``str.strip`` removes.
WHITE = r"[\s\p{Z}\x{1C}-\x{1F}\x{85}]"


@lru_cache(1)
def digit_class() -> str:
    """A character class of all that ``str.isdigit`` accepts, for Java and RE2: Nd, and the other digits as ranges."""
    others, runs = [c for c in range(sys.maxunicode + 1) if chr(c).isdigit() and unicodedata.category(chr(c)) != "Nd"], []
    for c in others:
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return r"[\p{Nd}" + "".join(rf"\x{{{a:X}}}" if a == b else rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in runs) + "]"


def strip(col: Column) -> Column:
    return F.regexp_replace(col, f"^{WHITE}+|{WHITE}+$", "")


def occurrences(col: Column, literal: str) -> Column:
    """How often ``literal`` occurs, without overlaps."""
    return ((F.length(col) - F.length(F.replace(col, F.lit(literal), F.lit("")))) / len(literal)).cast("int")


def matches(col: Column, character_class: str) -> Column:
    """Number of characters of a class."""
    return F.length(col) - F.length(F.regexp_replace(col, character_class, ""))


def share(col: Column, first: int, last: int) -> Column:
    """Share of characters from ``first`` to ``last``; null for an empty text."""
    return F.when(F.length(col) > 0, matches(col, rf"[\x{{{first:X}}}-\x{{{last:X}}}]") / F.length(col))


def characters(col: Column) -> Column:
    """Code points as an array."""
    return F.regexp_extract_all(col, F.lit("(?s)."), F.lit(0))


def grams(col: Column, n: int) -> Column:
    """All character ``n``-grams in order; an empty array for texts that are shorter. Linear in the text's length.

    The characters are bound to a variable, as an expression inside a lambda is evaluated for each element.
    """

    def of(c: Column) -> Column:
        made = F.transform(F.sequence(F.lit(0), F.size(c) - n), lambda i: F.concat(*[F.get(c, i + k) for k in range(n)]))
        return F.when(F.size(c) >= n, made).otherwise(F.array().cast("array<string>"))

    return F.get(F.transform(F.array(characters(col)), of), F.lit(0))


def sentences(col: Column, end: str = "。") -> Column:
    """Stripped parts between ``end``, empty ones left out."""
    return F.filter(F.transform(F.split(col, end), strip), lambda s: s != "")


def mean_length(parts: Column) -> Column:
    """Mean length of the parts; null where there are none."""
    return F.when(F.size(parts) > 0, F.aggregate(parts, F.lit(0), lambda a, s: a + F.length(s)) / F.size(parts))


def python_regex(pattern: str) -> str:
    """``pattern`` with Python's Unicode classes and line ends, for Java."""
    return f"(?Ud){pattern}"
