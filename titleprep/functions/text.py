"""Text expressions: title normalisation, tag normalisation, non-ASCII test.

Everything here is a Column expression, so it stays inside the JVM.  The one
exception is ``normalize_title(..., exact=True)``, an Arrow batch function for
letters that are newer than the JVM's Unicode tables.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Conjoining letters of Hangul syllables, from the Unicode standard (section 3.12).
_LEADS = "".join(chr(0x1100 + i) for i in range(19))
_VOWELS = "".join(chr(0x1161 + i) for i in range(21))
_TAILS = "".join(chr(0x11A7 + i) for i in range(1, 28))
_FIRST_SYLLABLE = 0xAC00
_LAST_SYLLABLE = 0xD7A3

# Python counts the four separator controls as white space; Java does not.
_SPACE = r"\s\x1c-\x1f"


@functools.cache
def _accent_table() -> tuple[str, str]:
    """Letters that lose an accent or a mark, and the letter each one becomes.

    Parts of a decomposition that are neither letters nor digits are dropped
    with the punctuation anyway, which leaves one letter for every character
    but the Hangul syllables.
    """
    source, target = [], []
    for code in range(0x80, sys.maxunicode + 1):
        ch = chr(code)
        if not unicodedata.decomposition(ch) or _FIRST_SYLLABLE <= code <= _LAST_SYLLABLE:
            continue
        letters = [
            c
            for c in unicodedata.normalize("NFD", ch)
            if c.isalnum() and unicodedata.category(c) != "Mn"
        ]
        if len(letters) == 1 and letters[0] != ch:
            source.append(ch)
            target.append(letters[0])
    return "".join(source), "".join(target)


def _split_hangul(text: Column) -> Column:
    """Hangul syllables written out as their conjoining letters."""

    def letters(ch: Column) -> Column:
        offset = F.ascii(ch) - F.lit(_FIRST_SYLLABLE)
        return F.when(
            ch.between(chr(_FIRST_SYLLABLE), chr(_LAST_SYLLABLE)),
            F.concat(
                F.substring(F.lit(_LEADS), F.floor(offset / 588).cast("int") + 1, F.lit(1)),
                F.substring(F.lit(_VOWELS), F.floor((offset % 588) / 28).cast("int") + 1, F.lit(1)),
                F.when(
                    offset % 28 > 0,
                    F.substring(F.lit(_TAILS), (offset % 28).cast("int"), F.lit(1)),
                ).otherwise(""),
            ),
        ).otherwise(ch)

    return F.array_join(F.transform(F.split(text, ""), letters), "")


def is_non_ascii(text: Column) -> Column:
    return text.rlike(r"[^\x00-\x7F]")


def _squeeze(text: Column, dropped: str, blanks: str) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(text, dropped, ""), blanks, " "))


def _spell_out(text: Column) -> Column:
    hangul = f"[{chr(_FIRST_SYLLABLE)}-{chr(_LAST_SYLLABLE)}]"
    return F.when(text.rlike(hangul), _split_hangul(text)).otherwise(text)


def _normalize_native(text: Column) -> Column:
    source, target = _accent_table()
    plain = _squeeze(F.lower(text), rf"[^a-z0-9_{_SPACE}]+", rf"[{_SPACE}]+")
    # combining marks are neither letters nor digits: they go with the punctuation
    wide = _squeeze(
        F.lower(F.translate(_spell_out(text), source, target)),
        rf"(?U)[^\p{{L}}\p{{N}}_{_SPACE}]+",
        rf"(?U)[{_SPACE}]+",
    )
    return F.when(is_non_ascii(text), wide).otherwise(plain)


def _normalize_exact(text: Column) -> Column:
    # a local function travels to the executors by value: they need not have this package
    def batch(titles: pd.Series) -> pd.Series:
        small = titles.astype("object").str.normalize("NFD").str.lower()
        kept = small.str.replace(r"[^\w\s]+", "", regex=True)
        return kept.str.split().str.join(" ")

    return F.pandas_udf(batch, StringType())(text)


def normalize_title(text: Column, exact: bool = False) -> Column:
    """Accents off, lower case, letters, digits and ``_`` only, single spaces.

    Null stays null.  The native form differs from ``exact=True`` only on
    letters and digits newer than the JVM's Unicode version.
    """
    return _normalize_exact(text) if exact else _normalize_native(text)


def normalize_tags(tags: Column) -> Column:
    """A comma list with every tag stripped, lower-cased, `` `` to ``_``, ``&`` to ``and``."""
    blank = f"[{_SPACE}]"
    lists = F.regexp_replace(F.lower(tags), rf"(?U)^{blank}+|{blank}+$", "")
    # plain commas stay as they are: long lists have little else
    lists = F.regexp_replace(lists, rf"(?U){blank}+,{blank}*|,{blank}+", ",")
    return F.replace(F.replace(lists, F.lit(" "), F.lit("_")), F.lit("&"), F.lit("and"))
