"""Text cleaning expressions.

``strip_accents`` reproduces this definition of text normalisation exactly:

    NFD-decompose; drop combining marks U+0300..U+036F; drop every character that is not an
    ASCII letter, an ASCII digit or Unicode whitespace; collapse whitespace runs to one space;
    strip; lower-case.  NULL stays NULL.

It is evaluated with native Spark expressions only, so no Python worker is involved:

1. one ``translate`` maps every character at once: accented letters to their lower-case
   ASCII base letter, ``A-Z`` to ``a-z``, and every Unicode whitespace character to a space;
2. ``regexp_replace('[^a-z0-9 ]+', '')`` drops everything else;
3. ``regexp_replace('  +', ' ')`` and ``trim`` collapse and strip the spaces.

Canonical decomposition works character by character, so the per-character table built
below from ``unicodedata`` gives the same answer as decomposing the whole string.  Doing
the case and whitespace work inside ``translate`` keeps the regular expressions to plain
ASCII classes (a class listing the 29 Unicode whitespace characters is several times
slower in Java's regex engine).
"""

from __future__ import annotations

import functools
import re
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

ITEM_KEY_PREFIX = "item-"

_ASCII_ALNUM = re.compile(r"[^a-zA-Z0-9]")


@functools.lru_cache(maxsize=1)
def _whitespace_chars() -> str:
    """Every code point that Python's ``\\s`` (``str.isspace``) matches, by rule."""
    return "".join(chr(cp) for cp in range(sys.maxunicode + 1) if chr(cp).isspace())


@functools.lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """(source, target) strings for ``translate``: every non-ASCII, non-space character whose
    canonical decomposition keeps exactly one ASCII letter or digit maps to that character.
    Characters keeping nothing are removed later by the character-class filter."""
    src, dst = [], []
    for cp in range(0x80, sys.maxunicode + 1):
        ch = chr(cp)
        if ch.isspace() or 0xD800 <= cp <= 0xDFFF:
            continue
        decomposed = unicodedata.normalize("NFD", ch)
        if decomposed == ch:
            continue
        kept = _ASCII_ALNUM.sub("", decomposed)
        if len(kept) == 1:
            src.append(ch)
            dst.append(kept)
        elif len(kept) > 1:  # no such code point in current Unicode data
            raise ValueError(f"U+{cp:04X} decomposes to several letters: {kept!r}")
    return "".join(src), "".join(dst)


@functools.lru_cache(maxsize=1)
def _fold_table() -> tuple[str, str]:
    """The full ``translate`` table: accents, upper case and whitespace."""
    src, dst = accent_table()
    ws = _whitespace_chars().replace(" ", "")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return src + upper + ws, dst.lower() + upper.lower() + " " * len(ws)


def strip_accents(col: Column | str) -> Column:
    """Accent and symbol removal (see module doc). ``"Phở Bò"`` -> ``"pho bo"``,
    ``"Đậu phộng"`` -> ``"au phong"`` (letters without a canonical decomposition go)."""
    c = F.col(col) if isinstance(col, str) else col
    src, dst = _fold_table()
    folded = F.translate(c, src, dst)
    kept = F.regexp_replace(folded, F.lit("[^a-z0-9 ]+"), F.lit(""))
    return F.trim(F.regexp_replace(kept, F.lit("  +"), F.lit(" ")))


def clean_text(col: Column | str, default: str = "unknown") -> Column:
    """NULL, empty or all-space text -> ``default``; otherwise ``lower(trim(x))``.
    ``trim`` removes the space character only (a leading tab is kept)."""
    c = F.col(col) if isinstance(col, str) else col
    trimmed = F.trim(c)
    return F.when(c.isNull() | (trimmed == F.lit("")), F.lit(default)).otherwise(F.lower(trimmed))


def display_name(col: Column | str) -> Column:
    """Item key -> display name: ``_`` becomes a space, then each word is capitalised."""
    c = F.col(col) if isinstance(col, str) else col
    return F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))


def item_key(col: Column | str) -> Column:
    """Item name -> partition key: the name itself behind a fixed prefix, so that different
    names never share a key and a key is never empty or read back as a number or date.  Spark
    escapes characters that a path cannot hold."""
    c = F.col(col) if isinstance(col, str) else col
    return F.concat(F.lit(ITEM_KEY_PREFIX), c)


def quoted(name: str) -> str:
    """A column name as an identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"
