"""Comparison keys for hand-typed labels."""

from __future__ import annotations

import functools
import json
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


@functools.lru_cache(maxsize=1)
def _folding_tables() -> tuple[str, str, dict[str, str]]:
    """Foldings of single characters, derived from the Unicode character database.

    Returns the arguments of ``translate`` (letters that fold to one ASCII
    character, then the marks it has to delete) and the characters that fold to
    several. Characters absent from all three end up as separators.
    """
    source: list[str] = []
    target: list[str] = []
    marks: list[str] = []
    several: dict[str, str] = {}
    for char in map(chr, range(0x80, sys.maxunicode + 1)):
        if unicodedata.combining(char):
            marks.append(char)
        elif unicodedata.decomposition(char):
            base = [c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)]
            folded = "".join(c.lower() if c.isascii() and c.isalnum() else " " for c in base)
            if not folded:
                marks.append(char)
            elif folded.isspace():
                continue
            elif len(folded) == 1:
                source.append(char)
                target.append(folded)
            else:
                several[char] = folded
    return "".join(source + marks), "".join(target), several


def _is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def _fold(text: Column) -> Column:
    """Text without accents or compatibility forms; plain ASCII is passed through."""
    source, target, several = _folding_tables()
    narrow = F.translate(text, source, target)
    table = F.from_json(F.lit(json.dumps(several)), "map<string,string>")
    spread = F.array_join(
        F.transform(F.split(narrow, ""), lambda c: F.coalesce(F.try_element_at(table, c), c)), ""
    )
    return F.when(_is_ascii(text), text).when(_is_ascii(narrow), narrow).otherwise(spread)


def canonical_key(text: Column | str) -> Column:
    """Key under which typing variants of one label compare equal.

    Accents, case, punctuation and repeated or outer blanks do not count:
    ``'Côte Sud'``, ``'  COTE   SUD'`` and ``'cote_sud'`` all give
    ``'cote sud'``. A missing label gives ``''``.
    """
    column = F.col(text) if isinstance(text, str) else text
    words = F.regexp_replace(F.lower(_fold(column)), "[^a-z0-9]+", " ")
    return F.coalesce(F.trim(words), F.lit(""))


def strip_blanks(text: Column | str) -> Column:
    """Remove leading and trailing whitespace of any kind (``trim`` knows only the space)."""
    column = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(column, r"(?U)^\s+|\s+$", "")


def title_case(text: Column | str) -> Column:
    """Capitalise the first letter of every run of letters, after any other character."""
    column = F.col(text) if isinstance(text, str) else text
    runs = F.regexp_extract_all(column, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda run: F.initcap(run)), "")
