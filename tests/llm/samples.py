"""Small tables with the awkward cases that every operator has to take."""

from __future__ import annotations

import random
import zlib

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " ids string, score string, letters string, part int"
)

ROOTS = {
    "en": ["the", "and", "tion", "ing", "wh", "ou", "re", "th"],
    "de": ["ein", "sch", "ung", "und", "keit", "ver", "ich", "heit"],
    "fr": ["eau", "ment", "que", "les", "eux", "oi", "tre", "an"],
}


def prose(rng: random.Random, lang: str, words: int) -> str:
    roots = ROOTS[lang]
    return " ".join("".join(rng.choices(roots, k=rng.randint(1, 3))) for _ in range(words))


def texts(seed: int = 1, number: int = 40) -> list[tuple[int, str | None, str | None]]:
    rng = random.Random(seed)
    rows: list[tuple[int, str | None, str | None]] = []
    for i in range(number):
        lang = rng.choice(sorted(ROOTS))
        rows.append((i * 3, prose(rng, lang, rng.randint(5, 120)), lang))
    return rows


def awkward() -> list[tuple[int | None, str | None, str | None]]:
    rng = random.Random(5)
    long = prose(rng, "en", 6000)
    return [
        (1001, None, "en"),
        (1002, "", None),
        (1003, "   \n\t ", "de"),
        (1004, "!!! ... 123 \u0301", "fr"),
        (1005, long, "en"),
        (1006, long, "en"),
        (1007, "a", "en"),
        (1008, "  two  spaces and a\ttab\n\nlines ", "en"),
        (1009, "<|endoftext|> “quoted” é   　x é\U0001f600", None),
        (1010, "same words again " * 300, "en"),
        (1011, "same words again " * 300, "en"),
        (1011, "same words again " * 300, "en"),
        (None, "no key at all", "en"),
    ]


def frame(spark: SparkSession, rows) -> DataFrame:
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame(
        [(i, t, g, "s", 0 if t is None else len(t), "i", "s", "l", 1) for i, t, g in rows], SCHEMA
    )


def crc_mod(key, divisor: int) -> int:
    return zlib.crc32(("" if key is None else str(key)).encode()) % divisor
