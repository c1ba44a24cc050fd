from __future__ import annotations

import datetime as dt
import random
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from winnow.functions.calendar import parse_date, season_kind, season_label, weekday_name
from winnow.functions.conditional import (
    at_most,
    clip,
    constant_lookup,
    first_match,
    right_closed_bins,
    scaled_price,
)
from winnow.functions.labels import canonical_key, strip_blanks, title_case
from winnow.functions.nulls import differs, nan_to_null, share_pct
from winnow.functions.rounding import round_half_even, rounded_long


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_rounding_agrees_with_numpy(spark):
    values = [0.5, 1.5, 2.5, 0.25, 2.675, 1.255, -0.5, -1.25] + [i * 0.005 for i in range(400)]
    for digits in (0, 1, 2):
        got = column(spark, values, "double", lambda v: round_half_even(v, digits))
        assert got == list(np.round(np.array(values), digits))
    assert column(spark, [1.5, 2.5, None], "double", rounded_long) == [2, 2, None]


def test_bins_are_closed_on_the_right(spark):
    edges, labels = (0.0, 100.0, 500.0, 1000.0, float("inf")), ("s", "m", "l", "xl")
    values = [0.0, -1.0, 0.1, 100.0, 100.1, 500.0, 1000.0, 1000.1, None]
    want = [None, None, "s", "s", "m", "m", "l", "xl", None]
    assert column(spark, values, "double", lambda v: right_closed_bins(v, edges, labels)) == want
    text = column(spark, values, "double", lambda v: right_closed_bins(v, edges, labels, "nan"))
    assert text == [w or "nan" for w in want]
    with pytest.raises(ValueError):
        right_closed_bins(F.col("v"), edges, labels[:2])


def test_missing_values_never_pass_a_flag(spark):
    assert column(spark, [7.9, 8.0, 8.1, None], "double", lambda v: at_most(v, 8.0)) == [
        True, True, False, False,
    ]
    df = spark.createDataFrame(
        [("a", "a"), ("a", "b"), ("a", None), (None, None)], "l string, r string"
    )
    assert [r[0] for r in df.select(differs(df.l, df.r)).collect()] == [False, True, True, True]
    assert spark.range(1).select(share_pct(F.lit(0), F.lit(0))).first()[0] is None


def test_nan_becomes_null(spark):
    df = nan_to_null(spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, k int"))
    assert [tuple(r) for r in df.orderBy("k").collect()] == [(None, 1), (2.0, 2)]


def test_conditional_columns(spark):
    assert column(spark, [1.0, 5.0, 9.0, None], "double", lambda v: clip(v, 2.0, 8.0)) == [
        2.0, 5.0, 8.0, None,
    ]
    tier = lambda v: first_match([(v >= 5, F.lit(1.03)), (v >= 1, F.lit(0.97))], 1.0)
    assert column(spark, [9.0, 2.0, 0.0, None], "double", tier) == [1.03, 0.97, 1.0, 1.0]
    assert column(spark, [100.0], "double", lambda v: scaled_price(v, F.lit(1.1), F.lit(0.96))) == [106]
    assert column(spark, [1, 3], "int", lambda v: constant_lookup(v, {1: 0.1, 2: 0.2})) == [0.1, None]


def test_dates_and_seasons(spark):
    assert column(spark, ["2023-01-05", None], "string", parse_date) == [dt.date(2023, 1, 5), None]
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|CAST_INVALID_INPUT"):
        column(spark, ["13/01/2023"], "string", parse_date)
    tolerant = column(spark, ["13/01/2023"], "string", lambda v: parse_date(v, strict=False))
    assert tolerant == [None]
    days = [dt.date(2023, m, 1) for m in (9, 10, 12, 1)]
    assert column(spark, days, "date", season_label) == [
        "2022-2023", "2023-2024", "2023-2024", "2022-2023",
    ]
    kind = lambda v: season_kind(v, {10, 11, 12, 1, 2, 3}, "P", "I")
    assert column(spark, [*days, None], "date", kind) == ["I", "P", "P", "P", "I"]
    week = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(7)]
    assert column(spark, week, "date", weekday_name) == [d.strftime("%A") for d in week]


def python_key(text):
    if text is None:
        return ""
    plain = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return re.sub("[^a-z0-9]+", " ", plain.lower()).strip()


def test_canonical_key_examples(spark):
    labels = ["Côte Sud", "  COTE   SUD", "cote_sud", "Élève", "ﬁ²", "½ ㎏ Ⅷ", "İstanbul K", None, "", "--"]
    got = column(spark, labels, "string", canonical_key)
    assert got == [python_key(t) for t in labels]
    assert got[:3] == ["cote sud"] * 3 and got[3] == "eleve" and got[4] == "fi2"


def test_canonical_key_of_every_character_and_random_texts(spark):
    chars = [chr(i) for i in range(1, 0x110000) if not 0xD800 <= i <= 0xDFFF]
    random.seed(7)
    special = [c for c in chars if unicodedata.decomposition(c) or unicodedata.combining(c)]
    texts = [f"a{''.join(chars[i : i + 40])}Z" for i in range(0, len(chars), 40)]
    texts += [f"a{c}b" for c in special]
    texts += ["".join(random.choices(special + list("aB 1-_"), k=12)) for _ in range(3000)]
    got = column(spark, texts, "string", canonical_key)
    wrong = [(t, g, python_key(t)) for t, g in zip(texts, got) if g != python_key(t)]
    assert not wrong[:5]


def test_title_and_strip_follow_python(spark):
    labels = ["san-pedro", "SAN  PEDRO", " daloa\t", "o'neil 3rd", "NATION_12", "élan vital"]
    assert column(spark, labels, "string", title_case) == [t.title() for t in labels]
    assert column(spark, labels, "string", strip_blanks) == [t.strip() for t in labels]
