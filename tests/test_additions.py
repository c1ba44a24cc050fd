"""Stable keys, rejects, sketches, buckets, seasons and exact sums."""

from __future__ import annotations

import datetime
import math

import pytest
from pyspark.sql import functions as F

from winnow.operators.aggregates import exact_sum
from winnow.operators.dedup import keep_first
from winnow.operators.joins import duplicate_keys
from winnow.operators.registry import KeyRegistry
from winnow.operators.sketches import distinct_sketches, merged_distincts, relative_error
from winnow.plans import analyses, cleaning
from winnow.sources import rejects, schemas, tables


def names(spark, *values):
    return spark.createDataFrame([(v, len(v or "")) for v in values], "nom string, taille int")


@pytest.mark.parametrize("local_rows", [100_000, 1])
def test_keys_stay_when_references_change(spark, tmp_path, local_rows):
    registry = KeyRegistry(spark, str(tmp_path / "keys"), "nom", "cle")
    assert not registry.exists()
    first = registry.load(names(spark, "m", "c", "x", None, "c"), local_rows)
    assert {r["nom"]: r["cle"] for r in first.collect()} == {"c": 1, "m": 2, "x": 3}
    registry.load(names(spark, "a", "x", "z"), local_rows)
    after = {r["nom"]: r["cle"] for r in registry.load(names(spark, "a", "x", "z"), local_rows).collect()}
    assert after == {"c": 1, "m": 2, "x": 3, "a": 4, "z": 5}
    registry.load(names(spark), local_rows)
    today = registry.dimension(names(spark, "z", "zzz"), ["taille"])
    assert {r["nom"]: r["taille"] for r in today.collect()} == {"c": None, "m": None, "x": None, "a": None, "z": 1}


def test_keys_of_an_empty_first_load(spark, tmp_path):
    registry = KeyRegistry(spark, str(tmp_path / "keys"), "nom", "cle")
    assert registry.load(names(spark)).count() == 0
    assert [tuple(r) for r in registry.load(names(spark, "b")).collect()] == [(1, "b")]


def test_csv_with_every_kind_of_fault(spark, tmp_path):
    path = tmp_path / "pesees.csv"
    good = 'P0,2023-01-05," so, ubre ",C-0,PLT1,3.5,Grade A,900,7.0'
    lines = [
        ",".join(f.name for f in schemas.WEIGHINGS),
        good,
        "P1,2023-01-05,a,b,c,1,Grade A,2,3,4,5",
        "P2,2023-01-05,a",
        "P3,05/01/2023,a,b,c,heavy,Grade A,2.5,n/a",
        "P4,,,,,,,,",
        'P5,2023-02-30,"a ""quoted"", cell",b,c,1,Grade A,2,3',
        "",
        "P6",
    ]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    rows, wrong = rejects.read_csv_with_rejects(
        spark, str(path), schemas.WEIGHINGS, "id_pesee", dates={"date": "yyyy-MM-dd"}
    )
    kept = {r["id_pesee"]: r for r in rows.collect()}
    assert sorted(kept) == ["P0", "P2", "P3", "P4", "P5", "P6"]
    assert kept["P0"]["region"] == " so, ubre " and kept["P0"]["prix_fcfa_kg"] == 900
    assert (kept["P2"]["region"], kept["P2"]["cooperative"]) == ("a", None)
    assert [kept["P3"][c] for c in ("date", "tonnage_kg", "prix_fcfa_kg", "humidite_pct")] == [None] * 4
    assert kept["P5"]["region"] == 'a "quoted", cell' and kept["P5"]["date"] is None
    assert [r["id_pesee"] for r in rows.orderBy(tables.ORDER).collect()] == sorted(kept)
    found = sorted(
        (r["id_pesee"], r["colonne"] or "", r["raison"], r["texte"]) for r in wrong.collect()
    )
    assert found == [
        ("P1", "", rejects.SURPLUS, lines[2]),
        ("P2", "", rejects.SHORT, lines[3]),
        ("P3", "date", rejects.BAD_DATE, "05/01/2023"),
        ("P3", "prix_fcfa_kg", rejects.BAD_VALUE, "2.5"),
        ("P3", "tonnage_kg", rejects.BAD_VALUE, "heavy"),
        ("P5", "date", rejects.BAD_DATE, "2023-02-30"),
        ("P6", "", rejects.SHORT, "P6"),
    ]


def test_sketches_of_parts_merge_to_the_whole(spark):
    df = spark.range(30_000).select(
        (F.col("id") % 5).alias("part"),
        (F.col("id") % 7000).alias("n"),
        F.when(F.col("id") % 2 == 0, (F.col("id") % 300) / 7).alias("x"),
        F.lit(None).cast("string").alias("none"),
    )
    sketches = distinct_sketches(df, ["part"], ["n", "x", "none"])
    assert sketches.count() == 15
    whole = {r["colonne"]: r["distincts"] for r in merged_distincts(sketches).collect()}
    assert abs(whole["n"] / 7000 - 1) <= relative_error() and abs(whole["x"] / 150 - 1) <= relative_error()
    assert whole["none"] == 0
    some = merged_distincts(sketches.filter("part < 2"), ["part"]).filter("colonne = 'n'").collect()
    assert len(some) == 2 and all(abs(r["distincts"] / 1400 - 1) <= relative_error() for r in some)


def test_bucketed_stage_needs_no_exchange(spark, plan, tmp_path):
    df = spark.range(4000).select((F.col("id") % 700).cast("string").alias("k"), (-F.col("id")).alias("o"))
    rows = tables.write_bucketed(df, "bucketed_test", str(tmp_path / "bucketed"), "k", ["o"], 4)
    first = keep_first(rows, ["k"], ["o"])
    assert "Exchange" not in plan(first)
    want = keep_first(df, ["k"], ["o"])
    assert first.exceptAll(want).isEmpty() and first.count() == 700
    assert "Exchange" not in plan(duplicate_keys(rows, "k")) and duplicate_keys(rows, "k").count() == 700
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        other = tables.write_bucketed(df.filter("o > -100"), "bucketed_other", str(tmp_path / "other"), "k", [], 4)
        joined = rows.join(other, "k")
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_seasons_are_compared_over_gaps(spark):
    day = datetime.date
    rows = [(day(2020, 11, 3), 10.0), (day(2020, 11, 9), 20.0), (day(2022, 11, 1), 45.0), (day(2021, 3, 1), 4.0)]
    rows += [(day(2022, 3, 1), 5.0), (None, 99.0)]
    df = cleaning.season_columns(spark.createDataFrame(rows, "date date, tonnage_kg double"))
    got = analyses.season_comparison(df.withColumn("mois", F.month("date"))).collect()
    table = {(r["saison"], r["mois"]): tuple(r[2:]) for r in got}
    assert len(got) == 36 and {s for s, _ in table} == {"2020-2021", "2021-2022", "2022-2023"}
    assert table["2020-2021", 11] == (2, 30.0, None, None, None)
    assert table["2021-2022", 11] == (0, 0.0, 2, 30.0, -100.0)
    assert table["2022-2023", 11] == (1, 45.0, 0, 0.0, None)
    assert table["2021-2022", 3] == (1, 5.0, 1, 4.0, 25.0)
    empty = df.limit(0).withColumn("mois", F.month("date"))
    assert analyses.season_comparison(empty).collect() == []


@pytest.mark.parametrize(
    "values, want",
    [
        ([1e-7] * 10, 1e-6), ([0.1] * 10, 1.0), ([1e23, 1.0], 1e23), ([1e-300] * 3, 3e-300),
        ([1.5, None, 2.5], 4.0), ([None], None), ([9e15] * 4, 3.6e16),
    ],
)
def test_exact_sums(spark, values, want):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert df.agg(exact_sum(df, "x")).first()[0] == (want if want is None else pytest.approx(want, rel=1e-15))


def test_exact_sum_keeps_nan_and_does_not_depend_on_the_order(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),)], "x double")
    assert math.isnan(df.agg(exact_sum(df, "x")).first()[0])
    rows = spark.range(5000).select((F.col("id") * 0.1).alias("x"))
    sums = {rows.repartition(n).agg(exact_sum(rows, "x")).first()[0] for n in (1, 3, 7)}
    assert len(sums) == 1
