from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from winnow.operators.aggregates import (
    distinct_pairs,
    grouped_summary,
    keys_with_several,
    union_rows,
    weighted_mean,
    with_share,
)
from winnow.operators.bounded import (
    CELL_CHARS,
    LOCAL_ROWS,
    local_if_small,
    rows_if_small,
    small_or_same,
)
from winnow.operators.canonical import (
    canonicalisation_stats,
    canonicalise,
    label_variants,
    official_collisions,
    official_labels,
    unknown_values,
    variant_sample,
)
from winnow.operators.dedup import dedup_summary, duplicate_counts, keep_first
from winnow.operators.joins import (
    attach_reference,
    duplicate_keys,
    hierarchy_counts,
    keep_known,
    orphan_count,
)
from winnow.operators.profile import count_where, distribution, missing_rates, profile_columns
from winnow.operators.quantiles import (
    approx_quantiles,
    attach_statistic,
    group_quantiles,
    ranked_quantiles,
    value_counts,
)
from winnow.operators.spine import date_spine, weighted_spine
from winnow.operators.star import dimension, star_fact


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# --- size checks -----------------------------------------------------------------


def test_local_if_small_keeps_rows_or_refuses(spark):
    df = spark.range(50)
    assert local_if_small(df, 49) is None
    assert local_if_small(df, 50).count() == 50
    assert local_if_small(df, max_bytes=8) is None
    assert small_or_same(df, 10) is df


# --- quantiles -------------------------------------------------------------------


@pytest.fixture(scope="module")
def measured(spark):
    random.seed(1)
    data = [
        (random.choice(["a", "a", "a", "b", "c", None]), random.choice([None, 5.0, random.gauss(0, 9)]))
        for _ in range(4000)
    ]
    data += [("single", 3.5), ("empty", None), ("pair", 1.0), ("pair", 2.0)]
    return spark.createDataFrame(data, "k string, x double"), pd.DataFrame(data, columns=["k", "x"])


QUANTILES = {"q1": 0.25, "mid": 0.5, "q3": 0.75, "low": 0.0, "high": 1.0}


@pytest.mark.parametrize("limit", [LOCAL_ROWS, 10])
def test_group_quantiles_equal_pandas_on_both_paths(spark, measured, limit):
    df, frame = measured
    got = {r["k"]: r for r in group_quantiles(df, ["k"], "x", QUANTILES, limit).collect()}
    want = frame.dropna().groupby("k")["x"]
    assert set(got) == {"a", "b", "c", "single", "pair"}
    for name, p in QUANTILES.items():
        for key, value in want.quantile(p).items():
            assert got[key][name] == pytest.approx(value, abs=1e-12)


@pytest.mark.parametrize("limit", [LOCAL_ROWS, 10])
def test_whole_table_quantiles(spark, measured, limit):
    df, frame = measured
    got = group_quantiles(df, [], "x", QUANTILES, limit).first()
    for name, p in QUANTILES.items():
        assert got[name] == pytest.approx(frame.x.quantile(p), abs=1e-12)


def test_ranked_quantiles_survive_a_hot_value_and_group(spark):
    df = spark.range(30_000).select(
        F.lit("hot").alias("k"), F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id")).alias("x")
    )
    got = ranked_quantiles(value_counts(df, ["k"], "x"), ["k"], {"m": 0.5}).first()
    ids = np.arange(30_000)
    assert got["m"] == np.median(np.where(ids % 3 == 0, 7.0, ids))


def test_statistic_of_a_missing_group_is_missing(spark, measured):
    df, _ = measured
    medians = group_quantiles(df, ["k"], "x")
    joined = attach_statistic(df, medians, ["k"])
    assert joined.count() == df.count()
    assert joined.filter("k IS NULL AND median IS NOT NULL").isEmpty()


def test_approx_quantiles_are_close(spark):
    df = spark.range(1001).select(F.lit(1).alias("k"), F.col("id").cast("double").alias("x"))
    assert abs(approx_quantiles(df, ["k"], "x").first()["median"] - 500) <= 1


# --- duplicates ------------------------------------------------------------------


def test_keep_first_follows_the_order_and_keeps_one_missing_key(spark):
    df = spark.createDataFrame(
        [("a", 2, "late"), ("a", 1, "early"), ("b", 1, "x"), ("b", 1, "x"), (None, 3, "n"), (None, 1, "m")],
        "k string, o int, v string",
    )
    first = keep_first(df, ["k"], ["o"])
    assert rows(first, "k") == [(None, 1, "m"), ("a", 1, "early"), ("b", 1, "x")]
    assert rows(keep_first(first, ["k"], ["o"]), "k") == rows(first, "k")
    assert rows(duplicate_counts(df, ["k"])) == [(6, 3, 3, 1)]
    assert rows(dedup_summary(df, ["k"])) == [(6, 3, 3)]
    assert rows(duplicate_counts(df.limit(0), ["k"])) == [(0, 0, 0, 0)]


def test_keep_first_limits_groups_before_the_exchange(spark, plan):
    hot = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    text = plan(keep_first(hot, ["k"], ["id"]))
    before = text.index("WindowGroupLimit", text.index("Exchange"))
    assert before > 0 and text.count("WindowGroupLimit") == 2
    assert keep_first(hot, ["k"], ["id"]).count() == hot.select("k").distinct().count()


# --- joins -----------------------------------------------------------------------


def test_attach_reference_keeps_rows_and_rejects_repeated_keys(spark):
    fact = spark.createDataFrame([("a", 1), ("z", 2), (None, 3)], "k string, v int")
    reference = spark.createDataFrame([("a", "one"), (None, "none")], "code string, name string")
    joined = attach_reference(fact, reference, "k", ["name"], "code")
    assert rows(joined, "v") == [("a", 1, "one"), ("z", 2, None), (None, 3, None)]
    repeated = reference.union(spark.createDataFrame([("a", "two")], "code string, name string"))
    assert rows(duplicate_keys(repeated, "code")) == [("a", 2)]
    with pytest.raises(ValueError, match="repeated reference key code=a"):
        attach_reference(fact, repeated, "k", ["name"], "code")
    # A large reference gives the same error, even if none of its columns is used.
    large = spark.range(LOCAL_ROWS + 10).selectExpr("CAST(id AS STRING) AS code", "'x' AS name")
    assert attach_reference(fact, large, "k", ["name"], "code").count() == 3
    twice = large.union(large.filter("code = '7'"))
    with pytest.raises(ValueError, match="repeated reference key code=7"):
        attach_reference(fact, twice, "k", ["name"], "code").select("v")


def test_long_texts_are_refused_before_they_are_collected(spark):
    short = spark.createDataFrame([("a" * CELL_CHARS, 1)], "t string, `a b` int")
    assert rows_if_small(short).num_rows == 1
    assert rows_if_small(spark.createDataFrame([("a" * (CELL_CHARS + 1), 1)], "t string, n int")) is None


def test_orphans_and_hierarchy_count_missing_values(spark):
    fact = spark.createDataFrame(
        [("p1", "r1"), ("p1", "r2"), ("p2", None), (None, None), ("p9", "r1"), ("two", "r1")],
        "p string, r string",
    )
    reference = spark.createDataFrame(
        [("p1", "r1"), ("p2", None), ("two", "r1"), ("two", "r2")], "p string, r string"
    )
    assert rows(orphan_count(fact, "p", reference, "p")) == [(2,)]
    assert rows(hierarchy_counts(fact, "p", "r", reference)) == [(2, 5)]
    assert keep_known(fact, {"p": (reference, "p"), "r": (reference, "r")}).count() == 3


def test_skewed_large_join_is_split(spark, plan):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        fact = spark.range(0, 200_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), F.uuid().alias("v")
        )
        big = spark.range(LOCAL_ROWS + 10).select(F.col("id").alias("k"), F.col("id").alias("a"))
        joined = attach_reference(fact, big, "k", ["a"])
        assert joined.count() == 200_000
        assert "skew=true" in plan(joined, run=True)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# --- labels ----------------------------------------------------------------------


@pytest.mark.parametrize("limit", [LOCAL_ROWS, 0])
def test_canonicalise_on_both_paths(spark, limit):
    reference = spark.createDataFrame([("San Pedro", 1), ("Soubré", 2)], "region string, o int")
    fact = spark.createDataFrame(
        [(1, "SAN  pedro"), (2, "San-Pedro "), (3, "soubre"), (4, "Nowhere"), (5, None), (6, "Soubré")],
        "i int, region string",
    )
    officials = official_labels(reference, {"region": "region"})
    got = rows(canonicalise(fact, ["region"], officials, limit), "i")
    assert [r[1] for r in got] == ["San Pedro", "San Pedro", "Soubré", "Nowhere", None, "Soubré"]
    assert rows(canonicalisation_stats(fact, ["region"], officials)) == [("region", 5, 3, 2)]


def test_lookup_collision_keeps_the_last_and_is_reported(spark):
    reference = spark.createDataFrame(
        [("San-Pedro", 1), ("San Pedro", 2), ("San-Pedro", 3)], "region string, o int"
    )
    columns = {"region": "region"}
    assert rows(official_labels(reference, columns, "o")) == [("region", "san pedro", "San Pedro")]
    assert rows(official_labels(reference, columns)) == [("region", "san pedro", "San-Pedro")]
    assert rows(official_collisions(reference, "region")) == [
        ("san pedro", 2, "San Pedro", "San-Pedro")
    ]


def test_variants_samples_and_unknown_values(spark):
    df = spark.createDataFrame(
        [("San Pedro",), ("SAN PEDRO",), (" Daloa",), (None,), ("Daloa",)], "region string"
    )
    assert rows(label_variants(df, ["region"])) == [("region", 4, 3, 1)]
    assert rows(variant_sample(df, "region")) == [(" Daloa",), ("SAN PEDRO",)]
    assert rows(unknown_values(df, "region", ["Daloa", "San Pedro"]), "valeur") == [
        (" Daloa",), ("SAN PEDRO",),
    ]


# --- measurements ----------------------------------------------------------------


@pytest.mark.parametrize("limit", [LOCAL_ROWS, 3])
def test_distribution_equals_describe(spark, limit):
    frame = pd.DataFrame({"x": [1.0, 2.0, 2.5, None, 9.0, 7.25], "y": [1, 2, 3, 4, 5, 6]})
    data = [(None if pd.isna(x) else float(x), int(y)) for x, y in frame.values]
    df = spark.createDataFrame(data, "x double, y long")
    want = frame.describe().T.round(1)
    for row in distribution(df, ["x", "y"], local_rows=limit).collect():
        assert list(row)[1:] == pytest.approx(list(want.loc[row["mesure"]]))


def test_missing_rates_profile_and_counts(spark):
    df = spark.createDataFrame(
        [(1, "b", None, None), (2, None, float("nan"), None), (3, "a", 1.5, None)],
        "o int, s string, x double, e string",
    )
    assert rows(missing_rates(df, ["s", "x", "e", "o"]), "colonne") == [
        ("e", 3, 100.0), ("s", 1, 33.33), ("x", 2, 66.67),
    ]
    assert rows(profile_columns(df, ["s", "x", "e"], ["o"]), "colonne") == [
        ("e", "string", "-", 0), ("s", "string", "b", 2), ("x", "double", "1.5", 1),
    ]
    assert missing_rates(df.limit(0)).isEmpty()
    assert rows(count_where(df, n=F.col("x") <= 2)) == [(1,)]


def test_grouped_summaries_and_shares(spark):
    df = spark.createDataFrame(
        [("a", "i", 1.0, 10.0), ("a", None, 2.0, 20.0), ("b", "j", 4.0, None), (None, "k", 9.0, 1.0)],
        "g string, id string, w double, p double",
    )
    summary = grouped_summary(df, ["g"], {"nb": "id"}, {"mean": "p"}, {"w": "w"})
    assert rows(summary, "g") == [("a", 1, 15.0, 3.0), ("b", 1, None, 4.0)]
    assert rows(with_share(summary, "w", "pct").select("g", "pct"), "g") == [("a", 42.9), ("b", 57.1)]
    amounts = df.withColumn("amount", F.col("w") * F.col("p"))
    assert rows(weighted_mean(amounts, ["g"], "amount", "w", "m").select("g", "m"), "g")[1] == ("a", 16.7)
    assert rows(distinct_pairs(df, "g", "id")) == [(2,)]
    assert rows(keys_with_several(df, "g", "w")) == [("a",)]
    assert union_rows(df, F.col("g") == "a").count() == 6


def test_date_spine_and_weights(spark):
    df = spark.createDataFrame([("2022-10-01",), ("2024-09-30",)], "d string")
    spine = date_spine(df, F.to_date("d"))
    assert spine.count() == 731
    weighted = weighted_spine(spine, {m: 1.0 for m in range(1, 13)}, 0.25)
    total = weighted.agg(F.sum("poids")).first()[0]
    sunday = weighted.filter(F.weekday("jour") == 6).select("poids").distinct().collect()
    assert total == pytest.approx(1.0) and len(sunday) == 1
    assert date_spine(df.limit(0), F.to_date("d")).isEmpty()


@pytest.mark.parametrize("local_rows", [LOCAL_ROWS, 100])
def test_star_keys_are_dense_and_facts_complete(spark, local_rows):
    reference = spark.range(1000).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("a"))
    dim = dimension(reference, "k", "sk", ["a"], local_rows)
    got = rows(dim.select("sk", "k"), "sk")
    assert got == list(enumerate(sorted(f"k{i}" for i in range(1000)), start=1))
    fact = spark.createDataFrame([("k5", 1), ("nope", 2)], "k string, m int")
    keys = dict(got)
    result = rows(star_fact(fact, {"k": (dim, "k", "sk")}, ["m"]), "m")
    assert keys[result[0][0]] == "k5" and result[1] == (None, 2)
