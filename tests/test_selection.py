from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from winnow.operators import selection
from winnow.operators.profile import distribution
from winnow.operators.quantiles import VALUE, group_quantiles, quantiles_of_summary
from winnow.operators.selection import bracketed_counts, certified_counts, summary, uncertified

WANTED = {"low": 0.0, "q1": 0.25, "m": 0.5, "q3": 0.75, "high": 1.0}


def apart(spark, rows: int, parts: int = 6):
    """As many values as rows, in no order."""
    mixed = F.pmod(F.xxhash64("id"), F.lit(10**12)) + F.col("id") / F.lit(10**7)
    return spark.range(rows, numPartitions=parts).select(mixed.cast("double").alias("x"), (F.col("id") % 3).alias("k"))


def test_selection_moves_few_rows_and_is_exact(spark):
    df = apart(spark, 200_000)
    present = df.select(F.col("x").alias(VALUE))
    brackets = summary(present, [], {"q1": 0.25, "m": 0.5, "q3": 0.75})
    moved = bracketed_counts(present, [], brackets, 3)
    assert moved.count() < 0.05 * 200_000
    x = np.array([r.x for r in df.select("x").collect()])
    got = group_quantiles(df, [], "x", WANTED, local_rows=10_000).first().asDict()
    assert got == pytest.approx({n: np.quantile(x, p) for n, p in WANTED.items()}, rel=1e-12)


@pytest.mark.parametrize("local_rows", [100_000, 3000, 50])
def test_groups_hot_values_small_groups_and_missing_values(spark, local_rows):
    rng = np.random.default_rng(3)
    rows = [("hot", 7.0)] * 3000 + [("hot", float(x)) for x in rng.normal(7, 3, 3000)]
    rows += [("flat", 1.0)] * 1500 + [("one", 5.0), ("two", 1.0), ("two", 2.0)]
    rows += [("many", float(x)) for x in rng.integers(-50, 50, 4000)] + [(None, 1.0), ("hot", None), ("none", None)]
    rows += [("nan", float("nan")), ("wide", float("inf")), ("wide", float("-inf")), ("wide", 0.0)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(5)
    got = {r["k"]: r.asDict() for r in group_quantiles(df, ["k"], "x", WANTED, local_rows).collect()}
    assert set(got) == {"hot", "flat", "one", "two", "many", "wide"}
    for k, row in got.items():
        x = [v for g, v in rows if g == k and v is not None]
        for name, p in WANTED.items():
            if k == "wide":
                assert row["m"] == 0.0
            else:
                assert row[name] == pytest.approx(np.quantile(x, p), rel=1e-12)


def test_a_bracket_that_misses_is_widened(spark, monkeypatch):
    df = apart(spark, 20_000)
    present = df.select("k", F.col("x").alias(VALUE))
    want = {"m": 0.5}
    right = summary(present, ["k"], want)
    wrong = right.withColumn("__low_0", F.when(F.col("k") == 1, F.col("__high_0")).otherwise(F.col("__low_0")))
    found = bracketed_counts(present, ["k"], wrong, 1)
    assert [r.k for r in uncertified(found, ["k"], wrong, want).collect()] == [1]
    assert uncertified(bracketed_counts(present, ["k"], right, 1), ["k"], right, want).isEmpty()
    counts = certified_counts(present, ["k"], wrong, want)
    sizes = {r.k: r.n for r in counts.groupBy("k").agg(F.sum("n").alias("n")).collect()}
    assert sizes == {0: 6667, 1: 6667, 2: 6666}
    # A sketch far too coarse ends with all values of the group.
    monkeypatch.setattr(selection, "_margin", lambda accuracy: 1e-6)
    coarse = summary(present, ["k"], want, accuracy=2, margin=1e-6)
    got = quantiles_of_summary(present, ["k"], want, coarse, local_rows=100)
    x = {k: np.quantile([r.x for r in df.filter(F.col("k") == k).collect()], 0.5) for k in range(3)}
    assert {r.k: r.m for r in got.collect()} == pytest.approx(x, rel=1e-12)


def test_empty_table_has_no_quantile(spark):
    df = apart(spark, 10).limit(0)
    assert group_quantiles(df, ["k"], "x", WANTED).collect() == []
    assert all(v is None for r in group_quantiles(df, [], "x", WANTED, 1).collect() for v in r)
    assert distribution(df, ["x"]).collect() == []
