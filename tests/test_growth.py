"""What moves, and what one task holds, on tables that are too large to be broadcast."""

from __future__ import annotations

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from winnow.catalog import fixture
from winnow.operators import canonical, measured, quantiles
from winnow.operators.measured import Wanted, measure_table
from winnow.operators.quantiles import medians_by_key, ranked_quantiles, value_counts
from winnow.plans import cleaning, pipeline
from winnow.plans import weighings as w

DAY = datetime.datetime(1996, 9, 13)


@pytest.fixture
def tables(spark, tmp_path):
    """Test tables with a repeated customer, missing keys and an order without a customer."""
    rows = {
        "region": [(0, "AFRICA")],
        "nation": [(0, "NATION_0", 0), (1, "NATION_1", 0)],
        "customer": [(1, 0), (2, 1), (2, 1), (None, 0), (3, None)],
        "supplier": [(1, "Supplier#1", 0), (2, "Supplier#2", 1)],
        "orders": [(10, 1), (67, 2), (11, 9), (None, 1), (12, None), (13, 3)],
        "lineitem": [
            (o, p, s, n, 3.0, 150.0, 0.02, "A", "F", DAY)
            for n, (o, p, s) in enumerate([(10, 5, 1), (67, 6, 2), (11, 5, 1), (None, 5, 1), (12, 7, 1), (13, 8, 2), (10, 5, 9)])
        ],
    }
    for name, values in rows.items():
        spark.createDataFrame(values, fixture.SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_line_items_move_to_their_orders_only(spark, tables):
    found = fixture.weighings(spark, tables)
    assert sorted((r["id_pesee"], r["id_planteur"], r["cooperative"]) for r in found.collect()) == [
        ("10-0", "PLT1", "Supplier#1"), *[("67-1", "PLT2", "Supplier#2")] * 4
    ]
    lines = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = [len(x) - len(x.lstrip(" +-:")) for x in lines]
    at = next(i for i, x in enumerate(lines) if "Join Inner" in x and "c_custkey" in x)
    below = [x for x, d in zip(lines[at + 1 :], depth[at + 1 :]) if d > depth[at]]
    assert below and not any("l_quantity" in x for x in below)


def test_columns_of_the_date_do_not_move_with_the_rows(spark, tables):
    class Seen:
        rows = None

        def __call__(self, df):
            self.columns = df.columns
            return df

    seen = Seen()
    cleaned = pipeline.clean(
        fixture.weighings(spark, tables),
        fixture.growers(spark, tables).distinct(),
        fixture.cooperatives(spark, tables),
        fixture.ORDER,
        seen,
    ).fact
    assert set(seen.columns) == set(w.FACT_COLUMNS)
    row = cleaned.filter("id_pesee = '10-0'").first()
    assert (row["annee"], row["mois"], row["jour_semaine"]) == (1996, 9, "Friday")
    assert cleaned.columns == list(pipeline.CLEAN_COLUMNS)


@pytest.mark.parametrize("part_rows", [1_000_000, 500])
def test_groups_cut_by_parts_are_ranked_in_parts_of_bounded_size(spark, plan, monkeypatch, part_rows):
    monkeypatch.setattr(quantiles, "PART_ROWS", part_rows)
    value = F.when(F.col("id") % 5 == 0, 7.0).otherwise((F.col("id") * 37 % 4001).cast("double"))
    key = F.when(F.col("id") < 4000, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 300))
    df = spark.range(6000).select(key.alias("k"), value.alias("x"))
    wanted = {"m": 0.5, "q": 0.9, "top": 1.0, "least": 0.0}
    found = ranked_quantiles(quantiles.durable(value_counts(df, ["k"], "x")), ["k"], wanted)
    frame = df.toPandas().groupby("k").x
    for row in found.collect():
        values = frame.get_group(row["k"])
        for name, p in wanted.items():
            assert row[name] == pytest.approx(np.quantile(values, p), abs=1e-9)
    assert found.count() == 301
    assert "REPARTITION_BY_NUM" in plan(found) and "collect_set" not in plan(found)


def test_medians_by_key_of_missing_values(spark):
    rows = [("a", 1.0, None), ("a", 4.0, None), (None, 9.0, 9), ("b", float("nan"), 5), ("b", 2.0, 8)]
    df = spark.createDataFrame(rows, "k string, x double, y int")
    found = {r["k"]: (r["mx"], r["my"]) for r in medians_by_key(df, "k", {"mx": "x", "my": "y"}).collect()}
    assert found == {"a": (2.5, None), "b": (2.0, 6.5)}


def test_rows_of_a_ticket_are_told_apart_by_digests(spark):
    rows = [("t", "a", None, 0.0), ("t", None, "a", 0.0), ("t", "a", None, -0.0), ("t", "", "1:a", 0.0), ("t", "1:a", "", 0.0)]
    df = spark.createDataFrame(rows, "key string, a string, b string, x double")
    wanted = Wanted("key", df.columns)
    assert measured._stacked(df, wanted).schema["whole"].dataType == BinaryType()
    found = measure_table(df, wanted).first()
    assert (found["lignes"], found["cles"], found["doublons_cle"], found["doublons_complets"]) == (5, 1, 4, 1)
    nested = df.select("key", F.struct("a", "b").alias("pair"))
    found = measure_table(nested, Wanted("key", nested.columns)).first()
    assert (found["lignes"], found["doublons_complets"]) == (5, 1)


def test_tickets_are_added_up_before_a_large_reference_is_joined(spark):
    df = spark.range(2000).select(F.concat(F.lit("t"), "id").alias("key"), (F.col("id") % 7).cast("string").alias("g"))
    known = spark.range(5).select(F.col("id").cast("string").alias("g"))
    wanted = Wanted("key", df.columns, references={"g": (known, "g")})
    seen = []

    def folded(merged, own=measured._folded):
        seen.append(own(merged))
        return seen[-1]

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(measured, "_folded", folded)
        found = measure_table(df, wanted, local_rows=1).first()
    assert (found["lignes"], found["cles"], found["doublons_cle"], found["orphelins_g"]) == (2000, 2000, 0, 570)
    assert seen[0].count() == 1 + 1 + 7


def test_many_labels_are_resolved_by_one_scan(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(50).select(F.concat(F.lit(" L"), "id").alias("c")).mapInArrow(count, "c string")
    officials = canonical.official_labels(spark.range(40).select(F.concat(F.lit("L"), "id").alias("c")), {"c": "c"})
    resolved = canonical.resolved_once(df, ["c"], officials, local_rows=10)
    assert resolved.filter("official IS NOT NULL").count() == 40
    assert seen.value == 50


def test_date_columns_are_part_of_correct_types(spark):
    df = spark.createDataFrame([("2023-01-05",), (None,)], "date string")
    whole = cleaning.correct_types(df)
    assert whole.collect() == cleaning.date_columns(cleaning.correct_dates(df)).collect()
