"""One scan for all rules and measurements, counts taken while writing, and the life of a run."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from test_pipeline import RELAXED, small_tables

from winnow.catalog import fixture
from winnow.operators.measured import Wanted, measure_table
from winnow.operators.rules import measure, validate
from winnow.plans import audit, pipeline
from winnow.plans import weighings as w
from winnow.sources.stages import Run, Stage

SF = "/root/testdata/sf0.001"


@pytest.fixture
def counted(spark):
    """A table whose rows are counted every time they are read, and the counter."""

    def wrap(df):
        seen = spark.sparkContext.accumulator(0)

        def count(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return df.mapInArrow(count, df.schema), seen

    return wrap


@pytest.fixture(scope="module")
def references(spark):
    return [Stage()(f(spark, SF)) for f in (fixture.growers, fixture.cooperatives)]


@pytest.fixture(scope="module")
def fact(spark):
    return Stage()(fixture.fact(spark, SF))


def test_rules_scan_the_table_once(counted, fact, references):
    df, seen = counted(fact)
    rows = fact.count()
    assert len(validate(df, w.RULES, *references).collect()) == 9
    assert seen.value == rows


def test_audit_scans_the_table_once(counted, fact, references):
    df, seen = counted(fact)
    rows = fact.count()
    assert audit.measurements(df, *references).first()["lignes"] == rows
    assert seen.value == rows


def test_control_of_the_clean_fact_scans_it_once(spark, counted, references):
    cleaned = pipeline.clean(
        fixture.weighings(spark, SF), *references, fixture.ORDER, pipeline.stage_in()
    )
    df, seen = counted(pipeline.stage_in()(cleaned.fact))
    report = pipeline.quality_report(
        pipeline.replace(cleaned, fact=df), *references, generated=False
    ).first()
    assert report["volumes"]["lignes_conservees"] == cleaned.kept == seen.value
    assert report["volumes"]["lignes_extraites"] == fixture.weighings(spark, SF).count()


@pytest.mark.parametrize("drop", [(), ("region",), ("id_pesee", "cooperative")])
def test_large_references_give_the_same_rules_and_measurements(fact, references, drop):
    df = fact.drop(*drop)
    small = validate(df, w.RULES, *references).collect()
    large = validate(df, w.RULES, *references, local_rows=1).collect()
    assert sorted(small) == sorted(large) and len(small) >= 9
    if not drop:
        wanted = Wanted(
            w.KEY, w.FACT_COLUMNS, ["region"], {"region": (references[1], "region")}, {}, "date"
        )
        assert measure_table(df, wanted).collect() == measure_table(df, wanted, local_rows=1).collect()


def test_marks_and_amounts_beside_the_rules(spark):
    fact, growers, cooperatives = small_tables(spark)
    found = measure(
        fact, RELAXED, growers, cooperatives, {"heavy": "tonnage_kg > 500", "dear": "prix_fcfa_kg > 950"}, "tonnage_kg"
    ).totals.first()
    assert (found["rows"], found["heavy"], found["dear"]) == (5, 3, 1)
    assert (found["amount_heavy"], found["amount_dear"]) == (2400.0, 100.0)
    none = measure(fact.limit(0), RELAXED, growers, cooperatives, {"heavy": "tonnage_kg > 500"}, "tonnage_kg")
    assert tuple(none.totals.select("rows", "heavy", "amount_heavy").first()) == (0, 0, 0.0)


def test_measurements_of_missing_repeated_and_no_rows(spark):
    rows = [(None, " A ", 1.0), (None, "a", float("nan")), ("k", None, None), ("k", None, None), ("m", "-a", 2.0)]
    df = spark.createDataFrame(rows, "key string, label string, x double")
    known = spark.createDataFrame([("A",), ("A",), (None,)], "label string")
    wanted = Wanted("key", ["key", "label", "x"], ["label"], {"label": (known, "label")}, {"two": "x >= 2"})
    found = measure_table(df, wanted).first().asDict()
    assert found == {
        "lignes": 5, "cles": 3, "doublons_cle": 2, "doublons_complets": 1, "two": 2 - 1,
        "brutes_label": 3, "normalisees_label": 2, "orphelins_label": 2,
        "manquants": {"key": 2, "label": 2, "x": 3},
    }
    empty = measure_table(df.limit(0), wanted).first().asDict()
    assert empty.pop("manquants") == {} and set(empty.values()) == {0}


def test_stage_counts_while_it_writes(spark, tmp_path):
    context = spark.sparkContext
    stage = Stage(str(tmp_path / "own"))
    df = spark.range(1000, numPartitions=3).withColumn("x", F.col("id") % 7)
    context.setJobGroup("stage", "write and count")
    written = stage(df)
    context.setLocalProperty("spark.jobGroup.id", None)
    # One job writes; none counts.
    assert stage.rows == 1000 and len(context.statusTracker().getJobIdsForGroup("stage")) == 1
    assert written.count() == 1000 and stage(df.limit(0)).isEmpty() and stage.rows == 0


def test_run_leaves_results_only(spark, tmp_path):
    fact, growers, cooperatives = small_tables(spark)
    shared = tmp_path / "shared"
    out = tmp_path / "out"
    with Run(spark, str(shared)) as run:
        kept = run.stage()(fact)
        assert os.listdir(shared) != []
        kept.write.parquet(run.result(f"{out}/fact"))
        assert not os.path.exists(out / "fact")
    assert os.listdir(shared) == [] and [n for n in os.listdir(out) if not n.startswith(".")] == ["fact"]
    assert spark.read.parquet(f"{out}/fact").count() == 5
    with pytest.raises(ZeroDivisionError), Run(spark, str(shared)) as run:
        run.stage()(fact)
        fact.limit(1).write.parquet(run.result(f"{out}/fact"))
        fact.write.parquet(run.result(f"{out}/more"))
        raise ZeroDivisionError
    assert os.listdir(shared) == [] and [n for n in os.listdir(out) if not n.startswith(".")] == ["fact"]
    assert spark.read.parquet(f"{out}/fact").count() == 5


def test_failed_pipeline_publishes_nothing(spark, tmp_path):
    fact, growers, cooperatives = small_tables(spark)
    broken = fact.withColumn("date", F.when(F.col("o") == 3, "05/05/2023").otherwise(F.col("date")))
    with pytest.raises(Exception, match="CANNOT_PARSE|could not be parsed"):
        pipeline.run(broken, growers, cooperatives, ["o"], str(tmp_path / "out"), RELAXED)
    assert not os.path.exists(tmp_path / "out" / "pesees_propres.parquet")
    pipeline.run(fact, growers, cooperatives, ["o"], str(tmp_path / "out"), RELAXED)
    names = sorted(n for n in os.listdir(tmp_path / "out") if not n.startswith("."))
    assert names == ["pesees_propres.parquet", "rapport_qualite.json"]
