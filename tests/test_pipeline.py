from __future__ import annotations

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from winnow.catalog import fixture
from winnow.functions.nulls import nan_to_null
from winnow.operators.anomalies import anomaly_statistics, anomaly_summary, flag_anomalies
from winnow.operators.impute import imputation_summary
from winnow.operators.rules import validate, verdict
from winnow.plans import analyses, audit, cleaning, pipeline
from winnow.plans import weighings as w
from winnow.sources import schemas, tables

SF = "/root/testdata/sf0.001"
RELAXED = w.RULES.__class__(**{**w.RULES.__dict__, "minimum_rows": 3})


def small_tables(spark):
    """A handful of weighings with every defect, in input order."""
    fact = spark.createDataFrame(
        [
            ("P1", "2022-10-05", "Soubre", "COOP-SOU-001", "PLT1", 100.0, "Grade A", 1000, 6.0, 0),
            ("P2", "2023-01-05", " soubre", "coop sou 001", "PLT1", 600.0, "Grade A", -1, None, 1),
            ("P2", "2023-01-05", " soubre", "coop sou 001", "PLT1", 600.0, "Grade A", -1, None, 2),
            ("P3", "2023-05-05", "San-Pedro", "COOP-SAN-001", "PLT2", 50.0, "Grade B", 800, 9.0, 3),
            ("P4", "2023-12-31", "San Pedro", "COOP-SAN-001", "PLT2", 1200.0, "Grade A", 901, 7.25, 4),
        ],
        "id_pesee string, date string, region string, cooperative string, id_planteur string,"
        " tonnage_kg double, qualite string, prix_fcfa_kg long, humidite_pct double, o int",
    )
    growers = spark.createDataFrame(
        [("PLT1", "COOP-SOU-001", "Soubre", 4.0, 2010, True),
         ("PLT2", "COOP-SAN-001", "San Pedro", 2.5, 2015, False)],
        schemas.GROWERS,
    )
    cooperatives = spark.createDataFrame(
        [("COOP-SOU-001", "Cooperative Soubre 1", "Soubre", "Sud-Ouest", "San Pedro", 2001, True),
         ("COOP-SAN-001", "Cooperative San Pedro 1", "San Pedro", "Sud-Ouest", "San Pedro", 2002, False)],
        schemas.COOPERATIVES,
    )
    return fact, growers, cooperatives


def test_clean_fact_by_hand(spark):
    fact, growers, cooperatives = small_tables(spark)
    cleaned = pipeline.clean(fact, growers, cooperatives, ["o"]).fact
    assert tuple(cleaned.columns) == pipeline.CLEAN_COLUMNS and len(cleaned.columns) == 25
    rows = {r["id_pesee"]: r.asDict() for r in cleaned.collect()}
    assert set(rows) == {"P1", "P2", "P3", "P4"}
    second = rows["P2"]
    assert (second["region"], second["cooperative"]) == ("Soubre", "COOP-SOU-001")
    # Median of 1000 and 901 is 950.5; half to even gives 950.
    assert second["prix_fcfa_kg"] == 950 and second["prix_impute"]
    # Median of 6.0 and 7.25 is 6.625, kept to one decimal.
    assert second["humidite_pct"] == 6.6 and second["humidite_imputee"] and second["conforme_export"]
    assert second["montant_fcfa"] == 570_000 and second["jour_semaine"] == "Thursday"
    assert (second["campagne"], second["saison"]) == ("Principale", "2022-2023")
    assert rows["P3"]["campagne"] == "Intermediaire" and not rows["P3"]["conforme_export"]
    assert rows["P4"]["saison"] == "2023-2024" and rows["P4"]["humidite_pct"] == 7.2
    assert [rows[k]["categorie_tonnage"][:5] for k in ("P1", "P2", "P3", "P4")] == [
        "Petit", "Gros ", "Petit", "Tres ",
    ]
    # Grade A prices after imputation are 1000, 950, 901.
    assert rows["P1"]["ecart_prix_grade_pct"] == round((1000 - 950) / 950 * 100, 1)
    assert rows["P1"]["superficie_ha"] == 4.0 and rows["P1"]["port_export"] == "San Pedro"
    stats = imputation_summary(cleaned, list(w.IMPUTED_FLAGS)).first()
    assert tuple(stats) == (1, 1)


def test_staged_unstaged_and_ranked_pipelines_agree(spark):
    tables_ = [f(spark, SF) for f in (fixture.weighings, fixture.growers, fixture.cooperatives)]
    plain = pipeline.clean(*tables_, fixture.ORDER)
    staged = pipeline.clean(*tables_, fixture.ORDER, pipeline.stage_in())
    want = plain.fact
    assert staged.fact.exceptAll(want).isEmpty() and want.exceptAll(staged.fact).isEmpty()
    rows = cleaning.season_columns(cleaning.correct_types(
        cleaning.deduplicate(cleaning.canonicalise_labels(tables_[0], tables_[2]), fixture.ORDER)
    ))
    ranked = cleaning.cleaning_statistics(rows, local_rows=5)
    assert ranked.grade_price is None
    imputed = cleaning.impute(cleaning.enrich(rows, *tables_[1:]), ranked)
    again = cleaning.derive_measures(imputed).select(*want.columns)
    assert again.exceptAll(want).isEmpty() and want.exceptAll(again).isEmpty()
    assert want.filter("prix_fcfa_kg IS NULL OR prix_fcfa_kg <= 0").isEmpty()
    known = anomaly_summary(want, w.ANOMALIES, plain.statistics.anomalies(want)).collect()
    assert known == anomaly_summary(want).collect()


def test_clean_plan_shuffles_the_fact_once_and_stays_in_the_jvm(spark, plan):
    tables_ = [f(spark, SF) for f in (fixture.weighings, fixture.growers, fixture.cooperatives)]
    text = plan(pipeline.clean(*tables_, fixture.ORDER).fact)
    assert "Python" not in text and "Pandas" not in text and "SortMergeJoin" not in text
    assert text.count("Exchange hashpartitioning(id_pesee") == 1
    assert "windowspecdefinition(qualite" not in text and "CartesianProduct" not in text


def test_clean_data_pass_the_nine_checks(spark):
    fact, growers, cooperatives = small_tables(spark)
    cleaned = pipeline.clean(fact, growers, cooperatives, ["o"]).fact
    checks = validate(cleaned, RELAXED, growers, cooperatives)
    levels = [(r["regle"], r["niveau"]) for r in checks.orderBy("ordre").collect()]
    assert [x for x in levels if x[0] != "V1"] == [
        (r, "OK") for r in ("R1", "R2", "R3", "R4", "R4", "R5", "R6", "R6", "R7")
    ]
    # One price and one moisture in four are imputed, above the limit of 5 %.
    assert levels[9:] == [("V1", "AVERTISSEMENT")] * 2
    messages = {r["message"] for r in checks.collect()}
    assert "R1 volume : 4 lignes (seuil 3)" in messages
    assert "R3 completude : 8 colonnes critiques sans valeur manquante" in messages
    assert "R4 domaine : 2 regions, toutes normalisees" in messages
    result = verdict(checks, cleaned.agg(F.count("*")).scalar()).first()
    assert result["valide"] and (result["nb_ok"], result["nb_avertissements"]) == (9, 2)
    assert result["resume"].startswith("QUALITE OK : 9 regle(s) passee(s), 0 erreur(s)")


def test_rules_report_every_defect_and_absent_columns(spark):
    fact, growers, cooperatives = small_tables(spark)
    broken = fact.withColumn("qualite", F.lit("Grade Z")).withColumn(
        "date", F.when(F.col("o") > 0, F.col("date"))
    )
    found = {
        (r["regle"], r["controle"]): r
        for r in validate(broken, w.RULES, growers, cooperatives).collect()
    }
    assert found["R1", "volume"]["nb"] == 69_995
    assert found["R2", "unicite"]["nb"] == 1
    assert found["R3", "completude"]["message"].endswith("sur date (1)")
    assert "['Grade Z']" in found["R4", "qualite"]["message"]
    assert found["R4", "region"]["nb"] == 2 and "[' soubre', 'San-Pedro']" in found["R4", "region"]["message"]
    assert found["R5", "bornes"]["message"] == "R5 bornes : prix_fcfa_kg (2 hors [200 ; 2000])"
    assert found["R6", "cooperative"]["nb"] == 2 and found["R6", "id_planteur"]["nb"] == 0
    assert found["R7", "coherence"]["nb"] == 3
    lacking = validate(fact.drop("qualite", "id_pesee"), w.RULES, growers, cooperatives).collect()
    absent = {(r["regle"], r["controle"]) for r in lacking if "absente" in (r["message"] or "")}
    assert {("R2", "id_pesee"), ("R3", "id_pesee"), ("R3", "qualite"), ("R4", "qualite")} <= absent


def test_rules_on_an_empty_table(spark):
    fact, growers, cooperatives = small_tables(spark)
    checks = validate(fact.limit(0), w.RULES, growers, cooperatives).collect()
    assert len(checks) == 9
    assert {r["regle"] for r in checks if r["niveau"] == "ERREUR"} == {"R1"}
    assert [r["nb_lignes"] for r in anomaly_summary(fact.limit(0)).collect()] == [0, 0, 0]


@pytest.mark.parametrize("limit", [100_000, 2])
def test_anomalies_equal_pandas(spark, limit):
    df = fixture.fact(spark, SF)
    frame = df.toPandas()
    q1, q3 = frame.tonnage_kg.quantile([0.25, 0.75])
    price = frame.groupby("qualite").prix_fcfa_kg.transform("median")
    masks = [
        frame.tonnage_kg > q3 + 3 * (q3 - q1),
        frame.humidite_pct > 8,
        (frame.prix_fcfa_kg - price).abs() / price > 0.30,
    ]
    stats = anomaly_statistics(df, local_rows=limit)
    got = anomaly_summary(df, stats=stats).collect()
    assert [r["nb_lignes"] for r in got] == [int(m.sum()) for m in masks]
    assert [r["part_pct"] for r in got] == [round(m.mean() * 100, 2) for m in masks]
    assert [r["tonnage_concerne_kg"] for r in got] == [frame.tonnage_kg[m].sum() for m in masks]
    assert flag_anomalies(df, stats=stats).count() == len(frame)


def test_csv_keeps_blanks_order_and_missing_values(spark, tmp_path):
    path = tmp_path / "pesees.csv"
    lines = ["id_pesee,date,region,cooperative,id_planteur,tonnage_kg,qualite,prix_fcfa_kg,humidite_pct"]
    lines += [f'P{i},2023-01-05," soubre ",C-{i},PLT1,{i}.5,Grade A,{900 + i},{"" if i % 2 else "NaN"}'
              for i in range(200)]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    df = tables.read_sources(spark, {"pesees": str(path)})["pesees"]
    back = df.orderBy(tables.ORDER).collect()
    assert [r["id_pesee"] for r in back] == [f"P{i}" for i in range(200)]
    assert back[0]["region"] == " soubre " and back[0]["humidite_pct"] is None
    assert back[3]["tonnage_kg"] == 3.5 and back[3]["prix_fcfa_kg"] == 903
    out = tables.write_csv(df.drop(tables.ORDER), str(tmp_path / "out"))
    again = tables.read_csv(spark, out, schemas.WEIGHINGS)
    assert again.exceptAll(df.drop(tables.ORDER)).isEmpty() and again.count() == 200
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_csv(spark, str(tmp_path / "absent.csv"), schemas.WEIGHINGS)
    path.write_text(lines[0] + "\nP1,2023-01-05,a,b,c,heavy,Grade A,1,2\n", encoding="utf-8")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.read_csv(spark, str(path), schemas.WEIGHINGS).collect()


def test_stage_order_and_nan(spark, tmp_path):
    path = str(tmp_path / "stage")
    pd.DataFrame({"k": ["b", "a", "b"], "x": [1.0, np.nan, 2.0]}).to_parquet(tmp_path / "one.parquet")
    df = tables.read_stage(spark, str(tmp_path / "one.parquet"), keep_order=True)
    assert [r["x"] for r in df.orderBy(tables.ORDER).collect()] == [1.0, None, 2.0]
    tables.write_stage(df.select("k", "x"), path)
    tables.write_stage(df.select("k", "x"), path)
    assert tables.read_stage(spark, path).count() == 3
    assert nan_to_null(spark.range(1)).columns == ["id"]


def test_run_writes_fact_and_reports(spark, tmp_path):
    fact, growers, cooperatives = small_tables(spark)
    written = pipeline.run(fact, growers, cooperatives, ["o"], str(tmp_path), RELAXED)
    assert written.count() == 4
    report = json.loads(
        next((tmp_path / "rapport_qualite.json").glob("part-*.json")).read_text(encoding="utf-8")
    )
    assert list(report) == [
        "genere_le", "volumes", "normalisation_libelles", "dedoublonnage", "imputation",
        "validation", "anomalies", "valeurs_manquantes_restantes",
    ]
    assert report["volumes"] == {"lignes_extraites": 5, "lignes_conservees": 4, "colonnes_finales": 25}
    assert report["normalisation_libelles"]["region"] == {
        "modalites_avant": 4, "modalites_apres": 2, "non_resolus": 0,
    }
    assert report["dedoublonnage"] == {"lignes_avant": 5, "doublons_supprimes": 1, "lignes_apres": 4}
    assert report["imputation"] == {"prix_impute": 1, "humidite_imputee": 1}
    assert report["validation"]["valide"] and len(report["validation"]["controles_passes"]) == 9
    assert report["validation"]["controles_passes"][0] == "R1 volume : 4 lignes (seuil 3)"
    assert report["validation"]["erreurs"] == [] and len(report["validation"]["avertissements"]) == 2
    assert [a["anomalie"] for a in report["anomalies"]] == [
        "tonnage extreme", "humidite hors norme export", "prix atypique pour le grade",
    ]
    assert report["valeurs_manquantes_restantes"] == []


def test_audit_report(spark, tmp_path):
    fact, growers, cooperatives = small_tables(spark)
    archived = audit.run(
        {"pesees": fact, "planteurs": growers, "cooperatives": cooperatives},
        {"pesees": "pesees.csv", "planteurs": "planteurs.csv", "cooperatives": "cooperatives.csv"},
        str(tmp_path),
    )
    assert archived["pesees"].exceptAll(fact).isEmpty() and archived["pesees"].count() == 5
    path = next((tmp_path / "rapport_audit.json").glob("part-*.json"))
    found = json.loads(path.read_text(encoding="utf-8"))
    assert found["sources"]["pesees"] == {"fichier": "pesees.csv", "nb_lignes": 5}
    assert found["constats"] == {
        "valeurs_manquantes": {"humidite_pct": 2},
        "doublons_id_pesee": 1,
        "doublons_lignes_completes": 1,
        "variantes_saisie": {"cooperative": 1, "qualite": 0, "region": 2},
        "prix_aberrants": 2,
        "periode": {"debut": "2022-10-05", "fin": "2023-12-31"},
        "integrite": {"orphelins_planteur": 0, "orphelins_cooperative": 0, "orphelins_region": 0},
    }


def test_self_check_and_star(spark):
    fact, growers, cooperatives = small_tables(spark)
    parts = analyses.self_check(fact, growers, cooperatives)
    assert [r["qualite"] for r in parts["prix_par_grade"].collect()] == ["Grade A", "Grade B"]
    assert tuple(parts["hierarchie"].first()) == (2, 2, 0)
    cleaned = pipeline.clean(fact, growers, cooperatives, ["o"]).fact
    star = analyses.star_schema(cleaned, growers, cooperatives)
    assert star["fact"].count() == 4
    assert star["fact"].filter("id_region IS NULL OR cle_planteur IS NULL").isEmpty()
    assert analyses.class_distribution(cleaned).count() == 3
    assert analyses.compliance_by_month(cleaned).agg(F.sum("nb")).first()[0] == 3
