"""The whole transformation: clean, control, write."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.functions.nulls import nan_to_null, share_pct
from winnow.operators.anomalies import FLAGS, flag_anomalies, summary_rows
from winnow.operators.canonical import stats_of_labels
from winnow.operators.rules import ERROR, OK, WARNING, RuleSet, measure
from winnow.plans import weighings as w
from winnow.plans.audit import as_map, stamped
from winnow.plans.cleaning import (
    CleaningStatistics,
    canonicalise_labels,
    cleaning_statistics,
    correct_dates,
    date_columns,
    deduplicate,
    derive_measures,
    enrich,
    impute,
    season_columns,
    typed_labels,
)
from winnow.sources.stages import Run, Stage
from winnow.sources.tables import read_stage, write_report, write_stage

CLEAN_COLUMNS = (
    *w.FACT_COLUMNS,
    "annee", "mois", "jour_semaine",
    "superficie_ha", "annee_adhesion", "certifie_bio", "zone_production", "port_export",
    "campagne", "saison", "conforme_export", "categorie_tonnage",
    "prix_impute", "humidite_imputee", "montant_fcfa", "ecart_prix_grade_pct",
)


@dataclass(frozen=True)
class Cleaned:
    """The clean fact, the statistics it was built with, and what cleaning saw on its way.

    ``labels`` are the distinct raw labels with their official form and rows; ``kept`` is the
    number of deduplicated rows where a stage has counted them.
    """

    fact: DataFrame
    statistics: CleaningStatistics
    labels: DataFrame
    kept: int | None = None


def clean(
    fact: DataFrame,
    growers: DataFrame,
    cooperatives: DataFrame,
    order: Sequence[str],
    stage: Stage | None = None,
    strict_dates: bool = True,
) -> Cleaned:
    """The 25-column clean fact.

    The order is semantic: labels first or joins miss, duplicates out before any
    median, dates before seasons, imputation last. The deduplicated rows are read
    twice: ``stage`` writes and counts them once, otherwise the second reading
    repeats the exchange with the four columns that the statistics need. What the date
    alone tells is added after the references, so that it does not move with the rows.
    """

    def typed_rows(rows: DataFrame) -> DataFrame:
        unique = deduplicate(rows, order).select(*w.FACT_COLUMNS)
        return correct_dates(unique, strict_dates)

    fact = nan_to_null(fact)
    labels = typed_labels(fact, cooperatives)
    typed = typed_rows(canonicalise_labels(fact, cooperatives, labels))
    if stage is not None:
        typed = measured = stage(typed)
    else:
        measured = typed_rows(fact)
    stats = cleaning_statistics(season_columns(measured))
    filled = impute(date_columns(enrich(typed, growers, cooperatives)), stats)
    clean_fact = derive_measures(filled, stats.grade_price).select(*CLEAN_COLUMNS)
    return Cleaned(clean_fact, stats, labels, stage.rows if stage else None)


def stage_in(folder: str | None = None) -> Stage:
    """A stage that writes Parquet under a fresh name in the shared folder and reads it back."""
    return Stage(folder)


def control(
    cleaned: Cleaned, growers: DataFrame, cooperatives: DataFrame, rules: RuleSet = w.RULES
) -> DataFrame:
    """One row with all that is controlled on the clean fact, from one scan of it.

    ``checks`` and ``anomalies`` are the rows of the rules and of the anomaly summary,
    ``missing`` the columns with missing values, ``filled`` the imputed values by flag.
    """
    fact = nan_to_null(cleaned.fact)
    stats = cleaned.statistics.anomalies(fact)
    flagged = flag_anomalies(fact, w.ANOMALIES, stats)
    marks = {f: f for f in FLAGS} | {f"filled_{i}": f for i, f in enumerate(w.IMPUTED_FLAGS)}
    marks |= {f"absent_{i}": f"`{c}` IS NULL" for i, c in enumerate(fact.columns)}
    figures = measure(flagged, rules, growers, cooperatives, marks, w.ANOMALIES.weight)
    absent = [
        F.struct(
            F.lit(c).alias("colonne"),
            F.col(f"absent_{i}").alias("nb_manquants"),
            share_pct(F.col(f"absent_{i}"), F.col("rows")).alias("part_pct"),
        )
        for i, c in enumerate(fact.columns)
    ]
    filled = [F.col(f"filled_{i}").alias(f) for i, f in enumerate(w.IMPUTED_FLAGS)]
    return figures.with_checks("checks").select(
        "rows",
        "checks",
        summary_rows(w.ANOMALIES, stats).alias("anomalies"),
        F.filter(F.array(*absent), lambda m: m["nb_manquants"] > 0).alias("missing"),
        F.struct(*filled).alias("filled"),
    )


def quality_report(
    cleaned: Cleaned,
    growers: DataFrame,
    cooperatives: DataFrame,
    rules: RuleSet = w.RULES,
    generated: bool = True,
) -> DataFrame:
    """The quality report as one nested row, ready to be written as JSON.

    It reads the clean fact once and the raw one not at all: the distinct labels tell the raw
    rows, and the rows that are left were counted by the stage, or else by the rules.
    """
    by_label = as_map(
        stats_of_labels(cleaned.labels),
        "colonne",
        F.struct("modalites_avant", "modalites_apres", "non_resolus"),
    )
    raw = cleaned.labels.filter(F.col("colonne") == "region").agg(F.coalesce(F.sum("n"), F.lit(0)))
    before = raw.scalar()
    kept = F.col("rows") if cleaned.kept is None else F.lit(cleaned.kept).cast("long")

    def messages(level: str) -> Column:
        found = F.filter("checks", lambda c: c["niveau"] == level)
        ordered = F.array_sort(F.transform(found, lambda c: F.struct(c["ordre"], c["controle"], c["message"])))
        return F.transform(ordered, lambda c: c["message"])

    checks = F.struct(
        (~F.exists("checks", lambda c: c["niveau"] == ERROR)).alias("valide"),
        kept.alias("nb_lignes"),
        messages(OK).alias("controles_passes"),
        messages(ERROR).alias("erreurs"),
        messages(WARNING).alias("avertissements"),
    )
    report = control(cleaned, growers, cooperatives, rules).select(
        F.struct(
            before.alias("lignes_extraites"),
            kept.alias("lignes_conservees"),
            F.lit(len(cleaned.fact.columns)).alias("colonnes_finales"),
        ).alias("volumes"),
        F.struct(
            by_label["region"].alias("region"), by_label["cooperative"].alias("cooperative")
        ).alias("normalisation_libelles"),
        F.struct(
            before.alias("lignes_avant"),
            (before - kept).alias("doublons_supprimes"),
            kept.alias("lignes_apres"),
        ).alias("dedoublonnage"),
        F.col("filled").alias("imputation"),
        checks.alias("validation"),
        F.col("anomalies"),
        F.col("missing").alias("valeurs_manquantes_restantes"),
    )
    return stamped(report) if generated else report


def run(
    fact: DataFrame,
    growers: DataFrame,
    cooperatives: DataFrame,
    order: Sequence[str],
    output: str,
    rules: RuleSet = w.RULES,
) -> DataFrame:
    """Clean, write the fact and its quality report under ``output``, return the written fact.

    Intermediate tables go with the run. Fact and report appear when both are complete; after
    an error whatever stood there before is still there.
    """
    spark = fact.sparkSession
    path = f"{output}/pesees_propres.parquet"
    with Run(spark) as scope:
        cleaned = clean(fact, growers, cooperatives, order, scope.stage())
        written = read_stage(spark, write_stage(cleaned.fact, scope.result(path)))
        report = quality_report(replace(cleaned, fact=written), growers, cooperatives, rules)
        write_report(report, scope.result(f"{output}/rapport_qualite.json"))
    return read_stage(spark, path)
