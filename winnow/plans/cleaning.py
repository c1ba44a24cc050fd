"""Cleaning stages of the weighing fact table, each ``DataFrame -> DataFrame``."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.functions.calendar import parse_date, season_kind, season_label, weekday_name
from winnow.functions.conditional import at_most, right_closed_bins
from winnow.functions.rounding import round_half_even, rounded_long
from winnow.operators.anomalies import QUARTILES, AnomalyStatistics
from winnow.operators.bounded import LOCAL_ROWS, local_if_small
from winnow.operators.canonical import canonicalise, official_labels, resolved_once
from winnow.operators.dedup import keep_first
from winnow.operators.impute import fill_with_median, filled_counts, medians_of_counts
from winnow.operators.joins import attach_reference
from winnow.operators.quantiles import (
    COUNT,
    VALUE,
    Measure,
    attach_statistic,
    group_quantiles,
    measure_counts,
    quantiles_of_counts,
)
from winnow.plans import weighings as w
from winnow.sources.tables import ORDER


TYPED_LABELS = {"region": "region", "cooperative": "code_cooperative"}


def official_names(cooperatives: DataFrame) -> DataFrame:
    """Official regions and cooperative codes by canonical key.

    Of two that share a key the last wins: the last to appear where the reference keeps its
    input order, else the last label.
    """
    order = ORDER if ORDER in cooperatives.columns else None
    return official_labels(cooperatives, TYPED_LABELS, order)


def typed_labels(fact: DataFrame, cooperatives: DataFrame) -> DataFrame:
    """Distinct typed labels with their official form and rows, computed once."""
    return resolved_once(fact, list(TYPED_LABELS), official_names(cooperatives))


def canonicalise_labels(
    fact: DataFrame, cooperatives: DataFrame, labels: DataFrame | None = None
) -> DataFrame:
    """Official region and cooperative labels wherever the typed one resolves."""
    officials = official_names(cooperatives)
    return canonicalise(fact, list(TYPED_LABELS), officials, resolved=labels)


def deduplicate(fact: DataFrame, order: Sequence[str]) -> DataFrame:
    """First scan of every ticket, in input order."""
    return keep_first(fact, [w.KEY], order)


def correct_dates(fact: DataFrame, strict: bool = True) -> DataFrame:
    """Date in its one imposed format."""
    return fact.withColumn("date", parse_date(F.col("date"), strict=strict))


def date_columns(fact: DataFrame) -> DataFrame:
    """Year, month and weekday name of the date."""
    return fact.withColumns(
        {
            "annee": F.year("date"),
            "mois": F.month("date"),
            "jour_semaine": weekday_name(F.col("date")),
        }
    )


def correct_types(fact: DataFrame, strict: bool = True) -> DataFrame:
    """Date in its one imposed format, with year, month and weekday name."""
    return date_columns(correct_dates(fact, strict))


def season_columns(fact: DataFrame) -> DataFrame:
    """Season kind and the October-to-September season label."""
    return fact.withColumns(
        {
            "campagne": season_kind(
                F.col("date"), w.MAIN_SEASON_MONTHS, w.MAIN_SEASON, w.MID_SEASON
            ),
            "saison": season_label(F.col("date"), w.SEASON_START),
        }
    )


def weight_class(text_for_missing: str | None = None) -> Column:
    """Class of a delivery by weight."""
    return right_closed_bins(
        F.col("tonnage_kg"), w.WEIGHT_EDGES, w.WEIGHT_CLASSES, text_for_missing
    )


def export_flag() -> Column:
    """Moisture within the export norm."""
    return at_most(F.col("humidite_pct"), w.EXPORT_MOISTURE)


def attach_references(fact: DataFrame, growers: DataFrame, cooperatives: DataFrame) -> DataFrame:
    """Attributes of the grower and of the cooperative; every weighing is kept."""
    fact = attach_reference(
        fact, growers, "id_planteur", ["superficie_ha", "annee_adhesion", "certifie_bio"]
    )
    return attach_reference(
        fact, cooperatives, "cooperative", ["zone_production", "port_export"], "code_cooperative"
    )


def enrich(fact: DataFrame, growers: DataFrame, cooperatives: DataFrame) -> DataFrame:
    """References, season, export flag and weight class."""
    return season_columns(attach_references(fact, growers, cooperatives)).withColumns(
        {"conforme_export": export_flag(), "categorie_tonnage": weight_class()}
    )


@dataclass(frozen=True)
class CleaningStatistics:
    """Statistics of the deduplicated fact that imputation, measures and anomalies share."""

    price: DataFrame
    moisture: DataFrame
    grade_price: DataFrame | None
    quartiles: DataFrame | None

    def anomalies(self, fact: DataFrame) -> AnomalyStatistics:
        """Anomaly statistics of the cleaned fact, without another scan if they are known."""
        medians, quartiles = self.grade_price, self.quartiles
        if medians is None:
            medians = group_quantiles(fact, ["qualite"], "prix_fcfa_kg")
        if quartiles is None:
            quartiles = group_quantiles(fact, [], "tonnage_kg", QUARTILES)
        return AnomalyStatistics(quartiles, medians)


def cleaning_statistics(fact: DataFrame, local_rows: int = LOCAL_ROWS) -> CleaningStatistics:
    """All medians and quartiles from one scan of four columns.

    The counted prices tell the grade medians both before and after imputation,
    so the filled table need not be read again. If the values are too many to be
    local, each statistic is ranked in a distributed sort instead.
    """
    price, moisture = w.PRICE_FILL, w.MOISTURE_FILL
    counts = local_if_small(
        measure_counts(
            fact, [price.measure, moisture.measure, Measure("tonnage_kg", "tonnage_kg")]
        ),
        local_rows,
    )
    if counts is None:
        return CleaningStatistics(
            group_quantiles(fact, price.keys, F.expr(price.measure.value), local_rows=local_rows),
            group_quantiles(fact, moisture.keys, moisture.column, local_rows=local_rows),
            None,
            None,
        )
    filled = filled_counts(counts, price).dropna(subset=["qualite", VALUE])
    weights = counts.filter("mesure = 'tonnage_kg'").dropna(subset=[VALUE])
    return CleaningStatistics(
        medians_of_counts(counts, price),
        medians_of_counts(counts, moisture),
        quantiles_of_counts(filled, ["qualite"]),
        quantiles_of_counts(weights.select(VALUE, COUNT), [], QUARTILES),
    )


def impute(fact: DataFrame, stats: CleaningStatistics | None = None) -> DataFrame:
    """Fill and flag prices and moistures, then judge the export norm again."""
    stats = stats or cleaning_statistics(fact)
    fact = fill_with_median(fact, w.PRICE_FILL, stats.price)
    fact = fill_with_median(fact, w.MOISTURE_FILL, stats.moisture)
    return fact.withColumn("conforme_export", export_flag())


def derive_measures(fact: DataFrame, grade_price: DataFrame | None = None) -> DataFrame:
    """Amount paid, and deviation from the median price of the grade in percent."""
    if grade_price is None:
        grade_price = group_quantiles(fact, ["qualite"], "prix_fcfa_kg")
    relative = F.try_divide(F.col("prix_fcfa_kg") - F.col("median"), F.col("median")) * 100
    return (
        attach_statistic(fact, grade_price, ["qualite"])
        .withColumns(
            {
                "montant_fcfa": rounded_long(F.col("tonnage_kg") * F.col("prix_fcfa_kg")),
                "ecart_prix_grade_pct": round_half_even(relative, 1),
            }
        )
        .drop("median")
    )
