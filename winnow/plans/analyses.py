"""Analyses of the clean fact and self-checks of the raw one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnow.functions.calendar import parse_date, season_kind
from winnow.functions.conditional import first_match, scaled_price
from winnow.functions.rounding import round_half_even
from winnow.operators.aggregates import (
    exact_sum,
    grouped_summary,
    keys_with_several,
    weighted_mean,
    with_share,
)
from winnow.operators.impute import measured_only
from winnow.operators.joins import keep_known
from winnow.operators.star import dimension, star_fact
from winnow.plans import weighings as w


def weighted_price(fact: DataFrame, keys: tuple[str, ...] = ("qualite", "saison")) -> DataFrame:
    """Mean price weighted by weight, ``sum(amount) / sum(weight)``."""
    return weighted_mean(fact, keys, "montant_fcfa", "tonnage_kg", "prix_moyen_pondere")


def grade_summary(fact: DataFrame) -> DataFrame:
    """Rows, mean price and mean moisture per grade, dearest grade first."""
    priced = fact.filter(F.col("prix_fcfa_kg") > 0)
    return grouped_summary(
        priced,
        ["qualite"],
        counted={"nb": w.KEY},
        means={"prix_moyen": "prix_fcfa_kg", "humidite_moyenne": "humidite_pct"},
    ).orderBy(F.desc("prix_moyen"), "qualite")


def season_share(fact: DataFrame) -> DataFrame:
    """Rows, weight and share of the weight per season kind."""
    kind = season_kind(
        parse_date(F.col("date")), w.MAIN_SEASON_MONTHS, "principale", "intermediaire"
    )
    priced = fact.filter(F.col("prix_fcfa_kg") > 0).withColumn("campagne", kind)
    totals = grouped_summary(
        priced, ["campagne"], counted={"nb_pesees": w.KEY}, sums={"tonnage_kg": "tonnage_kg"}
    )
    return with_share(totals, "tonnage_kg", "part_pct")


def usable_rows(fact: DataFrame, cooperatives: DataFrame) -> DataFrame:
    """Rows whose region and cooperative are both official as typed."""
    return keep_known(
        fact,
        {"region": (cooperatives, "region"), "cooperative": (cooperatives, "code_cooperative")},
    )


def hierarchy_check(fact: DataFrame, growers: DataFrame, cooperatives: DataFrame) -> DataFrame:
    """One row: usable rows, distinct region-cooperative pairs, growers in several regions."""
    pairs = fact.groupBy("region", "cooperative").agg(F.count("*").alias("n"))
    several = keys_with_several(growers, "id_planteur", "region")
    return (
        usable_rows(pairs, cooperatives)
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("lignes_exploitables"),
            F.count("*").alias("couples"),
        )
        .withColumn("planteurs_multi_region", several.agg(F.count("*")).scalar())
    )


def self_check(fact: DataFrame, growers: DataFrame, cooperatives: DataFrame) -> dict[str, DataFrame]:
    """Grade prices, season shares and strictness of the hierarchy."""
    return {
        "prix_par_grade": grade_summary(fact),
        "repartition_campagne": season_share(fact),
        "hierarchie": hierarchy_check(fact, growers, cooperatives),
    }


def tiered_price(base: Column, organic: Column, main_season: Column, weight: Column) -> Column:
    """Price after the organic premium, the mid-season cut and the lot-size tier."""
    return scaled_price(
        base,
        F.when(organic, w.ORGANIC_FACTOR).otherwise(1.0),
        F.when(main_season, 1.0).otherwise(w.MID_SEASON_FACTOR),
        first_match(
            [
                (weight >= w.LARGE_LOT_KG, F.lit(w.LARGE_LOT_FACTOR)),
                (weight < w.SMALL_LOT_KG, F.lit(w.SMALL_LOT_FACTOR)),
            ],
            1.0,
        ),
    )


def compliance_by_month(fact: DataFrame) -> DataFrame:
    """Rows, weight and export compliance per season and month, measured moistures only."""
    compliant = F.count_if("conforme_export")
    share = F.rint(F.try_divide(compliant.cast("double"), F.count("*").cast("double")) * 1000) / 10
    return (
        measured_only(fact, ["humidite_imputee"])
        .groupBy("saison", "campagne", "mois")
        .agg(
            F.count("*").alias("nb"),
            exact_sum(fact, "tonnage_kg").alias("tonnage_kg"),
            compliant.alias("nb_conformes"),
            share.alias("taux_conformite_pct"),
        )
    )


def class_distribution(fact: DataFrame) -> DataFrame:
    """Rows, weight and share of the rows per weight class."""
    totals = fact.groupBy("categorie_tonnage").agg(
        F.count("*").alias("nb"), exact_sum(fact, "tonnage_kg").alias("tonnage_kg")
    )
    return with_share(totals, "nb", "part_pct")


def season_comparison(fact: DataFrame) -> DataFrame:
    """Deliveries of every month of every season beside the same month of the season before.

    The months form a spine without gaps from the first season to the last: a month without a
    delivery counts as zero, so that the season before is always the row before. The change in
    percent is NULL in the first season and after a month of zero. Rows without a date are in
    no season.
    """
    start = F.substring("saison", 1, 4).cast("int")
    months = (
        fact.filter(F.col("saison").isNotNull())
        .groupBy(start.alias("debut"), "mois")
        .agg(F.count("*").alias("nb"), exact_sum(fact, "tonnage_kg").alias("tonnage_kg"))
    )
    spine = (
        months.agg(F.min("debut").alias("low"), F.max("debut").alias("high"))
        .filter(F.col("low").isNotNull())
        .select(F.explode(F.sequence("low", "high")).alias("debut"))
        .select("debut", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("mois"))
    )
    filled = spine.join(months, ["debut", "mois"], "left").fillna({"nb": 0, "tonnage_kg": 0.0})
    before = Window.partitionBy("mois").orderBy("debut")
    previous = F.lag("tonnage_kg").over(before)
    change = F.try_divide(F.col("tonnage_kg") - previous, F.when(previous != 0, previous)) * 100
    return filled.select(
        F.concat_ws("-", "debut", F.col("debut") + 1).alias("saison"),
        "mois",
        "nb",
        "tonnage_kg",
        F.lag("nb").over(before).alias("nb_precedent"),
        previous.alias("tonnage_precedent"),
        round_half_even(change, 1).alias("evolution_pct"),
    )


def star_schema(fact: DataFrame, growers: DataFrame, cooperatives: DataFrame) -> dict[str, DataFrame]:
    """Three dimensions with integer keys, and the fact that carries them."""
    regions = dimension(cooperatives, "region", "id_region")
    coops = dimension(
        cooperatives, "code_cooperative", "id_cooperative", ["zone_production", "port_export"]
    )
    planters = dimension(
        growers, "id_planteur", "cle_planteur", ["superficie_ha", "annee_adhesion", "certifie_bio"]
    )
    measures = [
        w.KEY, "date", "campagne", "saison", "qualite", "categorie_tonnage", "tonnage_kg",
        "prix_fcfa_kg", "montant_fcfa", "humidite_pct", "conforme_export", "prix_impute",
        "humidite_imputee",
    ]
    table = star_fact(
        fact,
        {
            "region": (regions, "region", "id_region"),
            "cooperative": (coops, "code_cooperative", "id_cooperative"),
            "id_planteur": (planters, "id_planteur", "cle_planteur"),
        },
        measures,
    )
    return {"dim_region": regions, "dim_cooperative": coops, "dim_planteur": planters, "fact": table}
