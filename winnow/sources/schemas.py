"""Declared schemas of the three input tables."""

from __future__ import annotations

from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructType

WEIGHINGS = (
    StructType()
    .add("id_pesee", StringType())
    .add("date", StringType())
    .add("region", StringType())
    .add("cooperative", StringType())
    .add("id_planteur", StringType())
    .add("tonnage_kg", DoubleType())
    .add("qualite", StringType())
    .add("prix_fcfa_kg", LongType())
    .add("humidite_pct", DoubleType())
)

GROWERS = (
    StructType()
    .add("id_planteur", StringType())
    .add("code_cooperative", StringType())
    .add("region", StringType())
    .add("superficie_ha", DoubleType())
    .add("annee_adhesion", LongType())
    .add("certifie_bio", BooleanType())
)

COOPERATIVES = (
    StructType()
    .add("code_cooperative", StringType())
    .add("nom_cooperative", StringType())
    .add("region", StringType())
    .add("zone_production", StringType())
    .add("port_export", StringType())
    .add("annee_creation", LongType())
    .add("certifiee_bio", BooleanType())
)

INPUT_SCHEMAS = {"pesees": WEIGHINGS, "planteurs": GROWERS, "cooperatives": COOPERATIVES}
