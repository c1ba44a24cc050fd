"""Names, domains and thresholds of the cocoa weighing tables."""

from __future__ import annotations

from winnow.operators.anomalies import AnomalyColumns
from winnow.operators.impute import MedianFill
from winnow.operators.rules import RuleSet

KEY = "id_pesee"
MEASURES = ("tonnage_kg", "prix_fcfa_kg", "humidite_pct")
LABELS = ("region", "cooperative", "qualite")
FACT_COLUMNS = (
    "id_pesee", "date", "region", "cooperative", "id_planteur",
    "tonnage_kg", "qualite", "prix_fcfa_kg", "humidite_pct",
)

# Grades, season months and business thresholds.
GRADES = ("Grade A", "Grade B", "Grade C", "Hors grade")
MAIN_SEASON_MONTHS = (1, 2, 3, 10, 11, 12)
SEASON_START = 10
MAIN_SEASON, MID_SEASON = "Principale", "Intermediaire"
EXPORT_MOISTURE = 8.0
WEIGHT_EDGES = (0.0, 100.0, 500.0, 1000.0, float("inf"))
WEIGHT_CLASSES = (
    "Petit (<100 kg)", "Moyen (100-500 kg)", "Gros (500-1000 kg)", "Tres gros (>1000 kg)",
)
BOUNDS = {
    "tonnage_kg": (1.0, 5000.0),
    "prix_fcfa_kg": (200.0, 2000.0),
    "humidite_pct": (0.0, 25.0),
}
# Price factors and delivery weights by month.
ORGANIC_FACTOR = 1.10
MID_SEASON_FACTOR = 0.96
LARGE_LOT_KG, LARGE_LOT_FACTOR = 500.0, 1.03
SMALL_LOT_KG, SMALL_LOT_FACTOR = 100.0, 0.97
MONTH_WEIGHTS = {
    1: 0.12, 2: 0.06, 3: 0.04, 4: 0.04, 5: 0.06, 6: 0.07,
    7: 0.05, 8: 0.03, 9: 0.04, 10: 0.16, 11: 0.18, 12: 0.15,
}
SUNDAY_FACTOR = 0.25

PRICE_FILL = MedianFill(
    column="prix_fcfa_kg",
    keys=("qualite", "campagne"),
    flag="prix_impute",
    valid="prix_fcfa_kg > 0",
)
MOISTURE_FILL = MedianFill(
    column="humidite_pct",
    keys=("qualite",),
    flag="humidite_imputee",
    valid="humidite_pct IS NOT NULL",
    digits=1,
)
IMPUTED_FLAGS = {"prix_impute": "prix", "humidite_imputee": "humidite"}

RULES = RuleSet(
    key=KEY,
    critical=FACT_COLUMNS[:-1],
    grade="qualite",
    grades=GRADES,
    region="region",
    cooperative="cooperative",
    reference_cooperative="code_cooperative",
    grower="id_planteur",
    bounds=BOUNDS,
    imputed=IMPUTED_FLAGS,
)
ANOMALIES = AnomalyColumns()
