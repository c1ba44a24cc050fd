"""Read-only measurements of a table: profile, missing values, distributions, period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from winnow.functions.nulls import share_pct
from winnow.functions.rounding import round_half_even
from winnow.operators.bounded import LOCAL_ROWS, durable
from winnow.operators.quantiles import quantiles_of_summary
from winnow.operators.selection import SIZE, VALUE, summary

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def _floating(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (DoubleType, FloatType))


def _missing(df: DataFrame, column: str) -> Column:
    absent = F.col(column).isNull()
    return absent | F.isnan(column) if _floating(df, column) else absent


def profile_columns(
    df: DataFrame,
    columns: Sequence[str],
    order: Sequence[str],
    approximate: bool = False,
    width: int = 24,
) -> DataFrame:
    """Per column: type, first present value in row order, and number of distinct values.

    ``approximate`` swaps the exact distinct counts, which shuffle every value of
    every column once, for sketches that need no shuffle of values.
    """
    position = F.struct(*order)
    firsts = df.agg(
        *[F.min_by(F.col(c), F.when(~_missing(df, c), position)).alias(c) for c in columns]
    )
    examples = firsts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("colonne"),
                        F.lit(df.schema[c].dataType.simpleString()).alias("type"),
                        F.coalesce(F.substring(F.col(c).cast("string"), 1, width), F.lit("-")).alias(
                            "exemple"
                        ),
                    )
                    for c in columns
                ]
            )
        )
    )
    # Equal values have equal texts once the sign of a zero is dropped.
    texts = [
        F.struct(
            F.lit(c).alias("colonne"),
            F.when(
                ~_missing(df, c),
                (F.col(c) + 0.0 if _floating(df, c) else F.col(c)).cast("string"),
            ).alias("text"),
        )
        for c in columns
    ]
    present = df.select(F.inline(F.array(*texts))).filter("text IS NOT NULL")
    if approximate:
        sizes = present.groupBy("colonne").agg(F.approx_count_distinct("text").alias("distincts"))
    else:
        sizes = present.distinct().groupBy("colonne").agg(F.count("*").alias("distincts"))
    found = F.coalesce("distincts", F.lit(0)).alias("valeurs_distinctes")
    return examples.join(sizes, "colonne", "left").select("colonne", "type", "exemple", found)


def missing_rates(df: DataFrame, columns: Sequence[str] | None = None, all_columns: bool = False) -> DataFrame:
    """Missing values per column with their share in percent, columns without any left out."""
    columns = list(columns or df.columns)
    counts = df.agg(
        F.count("*").alias("__rows"), *[F.count_if(_missing(df, c)).alias(c) for c in columns]
    )
    rates = counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("colonne"),
                        F.col(c).alias("nb_manquants"),
                        share_pct(F.col(c), F.col("__rows")).alias("part_pct"),
                    )
                    for c in columns
                ]
            )
        )
    )
    return rates if all_columns else rates.filter(F.col("nb_manquants") > 0)


def distribution(
    df: DataFrame, measures: Sequence[str], digits: int = 1, local_rows: int = LOCAL_ROWS
) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of each measure.

    The measures are stacked as rows. One scan gives all moments and a sketch of each, a
    second the values around the quartiles.
    """
    stacked = [F.struct(F.lit(m).alias("mesure"), F.col(m).cast("double").alias(VALUE)) for m in measures]
    present = df.select(F.inline(F.array(*stacked))).dropna()
    moments = [
        F.avg(VALUE).alias("moyenne"),
        F.when(F.count("*") > 1, F.stddev_samp(VALUE)).alias("ecart_type"),
        F.min(VALUE).alias("minimum"),
        F.max(VALUE).alias("maximum"),
    ]
    found = durable(summary(present, ["mesure"], QUARTILES, extra=moments))
    quartiles = quantiles_of_summary(present, ["mesure"], QUARTILES, found, local_rows)
    figures = {
        c: F.col(c) for c in ("moyenne", "ecart_type", "minimum", *QUARTILES, "maximum")
    }
    return found.join(quartiles, "mesure").select(
        "mesure",
        F.col(SIZE).alias("nombre"),
        *[round_half_even(value, digits).alias(name) for name, value in figures.items()],
    )


def count_where(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row with the number of rows that meet each condition; unknown does not count."""
    return df.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])


def period_span(df: DataFrame, date: Column) -> DataFrame:
    """One row: first and last date and the days between them."""
    return df.agg(F.min(date).alias("debut"), F.max(date).alias("fin")).withColumn(
        "jours", F.datediff("fin", "debut")
    )
