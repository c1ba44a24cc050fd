"""Tolerant reading of CSV: one pass gives the rows and a list of everything that was wrong."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from winnow.operators.bounded import durable
from winnow.sources.tables import MISSING_TEXTS, ORDER, row_position

SURPLUS, SHORT, UNREADABLE = "cellules en trop", "cellules manquantes", "ligne illisible"
BAD_VALUE, BAD_DATE = "valeur illisible", "date illisible"
_RECORD = "__record"


def _cells(record: Column) -> Column:
    """Number of cells of a record; separators inside quotes do not count."""
    return F.size(F.split(F.regexp_replace(record, r'"([^"]|"")*"', "q"), ","))


def read_csv_with_rejects(
    spark: SparkSession,
    path: str,
    schema: StructType,
    key: str,
    missing: Sequence[str] = MISSING_TEXTS,
    dates: Mapping[str, str] | None = None,
    header: bool = True,
    multiline: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The rows under their schema, and ``(input_order, key, colonne, raison, texte)`` per problem.

    A row with too few cells is filled with missing ones. One with too many cells, or that
    cannot be split into cells, is left out. A cell that cannot be cast, or a text in ``dates``
    (column: pattern) that is no date, becomes missing and its row stays. ``colonne`` is NULL
    for a problem of the whole row, whose ``texte`` is the record. The file is read once, into
    a durable table that both results read.
    """
    text = StructType([StructField(f.name, StringType()) for f in schema])
    raw = (
        spark.read.schema(text.add(_RECORD, StringType()))
        .options(header=header, encoding="UTF-8", mode="PERMISSIVE", escape='"', multiLine=multiline)
        .options(columnNameOfCorruptRecord=_RECORD, enforceSchema=not header)
        .csv(path)
    )
    values, problems = {}, []

    def problem(column: str | None, reason: Column, found: Column, bad: Column) -> Column:
        entry = F.struct(
            F.lit(column).cast("string").alias("colonne"), reason.alias("raison"), found.alias("texte")
        )
        return F.when(bad, entry)

    cells = _cells(F.col(_RECORD))
    reason = F.when(cells > len(schema), SURPLUS).when(cells < len(schema), SHORT).otherwise(UNREADABLE)
    lost = F.col(_RECORD).isNotNull() & (cells >= len(schema))
    problems.append(problem(None, reason, F.col(_RECORD), F.col(_RECORD).isNotNull()))
    for f in schema:
        own = F.when(~F.col(f.name).isin(*missing), F.col(f.name))
        value = own.try_cast(f.dataType)
        if f.name in (dates or {}):
            day = F.try_to_date(own, dates[f.name])
            value = F.when(day.isNotNull(), own).try_cast(f.dataType)
        why = F.lit(BAD_DATE if f.name in (dates or {}) else BAD_VALUE)
        problems.append(problem(f.name, why, own, ~lost & own.isNotNull() & value.isNull()))
        values[f.name] = value
    read = durable(
        raw.select(
            *[v.alias(c) for c, v in values.items()],
            row_position().alias(ORDER),
            F.col(key).alias("__key"),
            F.array_compact(F.array(*problems)).alias("__problems"),
            lost.alias("__lost"),
        )
    )
    rows = read.filter(~F.col("__lost")).select(*values, ORDER)
    rejects = read.select(ORDER, F.col("__key").alias(key), F.inline("__problems"))
    return rows, rejects
