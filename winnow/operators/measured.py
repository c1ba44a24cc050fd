"""Every measurement of a raw table from one scan: three groupings over stacked rows.

A row of the table becomes rows of (code, key): its faults as one text of 0 and 1, its ticket
with a digest of the whole row, and the value of each measured column. The first grouping counts equal rows
before its exchange. The second brings the spellings of one label, or the copies of one ticket,
together. The third adds everything up to one row: volumes, duplicates, missing values, label
variants, orphans, first and last date.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegralType,
    StringType,
    TimestampNTZType,
)

from winnow.functions.labels import canonical_key
from winnow.functions.nulls import nan_to_null
from winnow.operators.bounded import LOCAL_ROWS, local_if_small

_FAULTS, _TICKET, _FIRST = 0, 1, 2
_PLAIN = (
    BooleanType, DateType, DecimalType, DoubleType, FloatType, IntegralType, StringType, TimestampNTZType,
)


@dataclass(frozen=True)
class Wanted:
    """What is measured besides volume and duplicates of the ``key``.

    ``labels`` are compared by canonical key. ``references`` maps a column to the table and
    column that list its known values; those of a label column are compared by canonical key
    too. ``conditions`` are SQL conditions to be counted, ``date`` a column read by ``parse``.
    """

    key: str
    columns: Sequence[str]
    labels: Sequence[str] = ()
    references: Mapping[str, tuple[DataFrame, str]] = field(default_factory=dict)
    conditions: Mapping[str, str] = field(default_factory=dict)
    date: str | None = None
    parse: Callable[[Column], Column] = F.to_date

    @property
    def values(self) -> dict[str, int]:
        """Codes of the columns whose values are counted."""
        names = [*self.labels, *self.references, *([self.date] if self.date else [])]
        return {c: _FIRST + i for i, c in enumerate(dict.fromkeys(names))}


def _digest(df: DataFrame, columns: Sequence[str]) -> Column | None:
    """128 bits that tell the rows of one ticket apart, or None for columns without one plain text."""
    texts = []
    for c in columns:
        kind = df.schema[c].dataType
        if not isinstance(kind, _PLAIN):
            return None
        # Equal values have equal texts once the sign of a zero is dropped.
        text = (F.col(c) + 0.0 if isinstance(kind, (DoubleType, FloatType)) else F.col(c)).cast("string")
        sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        texts.append(F.coalesce(sized, F.lit("-")))
    return F.substring(F.unhex(F.sha2(F.concat(F.lit(""), *texts), 256)), 1, 16)


def _stacked(df: DataFrame, wanted: Wanted) -> DataFrame:
    marks = [F.col(c).isNull() for c in wanted.columns]
    marks += [F.coalesce(F.expr(x), F.lit(False)) for x in wanted.conditions.values()]
    pattern = F.concat(F.lit(""), *[F.when(m, "1").otherwise("0") for m in marks])
    whole = _digest(df, wanted.columns)
    whole = F.struct(*wanted.columns) if whole is None else whole
    none = F.when(F.lit(False), whole)

    def entry(code: int, key: Column, row: Column = none) -> Column:
        return F.struct(F.lit(code).alias("code"), key.cast("string").alias("k"), row.alias("whole"))

    entries = [entry(_FAULTS, pattern), entry(_TICKET, F.col(wanted.key), whole)]
    entries += [entry(code, F.col(c)) for c, code in wanted.values.items()]
    return df.select(F.inline(F.array(*entries)))


def _known(df: DataFrame, wanted: Wanted) -> DataFrame | None:
    """``(r_code, r_k)``: the known values of all referenced columns."""
    known = None
    for column, (reference, name) in wanted.references.items():
        key = canonical_key(name) if column in wanted.labels else F.col(name).cast("string")
        part = reference.filter(F.col(name).isNotNull()).select(F.lit(wanted.values[column]).alias("r_code"), key.alias("r_k"))
        known = part if known is None else known.unionByName(part)
    return None if known is None else known.distinct()


def _folded(merged: DataFrame) -> DataFrame:
    """The merged rows with those of all tickets added up, which no reference knows.

    They are added up within each task, so that only labels, growers and dates move and are sorted.
    """
    key = F.when(F.col("code") != _TICKET, F.col("k2")).alias("k2")
    return merged.groupBy("code", key).agg(*[F.sum(c).alias(c) for c in ("n", "same", "raw", "keys")])


def measure_table(df: DataFrame, wanted: Wanted, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """One row of figures.

    ``lignes``, ``cles``, ``doublons_cle`` and ``doublons_complets``; the missing values of each
    column in the map ``manquants``; each condition under its name; for a label ``c`` the counts
    ``brutes_c`` and ``normalisees_c``; for a reference ``orphelins_c``; ``debut`` and ``fin``
    of the date. A missing key is one key, a missing label has the key ``''`` but no spelling,
    a missing referenced value is an orphan. NaN counts as missing.
    """
    codes = wanted.values
    counted = _stacked(nan_to_null(df), wanted).groupBy("code", "k", "whole").agg(F.count("*").alias("n"))
    label_codes = [codes[c] for c in wanted.labels]
    key = F.when(F.col("code").isin(*label_codes), canonical_key("k")) if label_codes else F.when(F.lit(False), "")
    merged = (
        counted.withColumn("k2", key.otherwise(F.col("k")))
        .groupBy("code", "k2")
        .agg(F.sum("n").alias("n"), F.sum(F.col("n") - 1).alias("same"), F.count("k").alias("raw"))
        .withColumn("keys", F.lit(1).cast("long"))
    )
    known = _known(df, wanted)
    if known is not None:
        small = local_if_small(known, local_rows)
        merged, known = (_folded(merged), known) if small is None else (merged, F.broadcast(small))
        merged = merged.join(known, F.expr("code = r_code AND k2 = r_k"), "left")

    def total(condition: str, value: str, name: str) -> Column:
        return F.expr(f"coalesce(sum(IF({condition}, {value}, 0L)), 0L)").alias(name)

    def faults(place: int, name: str) -> Column:
        return total(f"code = {_FAULTS} AND substring(k2, {place}, 1) = '1'", "n", name)

    ticket = f"code = {_TICKET}"
    figures = [
        total(ticket, "n", "lignes"),
        total(ticket, "keys", "cles"),
        total(ticket, "n - keys", "doublons_cle"),
        total(ticket, "same", "doublons_complets"),
        *[faults(i, f"missing_{i}") for i in range(1, len(wanted.columns) + 1)],
        *[faults(i, c) for i, c in enumerate(wanted.conditions, len(wanted.columns) + 1)],
    ]
    for column, code in codes.items():
        if column in wanted.labels:
            figures.append(total(f"code = {code}", "raw", f"brutes_{column}"))
            figures.append(total(f"code = {code}", "keys", f"normalisees_{column}"))
        if column in wanted.references:
            figures.append(total(f"code = {code} AND r_k IS NULL", "n", f"orphelins_{column}"))
    if wanted.date:
        day = F.when(F.col("code") == codes[wanted.date], wanted.parse(F.col("k2")))
        figures += [F.min(day).alias("debut"), F.max(day).alias("fin")]
    row = merged.agg(*figures)
    entries = [
        F.struct(F.lit(c).alias("k"), F.col(f"missing_{i}").alias("n"))
        for i, c in enumerate(wanted.columns, 1)
    ]
    found = F.array_sort(F.filter(F.array(*entries), lambda e: e["n"] > 0))
    return row.withColumn("manquants", F.map_from_entries(found)).drop(
        *[f"missing_{i}" for i in range(1, len(wanted.columns) + 1)]
    )
