"""Joins of a fact table with reference tables.

A reference is broadcast only after its rows were counted and fit the local bounds;
a larger one is sort-merged, where AQE splits a skewed key. Checks of keys group
the fact by key first, so a hot key reaches the join as one row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.functions.nulls import differs
from winnow.operators.bounded import rows_if_small, small_or_same


def duplicate_keys(reference: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once in a reference, with their number of rows."""
    return reference.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def attach_reference(
    df: DataFrame,
    reference: DataFrame,
    key: str,
    columns: Sequence[str],
    reference_key: str | None = None,
) -> DataFrame:
    """Many-to-one left join that adds reference columns and keeps every fact row.

    A repeated key is a ``ValueError`` before the join, whatever the size of the
    reference and whichever of its columns are used: a small reference is checked where
    it is counted, a large one by one grouping of its keys.
    """
    right_key = reference_key or key
    right = reference.select(F.col(right_key).alias("__key"), *columns)
    rows = rows_if_small(right)
    if rows is None:
        keys = right.filter(F.col("__key").isNotNull())
        repeated = [r["__key"] for r in duplicate_keys(keys, "__key").take(1)]
    else:
        counted = pc.value_counts(rows["__key"].drop_null())
        repeated = [e["values"].as_py() for e in counted if e["counts"].as_py() > 1]
        right = F.broadcast(df.sparkSession.createDataFrame(rows, schema=right.schema))
    if repeated:
        raise ValueError(f"repeated reference key {right_key}={repeated[0]}")
    return df.join(right, df[key] == right["__key"], "left").drop("__key")


def keep_known(df: DataFrame, domains: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows whose every listed column has its value in the given reference column."""
    for column, (reference, reference_column) in domains.items():
        known = small_or_same(reference.select(F.col(reference_column).alias("__known")).distinct())
        df = df.join(known, df[column] == known["__known"], "left_semi")
    return df


def orphan_keys(
    df: DataFrame, key: Column | str, reference: DataFrame, reference_key: Column | str
) -> DataFrame:
    """Fact keys absent from the reference as ``(key, n)``; a missing key is an orphan."""
    left = F.col(key) if isinstance(key, str) else key
    right = F.col(reference_key) if isinstance(reference_key, str) else reference_key
    counts = df.groupBy(left.alias("key")).agg(F.count("*").alias("n"))
    known = reference.select(right.alias("known")).distinct()
    return counts.join(known, F.col("key") == F.col("known"), "left_anti")


def orphan_count(
    df: DataFrame, key: Column | str, reference: DataFrame, reference_key: Column | str
) -> DataFrame:
    """One row ``orphelins``: fact rows whose key is absent from the reference."""
    lost = orphan_keys(df, key, reference, reference_key)
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphelins"))


def orphan_label_count(
    df: DataFrame,
    label: str,
    reference: DataFrame,
    reference_label: str,
    key: Callable[[str], Column],
) -> DataFrame:
    """One row ``orphelins``: fact rows whose label has no equal in the reference under ``key``.

    The key is taken once per distinct label, not per row.
    """
    labels = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    keys = labels.select(key("label").alias("key"), "n")
    known = reference.select(key(reference_label).alias("known")).distinct()
    lost = keys.join(known, F.col("key") == F.col("known"), "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphelins"))


def hierarchy_counts(
    df: DataFrame,
    key: str,
    attribute: str,
    reference: DataFrame,
    reference_key: str | None = None,
    reference_attribute: str | None = None,
) -> DataFrame:
    """One row: ``orphelins`` and ``incoherents``.

    A row is incoherent when its attribute is not the one its key has in the
    reference; missing on either side counts. A key that the reference lists with
    two attributes is coherent with neither.
    """
    pairs = df.groupBy(F.col(key).alias("k"), F.col(attribute).alias("a")).agg(
        F.count("*").alias("n")
    )
    value = F.col(reference_attribute or attribute)
    expected = (
        reference.groupBy(F.col(reference_key or key).alias("rk"))
        .agg(F.min(value).alias("low"), F.max(value).alias("high"))
        .select("rk", F.when(F.col("low") == F.col("high"), F.col("low")).alias("expected"))
    )
    joined = pairs.join(expected, F.col("k") == F.col("rk"), "left")
    return joined.agg(
        F.coalesce(F.sum(F.when(F.col("rk").isNull(), F.col("n"))), F.lit(0)).alias("orphelins"),
        F.coalesce(
            F.sum(F.when(differs(F.col("a"), F.col("expected")), F.col("n"))), F.lit(0)
        ).alias("incoherents"),
    )
