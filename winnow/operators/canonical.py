"""Canonicalisation of hand-typed labels against a reference."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.functions.labels import canonical_key, strip_blanks, title_case
from winnow.operators.bounded import LOCAL_ROWS, durable, local_if_small, small_or_same


def official_labels(
    reference: DataFrame, columns: Mapping[str, str], order: str | None = None
) -> DataFrame:
    """Lookup ``(colonne, label_key, official)`` with one official label per key.

    ``columns`` maps each fact column to the reference column that names its official
    labels; all are read in one scan. When two official labels share a key, the one
    that first appears last in ``order`` wins, or without an order the last label.
    """
    entries = [
        F.struct(F.lit(c).alias("colonne"), F.col(r).alias("official")) for c, r in columns.items()
    ]
    labels = reference.select(
        F.inline(F.array(*entries)), *([] if order is None else [F.col(order).alias("position")])
    ).filter("official IS NOT NULL")
    key = canonical_key("official").alias("label_key")
    if order is None:
        return labels.distinct().groupBy("colonne", key).agg(F.max("official").alias("official"))
    first = labels.groupBy("colonne", "official").agg(F.min("position").alias("position"))
    return first.groupBy("colonne", key).agg(F.max_by("official", "position").alias("official"))


def official_collisions(reference: DataFrame, column: str) -> DataFrame:
    """Keys shared by several official labels, with the first and last of them."""
    labels = reference.select(F.col(column).alias("official")).dropna().distinct()
    return (
        labels.groupBy(canonical_key("official").alias("label_key"))
        .agg(
            F.count("*").alias("n"),
            F.min("official").alias("first_label"),
            F.max("official").alias("last_label"),
        )
        .filter(F.col("n") > 1)
    )


def label_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per distinct label of several columns, ``(colonne, label, n)``, in one scan."""
    pairs = F.inline(
        F.array(*[F.struct(F.lit(c).alias("colonne"), F.col(c).alias("label")) for c in columns])
    )
    return df.select(pairs).groupBy("colonne", "label").agg(F.count("*").alias("n"))


def resolve_labels(df: DataFrame, columns: Sequence[str], officials: DataFrame) -> DataFrame:
    """Distinct labels with their official form, ``(colonne, label, n, official)``.

    The key is computed once per distinct label, never per row; ``official`` is
    NULL where a label does not resolve.
    """
    counts = label_counts(df, columns).withColumn("label_key", canonical_key("label"))
    return counts.join(officials, ["colonne", "label_key"], "left").drop("label_key")


def resolved_once(
    df: DataFrame, columns: Sequence[str], officials: DataFrame, local_rows: int = LOCAL_ROWS
) -> DataFrame:
    """The resolved labels, computed by one scan and kept for every later reader."""
    resolved = durable(resolve_labels(df, columns, officials))
    small = local_if_small(resolved, local_rows)
    return resolved if small is None else small


def canonicalise(
    df: DataFrame,
    columns: Sequence[str],
    officials: DataFrame,
    local_rows: int = LOCAL_ROWS,
    resolved: DataFrame | None = None,
) -> DataFrame:
    """Replace each label by its official form; an unresolved label stays as typed.

    If the labels to be changed are proven few, they are looked up as typed and
    broadcast: no row is shuffled and no key computed per row. Otherwise each row
    gets its key and is joined with the reference, which AQE splits on a hot label.
    """
    kept = df.columns
    if resolved is None:
        resolved = resolve_labels(df, columns, officials)
    changed = resolved.filter("official <> label")
    changed = local_if_small(changed.select("colonne", "label", "official"), local_rows)
    for column in columns:
        if changed is not None:
            own, label, key = F.broadcast(changed), "label", F.col(column)
        else:
            own, label, key = officials, "label_key", canonical_key(column)
            key = F.when(F.col(column).isNotNull(), key)
        own = own.filter(F.col("colonne") == column).select(
            F.col(label).alias("__label"), F.col("official").alias("__official")
        )
        if changed is None:
            own = small_or_same(own, local_rows)
        df = (
            df.withColumn("__key", key)
            .join(own, F.expr("__key = __label"), "left")
            .withColumn(column, F.coalesce("__official", column))
            .drop("__key", "__label", "__official")
        )
    return df.select(*kept)


def canonicalisation_stats(
    df: DataFrame, columns: Sequence[str], officials: DataFrame
) -> DataFrame:
    """Per column: distinct labels before and after, and rows left unresolved."""
    return stats_of_labels(resolve_labels(df, columns, officials))


def stats_of_labels(resolved: DataFrame) -> DataFrame:
    """The same from the resolved labels."""
    return resolved.groupBy("colonne").agg(
        F.count("label").alias("modalites_avant"),
        F.count_distinct(F.coalesce("official", "label")).alias("modalites_apres"),
        F.coalesce(F.sum(F.when(F.col("official").isNull(), F.col("n"))), F.lit(0)).alias(
            "non_resolus"
        ),
    )


def label_variants(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: distinct raw labels, distinct keys, and their difference.

    Raw labels do not count the missing one, keys do (as ``''``).
    """
    counts = label_counts(df, columns)
    raw, keys = F.count("label"), F.count_distinct(canonical_key("label"))
    return counts.groupBy("colonne").agg(
        raw.alias("modalites_brutes"),
        keys.alias("modalites_normalisees"),
        (raw - keys).alias("variantes_de_saisie"),
    )


def variant_sample(df: DataFrame, column: str, size: int = 6) -> DataFrame:
    """The first ``size`` labels in order that have outer blanks or are not in title case."""
    label = F.col(column)
    return (
        df.select(label.alias("label"))
        .distinct()
        .filter((F.col("label") != strip_blanks("label")) | (F.col("label") != title_case("label")))
        .orderBy("label")
        .limit(size)
    )


def unknown_values(
    df: DataFrame, column: str, allowed: Sequence[object] | DataFrame, allowed_column: str | None = None
) -> DataFrame:
    """Distinct observed values outside the allowed domain; missing ones are ignored."""
    observed = df.select(F.col(column).alias("valeur")).dropna().distinct()
    if not isinstance(allowed, DataFrame):
        return observed.filter(~F.col("valeur").isin(*allowed))
    domain = allowed.select(F.col(allowed_column or column).alias("allowed")).distinct()
    return observed.join(domain, F.col("valeur") == F.col("allowed"), "left_anti")
