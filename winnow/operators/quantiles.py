"""Exact quantiles of whole tables or groups, and their use as row attributes.

Rows are reduced to (group, value, count) with a map-side combine, so a hot group or
value costs one row per task. If the values are few the quantiles come from them
directly. If they are many, only those near the wanted ranks are counted
(:mod:`winnow.operators.selection`). Should even these be many, they are sorted over
range partitions and each wanted rank is looked up in the one partition that holds
it; no task ever sees a whole group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnow.operators.bounded import LOCAL_ROWS, durable, local_if_small, small_or_same
from winnow.operators.selection import COUNT, VALUE, certified_counts, summary

MEDIAN = {"median": 0.5}
PART_ROWS = 1_000_000


@dataclass(frozen=True)
class Measure:
    """A numeric SQL expression to be counted by value, within groups if ``keys`` are given."""

    name: str
    value: str
    keys: tuple[str, ...] = ()


def measure_counts(df: DataFrame, measures: Sequence[Measure]) -> DataFrame:
    """Rows per measure, group and value, for several measures in one scan.

    The columns are ``mesure``, every key used by any measure (NULL where a measure
    does not use it), ``value`` and ``n``. Missing values are counted under NULL.
    """
    keys = sorted({k for m in measures for k in m.keys})
    stacked = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(m.name).alias("mesure"),
                    *[
                        (F.col(k) if k in m.keys else F.lit(None).cast(df.schema[k].dataType)).alias(k)
                        for k in keys
                    ],
                    F.nanvl(F.expr(m.value).cast("double"), F.lit(None)).alias(VALUE),
                )
                for m in measures
            ]
        )
    )
    return df.select(stacked).groupBy("mesure", *keys, VALUE).agg(F.count("*").alias(COUNT))


def value_counts(df: DataFrame, keys: Sequence[str], value: Column | str) -> DataFrame:
    """Rows per group and value as ``(keys..., value, n)``.

    Missing values do not count, and rows with a missing key belong to no group.
    """
    column = F.col(value) if isinstance(value, str) else value
    present = df.select(*keys, column.cast("double").alias(VALUE)).dropna()
    return present.groupBy(*keys, VALUE).agg(F.count("*").alias(COUNT))


def quantiles_of_counts(
    counts: DataFrame, keys: Sequence[str], quantiles: Mapping[str, float] = MEDIAN
) -> DataFrame:
    """One row per group of a local ``(keys..., value, n)`` table, linear interpolation."""
    grouped = counts.coalesce(1).groupBy(*keys)
    return F.broadcast(
        grouped.agg(
            *[F.percentile(VALUE, p, F.col(COUNT)).alias(name) for name, p in quantiles.items()]
        )
    )


def ranked_quantiles(
    counts: DataFrame, keys: Sequence[str], quantiles: Mapping[str, float] = MEDIAN
) -> DataFrame:
    """The same result for a durable ``(keys..., value, n)`` table of any size."""
    keys = list(keys)
    # Range boundaries come from a sample, so the split is made durable before it
    # is read more than once. A task sorts about PART_ROWS counted values.
    usual = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(usual, -(-counts.count() // PART_ROWS))
    parts = durable(
        counts.repartitionByRange(ranges, *keys, VALUE).withColumn("part", F.spark_partition_id())
    )
    whole = Window.partitionBy(*keys)
    # Only a group that is cut by a boundary lies in several parts: at most two rows per part.
    cut = small_or_same(
        parts.groupBy(*keys, "part")
        .agg(F.sum(COUNT).alias("held"))
        .withColumn("start", F.sum("held").over(whole.orderBy("part")) - F.col("held"))
        .withColumn("size", F.sum("held").over(whole))
        .filter("held < size")
        .select(*keys, "part", "start", "size")
    )
    own = Window.partitionBy(*keys, "part")
    upto = F.sum(COUNT).over(own.orderBy(VALUE).rowsBetween(Window.unboundedPreceding, 0))
    placed = (
        parts.dropna(subset=[*keys, VALUE])
        .repartition(ranges, *keys, "part")
        .select("*", upto.alias("upto"), F.sum(COUNT).over(own).alias("held"))
        .join(cut, [*keys, "part"], "left")
    )
    after = F.col("upto") + F.coalesce("start", F.lit(0))

    def holds(rank: Column) -> Column:
        return (rank >= after - F.col(COUNT)) & (rank < after)

    # The wanted zero-based rank p * (size - 1) lies between two whole ranks.
    size = F.coalesce("size", "held")
    ranks = {name: F.lit(p) * (size - 1) for name, p in quantiles.items()}
    either = [holds(f(rank)) for rank in ranks.values() for f in (F.floor, F.ceil)]
    found = placed.filter(reduce(lambda a, b: a | b, either))

    def pick(name: str, rank: Column) -> Column:
        low = F.min(F.when(holds(F.floor(rank)), F.col(VALUE)))
        high = F.max(F.when(holds(F.ceil(rank)), F.col(VALUE)))
        part = F.max(rank - F.floor(rank))
        return (low * (1 - part) + high * part).alias(name)

    return found.groupBy(*keys).agg(*[pick(name, rank) for name, rank in ranks.items()])


def group_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: Column | str,
    quantiles: Mapping[str, float] = MEDIAN,
    local_rows: int = LOCAL_ROWS,
) -> DataFrame:
    """Exact quantiles of ``value`` per group, equal to linear interpolation in pandas.

    A first scan sketches every group. Where the values are few they are counted whole,
    otherwise only those around the wanted ranks.
    """
    column = F.col(value) if isinstance(value, str) else value
    present = df.select(*keys, column.cast("double").alias(VALUE)).dropna()
    brackets = durable(summary(present, keys, quantiles))
    return quantiles_of_summary(present, keys, quantiles, brackets, local_rows)


def quantiles_of_summary(
    present: DataFrame,
    keys: Sequence[str],
    quantiles: Mapping[str, float],
    brackets: DataFrame,
    local_rows: int = LOCAL_ROWS,
) -> DataFrame:
    """The quantiles after the first scan, whose :func:`summary` is durable."""
    distinct = brackets.agg(F.sum("__distinct").alias("d")).head()["d"] or 0
    if distinct <= local_rows // 2:
        small = local_if_small(value_counts(present, keys, VALUE), local_rows)
        if small is not None:
            return quantiles_of_counts(small, keys, quantiles)
    counts = certified_counts(present, keys, brackets, quantiles, local_rows=local_rows)
    # Rows of a gap follow the bracket below them, so they may stand for its last value.
    counts = counts.drop("gap")
    small = local_if_small(counts, local_rows)
    if small is not None:
        return quantiles_of_counts(small, keys, quantiles)
    return small_or_same(ranked_quantiles(durable(counts), keys, quantiles), local_rows)


def medians_by_key(df: DataFrame, key: str, names: Mapping[str, str]) -> DataFrame:
    """Exact medians of several columns (output name: column) per key, for very many keys.

    All columns are counted by value in one scan; a hot key is spread over range partitions.
    """
    places = {name: str(i) for i, name in enumerate(names)}
    measures = [Measure(places[name], column, (key,)) for name, column in names.items()]
    counts = durable(measure_counts(df, measures).dropna(subset=[key, VALUE]))
    found = ranked_quantiles(counts, ["mesure", key])
    return found.groupBy(key).agg(
        *[F.max(F.when(F.col("mesure") == i, F.col("median"))).alias(n) for n, i in places.items()]
    )


def approx_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: Column | str,
    quantiles: Mapping[str, float] = MEDIAN,
    accuracy: int = 10_000,
) -> DataFrame:
    """Sketch-based quantiles in one pass, for callers that accept a rank error."""
    column = F.col(value) if isinstance(value, str) else value
    return (
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(*[F.percentile_approx(column, p, accuracy).alias(n) for n, p in quantiles.items()])
    )


def attach_statistic(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add a group statistic to every row; a row with a missing key gets NULL.

    A statistic proven small is broadcast, so the rows are not shuffled to as many
    tasks as there are groups. Otherwise this is an ordinary join, which AQE splits
    where a group is skewed.
    """
    return df.join(stats, list(keys), "left").select(
        *df.columns, *[c for c in stats.columns if c not in keys]
    )
