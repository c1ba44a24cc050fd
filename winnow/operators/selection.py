"""Exact quantiles by bracketed selection: two scans, and almost no row is shuffled.

The first scan makes a mergeable quantile sketch of each group. Its values around a wanted rank
form a bracket. The second scan counts, before its exchange, the rows between two brackets as
one entry and the values inside a bracket each; only those travel. The counts certify that a
wanted rank lies inside its bracket, so the result does not depend on the promise of the sketch:
a group whose bracket misses is done again with wider brackets, at last with all of its values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.operators.bounded import LOCAL_ROWS, durable, local_if_small

VALUE, COUNT = "value", "n"
# Entries of a sketch; a sketched value is off by at most one part in so many of the rows.
ACCURACY = 2000
# Groups of at most so many rows keep all their values.
WHOLE_ROWS = 1000
LOW, HIGH = "__low_{}", "__high_{}"
SIZE = "__size"


def _margin(accuracy: int) -> float:
    return 2 / accuracy


def summary(
    present: DataFrame,
    keys: Sequence[str],
    quantiles: Mapping[str, float],
    accuracy: int = ACCURACY,
    margin: float | None = None,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """One row per group: its size, estimated distinct values, and a bracket per quantile.

    ``extra`` are further aggregates of the same scan.
    """
    margin = _margin(accuracy) if margin is None else margin
    points = [min(max(p + d, 0.0), 1.0) for p in quantiles.values() for d in (-margin, margin)]
    sketch = F.percentile_approx(VALUE, F.array(*[F.lit(p) for p in points]), accuracy)
    found = present.groupBy(*keys).agg(
        F.count("*").alias(SIZE),
        F.approx_count_distinct(VALUE).alias("__distinct"),
        sketch.alias("__points"),
        *extra,
    )
    # A rank between two rows, and a small group, need neighbours that no sketch resolves.
    all_values = (F.col(SIZE) <= WHOLE_ROWS) | F.lit(margin >= 1)
    columns = {}
    for i in range(len(quantiles)):
        low, high = F.col("__points")[2 * i], F.col("__points")[2 * i + 1]
        columns[LOW.format(i)] = F.when(all_values, float("-inf")).otherwise(low)
        columns[HIGH.format(i)] = F.when(all_values, float("inf")).otherwise(high)
    return found.withColumns(columns).drop("__points")


def bracketed_counts(
    present: DataFrame, keys: Sequence[str], brackets: DataFrame, quantiles: int
) -> DataFrame:
    """``(keys..., value, gap, n)``, durable: values inside a bracket, and rows between brackets.

    Rows outside of all brackets are counted under the end of the bracket below them, in an
    entry with ``gap``, so that sorting by (value, gap) sorts all rows of the group.
    """
    inside = reduce(
        lambda a, b: a | b,
        [F.col(VALUE).between(F.col(LOW.format(i)), F.col(HIGH.format(i))) for i in range(quantiles)],
    )
    ends = [F.when(F.col(HIGH.format(i)) < F.col(VALUE), F.col(HIGH.format(i))) for i in range(quantiles)]
    below = F.coalesce(F.greatest(F.lit(float("-inf")), *ends), F.lit(float("-inf")))
    matched = F.expr(" AND ".join(["true", *[f"`{k}` <=> `__k_{i}`" for i, k in enumerate(keys)]]))
    named = [F.col(k).alias(f"__k_{i}") for i, k in enumerate(keys)]
    bounds = [f.format(i) for i in range(quantiles) for f in (LOW, HIGH)]
    placed = present.join(brackets.select(*named, *bounds), matched)
    counted = placed.select(
        *keys, F.when(inside, F.col(VALUE)).otherwise(below).alias(VALUE), (~inside).alias("gap")
    )
    return durable(counted.groupBy(*keys, VALUE, "gap").agg(F.count("*").alias(COUNT)))


def uncertified(
    counts: DataFrame, keys: Sequence[str], brackets: DataFrame, quantiles: Mapping[str, float]
) -> DataFrame:
    """The groups in which a wanted rank lies outside of its bracket."""
    named = [F.col(k).alias(f"__k_{i}") for i, k in enumerate(keys)]
    matched = F.expr(" AND ".join(["true", *[f"`{k}` <=> `__k_{i}`" for i, k in enumerate(keys)]]))
    joined = counts.join(brackets.drop("__distinct").select("*", *named).drop(*keys), matched)
    fine = F.lit(True)
    sums = []
    for i, p in enumerate(quantiles.values()):
        low, high = F.col(LOW.format(i)), F.col(HIGH.format(i))
        before = (F.col(VALUE) < low) | (F.col("gap") & (F.col(VALUE) <= low))
        upto = (F.col(VALUE) < high) | (~F.col("gap") & (F.col(VALUE) == high))
        sums.append(F.sum(F.when(before, F.col(COUNT)).otherwise(0)).alias(f"before_{i}"))
        sums.append(F.sum(F.when(upto, F.col(COUNT)).otherwise(0)).alias(f"upto_{i}"))
        rank = F.lit(p) * (F.col(SIZE) - 1)
        fine = fine & (F.col(f"before_{i}") <= F.floor(rank)) & (F.ceil(rank) < F.col(f"upto_{i}"))
    checked = joined.groupBy(*keys, SIZE).agg(*sums)
    return checked.filter(~fine).select(*keys, F.lit(True).alias("__failed"))


def certified_counts(
    present: DataFrame,
    keys: Sequence[str],
    brackets: DataFrame,
    quantiles: Mapping[str, float],
    accuracy: int = ACCURACY,
    local_rows: int = LOCAL_ROWS,
) -> DataFrame:
    """Counts that hold every wanted rank of every group inside a bracket, proven by the counts."""
    margin = _margin(accuracy)
    counts = None
    while True:
        small = local_if_small(brackets, local_rows)
        brackets = durable(brackets) if small is None else F.broadcast(small)
        found = bracketed_counts(present, keys, brackets, len(quantiles))
        failed = durable(uncertified(found, keys, brackets, quantiles))
        if failed.isEmpty():
            return found if counts is None else counts.unionByName(found)
        same = [F.col(k).eqNullSafe(F.col(f"__f_{i}")) for i, k in enumerate(keys)]
        named = failed.select("__failed", *[F.col(k).alias(f"__f_{i}") for i, k in enumerate(keys)])
        matched = reduce(lambda a, b: a & b, same, F.lit(True))
        good = found.join(named, matched, "left_anti")
        counts = good if counts is None else counts.unionByName(good)
        present = present.join(named, matched, "left_semi")
        margin *= 8
        brackets = summary(present, keys, quantiles, accuracy, margin)
