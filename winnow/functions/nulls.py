"""Two-valued logic over missing values, so that no flag column is ever NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from winnow.functions.rounding import round_half_even


def flag(condition: Column) -> Column:
    """The condition, with an unknown outcome counted as False."""
    return F.coalesce(condition, F.lit(False))


def differs(left: Column, right: Column) -> Column:
    """True unless both sides are present and equal (both missing is a difference)."""
    return F.coalesce(left != right, F.lit(True))


def share_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part / whole`` in percent; NULL for an empty ``whole``."""
    return round_half_even(F.try_divide(part.cast("double"), whole.cast("double")) * 100, digits)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating column.

    Spark orders NaN above every number, so ``NaN > 8`` is true: missing
    measures have to be NULL before any comparison.
    """
    floating = {f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))}
    if not floating:
        return df
    named = {c: F.col("`" + c.replace("`", "``") + "`") for c in df.columns}
    return df.select(
        *[
            F.nanvl(named[c], F.lit(None).cast(df.schema[c].dataType)).alias(c)
            if c in floating
            else named[c]
            for c in df.columns
        ]
    )
