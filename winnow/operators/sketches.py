"""Distinct counts from sketches that are kept per partition and merged for any subset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A sketch has 2 ** LG_CELLS cells; its relative standard error is 1.04 / sqrt(cells) at most.
LG_CELLS = 12


def relative_error(lg_cells: int = LG_CELLS, deviations: float = 3.0) -> float:
    """Error that an estimate exceeds in about 1 of 400 cases for three standard deviations."""
    return deviations * 1.04 / 2 ** (lg_cells / 2)


def distinct_sketches(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], lg_cells: int = LG_CELLS
) -> DataFrame:
    """``(keys..., colonne, sketch)``: one scan, and only sketches are shuffled.

    Missing values do not count. Values are compared as text, zeros without their sign.
    """
    floating = {c for c, t in df.dtypes if t in ("double", "float")}

    def text(c: str) -> Column:
        value = F.nanvl(F.col(c) + 0.0, F.lit(None)) if c in floating else F.col(c)
        return value.cast("string")

    sketches = [F.hll_sketch_agg(text(c), lg_cells).alias(f"__{i}") for i, c in enumerate(columns)]
    entries = [
        F.struct(F.lit(c).alias("colonne"), F.col(f"__{i}").alias("sketch"))
        for i, c in enumerate(columns)
    ]
    return df.groupBy(*keys).agg(*sketches).select(*keys, F.inline(F.array(*entries)))


def merged_distincts(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys..., colonne, distincts)``: estimates of the sketches merged by the given keys."""
    union = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return sketches.groupBy(*keys, "colonne").agg(union.alias("distincts"))
