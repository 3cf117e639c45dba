"""Column profiles, describe, dataset card and correlation matrix: one pass each."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starsift.functions.rounding import round_even
from starsift.operators.running import exact_quantiles


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def column_profile(df: DataFrame) -> DataFrame:
    """Type, non-null count and percent of nulls of every column."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(f.name)).alias(f"_c{i}") for i, f in enumerate(df.schema.fields)],
    )
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.col(f"_c{i}").alias("non_null"),
            round_even((1 - F.try_divide(F.col(f"_c{i}"), F.col("_rows"))) * 100, 2).alias("null_pct"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _long_form(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in columns
    ]
    return df.select(F.inline(F.array(*pairs)))


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, std, min, exact quartiles and max of every numeric column."""
    long = _long_form(df, columns or numeric_columns(df)).where(
        F.col("v").isNotNull() & ~F.isnan("v")
    )
    base = long.groupBy("column_name").agg(
        F.count("v").alias("count"),
        F.avg("v").alias("mean"),
        F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
    )
    quartiles = exact_quantiles(
        long, "v", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, ["column_name"]
    )
    return base.join(quartiles, "column_name").select(
        "column_name",
        "count",
        *[round_even(F.col(c), 2).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")],
    )


def dataset_card(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("brand").alias("n_brands"),
        F.count_distinct("parent_asin").alias("n_products"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
    )


def null_safe_corr(a: Column, b: Column) -> Column:
    """Pearson correlation over rows where both are known; none for a constant column."""
    both = a.isNotNull() & b.isNotNull()
    x = F.when(both, a.cast("double"))
    y = F.when(both, b.cast("double"))
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair of numeric columns, 2 decimals, in one pass.

    A row gives one (pair, x, y) entry per pair of known values; the entries are
    summed inside each task, so a task sends one row per pair.
    """
    names = list(columns or numeric_columns(df))
    pairs = list(combinations_with_replacement(names, 2))
    entries = [
        F.struct(
            F.lit(i).alias("pair"),
            F.col(a).cast("double").alias("x"),
            F.col(b).cast("double").alias("y"),
        )
        for i, (a, b) in enumerate(pairs)
    ]
    sums = (
        df.select(F.inline(F.array(*entries)))
        .where("x IS NOT NULL AND y IS NOT NULL")
        .groupBy("pair")
        .agg(
            F.try_divide(
                F.covar_samp("x", "y"), F.stddev_samp("x") * F.stddev_samp("y")
            ).alias("r")
        )
    )
    cells = [
        F.struct(F.lit(x).alias("column_a"), F.lit(y).alias("column_b"), F.lit(i).alias("pair"))
        for i, (a, b) in enumerate(pairs)
        for x, y in dict.fromkeys(((a, b), (b, a)))
    ]
    grid = df.sparkSession.range(1).select(F.inline(F.array(*cells)))
    return grid.join(sums, "pair", "left").select(
        "column_a", "column_b", round_even(F.col("r"), 2).alias("r")
    )
