"""Contingency tables, chi-square tests and residuals."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starsift.functions.rounding import round_even
from starsift.functions.tails import chi_square_p
from starsift.operators.summaries import count_by, keyword_hits


def contingency(df: DataFrame, row: str, col: str) -> DataFrame:
    """Long table (row, col, n, row_total, col_total, total), with empty cells as 0.

    Only counts per cell leave the reviews; every later step works on labels.
    """
    seen = count_by(df, row, col, name="n")
    columns = seen.groupBy(col).agg(F.sum("n").alias("col_total"))
    labels = columns.agg(F.array_sort(F.collect_list(F.struct(col, "col_total")))).scalar()
    total = seen.agg(F.sum("n")).scalar()
    per_row = seen.groupBy(row).agg(
        F.map_from_entries(F.collect_list(F.struct(col, "n"))).alias("_cells"), F.sum("n").alias("row_total")
    )
    cells = per_row.select(row, "_cells", "row_total", F.explode(labels).alias("_label"))
    return cells.select(
        row,
        F.col("_label").getField(col).alias(col),
        F.coalesce(F.element_at("_cells", F.col("_label").getField(col)), F.lit(0)).alias("n"),
        "row_total",
        F.col("_label.col_total").alias("col_total"),
        total.alias("total"),
    )


def row_percent(cells: DataFrame) -> DataFrame:
    return cells.withColumn("row_pct", round_even(F.col("n") / F.col("row_total") * 100, 2))


def expected_count() -> Column:
    return F.col("row_total") * F.col("col_total").cast("double") / F.col("total")


def residuals(cells: DataFrame) -> DataFrame:
    """Expected counts, standardised and adjusted residuals per cell."""
    e = expected_count()
    gap = F.col("n") - e
    adjusted = F.sqrt(
        e
        * (1 - F.col("row_total") / F.col("total"))
        * (1 - F.col("col_total") / F.col("total"))
    )
    return cells.withColumns(
        {
            "expected": e,
            "std_resid": F.try_divide(gap, F.sqrt(e)),
            "adj_resid": F.try_divide(gap, adjusted),
        }
    )


def _chi_square_terms(n: Column, e: Column, yates: Column) -> Column:
    gap = n - e
    corrected = F.when(yates, gap - F.signum(gap) * F.least(F.lit(0.5), F.abs(gap))).otherwise(gap)
    return F.try_divide(corrected * corrected, e)


def _finish(stats: DataFrame, alpha: float) -> DataFrame:
    effect = F.sqrt(
        F.try_divide(F.col("chi2"), F.col("n") * F.least(F.col("rows") - 1, F.col("cols") - 1))
    )
    return (
        stats.withColumn("dof", ((F.col("rows") - 1) * (F.col("cols") - 1)).cast("int"))
        .withColumn("cramers_v", effect)
        .withColumn("p_value", chi_square_p("chi2", "dof"))
        .withColumn(
            "conclusion",
            F.when(F.col("p_value") < alpha, "Reject H0").otherwise("Fail to reject H0"),
        )
        .drop("rows", "cols")
    )


def chi_square(cells: DataFrame, row: str, col: str, alpha: float = 0.05) -> DataFrame:
    """Test of independence on a contingency table; Yates' correction for a 2 x 2 table."""
    plain, corrected = (
        F.sum(_chi_square_terms(F.col("n"), expected_count(), F.lit(yates))) for yates in (False, True)
    )
    counted = cells.agg(plain.alias("_plain"), corrected.alias("_corrected"), F.sum("n").alias("n"))
    sizes = cells.agg(F.count_distinct(row).alias("rows"), F.count_distinct(col).alias("cols"))
    stats = counted.withColumns({"rows": sizes.select("rows").scalar(), "cols": sizes.select("cols").scalar()})
    two_by_two = (F.col("rows") - 1) * (F.col("cols") - 1) == 1
    stats = stats.select(
        F.when(two_by_two, F.col("_corrected")).otherwise(F.col("_plain")).alias("chi2"), "n", "rows", "cols"
    )
    return _finish(stats, alpha)


def keyword_chi_square(df: DataFrame, keywords: Mapping[str, str], alpha: float = 0.001) -> DataFrame:
    """Per keyword: are mentions independent of the period? One pass over the flags."""
    hits = keyword_hits(df, keywords)
    w = Window.partitionBy("keyword")
    sized = hits.withColumns(
        {
            "_all": F.sum("n").over(w),
            "_hit": F.sum("hits").over(w),
            "_periods": F.count(F.lit(1)).over(w),
        }
    )
    expected_hit = F.col("n") * F.col("_hit").cast("double") / F.col("_all")
    expected_miss = F.col("n") - expected_hit
    yates = F.col("_periods") == 2
    stats = sized.groupBy("keyword").agg(
        F.sum(
            _chi_square_terms(F.col("hits"), expected_hit, yates)
            + _chi_square_terms(F.col("n") - F.col("hits"), expected_miss, yates)
        ).alias("chi2"),
        F.sum("n").alias("n"),
        F.max("_periods").alias("rows"),
        F.lit(2).alias("cols"),
    )
    return _finish(stats, alpha).withColumn(
        "significant", F.coalesce(F.col("p_value") < alpha, F.lit(False))
    ).drop("conclusion")
