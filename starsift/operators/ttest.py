"""Per-product t-tests of review ratings against the listed average."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsift.functions.rounding import round_even
from starsift.functions.tails import t_two_sided_p
from starsift.operators.running import exact_quantiles

MIN_REVIEWS = 30
ALPHA = 0.05


def first_value(value: str, order: Column) -> Column:
    """First known value of a column in the given order."""
    return F.min_by(value, F.when(F.col(value).isNotNull(), order))


def product_moments(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Per product: brand, rating moments, and the listing taken from its first row.

    One aggregate serves both the rating statistics and the listing, so the
    reviews are shuffled once, as partial sums.
    """
    key = F.struct(*order)
    listing = F.min_by(F.struct("average_rating", "rating_number"), key)
    return (
        df.where(F.col("parent_asin").isNotNull())
        .groupBy("parent_asin")
        .agg(
            first_value("brand", key).alias("brand"),
            F.avg("rating").alias("dataset_avg_rating"),
            F.stddev_samp("rating").alias("dataset_rating_std"),
            F.count("rating").alias("dataset_reviews"),
            listing.alias("_listing"),
        )
        .select("*", "_listing.average_rating", "_listing.rating_number")
        .drop("_listing")
    )


def t_statistic(mean: Column, mu: Column, std: Column, n: Column) -> Column:
    """One-sample t; without spread it is infinite, or undefined at no difference."""
    gap = mean - mu
    flat = F.when(gap != 0, F.signum(gap) * F.lit(float("inf")))
    return F.when(std == 0, flat).otherwise(F.try_divide(gap, std / F.sqrt(n)))


def product_t_tests(
    df: DataFrame, order: Sequence[str], min_reviews: int = MIN_REVIEWS, alpha: float = ALPHA
) -> DataFrame:
    """Verdict per product with enough reviews that are not all of its listed ratings."""
    tested = (
        product_moments(df, order)
        .where(
            (F.col("dataset_reviews") >= min_reviews)
            & (F.col("rating_number") > F.col("dataset_reviews"))
        )
        .withColumn("gap", F.col("dataset_avg_rating") - F.col("average_rating"))
        .withColumn(
            "t_stat",
            t_statistic(
                F.col("dataset_avg_rating"),
                F.col("average_rating"),
                F.col("dataset_rating_std"),
                F.col("dataset_reviews"),
            ),
        )
        .withColumn("p_value", t_two_sided_p("t_stat", F.col("dataset_reviews") - 1))
    )
    differs = F.col("p_value") < alpha

    def flag(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    return tested.select(
        "parent_asin", "brand", "dataset_reviews", "dataset_avg_rating", "average_rating",
        "rating_number", "gap", "t_stat", "p_value",
        flag(differs & (F.col("t_stat") < 0)).alias("is_harsher"),
        flag(differs & (F.col("t_stat") > 0)).alias("is_lenient"),
        flag(F.col("p_value") >= alpha).alias("no_diff"),
    )


def smallest_p(results: DataFrame, n: int = 10) -> DataFrame:
    return results.where("p_value IS NOT NULL").orderBy("p_value", "parent_asin").limit(n)


def verdict_summary(results: DataFrame) -> DataFrame:
    """Totals, percentages, mean gap and exact medians over the per-product results."""
    medians = exact_quantiles(results, "t_stat", {"m": 0.5}).select("m").scalar()
    median_p = exact_quantiles(results, "p_value", {"m": 0.5}).select("m").scalar()

    def total(flag: str) -> Column:
        return F.sum(F.col(flag).cast("int"))

    def percent(flag: str) -> Column:
        return round_even(F.avg(F.col(flag).cast("int")) * 100, 1)

    return results.agg(
        F.count(F.lit(1)).alias("total_products"),
        total("is_harsher").alias("harsher_products"),
        total("is_lenient").alias("lenient_products"),
        total("no_diff").alias("nodiff_products"),
        percent("is_harsher").alias("harsher_pct"),
        percent("is_lenient").alias("lenient_pct"),
        round_even(F.avg("gap"), 3).alias("avg_gap"),
    ).select(
        "*",
        round_even(medians, 3).alias("median_t_stat"),
        round_even(median_p, 4).alias("median_p_value"),
    )


def verdict(results: DataFrame) -> DataFrame:
    """Label of each tested product: harsher, lenient or neutral."""
    return results.withColumn(
        "verdict",
        F.when(F.col("is_harsher"), "harsher").when(F.col("is_lenient"), "lenient").when(F.col("no_diff"), "neutral"),
    ).where("verdict IS NOT NULL")


def gap_density(
    results: DataFrame, grid_size: int = 300, margin: float = 0.3, min_products: int = 5
) -> DataFrame:
    """Gaussian kernel density of the gap per verdict, Scott bandwidth, on an even grid.

    Equal gaps are folded first; grid sums are combined inside each task, so
    the shuffle carries at most grid_size rows per verdict and task.
    """
    labelled = verdict(results)
    shape = (
        labelled.groupBy("verdict")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("gap").alias("lo"),
            F.max("gap").alias("hi"),
            F.stddev_samp("gap").alias("std"),
        )
        .where(F.col("n") >= min_products)
        .select(
            "verdict",
            "n",
            (F.col("lo") - margin).alias("lo"),
            ((F.col("hi") - F.col("lo") + 2 * margin) / (grid_size - 1)).alias("step"),
            (F.col("std") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).alias("bw"),
        )
        .where(F.col("bw") > 0)
    )
    folded = labelled.groupBy("verdict", "gap").agg(F.count(F.lit(1)).alias("w"))
    # three verdicts at most
    spread = folded.join(F.broadcast(shape), "verdict").select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(grid_size - 1))).alias("i")
    )
    x = F.col("lo") + F.col("i") * F.col("step")
    u = (x - F.col("gap")) / F.col("bw")
    return (
        spread.select("verdict", "i", "n", "bw", x.alias("x"), (F.col("w") * F.exp(-0.5 * u * u)).alias("k"))
        .groupBy("verdict", "i", "x", "n", "bw")
        .agg(F.sum("k").alias("k"))
        .select(
            "verdict",
            "x",
            (F.col("k") / (F.col("n") * F.col("bw") * F.sqrt(F.lit(2.0) * F.pi()))).alias("density"),
        )
    )
