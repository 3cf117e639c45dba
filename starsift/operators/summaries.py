"""Grouped counts, shares, distributions and period comparisons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starsift.functions import patterns as P
from starsift.functions.rounding import round_even
from starsift.operators.clean import flag_columns
from starsift.operators.running import exact_quantiles, present, running_counts


def labels_table(spark: SparkSession, column: str, labels: Sequence[str]) -> DataFrame:
    """A fixed list of labels with its order in `position`."""
    return spark.createDataFrame(
        [(name, i) for i, name in enumerate(labels)], f"{column} string, position int"
    )


def count_by(df: DataFrame, *keys: str, name: str = "reviews") -> DataFrame:
    """Rows per key; rows without a key are left out."""
    kept = df
    for k in keys:
        kept = kept.where(F.col(k).isNotNull())
    return kept.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def in_fixed_order(counts: DataFrame, column: str, labels: Sequence[str]) -> DataFrame:
    """The rows of a summary in label order; a label without rows is present, with nulls."""
    dim = labels_table(counts.sparkSession, column, labels)
    return dim.join(counts, column, "left").orderBy("position").drop("position")


def top_brands(df: DataFrame, n: int = 15) -> DataFrame:
    return (
        count_by(df.where(F.col("brand") != P.NO_BRAND), "brand")
        .orderBy(F.desc("reviews"), "brand")
        .limit(n)
    )


def top_brand_ratings(df: DataFrame, n: int = 15) -> DataFrame:
    """Mean rating of the most reviewed brands, best first."""
    return (
        df.where(F.col("brand") != P.NO_BRAND)
        .groupBy("brand")
        .agg(F.count(F.lit(1)).alias("reviews"), F.avg("rating").alias("avg_rating"))
        .orderBy(F.desc("reviews"), "brand")
        .limit(n)
        .orderBy(F.desc("avg_rating"), "brand")
    )


def value_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How often each value occurs in each of the columns, in one pass."""
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value"))
        for c in columns
    ]
    return (
        df.select(F.inline(F.array(*pairs)))
        .where("value IS NOT NULL")
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins between the smallest and the largest value; the largest is in the last."""
    rows = present(df, value).select(F.col(value).cast("double").alias("_v"))
    span = rows.agg(F.struct(F.min("_v").alias("lo"), F.max("_v").alias("hi"))).scalar()
    lo, hi = F.col("_span.lo"), F.col("_span.hi")
    width = (hi - lo) / bins
    bin_no = F.when(hi == lo, 0).otherwise(
        F.least(F.floor((F.col("_v") - lo) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1))
    )
    return (
        rows.withColumn("_span", span)
        .groupBy(bin_no.cast("int").alias("bin"), lo.alias("_lo"), width.alias("_width"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("bin", (F.col("_lo") + F.col("bin") * F.col("_width")).alias("left_edge"), "n")
    )


def box_summary(df: DataFrame, value: str, group: str) -> DataFrame:
    """Five numbers, row count and 1.5 IQR whiskers per group label."""
    rows = present(df, value, [group]).select(group, F.col(value).cast("double").alias("v"))
    q = exact_quantiles(rows, "v", {"q1": 0.25, "median": 0.5, "q3": 0.75}, [group])
    iqr = F.col("q3") - F.col("q1")
    # one quartile row per group label
    return (
        rows.join(F.broadcast(q), group)
        .groupBy(group, "q1", "median", "q3")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("v").alias("min"),
            F.max("v").alias("max"),
            F.min(F.when(F.col("v") >= F.col("q1") - 1.5 * iqr, F.col("v"))).alias("lower_whisker"),
            F.max(F.when(F.col("v") <= F.col("q3") + 1.5 * iqr, F.col("v"))).alias("upper_whisker"),
        )
    )


def share_within(
    df: DataFrame, outer: str, inner: str, name: str = "share", percent: bool = False
) -> DataFrame:
    """Count of (outer, inner) and its share of the outer label's rows."""
    counts = count_by(df, outer, inner, name="n")
    share = F.col("n") / F.sum("n").over(Window.partitionBy(outer))
    return counts.withColumn(name, round_even(share * 100, 1) if percent else share)


def rating_share_by_tier(df: DataFrame) -> DataFrame:
    """Share of each star rating within a price tier, priced rows only."""
    return share_within(
        df.where(F.col("price").isNotNull()), "price_tier", "rating", name="proportion"
    )


def product_ratings(df: DataFrame) -> DataFrame:
    """Per product the listed average and the number of reviews."""
    return (
        df.where(F.col("parent_asin").isNotNull())
        .groupBy("parent_asin")
        .agg(
            F.avg("average_rating").alias("average_rating"),
            F.count("average_rating").alias("review_count"),
        )
    )


def local_smoother(
    points: DataFrame, x: str, y: str, grid_size: int = 25, share: float = 2 / 3
) -> DataFrame:
    """Local linear smoother with tricube weights on an even grid between the extremes of x.

    Points are first folded by x (weight, sum of y). Only distinct x values
    meet the grid: for review counts there are at most sqrt(2 * reviews).
    """
    folded = (
        present(points, x)
        .where(F.col(y).isNotNull())
        .groupBy(F.col(x).cast("double").alias("x"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("sy"))
    )
    span = folded.agg(
        F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"), F.sum("n").alias("n"))
    ).scalar()
    step = (F.col("_span.hi") - F.col("_span.lo")) / (grid_size - 1)
    spread = (
        folded.withColumn("_span", span)
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(grid_size - 1))).alias("i"))
        .withColumn("g", F.col("_span.lo") + F.col("i") * step)
        .withColumn("d", F.abs(F.col("x") - F.col("g")))
    )
    wanted = F.floor(F.col("_span.n") * F.lit(share) + F.lit(1e-10))
    nearest = Window.partitionBy("i").orderBy("d")
    reach = (
        spread.withColumn(
            "_cum", F.sum("n").over(nearest.rangeBetween(Window.unboundedPreceding, 0))
        )
        .where(F.col("_cum") >= wanted)
        .groupBy("i")
        .agg(F.min("d").alias("h"))
    )
    u = F.col("d") / F.col("h")
    w = F.when(F.col("d") < F.col("h"), F.pow(1 - F.pow(u, F.lit(3.0)), F.lit(3.0))).otherwise(
        F.lit(0.0)
    )
    dx = F.col("x") - F.col("g")
    # one bandwidth row per grid point
    sums = (
        spread.join(F.broadcast(reach.where("h > 0")), "i")
        .select("i", "g", (w * F.col("n")).alias("wn"), (w * F.col("sy")).alias("wy"), dx.alias("dx"))
        .groupBy("i", "g")
        .agg(
            F.sum("wn").alias("s0"),
            F.sum(F.col("wn") * F.col("dx")).alias("s1"),
            F.sum(F.col("wn") * F.col("dx") * F.col("dx")).alias("s2"),
            F.sum("wy").alias("t0"),
            F.sum(F.col("wy") * F.col("dx")).alias("t1"),
        )
    )
    fit = F.try_divide(
        F.col("s2") * F.col("t0") - F.col("s1") * F.col("t1"),
        F.col("s0") * F.col("s2") - F.col("s1") * F.col("s1"),
    )
    return sums.select(F.col("g").alias("x"), fit.alias("fit"))


def monthly_spend(df: DataFrame) -> DataFrame:
    return (
        df.where(F.col("price").isNotNull())
        .groupBy("year", "month")
        .agg((F.sum("price") / 1e6).alias("spending_millions"))
    )


def reviews_by_month(df: DataFrame) -> DataFrame:
    names = F.array(*[F.lit(m) for m in P.MONTHS])
    return count_by(df, "month").withColumn("month_name", F.element_at(names, F.col("month")))


def reviews_by_weekday(df: DataFrame) -> DataFrame:
    return in_fixed_order(count_by(df, "day_of_week"), "day_of_week", P.WEEKDAYS)


def known_period(df: DataFrame) -> DataFrame:
    return df.where(F.col("covid_period") != P.NO_PERIOD)


def volume_by_period(df: DataFrame, periods: Sequence[str] = P.PERIODS) -> DataFrame:
    return in_fixed_order(count_by(known_period(df), "covid_period"), "covid_period", periods)


def rating_by_period(df: DataFrame, periods: Sequence[str] = P.PERIODS) -> DataFrame:
    """Mean, median, std, count and standard error of the rating per period."""
    stats = (
        known_period(df)
        .groupBy("covid_period")
        .agg(
            F.avg("rating").alias("avg_rating"),
            # ratings take a handful of values, so the exact median is a small count map
            F.median("rating").alias("median_rating"),
            F.stddev_samp("rating").alias("std"),
            F.count("rating").alias("n"),
        )
        .withColumn("se", F.try_divide(F.col("std"), F.sqrt("n")))
    )
    return in_fixed_order(stats, "covid_period", periods)


def _period_sums(df: DataFrame, keywords: Mapping[str, str]) -> DataFrame:
    """One row per period: rows and hits of every keyword, in one aggregate."""
    flags = flag_columns(keywords)
    return (
        known_period(df)
        .groupBy("covid_period")
        .agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in flags.values()])
    )


def keyword_hits(df: DataFrame, keywords: Mapping[str, str]) -> DataFrame:
    """(keyword, period, rows, hits) from the flag columns, one pass over the reviews."""
    flags = flag_columns(keywords)
    rows = [
        F.struct(
            F.lit(kw).alias("keyword"),
            F.col("covid_period").alias("period"),
            F.col("n"),
            F.col(c).alias("hits"),
        )
        for kw, c in flags.items()
    ]
    return _period_sums(df, keywords).select(F.inline(F.array(*rows)))


def keyword_rates(df: DataFrame, keywords: Mapping[str, str], places: int = 2) -> DataFrame:
    """Percent of reviews naming each keyword, by period; a period without rows is left out."""
    return keyword_hits(df, keywords).select(
        "keyword", "period", round_even(F.col("hits") / F.col("n") * 100, places).alias("pct")
    )


def _lift(now: Column, before: Column) -> Column:
    return round_even((now - before) / (before + 1e-9) * 100, 1)


def keyword_lift(
    df: DataFrame, keywords: Mapping[str, str], periods: Sequence[str] = P.PERIODS
) -> DataFrame:
    """Relative change of each keyword's rate, second period against the first, smallest first."""
    before, during = periods[0], periods[1]

    def rate(period: str) -> Column:
        hit = F.sum(F.when(F.col("period") == period, F.col("hits")))
        return F.coalesce(
            F.try_divide(hit, F.sum(F.when(F.col("period") == period, F.col("n")))), F.lit(0.0)
        )

    return (
        keyword_hits(df, keywords)
        .groupBy("keyword")
        .agg(_lift(rate(during), rate(before)).alias("lift_pct"))
        .orderBy("lift_pct", "keyword")
    )


def keyword_period_table(
    df: DataFrame, keywords: Mapping[str, str], periods: Sequence[str] = P.PERIODS
) -> DataFrame:
    """Keyword by period rates (3 decimals) and the two lifts taken from the rounded rates."""
    wide = (
        keyword_rates(df, keywords, 3)
        .groupBy("keyword")
        .pivot("period", list(periods))
        .agg(F.max("pct"))
        .withColumnsRenamed(dict(zip(periods, ("pre_rate", "during_rate", "post_rate"))))
    )
    return wide.withColumns(
        {
            "lift_during_vs_pre": _lift(F.col("during_rate"), F.col("pre_rate")),
            "lift_post_vs_pre": _lift(F.col("post_rate"), F.col("pre_rate")),
        }
    )


def mean_by(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(F.avg(value).alias(name))


def binned_ratings(df: DataFrame, min_count: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """Rating statistics per price bin (and label); bins with too few ratings are left out."""
    kept = df.where(F.col("price_mid").isNotNull())
    for b in by:
        kept = kept.where(F.col(b).isNotNull())
    return (
        kept.groupBy(*by, F.col("price_mid").alias("price"))
        .agg(
            F.avg("rating").alias("avg_rating"),
            F.stddev_samp("rating").alias("std"),
            F.count("rating").alias("n"),
            (F.avg((F.col("rating") <= 3).cast("int")) * 100).alias("neg_pct"),
        )
        .where(F.col("n") >= min_count)
        .withColumn("se", F.try_divide(F.col("std"), F.sqrt("n")))
    )


def bin_extremes(binned: DataFrame) -> DataFrame:
    """Covered price range, number of bins, best and worst bin (lowest price among equals)."""
    return binned.agg(
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.count(F.lit(1)).alias("n_bins"),
        F.min_by("price", F.struct(-F.col("avg_rating"), F.col("price"))).alias("best_bin"),
        F.max("avg_rating").alias("best_rating"),
        F.min_by("price", F.struct(F.col("avg_rating"), F.col("price"))).alias("worst_bin"),
        F.min("avg_rating").alias("worst_rating"),
    )


def quartile_summary(df: DataFrame, group: str = "price_quartile") -> DataFrame:
    """Median and mean rating (3 decimals), percent negative (1 decimal) and count per label."""
    return (
        df.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(
            F.median("rating").alias("median_rating"),
            round_even(F.avg("rating"), 3).alias("mean_rating"),
            round_even(
                round_even(F.avg((F.col("rating") <= 3).cast("int")), 3) * 100, 1
            ).alias("pct_negative"),
            F.count("rating").alias("n"),
        )
    )


def group_summary(df: DataFrame, group: str = "group") -> DataFrame:
    """Rows, mean and median rating and percent of five stars per label."""
    return (
        df.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("n_reviews"),
            round_even(F.avg("rating"), 3).alias("mean_rating"),
            F.median("rating").alias("median_rating"),
            round_even(F.avg("is_5_star") * 100, 3).alias("pct_5_star"),
        )
    )


def votes_by_rating(df: DataFrame) -> DataFrame:
    """Mean helpful votes per rating over reviews with at least one vote."""
    return (
        df.where(F.col("helpful_vote") > 0)
        .where(F.col("rating").isNotNull())
        .groupBy("rating")
        .agg(F.avg("helpful_vote").alias("mean_helpful"))
    )


def votes_by_length(df: DataFrame, bucket: str = "length_bucket") -> DataFrame:
    """Mean helpful votes and percent of reviews with a vote per length bucket."""
    voted = F.coalesce(F.col("helpful_vote") > 0, F.lit(False)).cast("int")
    return (
        df.where(F.col(bucket).isNotNull())
        .groupBy(bucket)
        .agg(
            F.avg("helpful_vote").alias("mean_helpful"), (F.avg(voted) * 100).alias("pct_voted")
        )
    )


def medians_by(df: DataFrame, group: str, values: Sequence[str]) -> DataFrame:
    """Exact medians of several columns per label."""
    out = None
    for v in values:
        m = exact_quantiles(df, v, {f"median_{v}": 0.5}, [group])
        out = m if out is None else out.join(m, group)
    return out


def product_level(df: DataFrame) -> DataFrame:
    """Per product the mean rating, review count, mean sentiment and log count."""
    return (
        df.where(F.col("parent_asin").isNotNull())
        .groupBy("parent_asin")
        .agg(
            F.avg("rating").alias("avg_rating"),
            F.count("rating").alias("review_count"),
            F.avg("vader_sentiment").alias("avg_sentiment"),
        )
        .withColumn("log_review_count", F.log1p("review_count"))
    )


def linear_trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line of y on x."""
    slope = F.regr_slope(F.col(y), F.col(x))
    return df.agg(
        slope.alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
        F.min(x).alias("x_min"),
        F.max(x).alias("x_max"),
    )


def ecdf(df: DataFrame, value: str, group: str) -> DataFrame:
    """Share of a label's rows at or below each distinct value."""
    ranked = running_counts(df, value, {"n": F.count(F.lit(1))}, [group])
    return ranked.select(
        group,
        F.col("value").alias(value),
        "n",
        ((F.col("n_before") + F.col("n")) / F.col("n_total")).alias("ecdf"),
    )


def group_total_beside_rows(
    df: DataFrame, group: str, value: str, name: str, few_groups: bool = True
) -> DataFrame:
    """A group's total on each of its rows, by a join with the totals.

    A window would gather a whole group in one task. The totals are one row per
    label after map-side sums: they are broadcast for a label column, and joined
    like any table for a key with many values.
    """
    totals = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.sum(value).alias(name))
    return df.join(F.broadcast(totals) if few_groups else totals, group)
