"""Derived review columns: dates, tiers, periods, categories, brands, flags and bins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsift.functions import patterns as P
from starsift.operators.running import with_quantiles


def from_epoch_ms(ms: Column) -> Column:
    """Epoch milliseconds as a zone-less UTC time."""
    seconds = ms.cast("decimal(20,0)") / F.lit(1000).cast("decimal(4,0)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)")
    )


def whole_word(pattern: str) -> str:
    """Case-blind form of a pattern in which word edges and spaces follow Unicode."""
    return "(?iU)" + pattern


def exclude_value(df: DataFrame, column: str, value: str) -> DataFrame:
    """Drop rows equal to `value`; rows with no value stay."""
    return df.where(~F.col(column).eqNullSafe(F.lit(value)))


def with_date_parts(df: DataFrame, date: str = "date") -> DataFrame:
    return df.withColumns(
        {
            "year": F.year(date),
            "month": F.month(date),
            "date_of_month": F.dayofmonth(date),
            "day_of_week": F.date_format(date, "EEEE"),
        }
    )


def basic_clean(df: DataFrame, excluded: str = P.EXCLUDED_MAIN_CATEGORY) -> DataFrame:
    """Time of the review, its date parts, text length and the missing-price flag."""
    out = df
    if "timestamp" in df.columns:
        out = out.withColumn("date", from_epoch_ms(F.col("timestamp")))
    out = exclude_value(out.drop(*P.UNUSED_REVIEW_COLUMNS), "main_category", excluded)
    out = with_date_parts(out)
    if "review_text" in out.columns:
        out = out.withColumn("review_length", F.length("review_text"))
    return out.withColumn("price_missing", F.col("price").isNull().cast("int"))


def with_price_tier(
    df: DataFrame, price: str = "price", quantiles: Mapping[str, float] = P.TIER_QUANTILES
) -> DataFrame:
    """Tier by the quantiles of the known prices; no price or a zero price is `Unknown`."""
    q50, q75, q975 = quantiles
    p, cut = F.col(price), F.col("_q")
    low, medium, high, premium = P.TIERS
    tier = (
        F.when(p.isNull() | F.isnan(p) | (p == 0), P.NO_TIER)
        .when(p >= cut[q975], premium)
        .when(p > cut[q75], high)
        .when(p > cut[q50], medium)
        .otherwise(low)
    )
    return with_quantiles(df, price, quantiles).withColumn("price_tier", tier).drop("_q")


def with_period(
    df: DataFrame,
    date: str = "date",
    cuts: Sequence[str] = P.PERIOD_CUTS,
    labels: Sequence[str] = P.PERIODS,
    column: str = "covid_period",
) -> DataFrame:
    """Half-open periods between cut dates; no date gives `unknown`."""
    d = F.col(date)
    label = F.when(d.isNull(), P.NO_PERIOD)
    for cut, name in zip(cuts, labels):
        label = label.when(d < F.lit(cut).cast("timestamp_ntz"), name)
    return df.withColumn(column, label.otherwise(labels[-1]))


def classify_title(title: Column, classes: Sequence[tuple[str, str]] = P.TITLE_CLASSES) -> Column:
    """First matching class of the ordered list; no title and no match are `other`."""
    lowered = F.coalesce(F.lower(title), F.lit(""))
    label = None
    for name, pattern in classes:
        hit = lowered.rlike(whole_word(pattern))
        label = F.when(hit, name) if label is None else label.when(hit, name)
    return label.otherwise(P.NO_CLASS)


def with_category(
    df: DataFrame,
    classes: Sequence[tuple[str, str]] = P.TITLE_CLASSES,
    overrides: DataFrame | None = None,
    denied: DataFrame | None = None,
    dropped: Sequence[str] = P.DROPPED_CLASSES,
    key: str = "parent_asin",
    title: str = "product_title",
) -> DataFrame:
    """Title class, corrected by product lists, with unwanted classes removed.

    A `title_class` column found already (see `label_products`) saves matching
    the title once per review. `overrides` holds (key, category, priority) and may name a product more
    than once: the smallest priority wins. `denied` holds keys to drop.
    """
    known = "title_class" in df.columns
    found = F.col("title_class") if known else classify_title(F.col(title), classes)
    out = df.withColumn("category", found).drop("title_class")
    if overrides is not None:
        chosen = overrides.groupBy(key).agg(F.min_by("category", "priority").alias("_override"))
        out = (
            out.join(chosen, key, "left")
            .withColumn("category", F.coalesce("_override", "category"))
            .drop("_override")
        )
    if denied is not None:
        out = out.join(denied.select(key).distinct(), key, "left_anti")
    return out.where(~F.col("category").isin(*dropped))


def detect_brand(
    title: Column, pattern: str = P.BRAND_PATTERN, aliases: Mapping[str, str] = P.BRAND_ALIASES
) -> Column:
    """Leftmost brand word of the title, without hyphens and spaces, alias resolved."""
    word = F.regexp_extract(F.lower(F.coalesce(title, F.lit(""))), whole_word(pattern), 1)
    raw = F.translate(word, "- ", "")
    brand = F.when(raw == "", P.NO_BRAND)
    by_brand: dict[str, list[str]] = {}
    for alias, name in aliases.items():
        by_brand.setdefault(name, []).append(alias)
    for name, words in by_brand.items():
        brand = brand.when(raw.isin(*words), name)
    return brand.otherwise(raw)


def with_brand(
    df: DataFrame,
    title: str = "product_title",
    pattern: str = P.BRAND_PATTERN,
    aliases: Mapping[str, str] = P.BRAND_ALIASES,
) -> DataFrame:
    return df.withColumn("brand", detect_brand(F.col(title), pattern, aliases))


def label_products(
    products: DataFrame,
    title: str = "title",
    classes: Sequence[tuple[str, str]] = P.TITLE_CLASSES,
    pattern: str = P.BRAND_PATTERN,
    aliases: Mapping[str, str] = P.BRAND_ALIASES,
) -> DataFrame:
    """Title class and brand of each product, so that its reviews need not repeat the work."""
    return products.withColumns(
        {
            "title_class": classify_title(F.col(title), classes),
            "brand": detect_brand(F.col(title), pattern, aliases),
        }
    )


def pattern_flag(text: Column, pattern: str) -> Column:
    """1 where the text holds the pattern; no text gives 0."""
    return F.coalesce(text, F.lit("")).rlike(whole_word(pattern)).cast("int")


def with_tradeoff_flag(
    df: DataFrame, text: str = "review_text", pattern: str = P.CONTRAST_PATTERN
) -> DataFrame:
    return df.withColumn("has_tradeoff", pattern_flag(F.col(text), pattern))


def flag_columns(keywords: Mapping[str, str]) -> dict[str, str]:
    """Keyword -> name of its flag column."""
    return {kw: f"kw_{i}" for i, kw in enumerate(keywords)}


def with_keyword_flags(
    df: DataFrame, keywords: Mapping[str, str] = P.PERIOD_KEYWORDS, text: str = "review_text"
) -> DataFrame:
    """One 0/1 column per keyword pattern."""
    names = flag_columns(keywords)
    return df.withColumns(
        {names[kw]: pattern_flag(F.col(text), pattern) for kw, pattern in keywords.items()}
    )


def with_purchase_group(df: DataFrame) -> DataFrame:
    """Verified / Non-verified label (none without the flag) and the five-star flag."""
    verified = F.col("verified_purchase")
    return df.withColumns(
        {
            "group": F.when(verified, "Verified").when(~verified, "Non-verified"),
            "is_5_star": F.coalesce(F.col("rating") == 5, F.lit(False)).cast("int"),
        }
    )


def with_controls(df: DataFrame) -> DataFrame:
    """Log controls, distance from the product average, purchase flag as 0/1."""

    def log_of(name: str) -> Column:
        return F.log1p(F.coalesce(F.col(name).cast("double"), F.lit(0.0)))

    return df.withColumns(
        {
            "log_rating_number": log_of("rating_number"),
            "log_review_length": log_of("review_length"),
            "log_helpful_vote": log_of("helpful_vote"),
            "anchor_delta": F.col("rating") - F.col("average_rating"),
            # a missing flag counts as true, as a truth test of a missing value does
            "verified_int": F.coalesce(F.col("verified_purchase"), F.lit(True)).cast("int"),
        }
    )


def with_price_bin(
    df: DataFrame, price: str = "price", width: int = 50, quantile: float = 0.97, ceiling: int = 3000
) -> DataFrame:
    """Midpoint of right-closed bins of fixed width, for priced rows.

    The last edge is the largest multiple of `width` below int(limit) + width,
    where limit is the smaller of the price quantile and `ceiling`. Prices past
    it get no bin.
    """
    priced = df.where(F.col(price) > 0)
    limit = F.least(F.col("_q")["top"], F.lit(float(ceiling)))
    last_edge = F.floor((F.floor(limit) + F.lit(width - 1)) / F.lit(width)) * width
    mid = F.ceil(F.col(price) / width) * width - width / 2
    return (
        with_quantiles(priced, price, {"top": quantile})
        .withColumn("price_mid", F.when(F.col(price) <= last_edge, mid))
        .drop("_q")
    )


def cut_label(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed interval (edge, next edge] holding the value."""
    label = F.when(value <= F.lit(edges[0]), F.lit(None).cast("string"))
    for upper, name in zip(edges[1:], labels):
        label = label.when(value <= F.lit(upper), name)
    return label


def with_quantile_bin(
    df: DataFrame, value: str, labels: Sequence[str], column: str
) -> DataFrame:
    """Equal-share bins by interpolated quantile edges, right-closed, lowest value included.

    Two equal edges are an error, raised when the rows are computed.
    """
    k = len(labels)
    names = [f"e{i}" for i in range(k + 1)]
    v, edges = F.col(value).cast("double"), F.col("_q")
    clash = F.lit(False)
    for a, b in zip(names, names[1:]):
        clash = clash | (edges[a] == edges[b])
    label = F.when(clash, F.raise_error(F.lit(f"{value}: bin edges are not unique")).cast("string"))
    for name, upper in zip(labels, names[1:]):
        label = label.when(v <= edges[upper], name)
    binned = with_quantiles(df, value, {n: i / k for i, n in enumerate(names)})
    return binned.withColumn(column, label).drop("_q")
