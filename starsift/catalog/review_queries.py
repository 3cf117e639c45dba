"""Cleaning, joins, de-duplication, summaries, windows and sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from starsift.catalog import tables as V
from starsift.catalog.registry import n_rows, query, rounded
from starsift.catalog.sql import ctes, rnd
from starsift.catalog.tables import BASE, PR, RV, REVIEW_ID, Tables
from starsift.functions import patterns as P
from starsift.functions.rounding import round_even
from starsift.operators import clean, dedupe, profile, summaries
from starsift.operators.running import exact_quantiles
from starsift.operators.splits import shuffled
from starsift.plans import jobs
from starsift.sources.readers import lean_reviews

LINKED = ["parent_asin", "review_title", "review_text"]


def _priced(t: Tables):
    return t.prepared.where(F.col("price").isNotNull())


# --- B: derived columns ----------------------------------------------------------


@query(
    "b01_epoch_to_time",
    """SELECT order_key, line_no, CAST(epoch_ms(l_shipdate) AS BIGINT) AS ms,
      strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS shipped
    FROM (SELECT l_orderkey AS order_key, l_linenumber AS line_no, l_shipdate FROM lineitem)""",
)
def _(t: Tables):
    ms = F.timestamp_diff("MILLISECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("l_shipdate"))
    rows = t.read("lineitem").select(
        F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line_no"), ms.alias("ms")
    )
    shown = F.date_format(clean.from_epoch_ms(F.col("ms")), "yyyy-MM-dd HH:mm:ss")
    return rows.withColumn("shipped", shown)


@query(
    "b02_drop_columns",
    """SELECT main_category, count(*) AS n, sum(price) IS NOT NULL AS has_price
    FROM (SELECT p_type AS main_category, p_retailprice AS price FROM part) GROUP BY 1""",
)
def _(t: Tables):
    p = t.read("part").withColumnsRenamed({"p_type": "main_category", "p_retailprice": "price"})
    kept = p.drop("p_size", "pred_label", "rn")
    return kept.groupBy("main_category").agg(n_rows().alias("n"), F.sum("price").isNotNull().alias("has_price"))


@query(
    "b03_exclude_category",
    ctes(RV) + "SELECT main_category, count(*) AS n FROM rv WHERE main_category IS DISTINCT FROM 'PROMO' GROUP BY 1",
)
def _(t: Tables):
    kept = clean.exclude_value(t.reviews, "main_category", V.EXCLUDED)
    return kept.groupBy("main_category").agg(n_rows().alias("n"))


@query(
    "b04_date_parts",
    BASE + "SELECT year, month, date_of_month, day_of_week, count(*) AS n FROM pr GROUP BY ALL",
)
def _(t: Tables):
    return t.prepared.groupBy("year", "month", "date_of_month", "day_of_week").agg(n_rows().alias("n"))


@query(
    "b05_text_length",
    "SELECT doc_id, CAST(length(text) AS INTEGER) AS review_length FROM documents",
)
def _(t: Tables):
    return t.read("documents").select("doc_id", F.length("text").alias("review_length"))


@query(
    "b06_price_missing",
    BASE + "SELECT price_missing, count(*) AS n FROM pr GROUP BY 1",
)
def _(t: Tables):
    return t.prepared.groupBy("price_missing").agg(n_rows().alias("n"))


@query(
    "b07_price_tiers",
    BASE + f"""SELECT price_tier, count(*) AS n, {rnd('min(price)')} AS lowest, {rnd('max(price)')} AS highest
    FROM pr GROUP BY 1""",
)
def _(t: Tables):
    out = t.prepared.groupBy("price_tier").agg(
        n_rows().alias("n"), F.min("price").alias("lowest"), F.max("price").alias("highest")
    )
    return rounded(out, "lowest", "highest")


@query(
    "b08_period_label",
    BASE + "SELECT covid_period, min(year) AS first_year, max(year) AS last_year, count(*) AS n FROM pr GROUP BY 1",
)
def _(t: Tables):
    return t.prepared.groupBy("covid_period").agg(
        F.min("year").alias("first_year"), F.max("year").alias("last_year"), n_rows().alias("n")
    )


@query(
    "b09_title_class",
    f"SELECT product_title, category, count(*) AS n FROM (SELECT p_name AS product_title, {V.CATEGORY} AS category"
    " FROM (SELECT p_name, p_name AS product_title FROM part)) GROUP BY 1, 2",
)
def _(t: Tables):
    titled = t.products.withColumn("category", clean.classify_title(F.col("product_title"), V.CLASSES))
    return titled.groupBy("product_title", "category").agg(n_rows().alias("n"))


@query("b10_category_overrides", BASE + "SELECT parent_asin, category, count(*) AS n FROM pr GROUP BY 1, 2")
def _(t: Tables):
    return t.prepared.groupBy("parent_asin", "category").agg(n_rows().alias("n"))


@query(
    "b11_brand",
    f"SELECT product_title, brand, count(*) AS n FROM (SELECT product_title, {V.BRAND} AS brand"
    " FROM (SELECT p_name AS product_title FROM part)) GROUP BY 1, 2",
)
def _(t: Tables):
    branded = clean.with_brand(t.products, "product_title", V.BRANDS, V.ALIASES)
    return branded.groupBy("product_title", "brand").agg(n_rows().alias("n"))


@query(
    "b12_tradeoff_flag",
    r"""SELECT doc_id, CAST(regexp_matches(text,
      '(?i)(?:^|[^\p{L}\p{N}_])(that|which|que)(?:$|[^\p{L}\p{N}_])') AS INTEGER) AS has_tradeoff FROM documents""",
)
def _(t: Tables):
    return clean.with_tradeoff_flag(t.read("documents"), "text", V.HOW.contrast_pattern).select(
        "doc_id", "has_tradeoff"
    )


@query(
    "b13_keyword_flags",
    "WITH " + V.sql_flags() + " SELECT * FROM flags",
)
def _(t: Tables):
    flags = clean.with_keyword_flags(t.read("documents"), V.KEYWORDS, "text")
    return flags.select("doc_id", *clean.flag_columns(V.KEYWORDS).values())


@query(
    "b14_purchase_group",
    BASE + """SELECT CASE WHEN verified_purchase THEN 'Verified' ELSE 'Non-verified' END AS "group",
      CAST(rating = 5 AS INTEGER) AS is_5_star, count(*) AS n FROM pr GROUP BY 1, 2""",
)
def _(t: Tables):
    return clean.with_purchase_group(t.prepared).groupBy("group", "is_5_star").agg(n_rows().alias("n"))


@query(
    "b15_controls",
    ctes(RV, PR, V.WITH_LENGTH)
    + f"""SELECT rating, {rnd('avg(ln(1 + rating_number))')} AS log_rating_number,
      {rnd('avg(ln(1 + review_length))')} AS log_review_length,
      {rnd('avg(ln(1 + helpful_vote))')} AS log_helpful_vote,
      {rnd('avg(rating - average_rating)')} AS anchor_delta,
      CAST(sum(CAST(verified_purchase AS INTEGER)) AS BIGINT) AS verified FROM prl GROUP BY 1""",
)
def _(t: Tables):
    names = ["log_rating_number", "log_review_length", "log_helpful_vote", "anchor_delta"]
    out = clean.with_controls(t.with_length).groupBy("rating").agg(
        *[F.avg(n).alias(n) for n in names], F.sum("verified_int").alias("verified")
    )
    return rounded(out, *names)


BINS = """wp AS (SELECT * FROM pr WHERE price > 0),
edge AS (SELECT floor((floor(least(quantile_cont(price, 0.97), 3000)) + 49) / 50) * 50 AS last_edge FROM wp),
binned AS (SELECT wp.*, CASE WHEN price <= last_edge THEN ceil(price / 50) * 50 - 25e0 END AS price_mid FROM wp, edge)"""


@query(
    "b16_fixed_width_bins",
    ctes(RV, PR, BINS) + "SELECT CAST(price_mid AS DOUBLE) AS price_mid, count(*) AS n FROM binned GROUP BY 1",
)
def _(t: Tables):
    return clean.with_price_bin(t.prepared).groupBy("price_mid").agg(n_rows().alias("n"))


LENGTH_BUCKET = """CASE WHEN review_length <= 0 THEN NULL WHEN review_length <= 100 THEN '<100'
  WHEN review_length <= 300 THEN '100-300' WHEN review_length <= 600 THEN '300-600'
  WHEN review_length <= 1000 THEN '600-1000' WHEN review_length <= 99999 THEN '>1000' END"""


def _length_bucket(df):
    return df.withColumn(
        "length_bucket", clean.cut_label(F.col("review_length"), P.LENGTH_EDGES, P.LENGTH_LABELS)
    )


@query(
    "b17_explicit_bins",
    f"SELECT {LENGTH_BUCKET} AS length_bucket, count(*) AS n FROM"
    " (SELECT n_chars AS review_length FROM documents) GROUP BY 1",
)
def _(t: Tables):
    return _length_bucket(t.lengths).groupBy("length_bucket").agg(n_rows().alias("n"))


POP = """pq AS (SELECT quantile_cont(rating_number, 1 / 3e0) AS e1, quantile_cont(rating_number, 2 / 3e0) AS e2 FROM pr),
pop AS (SELECT pr.*, CASE WHEN rating_number <= e1 THEN 'Low' WHEN rating_number <= e2 THEN 'Mid' ELSE 'High' END
  AS pop_bucket FROM pr, pq)"""
POP_LABELS = ("Low", "Mid", "High")
QUART = """qq AS (SELECT quantile_cont(price, 0.25) AS e1, quantile_cont(price, 0.5) AS e2,
  quantile_cont(price, 0.75) AS e3 FROM pr WHERE price > 0),
quart AS (SELECT pr.*, CASE WHEN price <= e1 THEN 'Q1 (Budget)' WHEN price <= e2 THEN 'Q2 (Low-Mid)'
  WHEN price <= e3 THEN 'Q3 (High-Mid)' ELSE 'Q4 (Premium)' END AS price_quartile FROM pr, qq WHERE price > 0)"""


def popular(df):
    return clean.with_quantile_bin(df, "rating_number", POP_LABELS, "pop_bucket")


def quartiled(t: Tables):
    return clean.with_quantile_bin(
        t.prepared.where(F.col("price") > 0), "price", P.QUARTILE_LABELS, "price_quartile"
    )


@query(
    "b18_quantile_bins",
    ctes(RV, PR, QUART) + "SELECT price_quartile, count(*) AS n FROM quart GROUP BY 1",
)
def _(t: Tables):
    return quartiled(t).groupBy("price_quartile").agg(n_rows().alias("n"))


@query(
    "b18_quantile_bins_popularity",
    ctes(RV, PR, POP) + "SELECT pop_bucket, count(*) AS n FROM pop GROUP BY 1",
)
def _(t: Tables):
    return popular(t.prepared).groupBy("pop_bucket").agg(n_rows().alias("n"))


@query(
    "b23_lean_reviews",
    """SELECT CAST(row_number() OVER (ORDER BY md5('0|' || doc_id), doc_id) AS BIGINT) AS review_id,
      lang AS category, source AS brand, text AS review_text
    FROM documents WHERE text IS NOT NULL""",
)
def _(t: Tables):
    docs = t.read("documents").select(
        "doc_id", F.col("lang").alias("category"), F.col("source").alias("brand"),
        F.col("text").alias("review_text"),
    )
    return lean_reviews(docs, ["doc_id"])


@query(
    "b24_length_filters",
    "SELECT doc_id, length(text) > 20 AS context_ok FROM documents WHERE length(trim(text)) > 5",
)
def _(t: Tables):
    d = t.read("documents").where(F.length(F.trim("text")) > 5)
    return d.select("doc_id", (F.length("text") > 20).alias("context_ok"))


# --- C, D: joins and duplicates ----------------------------------------------------


@query(
    "c01_link_reviews",
    ctes(RV)
    + f"""SELECT order_key, line_no, parent_asin, rating, product_title, {rnd('price')} AS price,
      {rnd('average_rating')} AS average_rating, rating_number, main_category FROM rv""",
)
def _(t: Tables):
    out = t.reviews.select(
        "order_key", "line_no", "parent_asin", "rating", "product_title", "price",
        "average_rating", "rating_number", "main_category",
    )
    return rounded(out, "price", "average_rating")


@query(
    "c02_product_stats",
    BASE
    + f"""SELECT parent_asin, {rnd('avg(rating)')} AS avg_rating, {rnd('stddev_samp(rating)')} AS std, count(rating) AS n,
      {rnd('any_value(average_rating)')} AS average_rating, any_value(rating_number) AS rating_number
    FROM pr GROUP BY 1""",
)
def _(t: Tables):
    from starsift.operators.ttest import product_moments

    out = product_moments(t.prepared, REVIEW_ID).select(
        "parent_asin",
        F.col("dataset_avg_rating").alias("avg_rating"),
        F.col("dataset_rating_std").alias("std"),
        F.col("dataset_reviews").alias("n"),
        "average_rating",
        "rating_number",
    )
    return rounded(out, "avg_rating", "std", "average_rating")


@query(
    "c03_gap_to_product_mean",
    BASE
    + f"""SELECT order_key, line_no, rating, {rnd('rating - avg(rating) OVER (PARTITION BY parent_asin)')} AS off
    FROM pr""",
)
def _(t: Tables):
    means = summaries.mean_by(t.prepared, "parent_asin", "rating", "product_mean")
    out = t.prepared.join(means, "parent_asin").select(
        "order_key", "line_no", "rating", (F.col("rating") - F.col("product_mean")).alias("off")
    )
    return rounded(out, "off")


TOP_BRANDS = "top AS (SELECT brand, count(*) AS reviews FROM pr WHERE brand <> 'unknown' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 2)"


@query(
    "c04_rows_of_top_brands",
    ctes(RV, PR, TOP_BRANDS) + "SELECT brand, price_tier, count(*) AS n FROM pr WHERE brand IN (SELECT brand FROM top) GROUP BY 1, 2",
)
def _(t: Tables):
    top = summaries.top_brands(t.prepared, 2)
    return dedupe.keep_listed(t.prepared, top, "brand").groupBy("brand", "price_tier").agg(n_rows().alias("n"))


@query(
    "c05_rows_not_denied",
    ctes(RV) + "SELECT main_category, count(*) AS n FROM rv WHERE parent_asin % 101 <> 0 GROUP BY 1",
)
def _(t: Tables):
    kept = dedupe.drop_listed(t.reviews, t.denied, "parent_asin")
    return kept.groupBy("main_category").agg(n_rows().alias("n"))


@query(
    "c10_group_total",
    ctes(RV, PR)
    + """SELECT order_key, line_no, category, sum(helpful_vote) OVER (PARTITION BY category)::BIGINT AS category_votes
    FROM pr""",
)
def _(t: Tables):
    slim = t.prepared.select("order_key", "line_no", "category", "helpful_vote")
    out = summaries.group_total_beside_rows(slim, "category", "helpful_vote", "category_votes")
    return out.select("order_key", "line_no", "category", "category_votes")


@query(
    "d01_duplicate_report",
    """SELECT text, count(*) AS cnt FROM documents GROUP BY 1 HAVING count(*) > 1 ORDER BY 2 DESC, 1""",
)
def _(t: Tables):
    return dedupe.duplicate_groups(t.read("documents"), ["text"])


@query(
    "d01_duplicate_report_reviews",
    ctes(RV)
    + "SELECT order_key, line_no, count(*) AS cnt FROM rv GROUP BY 1, 2 HAVING count(*) > 1 ORDER BY 3 DESC, 1, 2",
)
def _(t: Tables):
    return dedupe.duplicate_groups(t.reviews, REVIEW_ID)


REST_ORDER = [
    "parent_asin", "rating", "date", "verified_purchase", "product_title", "price", "average_rating",
    "rating_number", "main_category", "helpful_vote",
]
_sql_order = ", ".join(f"{c} NULLS FIRST" for c in REST_ORDER)
DEDUPED = f"""dd AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY order_key, line_no ORDER BY {_sql_order}) AS rn FROM rv) WHERE rn = 1)"""


@query(
    "d02_keep_one_per_key",
    ctes(RV, DEDUPED)
    + f"SELECT order_key, line_no, parent_asin, rating, {rnd('price')} AS price, helpful_vote FROM dd",
)
def _(t: Tables):
    out = dedupe.first_per_key(t.reviews, REVIEW_ID, REST_ORDER).select(
        "order_key", "line_no", "parent_asin", "rating", "price", "helpful_vote"
    )
    return rounded(out, "price")


@query(
    "d02_keep_one_text",
    "SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY 1",
)
def _(t: Tables):
    return dedupe.first_per_key(t.read("documents").select("text", "doc_id"), ["text"], ["doc_id"])


@query(
    "d03_first_per_product",
    ctes(RV, PR)
    + f"""SELECT parent_asin, min((order_key, line_no, rating))[1] AS order_key, min((order_key, line_no, rating))[2] AS line_no,
      min((order_key, line_no, rating))[3] AS rating FROM pr GROUP BY 1""",
)
def _(t: Tables):
    first = F.min(F.struct("order_key", "line_no", "rating")).alias("f")
    return t.prepared.groupBy("parent_asin").agg(first).select("parent_asin", "f.*")


@query(
    "d05_distinct_texts",
    "SELECT DISTINCT text FROM benchmark WHERE text IS NOT NULL",
)
def _(t: Tables):
    return dedupe.distinct_values(t.read("benchmark"), "text")


@query(
    "d06_stack_rows",
    """SELECT kind, count(*) AS n, count(lang) AS with_lang FROM (
      SELECT 'document' AS kind, text, lang FROM documents UNION ALL SELECT 'benchmark', text, NULL FROM benchmark)
    GROUP BY 1""",
)
def _(t: Tables):
    docs = t.read("documents").select(F.lit("document").alias("kind"), "text", "lang")
    items = t.read("benchmark").select(F.lit("benchmark").alias("kind"), "text")
    both = dedupe.stack_rows(docs, items)
    return both.groupBy("kind").agg(n_rows().alias("n"), F.count("lang").alias("with_lang"))


@query(
    "d10_shuffle",
    """SELECT doc_id, CAST(row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) AS BIGINT) AS place
    FROM documents""",
)
def _(t: Tables):
    from starsift.operators.running import dense_ids

    # the place of each row in the repeatable random order of `shuffled`
    return dense_ids(t.read("documents").select("doc_id"), ["doc_id"], "place", seed=42)


@query("d10_shuffle_rows", "SELECT doc_id, lang FROM documents")
def _(t: Tables):
    return shuffled(t.read("documents").select("doc_id", "lang"), ["doc_id"])


# --- E: aggregations -----------------------------------------------------------------


@query(
    "e01_column_profile",
    ctes(RV, PR, "p1 AS (SELECT parent_asin, rating, price, category, brand, year FROM pr)")
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, '{ty}' AS dtype, count({c}) AS non_null,
        {rnd(f'(1 - count({c}) / count(*)) * 100', 2)} AS null_pct FROM p1"""
        for c, ty in (
            ("parent_asin", "bigint"), ("rating", "double"), ("price", "double"),
            ("category", "string"), ("brand", "string"), ("year", "int"),
        )
    ),
)
def _(t: Tables):
    return profile.column_profile(
        t.prepared.select("parent_asin", "rating", "price", "category", "brand", "year")
    )


DESCRIBED = ["rating", "price", "average_rating", "rating_number", "helpful_vote", "year"]


@query(
    "e02_describe",
    BASE
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS count, {rnd(f'avg({c})', 2)} AS mean,
        {rnd(f'stddev_samp({c})', 2)} AS std, {rnd(f'min({c})', 2)} AS min,
        {rnd(f'quantile_cont({c}, 0.25)', 2)} AS q25, {rnd(f'quantile_cont({c}, 0.5)', 2)} AS q50,
        {rnd(f'quantile_cont({c}, 0.75)', 2)} AS q75, {rnd(f'max({c})', 2)} AS max FROM pr"""
        for c in DESCRIBED
    ),
)
def _(t: Tables):
    return profile.describe_numeric(t.prepared, DESCRIBED)


@query(
    "e03_dataset_card",
    BASE
    + """SELECT count(*) AS n_rows, count(DISTINCT brand) AS n_brands, count(DISTINCT parent_asin) AS n_products,
      min(year) AS first_year, max(year) AS last_year FROM pr""",
)
def _(t: Tables):
    return profile.dataset_card(t.prepared)


@query("e04_reviews_by_category", BASE + "SELECT category, count(*) AS reviews FROM pr GROUP BY 1")
def _(t: Tables):
    return summaries.count_by(t.prepared, "category")


@query(
    "e05_top_brands",
    BASE + "SELECT brand, count(*) AS reviews FROM pr WHERE brand <> 'unknown' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15",
)
def _(t: Tables):
    return summaries.top_brands(t.prepared)


@query(
    "e06_top_brand_ratings",
    BASE
    + f"""SELECT brand, reviews, {rnd('avg_rating')} AS avg_rating FROM (
      SELECT brand, count(*) AS reviews, avg(rating) AS avg_rating FROM pr WHERE brand <> 'unknown'
      GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15)""",
)
def _(t: Tables):
    return rounded(summaries.top_brand_ratings(t.prepared), "avg_rating")


@query(
    "e07_rating_frequencies",
    BASE
    + f"""SELECT column_name, {rnd('value')} AS value, count(*) AS n FROM (
      SELECT 'rating' AS column_name, rating AS value FROM pr
      UNION ALL SELECT 'average_rating', average_rating FROM pr) GROUP BY 1, 2""",
)
def _(t: Tables):
    return rounded(summaries.value_frequencies(t.prepared, ["rating", "average_rating"]), "value")


def _sql_histogram(source: str, value: str, bins: int) -> str:
    return f"""SELECT bin, {rnd('any_value(lo) + bin * any_value(w)', 4)} AS left_edge, count(*) AS n FROM (
      SELECT CAST(least(floor((v - lo) / w), {bins - 1}) AS INTEGER) AS bin, lo, w FROM (
        SELECT v, lo, (hi - lo) / {bins} AS w FROM (SELECT {value} AS v FROM {source} WHERE {value} IS NOT NULL),
          (SELECT CAST(min({value}) AS DOUBLE) AS lo, CAST(max({value}) AS DOUBLE) AS hi FROM {source}))) GROUP BY 1"""


@query("e08_rating_gap_histogram", ctes(RV, PR) + _sql_histogram("pr", "(rating - average_rating)", 10))
def _(t: Tables):
    gap = t.prepared.withColumn("gap", F.col("rating") - F.col("average_rating"))
    return rounded(summaries.histogram(gap, "gap", 10), "left_edge", places=4)


@query(
    "e09_product_ratings",
    BASE
    + f"SELECT parent_asin, {rnd('avg(average_rating)')} AS average_rating, count(average_rating) AS review_count FROM pr GROUP BY 1",
)
def _(t: Tables):
    return rounded(summaries.product_ratings(t.prepared), "average_rating")


@query(
    "e10_popularity_smoother",
    ctes(
        RV,
        PR,
        "pts AS (SELECT count(average_rating) AS x, avg(average_rating) AS y FROM pr GROUP BY parent_asin)",
        "fold AS (SELECT CAST(x AS DOUBLE) AS x, count(*) AS n, sum(y) AS sy FROM pts GROUP BY 1)",
        "span AS (SELECT min(x) AS lo, max(x) AS hi, sum(n) AS n FROM fold)",
        "grid AS (SELECT i, lo + i * ((hi - lo) / 24) AS g, n AS total FROM span, range(0, 25) r(i))",
        "sp AS (SELECT i, g, total, x, n, sy, abs(x - g) AS d FROM fold, grid)",
        "cum AS (SELECT *, sum(n) OVER (PARTITION BY i ORDER BY d) AS c FROM sp)",
        "reach AS (SELECT i, min(d) AS h FROM cum WHERE c >= floor(total * (2 / 3e0) + 1e-10) GROUP BY 1)",
        "wt AS (SELECT sp.*, x - g AS dx, CASE WHEN d < h THEN pow(1 - pow(d / h, 3), 3) ELSE 0 END AS w FROM sp JOIN reach USING (i) WHERE h > 0)",
        """su AS (SELECT i, g, sum(w * n) AS s0, sum(w * n * dx) AS s1, sum(w * n * dx * dx) AS s2,
          sum(w * sy) AS t0, sum(w * sy * dx) AS t1 FROM wt GROUP BY 1, 2)""",
    )
    + f"SELECT {rnd('g', 4)} AS x, {rnd('(s2 * t0 - s1 * t1) / nullif(s0 * s2 - s1 * s1, 0)', 5)} AS fit FROM su",
)
def _(t: Tables):
    points = summaries.product_ratings(t.prepared)
    out = summaries.local_smoother(points, "review_count", "average_rating")
    return out.select(round_even(F.col("x"), 4).alias("x"), round_even(F.col("fit"), 5).alias("fit"))


@query("e11_price_histogram", ctes(RV, PR) + _sql_histogram("pr", "price", 30))
def _(t: Tables):
    return rounded(summaries.histogram(t.prepared, "price", 30), "left_edge", places=4)


SHARE_BY_TIER = f"""SELECT price_tier, rating, n, {rnd('n / sum(n) OVER (PARTITION BY price_tier)')} AS proportion
  FROM (SELECT price_tier, rating, count(*) AS n FROM {{source}} WHERE price IS NOT NULL GROUP BY 1, 2)"""


@query("e12_rating_share_by_tier", BASE + SHARE_BY_TIER.format(source="pr"))
def _(t: Tables):
    return rounded(summaries.rating_share_by_tier(t.prepared), "proportion")


def deduped_share(t: Tables):
    """Link, de-duplicate, tier, then share of ratings within each tier."""
    one = dedupe.first_per_key(t.reviews, REVIEW_ID, REST_ORDER)
    return rounded(summaries.rating_share_by_tier(clean.with_price_tier(one)), "proportion")


@query(
    "e12_rating_share_deduplicated",
    ctes(
        RV,
        DEDUPED,
        """cut AS (SELECT quantile_cont(price, 0.5) AS q50, quantile_cont(price, 0.75) AS q75,
          quantile_cont(price, 0.975) AS q975 FROM dd)""",
        f"dt AS (SELECT dd.*, {V.TIER} AS price_tier FROM dd, cut)",
    )
    + SHARE_BY_TIER.format(source="dt"),
)
def _(t: Tables):
    return deduped_share(t)


def _sql_box(source: str, value: str, group: str) -> str:
    return f"""SELECT {group}, {rnd('any_value(q1)')} AS q1, {rnd('any_value(med)')} AS median, {rnd('any_value(q3)')} AS q3,
      count(*) AS n, {rnd('min(v)')} AS min, {rnd('max(v)')} AS max,
      {rnd('min(v) FILTER (v >= q1 - 1.5e0 * (q3 - q1))')} AS lower_whisker,
      {rnd('max(v) FILTER (v <= q3 + 1.5e0 * (q3 - q1))')} AS upper_whisker
    FROM (SELECT {group}, CAST({value} AS DOUBLE) AS v FROM {source} WHERE {value} IS NOT NULL) JOIN (
      SELECT {group}, quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS med,
        quantile_cont({value}, 0.75) AS q3 FROM {source} WHERE {value} IS NOT NULL GROUP BY 1) USING ({group})
    GROUP BY 1"""


BOX = ["q1", "median", "q3", "min", "max", "lower_whisker", "upper_whisker"]


@query(
    "e13_premium_prices",
    ctes(RV, PR, "prem AS (SELECT price_tier, price FROM pr WHERE price_tier = 'Premium')")
    + _sql_box("prem", "price", "price_tier"),
)
def _(t: Tables):
    premium = t.prepared.where(F.col("price_tier") == "Premium")
    return rounded(summaries.box_summary(premium, "price", "price_tier"), *BOX)


@query(
    "e14_monthly_spend",
    BASE + f"SELECT year, month, {rnd('sum(price) / 1e6')} AS spending_millions FROM pr WHERE price IS NOT NULL GROUP BY 1, 2",
)
def _(t: Tables):
    return rounded(summaries.monthly_spend(t.prepared), "spending_millions")


@query("e15_reviews_by_year", BASE + "SELECT year, count(*) AS reviews FROM pr GROUP BY 1")
def _(t: Tables):
    return summaries.count_by(t.prepared, "year")


@query(
    "e15_reviews_by_month",
    BASE + "SELECT month, count(*) AS reviews, substr(monthname(any_value(date)), 1, 3) AS month_name FROM pr GROUP BY 1",
)
def _(t: Tables):
    return summaries.reviews_by_month(t.prepared)


@query(
    "e15_reviews_by_day_of_month",
    BASE + "SELECT date_of_month, count(*) AS reviews FROM pr GROUP BY 1",
)
def _(t: Tables):
    return summaries.count_by(t.prepared, "date_of_month")


@query("e16_reviews_by_weekday", BASE + "SELECT day_of_week, count(*) AS reviews FROM pr GROUP BY 1")
def _(t: Tables):
    return summaries.reviews_by_weekday(t.prepared)


@query(
    "e17_volume_by_period",
    BASE + "SELECT covid_period, count(*) AS reviews FROM pr WHERE covid_period <> 'unknown' GROUP BY 1",
)
def _(t: Tables):
    return summaries.volume_by_period(t.prepared)


@query(
    "e18_rating_by_period",
    BASE
    + f"""SELECT covid_period, {rnd('avg(rating)')} AS avg_rating, median(rating) AS median_rating,
      {rnd('stddev_samp(rating)')} AS std, count(rating) AS n,
      {rnd('stddev_samp(rating) / sqrt(count(rating))')} AS se FROM pr GROUP BY 1""",
)
def _(t: Tables):
    return rounded(summaries.rating_by_period(t.prepared), "avg_rating", "std", "se")


FLAGGED = "prf AS (SELECT * FROM pr JOIN flags USING (doc_id))"
HITS = "hits AS (" + " UNION ALL ".join(
    f"SELECT '{kw}' AS keyword, covid_period AS period, count(*) AS n, sum(kw_{i}) AS hits FROM prf GROUP BY 2"
    for i, kw in enumerate(V.KEYWORDS)
) + ")"
FLAG_BASE = ctes(RV, PR, V.sql_flags(), FLAGGED, HITS)


@query("e19_keyword_rates", FLAG_BASE + f"SELECT keyword, period, {rnd('hits / n * 100', 2)} AS pct FROM hits")
def _(t: Tables):
    return summaries.keyword_rates(t.with_flags, V.KEYWORDS)


_RATES = """max(hits / n) FILTER (period = 'pre-COVID') AS pre, max(hits / n) FILTER (period = 'during-COVID') AS dur"""


@query(
    "e20_keyword_lift",
    FLAG_BASE
    + f"SELECT keyword, {rnd('(dur - pre) / (pre + 1e-9) * 100', 1)} AS lift_pct FROM (SELECT keyword, {_RATES} FROM hits GROUP BY 1)",
)
def _(t: Tables):
    return summaries.keyword_lift(t.with_flags, V.KEYWORDS)


def _rate3(period: str) -> str:
    return f"{rnd(f'''max(hits / n * 100) FILTER (period = '{period}')''', 3)}"


@query(
    "e20_keyword_period_table",
    FLAG_BASE
    + f"""SELECT *, {rnd('(during_rate - pre_rate) / (pre_rate + 1e-9) * 100', 1)} AS lift_during_vs_pre,
      {rnd('(post_rate - pre_rate) / (pre_rate + 1e-9) * 100', 1)} AS lift_post_vs_pre FROM (
      SELECT keyword, {_rate3('pre-COVID')} AS pre_rate, {_rate3('during-COVID')} AS during_rate,
        {_rate3('post-COVID')} AS post_rate FROM hits GROUP BY 1)""",
)
def _(t: Tables):
    return summaries.keyword_period_table(t.with_flags, V.KEYWORDS)


@query(
    "d09_keyword_pivot",
    FLAG_BASE
    + f"""SELECT keyword, {_rate3('pre-COVID')} AS pre_rate, {_rate3('during-COVID')} AS during_rate,
        {_rate3('post-COVID')} AS post_rate FROM hits GROUP BY 1""",
)
def _(t: Tables):
    return summaries.keyword_period_table(t.with_flags, V.KEYWORDS).select(
        "keyword", "pre_rate", "during_rate", "post_rate"
    )


@query(
    "e21_category_share",
    BASE
    + f"""SELECT covid_period, category, n, {rnd('n / sum(n) OVER (PARTITION BY covid_period) * 100', 1)} AS share
    FROM (SELECT covid_period, category, count(*) AS n FROM pr GROUP BY 1, 2)""",
)
def _(t: Tables):
    known = summaries.known_period(t.prepared)
    return summaries.share_within(known, "covid_period", "category", percent=True)


SENT = (RV, PR, V.sql_sentiment("documents", "doc_id"), "prs AS (SELECT * FROM pr JOIN sentiment USING (doc_id))")


@query(
    "e22_sentiment_by_period",
    ctes(*SENT) + f"SELECT covid_period, {rnd('avg(vader_sentiment)', 5)} AS mean_sentiment FROM prs GROUP BY 1",
)
def _(t: Tables):
    out = summaries.mean_by(
        summaries.known_period(t.with_sentiment), "covid_period", "vader_sentiment", "mean_sentiment"
    )
    return rounded(out, "mean_sentiment", places=5)


_BIN_STATS = f"""CAST(price_mid AS DOUBLE) AS price, {rnd('avg(rating)')} AS avg_rating, {rnd('stddev_samp(rating)')} AS std,
  count(rating) AS n, {rnd('avg(CAST(rating <= 3 AS INTEGER)) * 100')} AS neg_pct,
  {rnd('stddev_samp(rating) / sqrt(count(rating))')} AS se"""
BIN_COLS = ["avg_rating", "std", "neg_pct", "se"]


@query(
    "e23_binned_ratings",
    ctes(RV, PR, BINS) + f"SELECT {_BIN_STATS} FROM binned WHERE price_mid IS NOT NULL GROUP BY price_mid HAVING count(rating) >= 30",
)
def _(t: Tables):
    return rounded(summaries.binned_ratings(clean.with_price_bin(t.prepared)), *BIN_COLS)


@query(
    "e23_binned_by_category",
    ctes(RV, PR, BINS)
    + f"SELECT category, {_BIN_STATS} FROM binned WHERE price_mid IS NOT NULL GROUP BY category, price_mid HAVING count(rating) >= 10",
)
def _(t: Tables):
    return rounded(
        summaries.binned_ratings(clean.with_price_bin(t.prepared), 10, ["category"]), *BIN_COLS
    )


@query(
    "e24_length_histogram",
    "WITH len AS (SELECT n_chars AS review_length FROM documents) " + _sql_histogram("len", "review_length", 50),
)
def _(t: Tables):
    return rounded(summaries.histogram(t.lengths, "review_length", 50), "left_edge", places=4)


@query("e25_rating_by_category", BASE + _sql_box("pr", "rating", "category"))
def _(t: Tables):
    return rounded(summaries.box_summary(t.prepared, "rating", "category"), *BOX)


@query("e25_length_by_rating", ctes(RV, PR, V.WITH_LENGTH) + _sql_box("prl", "review_length", "rating"))
def _(t: Tables):
    return rounded(summaries.box_summary(t.with_length, "review_length", "rating"), *BOX)


@query(
    "e25_sentiment_by_rating",
    ctes(*SENT, f"pbox AS ({_sql_box('prs', 'vader_sentiment', 'rating')})")
    + "SELECT * FROM pbox",
)
def _(t: Tables):
    return rounded(summaries.box_summary(t.with_sentiment, "vader_sentiment", "rating"), *BOX)


@query(
    "e25_sentiment_by_period",
    ctes(*SENT) + _sql_box("prs", "vader_sentiment", "covid_period"),
)
def _(t: Tables):
    known = summaries.known_period(t.with_sentiment)
    return rounded(summaries.box_summary(known, "vader_sentiment", "covid_period"), *BOX)


@query(
    "e26_negative_by_bin",
    ctes(RV, PR, BINS)
    + f"""SELECT CAST(price_mid AS DOUBLE) AS price, {rnd('avg(CAST(rating <= 3 AS INTEGER)) * 100')} AS neg_pct, count(rating) AS n
    FROM binned WHERE price_mid IS NOT NULL GROUP BY 1 HAVING count(rating) >= 30""",
)
def _(t: Tables):
    out = summaries.binned_ratings(clean.with_price_bin(t.prepared)).select("price", "neg_pct", "n")
    return rounded(out, "neg_pct")


@query(
    "e27_best_and_worst_bin",
    ctes(
        RV, PR, BINS,
        "b AS (SELECT CAST(price_mid AS DOUBLE) AS price, avg(rating) AS r FROM binned WHERE price_mid IS NOT NULL GROUP BY 1 HAVING count(rating) >= 30)",
    )
    + f"""SELECT min(price) AS min_price, max(price) AS max_price, count(*) AS n_bins,
      min_by(price, (-r, price)) AS best_bin, {rnd('max(r)')} AS best_rating,
      min_by(price, (r, price)) AS worst_bin, {rnd('min(r)')} AS worst_rating FROM b""",
)
def _(t: Tables):
    bins = summaries.binned_ratings(clean.with_price_bin(t.prepared))
    return rounded(summaries.bin_extremes(bins), "best_rating", "worst_rating")


@query(
    "e28_quartile_summary",
    ctes(RV, PR, QUART)
    + f"""SELECT price_quartile, median(rating) AS median_rating, {rnd('avg(rating)', 3)} AS mean_rating,
      {rnd(rnd('avg(CAST(rating <= 3 AS INTEGER))', 3) + ' * 100', 1)} AS pct_negative, count(rating) AS n FROM quart GROUP BY 1""",
)
def _(t: Tables):
    return summaries.quartile_summary(quartiled(t))


@query(
    "e29_group_summary",
    BASE
    + f"""SELECT CASE WHEN verified_purchase THEN 'Verified' ELSE 'Non-verified' END AS "group", count(*) AS n_reviews,
      {rnd('avg(rating)', 3)} AS mean_rating, median(rating) AS median_rating,
      {rnd('avg(CAST(rating = 5 AS INTEGER)) * 100', 3)} AS pct_5_star FROM pr GROUP BY 1""",
)
def _(t: Tables):
    return summaries.group_summary(clean.with_purchase_group(t.prepared))


@query(
    "e31_product_rating_stats",
    BASE
    + f"""SELECT parent_asin, any_value(brand) AS brand, {rnd('avg(rating)')} AS dataset_avg_rating,
      {rnd('stddev_samp(rating)')} AS dataset_rating_std, count(rating) AS dataset_reviews FROM pr GROUP BY 1""",
)
def _(t: Tables):
    from starsift.operators.ttest import product_moments

    out = product_moments(t.prepared, REVIEW_ID).select(
        "parent_asin", "brand", "dataset_avg_rating", "dataset_rating_std", "dataset_reviews"
    )
    return rounded(out, "dataset_avg_rating", "dataset_rating_std")


@query(
    "e33_votes_by_rating",
    BASE + f"SELECT rating, {rnd('avg(helpful_vote)')} AS mean_helpful FROM pr WHERE helpful_vote > 0 GROUP BY 1",
)
def _(t: Tables):
    return rounded(summaries.votes_by_rating(t.prepared), "mean_helpful")


@query(
    "e33_votes_by_length",
    ctes(RV, PR, V.WITH_LENGTH)
    + f"""SELECT {LENGTH_BUCKET} AS length_bucket, {rnd('avg(helpful_vote)')} AS mean_helpful,
      {rnd('avg(CAST(helpful_vote > 0 AS INTEGER)) * 100')} AS pct_voted FROM prl GROUP BY 1""",
)
def _(t: Tables):
    out = summaries.votes_by_length(_length_bucket(t.with_length))
    return rounded(out, "mean_helpful", "pct_voted")


@query(
    "e34_medians_by_popularity",
    ctes(RV, PR, POP)
    + """SELECT pop_bucket, median(rating) AS median_rating, CAST(median(n_chars) AS DOUBLE) AS median_review_length
    FROM pop JOIN documents USING (doc_id) GROUP BY 1""",
)
def _(t: Tables):
    df = popular(t.prepared).join(t.lengths, "doc_id")
    return summaries.medians_by(df, "pop_bucket", ["rating", "review_length"])


@query(
    "e35_product_level",
    ctes(*SENT)
    + f"""SELECT parent_asin, {rnd('avg(rating)')} AS avg_rating, count(rating) AS review_count,
      {rnd('avg(vader_sentiment)', 5)} AS avg_sentiment, {rnd('ln(1 + count(rating))')} AS log_review_count FROM prs GROUP BY 1""",
)
def _(t: Tables):
    out = summaries.product_level(t.with_sentiment)
    return rounded(rounded(out, "avg_rating", "log_review_count"), "avg_sentiment", places=5)


@query(
    "e35_popularity_trend",
    ctes(RV, PR, "pl AS (SELECT avg(rating) AS y, ln(1 + count(rating)) AS x FROM pr GROUP BY parent_asin)")
    + f"""SELECT {rnd('regr_slope(y, x)', 5)} AS slope, {rnd('regr_intercept(y, x)', 5)} AS intercept,
      {rnd('min(x)')} AS x_min, {rnd('max(x)')} AS x_max FROM pl""",
)
def _(t: Tables):
    slim = t.prepared.withColumn("vader_sentiment", F.lit(None).cast("double"))
    out = summaries.linear_trend(summaries.product_level(slim), "log_review_count", "avg_rating")
    return rounded(rounded(out, "slope", "intercept", places=5), "x_min", "x_max")


CORR = ["rating", "price", "average_rating", "rating_number", "helpful_vote", "price_missing"]


def _sql_corr(a: str, b: str) -> str:
    x = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END"
    y = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({b} AS DOUBLE) END"
    r = f"covar_samp({x}, {y}) / nullif(stddev_samp({x}) * stddev_samp({y}), 0)"
    return f"SELECT '{a}' AS column_a, '{b}' AS column_b, {rnd(r, 2)} + 0e0 AS r FROM pr"


@query("e36_correlation_matrix", BASE + " UNION ALL ".join(_sql_corr(a, b) for a in CORR for b in CORR))
def _(t: Tables):
    out = profile.correlation_matrix(t.prepared, CORR)
    return out.withColumn("r", F.col("r") + F.lit(0.0))


# --- F, G: windows and sorts -----------------------------------------------------------


@query(
    "f01_row_number",
    ctes(RV)
    + f"SELECT order_key, line_no, count(*) FILTER (rn = 1) AS kept, count(*) AS copies FROM (SELECT *, row_number() OVER (PARTITION BY order_key, line_no ORDER BY {_sql_order}) AS rn FROM rv) GROUP BY 1, 2",
)
def _(t: Tables):
    kept = dedupe.first_per_key(t.reviews, REVIEW_ID, REST_ORDER).select(*REVIEW_ID)
    copies = t.reviews.groupBy(*REVIEW_ID).agg(n_rows().alias("copies"))
    return kept.groupBy(*REVIEW_ID).agg(n_rows().alias("kept")).join(copies, REVIEW_ID)


@query(
    "f02_group_total",
    BASE
    + """SELECT price_tier, rating, n, CAST(sum(n) OVER (PARTITION BY price_tier) AS BIGINT) AS tier_total
    FROM (SELECT price_tier, rating, count(*) AS n FROM pr GROUP BY 1, 2)""",
)
def _(t: Tables):
    counts = summaries.count_by(t.prepared, "price_tier", "rating", name="n")
    return summaries.group_total_beside_rows(counts, "price_tier", "n", "tier_total")


@query(
    "f03_ecdf_by_purchase",
    BASE
    + f"""SELECT "group", rating, n, {rnd('sum(n) OVER (PARTITION BY "group" ORDER BY rating) / sum(n) OVER (PARTITION BY "group")')} AS ecdf
    FROM (SELECT CASE WHEN verified_purchase THEN 'Verified' ELSE 'Non-verified' END AS "group", rating, count(*) AS n FROM pr GROUP BY 1, 2)""",
)
def _(t: Tables):
    return rounded(summaries.ecdf(clean.with_purchase_group(t.prepared), "rating", "group"), "ecdf")


@query(
    "f03_ecdf_price_by_category",
    BASE
    + f"""SELECT category, {rnd('price')} AS price, n, {rnd('c / sum(n) OVER (PARTITION BY category)')} AS ecdf
    FROM (SELECT *, sum(n) OVER (PARTITION BY category ORDER BY price) AS c FROM (
      SELECT category, price, count(*) AS n FROM pr WHERE price IS NOT NULL GROUP BY 1, 2))""",
)
def _(t: Tables):
    return rounded(summaries.ecdf(t.prepared, "price", "category"), "price", "ecdf")


@query(
    "f04_mid_ranks",
    BASE
    + """SELECT price, n, c - n + (n + 1) / 2e0 AS mid_rank FROM (
      SELECT price, n, sum(n) OVER (ORDER BY price) AS c FROM (
        SELECT price, count(*) AS n FROM pr WHERE price IS NOT NULL GROUP BY 1))""",
)
def _(t: Tables):
    from starsift.operators.running import running_counts

    ranked = running_counts(t.prepared, "price", {"n": n_rows()})
    return ranked.select(
        F.col("value").alias("price"), "n", (F.col("n_before") + (F.col("n") + 1) / 2).alias("mid_rank")
    )


@query(
    "g01_sort_by_count",
    ctes(RV) + "SELECT parent_asin, count(*) AS cnt FROM rv GROUP BY 1 ORDER BY 2 DESC, 1",
)
def _(t: Tables):
    return t.reviews.groupBy("parent_asin").agg(n_rows().alias("cnt")).orderBy(F.desc("cnt"), "parent_asin")


@query(
    "g02_top_products",
    BASE + "SELECT parent_asin, count(*) AS reviews FROM pr GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20",
)
def _(t: Tables):
    return (
        summaries.count_by(t.prepared, "parent_asin")
        .orderBy(F.desc("reviews"), "parent_asin")
        .limit(20)
    )


@query(
    "e02_price_quantiles",
    BASE
    + "SELECT "
    + ", ".join(f"{rnd(f'quantile_cont(price, {q})')} AS {n}" for n, q in P.TIER_QUANTILES.items())
    + " FROM pr",
)
def _(t: Tables):
    return rounded(exact_quantiles(t.prepared, "price", P.TIER_QUANTILES), *P.TIER_QUANTILES)


# --- P: prepared tables ------------------------------------------------------------------


@query(
    "p01_prepared_columns",
    BASE
    + f"""SELECT order_key, line_no, parent_asin, rating, {rnd('price')} AS price, year, month, date_of_month, day_of_week,
      price_missing, price_tier, covid_period, category, brand FROM pr""",
)
def _(t: Tables):
    out = t.prepared.select(
        "order_key", "line_no", "parent_asin", "rating", "price", "year", "month", "date_of_month",
        "day_of_week", "price_missing", "price_tier", "covid_period", "category", "brand",
    )
    return rounded(out, "price")


def _documents_as_reviews(t: Tables):
    return t.read("documents").select(
        F.col("source").alias("parent_asin"),
        (F.col("doc_id") % 5 + 1).cast("double").alias("rating"),
        F.lit(None).cast("string").alias("title"),
        "text",
        F.lit(True).alias("verified_purchase"),
    )


@query(
    "p02_link_and_deduplicate",
    """SELECT text AS review_text, source AS parent_asin, count(*) FILTER (rn = 1) AS kept, count(*) AS copies FROM (
      SELECT text, source, row_number() OVER (PARTITION BY source, text ORDER BY doc_id) AS rn
      FROM documents JOIN (SELECT DISTINCT source FROM documents) USING (source)) GROUP BY 1, 2""",
)
def _(t: Tables):
    products = (
        t.read("documents")
        .select(F.col("source").alias("parent_asin"))
        .distinct()
        .withColumns(
            {
                "title": F.col("parent_asin"),
                "price": F.lit(1.0),
                "average_rating": F.lit(3.0),
                "rating_number": F.lit(1),
                "main_category": F.lit("text"),
            }
        )
    )
    reviews = _documents_as_reviews(t)
    _, kept = jobs.linked_reviews(reviews, products)
    copies = reviews.groupBy("parent_asin", F.col("text").alias("review_text")).agg(n_rows().alias("copies"))
    one = kept.groupBy("parent_asin", "review_text").agg(n_rows().alias("kept"))
    return one.join(copies, ["parent_asin", "review_text"]).select(
        "review_text", "parent_asin", "kept", "copies"
    )
