"""Correlation, rank, chi-square and t-tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from starsift.catalog import sql as Q
from starsift.catalog import tables as V
from starsift.catalog.registry import query, rounded
from starsift.catalog.review_queries import (
    FLAG_BASE,
    POP,
    POP_LABELS,
    QUART,
    popular,
    quartiled,
)
from starsift.catalog.sql import ctes, rnd
from starsift.catalog.tables import PR, REVIEW_ID, Tables
from starsift.functions import patterns as P
from starsift.functions.rounding import round_even
from starsift.operators import clean, contingency, ranktests, summaries, ttest

GROUPS = ("Verified", "Non-verified")
GROUPED = """gr AS (SELECT pr.*, CASE WHEN verified_purchase THEN 'Verified' ELSE 'Non-verified' END AS "group" FROM pr)"""


def _correlation(name: str, r: str, source: str) -> str:
    t = "(r * sqrt((n - 2) / ((1 + r) * (1 - r))))"
    return f"""SELECT {rnd('r')} AS {name}, n, {rnd(t, 4)} AS t_stat, {rnd(Q.t_two_sided(t, '(n - 2)'))} AS p_value
    FROM (SELECT {r} AS r, count(*) AS n FROM {source})"""


def _ranks(source: str, x: str, y: str) -> str:
    def rank(c: str) -> str:
        return f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2e0"

    return f"rk AS (SELECT {rank(x)} AS rx, {rank(y)} AS ry FROM {source} WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"


def _shown(df, name: str):
    return rounded(rounded(df, name, "p_value"), "t_stat", places=4)


# --- correlations --------------------------------------------------------------------


@query(
    "h01_pearson_price_rating",
    ctes(V.RV, PR, "priced AS (SELECT price, rating FROM pr WHERE price > 0)")
    + _correlation("pearson_r", "corr(price, rating)", "priced"),
)
def _(t: Tables):
    priced = t.prepared.where(F.col("price") > 0)
    return _shown(ranktests.pearson(priced, "price", "rating"), "pearson_r")


@query(
    "h02_spearman_price_rating",
    ctes(V.RV, PR, "priced AS (SELECT price, rating FROM pr WHERE price > 0)", _ranks("priced", "price", "rating"))
    + _correlation("spearman_rho", "corr(rx, ry)", "rk"),
)
def _(t: Tables):
    priced = t.prepared.where(F.col("price") > 0)
    return _shown(ranktests.spearman(priced, "price", "rating"), "spearman_rho")


@query(
    "h02_spearman_length_votes",
    ctes(V.RV, PR, V.WITH_LENGTH, _ranks("prl", "review_length", "helpful_vote"))
    + _correlation("spearman_rho", "corr(rx, ry)", "rk"),
)
def _(t: Tables):
    return _shown(ranktests.spearman(t.with_length, "review_length", "helpful_vote"), "spearman_rho")


@query(
    "h02_spearman_rating_votes",
    ctes(V.RV, PR, _ranks("pr", "rating", "helpful_vote")) + _correlation("spearman_rho", "corr(rx, ry)", "rk"),
)
def _(t: Tables):
    return _shown(ranktests.spearman(t.prepared, "rating", "helpful_vote"), "spearman_rho")


@query(
    "h02_spearman_count_rating",
    ctes(
        V.RV,
        PR,
        f"pl AS (SELECT ln(1 + count(rating)) AS x, {rnd('avg(rating)', 9)} AS y FROM pr GROUP BY parent_asin)",
        _ranks("pl", "x", "y"),
    )
    + _correlation("spearman_rho", "corr(rx, ry)", "rk"),
)
def _(t: Tables):
    slim = t.prepared.withColumn("vader_sentiment", F.lit(None).cast("double"))
    products = rounded(summaries.product_level(slim), "avg_rating", places=9)
    return _shown(ranktests.spearman(products, "log_review_count", "avg_rating"), "spearman_rho")


@query(
    "h03_nonlinearity",
    ctes(V.RV, PR, "priced AS (SELECT price, rating FROM pr WHERE price > 0)", _ranks("priced", "price", "rating"))
    + f"""SELECT {rnd('s')} AS spearman_rho, n, {rnd('p')} AS pearson_r, abs(s) > abs(p) * 1.1e0 AS nonlinear
    FROM (SELECT corr(rx, ry) AS s, count(*) AS n FROM rk), (SELECT corr(price, rating) AS p FROM priced)""",
)
def _(t: Tables):
    priced = t.prepared.where(F.col("price") > 0)
    return rounded(ranktests.nonlinearity(priced, "price", "rating"), "spearman_rho", "pearson_r")


# --- Mann-Whitney and Kruskal-Wallis ------------------------------------------------------


def _mw_part(source: str, value: str, group: str, a: str, b: str) -> str:
    """U, ties and sizes of one pair by explicit ranks of the two groups together."""
    return f"""SELECT '{a}' AS group_a, '{b}' AS group_b, count(*) FILTER (g = '{a}') AS n_a, count(*) FILTER (g = '{b}') AS n_b,
      sum(r) FILTER (g = '{a}') - count(*) FILTER (g = '{a}') * (count(*) FILTER (g = '{a}') + 1) / 2e0 AS u,
      sum(CAST(c AS DOUBLE) * c - 1) AS ties
    FROM (SELECT {group} AS g, rank() OVER (ORDER BY {value}) + (count(*) OVER (PARTITION BY {value}) - 1) / 2e0 AS r,
      count(*) OVER (PARTITION BY {value}) AS c FROM {source} WHERE {value} IS NOT NULL AND {group} IN ('{a}', '{b}'))"""


def _mann_whitney(
    source: str, value: str, group: str, levels, pairs, cut: float, two_sided=True, absolute=False
) -> str:
    parts = " UNION ALL ".join(_mw_part(source, value, group, levels[a], levels[b]) for a, b in pairs)
    u = "greatest(u, CAST(n_a AS DOUBLE) * n_b - u)" if two_sided else "u"
    spread = "sqrt(CAST(n_a AS DOUBLE) * n_b / 12 * (n_a + n_b + 1 - ties / (CAST(n_a + n_b AS DOUBLE) * (n_a + n_b - 1))))"
    z = f"(({u} - CAST(n_a AS DOUBLE) * n_b / 2 - 0.5e0) / {spread})"
    p = f"least(1e0, {2 if two_sided else 1} * {Q.normal_upper('z')})"
    effect = "1 - 2 * u / (CAST(n_a AS DOUBLE) * n_b)"
    effect = f"abs({effect})" if absolute else effect
    return f"""SELECT group_a, group_b, n_a, n_b, u, {rnd('z', 5)} AS z, {rnd(p)} AS p_value, {rnd(effect)} AS effect,
      {p} < {cut!r}e0 AS significant FROM (SELECT *, {z} AS z FROM ({parts}))"""


def _mw_shown(df):
    return rounded(rounded(df, "z", places=5), "p_value", "effect")


@query(
    "h04_mann_whitney_purchase",
    ctes(V.RV, PR, GROUPED) + _mann_whitney("gr", "rating", '"group"', GROUPS, [(0, 1)], 0.05),
)
def _(t: Tables):
    grouped = clean.with_purchase_group(t.prepared)
    return _mw_shown(ranktests.mann_whitney(grouped, "rating", "group", GROUPS))


SIDES = ("negative", "positive")
SIDED = """sd AS (SELECT pr.*, CASE WHEN rating <= 2 THEN 'negative' WHEN rating >= 4 THEN 'positive' END AS side FROM pr)"""


def _sided(t: Tables):
    return t.prepared.withColumn(
        "side", F.when(F.col("rating") <= 2, "negative").when(F.col("rating") >= 4, "positive")
    )


@query(
    "h04_votes_negative_vs_positive",
    ctes(V.RV, PR, SIDED) + _mann_whitney("sd", "helpful_vote", "side", SIDES, [(0, 1)], 0.05, two_sided=False),
)
def _(t: Tables):
    return _mw_shown(
        ranktests.mann_whitney(_sided(t), "helpful_vote", "side", SIDES, alternative="greater")
    )


@query(
    "h04_median_votes",
    ctes(V.RV, PR, SIDED)
    + "SELECT side, CAST(median(helpful_vote) AS DOUBLE) AS median_helpful_vote FROM sd WHERE side IS NOT NULL GROUP BY 1",
)
def _(t: Tables):
    return summaries.medians_by(_sided(t), "side", ["helpful_vote"])


ALL3 = [(0, 1), (0, 2), (1, 2)]


@query(
    "h05_pairwise_popularity",
    ctes(V.RV, PR, POP) + _mann_whitney("pop", "rating", "pop_bucket", POP_LABELS, ALL3, 0.017),
)
def _(t: Tables):
    return _mw_shown(
        ranktests.mann_whitney(popular(t.prepared), "rating", "pop_bucket", POP_LABELS, cut=0.017)
    )


@query(
    "h05_adjacent_quartiles",
    ctes(V.RV, PR, QUART)
    + _mann_whitney(
        "quart", "rating", "price_quartile", P.QUARTILE_LABELS, [(0, 1), (1, 2), (2, 3)], 0.0125, absolute=True
    ),
)
def _(t: Tables):
    return _mw_shown(
        ranktests.mann_whitney(
            quartiled(t),
            "rating",
            "price_quartile",
            P.QUARTILE_LABELS,
            ranktests.adjacent_pairs(P.QUARTILE_LABELS),
            cut=0.0125,
            absolute_effect=True,
        )
    )


@query(
    "h05_pairwise_periods",
    ctes(V.RV, PR) + _mann_whitney("pr", "rating", "covid_period", V.PERIODS, ALL3, 0.017, absolute=True),
)
def _(t: Tables):
    return _mw_shown(
        ranktests.mann_whitney(
            t.prepared, "rating", "covid_period", V.PERIODS, cut=0.017, absolute_effect=True
        )
    )


@query(
    "h05_pairwise_price_by_category",
    ctes(V.RV, PR)
    + _mann_whitney("pr", "price", "category", ("desktop", "laptop", "tablet"), ALL3, 0.017),
)
def _(t: Tables):
    return _mw_shown(
        ranktests.mann_whitney(
            t.prepared, "price", "category", ("desktop", "laptop", "tablet"), cut=0.017
        )
    )


def _kruskal(source: str, value: str, group: str) -> str:
    h = "((12 / (n * (n + 1e0)) * s - 3 * (n + 1)) / (1 - ties / (CAST(n AS DOUBLE) * n * n - n)))"
    return f"""SELECT {rnd('h', 5)} AS h, k, n, {rnd('(h - k + 1) / (n - k)')} AS eta_sq,
      {rnd(Q.chi_square_upper('h', '(k - 1)'))} AS p_value FROM (SELECT *, {h} AS h FROM (
        SELECT sum(sr * sr / m) AS s, CAST(count(*) AS INTEGER) AS k, CAST(sum(m) AS BIGINT) AS n, sum(t) AS ties FROM (
          SELECT g, sum(r) AS sr, count(*) AS m, sum(CAST(c AS DOUBLE) * c - 1) AS t FROM (
            SELECT {group} AS g, rank() OVER (ORDER BY {value}) + (count(*) OVER (PARTITION BY {value}) - 1) / 2e0 AS r,
              count(*) OVER (PARTITION BY {value}) AS c FROM {source} WHERE {value} IS NOT NULL AND {group} IS NOT NULL)
          GROUP BY 1)))"""


def _kw_shown(df):
    return rounded(rounded(df, "h", places=5), "eta_sq", "p_value")


@query("h06_kruskal_popularity", ctes(V.RV, PR, POP) + _kruskal("pop", "rating", "pop_bucket"))
def _(t: Tables):
    return _kw_shown(ranktests.kruskal_wallis(popular(t.prepared), "rating", "pop_bucket", POP_LABELS))


@query("h06_kruskal_quartiles", ctes(V.RV, PR, QUART) + _kruskal("quart", "rating", "price_quartile"))
def _(t: Tables):
    return _kw_shown(
        ranktests.kruskal_wallis(quartiled(t), "rating", "price_quartile", P.QUARTILE_LABELS)
    )


@query("h06_kruskal_periods", ctes(V.RV, PR) + _kruskal("pr", "rating", "covid_period"))
def _(t: Tables):
    return _kw_shown(ranktests.kruskal_wallis(t.prepared, "rating", "covid_period", V.PERIODS))


# --- contingency ------------------------------------------------------------------------------


def _sql_cells(source: str, row: str, col: str) -> str:
    return f"""seen AS (SELECT {row} AS r, {col} AS c, count(*) AS n FROM {source}
      WHERE {row} IS NOT NULL AND {col} IS NOT NULL GROUP BY 1, 2),
    grid AS (SELECT r, c FROM (SELECT DISTINCT r FROM seen) a, (SELECT DISTINCT c FROM seen) b),
    cells AS (SELECT r, c, coalesce(n, 0) AS n, sum(coalesce(n, 0)) OVER (PARTITION BY r) AS rt,
      sum(coalesce(n, 0)) OVER (PARTITION BY c) AS ct, sum(coalesce(n, 0)) OVER () AS total
      FROM grid LEFT JOIN seen USING (r, c))"""


EXPECTED = "(rt * CAST(ct AS DOUBLE) / total)"


def _chi(source: str) -> str:
    e = EXPECTED
    term = f"pow(CASE WHEN dof = 1 THEN abs(n - {e}) - least(0.5e0, abs(n - {e})) ELSE n - {e} END, 2) / {e}"
    return f"""SELECT {rnd('chi2', 5)} AS chi2, n, dof, {rnd('sqrt(chi2 / n / least(a, b))')} AS cramers_v,
      {rnd(Q.chi_square_upper('chi2', 'dof'))} AS p_value,
      CASE WHEN {Q.chi_square_upper('chi2', 'dof')} < 0.05 THEN 'Reject H0' ELSE 'Fail to reject H0' END AS conclusion
    FROM (SELECT sum({term}) AS chi2, CAST(sum(n) AS BIGINT) AS n, CAST(any_value(dof) AS INTEGER) AS dof, any_value(a) AS a, any_value(b) AS b FROM (
      SELECT *, (SELECT count(DISTINCT r) - 1 FROM {source}) AS a, (SELECT count(DISTINCT c) - 1 FROM {source}) AS b,
        (SELECT (count(DISTINCT r) - 1) * (count(DISTINCT c) - 1) FROM {source}) AS dof FROM {source}))"""


def _chi_shown(df):
    return rounded(rounded(df, "chi2", places=5), "cramers_v", "p_value")


RATING_TABLE = ctes(V.RV, PR, GROUPED, _sql_cells("gr", '"group"', "rating"))


def _rating_cells(t: Tables):
    return contingency.contingency(clean.with_purchase_group(t.prepared), "group", "rating")


@query(
    "e30_contingency_table",
    RATING_TABLE
    + f"""SELECT r AS "group", c AS rating, n, CAST(rt AS BIGINT) AS row_total, CAST(ct AS BIGINT) AS col_total,
      CAST(total AS BIGINT) AS total, {rnd('n / rt * 100', 2)} AS row_pct FROM cells""",
)
def _(t: Tables):
    return contingency.row_percent(_rating_cells(t))


@query("h07_chi_square_rating", RATING_TABLE + _chi("cells"))
def _(t: Tables):
    return _chi_shown(contingency.chi_square(_rating_cells(t), "group", "rating"))


@query(
    "h07_chi_square_two_by_two",
    ctes(V.RV, PR, GROUPED, "g5 AS (SELECT \"group\", rating = 5 AS five FROM gr)", _sql_cells("g5", '"group"', "five"))
    + _chi("cells"),
)
def _(t: Tables):
    grouped = clean.with_purchase_group(t.prepared)
    cells = contingency.contingency(grouped, "group", "is_5_star")
    return _chi_shown(contingency.chi_square(cells, "group", "is_5_star"))


@query(
    "h07_chi_square_category",
    ctes(V.RV, PR, _sql_cells("pr", "covid_period", "category")) + _chi("cells"),
)
def _(t: Tables):
    cells = contingency.contingency(summaries.known_period(t.prepared), "covid_period", "category")
    return _chi_shown(contingency.chi_square(cells, "covid_period", "category"))


@query(
    "h08_keyword_chi_square",
    FLAG_BASE
    + f"""SELECT keyword, {rnd('chi2', 5)} AS chi2, n, CAST(k - 1 AS INTEGER) AS dof, {rnd('sqrt(chi2 / n)')} AS cramers_v,
      {rnd(Q.chi_square_upper('chi2', '(k - 1)'))} AS p_value, {Q.chi_square_upper('chi2', '(k - 1)')} < 0.001 AS significant
    FROM (SELECT keyword, sum(pow(hits - eh, 2) / eh + pow(hits - eh, 2) / (n - eh)) AS chi2, CAST(sum(n) AS BIGINT) AS n, count(*) AS k
      FROM (SELECT *, n * (sum(hits) OVER w) / (sum(n) OVER w) AS eh FROM (
        SELECT keyword, CAST(n AS DOUBLE) AS n, CAST(hits AS DOUBLE) AS hits FROM hits) WINDOW w AS (PARTITION BY keyword))
      GROUP BY 1)""",
)
def _(t: Tables):
    return _chi_shown(contingency.keyword_chi_square(t.with_flags, V.KEYWORDS))


@query("h09_cramers_v", RATING_TABLE + f"SELECT {rnd('v', 4)} AS cramers_v FROM (SELECT sqrt((sum(pow(n - {EXPECTED}, 2) / {EXPECTED})) / sum(n) / 1e0) AS v FROM cells)")
def _(t: Tables):
    test = contingency.chi_square(_rating_cells(t), "group", "rating")
    return test.select(round_even(F.col("cramers_v"), 4).alias("cramers_v"))


@query(
    "h10_standardised_residuals",
    RATING_TABLE
    + f"""SELECT r AS "group", c AS rating, {rnd(EXPECTED, 4)} AS expected, {rnd(f'(n - {EXPECTED}) / sqrt({EXPECTED})', 5)} AS std_resid FROM cells""",
)
def _(t: Tables):
    out = contingency.residuals(_rating_cells(t)).select("group", "rating", "expected", "std_resid")
    return rounded(rounded(out, "std_resid", places=5), "expected", places=4)


@query(
    "h11_adjusted_residuals",
    RATING_TABLE
    + f"""SELECT r AS "group", c AS rating,
      {rnd(f'(n - {EXPECTED}) / sqrt({EXPECTED} * (1 - rt / CAST(total AS DOUBLE)) * (1 - ct / CAST(total AS DOUBLE)))', 5)} AS adj_resid FROM cells""",
)
def _(t: Tables):
    out = contingency.residuals(_rating_cells(t)).select("group", "rating", "adj_resid")
    return rounded(out, "adj_resid", places=5)


# --- per-product t-tests -----------------------------------------------------------------------

_T = "((m - mu) / (s / sqrt(n)))"
T_TESTS = f"""tt AS (SELECT *, {Q.t_two_sided(_T, '(n - 1)')} AS p, m - mu AS gap, {_T} AS t FROM (
  SELECT parent_asin, any_value(brand) AS brand, count(rating) AS n, avg(rating) AS m, stddev_samp(rating) AS s,
    any_value(average_rating) AS mu, any_value(rating_number) AS rating_number
  FROM pr GROUP BY 1) WHERE n >= 30 AND rating_number > n),
tv AS (SELECT *, p < 0.05 AND t < 0 AS is_harsher, p < 0.05 AND t > 0 AS is_lenient, p >= 0.05 AS no_diff FROM tt)"""


def _t_tests(t: Tables):
    return ttest.product_t_tests(t.prepared, REVIEW_ID)


@query(
    "h12_product_t_tests",
    ctes(V.RV, PR, T_TESTS)
    + f"""SELECT parent_asin, brand, n AS dataset_reviews, {rnd('m')} AS dataset_avg_rating, {rnd('mu')} AS average_rating,
      rating_number, {rnd('gap')} AS gap, {rnd('t', 5)} AS t_stat, {rnd('p')} AS p_value, is_harsher, is_lenient, no_diff FROM tv""",
)
def _(t: Tables):
    out = rounded(_t_tests(t), "dataset_avg_rating", "average_rating", "gap", "p_value")
    return rounded(out, "t_stat", places=5).orderBy("gap", "parent_asin")


@query(
    "e32_verdict_summary",
    ctes(V.RV, PR, T_TESTS)
    + f"""SELECT count(*) AS total_products, CAST(sum(CAST(is_harsher AS INTEGER)) AS BIGINT) AS harsher_products,
      CAST(sum(CAST(is_lenient AS INTEGER)) AS BIGINT) AS lenient_products, CAST(sum(CAST(no_diff AS INTEGER)) AS BIGINT) AS nodiff_products,
      {rnd('avg(CAST(is_harsher AS INTEGER)) * 100', 1)} AS harsher_pct, {rnd('avg(CAST(is_lenient AS INTEGER)) * 100', 1)} AS lenient_pct,
      {rnd('avg(gap)', 3)} AS avg_gap, {rnd('median(t)', 3)} AS median_t_stat, {rnd('median(p)', 4)} AS median_p_value FROM tv""",
)
def _(t: Tables):
    return ttest.verdict_summary(_t_tests(t))


@query(
    "g03_smallest_p",
    ctes(V.RV, PR, T_TESTS)
    + f"SELECT parent_asin, n AS dataset_reviews, {rnd('gap')} AS gap, {rnd('t', 5)} AS t_stat FROM tv ORDER BY p, parent_asin LIMIT 10",
)
def _(t: Tables):
    best = ttest.smallest_p(_t_tests(t), 10)
    out = best.select("parent_asin", "dataset_reviews", "gap", "t_stat")
    return rounded(rounded(out, "gap"), "t_stat", places=5)


@query(
    "h13_gap_density",
    ctes(
        V.RV,
        PR,
        T_TESTS,
        """lab AS (SELECT gap, CASE WHEN is_harsher THEN 'harsher' WHEN is_lenient THEN 'lenient' ELSE 'neutral' END AS verdict FROM tv)""",
        """shape AS (SELECT verdict, count(*) AS n, min(gap) - 0.3e0 AS lo, (max(gap) - min(gap) + 0.6e0) / 299 AS step,
          stddev_samp(gap) * pow(count(*), -0.2e0) AS bw FROM lab GROUP BY 1 HAVING count(*) >= 5)""",
    )
    + f"""SELECT verdict, {rnd('x', 4)} AS x, {rnd('sum(exp(-0.5e0 * pow((x - gap) / bw, 2))) / (any_value(n) * any_value(bw) * sqrt(2 * pi()))', 5)} AS density
    FROM (SELECT verdict, n, bw, i, lo + i * step AS x FROM shape, range(0, 300) r(i)) JOIN lab USING (verdict) GROUP BY verdict, i, x""",
)
def _(t: Tables):
    out = ttest.gap_density(_t_tests(t))
    return rounded(rounded(out, "x", places=4), "density", places=5)


@query(
    "h14_decision",
    RATING_TABLE + f"SELECT conclusion FROM ({_chi('cells')})",
)
def _(t: Tables):
    return contingency.chi_square(_rating_cells(t), "group", "rating").select("conclusion")
