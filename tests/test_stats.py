"""Tests of hypothesis against closed forms and brute force."""

import itertools
import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from starsift.functions import tails
from starsift.operators import clean, contingency, ranktests, ttest


def test_normal_tail():
    assert tails.normal_upper([0.0, 1.959963984540054, -1.0]) == pytest.approx([0.5, 0.025, 0.8413447460685429])


def test_t_tail_closed_forms():
    t = np.array([0.0, 0.5, 1.0, 2.0, 12.706204736])
    assert tails.t_two_sided(t, 1) == pytest.approx(1 - 2 / math.pi * np.arctan(t), abs=1e-12)
    assert tails.t_two_sided(t, 2) == pytest.approx(1 - t / np.sqrt(2 + t * t), abs=1e-12)
    assert tails.t_two_sided(np.array([2.042272456]), 30) == pytest.approx([0.05], abs=1e-9)
    assert tails.t_two_sided(np.array([math.inf, -math.inf]), 9) == pytest.approx([0, 0])
    assert np.isnan(tails.t_two_sided(np.array([math.nan]), 9)).all()


def test_t_tail_large_counts():
    z = np.array([0.3, 1.5, 4.0])
    assert tails.t_two_sided(z, 1e9) == pytest.approx(2 * tails.normal_upper(z), rel=1e-6)
    assert tails.t_two_sided([1.9], [1e12]) == pytest.approx(2 * tails.normal_upper([1.9]), abs=1e-9)
    assert tails.t_two_sided(z, math.inf) == pytest.approx(2 * tails.normal_upper(z), rel=1e-15)
    below, above = tails.t_two_sided(z, 99_999.999), tails.t_two_sided(z, 100_000.0)
    assert below == pytest.approx(above, rel=1e-9)


def test_tails_run_to_convergence():
    # at its mean a chi-square law of many degrees has a tail near one half
    assert tails.chi_square_upper([1e9 + 2], [1e9]) == pytest.approx([0.5], abs=1e-4)
    assert tails.chi_square_upper([math.inf], [3]) == pytest.approx([0.0])


def test_t_tail_ends_for_every_row():
    rng = np.random.default_rng(6)
    begin = time.monotonic()
    counts = rng.integers(5_000, 50_000, 10_000)
    many = tails.t_two_sided(3 * rng.standard_normal(10_000), counts)
    mixed = tails.t_two_sided(2 * rng.standard_cauchy(100_000), np.exp(rng.uniform(0, np.log(1e5), 100_000)))
    assert time.monotonic() - begin < 10 and np.isfinite(many).all() and ((mixed >= 0) & (mixed <= 1)).all()
    t, dof = np.linspace(0.01, 12, 300), np.full(300, 2_000.0)
    assert tails.t_two_sided(t, dof) == pytest.approx(2 * tails.normal_upper(tails._normal_point(t, dof)), rel=1e-9)


def test_chi_square_tail():
    x = np.array([0.1, 1.0, 3.841458820694124, 30.0, 200.0])
    assert tails.chi_square_upper(x, 1) == pytest.approx(2 * tails.normal_upper(np.sqrt(x)), rel=1e-9)
    assert tails.chi_square_upper(x, 2) == pytest.approx(np.exp(-x / 2), rel=1e-9)
    assert tails.chi_square_upper(x, 4) == pytest.approx(np.exp(-x / 2) * (1 + x / 2), rel=1e-9)


def two(spark, a, b):
    return spark.createDataFrame([("a", float(v)) for v in a] + [("b", float(v)) for v in b], "g string, v double")


def brute_u(a, b):
    return sum((x > y) + 0.5 * (x == y) for x, y in itertools.product(a, b))


@pytest.mark.parametrize(
    "a, b",
    [([1, 2, 2, 5], [2, 3]), ([1], [2]), ([5, 6], [1, 2]), ([3, 3], [3, 3, 3]), ([1, 4, 4, 4, 9], [0, 4, 10])],
)
def test_mann_whitney(spark, a, b):
    r = ranktests.mann_whitney(two(spark, a, b), "v", "g", ("a", "b")).first()
    u = brute_u(a, b)
    assert r["u"] == u
    assert r["effect"] == pytest.approx(1 - 2 * u / (len(a) * len(b)))
    n1, n2 = len(a), len(b)
    counts = np.unique(np.array(a + b), return_counts=True)[1].astype(float)
    n = n1 + n2
    s2 = n1 * n2 / 12 * (n + 1 - (counts**3 - counts).sum() / (n * (n - 1)))
    if s2 == 0:
        assert r["z"] is None and r["p_value"] == 1.0
    else:
        z = (max(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / math.sqrt(s2)
        assert r["p_value"] == pytest.approx(min(1.0, math.erfc(z / math.sqrt(2))))


def test_empty_group_gives_no_verdict(spark):
    r = ranktests.mann_whitney(two(spark, [1, 2], []), "v", "g", ("a", "b")).first()
    assert (r["n_a"], r["n_b"], r["p_value"], r["significant"]) == (2, 0, None, None)


def test_kruskal_of_two_groups_is_squared_z(spark):
    a, b = [1, 2, 2, 5, 7], [2, 3, 8, 8]
    df = two(spark, a, b)
    h = ranktests.kruskal_wallis(df, "v", "g", ("a", "b")).first()
    n1, n2 = len(a), len(b)
    counts = np.unique(np.array(a + b), return_counts=True)[1].astype(float)
    n = n1 + n2
    s2 = n1 * n2 / 12 * (n + 1 - (counts**3 - counts).sum() / (n * (n - 1)))
    z = (brute_u(a, b) - n1 * n2 / 2) / math.sqrt(s2)
    assert h["h"] == pytest.approx(z * z)
    assert h["p_value"] == pytest.approx(math.erfc(abs(z) / math.sqrt(2)))


def test_kruskal_all_tied(spark):
    assert ranktests.kruskal_wallis(two(spark, [3, 3], [3]), "v", "g", ("a", "b")).first()["h"] is None


def midranks(v):
    v = np.asarray(v, float)
    return np.array([(v < x).sum() + ((v == x).sum() + 1) / 2 for x in v])


def test_spearman_with_ties_missing_and_a_hot_value(spark):
    x = [1, 1, 1, 1, 1, 2, 3, 9, None, 4]
    y = [5, 4, 4, 8, 1, 2, 2, 0, 3, None]
    df = spark.createDataFrame(
        [(None if a is None else float(a), None if b is None else float(b)) for a, b in zip(x, y)],
        "x double, y double",
    )
    keep = [(a, b) for a, b in zip(x, y) if a is not None and b is not None]
    want = np.corrcoef(midranks([a for a, _ in keep]), midranks([b for _, b in keep]))[0, 1]
    got = ranktests.spearman(df, "x", "y").first()
    assert got["spearman_rho"] == pytest.approx(want) and got["n"] == 8


def test_perfect_and_constant_correlation(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 1.0) for i in range(5)], "x double, y double, c double")
    assert ranktests.spearman(df, "x", "y").first()["p_value"] == pytest.approx(0.0, abs=1e-9)
    assert ranktests.pearson(df, "x", "y").first()["p_value"] == pytest.approx(0.0, abs=1e-9)
    assert ranktests.pearson(df, "x", "c").first()["pearson_r"] is None
    assert ranktests.spearman(df, "x", "c").first()["spearman_rho"] is None


def cells(spark, table):
    rows = [(r, c) for (r, c), n in table.items() for _ in range(n)]
    return contingency.contingency(spark.createDataFrame(rows, "r string, c string"), "r", "c")


def test_two_by_two_uses_yates(spark):
    t = {("a", "x"): 12, ("a", "y"): 5, ("b", "x"): 6, ("b", "y"): 9}
    got = contingency.chi_square(cells(spark, t), "r", "c").first()
    n, det = 32, 12 * 9 - 5 * 6
    want = n * (abs(det) - n / 2) ** 2 / (17 * 15 * 18 * 14)
    assert got["dof"] == 1 and got["chi2"] == pytest.approx(want)
    assert got["cramers_v"] == pytest.approx(math.sqrt(want / n))


def test_empty_cell_counts_as_zero(spark):
    t = {("a", "x"): 4, ("a", "y"): 2, ("b", "x"): 3, ("c", "x"): 1, ("c", "y"): 5}
    table = cells(spark, t)
    assert table.count() == 6
    o = np.array([[4, 2], [3, 0], [1, 5]], float)
    e = o.sum(1, keepdims=True) * o.sum(0, keepdims=True) / o.sum()
    got = contingency.chi_square(table, "r", "c").first()
    assert got["chi2"] == pytest.approx(((o - e) ** 2 / e).sum()) and got["dof"] == 2
    r = {(x["r"], x["c"]): x for x in contingency.residuals(table).collect()}
    assert r["b", "y"]["n"] == 0 and r["b", "y"]["std_resid"] == pytest.approx(-math.sqrt(e[1, 1]))


def test_keyword_never_mentioned_has_no_result(spark):
    df = spark.createDataFrame(
        [("pre-COVID", "zoom"), ("post-COVID", "no"), ("during-COVID", "x"), ("unknown", "zoom")],
        "covid_period string, review_text string",
    )
    keywords = {"zoom": r"\bzoom\b", "never": r"\bnever\b"}
    flagged = clean.with_keyword_flags(df, keywords)
    got = {r["keyword"]: r for r in contingency.keyword_chi_square(flagged, keywords).collect()}
    assert got["zoom"]["n"] == 3 and got["zoom"]["dof"] == 2
    assert not got["never"]["significant"]


def products(spark, spec):
    rows = []
    for asin, (ratings, listed, number) in spec.items():
        rows += [(asin, i, None if i == 0 else "brand", float(r), listed, number) for i, r in enumerate(ratings)]
    return spark.createDataFrame(
        rows, "parent_asin string, i int, brand string, rating double, average_rating double, rating_number long"
    )


def test_product_t_tests(spark):
    df = products(
        spark,
        {
            "few": ([1.0] * 29, 4.0, 1000),
            "all": ([1.0, 2.0] * 15, 4.0, 30),
            "flat_low": ([2.0] * 30, 4.0, 31),
            "flat_high": ([5.0] * 30, 4.0, 31),
            "flat_same": ([4.0] * 30, 4.0, 31),
            "mixed": ([3.0, 5.0] * 20, 4.0, 100),
            "harsh": ([1.0, 2.0, 1.0] * 20, 4.0, 100),
        },
    )
    got = {r["parent_asin"]: r for r in ttest.product_t_tests(df, ["i"]).collect()}
    assert set(got) == {"flat_low", "flat_high", "flat_same", "mixed", "harsh"}
    assert got["harsh"]["brand"] == "brand"
    assert got["flat_low"]["t_stat"] == -math.inf and got["flat_low"]["is_harsher"]
    assert got["flat_high"]["t_stat"] == math.inf and got["flat_high"]["is_lenient"]
    same = got["flat_same"]
    assert same["t_stat"] is None and not (same["is_harsher"] or same["is_lenient"] or same["no_diff"])
    assert got["mixed"]["no_diff"] and got["mixed"]["p_value"] == 1.0
    ratings = np.array([1.0, 2.0, 1.0] * 20)
    t = (ratings.mean() - 4) / (ratings.std(ddof=1) / math.sqrt(60))
    assert got["harsh"]["t_stat"] == pytest.approx(t)
    summary = ttest.verdict_summary(ttest.product_t_tests(df, ["i"])).first()
    assert (summary["total_products"], summary["harsher_products"], summary["lenient_products"]) == (5, 2, 1)


def test_density_integrates_to_one(spark):
    df = spark.range(40).select(
        F.col("id").cast("string").alias("parent_asin"),
        F.lit(False).alias("is_harsher"),
        F.lit(False).alias("is_lenient"),
        F.lit(True).alias("no_diff"),
        (F.col("id") / 100).alias("gap"),
    )
    rows = ttest.gap_density(df, margin=1.0).orderBy("x").collect()
    x, d = np.array([r["x"] for r in rows]), np.array([r["density"] for r in rows])
    assert len(rows) == 300 and np.trapezoid(d, x) == pytest.approx(1.0, abs=1e-3)
    assert ttest.gap_density(df.limit(4)).count() == 0
