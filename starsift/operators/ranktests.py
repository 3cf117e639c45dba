"""Correlation and rank tests on frequency tables.

The reviews are folded to one row per distinct value before anything is
ordered, and every test is a sum over that table.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsift.functions.tails import chi_square_p, normal_upper_p, t_two_sided_p
from starsift.operators.profile import null_safe_corr
from starsift.operators.running import present, running_counts

#: A value is common when it holds more than 1/COMMON of all pairs; so at most COMMON values are.
COMMON = 1024


def _correlation_result(r: DataFrame, name: str) -> DataFrame:
    """Add the t statistic and two-sided p of a correlation held in `name`, with `n` pairs."""
    c, dof = F.col(name), F.col("n") - 2
    t = F.when(F.abs(c) >= 1, F.signum(c) * F.lit(float("inf"))).otherwise(
        c * F.sqrt(F.try_divide(dof.cast("double"), (1 + c) * (1 - c)))
    )
    return r.withColumn("t_stat", t).withColumn("p_value", t_two_sided_p("t_stat", dof))


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    one = df.agg(
        null_safe_corr(F.col(x), F.col(y)).alias("pearson_r"), F.count(F.when(both, 1)).alias("n")
    )
    return _correlation_result(one, "pearson_r")


def _midranks(pairs: DataFrame, value: str, name: str) -> DataFrame:
    """Centred mid-rank of every distinct value of one side of the pair table, and its share of the pairs as `_salts`.

    A value with k / COMMON of all pairs gets k + 1 salts (rounded down), any other one.
    """
    ranked = running_counts(pairs, value, {"w": F.sum("n"), "p": F.count(F.lit(1))})
    return ranked.select(
        F.col("value").alias(value),
        (F.col("w_before") + (F.col("w") - F.col("w_total")) / 2).alias(name),
        (F.floor(F.col("p") * COMMON / F.col("p_total")) + 1).alias("_salts"),
    )


def _attach_rank(pairs: DataFrame, ranks: DataFrame, value: str, other: str) -> DataFrame:
    """Join ranks on a value that may be very common: a common value's pairs are spread over salts in proportion to
    their number, and its rank is copied once for each; other values are not copied.
    """
    common = ranks.where(F.col("_salts") > 1).select(value, "_salts")
    # at most COMMON rows
    salted = pairs.join(F.broadcast(common), value, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(other), F.coalesce("_salts", F.lit(1)))
    )
    spread = ranks.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_salts") - 1)))
    return salted.drop("_salts").join(spread.drop("_salts"), [value, "_salt"]).drop("_salt")


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson correlation of mid-ranks over rows where both values are known."""
    values = df.select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    pairs = (
        present(present(values, "_x"), "_y")
        .groupBy("_x", "_y")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    with_x = _attach_rank(pairs, _midranks(pairs, "_x", "rx"), "_x", "_y")
    ranked = _attach_rank(with_x, _midranks(pairs, "_y", "ry"), "_y", "_x")
    n, rx, ry = F.col("n"), F.col("rx"), F.col("ry")
    one = ranked.agg(
        F.try_divide(F.sum(n * rx * ry), F.sqrt(F.sum(n * rx * rx)) * F.sqrt(F.sum(n * ry * ry))).alias(
            "spearman_rho"
        ),
        F.sum(n).alias("n"),
    )
    return _correlation_result(one, "spearman_rho")


def nonlinearity(df: DataFrame, x: str, y: str, factor: float = 1.1) -> DataFrame:
    """Both correlations, and whether the rank one is clearly the stronger."""
    p = pearson(df, x, y).select("pearson_r").scalar()
    return (
        spearman(df, x, y)
        .select("spearman_rho", "n")
        .withColumn("pearson_r", p)
        .withColumn("nonlinear", F.abs("spearman_rho") > F.abs("pearson_r") * factor)
    )


def level_counts(df: DataFrame, value: str, group: str, levels: Sequence[str]) -> DataFrame:
    """One row per distinct value: count of each label and its count of smaller values."""
    kept = df.where(F.col(group).isin(*levels))
    return running_counts(
        kept,
        value,
        {f"n{i}": F.count(F.when(F.col(group) == level, 1)) for i, level in enumerate(levels)},
    )


def _total(parts: list[Column]) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out


def kruskal_wallis(df: DataFrame, value: str, group: str, levels: Sequence[str]) -> DataFrame:
    """Tie-corrected H, its p value and the eta-squared effect size."""
    k = range(len(levels))
    ranked = level_counts(df, value, group, levels)
    tied = _total([F.col(f"n{i}") for i in k]).cast("double")
    rank = _total([F.col(f"n{i}_before") for i in k]) + (tied + 1) / 2
    sums = ranked.agg(
        *[F.sum(F.col(f"n{i}") * rank).alias(f"r{i}") for i in k],
        *[F.sum(f"n{i}").alias(f"m{i}") for i in k],
        F.sum(tied * tied * tied - tied).alias("ties"),
    )
    n = _total([F.col(f"m{i}") for i in k]).cast("double")
    spread = _total(
        [F.coalesce(F.try_divide(F.col(f"r{i}") * F.col(f"r{i}"), F.col(f"m{i}")), F.lit(0.0)) for i in k]
    )
    groups = _total([(F.col(f"m{i}") > 0).cast("int") for i in k])
    h = F.try_divide(
        12 / (n * (n + 1)) * spread - 3 * (n + 1), 1 - F.col("ties") / (n * n * n - n)
    )
    return (
        sums.select(h.alias("h"), groups.alias("k"), n.cast("long").alias("n"))
        .withColumn("eta_sq", F.try_divide(F.col("h") - F.col("k") + 1, F.col("n") - F.col("k")))
        .withColumn("p_value", chi_square_p("h", F.col("k") - 1))
    )


def mann_whitney(
    df: DataFrame,
    value: str,
    group: str,
    levels: Sequence[str],
    pairs: Sequence[tuple[int, int]] | None = None,
    alternative: str = "two-sided",
    cut: float = 0.05,
    absolute_effect: bool = False,
) -> DataFrame:
    """U, normal-approximation p and rank-biserial effect of label pairs, all pairs in one job.

    U of a pair is a sum over distinct values of count_a * (smaller b + half
    the equal b), so no row of one label ever meets a row of the other.
    """
    chosen = list(pairs) if pairs is not None else list(combinations(range(len(levels)), 2))
    ranked = level_counts(df, value, group, levels)

    def d(name: str) -> Column:
        return F.col(name).cast("double")

    # sizes come from the running totals, so that both sides of their join use all counts
    aggregates = [F.max(d(f"n{i}_total")).alias(f"m{i}") for i in range(len(levels))]
    for a, b in chosen:
        t = d(f"n{a}") + d(f"n{b}")
        aggregates.append(
            F.sum(d(f"n{a}") * (d(f"n{b}_before") + d(f"n{b}") / 2)).alias(f"u_{a}_{b}")
        )
        aggregates.append(F.sum(t * t * t - t).alias(f"ties_{a}_{b}"))
    one = ranked.agg(*aggregates)
    rows = one.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(levels[a]).alias("group_a"),
                        F.lit(levels[b]).alias("group_b"),
                        F.col(f"m{a}").alias("n_a"),
                        F.col(f"m{b}").alias("n_b"),
                        F.col(f"u_{a}_{b}").alias("u"),
                        F.col(f"ties_{a}_{b}").alias("ties"),
                    )
                    for a, b in chosen
                ]
            )
        )
    )
    n = F.col("n_a") + F.col("n_b")
    product = F.col("n_a") * F.col("n_b")
    spread = F.sqrt(product / 12 * (n + 1 - F.try_divide(F.col("ties"), n * (n - 1))))
    u = F.greatest(F.col("u"), product - F.col("u")) if alternative == "two-sided" else F.col("u")
    z = F.try_divide(u - product / 2 - 0.5, spread)
    tails = 2 if alternative == "two-sided" else 1
    effect = 1 - F.try_divide(2 * F.col("u"), product)
    return (
        rows.withColumn("z", z)
        .withColumn("_tail", normal_upper_p("z"))
        .select(
            "group_a",
            "group_b",
            F.col("n_a").cast("long").alias("n_a"),
            F.col("n_b").cast("long").alias("n_b"),
            "u",
            "z",
            # with every value tied there is no spread and nothing to reject
            F.when(product > 0, F.least(F.coalesce(tails * F.col("_tail"), F.lit(1.0)), F.lit(1.0))).alias(
                "p_value"
            ),
            (F.abs(effect) if absolute_effect else effect).alias("effect"),
        )
        .withColumn("significant", F.col("p_value") < cut)
    )


def adjacent_pairs(levels: Sequence[str]) -> list[tuple[int, int]]:
    return [(i, i + 1) for i in range(len(levels) - 1)]
