"""Running totals, exact quantiles and exact hash cuts over columns of any size.

All three need a global order, which a plain ordered window gives only by
moving every row into one task. Here the column is cut into buckets that follow
its order. Bucket totals are a small table (its size has a fixed bound), so the
running total over buckets is cheap, and the remaining work is a window inside
each bucket. A bucket first spans a fixed share of the value's size; where many
distinct values lie closer than that, it is split again at values drawn from
the column. The draw depends on the set of values alone, so a lost executor
recomputes the same buckets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RESOLUTION = 1024
_BUCKET_CEILING = 1_000_000
#: Hash cells of the draw of distinct values: one is drawn from each.
CELLS = 4096
#: A bucket that holds this many of the drawn values, a hundredth of them, is split at them.
CROWDED = CELLS // 100
HASH_PREFIX = 4


def value_bucket(value: Column, resolution: int = RESOLUTION) -> Column:
    """Integer that never decreases as the value grows.

    It spans about 1/resolution of the value's size (1/resolution near zero).
    ln(largest double) * 1024 is under the ceiling, so a column has at most two
    million of them whatever it holds.
    """
    size = F.least(F.floor(F.log1p(F.abs(value)) * resolution), F.lit(_BUCKET_CEILING))
    return (F.signum(value) * size).cast("long")


def crowded_values(df: DataFrame, value: str, groups: Sequence[str] = ()) -> Column:
    """A scalar struct: `buckets`, the value buckets that hold many distinct values, and `cuts`, values drawn from those.

    Values (with their group labels, where given) are hashed into cells, and the
    value of the smallest hash is drawn from each: a uniform draw of distinct
    values that is merged from partial draws, reads the rows once, shuffles at
    most `CELLS` rows a task and gives the same values on every run. Both arrays
    ascend and are bounded: 100 buckets, `CELLS` cuts.
    """
    h = F.xxhash64(*groups, value)
    drawn = df.groupBy(F.pmod(h, F.lit(CELLS)).alias("_cell")).agg(F.min_by(value, h).alias("_cut"))
    per_bucket = drawn.groupBy(value_bucket(F.col("_cut")).alias("_k")).agg(F.collect_set("_cut").alias("_cuts"))
    return (
        per_bucket.where(F.size("_cuts") >= CROWDED)
        .agg(
            F.struct(
                F.sort_array(F.collect_list("_k")).alias("buckets"),
                F.sort_array(F.flatten(F.collect_list("_cuts"))).alias("cuts"),
            )
        )
        .scalar()
    )


def _cuts_below(value: Column, cuts: Column) -> Column:
    """How many of the ascending `cuts` lie below the value, found by halving."""
    steps = F.array(*[F.lit(1 << k) for k in range(CELLS.bit_length(), -1, -1)])
    # the value goes in as an argument: an attribute held only by a lambda escapes the optimiser's own checks
    start = F.struct(F.lit(0).alias("at"), value.alias("v"))

    def halve(now: Column, step: Column) -> Column:
        after = now["at"] + step
        at = F.when(F.get(cuts, after - 1) < now["v"], after).otherwise(now["at"])
        return F.struct(at.alias("at"), now["v"].alias("v"))

    return F.aggregate(steps, start, halve, lambda now: now["at"])


def with_bucket(df: DataFrame, value: str, groups: Sequence[str] = ()) -> DataFrame:
    """Add `_b`, an integer that never decreases as the value grows and is never null.

    However close the values lie, a bucket holds about a hundredth of the
    distinct values at most; only rows of crowded buckets look for their cut.
    """
    first = value_bucket(F.col(value))
    # a column first, as a subquery may not stand inside a lambda; the optimiser puts it back in place
    crowd = F.col("_crowd")
    among = F.when(F.array_contains(crowd["buckets"], first), _cuts_below(F.col(value), crowd["cuts"])).otherwise(0)
    bucket = F.coalesce(first * (2 * CELLS) + among, F.lit(0))
    return df.withColumn("_crowd", crowded_values(df, value, groups)).withColumn("_b", bucket).drop("_crowd")


def present(df: DataFrame, value: str, groups: Sequence[str] = ()) -> DataFrame:
    """Rows where the value and every group label are known."""
    kept = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    for g in groups:
        kept = kept.where(F.col(g).isNotNull())
    return kept


def running_counts(
    df: DataFrame, value: str, counts: Mapping[str, Column], groups: Sequence[str] = ()
) -> DataFrame:
    """One row per distinct value: each count, its total over smaller values, and its grand total.

    `counts` maps a name to an aggregate (`F.count(...)`, `F.sum(...)`). For
    every name `n` the result holds `n`, `n_before` and `n_total`.
    """
    groups = list(groups)
    names = list(counts)
    freq = (
        present(df, value, groups)
        .groupBy(*groups, F.col(value).cast("double").alias("value"))
        .agg(*[counts[n].alias(n) for n in names])
    )
    freq = with_bucket(freq, "value", groups)
    per_bucket = freq.groupBy(*groups, "_b").agg(*[F.sum(n).alias(f"_{n}") for n in names])
    # bounded: about two million bucket rows per group
    ahead = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    offsets = per_bucket.select(
        *groups,
        "_b",
        *[F.coalesce(F.sum(f"_{n}").over(ahead), F.lit(0)).alias(f"_{n}_offset") for n in names],
        *[F.sum(f"_{n}").over(whole).alias(f"{n}_total") for n in names],
    )
    inside = (
        Window.partitionBy(*groups, "_b").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    )
    ranked = freq.select(
        "*", *[F.coalesce(F.sum(n).over(inside), F.lit(0)).alias(f"_{n}_inside") for n in names]
    )
    return ranked.join(offsets, [*groups, "_b"]).select(
        *groups,
        "value",
        *names,
        *[(F.col(f"_{n}_offset") + F.col(f"_{n}_inside")).alias(f"{n}_before") for n in names],
        *[f"{n}_total" for n in names],
    )


def _interpolate(low: Column, high: Column, share: Column) -> Column:
    gap = high - low
    return F.when(share >= 0.5, high - gap * (1 - share)).otherwise(low + gap * share)


def exact_quantiles(
    df: DataFrame,
    value: str,
    quantiles: Mapping[str, float],
    groups: Sequence[str] = (),
    few_groups: bool = True,
) -> DataFrame:
    """Linearly interpolated quantiles, one row per group (one row in all without groups).

    The first pass looks for crowded buckets, the second counts rows per bucket, the
    third keeps only the buckets that hold a wanted position and orders those. With `few_groups` the kept
    bucket list has at most two rows per quantile and label, so it is
    broadcast; otherwise it is joined on the group key like any table.
    """
    groups = list(groups)
    rows = with_bucket(present(df, value, groups).select(*groups, F.col(value).cast("double").alias("_v")), "_v", groups)
    per_bucket = rows.groupBy(*groups, "_b").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    spans = per_bucket.select(
        *groups,
        "_b",
        "_n",
        F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_start"),
        F.sum("_n").over(Window.partitionBy(*groups)).alias("_total"),
    )

    def place(share: float) -> Column:
        return F.lit(float(share)) * (F.col("_total") - 1)

    wanted = F.array(*[f(place(p)) for p in quantiles.values() for f in (F.floor, F.ceil)])
    kept = spans.where(
        F.exists(wanted, lambda k: (k >= F.col("_start")) & (k < F.col("_start") + F.col("_n")))
    ).select(*groups, "_b", "_start", "_total")
    near = (
        rows.join(F.broadcast(kept) if few_groups else kept, [*groups, "_b"])
        .groupBy(*groups, "_b", "_start", "_total", "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    inside = (
        Window.partitionBy(*groups, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = near.withColumn("_at", F.col("_start") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))

    def value_at(k: Column) -> Column:
        return F.max(F.when((k >= F.col("_at")) & (k < F.col("_at") + F.col("_n")), F.col("_v")))

    ends = placed.groupBy(*groups).agg(
        F.max("_total").alias("_total"),
        *[value_at(F.floor(place(p))).alias(f"_lo_{n}") for n, p in quantiles.items()],
        *[value_at(F.ceil(place(p))).alias(f"_hi_{n}") for n, p in quantiles.items()],
    )
    return ends.select(
        *groups,
        *[
            _interpolate(
                F.col(f"_lo_{n}"), F.col(f"_hi_{n}"), place(p) - F.floor(place(p))
            ).alias(n)
            for n, p in quantiles.items()
        ],
    )


def with_quantiles(
    df: DataFrame,
    value: str,
    quantiles: Mapping[str, float],
    column: str = "_q",
    source: DataFrame | None = None,
) -> DataFrame:
    """Add the quantiles of a whole column as one struct, evaluated once per query.

    It is a column of its own, so any number of uses share one subquery.
    """
    row = exact_quantiles(df if source is None else source, value, quantiles)
    return df.withColumn(column, row.select(F.struct(*quantiles)).scalar())


def order_hash(key: Sequence[str], seed: int) -> Column:
    """Repeatable pseudo-random order of rows: a digest of the seed and the key."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))


def hash_cuts(
    df: DataFrame,
    hash_column: str,
    positions: Mapping[str, Column],
    strata: Sequence[str] = (),
    few_strata: bool = True,
) -> DataFrame:
    """Per stratum the digest found at each wanted 1-based position of the hash order.

    Keeping rows whose digest is at or below a cut keeps exactly that many
    rows. `positions` are expressions over `size`, the rows in the stratum; a
    position outside 1..size gives a null cut. Digest prefixes split even one
    huge stratum into 65,536 equal buckets, and only the buckets holding a cut
    are ever ordered. With `few_strata` that bucket list has at most one row
    per position and label and is broadcast.
    """
    strata = list(strata)
    prefix = F.substring(hash_column, 1, HASH_PREFIX)
    rows = df.select(*strata, F.col(hash_column).alias("_h"), prefix.alias("_b"))
    per_bucket = rows.groupBy(*strata, "_b").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy(*strata).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    spans = per_bucket.select(
        *strata,
        "_b",
        "_n",
        F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_start"),
        F.sum("_n").over(Window.partitionBy(*strata)).alias("size"),
    )
    names = list(positions)
    spans = spans.select("*", *[positions[n].cast("long").alias(f"_p_{n}") for n in names])
    holds = F.lit(False)
    for n in names:
        p = F.col(f"_p_{n}")
        holds = holds | ((p > F.col("_start")) & (p <= F.col("_start") + F.col("_n")))
    first = spans.groupBy(*strata).agg(F.max("size").alias("size"))
    kept = spans.where(holds).drop("_n", "size")
    inside = Window.partitionBy(*strata, "_b").orderBy("_h")
    null_safe = [F.col(f"r.{s}").eqNullSafe(F.col(f"k.{s}")) for s in strata]
    condition = F.col("r._b") == F.col("k._b")
    for extra in null_safe:
        condition = condition & extra
    placed = (
        rows.alias("r")
        .join((F.broadcast(kept) if few_strata else kept).alias("k"), condition)
        .select(
            *[F.col(f"r.{s}").alias(s) for s in strata],
            F.col("r._b").alias("_b"),
            F.col("r._h").alias("_h"),
            F.col("k._start").alias("_start"),
            *[F.col(f"k._p_{n}").alias(f"_p_{n}") for n in names],
        )
        .withColumn("_rank", F.col("_start") + F.row_number().over(inside))
    )
    cuts = placed.groupBy(*strata).agg(
        *[F.max(F.when(F.col("_rank") == F.col(f"_p_{n}"), F.col("_h"))).alias(n) for n in names]
    )
    if not strata:
        return cuts
    same = F.lit(True)
    for s in strata:
        same = same & F.col(f"f.{s}").eqNullSafe(F.col(f"c.{s}"))
    return (
        first.alias("f")
        .join(cuts.alias("c"), same, "left")
        .select(*[F.col(f"f.{s}").alias(s) for s in strata], *[F.col(f"c.{n}") for n in names])
    )


def dense_ids(df: DataFrame, key: Sequence[str], column: str, seed: int = 0) -> DataFrame:
    """Number the rows 1..n in the digest order of a unique key.

    Digest prefixes give 65,536 equal buckets; rows are numbered inside a
    bucket and shifted by the rows of the buckets before it.
    """
    hashed = df.withColumn("_h", order_hash(key, seed)).withColumn(
        "_b", F.substring("_h", 1, HASH_PREFIX)
    )
    per_bucket = hashed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_bucket.select("_b", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_b").orderBy("_h", *key)
    # 65,536 rows at most
    return (
        hashed.join(F.broadcast(starts), "_b")
        .withColumn(column, F.col("_start") + F.row_number().over(inside))
        .drop("_h", "_b", "_start")
    )
