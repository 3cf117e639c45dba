"""Repeatable, exact splits and samples by hash order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsift.operators.running import hash_cuts, order_hash

SEED = 42


def _cut_positions(shares: Mapping[str, float]) -> dict[str, Column]:
    positions, covered = {}, 0.0
    for name, share in list(shares.items())[:-1]:
        covered += share
        positions[f"_cut_{name}"] = F.floor(F.lit(covered) * F.col("size") + F.lit(0.5))
    return positions


def stratified_split(
    df: DataFrame,
    key: Sequence[str],
    strata: Sequence[str],
    shares: Mapping[str, float],
    seed: int = SEED,
    column: str = "split",
) -> DataFrame:
    """Label rows so that every stratum is divided in the given shares, to the nearest row.

    Rows are never moved: each is compared with its stratum's cut digests, one
    small row per stratum. The last share takes the rest. `key` must be unique.
    """
    hashed = df.withColumn("_h", order_hash(key, seed))
    positions = _cut_positions(shares)
    cuts = hash_cuts(hashed, "_h", positions, strata)
    if strata:
        same = F.lit(True)
        for s in strata:
            same = same & F.col(f"l.{s}").eqNullSafe(F.col(f"c.{s}"))
        # one row per stratum label
        hashed = (
            hashed.alias("l")
            .join(F.broadcast(cuts).alias("c"), same)
            .select("l.*", *[F.col(f"c.{p}") for p in positions])
        )
        cut = {p: F.col(p) for p in positions}
    else:
        only = cuts.select(F.struct(*positions)).scalar()
        cut = {p: only.getField(p) for p in positions}
    names = list(shares)
    label = None
    for name, p in zip(names, positions):
        below = F.col("_h") <= cut[p]
        label = F.when(below, name) if label is None else label.when(below, name)
    return hashed.withColumn(column, label.otherwise(names[-1])).drop("_h", *positions)


def sample_rows(df: DataFrame, key: Sequence[str], n: int, seed: int = SEED) -> DataFrame:
    """Exactly `n` rows (all of them when there are fewer), without ordering the table."""
    hashed = df.withColumn("_h", order_hash(key, seed))
    cut = hash_cuts(hashed, "_h", {"cut": F.least(F.lit(n), F.col("size"))}).select("cut").scalar()
    return hashed.where(F.col("_h") <= cut).drop("_h")


def shuffled(df: DataFrame, key: Sequence[str], seed: int = SEED) -> DataFrame:
    """The rows in a repeatable random order (a distributed range sort)."""
    return df.withColumn("_h", order_hash(key, seed)).orderBy("_h", *key).drop("_h")


def splits_overlap(df: DataFrame, key: Sequence[str], split: str = "split") -> DataFrame:
    """Keys that occur in more than one split; empty when the splits are disjoint."""
    return (
        df.groupBy(*key)
        .agg(F.min(split).alias("first_split"), F.max(split).alias("last_split"))
        .where(F.col("first_split") != F.col("last_split"))
    )
