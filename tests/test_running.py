"""Quantiles, running totals and hash cuts against brute force."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starsift.operators import splits
from starsift.operators.running import dense_ids, exact_quantiles, running_counts, with_bucket

VALUES = st.lists(
    st.one_of(
        st.floats(-1e6, 1e6, allow_nan=False), st.integers(-50, 50).map(float), st.none()
    ),
    min_size=1,
    max_size=40,
)
FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


@FEW
@given(VALUES)
def test_quantiles_match_numpy(spark, values):
    known = [v for v in values if v is not None]
    wanted = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.975, "e": 1.0}
    rows = exact_quantiles(frame(spark, values), "x", wanted).collect()
    if not known:
        assert all(v is None for r in rows for v in r)
        return
    for name, q in wanted.items():
        assert rows[0][name] == pytest.approx(np.quantile(known, q), rel=1e-12, abs=1e-12)


@FEW
@given(VALUES)
def test_running_counts_match_brute_force(spark, values):
    known = [v + 0.0 for v in values if v is not None]
    rows = running_counts(frame(spark, values), "x", {"n": F.count(F.lit(1))}).collect()
    assert len(rows) == len(set(known))
    for r in rows:
        assert r["n"] == sum(v == r["value"] for v in known)
        assert r["n_before"] == sum(v < r["value"] for v in known)
        assert r["n_total"] == len(known)


def test_bucket_follows_order(spark):
    values = sorted(
        [0.0, 1e-300, -1e-300, 1e308, -1e308, math.inf, -math.inf]
        + [s * 10.0**e for e in range(-5, 12) for s in (-3, -1, 1, 2.5)]
    )
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = with_bucket(df, "x").orderBy("x").collect()
    assert [r["_b"] for r in rows] == sorted(r["_b"] for r in rows)
    assert with_bucket(df.where("x > 1e300 and x < 0"), "x").count() == 0


def test_buckets_of_close_values_stay_small(spark):
    # a million values within 1/1024 of each other, and one far away
    df = spark.range(1_000_000).select((5 + F.col("id") * 1e-9).alias("x")).unionAll(spark.sql("SELECT -1e300D"))
    counted = with_bucket(df, "x").groupBy("_b").agg(F.count(F.lit(1)).alias("n"))
    largest, n = counted.agg(F.max("n"), F.count(F.lit(1))).first()
    assert largest < 10_000 and n > 3000
    got = exact_quantiles(df, "x", {"m": 0.5}).first()["m"]
    assert got == pytest.approx(5 + 499_999 * 1e-9, rel=1e-12)
    again = with_bucket(df.repartition(5), "x").groupBy("_b").agg(F.count(F.lit(1)).alias("n"))
    assert sorted(again.collect()) == sorted(counted.collect())


def test_buckets_are_shared_by_many_groups(spark):
    # every group has values of its own range, so no group may fall into one bucket
    df = spark.range(200_000).select((F.col("id") % 2).alias("g"), (F.col("id") % 2 * 1000 + F.col("id") * 1e-9).alias("x"))
    counted = with_bucket(df, "x", ["g"]).groupBy("g", "_b").count()
    assert counted.agg(F.max("count")).first()[0] < 2_000


def test_groups_and_unknown_labels(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 3.0), ("b", 5.0), (None, 9.0), ("b", None)], "g string, x double"
    )
    got = {r["g"]: r["m"] for r in exact_quantiles(df, "x", {"m": 0.5}, ["g"]).collect()}
    assert got == {"a": 2.0, "b": 5.0}
    same = exact_quantiles(df, "x", {"m": 0.5}, ["g"], few_groups=False)
    assert {r["g"]: r["m"] for r in same.collect()} == got


def test_one_hot_value(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 < 2, 7.0).otherwise(F.col("id") * 0.01).alias("x")
    )
    values = [7.0 if i % 3 < 2 else i * 0.01 for i in range(20000)]
    got = exact_quantiles(df, "x", {"q1": 0.25, "q2": 0.5, "q3": 0.9}).first()
    assert [got["q1"], got["q2"], got["q3"]] == pytest.approx(np.quantile(values, [0.25, 0.5, 0.9]))


def digest(key, seed=42):
    return hashlib.md5(f"{seed}|{key}".encode()).hexdigest()


def test_split_is_exact_repeatable_and_independent_of_partitions(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 10 < 8, "hot").otherwise("cold").alias("s"))
    shares = {"train": 0.7, "val": 0.15, "test": 0.15}
    rows = splits.stratified_split(df, ["id"], ["s"], shares).collect()
    again = splits.stratified_split(df.repartition(5, "s"), ["id"], ["s"], shares).collect()
    assert sorted(rows) == sorted(again)
    for label, size in (("hot", 2400), ("cold", 600)):
        by = [r["split"] for r in rows if r["s"] == label]
        assert [by.count(n) for n in shares] == [round(size * 0.7), round(size * 0.15), round(size * 0.15)]
        ids = sorted((r["id"] for r in rows if r["s"] == label), key=digest)
        assert {r["id"] for r in rows if r["s"] == label and r["split"] == "train"} == set(
            ids[: round(size * 0.7)]
        )


def test_split_keeps_rows_without_stratum_and_tiny_strata(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x")], "id long, s string")
    rows = splits.stratified_split(df, ["id"], ["s"], {"train": 0.5, "test": 0.5}).collect()
    assert sorted(r["id"] for r in rows) == [1, 2, 3]


def test_sample_size(spark):
    df = spark.range(500).toDF("id")
    assert splits.sample_rows(df, ["id"], 120).count() == 120
    assert splits.sample_rows(df, ["id"], 9999).count() == 500
    chosen = {r["id"] for r in splits.sample_rows(df, ["id"], 120).collect()}
    assert chosen == set(sorted(range(500), key=digest)[:120])


def test_dense_ids(spark):
    rows = dense_ids(spark.range(700).toDF("id"), ["id"], "n").collect()
    assert sorted(r["n"] for r in rows) == list(range(1, 701))


def test_overlap(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "id int, split string")
    assert [r["id"] for r in splits.splits_overlap(df, ["id"]).collect()] == [1]
