"""Joins that build the review table, duplicate handling and text exclusion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starsift.session import cut_lineage

BROADCAST_BYTES = 64 << 20
ROW_BYTES = 32
REVIEW_KEY = ("parent_asin", "review_title", "review_text")


def link_reviews(reviews: DataFrame, products: DataFrame, key: str = "parent_asin") -> DataFrame:
    """Reviews with the attributes of their product, titles and text renamed.

    No hint: a small product table is broadcast by size, a large one is
    sort-merge joined and adaptive execution splits hot products.
    """
    r = reviews.withColumnsRenamed({"title": "review_title", "text": "review_text"})
    labels = [c for c in ("title_class", "brand") if c in products.columns]
    p = products.select(
        key, F.col("title").alias("product_title"), "price", "average_rating", "rating_number",
        "main_category", *labels,
    )
    return r.join(p, key)


def duplicate_groups(df: DataFrame, key: Sequence[str] = REVIEW_KEY) -> DataFrame:
    """Keys that occur more than once, most frequent first."""
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("cnt"))
        .where("cnt > 1")
        .orderBy(F.desc("cnt"), *key)
    )


def first_per_key(
    df: DataFrame, key: Sequence[str], order: Sequence[str | Column] | None = None
) -> DataFrame:
    """One row per key, the first in a total order (all other columns by default).

    The `row_number = 1` filter is pushed below the shuffle as a group limit,
    so each task sends at most one row per key however often a key repeats.
    """
    by = list(order) if order else [c for c in df.columns if c not in key]
    w = Window.partitionBy(*key).orderBy(*by)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def keep_listed(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def drop_listed(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_anti")


def broadcast_if_small(df: DataFrame, text: str, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The table marked for broadcast when its measured text is small, else as it is."""
    size = df.agg(F.coalesce(F.sum(F.octet_length(text) + F.lit(ROW_BYTES)), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= max_bytes else df


def drop_same_text(df: DataFrame, other: DataFrame, text: str, other_text: str) -> DataFrame:
    """Rows whose text equals no text of the other table; compared by digest, then in full.

    The distinct other texts are stored and measured first. A small list goes to
    every task, so the texts stay where they are; a large one is joined on the
    digest, where adaptive execution splits a digest that very many rows share.
    """
    left = df.withColumn("_d", F.xxhash64(text))
    listed = (
        other.where(F.col(other_text).isNotNull()).select(F.col(other_text).alias("_other")).distinct()
    )
    right = broadcast_if_small(cut_lineage(listed), "_other").withColumn("_d", F.xxhash64("_other"))
    same = (left["_d"] == right["_d"]) & (left[text] == right["_other"])
    return left.join(right, same, "left_anti").drop("_d")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def stack_rows(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union by column name; columns a table lacks are null."""
    out = first
    for df in others:
        out = out.unionByName(df, allowMissingColumns=True)
    return out
