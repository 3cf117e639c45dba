"""Table readers. Schemas are declared, never inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starsift.functions import patterns as P
from starsift.sources import schemas as S

_CSV = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}
COPIES_PER_TASK = 1_000_000


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Quoted CSV with a header; a quoted value may hold line breaks, and an empty value, quoted or not, is null."""
    return spark.read.schema(schema).options(**_CSV).csv(path)


def read_table(spark: SparkSession, path_or_table: str, schema: str | None = None) -> DataFrame:
    """A Parquet path, or a catalog table where the name holds no slash."""
    if "/" not in path_or_table:
        return spark.table(path_or_table)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path_or_table)


def load_reviews(spark: SparkSession, source: str, local_csv: bool = True) -> DataFrame:
    """De-duplicated linked reviews from CSV or from the warehouse, by switch."""
    if local_csv:
        return read_csv(spark, source, S.LINKED_REVIEWS)
    return read_table(spark, source)


def labelled_titles(df: DataFrame) -> DataFrame:
    return df.select("title", "label").where(F.col("title").isNotNull() & F.col("label").isNotNull())


def catalogue(df: DataFrame, categories: Sequence[str] = P.CATALOGUE_CATEGORIES) -> DataFrame:
    """Titled products of the listed main categories, six columns."""
    return df.select(
        "main_category", "title", "parent_asin", "average_rating", "rating_number", "price"
    ).where(F.col("title").isNotNull() & F.col("main_category").isin(*categories))


def with_row_id(df: DataFrame, copies_per_task: int = COPIES_PER_TASK) -> DataFrame:
    """Add a unique, repeatable `row_id`: a digest of the row and its occurrence number.

    Equal rows are counted and numbered where they were counted; only rows
    repeated more than `copies_per_task` times are cut into blocks, which are
    spread over many tasks.
    """
    columns = df.columns
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    parts = [
        F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in columns
    ]
    keyed = counted.select(*columns, F.sha2(F.concat_ws("\x1f", *parts), 256).alias("_digest"), "_n")
    few = keyed.where(F.col("_n") <= copies_per_task).withColumn("_from", F.lit(1).cast("bigint"))
    blocks = (
        keyed.where(F.col("_n") > copies_per_task)
        .withColumn("_from", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"), F.lit(copies_per_task))))
        .repartition("_digest", "_from")
        .withColumn("_n", F.least(F.col("_from") + (copies_per_task - 1), F.col("_n")))
    )
    numbered = few.unionByName(blocks).select(*columns, "_digest", F.explode(F.sequence("_from", "_n")).alias("_copy"))
    return numbered.select(F.concat_ws("-", "_digest", F.col("_copy").cast("string")).alias("row_id"), *columns)


def labelled_sentences(df: DataFrame, text: str = "sentence_for_model") -> DataFrame:
    """Rows with a sentence, each with a unique `row_id`."""
    return with_row_id(df.where(F.col(text).isNotNull()))


def required_columns(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """The sentence columns, plus `row_id` and the extras that exist; an error if one is missing."""
    missing = [c for c in S.SENTENCE_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    ids = ["row_id"] if "row_id" in df.columns else []
    return df.select(*ids, *S.SENTENCE_COLUMNS, *[c for c in extra if c in df.columns])


def lean_reviews(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Columns of the sentence job, reviews with text only, numbered from 1.

    `order` is a unique key. Numbers follow the digest order of that key, in
    which every prefix bucket is small, so no task ever orders the whole table.
    """
    from starsift.operators.running import dense_ids

    columns = [
        "parent_asin", "product_title", "category", "brand", "price_tier", "price",
        "average_rating", "rating_number", "rating", "review_text",
    ]
    kept = [c for c in columns if c in df.columns]
    lean = df.where(F.col("review_text").isNotNull()).select(
        *kept, *[c for c in order if c not in kept]
    )
    return dense_ids(lean, order, "review_id").select("review_id", *kept)
