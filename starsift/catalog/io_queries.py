"""Sources and sinks: the given tables written as the files and tables a user has, and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from starsift.catalog import sql as Q
from starsift.catalog.registry import query, rounded
from starsift.catalog.sql import ctes, rnd
from starsift.catalog.tables import BASE, Tables
from starsift.functions.textclean import clean_text
from starsift.operators import text as X
from starsift.session import cut_lineage, shared_folder
from starsift.sources import readers, schemas, writers

CATEGORIES = ("en", "de", "fr")


def _target(t: Tables, name: str) -> str:
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


def _written_csv(t: Tables, df, name: str) -> str:
    target = _target(t, name)
    writers.save_sentences(df, target, as_csv=True)
    return target


# --- A1-A3: inputs ---------------------------------------------------------------------

# texts with quotes, commas, blanks at both ends, line breaks and nulls; an empty title of a CSV file is no title
A01 = """SELECT source AS parent_asin, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE CAST(doc_id % 5 AS DOUBLE) END AS rating,
  CASE WHEN doc_id % 7 > 1 THEN ' "' || lang || '", no. ' || doc_id || ' ' END AS review_title,
  replace(text, chr(13), '') || chr(10) || '"end", ' AS review_text, doc_id * 1000 AS timestamp, doc_id % 2 = 0 AS verified_purchase
FROM documents"""


@query("a01_load_reviews", A01)
def _(t: Tables):
    i, number = F.col("doc_id"), F.col("doc_id").cast("string")
    title = F.concat(F.lit(' "'), "lang", F.lit('", no. '), number, F.lit(" "))
    reviews = t.read("documents").select(
        F.col("source").alias("parent_asin"),
        F.when(i % 5 != 0, (i % 5).cast("double")).alias("rating"),
        F.when(i % 7 == 1, "").when(i % 7 != 0, title).alias("review_title"),
        F.concat(F.replace("text", F.lit("\r"), F.lit("")), F.lit('\n"end", ')).alias("review_text"),
        (i * 1000).alias("timestamp"),
        (i % 2 == 0).alias("verified_purchase"),
        F.lit("product").alias("product_title"),
        F.lit(1.5).alias("price"),
        F.lit(None).cast("double").alias("average_rating"),
        F.lit(None).cast("long").alias("rating_number"),
        F.lit("all").alias("main_category"),
    )
    read = readers.load_reviews(t.spark, _written_csv(t, reviews, "reviews"))
    return read.select("parent_asin", "rating", "review_title", "review_text", "timestamp", "verified_purchase")


@query(
    "a02_labelled_titles",
    """SELECT replace(text, chr(13), '') AS title, CAST(quality AS INTEGER) AS label FROM documents JOIN labels USING (doc_id)
    WHERE doc_id % 4 <> 0 AND doc_id % 3 <> 0""",
)
def _(t: Tables):
    i = F.col("doc_id")
    titles = t.read("labels").join(t.read("documents"), "doc_id").select(
        F.when(i % 4 != 0, F.replace("text", F.lit("\r"), F.lit(""))).alias("title"),
        F.when(i % 3 != 0, F.col("quality")).cast("int").alias("label"),
    )
    return readers.labelled_titles(readers.read_csv(t.spark, _written_csv(t, titles, "titles"), schemas.LABELLED_TITLES))


def _products(t: Tables):
    i = F.col("doc_id")
    return t.read("documents").select(
        F.when(i % 9 != 0, F.col("lang")).alias("main_category"),
        F.when(i % 4 != 0, F.col("source")).alias("title"),
        i.cast("string").alias("parent_asin"),
        (i % 5 / 2).cast("double").alias("average_rating"),
        F.col("n_chars").cast("long").alias("rating_number"),
        F.when(i % 3 != 0, i / 4).alias("price"),
    )


PRODUCTS = """SELECT CASE WHEN doc_id % 9 <> 0 THEN lang END AS main_category, CASE WHEN doc_id % 4 <> 0 THEN source END AS title,
  CAST(doc_id AS VARCHAR) AS parent_asin, doc_id % 5 / 2e0 AS average_rating, CAST(n_chars AS BIGINT) AS rating_number,
  CASE WHEN doc_id % 3 <> 0 THEN doc_id / 4e0 END AS price FROM documents"""


@query(
    "a03_catalogue",
    f"SELECT * FROM ({PRODUCTS}) WHERE title IS NOT NULL AND main_category IN ('en', 'de', 'fr')",
)
def _(t: Tables):
    target = _target(t, "products")
    writers.replace_table(_products(t).withColumn("more", F.lit(1)), target)
    return readers.catalogue(readers.read_table(t.spark, target), CATEGORIES)


# --- A7-A10: outputs -------------------------------------------------------------------


@query(
    "a07_scored_products",
    f"""SELECT * EXCLUDE (p), p AS prob_digital, CAST(p >= 0.7e0 AS INTEGER) AS pred_label
    FROM (SELECT *, CAST(parent_asin AS BIGINT) * 37 % 100 / 100e0 AS p FROM ({PRODUCTS}))""",
)
def _(t: Tables):
    p = F.col("parent_asin").cast("long") * 37 % 100 / 100
    scored = _products(t).withColumn("prob_digital", p).withColumn("pred_label", (p >= 0.7).cast("int"))
    target = _target(t, "scored")
    # rows of an earlier run are replaced, not kept beside the new ones
    writers.replace_table(scored.where("pred_label = 1"), target)
    writers.replace_table(scored, target)
    return readers.read_table(t.spark, target, f"{schemas.PRODUCTS}, prob_digital double, pred_label int")


@query("a08_replaced_table", "SELECT doc_id, lang, n_chars FROM documents WHERE lang <> 'en'")
def _(t: Tables):
    docs = t.read("documents").select("doc_id", "lang", "n_chars")
    name = f"starsift_{uuid.uuid4().hex}"
    try:
        writers.replace_table(docs.select("doc_id"), name)
        writers.replace_table(docs.where("lang <> 'en'"), name)
        return cut_lineage(readers.load_reviews(t.spark, name, local_csv=False))
    finally:
        t.spark.sql(f"DROP TABLE IF EXISTS {name}")


@query(
    "a09_prepared_table",
    BASE + f"SELECT order_key, line_no, year, price_tier, {rnd('price')} AS price, category, brand FROM pr WHERE year >= 1998",
)
def _(t: Tables):
    target = _target(t, "prepared")
    writers.save_prepared(t.prepared, target)
    # only the folders of the wanted years are read
    recent = readers.read_table(t.spark, target).where("year >= 1998")
    return rounded(recent.select("order_key", "line_no", "year", "price_tier", "price", "category", "brand"), "price")


@query(
    "a10_sentence_files",
    ctes(f"cb AS (SELECT item_id, {Q.clean('text')} AS text FROM benchmark)")
    + f"""SELECT item_id, CAST(i - 1 AS INTEGER) AS sentence_no, ss[i] AS sentence FROM (
      SELECT item_id, ss, unnest(range(1, len(ss) + 1)) AS i FROM (
        SELECT item_id, list_filter({Q.sentences('text')}, lambda s: s <> '') AS ss FROM cb))
    WHERE length({Q.strip_spaces('ss[i]')}) > 5""",
)
def _(t: Tables):
    cleaned = t.read("benchmark").select("item_id", clean_text(F.col("text")).alias("text"))
    sentences = X.explode_sentences(cleaned, "text").select("item_id", "sentence_no", "sentence")
    target = _written_csv(t, sentences, "sentences")
    return readers.read_csv(t.spark, target, "item_id bigint, sentence_no int, sentence string")
