"""A corpus made ready for training: toxic documents out, exact and near copies out, mixed to weights, encoded."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starsift.llm.common import new_folder, read_table, stored, with_ids
from starsift.llm.content_sort import first_of_groups
from starsift.llm.curriculum import copies, mix_plan, word_count
from starsift.llm.severity import fit_severity, without_toxic
from starsift.llm.shingle_join import Likeness, linked_groups
from starsift.llm.word_codec import digests, encode_decode

#: Five-word shingles, similarity of 0.8 or more.
NEAR = Likeness(words=5, percent=80)
TOKENIZER = "word_bpe_49k.json"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model fitted on the labels does not call toxic, less those that a label itself calls toxic.

    Without usable labels all stay. Null and empty texts and rows without an id stay unless labelled; repeated rows fare
    alike; an empty table stays empty.
    """
    labels = read_table(spark, sf_dir, "labels")
    kept = without_toxic(docs, fit_severity(docs, labels))
    known = labels.filter("toxic > 0").select(F.col("doc_id").cast("long").alias("doc_id")).dropna().distinct()
    return with_ids(kept, known, how="left_anti").select(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for blanks, the longest and then the smallest id stays; null and empty texts are equal."""
    return first_of_groups(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by likeness the one of smallest id stays; empty texts and null ids are linked with nothing."""
    groups = linked_groups(docs, NEAR)
    gone = stored(groups.filter("component_id <> doc_id").select("doc_id").distinct())
    return with_ids(docs, gone, how="left_anti").select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order.

    The copy at which a source reaches its target stays whole if half of its words or more are taken, else it goes; so
    a source misses its target by half a document at most. Rows that share an id and a size get the same copies.
    """
    mark = "_"
    while any(c.startswith(mark) for c in docs.columns):
        mark += "_"
    key, size, copy, at, words = (mark + c for c in ("id", "size", "copy", "at", "words"))
    taken = copies(mix_plan(docs)).filter("words > 0 and 2 * words >= size")
    taken = taken.groupBy(F.col("doc_id").alias(key), F.col("size").alias(size), F.col("copy").alias(copy)).agg(F.min("position").alias(at))
    same = F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(words) == F.col(size))
    rows = docs.withColumn(words, word_count(F.col("text"))).join(taken, same)
    return rows.repartitionByRange(at, key, copy).sortWithinPartitions(at, key, copy).select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the digests of ids and decoded text of every row."""
    coded = encode_decode(docs, public_tokenizers.path(TOKENIZER))
    return digests(coded, "ids")


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_copies),
    ("near_duplicates", near_copies),
    ("mixing", mixture),
    ("bpe", encoding),
]

#: A fitted model decides in the first stage; SQL cannot state its rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written and read again as the next one's documents."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        folder = new_folder(spark)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.schema(docs.schema).parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
