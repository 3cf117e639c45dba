"""Exact duplicates by sorting content: sampled splitters, external sort, comparison of neighbours."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starsift.llm.common import BLANKS, id_and_text, stored, with_ids
from starsift.session import cut_lineage

#: Rows read for the splitters (about); the result does not depend on them.
SAMPLE_ROWS = 8192
#: Characters of the content at the head of the sort key; a hash of the whole content follows.
KEY_CHARS = 32


def splitters_of(sample: list[str], ranges: int) -> tuple[list[str], dict[str, int]]:
    """Distinct splitters of a sorted sample, and the keys that fill several ranges with how many they fill."""
    ordered = sorted(sample)
    picked = [ordered[len(ordered) * i // ranges] for i in range(1, ranges)] if ordered else []
    times = Counter(picked)
    return sorted(times), {k: n for k, n in times.items() if n > 1}


def range_of(key: Column, splitters: list[str]) -> Column:
    """How many splitters are at or below the key, by two short searches."""
    if not splitters:
        return F.lit(0)
    width = max(1, math.isqrt(len(splitters)))
    blocks = [splitters[i : i + width] for i in range(0, len(splitters), width)]
    heads = F.array(*[F.lit(b[0]) for b in blocks[1:]]) if len(blocks) > 1 else F.array().cast("array<string>")
    block = F.size(F.filter(heads, lambda s: s <= key))
    inside = F.element_at(F.array(*[F.array(*map(F.lit, b)) for b in blocks]), block + 1)
    return block * width + F.size(F.filter(inside, lambda s: s <= key))


def normalised(text: Column) -> Column:
    """The text without blanks; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{BLANKS}]+", "")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of rows whose texts are equal once blanks are deleted; one row per input row.

    Columns: doc_id, keep_id, group_size, kept, text_sha256. The row with the most code points in its original text
    stays, then the smallest id. Null texts count as empty; null ids come last; of repeated rows one is kept; an empty
    table gives no rows; other columns are not read.

    A bounded sample gives splitters. Rows go to ranges of the normalised content and are sorted there, each row is
    compared whole with the one before it, and equal neighbours make a run. A content that fills several ranges of
    the sample is dealt over as many parts by id; the runs of its parts are put together by digest, one row per run.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col).select(
        "doc_id",
        F.coalesce(F.length("text"), F.lit(0)).alias("points"),
        normalised(F.col("text")).alias("content"),
    )
    digits = F.lpad(F.hex(F.xxhash64("content")), 16, "0")
    rows = rows.withColumn("key", F.concat(F.substring("content", 1, KEY_CHARS), digits))

    total = docs.count()
    share = min(1.0, SAMPLE_ROWS / max(total, 1))
    sample = [r.key for r in rows.sample(share, seed=17).select("key").collect()]
    ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    splitters, heavy = splitters_of(sample, ranges)
    parts = F.lit(1)
    if heavy:
        table = F.create_map(*[F.lit(x) for pair in heavy.items() for x in pair])
        parts = F.coalesce(F.element_at(table, F.col("key")), F.lit(1))
    placed = rows.withColumn("range", range_of(F.col("key"), splitters)).withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "points"), parts).cast("int")
    )

    content_order = Window.partitionBy("range", "part").orderBy("key", "content", "doc_id", "points")
    compared = placed.select(
        "range", "part", "doc_id", "points",
        F.row_number().over(content_order).alias("place"),
        F.lag("content").over(content_order).eqNullSafe(F.col("content")).alias("same"),
        F.sha2("content", 256).alias("text_sha256"),
    )
    # the number of the run, from the places at which the content changed
    in_place = Window.partitionBy("range", "part").orderBy("place")
    runs = compared.withColumn("run", F.sum(F.when(F.col("same"), 0).otherwise(1)).over(in_place))
    # ascending in what stays: most code points, a known id, the smallest one, the first place
    standing = F.struct(
        "points", F.col("doc_id").isNotNull().alias("known"), F.bitwise_not("doc_id").alias("low"),
        (-F.col("part")).alias("part"), (-F.col("place")).alias("place"),
    )
    placed_runs = cut_lineage(runs.select("range", "part", "run", "doc_id", "text_sha256", standing.alias("standing")))

    per_run = placed_runs.groupBy("range", "part", "run").agg(
        F.max("standing").alias("best"), F.count(F.lit(1)).alias("n"), F.first("text_sha256").alias("text_sha256")
    )
    groups = cut_lineage(per_run.groupBy("text_sha256").agg(F.max("best").alias("best"), F.sum("n").alias("group_size")))
    return placed_runs.join(groups, "text_sha256").select(
        "doc_id",
        F.bitwise_not("best.low").alias("keep_id"),
        "group_size",
        (F.col("standing") == F.col("best")).alias("kept"),
        "text_sha256",
    )


def first_of_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, with all their columns, that stay of each group.

    Rows are picked by id. Ids that several rows carry, and null ids, are looked up by their text's digest as well.
    """
    groups = stored(exact_groups(docs, id_col, text_col))
    several = groups.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 or doc_id is null").select("doc_id")
    key = F.col(id_col)
    if several.isEmpty():
        gone = groups.filter("not kept").select(F.col("doc_id").alias(id_col))
        return with_ids(docs, gone, id_col, "left_anti")
    plain = groups.join(several, groups["doc_id"].eqNullSafe(several["doc_id"]), "left_anti").filter("kept")
    out = with_ids(docs, plain.select(F.col("doc_id").alias(id_col)), id_col).select(*docs.columns)
    odd = several.withColumnRenamed("doc_id", "_odd")
    rows = docs.join(odd, key.eqNullSafe(F.col("_odd")))
    rows = rows.withColumn("_digest", F.sha2(normalised(F.col(text_col)), 256))
    longest = Window.partitionBy(id_col, "_digest").orderBy(F.desc_nulls_last(F.length(text_col)))
    rows = rows.withColumn("_place", F.row_number().over(longest)).filter("_place = 1")
    kept = groups.filter("kept").select(F.col("doc_id").alias("_kept"), F.col("text_sha256").alias("_kept_digest")).distinct()
    same = key.eqNullSafe(F.col("_kept")) & (F.col("_digest") == F.col("_kept_digest"))
    return out.unionByName(rows.join(kept, same, "left_semi").select(*docs.columns))
