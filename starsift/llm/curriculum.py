"""Mixing sources to target weights along a curriculum of changing weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starsift.llm.common import BLANKS

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: How each weight runs over the training: its share at the beginning and at the end, straight between.
SCHEDULES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
#: Words of the mix over words of all sources, and how often a document may be taken.
SHARE, MOST = 1.5, 2
#: Slices of a source's digest order; each is summed on its own.
SLICE_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{BLANKS}]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, share: float = SHARE, most: int = MOST, weights=WEIGHTS, schedules=SCHEDULES) -> DataFrame:
    """Adds weight, target, begin and end to rows (source, source_size), one per source.

    The mix holds `share` of all words, dealt by weight; a target stops at `most` times its source and the excess
    goes to the others by weight until none is above. In the order of size per weight the stopped sources come
    first, so the level of the others follows from running sums.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    turn = (F.row_number().over(by_name) - 1) % len(weights) + 1
    rows = sizes.withColumn("turn", turn)
    for name, values in (
        ("weight", [float(w) for w in weights]),
        ("begin", [float(a) for a, _ in schedules]),
        ("end", [float(b) for _, b in schedules]),
    ):
        rows = rows.withColumn(name, F.element_at(F.array(*map(F.lit, values)), F.col("turn")))
    rows = rows.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    level_order = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    budget = F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share))
    before = F.coalesce(F.sum("cap").over(level_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(level_order.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("level", (budget - before) / rest).withColumn("place", F.row_number().over(level_order))
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    level = F.min(F.when(fits, F.struct("place", "level"))).over(Window.partitionBy())
    rows = rows.withColumn("chosen", level)
    stopped = F.col("chosen").isNull() | (F.col("place") < F.col("chosen.place"))
    target = F.when(stopped, F.col("cap")).otherwise(F.col("chosen.level") * F.col("weight"))
    return rows.select("source", "source_size", "weight", "begin", "end", target.alias("target"))


def position(share_done: Column, begin: Column, end: Column) -> Column:
    """When a source has given this share of its target: the inverse of its integrated weight."""
    mean = (begin + end) / 2
    root = F.sqrt(begin * begin + (end - begin) * 2 * share_done * mean)
    return F.when(share_done > 0, share_done * 2 * mean / (begin + root)).otherwise(F.lit(0.0))


def mix_plan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", share: float = SHARE,
    most: int = MOST, weights=WEIGHTS, schedules=SCHEDULES,
) -> DataFrame:
    """How much of every document the mix takes, and where its copies stand in the training.

    Columns: doc_id, source, size, source_size, target, taken, first_offset (words its source gives before it in a
    pass), passes (whole passes over the source), position (of its first copy, 0 to 1; null if not taken), begin and end.

    A source's documents stand in the order of a digest of their id. The mix passes over them until the target is
    reached, so each source gives its target to the word: a pass that stops inside a document takes its first words.
    Running sums add slices of the digest order first, so a source may hold any share of the rows. Null texts have
    size 0, a null source is a source of its own, repeated rows count each, an empty table gives no rows, other columns
    are not read.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"),
    )
    rows = rows.withColumn("digest", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = rows.withColumn("slice", F.substring("digest", 1, SLICE_DIGITS))
    slices = rows.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    targets = source_targets(
        slices.groupBy("source").agg(F.sum("slice_size").alias("source_size")), share, most, weights, schedules
    )
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(
        "source", "slice", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0).cast("long")).alias("slice_offset")
    )

    named = targets.withColumnRenamed("source", "target_source")
    facts = offsets.join(named, F.col("source").eqNullSafe(F.col("target_source"))).drop("target_source")
    facts = facts.withColumnRenamed("source", "slice_source").withColumnRenamed("slice", "source_slice")
    same = F.col("source").eqNullSafe(F.col("slice_source")) & (F.col("slice") == F.col("source_slice"))
    placed = rows.join(facts, same).drop("slice_source", "source_slice")
    in_slice = Window.partitionBy("source", "slice").orderBy("digest", "doc_id", "size")
    within = F.sum("size").over(in_slice.rowsBetween(Window.unboundedPreceding, -1))
    wanted = F.floor(F.col("target") + 0.5).cast("long")
    size_known = F.greatest(F.col("source_size"), F.lit(1).cast("long"))
    placed = (
        placed.withColumn("first_offset", F.col("slice_offset") + F.coalesce(within, F.lit(0).cast("long")))
        .withColumn("wanted", wanted)
        .withColumn("passes", F.floor(F.col("wanted") / size_known).cast("long"))
    )
    left = F.col("wanted") - F.col("passes") * F.col("source_size") - F.col("first_offset")
    taken = F.col("passes") * F.col("size") + F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), left))
    placed = placed.withColumn("taken", taken)
    done = F.col("first_offset") / F.greatest(F.col("wanted"), F.lit(1).cast("long"))
    first = F.when(F.col("taken") > 0, position(done, F.col("begin"), F.col("end")))
    return placed.withColumn("position", first).select(
        "doc_id", "source", "size", "source_size", "target", "taken", "first_offset", "passes", "wanted", "position",
        "begin", "end",
    )


def in_training_order(plan: DataFrame) -> DataFrame:
    """Rows range-sorted by position, those not taken last."""
    order = [F.asc_nulls_last("position"), F.asc_nulls_last("doc_id")]
    return plan.repartitionByRange(*order).sortWithinPartitions(*order)


def copies(plan: DataFrame) -> DataFrame:
    """One row per copy the mix takes: doc_id, copy from 0, words (all, or the first ones of the last copy), position."""
    whole = F.greatest(F.col("size"), F.lit(1).cast("long"))
    n = F.ceil(F.col("taken") / whole).cast("int")
    each = plan.filter(F.col("taken") > 0).withColumn("copy", F.explode(F.sequence(F.lit(0), n - 1)))
    done = (F.col("copy") * F.col("source_size") + F.col("first_offset")) / F.col("wanted")
    return each.select(
        "doc_id", "source", "size", "copy",
        F.least(F.col("size"), F.col("taken") - F.col("copy") * F.col("size")).alias("words"),
        position(done, F.col("begin"), F.col("end")).alias("position"),
    )
