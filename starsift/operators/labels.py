"""Label preparation: pairs, vocabularies, multi-hot vectors, oversampling and weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsift.functions import patterns as P
from starsift.functions.textclean import strip_spaces
from starsift.operators.splits import SEED, shuffled, stratified_split
from starsift.operators.summaries import count_by, in_fixed_order
from starsift.operators.text import accept_rewrite
from starsift.session import cut_lineage

RARE_BELOW = 150
COPIES = 2
MISSING_LABEL = -1.0
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
SHARES = {"train": 0.70, "val": 0.15, "test": 0.15}


def sentence_type(related: Column, technical: Column) -> Column:
    return (
        F.when(related == 0, "unrelated")
        .when((related == 1) & (technical == 0), "general")
        .when((related == 1) & (technical == 1), "technical")
        .otherwise("unknown")
    )


def with_sentence_type(df: DataFrame) -> DataFrame:
    return df.withColumn("sentence_type", sentence_type(F.col("is_related"), F.col("is_technical")))


def _whole_number(text: Column) -> Column:
    """A decimal number cut to its whole part; anything else is null."""
    return F.when(text.rlike(NUMBER), text.try_cast("double").try_cast("int"))


def parse_pairs(
    aspects: Column, sentiments: Column, excluded: Sequence[str] = P.EXCLUDED_ASPECTS
) -> Column:
    """array<struct<aspect, sentiment>> from `a;b` and `1;-1`; unequal lengths give none."""
    names = F.transform(F.split(aspects, ";"), lambda a: F.lower(strip_spaces(a)))
    marks = F.transform(F.split(sentiments, ";"), lambda s: _whole_number(strip_spaces(s)))
    pairs = F.filter(
        F.transform(names, lambda a, i: F.struct(a.alias("aspect"), F.get(marks, i).alias("sentiment"))),
        lambda p: (p["aspect"] != "") & ~p["aspect"].isin(*excluded) & p["sentiment"].isNotNull(),
    )
    aligned = aspects.isNotNull() & sentiments.isNotNull() & (F.size(names) == F.size(marks))
    none = F.array().cast("array<struct<aspect:string,sentiment:int>>")
    return F.when(aligned, pairs).otherwise(none)


def with_pairs(df: DataFrame, excluded: Sequence[str] = P.EXCLUDED_ASPECTS) -> DataFrame:
    """Parsed pairs, their two lists and whether any pair is valid."""
    parsed = df.withColumn(
        "pairs", parse_pairs(F.col("target_aspect"), F.col("target_sentiment"), excluded)
    )
    return parsed.withColumns(
        {
            "aspects_parsed": F.col("pairs.aspect"),
            "sentiments_parsed": F.col("pairs.sentiment"),
            "is_valid_pairs": F.size("pairs") > 0,
        }
    )


def technical_rows(df: DataFrame) -> DataFrame:
    return df.where((F.col("is_related") == 1) & (F.col("is_technical") == 1) & F.col("is_valid_pairs"))


def combo_labels(pairs: Column) -> Column:
    """`aspect_sentiment` labels of a row."""
    return F.transform(
        pairs, lambda p: F.concat_ws("_", p["aspect"], p["sentiment"].cast("string"))
    )


def with_rarest_combo(df: DataFrame, key: str = "row_id") -> DataFrame:
    """The row's least frequent combined label (ties by name), as the stratum for splitting; null without labels.

    Labels are counted and joined to (key, label) rows, of which the rarest one of
    a key remains; how the counts reach them is left to adaptive execution, which
    knows their size. `key` must be unique and not null.
    """
    labelled = df.withColumn("combo_labels", combo_labels(F.col("pairs")))
    held = labelled.select(key, F.explode(F.array_distinct("combo_labels")).alias("combo"))
    counts = held.groupBy("combo").agg(F.count(F.lit(1)).alias("_n"))
    rarest = (
        held.join(counts, "combo")
        .groupBy(key)
        .agg(F.min(F.struct("_n", "combo"))["combo"].alias("rarest_combo"))
    )
    return labelled.join(rarest, key, "left")


def split_technical(
    df: DataFrame, key: str = "row_id", shares: dict[str, float] | None = None, seed: int = SEED
) -> DataFrame:
    """Train/val/test of technical rows, each rarest combined label divided exactly.

    The split reads its rows several times, so they are stored with their label.
    """
    return stratified_split(cut_lineage(with_rarest_combo(df, key)), [key], ["rarest_combo"], shares or SHARES, seed)


def split_rest(
    df: DataFrame, technical: DataFrame, key: str = "row_id",
    shares: dict[str, float] | None = None, seed: int = SEED,
) -> DataFrame:
    """The rows outside the technical set, divided within each relatedness flag."""
    rest = cut_lineage(df.join(technical.select(key), key, "left_anti"))
    return stratified_split(rest, [key], ["is_related"], shares or SHARES, seed)


def aspect_vocabulary(train: DataFrame, aspects: str = "aspects_parsed") -> DataFrame:
    """Sorted distinct aspects of the training rows with their index."""
    classes = (
        train.select(F.explode(aspects).alias("aspect"))
        .groupBy()
        .agg(F.array_sort(F.collect_set("aspect")).alias("classes"))
    )
    return classes.select(F.posexplode("classes").alias("idx", "aspect"))


def vocabulary_array(train: DataFrame, aspects: str = "aspects_parsed") -> Column:
    """The same list as one array value, evaluated once per query."""
    return (
        train.select(F.explode(aspects).alias("aspect"))
        .agg(F.array_sort(F.collect_set("aspect")))
        .scalar()
    )


def with_multi_hot(
    df: DataFrame, vocabulary: Column, column: str = "aspect_labels", labels: str = "aspects_parsed"
) -> DataFrame:
    """1.0 per vocabulary entry the row names; names outside the vocabulary are ignored."""
    hot = F.transform(
        "_vocabulary",
        lambda c: F.coalesce(F.array_contains(F.col(labels), c), F.lit(False)).cast("float"),
    )
    return df.withColumn("_vocabulary", vocabulary).withColumn(column, hot).drop("_vocabulary")


def missing_vector(vocabulary: Column) -> Column:
    return F.array_repeat(F.lit(MISSING_LABEL).cast("float"), F.size(vocabulary))


def with_aspect_labels(df: DataFrame, reference: DataFrame, vocabulary: Column, key: str = "row_id") -> DataFrame:
    """Label vectors looked up by row id; rows without one get -1.0 vectors and a false flag."""
    looked = with_multi_hot(reference, vocabulary, "_labels").select(key, "_labels")
    return (
        df.join(looked, key, "left")
        .withColumn("has_aspect_label", F.col("_labels").isNotNull())
        .withColumn("aspect_labels", F.coalesce("_labels", missing_vector(vocabulary)))
        .drop("_labels")
    )


def aspect_counts(train: DataFrame, vocabulary: DataFrame, aspects: str = "aspects_parsed") -> DataFrame:
    """Training rows per vocabulary aspect, 0 where none, with the percent of rows."""
    counts = (
        train.select(F.explode(F.array_distinct(aspects)).alias("aspect"))
        .groupBy("aspect")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rows = train.agg(F.count(F.lit(1))).scalar()
    return vocabulary.join(counts, "aspect", "left").select(
        "idx",
        "aspect",
        F.coalesce("n", F.lit(0)).alias("n"),
        (F.coalesce("n", F.lit(0)) * 100.0 / rows).alias("pct"),
    )


def rare_classes(counts: DataFrame, below: int = RARE_BELOW) -> DataFrame:
    return counts.where(F.col("n") < below).select("idx", "aspect", "n")


def _rare_array(rare: DataFrame) -> Column:
    return F.coalesce(
        rare.agg(F.collect_list("aspect")).scalar(), F.array().cast("array<string>")
    )


def simulated_counts(
    train: DataFrame, counts: DataFrame, rare: DataFrame, copies: int = COPIES
) -> DataFrame:
    """Aspect counts before and after copying every row that names a rare aspect."""
    touched = train.where(F.arrays_overlap("aspects_parsed", _rare_array(rare)))
    extra = (
        touched.select(F.explode(F.array_distinct("aspects_parsed")).alias("aspect"))
        .groupBy("aspect")
        .agg(F.count(F.lit(1)).alias("m"))
    )
    return (
        counts.join(extra, "aspect", "left")
        .select(
            "aspect",
            F.col("n").alias("before"),
            (F.col("n") + F.coalesce("m", F.lit(0)) * copies).alias("after"),
        )
    )


def oversample_rare(
    train: DataFrame,
    rare: DataFrame,
    vocabulary: Column,
    copies: int = COPIES,
    rewrites: DataFrame | None = None,
    text: str = "sentence_for_model",
    key: str = "row_id",
) -> DataFrame:
    """Training rows plus `copies` of each row naming a rare aspect, with new ids and set flags.

    New text comes from a (row_id, copy, new_text, new_language) table where it
    has an acceptable entry, else the text is repeated.
    """
    labelled = with_multi_hot(train, vocabulary).withColumns(
        {
            "is_related": F.lit(1),
            "is_technical": F.lit(1),
            "has_aspect_label": F.lit(True),
        }
    )
    extra = labelled.where(F.arrays_overlap("aspects_parsed", _rare_array(rare))).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))
    )
    if rewrites is not None:
        table = rewrites.select(
            F.col(key).alias("_key"), F.col("copy").alias("_copy"), "new_text", "new_language"
        )
        extra = (
            extra.join(table, (F.col(key) == F.col("_key")) & (extra["_copy"] == table["_copy"]), "left")
            .drop(table["_copy"])
            .withColumn(text, accept_rewrite(F.col(text), F.col("new_text"), F.col("new_language")))
            .drop("_key", "new_text", "new_language")
        )
    renamed = extra.withColumn(
        key, F.sha2(F.concat_ws("#", F.col(key), F.col("_copy").cast("string")), 256)
    ).drop("_copy")
    return labelled.unionByName(renamed)


def final_training_frame(
    technical_train: DataFrame, other_train: DataFrame, vocabulary: Column, seed: int = SEED,
    key: str = "row_id",
) -> DataFrame:
    """Labelled technical rows with the others behind -1.0 vectors, in repeatable random order."""
    others = other_train.withColumns(
        {"aspect_labels": missing_vector(vocabulary), "has_aspect_label": F.lit(False)}
    )
    return shuffled(technical_train.unionByName(others, allowMissingColumns=True), [key], seed)


def sentiment_triples(
    df: DataFrame, text: str = "sentence_for_model", key: str = "row_id", columns: Sequence[str] = ()
) -> DataFrame:
    """(sentence, aspect, class) of technical rows with valid pairs, beside further `columns`; only -1 is negative."""
    return (
        df.where((F.col("is_technical") == 1) & F.col("is_valid_pairs"))
        .select(key, F.col(text).alias("sentence"), *columns, F.explode("pairs").alias("p"))
        .select(
            key,
            "sentence",
            *columns,
            F.col("p.aspect").alias("aspect"),
            F.when(F.col("p.sentiment") == -1, 0).otherwise(1).alias("label_idx"),
        )
    )


def positive_weights(df: DataFrame, labels: str = "aspect_labels") -> DataFrame:
    """Per vector position: negatives over positives among labelled rows, held in 0.1..10."""
    flat = df.where("has_aspect_label").select(F.posexplode(labels).alias("idx", "y"))
    weight = (F.count(F.lit(1)) - F.sum("y")) / (F.sum("y") + 1e-6)
    return flat.groupBy("idx").agg(
        F.sum("y").alias("n_pos"),
        F.greatest(F.lit(0.1), F.least(F.lit(10.0), weight)).alias("pos_weight"),
    )


def class_weights(df: DataFrame, label: str = "label_idx", classes: int = 2) -> DataFrame:
    """Per class: total over (classes * count), held in 0.2..5; an absent class counts as 1."""
    one = df.agg(
        F.count(label).alias("total"),
        *[F.count(F.when(F.col(label) == i, 1)).alias(f"c{i}") for i in range(classes)],
    )
    rows = [
        F.struct(
            F.lit(i).alias("label_idx"),
            F.greatest(
                F.lit(0.2),
                F.least(
                    F.lit(5.0),
                    F.col("total") / (classes * F.greatest(F.col(f"c{i}"), F.lit(1))),
                ),
            ).alias("weight"),
        )
        for i in range(classes)
    ]
    return one.select(F.inline(F.array(*rows)))


def sentence_type_counts(df: DataFrame) -> DataFrame:
    """Rows per sentence type in fixed order, 0 when absent."""
    counts = count_by(with_sentence_type(df), "sentence_type", name="n")
    return in_fixed_order(counts, "sentence_type", P.SENTENCE_TYPES).withColumn(
        "n", F.coalesce("n", F.lit(0))
    )


def share_error(df: DataFrame, shares: dict[str, float], label: str, split: str = "split") -> DataFrame:
    """How far each label's share of a split is from the wanted share."""
    counts = df.groupBy(label, split).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(label).agg(F.sum("n").alias("total"))
    wanted = F.lit(None).cast("double")
    for name, s in shares.items():
        wanted = F.when(F.col(split) == name, F.lit(s)).otherwise(wanted)
    return counts.join(totals, label).withColumn("error", F.col("n") / F.col("total") - wanted)
