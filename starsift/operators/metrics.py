"""Evaluation and threshold tuning from small count tables."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Threshold grids.
HEAD_GRID = tuple(float(t) for t in np.arange(0.1, 0.92, 0.05))
ASPECT_GRID = tuple(float(t) for t in np.arange(0.1, 0.92, 0.02))
CONFIDENCE_GRID = tuple(float(t) for t in np.arange(0.40, 0.92, 0.05))
DEFAULT_THRESHOLD = 0.5
DEFAULT_CONFIDENCE = 0.65
MIN_CONFIDENT = 10


def _ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def f_beta(tp: Column, fp: Column, fn: Column, beta: float = 1.0) -> Column:
    b2 = beta * beta
    return _ratio((1 + b2) * tp, (1 + b2) * tp + b2 * fn + fp)


def macro_binary(tp: Column, fp: Column, fn: Column, tn: Column, beta: float = 1.0) -> Column:
    """Mean F of the two classes, over the classes that occur among labels or predictions."""
    one = (tp + fp + fn > 0).cast("int")
    zero = (tn + fp + fn > 0).cast("int")
    return _ratio(
        f_beta(tp, fp, fn, beta) * one + f_beta(tn, fn, fp, beta) * zero, one + zero
    )


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.groupBy(label, pred).agg(F.count(F.lit(1)).alias("n"))


def class_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Precision, recall, F1 and support of every class seen among labels or predictions."""
    cells = confusion(df, label, pred)
    same = F.col(label) == F.col(pred)
    sides = cells.select(
        F.inline(
            F.array(
                F.struct(
                    F.col(label).alias("class"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("long").alias("predicted"),
                    F.when(same, F.col("n")).otherwise(0).alias("tp"),
                ),
                F.struct(
                    F.col(pred).alias("class"),
                    F.lit(0).cast("long").alias("support"),
                    F.col("n").alias("predicted"),
                    F.lit(0).cast("long").alias("tp"),
                ),
            )
        )
    )
    sums = sides.groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp")
    )
    tp, missed, wrong = F.col("tp"), F.col("support") - F.col("tp"), F.col("predicted") - F.col("tp")
    return sums.select(
        "class",
        _ratio(tp, F.col("predicted")).alias("precision"),
        _ratio(tp, F.col("support")).alias("recall"),
        f_beta(tp, wrong, missed).alias("f1"),
        "support",
    )


def overall_scores(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Accuracy and macro F1 of single-label predictions."""
    report = class_report(df, label, pred)
    macro = report.agg(F.avg("f1")).scalar()
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col(label) == F.col(pred)).cast("int")).alias("accuracy"),
    ).withColumn("f1_macro", macro)


def label_scores(df: DataFrame, truth: str, pred: str, vocabulary: Sequence[str]) -> DataFrame:
    """F1 per label of multi-hot vectors, one pass."""
    t, p = F.col("t") > 0.5, F.col("p") > 0.5
    flat = df.select(F.posexplode(F.arrays_zip(F.col(truth).alias("t"), F.col(pred).alias("p"))).alias("idx", "z"))
    flat = flat.select("idx", "z.t", "z.p")

    def hits(c: Column) -> Column:
        return F.sum(c.cast("int"))

    names = F.array(*[F.lit(v) for v in vocabulary])
    return (
        flat.groupBy("idx")
        .agg(hits(t & p).alias("tp"), hits(~t & p).alias("fp"), hits(t & ~p).alias("fn"))
        .select(
            F.get(names, F.col("idx")).alias("label"),
            "tp", "fp", "fn",
            f_beta(F.col("tp"), F.col("fp"), F.col("fn")).alias("f1"),
        )
    )


def sample_f1(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Mean over rows of the F1 between the true and the predicted vector."""

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)

    both = F.zip_with(truth, pred, lambda a, b: (a * b).cast("double"))

    def size(name: str) -> Column:
        return total(F.transform(name, lambda x: x.cast("double")))

    return df.agg(F.avg(_ratio(2 * total(both), size(truth) + size(pred))).alias("f1_samples"))


def multi_label_scores(df: DataFrame, truth: str, pred: str, vocabulary: Sequence[str]) -> DataFrame:
    macro = label_scores(df, truth, pred, vocabulary).agg(F.avg("f1")).scalar()
    return sample_f1(df, truth, pred).withColumn("f1_macro", macro)


def sweep(
    df: DataFrame, label: str, prob: str, grid: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """tp, fp, fn, tn of `prob >= threshold` at every threshold of a rising grid.

    Each row is counted once under the number of thresholds it passes. Only
    that count table, with len(grid) + 1 steps, is spread over the grid.
    """
    passed = F.lit(0)
    for t in grid:
        passed = passed + (F.col(prob) >= F.lit(t)).cast("int")
    counts = df.groupBy(*by, passed.alias("passed"), F.col(label).cast("int").alias("y")).agg(
        F.count(F.lit(1)).alias("n")
    )
    steps = F.array(
        *[F.struct(F.lit(i).alias("i"), F.lit(t).alias("threshold")) for i, t in enumerate(grid)]
    )
    wide = counts.select(*by, "passed", "y", "n", F.inline(steps))

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    yes = F.col("passed") > F.col("i")
    return wide.groupBy(*by, "i", "threshold").agg(
        total(yes & (F.col("y") == 1)).alias("tp"),
        total(yes & (F.col("y") == 0)).alias("fp"),
        total(~yes & (F.col("y") == 1)).alias("fn"),
        total(~yes & (F.col("y") == 0)).alias("tn"),
    )


def _first_best(scored: DataFrame, score: str, by: Sequence[str], default: float, name: str) -> DataFrame:
    """The lowest threshold of the best positive score; the default when no score is positive."""
    best = F.max(score)
    return scored.groupBy(*by).agg(
        F.when(best > 0, F.max_by("threshold", F.struct(F.col(score), -F.col("i"))))
        .otherwise(F.lit(default))
        .alias(name),
        best.alias(f"best_{score}"),
    )


def tune_head(
    df: DataFrame, label: str, prob: str, grid: Sequence[float] = HEAD_GRID, beta: float = 2.0
) -> DataFrame:
    """Threshold of a yes/no head by macro F-beta."""
    c = sweep(df, label, prob, grid)
    scored = c.withColumn(
        "f_beta", macro_binary(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"), beta)
    )
    return _first_best(scored, "f_beta", [], DEFAULT_THRESHOLD, "threshold")


def tune_aspects(
    df: DataFrame, aspect: str, label: str, prob: str, grid: Sequence[float] = ASPECT_GRID
) -> DataFrame:
    """Threshold of every aspect by F1, all aspects in one job."""
    c = sweep(df, label, prob, grid, [aspect])
    scored = c.withColumn("f1", f_beta(F.col("tp"), F.col("fp"), F.col("fn")))
    return _first_best(scored, "f1", [aspect], DEFAULT_THRESHOLD, "threshold")


def confidence_table(
    df: DataFrame, label: str, pred: str, conf: str, grid: Sequence[float] = CONFIDENCE_GRID
) -> DataFrame:
    """Coverage, macro F1 and accuracy among rows at least this confident.

    The count of confident rows never rises with the threshold, so leaving out
    thresholds with too few rows is the same as stopping at the first of them.
    """
    passed = F.lit(0)
    for t in grid:
        passed = passed + (F.col(conf) >= F.lit(t)).cast("int")
    counts = df.groupBy(
        passed.alias("passed"),
        F.col(label).cast("int").alias("y"),
        F.col(pred).cast("int").alias("z"),
    ).agg(F.count(F.lit(1)).alias("n"))
    all_rows = F.sum("n").over(Window.partitionBy())
    steps = F.array(
        *[F.struct(F.lit(i).alias("i"), F.lit(t).alias("threshold")) for i, t in enumerate(grid)]
    )
    wide = counts.withColumn("_all", all_rows).select("passed", "y", "z", "n", "_all", F.inline(steps))

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    sums = (
        wide.where(F.col("passed") > F.col("i"))
        .groupBy("i", "threshold")
        .agg(
            F.sum("n").alias("n"),
            F.max("_all").alias("_all"),
            total((F.col("y") == 1) & (F.col("z") == 1)).alias("tp"),
            total((F.col("y") == 0) & (F.col("z") == 1)).alias("fp"),
            total((F.col("y") == 1) & (F.col("z") == 0)).alias("fn"),
            total((F.col("y") == 0) & (F.col("z") == 0)).alias("tn"),
        )
    )
    return sums.where(F.col("n") >= MIN_CONFIDENT).select(
        "i",
        "threshold",
        "n",
        (F.col("n") * 100.0 / F.col("_all")).alias("coverage"),
        macro_binary(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")).alias("f1_macro"),
        ((F.col("tp") + F.col("tn")) / F.col("n")).alias("accuracy"),
    )


def tune_confidence(df: DataFrame, label: str, pred: str, conf: str) -> DataFrame:
    """Confidence cut with the best macro F1."""
    table = confidence_table(df, label, pred, conf)
    return _first_best(table, "f1_macro", [], DEFAULT_CONFIDENCE, "threshold")


def confident_scores(df: DataFrame, label: str, pred: str, conf: str, cut: float) -> DataFrame:
    """Size, macro F1 and accuracy of the confident subset."""
    y, z, sure = F.col(label) == 1, F.col(pred) == 1, F.col(conf) >= cut

    def total(condition: Column) -> Column:
        return F.count(F.when(condition & sure, 1))

    one = df.agg(
        F.count(F.lit(1)).alias("n"),
        total(F.lit(True)).alias("n_confident"),
        total(y & z).alias("tp"),
        total(~y & z).alias("fp"),
        total(y & ~z).alias("fn"),
        total(~y & ~z).alias("tn"),
    )
    return one.select(
        "n",
        "n_confident",
        macro_binary(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")).alias("f1_macro"),
        F.try_divide(F.col("tp") + F.col("tn"), F.col("n_confident")).alias("accuracy"),
    )


def aspect_scores(
    df: DataFrame, aspect: str, label: str, pred: str, conf: str, cut: float
) -> DataFrame:
    """Per aspect: pairs, accuracy, macro F1 and accuracy of the confident pairs."""
    y, z, sure = F.col(label) == 1, F.col(pred) == 1, F.col(conf) >= cut

    def total(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    sums = df.groupBy(aspect).agg(
        F.count(F.lit(1)).alias("n"),
        total(y & z).alias("tp"),
        total(~y & z).alias("fp"),
        total(y & ~z).alias("fn"),
        total(~y & ~z).alias("tn"),
        total(sure).alias("n_confident"),
        total(sure & (y == z)).alias("right_confident"),
    )
    return sums.select(
        aspect,
        "n",
        ((F.col("tp") + F.col("tn")) / F.col("n")).alias("accuracy"),
        macro_binary(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")).alias("f1_macro"),
        F.try_divide(F.col("right_confident"), F.col("n_confident")).alias("accuracy_confident"),
    )
