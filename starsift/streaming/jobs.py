"""Streaming forms of scoring, de-duplication and keyword rates."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starsift.operators.clean import flag_columns, with_keyword_flags
from starsift.operators.models import Thresholds, score_in_row


def scored_stream(
    texts: DataFrame, key: Sequence[str], text: str, cuts: Thresholds, positive: Callable[[Column], Column]
) -> DataFrame:
    """The scoring record per arriving text; the batch expression, stateless."""
    return score_in_row(texts, key, text, cuts, positive)


def first_arrivals(
    stream: DataFrame, key: Sequence[str], time: str, within: str = "1 day"
) -> DataFrame:
    """The first row to arrive per key; state of a key is dropped once the watermark passes."""
    return stream.withWatermark(time, within).dropDuplicatesWithinWatermark(list(key))


def runs_of_arrivals(
    stream: DataFrame, key: Sequence[str], time: str, gap: str = "2 days", late: str = "1 hour"
) -> DataFrame:
    """(key, first_at, n): each run of arrivals of a key in which none comes more than `gap` after the one before.

    A run is emitted, and leaves the state, once the watermark passes its last arrival by `gap`; a key that comes
    back later is seen again. State grows with the keys of the last `gap`, not with the stream. Rows without
    a time are left out; keys may be null.
    """
    runs = stream.withWatermark(time, late).groupBy(F.session_window(time, gap), *key)
    return runs.agg(F.count(F.lit(1)).alias("n")).select(*key, F.col("session_window.start").alias("first_at"), "n")


def keyword_windows(
    stream: DataFrame, time: str, text: str, keywords: Mapping[str, str],
    width: str = "1 day", late: str = "1 hour",
) -> DataFrame:
    """Rows and keyword hits per tumbling window, emitted when the window is closed."""
    flagged = with_keyword_flags(stream.withWatermark(time, late), keywords, text)
    names = flag_columns(keywords)
    sums = flagged.groupBy(F.window(time, width)).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in names.values()]
    )
    rows = [
        F.struct(
            F.lit(kw).alias("keyword"), F.col("n"), (F.col(c) / F.col("n") * 100).alias("pct")
        )
        for kw, c in names.items()
    ]
    return sums.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.inline(F.array(*rows)),
    )


def run_available(stream: DataFrame, target: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process what has arrived into a Parquet folder, then stop."""
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start(target)
    )


def read_results(spark: SparkSession, target: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(target)
