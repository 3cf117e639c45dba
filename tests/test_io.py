"""Readers, writers, row ids, streams and the shape of plans."""

import pytest
from pyspark.sql import functions as F

from starsift.catalog import QUERIES
from starsift.functions import patterns as P
from starsift.sources import readers, schemas, writers
from starsift.streaming import jobs as S


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", 5.0, 't "q"', 'line one\nline, "two"', 1583020800000, True, "P", None, 4.5, 10, "Computers")],
        schemas.LINKED_REVIEWS,
    )
    path = str(tmp_path / "reviews")
    writers.save_sentences(df, path, as_csv=True)
    assert readers.load_reviews(spark, path).collect() == df.collect()


def test_parquet_by_year_and_table(spark, tmp_path):
    df = spark.createDataFrame([(1, 2020), (2, 2021)], "id int, year int").withColumn(
        "date", F.lit("2020-01-01 10:00:00").cast("timestamp_ntz")
    )
    path = str(tmp_path / "prepared")
    writers.save_prepared(df, path)
    writers.save_prepared(df, path)
    back = readers.load_reviews(spark, path, local_csv=False)
    assert sorted(r["id"] for r in back.where("year = 2021").collect()) == [2] and back.count() == 2
    assert {p.name for p in (tmp_path / "prepared").iterdir()} >= {"year=2020", "year=2021"}
    csv = str(tmp_path / "prepared_csv")
    writers.save_prepared(df, csv, as_csv=True)
    assert spark.read.option("header", True).csv(csv).first()["date"] == "2020-01-01 10:00:00"


def test_labelled_titles_and_catalogue(spark):
    t = spark.createDataFrame([("a", 1), (None, 1), ("b", None)], schemas.LABELLED_TITLES)
    assert readers.labelled_titles(t).count() == 1
    p = spark.createDataFrame(
        [("Computers", "x", "a", 1.0, 1, 1.0), ("Toys", "x", "b", 1.0, 1, 1.0), ("Computers", None, "c", 1.0, 1, 1.0)],
        schemas.PRODUCTS,
    ).withColumn("extra", F.lit(1))
    got = readers.catalogue(p)
    assert [r["parent_asin"] for r in got.collect()] == ["a"] and "extra" not in got.columns


def test_row_ids_of_very_common_rows(spark):
    df = spark.createDataFrame([("x", 1)] * 25 + [("y", None), ("y", 2), (None, 2)], "sentence_for_model string, v int")
    ids = readers.with_row_id(df, copies_per_task=4)
    rows = ids.collect()
    assert len(rows) == 28 and len({r["row_id"] for r in rows}) == 28
    again = readers.with_row_id(df.repartition(3)).collect()
    assert {r["row_id"] for r in again} == {r["row_id"] for r in rows}
    assert readers.labelled_sentences(df).count() == 27


def test_required_columns(spark):
    df = spark.createDataFrame([("s", 1)], "sentence_for_model string, is_related int")
    with pytest.raises(ValueError, match="is_technical"):
        readers.required_columns(df)
    full = df.selectExpr("*", "1 AS is_technical", "'a' AS target_aspect", "'1' AS target_sentiment", "7 AS more")
    assert readers.required_columns(full, ["more", "none"]).columns[-1] == "more"
    assert "row_id" not in readers.required_columns(full).columns


def test_lean_reviews(spark):
    df = spark.createDataFrame([(i, None if i == 3 else f"t{i}", 1.0) for i in range(10)], "key int, review_text string, price double")
    rows = readers.lean_reviews(df, ["key"]).collect()
    assert sorted(r["review_id"] for r in rows) == list(range(1, 10))
    assert rows[0].asDict().keys() == {"review_id", "price", "review_text"}


def test_stream_windows_equal_batch(spark, tmp_path):
    rows = [(f"2024-01-0{d} 0{h}:30:00", "zoom call" if h % 2 else "other") for d in (1, 2, 3) for h in range(1, 6)]
    df = spark.createDataFrame(rows, "t string, text string").select(F.col("t").cast("timestamp").alias("ts"), "text")
    source = str(tmp_path / "in")
    df.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(df.schema).parquet(source)
    out = S.keyword_windows(stream, "ts", "text", {"zoom": r"\bzoom\b"})
    target = str(tmp_path / "out")
    S.run_available(out, target, str(tmp_path / "state")).awaitTermination()
    got = spark.read.schema(out.schema).parquet(target).orderBy("window_start").collect()
    # the last day is still open when the source ends
    assert [(r["n"], r["pct"]) for r in got] == [(5, 60.0), (5, 60.0)]


def test_stream_first_arrivals(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01-01"), (1, "2024-01-01"), (2, "2024-01-02")], "k int, t string").select(
        "k", F.col("t").cast("timestamp").alias("ts")
    )
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    df.write.parquet(source)
    stream = spark.readStream.schema(df.schema).parquet(source)
    S.run_available(S.first_arrivals(stream, ["k"], "ts"), target, str(tmp_path / "state")).awaitTermination()
    assert sorted(r["k"] for r in spark.read.schema(df.schema).parquet(target).collect()) == [1, 2]


def test_stream_sees_a_key_again_after_a_gap(spark, tmp_path):
    days = [(1, "2024-01-01"), (1, "2024-01-02"), (1, "2024-01-09"), (None, "2024-01-03"), (2, "2024-01-20"), (3, None)]
    df = spark.createDataFrame(days, "k int, t string").select("k", F.col("t").cast("timestamp").alias("ts"))
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    for k in range(len(days)):
        df.where("ts is null" if days[k][1] is None else F.col("ts") == F.lit(days[k][1]).cast("timestamp")).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(source)
    out = S.runs_of_arrivals(stream, ["k"], "ts", "2 days", "7 days")
    S.run_available(out, target, str(tmp_path / "state")).awaitTermination()
    got = {(r["k"], str(r["first_at"])[:10], r["n"]) for r in spark.read.schema(out.schema).parquet(target).collect()}
    # the run of key 2 is still open when the source ends
    assert got == {(1, "2024-01-01", 2), (1, "2024-01-09", 1), (None, "2024-01-03", 1)}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_what_is_needed(spark, sf_dir):
    text = plan(QUERIES["e04_reviews_by_category"](spark, sf_dir))
    scan = next(line for line in text.splitlines() if "lineitem.parquet" in line)
    assert "l_extendedprice" not in scan and "l_shipdate" not in scan


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([("Computers", "x", "a", 1.0, 1, 1.0)], schemas.PRODUCTS).write.parquet(path)
    text = plan(readers.catalogue(readers.read_table(spark, path)))
    assert "PushedFilters: [IsNotNull(title), In(main_category" in text
    assert len(P.CATALOGUE_CATEGORIES) == 4


def test_survivors_are_cut_down_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["d02_keep_one_per_key"](spark, sf_dir))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange hashpartitioning") == 1


def test_cleaning_and_language_move_no_rows(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    from starsift.functions.textclean import clean_text

    assert "Exchange" not in plan(table.select(clean_text(F.col("text"))))
