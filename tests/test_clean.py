"""Null, boundary and priority rules of the derived columns."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starsift.functions import patterns as P
from starsift.operators import clean, dedupe, profile, summaries


def column(df, name):
    return [r[name] for r in df.collect()]


def test_exclusion_keeps_missing(spark):
    df = spark.createDataFrame([(None,), ("Office Products",), ("Computers",)], "main_category string")
    kept = clean.exclude_value(df, "main_category", "Office Products")
    assert set(column(kept, "main_category")) == {None, "Computers"}


def test_epoch_and_parts(spark):
    df = spark.createDataFrame([(1583020800000,), (None,)], "ms long").withColumn(
        "date", clean.from_epoch_ms(F.col("ms"))
    )
    rows = clean.with_date_parts(df).collect()
    assert rows[0]["date"] == dt.datetime(2020, 3, 1)
    assert (rows[0]["year"], rows[0]["month"], rows[0]["date_of_month"], rows[0]["day_of_week"]) == (
        2020, 3, 1, "Sunday",
    )
    assert rows[1]["date"] is None and rows[1]["year"] is None


def test_basic_clean(spark):
    df = spark.createDataFrame(
        [("é👍", 1583020800123, None, "Computers", 1), (None, 0, 5.0, None, 1)],
        "review_text string, timestamp long, price double, main_category string, rn int",
    )
    rows = clean.basic_clean(df).collect()
    assert "timestamp" not in rows[0] and "rn" not in rows[0]
    assert [r["review_length"] for r in rows] == [2, None]
    assert [r["price_missing"] for r in rows] == [1, 0]


def test_tier_cut_points(spark):
    prices = [float(i) for i in range(1, 1001)] + [0.0, None]
    df = spark.createDataFrame([(p,) for p in prices], "price double")
    got = {r["price"]: r["price_tier"] for r in clean.with_price_tier(df).collect()}
    # 1001 known prices 0..1000: the cuts are 500, 750 and 975
    assert got[None] == got[0.0] == "Unknown"
    assert got[500.0] == "Low" and got[501.0] == "Medium"
    assert got[750.0] == "Medium" and got[751.0] == "High"
    assert got[974.0] == "High" and got[975.0] == "Premium"


def test_period_cuts(spark):
    instants = ["2020-02-29 23:59:59.999999", "2020-03-01 00:00:00", "2021-06-30 23:59:59", "2021-07-01 00:00:00", None]
    df = spark.createDataFrame([(i,) for i in instants], "d string").select(
        F.col("d").cast("timestamp_ntz").alias("date")
    )
    assert column(clean.with_period(df), "covid_period") == [
        "pre-COVID", "during-COVID", "during-COVID", "post-COVID", "unknown",
    ]


@pytest.mark.parametrize(
    "title, wanted",
    [
        ("Desktop tower and LAPTOP", "desktop"), ("laptop sleeve for iPad", "laptop"), ("Fire  Tablet 8", "tablet"),
        ("Galaxy S9 case", "phone"), ("Galaxy S21 case", "other"), ("all-in-one PC", "desktop"), ("desktops", "other"), (None, "other"),
        ("Surface Go keyboard", "tablet"),
    ],
)
def test_title_class(spark, title, wanted):
    df = spark.createDataFrame([(title,)], "t string")
    assert df.select(clean.classify_title(F.col("t"))).first()[0] == wanted


@pytest.mark.parametrize(
    "title, wanted",
    [
        ("New iPhone 12", "apple"), ("Hewlett-Packard 15", "hp"), ("hewlett packard 15", "hp"),
        ("Sony case for Dell XPS", "sony"), ("Nothing here", "unknown"), (None, "unknown"), ("", "unknown"),
        ("ThinkPad by Lenovo", "lenovo"), ("Surface Pro", "microsoft"), ("Razer Blade", "razer"),
    ],
)
def test_brand(spark, title, wanted):
    df = spark.createDataFrame([(title,)], "t string")
    assert df.select(clean.detect_brand(F.col("t"))).first()[0] == wanted


def test_overrides_priority_and_denied(spark):
    df = spark.createDataFrame(
        [("a", "laptop x"), ("b", "cable"), ("c", "cable"), ("d", "laptop y")], "parent_asin string, product_title string"
    )
    overrides = spark.createDataFrame(
        [("b", "laptop", 2), ("b", "desktop", 1)], "parent_asin string, category string, priority int"
    )
    denied = spark.createDataFrame([("d",), (None,)], "parent_asin string")
    out = clean.with_category(df, overrides=overrides, denied=denied)
    assert sorted((r["parent_asin"], r["category"]) for r in out.collect()) == [("a", "laptop"), ("b", "desktop")]


def test_flags_on_missing_text(spark):
    df = spark.createDataFrame([(None,), ("Good BUT slow",), ("butter",)], "review_text string")
    assert column(clean.with_tradeoff_flag(df), "has_tradeoff") == [0, 1, 0]
    flags = clean.with_keyword_flags(df)
    assert column(flags, clean.flag_columns(P.PERIOD_KEYWORDS)["performance"]) == [0, 1, 0]


def test_keyword_patterns(spark):
    texts = ["battery  life", "batteries", "video call", "zoomed", "WFH setup", "wébcam webcam"]
    df = spark.createDataFrame([(t,) for t in texts], "review_text string")
    names = clean.flag_columns(P.PERIOD_KEYWORDS)
    flags = clean.with_keyword_flags(df)
    assert column(flags, names["battery life"]) == [1, 1, 0, 0, 0, 0]
    assert column(flags, names["zoom / video"]) == [0, 0, 1, 0, 0, 0]
    assert column(flags, names["work from home"]) == [0, 0, 0, 0, 1, 0]


def test_purchase_group(spark):
    df = spark.createDataFrame(
        [(True, 5.0), (False, 4.0), (None, None)], "verified_purchase boolean, rating double"
    )
    rows = clean.with_purchase_group(df).collect()
    assert [(r["group"], r["is_5_star"]) for r in rows] == [("Verified", 1), ("Non-verified", 0), (None, 0)]


def test_fixed_width_bins(spark):
    prices = [50.0, 50.01, 100.0, 0.0, None] + [120.0] * 95 + [149.0] * 5
    df = spark.createDataFrame([(p,) for p in prices], "price double")
    got = {r["price"]: r["price_mid"] for r in clean.with_price_bin(df).collect()}
    # the 0.97 quantile is 149, so the last edge is 150
    assert got == {50.0: 25.0, 50.01: 75.0, 100.0: 75.0, 120.0: 125.0, 149.0: 125.0}


def test_bins_past_the_last_edge_have_no_label(spark):
    prices = [10.0] * 99 + [99.0]
    df = spark.createDataFrame([(p,) for p in prices], "price double")
    got = {r["price"]: r["price_mid"] for r in clean.with_price_bin(df).collect()}
    assert got == {10.0: 25.0, 99.0: None}


def test_explicit_bins(spark):
    df = spark.createDataFrame([(v,) for v in (0, 1, 100, 101, 1000, 1001, 100000, None)], "n int")
    got = column(df.select(clean.cut_label(F.col("n"), P.LENGTH_EDGES, P.LENGTH_LABELS).alias("b")), "b")
    assert got == [None, "<100", "<100", "100-300", "600-1000", ">1000", None, None]


def test_quantile_bins(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 3, 4, 5, None)], "n int")
    got = {r["n"]: r["b"] for r in clean.with_quantile_bin(df, "n", ("low", "high"), "b").collect()}
    assert got == {1: "low", 2: "low", 3: "low", 4: "high", 5: "high", None: None}
    tied = spark.createDataFrame([(1,), (1,), (1,), (2,)], "n int")
    with pytest.raises(Exception, match="not unique"):
        clean.with_quantile_bin(tied, "n", ("a", "b", "c"), "b").collect()


def test_first_per_key_keeps_null_keys_together(spark):
    df = spark.createDataFrame(
        [("p", None, "t", 2), ("p", None, "t", 1), ("p", "x", "t", 3)],
        "parent_asin string, review_title string, review_text string, v int",
    )
    kept = dedupe.first_per_key(df, dedupe.REVIEW_KEY, ["v"])
    assert sorted(column(kept, "v")) == [1, 3]
    assert [r["cnt"] for r in dedupe.duplicate_groups(df).collect()] == [2]


def test_link_reviews(spark):
    reviews = spark.createDataFrame([("a", "t1", "x1"), ("z", "t2", "x2")], "parent_asin string, title string, text string")
    products = spark.createDataFrame(
        [("a", "P", 1.0, 4.0, 9, "Computers")],
        "parent_asin string, title string, price double, average_rating double, rating_number long, main_category string",
    )
    rows = dedupe.link_reviews(reviews, products).collect()
    assert len(rows) == 1 and rows[0]["review_title"] == "t1" and rows[0]["product_title"] == "P"


@pytest.mark.parametrize("limit", [dedupe.BROADCAST_BYTES, 0])
def test_drop_same_text_small_and_large(spark, monkeypatch, limit):
    monkeypatch.setattr(dedupe.broadcast_if_small, "__defaults__", (limit,))
    df = spark.createDataFrame([(i, "hot" if i % 3 else f"t{i}") for i in range(60)], "id int, text string")
    other = spark.createDataFrame([("hot",), (None,), ("t3",)], "other string")
    kept = {r["id"] for r in dedupe.drop_same_text(df, other, "text", "other").collect()}
    assert kept == {i for i in range(60) if i % 3 == 0 and i != 3}


def test_constant_and_empty_correlation(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 7.0, None), (2.0, 4.0, 7.0, None), (3.0, None, 7.0, None)],
        "a double, b double, c double, d double",
    )
    got = {(r["column_a"], r["column_b"]): r["r"] for r in profile.correlation_matrix(df).collect()}
    assert len(got) == 16
    assert got["a", "b"] == got["b", "a"] == 1.0
    assert got["a", "c"] is None and got["d", "d"] is None


def test_one_row_std_and_missing_weekdays(spark):
    df = spark.createDataFrame([("Monday", 1), (None, 2)], "day_of_week string, x int")
    rows = summaries.reviews_by_weekday(df).collect()
    assert [r["day_of_week"] for r in rows] == list(P.WEEKDAYS)
    assert [r["reviews"] for r in rows] == [1] + [None] * 6
    one = spark.createDataFrame([("pre-COVID", 3.0), ("unknown", 1.0)], "covid_period string, rating double")
    rows = summaries.rating_by_period(one).collect()
    assert rows[0]["std"] is None and rows[0]["n"] == 1 and rows[2]["n"] is None


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(2.0,), (2.0,), (None,)], "v double")
    rows = summaries.histogram(df, "v", 10).collect()
    assert [(r["bin"], r["left_edge"], r["n"]) for r in rows] == [(0, 2.0, 2)]


def test_box_whiskers(spark):
    df = spark.createDataFrame([("g", float(v)) for v in (1, 2, 3, 4, 100)], "k string, v double")
    r = summaries.box_summary(df, "v", "k").first()
    assert (r["q1"], r["median"], r["q3"]) == (2.0, 3.0, 4.0)
    assert (r["lower_whisker"], r["upper_whisker"], r["max"]) == (1.0, 4.0, 100.0)


def test_labelled_products_give_the_same_columns(spark):
    from starsift.plans import jobs

    products = spark.createDataFrame(
        [("a", "Dell laptop", 1.0, 4.0, 9, "Computers"), ("b", "iPad Pro", 2.0, 4.0, 9, None), ("c", "cable", 3.0, 4.0, 9, "x")],
        "parent_asin string, title string, price double, average_rating double, rating_number long, main_category string",
    )
    reviews = spark.createDataFrame(
        [(p, f"t{i}", "text but", 1583020800000 + i) for i, p in enumerate("aabbc")],
        "parent_asin string, title string, text string, timestamp long",
    )
    plain = jobs.prepare_columns(dedupe.link_reviews(reviews, products))
    labelled = jobs.prepare_columns(dedupe.link_reviews(reviews, clean.label_products(products)))
    names = sorted(plain.columns)
    assert sorted(labelled.columns) == names
    assert sorted(labelled.select(names).collect(), key=str) == sorted(plain.select(names).collect(), key=str)
    assert {(r["parent_asin"], r["category"], r["brand"]) for r in plain.collect()} == {
        ("a", "laptop", "dell"), ("b", "tablet", "apple"),
    }
