"""Pairs, splits, vocabularies, oversampling, weights and the training frames."""

import pytest

from starsift.operators import labels as L
from starsift.plans import jobs
from starsift.sources.readers import labelled_sentences


def sentences(spark, rows):
    return spark.createDataFrame(
        rows,
        "sentence_for_model string, is_related int, is_technical int, target_aspect string, target_sentiment string",
    )


@pytest.mark.parametrize(
    "aspects, marks, wanted",
    [
        ("Battery; screen ", "1.0;-1", [("battery", 1), ("screen", -1)]),
        ("a;b", "1", []),
        (";b;", "1;0;1", [("b", 0)]),
        ("general;x;UNRELATED", "1;1;1", [("x", 1)]),
        ("a;b;c", "1;n/a;-1.9", [("a", 1), ("c", -1)]),
        (None, "1", []),
        ("a", None, []),
        ("a", "", []),
        ("a;b", "1d;1e0", [("b", 1)]),
        ("a;b", "nan;\t2 ", [("b", 2)]),
    ],
)
def test_pairs(spark, aspects, marks, wanted):
    row = L.with_pairs(sentences(spark, [("s", 1, 1, aspects, marks)])).first()
    assert [(p["aspect"], p["sentiment"]) for p in row["pairs"]] == wanted
    assert row["is_valid_pairs"] == bool(wanted)
    assert row["aspects_parsed"] == [a for a, _ in wanted]


def test_sentence_types(spark):
    df = spark.createDataFrame([(0, 1), (1, 0), (1, 1), (1, 7)], "is_related int, is_technical int")
    got = [r["sentence_type"] for r in L.with_sentence_type(df).collect()]
    assert got == ["unrelated", "general", "technical", "unknown"]
    counts = L.sentence_type_counts(df.where("is_related = 0")).collect()
    assert [(r["sentence_type"], r["n"]) for r in counts] == [("unrelated", 1), ("general", 0), ("technical", 0)]


def test_multi_hot_ignores_unknown(spark):
    train = spark.createDataFrame([(["b", "a"],), (["c"],)], "aspects_parsed array<string>")
    vocabulary = L.vocabulary_array(train)
    df = spark.createDataFrame([(["c", "zzz"],), ([],), (None,)], "aspects_parsed array<string>")
    got = [r["aspect_labels"] for r in L.with_multi_hot(df, vocabulary).collect()]
    assert got == [[0.0, 0.0, 1.0], [0.0] * 3, [0.0] * 3]


def many(spark, n=1200):
    rows = []
    for i in range(n):
        rare = i % 60 == 7
        rows.append((
            f"sentence {i} about things", int(i % 9 != 0), int(i % 9 != 0 and i % 4 != 0),
            "screen;gift" if rare else ("screen" if i % 3 else "battery"), "1;-1" if rare else str(i % 3 - 1),
        ))
    return sentences(spark, rows)


def test_training_frames(spark):
    frames = jobs.training_frames(many(spark))
    parts = {n: df.collect() for n, df in (("train", frames.train), ("val", frames.val), ("test", frames.test))}
    classes = [r["aspect"] for r in frames.vocabulary.orderBy("idx").collect()]
    assert classes == ["battery", "gift", "screen"]
    rare = {r["aspect"] for r in frames.rare.collect()}
    assert "gift" in rare
    originals = {r["row_id"] for rows in parts.values() for r in rows}
    base = [r for r in parts["train"]] + parts["val"] + parts["test"]
    assert len(originals) == len(base), "ids are unique over all frames"
    texts = {n: {r["sentence_for_model"] for r in rows} for n, rows in parts.items()}
    assert not texts["train"] & texts["val"] and not texts["train"] & texts["test"] and not texts["val"] & texts["test"]
    assert len(set().union(*texts.values())) == 1200
    for rows in parts.values():
        for r in rows:
            assert len(r["aspect_labels"]) == 3
            if not r["has_aspect_label"]:
                assert r["aspect_labels"] == [-1.0] * 3
            else:
                assert set(r["aspect_labels"]) <= {0.0, 1.0}
    touched = {}
    for r in parts["train"]:
        if r["has_aspect_label"]:
            touched.setdefault(r["sentence_for_model"], []).append(r["aspect_labels"])
    for labels in touched.values():
        named = {classes[i] for i, y in enumerate(labels[0]) if y == 1.0}
        assert len(labels) == (3 if named & rare else 1)


def test_split_shares_per_rarest_label(spark):
    technical = L.technical_rows(L.with_pairs(labelled_sentences(many(spark))))
    rows = L.split_technical(technical).groupBy("rarest_combo", "split").count().collect()
    by = {}
    for r in rows:
        by.setdefault(r["rarest_combo"], {})[r["split"]] = r["count"]
    for counts in by.values():
        n = sum(counts.values())
        assert abs(counts.get("train", 0) - 0.7 * n) <= 1 and abs(counts.get("val", 0) - 0.15 * n) <= 1


def test_rewrites_fall_back(spark):
    train = spark.createDataFrame([("r1", "old text", ["gift"], 0, 0)], "row_id string, sentence_for_model string, aspects_parsed array<string>, is_related int, is_technical int")
    vocabulary = L.vocabulary_array(train)
    rare = spark.createDataFrame([(0, "gift", 1)], "idx int, aspect string, n long")
    rewrites = spark.createDataFrame(
        [("r1", 1, "a new text of five words", "en"), ("r1", 2, "too short", "en")],
        "row_id string, copy int, new_text string, new_language string",
    )
    out = L.oversample_rare(train, rare, vocabulary, 2, rewrites).collect()
    assert sorted(r["sentence_for_model"] for r in out) == ["a new text of five words", "old text", "old text"]
    assert len({r["row_id"] for r in out}) == 3 and all(r["is_related"] == r["is_technical"] == 1 for r in out)


def test_no_rare_class(spark):
    train = spark.createDataFrame([("r1", "t", ["a"], 1, 1)], "row_id string, sentence_for_model string, aspects_parsed array<string>, is_related int, is_technical int")
    counts = L.aspect_counts(train, L.aspect_vocabulary(train))
    rare = L.rare_classes(counts, 1)
    assert rare.count() == 0
    assert L.oversample_rare(train, rare, L.vocabulary_array(train)).count() == 1


def test_weights(spark):
    df = spark.createDataFrame(
        [([1.0, 0.0, 0.0], True), ([1.0, 0.0, 1.0], True), ([-1.0, -1.0, -1.0], False)],
        "aspect_labels array<float>, has_aspect_label boolean",
    )
    got = {r["idx"]: r["pos_weight"] for r in L.positive_weights(df).collect()}
    assert got[0] == 0.1 and got[1] == 10.0 and got[2] == pytest.approx(1.0, abs=1e-5)
    labels = spark.createDataFrame([(1,)] * 30, "label_idx int")
    weights = {r["label_idx"]: r["weight"] for r in L.class_weights(labels).collect()}
    assert weights == {0: 5.0, 1: 0.5}


def test_triples(spark):
    df = L.with_pairs(labelled_sentences(sentences(spark, [("s", 0, 1, "a;b;c;d", "-1;0;1;7"), ("t", 1, 0, "a", "-1")])))
    got = {(r["aspect"], r["label_idx"]) for r in L.sentiment_triples(df).collect()}
    assert got == {("a", 0), ("b", 1), ("c", 1), ("d", 1)}


def test_domain_texts(spark):
    pool = spark.createDataFrame([(f"s{i}",) for i in range(50)] + [(None,)], "sentence_for_model string")
    held = spark.createDataFrame([("s1",), ("s2",), (None,)], "sentence_for_model string")
    train = spark.createDataFrame([("t",), ("t",)], "sentence_for_model string")
    out = [r[0] for r in jobs.domain_texts(pool, held, train, 20).collect()]
    assert len(out) == 22 and out.count("t") == 2 and not {"s1", "s2"} & set(out)
    assert jobs.domain_texts(pool, held, train, 1000).count() == 50


def test_pairs_are_parsed_once(spark, sf_dir):
    """No plan that follows the stored pairs parses them again."""
    from starsift.catalog import QUERIES

    for name in ("l05_multi_hot", "l06_rare_classes", "l07_oversample_rare", "l10_positive_weights", "e38_simulated_counts"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert "try_cast" not in plan.lower() and "RLIKE" not in plan and "target_sentiment" not in plan.split("LogicalRDD")[0]
