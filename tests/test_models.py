"""Metrics, threshold tuning, the gate and trained models."""

import pickle

import pytest
from pyspark import RDD, SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizer, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import DenseVector
from pyspark.sql import functions as F

from starsift.catalog import QUERIES
from starsift.catalog.tables import Tables
from starsift.operators import labels as L
from starsift.operators import metrics as E
from starsift.operators import models as M
from starsift.plans.jobs import training_frames, tuned_thresholds
from starsift.session import cut_lineage
from starsift.sources.readers import labelled_sentences
from starsift.sources.writers import read_thresholds, save_thresholds


def scored(spark, rows):
    return spark.createDataFrame(rows, "y int, p double")


def f_macro(y, z, beta):
    scores = []
    for c in sorted(set(y) | set(z)):
        tp = sum(a == c and b == c for a, b in zip(y, z))
        fp = sum(a != c and b == c for a, b in zip(y, z))
        fn = sum(a == c and b != c for a, b in zip(y, z))
        d = (1 + beta**2) * tp + beta**2 * fn + fp
        scores.append((1 + beta**2) * tp / d if d else 0.0)
    return sum(scores) / len(scores)


def test_grids():
    assert (len(E.HEAD_GRID), len(E.ASPECT_GRID), len(E.CONFIDENCE_GRID)) == (17, 41, 11)
    assert E.HEAD_GRID[0] == 0.1 and E.HEAD_GRID[-1] == pytest.approx(0.9)


@pytest.mark.parametrize(
    "rows",
    [
        [(1, 0.9), (0, 0.2), (1, 0.35), (0, 0.5), (1, 0.1), (0, 0.05)],
        [(1, 0.5)] * 4 + [(0, 0.5)] * 3,
        [(0, 0.05), (0, 0.02)],
        [(1, 0.01), (1, 0.02)],
    ],
)
def test_head_tuning_matches_brute_force(spark, rows):
    best, cut = 0.0, 0.5
    for t in E.HEAD_GRID:
        f = f_macro([y for y, _ in rows], [int(p >= t) for _, p in rows], 2.0)
        if f > best + 1e-15:
            best, cut = f, t
    got = E.tune_head(scored(spark, rows), "y", "p").first()
    assert got["threshold"] == cut and got["best_f_beta"] == pytest.approx(best)


def test_aspect_without_positives_gets_the_default(spark):
    df = spark.createDataFrame([("a", 0, 0.9), ("a", 0, 0.1), ("b", 1, 0.33), ("b", 0, 0.2)], "aspect string, y int, p double")
    got = {r["aspect"]: r["threshold"] for r in E.tune_aspects(df, "aspect", "y", "p").collect()}
    assert got["a"] == 0.5 and got["b"] == E.ASPECT_GRID[6] > 0.2


def test_confidence_stops_at_few_rows(spark):
    rows = [(1, 1, 0.95)] * 9 + [(1, 0, 0.7)] * 3 + [(0, 0, 0.55)] * 2
    df = spark.createDataFrame(rows, "y int, z int, c double")
    table = E.confidence_table(df, "y", "z", "c").orderBy("i").collect()
    assert [r["n"] for r in table][:4] == [14, 14, 14, 14][: len(table)] and all(r["n"] >= 10 for r in table)
    assert max(r["threshold"] for r in table) < 0.75
    few = E.tune_confidence(df.limit(5), "y", "z", "c").first()
    assert few is None or few["threshold"] in (None, 0.65)


def test_report(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "y int, z int")
    got = {r["class"]: r for r in E.class_report(df, "y", "z").collect()}
    assert got[1]["precision"] == pytest.approx(1 / 3) and got[1]["recall"] == 1.0
    assert got[2]["f1"] == 0.0 and got[2]["precision"] == 0.0 and got[0]["support"] == 2
    one = E.overall_scores(df, "y", "z").first()
    assert one["accuracy"] == 0.5 and one["f1_macro"] == pytest.approx((2 / 3 + 0.5 + 0) / 3)


def test_sample_f1_of_empty_rows(spark):
    df = spark.createDataFrame([([0.0, 0.0], [0.0, 0.0]), ([1.0, 1.0], [1.0, 0.0])], "t array<float>, p array<float>")
    assert E.sample_f1(df, "t", "p").first()[0] == pytest.approx((0 + 2 / 3) / 2)


def probabilities(spark):
    return spark.createDataFrame(
        [
            (1, "both", 0.9, 0.9, [("battery", 0.9), ("screen", 0.6)]),
            (2, "unrelated", 0.1, 0.9, [("battery", 0.9), ("screen", 0.6)]),
            (3, "general", 0.9, 0.1, [("battery", 0.9), ("screen", 0.6)]),
            (4, "nothing", 0.9, 0.9, [("battery", 0.1), ("screen", 0.1)]),
        ],
        "id int, text string, p_related double, p_technical double, p_aspects array<struct<aspect:string,prob:double>>",
    )


def test_gate(spark):
    cuts = M.Thresholds(0.5, 0.5, {"battery": 0.5, "screen": 0.5}, 0.65)
    df = probabilities(spark)

    def positive(aspect):
        return F.when(aspect == "battery", 0.123456).otherwise(0.6)

    gated = M.gate(df, cuts)
    pairs = M.detected_pairs(gated, ["id"], "text").withColumn("p_positive", positive(F.col("aspect")))
    joined = {r["id"]: r for r in M.assemble(gated, pairs, ["id"], "text", cuts).collect()}
    in_row = {r["id"]: r for r in M.score_in_row(df, ["id"], "text", cuts, positive).collect()}
    assert joined == in_row
    first = joined[1]
    assert [tuple(a) for a in first["sentiment_aspects"]] == [("battery", "Negative", 0.8765)]
    assert first["mentioned_aspects"] == ["screen"]
    assert (joined[2]["is_related"], joined[2]["is_technical"]) == (False, True)
    assert all(joined[i]["sentiment_aspects"] == joined[i]["mentioned_aspects"] == [] for i in (2, 3, 4))


def test_thresholds_round_trip(spark, tmp_path):
    rows = [("h1", "", 0.2), ("h2", "", 0.3), ("h3", "battery", 0.4), ("m2", "", 0.65)]
    target = str(tmp_path / "cuts")
    save_thresholds(spark.createDataFrame(rows, "head string, class string, threshold double"), target)
    got = M.Thresholds.from_table(read_thresholds(spark, target))
    assert got == M.Thresholds(0.2, 0.3, {"battery": 0.4}, 0.65)


def test_tuned_thresholds_reach_the_gate(spark, sf_dir):
    cuts = M.Thresholds.from_table(QUERIES["a11_stored_thresholds"](spark, sf_dir))
    assert 0.1 <= cuts.related <= 0.9 and 0.1 <= cuts.technical <= 0.9 and 0.4 <= cuts.confidence <= 0.9
    assert cuts.aspects
    names = list(cuts.aspects)
    given = spark.createDataFrame(
        [(1, "text", 1.0, 1.0, [(a, 1.0) for a in names])],
        "id int, text string, p_related double, p_technical double, p_aspects array<struct<aspect:string,prob:double>>",
    )
    assert M.gate(given, cuts).first()["detected"] == names


def titles(spark, n=120):
    rows = [(f"gaming laptop computer model {i % 7}", 1) for i in range(n)]
    rows += [(f"usb cable adapter pack {i % 5}", 0) for i in range(n // 3)]
    return spark.createDataFrame(rows, "title string, label int")


def test_thresholds_from_the_models_own_probabilities(spark):
    rows = [(i, int(i % 3 > 0), int(i % 3 == 2), i % 3 == 2, [float(i % 2), 0.0], i / 40) for i in range(40)]
    val = spark.createDataFrame(rows, "row_id int, is_related int, is_technical int, has_aspect_label boolean, aspect_labels array<float>, p double")
    triples = spark.createDataFrame([(i, i % 2) for i in range(40)], "row_id int, label_idx int")

    class Given:
        aspects = {"battery": None, "screen": None}

        def probabilities(self, df, text):
            named = [F.struct(F.lit(a).alias("aspect"), F.col("p").alias("prob")) for a in self.aspects]
            return df.withColumns({"p_related": F.col("p"), "p_technical": 1 - F.col("p"), "p_aspects": F.array(*named)})

    def sentiment(df):
        return df.withColumn("p_positive", F.col("label_idx") * 0.8 + 0.1)

    cuts = M.Thresholds.from_table(tuned_thresholds(val, triples, Given(), sentiment))

    def best(pairs):
        scores = [f_macro([y for y, _ in pairs], [int(p >= c) for _, p in pairs], 2.0) for c in E.HEAD_GRID]
        return E.HEAD_GRID[max(range(len(scores)), key=lambda i: (round(scores[i], 12), -i))]

    assert cuts.related == best([(r[1], r[5]) for r in rows])
    assert cuts.technical == best([(r[2], 1 - r[5]) for r in rows if r[1]])
    # no row speaks for the screen; every confidence is 0.9, so the first cut is as good as any
    assert cuts.aspects["screen"] == E.DEFAULT_THRESHOLD and set(cuts.aspects) == {"battery", "screen"}
    assert cuts.confidence == E.CONFIDENCE_GRID[0]
    empty = M.Thresholds.from_table(tuned_thresholds(val.limit(0), triples.limit(0), Given(), sentiment))
    assert empty == M.Thresholds(0.5, 0.5, {"battery": 0.5, "screen": 0.5}, E.DEFAULT_CONFIDENCE)


def test_title_classifier(spark):
    df = titles(spark)
    model = M.train_title_classifier(df, max_iter=30)
    shop = spark.createDataFrame(
        [("Computers", "Gaming LAPTOP computer", "a", 4.0, 9, None), ("Computers", "usb cable adapter", "b", 4.0, 9, 1.0)],
        "main_category string, title string, parent_asin string, average_rating double, rating_number long, price double",
    )
    out = M.score_products(model, shop)
    assert out.columns == ["main_category", "title", "parent_asin", "average_rating", "rating_number", "price",
                           "prob_digital", "pred_label"]
    got = {r["parent_asin"]: r for r in out.collect()}
    assert got["a"]["pred_label"] == 1 and got["b"]["pred_label"] == 0
    assert [r["parent_asin"] for r in M.device_products(out).collect()] == ["a"]
    top = M.strongest_terms(M.term_weights(model), 3, 2).collect()
    assert {r["term"] for r in top if r["side"] == "high"} <= {
        "gaming", "laptop", "computer", "model", "gaming laptop", "laptop computer", "computer model"
    }


def vectors_by_vocabulary(df, text, min_docs=M.MIN_DOCS):
    """The plain form of the title features: a vocabulary on the driver, and vectors."""
    terms = Pipeline(
        stages=[*M.term_stages(text), CountVectorizer(inputCol="terms", outputCol="_tf", minDF=min_docs, vocabSize=1 << 30)]
    ).fit(df)
    idf = IDF(inputCol="_tf", outputCol="_idf").fit(terms.transform(df)).idf.toArray()
    weigh = ElementwiseProduct(scalingVec=DenseVector(idf + 1.0), inputCol="_tf", outputCol="_weighted")
    return PipelineModel([*terms.stages, weigh, Normalizer(inputCol="_weighted", outputCol="features", p=2.0)])


def test_title_model_equals_the_vector_form(spark, sf_dir):
    """Terms, coefficients and probabilities against a vocabulary and vectors, with repeated and odd titles."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id")
    df = docs.select(F.substring("text", 1, 200).alias("title"), F.col("quality").alias("label"))
    df = cut_lineage(df.unionAll(df.limit(9)).unionAll(spark.createDataFrame([("", 0), ("42", 1), ("zz", 1)], df.schema)))
    odd = df.unionAll(spark.createDataFrame([(None, 1), ("words without label", None)], df.schema))
    model = M.train_title_classifier(odd)
    plain = vectors_by_vocabulary(df, "title")
    n, k = df.count(), dict(df.groupBy("label").count().collect())
    weight = F.when(F.col("label") == 1, n / (2 * k[1])).otherwise(n / (2 * k[0]))
    head = LogisticRegression(weightCol="weight", maxIter=M.MAX_ITERATIONS, regParam=1 / n, standardization=False).fit(
        plain.transform(df).withColumn("weight", weight)
    )
    names = next(s.vocabulary for s in plain.stages if hasattr(s, "vocabulary"))
    got = {r["term"]: r["coefficient"] for r in M.term_weights(model).collect()}
    assert set(got) == set(names) and len(names) > 20
    assert [got[t] for t in names] == pytest.approx(list(head.coefficients.toArray()), abs=2e-3)
    want = [(r["title"], r["probability"][1]) for r in head.transform(plain.transform(df)).collect()]
    scored = model.score(odd).collect()
    assert len(scored) == n + 2
    probabilities = {r["title"]: r["prob_digital"] for r in scored}
    assert [probabilities[t] for t, _ in want] == pytest.approx([p for _, p in want], abs=1e-3)
    # a title without a known term, and no title, have the probability of the intercept
    assert probabilities["42"] == probabilities[None] == probabilities[""]
    plan = model.score(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_title_model_without_terms_or_rows(spark):
    one = spark.createDataFrame([("rare words", 1), ("other things", 0)], "title string, label int")
    model = M.train_title_classifier(one)
    assert model.terms.count() == 0 and {r["prob_digital"] for r in model.score(one).collect()} == {0.5}
    with pytest.raises(ValueError, match="no labelled title"):
        M.train_title_classifier(one.where("false"))


def test_title_features_are_unit_vectors_of_frequent_terms(spark):
    df = titles(spark).unionAll(spark.createDataFrame([("unicorn laptop", 1)], "title string, label int"))
    model = vectors_by_vocabulary(df, "title")
    terms = next(s.vocabulary for s in model.stages if hasattr(s, "vocabulary"))
    assert "unicorn" not in terms and "gaming laptop" in terms and "7" not in terms
    v = model.transform(df).first()["features"]
    assert v.norm(2) == pytest.approx(1.0)


def test_title_term_rows_equal_the_vectors(spark):
    df = titles(spark).unionAll(spark.createDataFrame([("unicorn laptop laptop", 1), ("", 0), ("x", 0)], "title string, label int"))
    df = cut_lineage(df.coalesce(1).withColumn("id", F.monotonically_increasing_id()))
    model = vectors_by_vocabulary(df, "title")
    names = next(s.vocabulary for s in model.stages if hasattr(s, "vocabulary"))
    expected = {}
    for r in model.transform(df).collect():
        tf = dict(zip(r["_tf"].indices.tolist(), r["_tf"].values.tolist()))
        expected |= {(r["id"], names[i]): (tf[i], w) for i, w in zip(r["features"].indices.tolist(), r["features"].values)}
    rows = M.title_term_weights(df, "id", "title").collect()
    assert {(r["id"], r["term"]) for r in rows} == set(expected) and len(rows) == len(expected)
    for r in rows:
        assert (r["count"], r["weight"]) == pytest.approx(expected[r["id"], r["term"]])
        assert r["document_count"] >= M.MIN_DOCS


def test_registered_models_score_the_test_split(spark, sf_dir):
    test = {r["row_id"] for r in training_frames(Tables(spark, sf_dir).order_sentences).test.select("row_id").collect()}
    p = QUERIES["m04_aspect_probabilities"](spark, sf_dir).collect()
    aspects = {r["aspect"] for r in p}
    assert len(aspects) > 1 and {(r["row_id"], r["aspect"]) for r in p} == {(i, a) for i in test for a in aspects}
    assert len(p) == len(test) * len(aspects) and all(0 <= r["probability"] <= 1 for r in p)
    cut = {(r["row_id"], r["aspect"]) for r in p if r["p_related"] >= 0.5 and r["p_technical"] >= 0.5 and r["probability"] >= 0.5}
    scored = QUERIES["m07_score_sentences"](spark, sf_dir).collect()
    assert {r["row_id"] for r in scored} == test and len(scored) == len(test)
    found = [(r["row_id"], a) for r in scored for a in [*[x["aspect"] for x in r["sentiment_aspects"]], *r["mentioned_aspects"]]]
    assert cut and sorted(found) == sorted(cut)


def test_sentences_are_scored_at_the_stored_cuts(spark, sf_dir):
    cuts = M.Thresholds.from_table(QUERIES["a11_model_thresholds"](spark, sf_dir))
    p = QUERIES["m04_aspect_probabilities"](spark, sf_dir).collect()
    assert set(cuts.aspects) == {r["aspect"] for r in p}
    cut, near = set(), set()
    for r in p:
        over = [r["p_related"] - cuts.related, r["p_technical"] - cuts.technical, r["probability"] - cuts.aspects[r["aspect"]]]
        if min(map(abs, over)) < 1e-6:
            near.add((r["row_id"], r["aspect"]))
        elif min(over) > 0:
            cut.add((r["row_id"], r["aspect"]))
    scored = QUERIES["m07_score_at_tuned_cuts"](spark, sf_dir).collect()
    assert len(scored) == len({r["row_id"] for r in p})
    said = [(r["row_id"], x["aspect"], x["confidence"]) for r in scored for x in r["sentiment_aspects"]]
    found = {(i, a) for i, a, _ in said} | {(r["row_id"], a) for r in scored for a in r["mentioned_aspects"]}
    assert cut and found - near == cut - near
    assert all(c >= cuts.confidence - 1e-4 for _, _, c in said)


def test_aspect_and_sentiment_models(spark):
    rows = []
    for i in range(60):
        rows.append((f"battery lasts {'badly' if i % 2 else 'well'}", 1, 1, "battery", "-1" if i % 2 else "1"))
        rows.append((f"screen looks {'badly' if i % 3 == 0 else 'well'}", 1, 1, "screen", "-1" if i % 3 == 0 else "1"))
        rows.append(("general words only", 1, 0, None, None))
        rows.append(("something else entirely", 0, 0, None, None))
    raw = spark.createDataFrame(rows, "sentence_for_model string, is_related int, is_technical int, target_aspect string, target_sentiment string")
    parsed = L.with_pairs(labelled_sentences(raw))
    technical = L.technical_rows(parsed)
    frame = L.with_aspect_labels(parsed, technical, L.vocabulary_array(technical))
    aspects = M.train_aspect_model(frame, ["battery", "screen"], {"battery": 1.0, "screen": 1.0}, max_iter=20)
    triples = L.sentiment_triples(parsed)
    sentiment = M.train_sentiment_model(triples, L.class_weights(triples), max_iter=20)
    cuts = M.Thresholds(0.5, 0.5, {"battery": 0.5, "screen": 0.5}, 0.5)
    texts = spark.createDataFrame(
        [(1, "battery lasts badly"), (2, "screen looks well"), (3, "something else entirely")], "id int, text string"
    )
    got = {r["id"]: r for r in M.score_texts(texts, ["id"], "text", aspects, sentiment, cuts).collect()}
    assert [(a["aspect"], a["sentiment"]) for a in got[1]["sentiment_aspects"]] == [("battery", "Negative")]
    assert [(a["aspect"], a["sentiment"]) for a in got[2]["sentiment_aspects"]] == [("screen", "Positive")]
    assert not got[3]["is_related"] and got[3]["sentiment_aspects"] == []


def _small_models(spark):
    rows = [(f"battery lasts {'badly' if i % 2 else 'well'} {i}", 1, 1, "battery", "-1" if i % 2 else "1") for i in range(40)]
    rows += [("general words only", 1, 0, None, None), ("something else entirely", 0, 0, None, None)] * 20
    rows += [("screen looks well", 0, 1, "screen;battery", "1;-1")] * 3
    raw = spark.createDataFrame(rows, "sentence_for_model string, is_related int, is_technical int, target_aspect string, target_sentiment string")
    frames = training_frames(raw)
    aspects = M.train_aspect_model(frames.train, ["battery"], {}, max_iter=5)
    triples = frames.triples()
    return raw, frames, aspects, M.train_sentiment_model(triples, L.class_weights(triples), max_iter=5)


def test_triples_come_from_the_stored_split(spark):
    raw, frames, _, _ = _small_models(spark)
    plain = L.sentiment_triples(L.with_pairs(labelled_sentences(raw)))
    got = frames.triples()
    assert sorted(map(tuple, got.drop("split").collect())) == sorted(map(tuple, plain.collect()))
    split = {r["row_id"]: name for name in ("val", "test") for r in getattr(frames, name).select("row_id").collect()}
    rows = got.collect()
    assert {r["split"] for r in rows} == {"train", "val", "test"}
    assert all(split.get(r["row_id"], "train") == r["split"] for r in rows)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2" not in plan and "target_sentiment, ;" not in plan


def test_heads_run_once_for_each_scored_text(spark):
    """No head, and no cut of texts into terms for the heads, stands in what reads the gated texts."""
    raw, _, aspects, sentiment = _small_models(spark)
    texts = labelled_sentences(raw).select(F.col("row_id").alias("id"), F.col("sentence_for_model").alias("text"))
    out = M.score_texts(texts, ["id"], "text", aspects, sentiment, M.Thresholds(0.5, 0.5, {"battery": 0.5}, 0.5))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "p_related" not in plan and "sentence_for_model" not in plan
    assert out.count() == texts.count()


def test_cuts_are_tuned_on_stored_probabilities(spark):
    _, frames, aspects, sentiment = _small_models(spark)
    triples = frames.triples().where("split = 'val'").drop("split")
    tuned = tuned_thresholds(frames.val, triples, aspects, sentiment)
    assert "UDF" not in tuned._jdf.queryExecution().optimizedPlan().toString()
    assert {(r["head"], r["class"]) for r in tuned.collect()} == {("h1", ""), ("h2", ""), ("h3", "battery"), ("m2", "")}


def test_title_steps_do_not_follow_the_rarity_of_terms(spark, monkeypatch):
    """Terms of very different frequency: few passes over the titles, and the least value to many places."""
    names = ["".join(chr(97 + d) for d in (i // 26, i % 26)) for i in range(200)]
    rows = [(f"common c{names[i % 7]} " + (f"rare{names[i // 6]} " if i % 3 else "") + f"mid{names[i % 40]}", int(i * i % 11 < 5)) for i in range(600)]
    df = spark.createDataFrame(rows, "title string, label int")
    seen = []
    plain = M._minimum

    def counted(function, scale, start, max_iter):
        def value_and_gradient(x):
            out = function(x)
            seen.append(out)
            return out

        return plain(value_and_gradient, scale, start, max_iter)

    monkeypatch.setattr(M, "_minimum", counted)
    model = M.train_title_classifier(df, min_docs=2)
    assert model.terms.count() > 100 and len(seen) < 60
    assert max(abs(seen[-1][1])) < 1e-5
    one_class = M.train_title_classifier(df.where("label = 1"), min_docs=2)
    assert one_class.intercept == float("inf") and {r["coefficient"] for r in one_class.terms.collect()} == {0.0}


def test_title_coefficients_stay_off_the_driver(spark, monkeypatch):
    """What the driver sends and gets in a fit does not follow the vocabulary; slices and groups give the same model."""
    names = ["".join(chr(97 + d) for d in (i // 676, i // 26 % 26, i % 26)) for i in range(3000)]
    pairs = [f"{a} {names[i * 7 % 3000]}" for i, a in enumerate(names)]
    rows = [(" ".join(pairs[(i * 7 + j * j * 31) % 3000] for j in range(8)), int(i * i % 11 < 5)) for i in range(2000)]
    df = cut_lineage(spark.createDataFrame(rows, "title string, label int").repartition(6))
    whole = M.train_title_classifier(df, min_docs=2, max_iter=12)
    sizes = []

    def sized(value):
        sizes.append(len(pickle.dumps(value)))
        return value

    collect, broadcast = RDD.collect, SparkContext.broadcast
    monkeypatch.setattr(RDD, "collect", lambda self: sized(collect(self)))
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, value: broadcast(self, sized(value)))
    for name, value in (("SLICE_TERMS", 4000), ("BLOCK_TERMS", 2000), ("GROUP_TITLES", 100)):
        monkeypatch.setattr(M, name, value, raising=False)
    cut = M.train_title_classifier(df, min_docs=2, max_iter=12)
    terms = whole.terms.count()
    assert terms > 5000 and sizes and max(sizes) < 4 * terms
    one, other = ({r["term"]: r["coefficient"] for r in m.terms.collect()} for m in (whole, cut))
    assert set(one) == set(other) and len({round(c, 6) for c in one.values()}) > 100
    assert [other[t] for t in one] == pytest.approx(list(one.values()), abs=1e-7)
    assert cut.intercept == pytest.approx(whole.intercept, abs=1e-7)


def test_title_term_rows_read_the_texts_once(spark):
    """Words are found once; what follows starts from the stored counts, and rows that share a key count together."""
    df = spark.createDataFrame([(i // 2, "red laptop case " + "red " * (i % 3)) for i in range(20)], "id long, title string")
    out = M.title_term_weights(df, "id", "title")
    assert "sort_array" not in out._jdf.queryExecution().optimizedPlan().toString()
    counts = {(r["id"], r["term"]): r["count"] for r in out.collect()}
    assert counts[0, "laptop"] == 2 and counts[0, "red"] == 3 and len({i for i, _ in counts}) == 10
