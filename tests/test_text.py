"""Text cleaning, sentences, language, sentiment, leakage."""

import math
import random

import pytest
from pyspark.sql import functions as F

from starsift.functions import textclean as C
from starsift.operators import text as X


def apply(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("t"))).collect()]


@pytest.mark.parametrize(
    "raw, wanted",
    [
        (None, ""),
        ("a &amp;lt; b", "a &lt; b"),
        ("5 &lt;3 you", "5 <3 you"),
        ("I <3 it<br/>yes", "I <3 it. yes"),
        ("x<BR />y<b>z</b>", "x. y z"),
        ("a  b", "a b"),
        ("good.It is", "good. It is"),
        ("wait . . . what", "wait. what"),
        ("one\n\ntwo", "one. two"),
        ("see https://x.y/z?q now", "see now"),
        ("see www.x.y now", "see now"),
        ("[[VIDEOID:ab c]] fine", "fine"),
        ("## Features ## good", ". Features. good"),
        ("a - b * c multi-core", "a. b. c multi-core"),
        ("  \t ", ""),
        ("end...", "end."),
        ("&copy 2 &notanentity; &#39;q&#39;", "© 2 ¬anentity; 'q'"),
    ],
)
def test_clean(spark, raw, wanted):
    assert apply(spark, [raw], C.clean_text) == [wanted]


def test_long_text_is_cleaned_whole(spark):
    assert apply(spark, ["word\n" * 50_000], C.clean_text)[0].count("word") == 50_000


def test_model_text(spark):
    assert apply(spark, ["  GOOD<br>\n Screen "], C.model_text) == ["good. screen"]


def test_sentences(spark):
    got = apply(spark, ["Dr. Who came. He saw! Why?  Ok e.g. this. A. B. end", ""], C.sentences)
    assert got == [["Dr. Who came.", "He saw!", "Why?", "Ok e.g. this.", "A. B. end"], []]


def test_short_sentences_are_left_out(spark):
    df = spark.createDataFrame([(1, "No way. It is a good one. Ok.")], "review_id int, review_text string")
    rows = X.explode_sentences(df).select("sentence_no", "sentence").collect()
    assert [tuple(r) for r in rows] == [(0, "No way."), (1, "It is a good one.")]


def test_language(spark):
    train = spark.createDataFrame(
        [("en", "the cat and the hat with that thing"), ("de", "der hund und die katze nicht das")], "lang string, t string"
    )
    model = X.LanguageModel.from_profiles(X.language_profiles(train, "t", "lang"))
    texts = ["the hat and that", "und die katze", None, "ab", "12345", "你好你好", "zzz zzz", "  \n the  "]
    assert apply(spark, texts, lambda c: X.language_of(c, model)) == [
        "en", "de", "unknown", "unknown", "unknown", "unknown", "unknown", "en",
    ]
    empty = X.LanguageModel.from_profiles(X.language_profiles(train.where("false"), "t", "lang"))
    assert apply(spark, ["the hat"], lambda c: X.language_of(c, empty)) == ["unknown"]


def test_language_by_join_equals_the_arrays(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(-1, None), (-2, "ab"), (-3, "12345"), (-4, "zzz zzz"), (-5, ""), (-6, "\U0001f642\U0001f642 a the")], "doc_id long, text string")
    texts = docs.select("doc_id", "text").unionAll(odd)
    profiles = X.language_profiles(docs, "text", "lang")
    by_array = X.with_language(texts, ["doc_id"], "text", profiles)
    by_join = X.with_language(texts, ["doc_id"], "text", profiles, most_rows=0)
    got = {r["doc_id"]: r["language"] for r in by_join.collect()}
    assert got == {r["doc_id"]: r["language"] for r in by_array.collect()} and len(got) == texts.count()
    assert len(set(got.values())) >= 4 and got[-1] == got[-2] == got[-3] == got[-5] == "unknown"


def test_profiles_keep_every_piece_of_a_large_table(spark):
    """A piece seen once among two million stays in the profile."""
    many = spark.range(2000).select(F.lit("en").alias("lang"), F.expr("concat(repeat('abc', 333), if(id = 7, 'xyz', ''))").alias("t"))
    kept = {r["gram"] for r in X.language_profiles(many, "t", "lang").collect()}
    assert kept == {"abc", "bca", "cab", "bcx", "cxy", "xyz"}
    assert X.language_profiles(many, "t", "lang", least_per_million=1.0).count() == 3


def test_sentiment_rules(spark):
    lexicon = spark.createDataFrame([("good", 2.0), ("bad", -2.5)], "word string, valence double")
    texts = {
        "a": "good", "b": "not good", "c": "very good", "d": "not a very good", "e": "nothing here", "f": None,
        "g": "GOOD, bad!", "h": "not one two three good",
    }
    df = spark.createDataFrame(list(texts.items()), "id string, t string")
    got = {r["id"]: r["s"] for r in X.lexicon_sentiment(df, lexicon, ["id"], "t", "s").collect()}

    def scaled(x):
        return x / math.sqrt(x * x + 15)

    assert got["a"] == got["h"] == pytest.approx(scaled(2))
    assert got["b"] == pytest.approx(scaled(-1.48))
    assert got["c"] == pytest.approx(scaled(2.293))
    assert got["d"] == pytest.approx(scaled(-0.74 * 2.293))
    assert got["e"] == got["f"] == 0.0
    assert got["g"] == pytest.approx(scaled(-0.5))


@pytest.mark.parametrize("limit", [X.NEEDLE_BYTES, 16])
def test_contained_texts_in_one_or_many_groups(spark, limit):
    docs = spark.createDataFrame(
        [(1, "the quick brown fox"), (2, "a quick\nbrown dog"), (3, None), (4, "xquick brown foxx" * 3)], "id int, t string"
    )
    needles = spark.createDataFrame(
        [("quick brown",), ("brown fox",), ("dog",), ("",), (None,), ("été",), ("dog",)], "n string"
    )
    got = {tuple(r) for r in X.contained_texts(docs, "id", "t", needles, "n", limit).collect()}
    assert got == {(1, "quick brown"), (1, "brown fox"), (2, "dog"), (4, "quick brown"), (4, "brown fox")}


@pytest.mark.parametrize("limit", [X.NEEDLE_BYTES, 0])
def test_contained_texts_against_every_pair(spark, monkeypatch, limit):
    """A run that every text holds, needles cut inside words, texts that repeat and ids that are null."""
    monkeypatch.setattr(X, "COMMON_RUN", 3)
    rng = random.Random(3)
    words = ["to", "be", "or", "not", "thé", "\U0001f642x", "a"]
    texts = [(i % 70, "all texts hold this run " + " ".join(rng.choice(words) for _ in range(rng.randrange(30)))) for i in range(80)]
    texts += [(None, "to be or not to be"), (None, None), (5, ""), (6, "to  be  or")]
    needles = {t[rng.randrange(10) :][: rng.randrange(1, 60)] for _, t in texts if t} | {"hold this run", "texts hold this run to", "to  be", "absent words here now"}
    frame = spark.createDataFrame(texts, "id int, t string")
    got = X.contained_texts(frame, "id", "t", spark.createDataFrame([(n,) for n in needles], "n string"), "n", limit)
    want = [(i, n) for i, t in texts for n in needles if n and t and n in t]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Arrow" not in plan


def test_contained_texts_with_many_needles(spark):
    """More needles than are sent to every task."""
    texts = spark.range(300).select("id", F.concat(F.lit("text begins "), F.repeat(F.concat("id", F.lit(" some words ")), 20)).alias("t"))
    needles = spark.range(200_000).select(F.concat(F.lit("gins "), "id", F.lit(" some words "), "id", F.lit(" some words "), "id").alias("n"))
    assert X.contained_texts(texts, "id", "t", needles, "n", 1 << 20).count() == 300


def test_leakage_audit_uses_cleaned_long_contexts(spark):
    docs = spark.createDataFrame([(1, "say. this is a fairly long context. bye")], "id int, t string")
    labelled = spark.createDataFrame(
        [(" this is a<br>fairly long context ",), ("this is a. fairly long context",), ("say",), (None,),
         ("this is a fairly long context",)], "review_context string"
    )
    rows = X.leakage_audit(docs, "id", "t", labelled).collect()
    assert [(r["needle"], r["n_texts"]) for r in rows] == [("this is a fairly long context", 1)]


def test_drop_labelled_texts_cleans_both_sides(spark):
    df = spark.createDataFrame([(1, "good stuff here"), (2, "keep me")], "id int, review_text string")
    labelled = spark.createDataFrame([("good<b>stuff</b>here",), (None,)], "review_context string")
    assert [r["id"] for r in X.drop_labelled_texts(df, labelled).collect()] == [2]


def test_translations(spark):
    df = spark.createDataFrame(
        [(1, "hola", "es"), (2, "hola", "fr"), (3, "hi", "en"), (4, "ciao", "it"), (5, None, "unknown")],
        "id int, review_text string, language string",
    )
    table = df.where("id = 1").select(F.md5("review_text").alias("text_hash"), "language", F.lit("hello").alias("text_en"))
    got = {r["id"]: r["review_text"] for r in X.apply_translations(df, table).collect()}
    assert got == {1: "hello", 2: "hola", 3: "hi", 4: "ciao", 5: None}
    # several entries for one text keep one review, nulls in the table meet nothing, repeated rows stay
    more = table.unionAll(table).unionAll(table.withColumn("text_en", F.lit("hallo"))).unionAll(
        spark.createDataFrame([(None, "es", "no"), ("x", None, "no")], table.schema)
    )
    twice = df.unionAll(df).unionAll(spark.createDataFrame([(6, "sin idioma", None)], df.schema))
    rows = X.apply_translations(twice, more).collect()
    assert sorted((r["id"], r["review_text"] or "") for r in rows) == sorted(
        [(1, "hallo"), (2, "hola"), (3, "hi"), (4, "ciao"), (5, "")] * 2 + [(6, "sin idioma")]
    )
    plan = X.apply_translations(df, more)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan.split("Aggregate")[0]


def test_accept_rewrite(spark):
    rows = [("o", "one two three four five", "en"), ("o", "one two", "en"), ("o", "a b c d e f", "de"), ("o", None, "en"),
            ("o", "a b c d e", None)]
    df = spark.createDataFrame(rows, "a string, b string, l string")
    got = df.select(X.accept_rewrite(F.col("a"), F.col("b"), F.col("l"))).collect()
    assert [r[0] for r in got] == ["one two three four five", "o", "o", "o", "o"]


def test_pieces_are_counted_in_the_row_and_in_small_batches(spark):
    """Counts as a plain walk over code points gives them, also of equal and odd texts, without a row per character."""
    texts = ["abcabcabc", "Ünï \U0001f642\U0001f642 x", "", None, "ab", "abcabcabc", "你好你好你"]
    rows = [(i, t, "en" if i % 2 else None) for i, t in enumerate(texts)] + [(100 + i, "abc " * i, "fr") for i in range(200)]
    other = spark.newSession()
    df = other.createDataFrame(rows, "id long, t string, lang string")
    want = {}
    for _, t, lang in rows:
        low = (t or "").lower()
        for k in range(len(low) - 2):
            if lang:
                want[lang, low[k : k + 3]] = want.get((lang, low[k : k + 3]), 0) + 1
    profiles = X.language_profiles(df, "t", "lang")
    total = {lang: sum(n for (of, _), n in want.items() if of == lang) for lang in ("en", "fr")}
    got = {(r["profile_lang"], r["gram"]): round((math.exp(r["weight"]) - 1) * total[r["profile_lang"]] / 1e6) for r in profiles.collect()}
    assert got == want
    assert int(other.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) == 1000
    plan = X.language_by_join(df, ["id"], "t", profiles)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan


def test_audit_sends_small_batches_to_python(spark):
    other = spark.newSession()
    texts = other.createDataFrame([(1, "one two three four five six seven")], "id long, t string")
    needles = other.createDataFrame([("two three four five six",)], "c string")
    assert X.leakage_audit(texts, "id", "t", needles, "c").count() == 1
    assert int(other.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) == 1000
