"""Labelled sentences: pairs, splits, vocabularies, oversampling and weights."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starsift.catalog.registry import n_rows, query, rounded
from starsift.catalog.sql import ctes, rnd
from starsift.catalog.tables import PAIRS, REST_SPLIT, SL, TECH_SPLIT, Tables
from starsift.operators import labels as L
from starsift.operators.splits import sample_rows, splits_overlap, stratified_split
from starsift.plans import jobs
from starsift.session import cut_lineage
from starsift.sources.readers import required_columns

BASE = ctes(SL, PAIRS)
SPLIT = ctes(SL, PAIRS, TECH_SPLIT)
FULL = ctes(SL, PAIRS, TECH_SPLIT, REST_SPLIT)


def _parsed(t: Tables):
    """Sentences with their pairs, stored: every later step would parse them again, for each class even."""
    return cut_lineage(L.with_pairs(t.sentences))


def _technical(t: Tables):
    return L.technical_rows(_parsed(t))


def _split(t: Tables):
    """Technical rows with their split, stored once for the vocabulary, the counts and the rows."""
    return cut_lineage(L.split_technical(_technical(t)))


def _train(t: Tables):
    return _split(t).where(F.col("split") == "train")


def _others(t: Tables):
    parsed = _parsed(t)
    return L.split_rest(parsed, L.technical_rows(parsed))


def joined(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda x: x.cast("string")), ";")


def as_bits(vector: Column) -> Column:
    return F.array_join(F.transform(vector, lambda x: x.cast("int").cast("string")), ";")


# --- A5, A6, B19-B22 ---------------------------------------------------------------


@query(
    "a05_row_ids",
    ctes(SL) + "SELECT row_id, sentence_for_model, is_related, is_technical, target_aspect, target_sentiment FROM sl",
)
def _(t: Tables):
    return required_columns(t.sentences)


@query(
    "b19_sentence_type",
    ctes(SL)
    + """SELECT CASE WHEN is_related = 0 THEN 'unrelated' WHEN is_technical = 0 THEN 'general' ELSE 'technical' END AS sentence_type,
      count(*) AS n FROM sl GROUP BY 1""",
)
def _(t: Tables):
    return L.with_sentence_type(t.sentences).groupBy("sentence_type").agg(n_rows().alias("n"))


@query(
    "b20_parse_pairs",
    BASE
    + """SELECT sl.row_id, coalesce(aspects, '') AS aspects, coalesce(sentiments, '') AS sentiments, aspects IS NOT NULL AS is_valid_pairs
    FROM sl LEFT JOIN (SELECT row_id, string_agg(aspect, ';' ORDER BY i) AS aspects,
      string_agg(CAST(sentiment AS VARCHAR), ';' ORDER BY i) AS sentiments FROM pairs GROUP BY 1) USING (row_id)""",
)
def _(t: Tables):
    return _parsed(t).select(
        "row_id",
        joined(F.col("aspects_parsed")).alias("aspects"),
        joined(F.col("sentiments_parsed")).alias("sentiments"),
        "is_valid_pairs",
    )


@query("b21_technical_rows", BASE + "SELECT row_id, CAST(len(aspects) AS INTEGER) AS n_pairs FROM tech")
def _(t: Tables):
    return _technical(t).select("row_id", F.size("pairs").alias("n_pairs"))


@query(
    "b22_combo_labels",
    BASE
    + """SELECT row_id, string_agg(aspect || '_' || sentiment, ';' ORDER BY i) AS combos FROM pairs
    WHERE is_related = 1 AND is_technical = 1 GROUP BY 1""",
)
def _(t: Tables):
    return _technical(t).select("row_id", joined(L.combo_labels(F.col("pairs"))).alias("combos"))


# --- L1-L3, D7 ---------------------------------------------------------------------------


@query(
    "l01_stratified_hold_out",
    """SELECT doc_id, quality, CASE WHEN rk <= floor(0.8e0 * size + 0.5e0) THEN 'train' ELSE 'test' END AS split FROM (
      SELECT *, row_number() OVER (PARTITION BY quality ORDER BY md5('42|' || doc_id)) AS rk,
        count(*) OVER (PARTITION BY quality) AS size FROM labels)""",
)
def _(t: Tables):
    rows = t.read("labels").select("doc_id", "quality")
    return stratified_split(rows, ["doc_id"], ["quality"], {"train": 0.8, "test": 0.2})


@query("l02_split_technical", SPLIT + "SELECT row_id, rarest_combo, split FROM ts")
def _(t: Tables):
    return _split(t).select("row_id", "rarest_combo", "split")


@query("l03_split_rest", FULL + "SELECT row_id, is_related, split FROM rest")
def _(t: Tables):
    return _others(t).select("row_id", "is_related", "split")


@query(
    "d07_disjoint_splits",
    FULL + "SELECT count(*) AS overlapping FROM (SELECT row_id FROM (SELECT row_id, split FROM ts UNION ALL SELECT row_id, split FROM rest) GROUP BY 1 HAVING count(DISTINCT split) > 1)",
)
def _(t: Tables):
    both = _split(t).select("row_id", "split").unionAll(_others(t).select("row_id", "split"))
    return splits_overlap(both, ["row_id"]).agg(n_rows().alias("overlapping"))


@query(
    "l02_share_error",
    SPLIT
    + f"""SELECT rarest_combo, split, n, total, {rnd("n / total - CASE split WHEN 'train' THEN 0.7e0 ELSE 0.15e0 END")} AS error FROM (
      SELECT rarest_combo, split, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY rarest_combo) AS BIGINT) AS total FROM ts GROUP BY 1, 2)""",
)
def _(t: Tables):
    return rounded(L.share_error(_split(t), L.SHARES, "rarest_combo"), "error")


# --- L4-L9 ---------------------------------------------------------------------------------

TRAIN = SPLIT.rstrip() + """,
tr AS (SELECT * FROM ts WHERE split = 'train'),
vocab AS (SELECT aspect, CAST(row_number() OVER (ORDER BY aspect) - 1 AS INTEGER) AS idx FROM (SELECT DISTINCT unnest(aspects) AS aspect FROM tr)),
tra AS (SELECT DISTINCT row_id, unnest(aspects) AS aspect FROM tr),
acount AS (SELECT idx, aspect, count(row_id) AS n FROM vocab LEFT JOIN tra USING (aspect) GROUP BY 1, 2),
rare AS (SELECT * FROM acount WHERE n < 150)
"""


@query("l04_vocabulary", TRAIN + "SELECT idx, aspect FROM vocab")
def _(t: Tables):
    return L.aspect_vocabulary(_train(t))


BITS = """(SELECT string_agg(CASE WHEN list_contains(src.aspects, v.aspect) THEN '1' ELSE '0' END, ';' ORDER BY idx) FROM vocab v)"""


@query("l05_multi_hot", TRAIN + f"SELECT row_id, split, {BITS} AS labels FROM ts src")
def _(t: Tables):
    parts = _split(t)
    vocabulary = L.vocabulary_array(parts.where(F.col("split") == "train"))
    hot = L.with_multi_hot(parts, vocabulary)
    return hot.select("row_id", "split", as_bits(F.col("aspect_labels")).alias("labels"))


@query(
    "e38_aspect_counts",
    TRAIN + f"SELECT idx, aspect, n, {rnd('n * 100e0 / (SELECT count(*) FROM tr)')} AS pct FROM acount",
)
def _(t: Tables):
    train = _train(t)
    return rounded(L.aspect_counts(train, L.aspect_vocabulary(train)), "pct")


@query(
    "e38_simulated_counts",
    TRAIN
    + """, hit AS (SELECT DISTINCT row_id FROM tra WHERE aspect IN (SELECT aspect FROM rare))
    SELECT aspect, n AS before, n + 2 * (SELECT count(*) FROM tra JOIN hit USING (row_id) WHERE tra.aspect = acount.aspect) AS after
    FROM acount""",
)
def _(t: Tables):
    train = _train(t)
    counts = L.aspect_counts(train, L.aspect_vocabulary(train))
    return L.simulated_counts(train, counts, L.rare_classes(counts))


@query(
    "e37_sentence_type_counts",
    ctes(SL)
    + """SELECT CASE WHEN is_related = 0 THEN 'unrelated' WHEN is_technical = 0 THEN 'general' ELSE 'technical' END AS sentence_type,
      count(*) AS n FROM sl GROUP BY 1""",
)
def _(t: Tables):
    return L.sentence_type_counts(t.sentences)


@query("l06_rare_classes", TRAIN + "SELECT idx, aspect, n FROM rare")
def _(t: Tables):
    train = _train(t)
    return L.rare_classes(L.aspect_counts(train, L.aspect_vocabulary(train)))


def _sql_oversampled(below: int) -> str:
    return f"""rareset AS (SELECT aspect FROM acount WHERE n < {below}),
    os AS (SELECT row_id, sentence_for_model, aspects FROM tr UNION ALL
      SELECT sha256(row_id || '#' || k), sentence_for_model, aspects FROM tr, range(1, 3) c(k)
      WHERE row_id IN (SELECT row_id FROM tra WHERE aspect IN (SELECT aspect FROM rareset)))"""


@query(
    "l07_oversample_rare",
    TRAIN + "," + _sql_oversampled(150) + f" SELECT row_id, sentence_for_model, {BITS} AS labels, true AS has_aspect_label FROM os src",
)
def _(t: Tables):
    train = _train(t)
    vocabulary = L.vocabulary_array(train)
    rare = L.rare_classes(L.aspect_counts(train, L.aspect_vocabulary(train)))
    out = L.oversample_rare(train, rare, vocabulary)
    return out.select(
        "row_id", "sentence_for_model", as_bits(F.col("aspect_labels")).alias("labels"), "has_aspect_label"
    )


EMPTY_BITS = "(SELECT string_agg('-1', ';') FROM vocab)"
FINAL = (
    TRAIN
    + f""", {REST_SPLIT}, {_sql_oversampled(150)},
ft AS (SELECT row_id, {BITS} AS labels, true AS has_aspect_label FROM os src UNION ALL
  SELECT row_id, {EMPTY_BITS}, false FROM rest WHERE split = 'train')
"""
)


@query("l08_final_training_frame", FINAL + "SELECT * FROM ft")
def _(t: Tables):
    frames = jobs.training_frames(t.order_sentences)
    return frames.train.select("row_id", as_bits(F.col("aspect_labels")).alias("labels"), "has_aspect_label")


@query(
    "c09_labels_by_row_id",
    TRAIN
    + f""", {REST_SPLIT}, held AS (SELECT row_id, {BITS} AS labels FROM ts src WHERE split = 'val')
    SELECT row_id, labels, true AS has_aspect_label FROM held UNION ALL
    SELECT row_id, {EMPTY_BITS}, false FROM rest WHERE split = 'val'""",
)
def _(t: Tables):
    frames = jobs.training_frames(t.order_sentences)
    return frames.val.select("row_id", as_bits(F.col("aspect_labels")).alias("labels"), "has_aspect_label")


@query(
    "p04_training_frames",
    FINAL
    + """SELECT part, has_aspect_label, count(*) AS n FROM (
      SELECT 'train' AS part, has_aspect_label FROM ft UNION ALL
      SELECT split, true FROM ts WHERE split <> 'train' UNION ALL SELECT split, false FROM rest WHERE split <> 'train')
    GROUP BY 1, 2""",
)
def _(t: Tables):
    f = jobs.training_frames(t.order_sentences)
    parts = [
        df.select(F.lit(name).alias("part"), "has_aspect_label")
        for name, df in (("train", f.train), ("val", f.val), ("test", f.test))
    ]
    both = parts[0].unionAll(parts[1]).unionAll(parts[2])
    return both.groupBy("part", "has_aspect_label").agg(n_rows().alias("n"))


TRIPLES = """SELECT row_id, sentence_for_model AS sentence, aspect, CASE WHEN sentiment = -1 THEN 0 ELSE 1 END AS label_idx
  FROM pairs WHERE is_technical = 1"""


@query("l09_sentiment_triples", BASE + TRIPLES)
def _(t: Tables):
    return L.sentiment_triples(_parsed(t))


@query(
    "l10_positive_weights",
    TRAIN
    + f"""SELECT idx, CAST(n AS DOUBLE) AS n_pos, {rnd('greatest(0.1e0, least(10e0, (total - n) / (n + 1e-6)))')} AS pos_weight
    FROM acount, (SELECT count(*) AS total FROM tr)""",
)
def _(t: Tables):
    train = _train(t)
    vocabulary = L.vocabulary_array(train)
    frame = L.with_multi_hot(train, vocabulary).withColumn("has_aspect_label", F.lit(True))
    return rounded(L.positive_weights(frame), "pos_weight")


@query(
    "l11_class_weights",
    BASE.rstrip()
    + f""", trip AS ({TRIPLES})
    SELECT label_idx, {rnd('greatest(0.2e0, least(5e0, (SELECT count(*) FROM trip) / (2e0 * count(*))))')} AS weight
    FROM trip GROUP BY 1""",
)
def _(t: Tables):
    return rounded(L.class_weights(L.sentiment_triples(_parsed(t))), "weight")


@query(
    "l12_fixed_size_sample",
    "SELECT doc_id FROM documents ORDER BY md5('42|' || doc_id) LIMIT 300",
)
def _(t: Tables):
    return sample_rows(t.read("documents").select("doc_id"), ["doc_id"], 300)


POOL = """pool AS (SELECT DISTINCT sentence_for_model FROM sl WHERE is_related = 1)"""


@query(
    "p05_domain_texts",
    FINAL
    + f""", {POOL}, free AS (SELECT * FROM pool WHERE sentence_for_model NOT IN (
      SELECT sentence_for_model FROM sl JOIN (SELECT row_id, split FROM ts UNION ALL SELECT row_id, split FROM rest) USING (row_id) WHERE split <> 'train')),
    picked AS (SELECT sentence_for_model FROM free ORDER BY md5('42|' || sentence_for_model) LIMIT 5000)
    SELECT sentence_for_model, count(*) AS n FROM (
      SELECT sentence_for_model FROM os UNION ALL SELECT sentence_for_model FROM rest WHERE split = 'train' UNION ALL
      SELECT sentence_for_model FROM picked) GROUP BY 1""",
)
def _(t: Tables):
    f = jobs.training_frames(t.order_sentences)
    pool = t.order_sentences.where("is_related = 1").select("sentence_for_model").distinct()
    held = f.val.select("sentence_for_model").unionAll(f.test.select("sentence_for_model"))
    texts = jobs.domain_texts(pool, held, f.train, 5000)
    return texts.groupBy("sentence_for_model").agg(n_rows().alias("n"))


@query(
    "c11_sentence_aspect_pairs",
    BASE + "SELECT row_id, aspect FROM pairs",
)
def _(t: Tables):
    return _parsed(t).select("row_id", F.explode("aspects_parsed").alias("aspect"))


@query(
    "g05_ordered_aspects",
    TRAIN + "SELECT aspect, n FROM acount ORDER BY n DESC, aspect",
)
def _(t: Tables):
    train = _train(t)
    counts = L.aspect_counts(train, L.aspect_vocabulary(train)).select("aspect", "n")
    return counts.orderBy(F.desc("n"), "aspect")
