"""Classifiers, the two-stage gate, evaluation and threshold tuning."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsift.catalog.registry import query, rounded
from starsift.catalog.sql import ctes, rnd
from starsift.catalog.tables import SC, Tables
from starsift.operators import labels as L
from starsift.operators import metrics as E
from starsift.operators import models as M
from starsift.operators.splits import stratified_split
from starsift.plans import jobs
from starsift.session import cut_lineage, shared_folder
from starsift.sources.writers import read_thresholds, save_thresholds


# --- M8-M13 -------------------------------------------------------------------------


def _f(tp: str, fp: str, fn: str, beta: float = 1.0) -> str:
    b = beta * beta
    return f"coalesce({1 + b}e0 * ({tp}) / nullif({1 + b}e0 * ({tp}) + {b}e0 * ({fn}) + ({fp}), 0), 0)"


def _macro(beta: float = 1.0) -> str:
    one, zero = "CAST(tp + fp + fn > 0 AS INTEGER)", "CAST(tn + fp + fn > 0 AS INTEGER)"
    return (
        f"(({_f('tp', 'fp', 'fn', beta)} * {one} + {_f('tn', 'fn', 'fp', beta)} * {zero})"
        f" / nullif({one} + {zero}, 0))"
    )


def _counts(y: str, z: str, where: str = "true") -> str:
    return f"""count(*) FILTER ({where} AND {y} = 1 AND {z}) AS tp, count(*) FILTER ({where} AND {y} = 0 AND {z}) AS fp,
      count(*) FILTER ({where} AND {y} = 1 AND NOT ({z})) AS fn, count(*) FILTER ({where} AND {y} = 0 AND NOT ({z})) AS tn"""


def _grid(values) -> str:
    rows = ", ".join(f"({i}, {v!r}e0)" for i, v in enumerate(values))
    return f"grid(i, threshold) AS (VALUES {rows})"


def _first_best(score: str, by: str, default: float, source: str) -> str:
    head = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""SELECT {head}round(CASE WHEN max({score}) > 0 THEN max_by(threshold, ({score}, -i)) ELSE {default}e0 END, 4) AS threshold,
      {rnd(f'max({score})')} AS best_{score} FROM {source} {group}"""


def _tuned(df, score: str):
    return rounded(df, f"best_{score}").withColumn("threshold", F.round("threshold", 4))


@query("m08_confusion", ctes(SC) + "SELECT y, z, count(*) AS n FROM sc GROUP BY 1, 2")
def _(t: Tables):
    return E.confusion(t.scored, "y", "z")


@query(
    "m08_class_report",
    ctes(SC)
    + f"""SELECT "class", {rnd('coalesce(tp / nullif(predicted, 0), 0)')} AS "precision", {rnd('coalesce(tp / nullif(support, 0), 0)')} AS recall,
      {rnd('coalesce(2 * tp / nullif(predicted + support, 0), 0)')} AS f1, support FROM (
      SELECT "class", count(*) FILTER (y = "class") AS support, count(*) FILTER (z = "class") AS predicted,
        count(*) FILTER (y = "class" AND z = "class") AS tp FROM sc, (VALUES (0), (1)) k("class") GROUP BY 1)""",
)
def _(t: Tables):
    return rounded(E.class_report(t.scored, "y", "z"), "precision", "recall", "f1")


@query(
    "m09_overall_scores",
    ctes(SC)
    + f"""SELECT tp + fp + fn + tn AS n, {rnd('(tp + tn) / (tp + fp + fn + tn)')} AS accuracy, {rnd(_macro())} AS f1_macro
    FROM (SELECT {_counts('y', 'z = 1')} FROM sc)""",
)
def _(t: Tables):
    return rounded(E.overall_scores(t.scored, "y", "z"), "accuracy", "f1_macro")


STATES = ("open", "filled", "pending")


def _multi(t: Tables):
    """True and predicted label vectors of the orders: state against a repeatable guess."""
    o = t.read("orders").select("o_orderkey", "o_orderstatus")
    state = {"open": "O", "filled": "F", "pending": "P"}

    def bit(condition: Column) -> Column:
        return condition.cast("float")

    return o.select(
        "o_orderkey",
        F.array(*[bit(F.col("o_orderstatus") == state[s]) for s in STATES]).alias("truth"),
        F.array(*[bit((F.col("o_orderkey") * 13 + i * 29) % 100 >= 50) for i in range(3)]).alias("pred"),
    )


MULTI = """mo AS (SELECT o_orderkey, i, CAST(o_orderstatus = s AS INTEGER) AS y, CAST((o_orderkey * 13 + i * 29) % 100 >= 50 AS INTEGER) AS z, name
  FROM orders, (VALUES (0, 'O', 'open'), (1, 'F', 'filled'), (2, 'P', 'pending')) v(i, s, name))"""


@query(
    "m09_label_scores",
    ctes(MULTI)
    + f"SELECT label, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, {rnd(_f('tp', 'fp', 'fn'))} AS f1 FROM (SELECT name AS label, {_counts('y', 'z = 1')} FROM mo GROUP BY 1)",
)
def _(t: Tables):
    return rounded(E.label_scores(_multi(t), "truth", "pred", STATES), "f1")


@query(
    "m09_multi_label_scores",
    ctes(MULTI)
    + f"""SELECT {rnd('s')} AS f1_samples, {rnd('m')} AS f1_macro FROM
      (SELECT avg(coalesce(2e0 * b / nullif(ys + zs, 0), 0)) AS s FROM (SELECT sum(y * z) AS b, sum(y) AS ys, sum(z) AS zs FROM mo GROUP BY o_orderkey)),
      (SELECT avg({_f('tp', 'fp', 'fn')}) AS m FROM (SELECT i, {_counts('y', 'z = 1')} FROM mo GROUP BY 1))""",
)
def _(t: Tables):
    return rounded(E.multi_label_scores(_multi(t), "truth", "pred", STATES), "f1_samples", "f1_macro")


@query(
    "m10_tune_head",
    ctes(SC, _grid(E.HEAD_GRID), f"c AS (SELECT i, threshold, {_counts('y', 'p >= threshold')} FROM sc, grid GROUP BY 1, 2)",
         f"s AS (SELECT *, {_macro(2.0)} AS f_beta FROM c)")
    + _first_best("f_beta", "", 0.5, "s"),
)
def _(t: Tables):
    return _tuned(E.tune_head(t.scored, "y", "p"), "f_beta")


@query(
    "m10_threshold_sweep",
    ctes(SC, _grid(E.HEAD_GRID))
    + f"SELECT i, round(threshold, 4) AS threshold, {_counts('y', 'p >= threshold')} FROM sc, grid GROUP BY i, grid.threshold",
)
def _(t: Tables):
    return E.sweep(t.scored, "y", "p", E.HEAD_GRID).withColumn("threshold", F.round("threshold", 4))


@query(
    "m11_tune_aspects",
    ctes(SC, _grid(E.ASPECT_GRID), f"c AS (SELECT aspect, i, threshold, {_counts('y', 'p >= threshold')} FROM sc, grid GROUP BY 1, 2, 3)",
         f"s AS (SELECT *, {_f('tp', 'fp', 'fn')} AS f1 FROM c)")
    + _first_best("f1", "aspect", 0.5, "s"),
)
def _(t: Tables):
    return _tuned(E.tune_aspects(t.scored, "aspect", "y", "p"), "f1")


CONF = (
    SC,
    _grid(E.CONFIDENCE_GRID),
    f"""c AS (SELECT i, threshold, count(*) FILTER (conf >= threshold) AS n, count(*) AS total, {_counts('y', 'z = 1', 'conf >= threshold')}
      FROM sc, grid GROUP BY 1, 2)""",
    f"s AS (SELECT *, {_macro()} AS f1_macro FROM c WHERE n >= 10)",
)


@query(
    "m12_confidence_table",
    ctes(*CONF)
    + f"""SELECT i, round(threshold, 4) AS threshold, n, {rnd('n * 100e0 / total')} AS coverage, {rnd('f1_macro')} AS f1_macro,
      {rnd('(tp + tn) / n')} AS accuracy FROM s""",
)
def _(t: Tables):
    out = E.confidence_table(t.scored, "y", "z", "conf")
    return rounded(out, "coverage", "f1_macro", "accuracy").withColumn("threshold", F.round("threshold", 4))


@query("m12_tune_confidence", ctes(*CONF) + _first_best("f1_macro", "", 0.65, "s"))
def _(t: Tables):
    return _tuned(E.tune_confidence(t.scored, "y", "z", "conf"), "f1_macro")


@query(
    "m13_confident_subset",
    ctes(SC)
    + f"""SELECT n, tp + fp + fn + tn AS n_confident, {rnd(_macro())} AS f1_macro, {rnd('(tp + tn) / (tp + fp + fn + tn)')} AS accuracy
    FROM (SELECT count(*) AS n, {_counts('y', 'z = 1', 'conf >= 0.7e0')} FROM sc)""",
)
def _(t: Tables):
    return rounded(E.confident_scores(t.scored, "y", "z", "conf", 0.7), "f1_macro", "accuracy")


@query(
    "m13_aspect_scores",
    ctes(SC)
    + f"""SELECT aspect, n, {rnd('(tp + tn) / n')} AS accuracy, {rnd(_macro())} AS f1_macro, {rnd('sr / nullif(sn, 0)')} AS accuracy_confident
    FROM (SELECT aspect, count(*) AS n, {_counts('y', 'z = 1')}, count(*) FILTER (conf >= 0.7e0) AS sn,
      count(*) FILTER (conf >= 0.7e0 AND y = z) AS sr FROM sc GROUP BY 1)""",
)
def _(t: Tables):
    out = E.aspect_scores(t.scored, "aspect", "y", "z", "conf", 0.7)
    return rounded(out, "accuracy", "f1_macro", "accuracy_confident")


@query(
    "a11_thresholds",
    ctes(SC, _grid(E.HEAD_GRID), "agrid" + _grid(E.ASPECT_GRID)[4:],
         f"c1 AS (SELECT i, threshold, {_counts('y', 'p >= threshold')} FROM sc, grid GROUP BY 1, 2)",
         f"s1 AS (SELECT *, {_macro(2.0)} AS f_beta FROM c1)",
         f"c3 AS (SELECT aspect, i, threshold, {_counts('y', 'p >= threshold')} FROM sc, agrid GROUP BY 1, 2, 3)",
         f"s3 AS (SELECT *, {_f('tp', 'fp', 'fn')} AS f1 FROM c3)")
    + f"""SELECT 'h1' AS head, '' AS "class", threshold FROM ({_first_best('f_beta', '', 0.5, 's1')}) UNION ALL
      SELECT 'h3', aspect, threshold FROM ({_first_best('f1', 'aspect', 0.5, 's3')})""",
)
def _(t: Tables):
    head = E.tune_head(t.scored, "y", "p").select(F.lit("h1").alias("head"), F.lit("").alias("class"), "threshold")
    aspects = E.tune_aspects(t.scored, "aspect", "y", "p").select(
        F.lit("h3").alias("head"), F.col("aspect").alias("class"), "threshold"
    )
    return head.unionAll(aspects).withColumn("threshold", F.round("threshold", 4))


def _grid_as(name: str, values) -> str:
    return name + _grid(values)[4:]


# The second head is scored on related rows: whether the text is English, by a repeatable probability.
VAL = (
    SC,
    """rk AS (SELECT doc_id, row_number() OVER (PARTITION BY quality ORDER BY md5('42|' || doc_id)) AS r,
      count(*) OVER (PARTITION BY quality) AS size FROM labels)""",
    """val AS (SELECT sc.*, (doc_id * 53 % 100) / 100e0 AS p2, CAST(aspect = 'en' AS INTEGER) AS y2 FROM sc JOIN rk USING (doc_id)
      WHERE r > floor(0.7e0 * size + 0.5e0) AND r <= floor(0.85e0 * size + 0.5e0))""",
)


def tuned_thresholds(val):
    """(head, class, threshold) of the two heads, every aspect and the sentiment confidence."""
    parts = [
        ("h1", F.lit(""), E.tune_head(val, "y", "p")),
        ("h2", F.lit(""), E.tune_head(val.where("y = 1"), "y2", "p2")),
        ("h3", F.col("aspect"), E.tune_aspects(val, "aspect", "y", "p")),
        ("m2", F.lit(""), E.tune_confidence(val, "y", "z", "conf")),
    ]
    out = [df.select(F.lit(head).alias("head"), c.alias("class"), "threshold") for head, c, df in parts]
    return out[0].unionAll(out[1]).unionAll(out[2]).unionAll(out[3])


def stored_thresholds(t: Tables):
    """Tuned on the validation rows, written to the shared folder and read back."""
    parts = stratified_split(t.read("labels").select("doc_id", "quality"), ["doc_id"], ["quality"], L.SHARES)
    val = t.scored.join(parts.where(F.col("split") == "val").select("doc_id"), "doc_id", "left_semi")
    val = val.withColumns({"p2": (F.col("doc_id") * 53 % 100) / 100, "y2": (F.col("aspect") == "en").cast("int")})
    target = f"{shared_folder(t.spark).rstrip('/')}/thresholds-{uuid.uuid4().hex}"
    save_thresholds(tuned_thresholds(cut_lineage(val)), target)
    return read_thresholds(t.spark, target)


@query(
    "a11_stored_thresholds",
    ctes(*VAL, _grid(E.HEAD_GRID), _grid_as("agrid", E.ASPECT_GRID), _grid_as("mgrid", E.CONFIDENCE_GRID),
         f"c1 AS (SELECT i, threshold, {_counts('y', 'p >= threshold')} FROM val, grid GROUP BY 1, 2)",
         f"s1 AS (SELECT *, {_macro(2.0)} AS f_beta FROM c1)",
         f"c2 AS (SELECT i, threshold, {_counts('y2', 'p2 >= threshold')} FROM val, grid WHERE y = 1 GROUP BY 1, 2)",
         f"s2 AS (SELECT *, {_macro(2.0)} AS f_beta FROM c2)",
         f"c3 AS (SELECT aspect, i, threshold, {_counts('y', 'p >= threshold')} FROM val, agrid GROUP BY 1, 2, 3)",
         f"s3 AS (SELECT *, {_f('tp', 'fp', 'fn')} AS f1 FROM c3)",
         f"c4 AS (SELECT i, threshold, count(*) FILTER (conf >= threshold) AS n, {_counts('y', 'z = 1', 'conf >= threshold')} FROM val, mgrid GROUP BY 1, 2)",
         f"s4 AS (SELECT *, {_macro()} AS f1_macro FROM c4 WHERE n >= 10)")
    + f"""SELECT 'h1' AS head, '' AS "class", threshold FROM ({_first_best('f_beta', '', 0.5, 's1')}) UNION ALL
      SELECT 'h2', '', threshold FROM ({_first_best('f_beta', '', 0.5, 's2')}) UNION ALL
      SELECT 'h3', aspect, threshold FROM ({_first_best('f1', 'aspect', 0.5, 's3')}) UNION ALL
      SELECT 'm2', '', threshold FROM ({_first_best('f1_macro', '', 0.65, 's4')})""",
)
def _(t: Tables):
    # stored as tuned: a rounded cut can fall on the other side of a probability
    return stored_thresholds(t).withColumn("threshold", F.round("threshold", 4))


# --- M6, M7: gate with given probabilities ----------------------------------------------

CUTS = M.Thresholds(0.2, 0.3, {"battery": 0.4, "screen": 0.5, "price": 0.6}, 0.65)
ASPECTS = list(CUTS.aspects)


def with_probabilities(docs):
    """Repeatable head and aspect probabilities in place of a model."""

    def p(k: int) -> Column:
        return (F.col("doc_id") * k % 100) / 100

    scores = [
        F.struct(F.lit(a).alias("aspect"), p(41 + 2 * i).alias("prob")) for i, a in enumerate(ASPECTS)
    ]
    return docs.withColumns(
        {"p_related": p(37), "p_technical": p(53), "p_aspects": F.array(*scores)}
    )


def positive_of(aspect: Column) -> Column:
    out = F.lit(None).cast("double")
    for i, a in enumerate(ASPECTS):
        out = F.when(aspect == a, (F.col("doc_id") * (61 + 6 * i) % 100) / 100).otherwise(out)
    return out


def flat_record(scored):
    """The response record with its lists as text."""
    return scored.select(
        "doc_id",
        F.length("text").alias("text_length"),
        "is_related",
        "is_technical",
        F.array_join(
            F.transform(
                "sentiment_aspects",
                lambda a: F.concat_ws(
                    ":", a["aspect"], a["sentiment"], F.round(a["confidence"] * 10000).cast("int").cast("string")
                ),
            ),
            ";",
        ).alias("sentiment_aspects"),
        F.array_join("mentioned_aspects", ";").alias("mentioned_aspects"),
    )


def _gate_sql() -> str:
    rows = ", ".join(
        f"({i}, '{a}', {41 + 2 * i}, {c!r}e0, {61 + 6 * i})" for i, (a, c) in enumerate(CUTS.aspects.items())
    )
    return f"""WITH v(i, aspect, k, cut, q) AS (VALUES {rows}),
    g AS (SELECT doc_id, CAST(length(text) AS INTEGER) AS text_length, (doc_id * 37 % 100) / 100e0 >= 0.2e0 AS is_related,
      (doc_id * 53 % 100) / 100e0 >= 0.3e0 AS is_technical FROM documents),
    d AS (SELECT doc_id, i, aspect, (doc_id * q % 100) / 100e0 AS pp, greatest((doc_id * q % 100) / 100e0, 1 - (doc_id * q % 100) / 100e0) AS conf
      FROM g, v WHERE is_related AND is_technical AND (doc_id * k % 100) / 100e0 >= cut)
    SELECT g.*, coalesce(string_agg(aspect || ':' || CASE WHEN pp > 1 - pp THEN 'Positive' ELSE 'Negative' END || ':' || CAST(round(conf * 10000) AS INTEGER), ';' ORDER BY i)
        FILTER (conf >= 0.65e0), '') AS sentiment_aspects,
      coalesce(string_agg(aspect, ';' ORDER BY i) FILTER (conf < 0.65e0), '') AS mentioned_aspects
    FROM g LEFT JOIN d USING (doc_id) GROUP BY ALL"""


GATE_SQL = _gate_sql()


@query("m06_two_stage_gate", GATE_SQL)
def _(t: Tables):
    docs = with_probabilities(t.read("documents").select("doc_id", "text"))
    gated = M.gate(docs, CUTS)
    pairs = M.detected_pairs(gated, ["doc_id"], "text")
    scored = pairs.withColumn("p_positive", positive_of(F.col("aspect")))
    return flat_record(M.assemble(gated, scored, ["doc_id"], "text", CUTS))


@query("m07_batch_scoring", GATE_SQL)
def _(t: Tables):
    docs = with_probabilities(t.read("documents").select("doc_id", "text"))
    return flat_record(M.score_in_row(docs, ["doc_id"], "text", CUTS, positive_of))


# --- M1-M5: trained models ------------------------------------------------------------------


# Those English stop words of Spark's list that are plain words.
STOP_WORDS = """
    me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it
    its itself they them their theirs themselves what which who whom this that these those am is are was were be
    been being have has had having do does did doing an the and but if or because as until while of at by for with
    about against between into through during before after above below to from up down in out on off over under
    again further then once here there when where why how all any both each few more most other some such no nor not
    only own same so than too very can will just don should now cannot could ought would
""".split()


def _titles(t: Tables):
    docs = t.read("documents").select("doc_id", F.col("text").alias("title"), "lang")
    return t.read("labels").select("doc_id", F.col("quality").alias("label")).join(docs, "doc_id")


def _catalogue(t: Tables):
    return t.read("documents").select(
        F.col("lang").alias("main_category"), F.col("text").alias("title"), F.col("doc_id").alias("parent_asin"),
        F.lit(3.0).alias("average_rating"), F.col("n_chars").alias("rating_number"), F.lit(1.0).alias("price"),
    )


def _classifier(t: Tables):
    parts = stratified_split(_titles(t), ["doc_id"], ["label"], {"train": 0.8, "test": 0.2})
    return M.train_title_classifier(parts.where(F.col("split") == "train")), parts


@query("m01_train_title_classifier")
def _(t: Tables):
    model, parts = _classifier(t)
    held = model.score(parts.where(F.col("split") == "test"))
    return E.class_report(held.withColumn("pred", (F.col("prob_digital") > 0.5).cast("int")), "label", "pred")


@query("m02_score_products")
def _(t: Tables):
    model, _ = _classifier(t)
    return M.score_products(model, _catalogue(t))


@query("m03_device_products")
def _(t: Tables):
    model, _ = _classifier(t)
    return M.device_products(M.score_products(model, _catalogue(t)))


@query("g04_strongest_terms")
def _(t: Tables):
    model, _ = _classifier(t)
    return M.strongest_terms(M.term_weights(model))


# a word is a whole run of letters, digits and '_' that holds nothing but two or more plain letters
T08 = rf"""WITH words AS (
  SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[\p{{L}}\p{{Nd}}_]+'),
    lambda w: regexp_full_match(w, '[a-z]{{2,}}') AND w NOT IN ({", ".join(f"'{w}'" for w in STOP_WORDS)})) AS ws
  FROM labels JOIN documents USING (doc_id)),
counts AS (
  SELECT doc_id, term, count(*) AS n FROM (
    SELECT doc_id, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS term FROM words)
  GROUP BY 1, 2),
kept AS (SELECT term, count(*) AS document_count FROM counts GROUP BY 1 HAVING count(*) >= 5),
weighted AS (
  SELECT *, n * (ln(((SELECT count(*) FROM words) + 1) / (document_count + 1)) + 1) AS w FROM counts JOIN kept USING (term))
SELECT doc_id, term, n AS count, document_count, {rnd("w / sqrt(sum(w * w) OVER (PARTITION BY doc_id))")} AS weight FROM weighted"""


@query("t08_title_features", T08)
def _(t: Tables):
    return rounded(M.title_term_weights(_titles(t), "doc_id", "title"), "weight")


def _trained(t: Tables):
    """The aspect model fitted on the training split, and the frames of all splits."""
    frames = jobs.training_frames(t.order_sentences)
    train = cut_lineage(frames.train)
    classes = [r["aspect"] for r in frames.vocabulary.orderBy("idx").toLocalIterator()]
    weights = {
        classes[r["idx"]]: r["pos_weight"] for r in L.positive_weights(train).toLocalIterator()
    }
    return M.train_aspect_model(train, classes, weights), frames


@query("m04_aspect_probabilities")
def _(t: Tables):
    model, frames = _trained(t)
    out = model.probabilities(frames.test, "sentence_for_model")
    return out.select(
        "row_id", "p_related", "p_technical", F.inline("p_aspects").alias("aspect", "probability")
    )


def _sentiment(frames):
    """The sentiment model fitted on the triples outside the held-out splits, and all triples with their split."""
    triples = cut_lineage(frames.triples())
    seen = triples.where(~F.col("split").isin("val", "test")).drop("split")
    return M.train_sentiment_model(seen, L.class_weights(seen)), triples


def _said(triples: DataFrame, split: str) -> DataFrame:
    return triples.where(F.col("split") == split).drop("split")


@query("m05_aspect_sentiment")
def _(t: Tables):
    score, triples = _sentiment(jobs.training_frames(t.order_sentences))
    return score(_said(triples, "test")).select("row_id", "aspect", "label_idx", "p_positive")


def _tuned_models(t: Tables):
    """Both models fitted on the training split, their cuts tuned on the validation split, stored and read back; all frames."""
    aspects, frames = _trained(t)
    sentiment, triples = _sentiment(frames)
    target = f"{shared_folder(t.spark).rstrip('/')}/thresholds-{uuid.uuid4().hex}"
    save_thresholds(jobs.tuned_thresholds(frames.val, _said(triples, "val"), aspects, sentiment), target)
    return aspects, sentiment, read_thresholds(t.spark, target), frames


@query("a11_model_thresholds")
def _(t: Tables):
    return _tuned_models(t)[2]


def _scored_test(frames, aspects, sentiment, cuts: M.Thresholds) -> DataFrame:
    out = M.score_texts(
        frames.test.select("row_id", "sentence_for_model"), ["row_id"], "sentence_for_model", aspects, sentiment, cuts
    )
    return out.select("row_id", "is_related", "is_technical", "sentiment_aspects", "mentioned_aspects")


@query("m07_score_sentences")
def _(t: Tables):
    aspects, frames = _trained(t)
    sentiment, _ = _sentiment(frames)
    return _scored_test(frames, aspects, sentiment, M.Thresholds(0.5, 0.5, {a: 0.5 for a in aspects.aspects}, 0.65))


@query("m07_score_at_tuned_cuts")
def _(t: Tables):
    aspects, sentiment, thresholds, frames = _tuned_models(t)
    return _scored_test(frames, aspects, sentiment, M.Thresholds.from_table(thresholds))
