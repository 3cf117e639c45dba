"""Text jobs: sentences, language, lexicon sentiment, translation and leakage."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starsift.functions.textclean import (
    MIN_MODEL_TEXT,
    MIN_SENTENCE,
    clean_text,
    model_text,
    sentences,
    strip_spaces,
    word_count,
)
from starsift.operators.dedupe import broadcast_if_small, drop_same_text, first_per_key
from starsift.session import bounded_batches, cut_lineage

UNKNOWN_LANGUAGE = "unknown"
#: Profile rows (piece and language) that are sent to every task; a larger profile is joined.
PROFILE_ROWS = 4_000_000
#: Characters of text scored or counted at once; a longer text is taken alone.
SCORED_CHARS = 1 << 18
#: Texts of a batch that become Python strings at once.
SLICE_ROWS = 64
#: Hashed runs of needles that are sent to every task: bytes at most, and bytes counted for each.
NEEDLE_BYTES, RUN_BYTES = 8_000_000, 16
#: Words of a hashed run, and letters of one for needles without an inner word.
RUN, MOST_LETTERS = 3, 16
#: Texts from which on a run is common, so that a second run must be there too.
COMMON_RUN = 100

# Published constants of the rule-based sentiment score (Hutto and Gilbert 2014).
NEGATION_FACTOR = -0.74
BOOST = 0.293
NORMALISER = 15.0
NEGATORS = ("not", "no", "never", "none", "nothing", "neither", "nor", "cannot", "without", "hardly")
BOOSTERS = ("very", "really", "extremely", "absolutely", "completely", "totally", "so", "too")


# --- sentences -----------------------------------------------------------------


def explode_sentences(df: DataFrame, text: str = "review_text") -> DataFrame:
    """One row per sentence of more than five characters, parent columns kept."""
    return (
        df.select("*", F.posexplode(sentences(F.col(text))).alias("sentence_no", "sentence"))
        .where(F.length(strip_spaces(F.col("sentence"))) > MIN_SENTENCE)
    )


def model_sentences(df: DataFrame, text: str = "review_text") -> DataFrame:
    """Sentences with their model text, blank ones left out."""
    bounded_batches(df.sparkSession)
    return (
        explode_sentences(df, text)
        .withColumn("sentence_for_model", model_text(F.col("sentence"), once=True))
        .where(F.length("sentence_for_model") > MIN_MODEL_TEXT)
    )


def distinct_model_sentences(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The first occurrence of each model sentence."""
    return first_per_key(
        df.select("sentence_for_model", *order), ["sentence_for_model"], order
    )


# --- language ------------------------------------------------------------------


def _gram_codes(text: str) -> np.ndarray:
    """Three neighbouring code points packed into one integer, for every place in the text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    shift = np.uint64(21)
    return (points[:-2] << (shift + shift)) | (points[1:-1] << shift) | points[2:]


def _text_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Rows with their texts (the last column, null as empty) in pieces of bounded characters."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            rows = batch.slice(at, SLICE_ROWS)
            texts = [t or "" for t in rows.column(rows.num_columns - 1).to_pylist()]
            begin = held = 0
            for i, t in enumerate(texts):
                if i > begin and held + len(t) > SCORED_CHARS:
                    yield rows.slice(begin, i - begin), texts[begin:i]
                    begin, held = i, 0
                held += len(t)
            yield rows.slice(begin), texts[begin:]


def _gram_counts(df: DataFrame, keys: Sequence[str], text: str, merged: bool = False) -> DataFrame:
    """(keys, code, n): overlapping three-character pieces of the whole text, in lower case, counted in each row.

    With `merged` texts of equal keys are counted together where they meet, so a row of keys and piece may still
    come several times.
    """
    bounded_batches(df.sparkSession)
    lower = df.select(*keys, F.lower(F.col(text)).alias("_text")).where(F.length("_text") >= 3)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in _text_parts(batches):
            together = [[i] for i in range(len(texts))]
            if merged:
                by_key: dict[tuple, list[int]] = {}
                for i, key in enumerate(zip(*[rows.column(k).to_pylist() for k in keys], strict=True)):
                    by_key.setdefault(key, []).append(i)
                together = list(by_key.values())
            counted = [np.unique(np.concatenate([_gram_codes(texts[i]) for i in held]), return_counts=True) for held in together]
            if counted:
                own = rows.select(list(keys)).take(pa.array(np.repeat([held[0] for held in together], [len(c) for c, _ in counted])))
                codes, n = (np.concatenate(column).astype(np.int64) for column in zip(*counted, strict=True))
                yield pa.RecordBatch.from_arrays([*[own.column(k) for k in keys], pa.array(codes), pa.array(n)], names=[*keys, "code", "n"])

    schema = T.StructType([*[lower.schema[k] for k in keys], T.StructField("code", T.LongType()), T.StructField("n", T.LongType())])
    return lower.mapInArrow(run, schema)


@F.pandas_udf(T.StringType())
def _gram(codes: pd.Series) -> pd.Series:
    """The pieces that the codes stand for."""
    codes = codes.to_numpy(np.uint64)
    points = np.stack([codes >> np.uint64(42), codes >> np.uint64(21), codes], axis=1) & np.uint64((1 << 21) - 1)
    whole = points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    return pd.Series([whole[i : i + 3] for i in range(0, len(whole), 3)], dtype=object)


def language_profiles(
    labelled: DataFrame, text: str, lang: str, least_per_million: float = 0.0
) -> DataFrame:
    """Every piece of each language and its weight over an unseen piece, ln(1 + count per million pieces).

    A piece outside the profile weighs nothing. A caller may leave rare pieces
    out by a least rate; by default none is, however large the table is.
    """
    counts = _gram_counts(labelled, [lang], text, merged=True).groupBy(lang, "code").agg(F.sum("n").alias("n"))
    totals = counts.groupBy(lang).agg(F.sum("n").alias("total"))
    rate = F.col("n") * F.lit(1e6) / F.col("total")
    return (
        counts.join(totals, lang)
        .where(rate >= least_per_million)
        .select(F.col(lang).alias("profile_lang"), _gram("code").alias("gram"), F.log1p(rate).alias("weight"))
    )


@dataclass(frozen=True)
class LanguageModel:
    """Profiles in array form, for profiles measured as small (`PROFILE_ROWS`)."""

    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray

    @staticmethod
    def from_profiles(profiles: DataFrame) -> LanguageModel:
        rows = profiles.select("profile_lang", "gram", "weight").toArrow()
        names = np.array(rows["profile_lang"].to_pylist(), dtype=object)
        languages = sorted(set(names))
        found = _gram_codes("".join(rows["gram"].to_pylist()))[::3] if len(names) else np.zeros(0, np.uint64)
        codes, at = np.unique(found, return_inverse=True)
        weights = np.zeros((len(codes), len(languages)))
        weights[at, np.searchsorted(languages, names.astype(str))] = rows["weight"].to_numpy()
        return LanguageModel(languages, codes, weights)

    def best(self, texts: Sequence[str]) -> list[str]:
        """For each text the language with the largest sum of weights over the whole text."""
        pieces = [_gram_codes(t) for t in texts]
        grams = np.concatenate([np.zeros(0, np.uint64), *pieces])
        if not len(grams) or not len(self.codes):
            return [UNKNOWN_LANGUAGE] * len(texts)
        owner = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
        at = np.minimum(np.searchsorted(self.codes, grams), len(self.codes) - 1)
        known = self.codes[at] == grams
        at, owner = at[known], owner[known]
        # of equal scores the last language wins, so they stand in reverse
        order = range(len(self.languages) - 1, -1, -1)
        scores = np.stack([np.bincount(owner, self.weights[at, k], len(pieces)) for k in order], axis=1).round(6)
        names = [self.languages[k] for k in order]
        return [names[k] if any_ else UNKNOWN_LANGUAGE for k, any_ in zip(scores.argmax(axis=1), scores.any(axis=1))]


def language_of(text: Column, model: LanguageModel) -> Column:
    """Language of each text, scored in place: texts are neither cut into rows nor moved.

    `unknown` for texts under three characters, without a Latin letter, or
    sharing no piece with any profile.
    """

    size = SCORED_CHARS

    @F.pandas_udf(T.StringType())
    def score(texts: pd.Series) -> pd.Series:
        held = texts.dropna()
        piece = held.str.len().cumsum() // size
        found = [pd.Series(model.best(part.tolist()), part.index) for _, part in held.groupby(piece)]
        return pd.concat([pd.Series(dtype=object), *found]).reindex(texts.index)

    usable = (F.length(strip_spaces(text)) >= 3) & text.rlike("[a-zA-Z]")
    return F.coalesce(score(F.when(usable, F.lower(text))), F.lit(UNKNOWN_LANGUAGE))


def language_by_join(df: DataFrame, key: Sequence[str], text: str, profiles: DataFrame, column: str = "language") -> DataFrame:
    """(key, language) as `language_of` gives it, for profiles of any size: pieces are counted in each text and joined.

    `key` must be unique. Pieces are counted where the text is; only codes of pieces and counts are shuffled, never
    texts. A piece that many texts hold is split by the adaptive join.
    """
    usable = df.where((F.length(strip_spaces(F.col(text))) >= 3) & F.col(text).rlike("[a-zA-Z]"))
    counted = _gram_counts(usable, key, text).withColumnRenamed("n", "_n")
    first, second, third = (F.ascii(F.substring("gram", i, 1)).cast("long") for i in (1, 2, 3))
    code = F.shiftleft(first, 42).bitwiseOR(F.shiftleft(second, 21)).bitwiseOR(third)
    scores = (
        counted.join(profiles.select("profile_lang", code.alias("code"), "weight"), "code")
        .groupBy(*key, "profile_lang")
        .agg(F.round(F.sum(F.col("_n") * F.col("weight")), 6).alias("_s"))
        # a piece weighs something in its own language, but it may round to nothing
        .where(F.col("_s") > 0)
        .groupBy(*key)
        .agg(F.max(F.struct("_s", "profile_lang"))["profile_lang"].alias(column))
    )
    return df.select(*key).join(scores, list(key), "left").withColumn(column, F.coalesce(column, F.lit(UNKNOWN_LANGUAGE)))


def with_language(
    df: DataFrame, key: Sequence[str], text: str, profiles: DataFrame, column: str = "language",
    most_rows: int = PROFILE_ROWS,
) -> DataFrame:
    """Add the language of each text. Profiles are stored and counted: small ones go to the texts as arrays, larger
    ones are joined by piece, with the same result. `key` must be unique and not null.
    """
    bounded_batches(df.sparkSession)
    stored = cut_lineage(profiles)
    if stored.count() <= most_rows:
        return df.withColumn(column, language_of(F.col(text), LanguageModel.from_profiles(stored)))
    return df.join(language_by_join(df, key, text, stored, column), list(key))


# --- translation and rewriting --------------------------------------------------


def apply_translations(
    df: DataFrame, translations: DataFrame, text: str = "review_text", language: str = "language"
) -> DataFrame:
    """Replace non-English texts found in a (text_hash, language, text_en) table; others stay.

    Of several entries for a text the smallest translation counts, so no review
    is multiplied. The rows are read once, by one join: those that need no
    translation carry a negative key of their own spread, which no entry has.
    """
    table = (
        translations.where(F.col("text_hash").isNotNull() & F.col("language").isNotNull())
        .groupBy(F.col("text_hash").alias("_h"), F.col("language").alias("_lang"))
        .agg(F.min("text_en").alias("_en"))
    )
    foreign = F.coalesce(~F.col(language).isin("en", UNKNOWN_LANGUAGE) & F.col(text).isNotNull(), F.lit(False))
    spread = F.concat(F.lit("-"), F.xxhash64(*[F.col(c) for c in df.columns]).cast("string"))
    keyed = df.withColumn("_h", F.when(foreign, F.md5(text)).otherwise(spread)).withColumn(
        "_lang", F.when(foreign, F.col(language)).otherwise("")
    )
    return (
        keyed.join(table, ["_h", "_lang"], "left")
        .withColumn(text, F.coalesce("_en", text))
        .select(*df.columns)
    )


def accept_rewrite(original: Column, rewritten: Column, language: Column, min_words: int = 5) -> Column:
    """The rewritten text, unless it is too short or not English."""
    bad = rewritten.isNull() | (word_count(rewritten) < min_words) | ~language.eqNullSafe(F.lit("en"))
    return F.when(bad, original).otherwise(rewritten)


# --- sentiment -----------------------------------------------------------------


def lexicon_sentiment(
    df: DataFrame,
    lexicon: DataFrame,
    key: Sequence[str],
    text: str,
    column: str = "vader_sentiment",
    negators: Sequence[str] = NEGATORS,
    boosters: Sequence[str] = BOOSTERS,
) -> DataFrame:
    """(key, score): valence sum of the lexicon words of the whole text, scaled into -1..1.

    A negator among the three words before turns and damps a valence; a booster
    directly before strengthens it. The three words before travel with each
    word, so no ordered window is needed. A lexicon measured as small is
    broadcast, and words outside it are dropped before anything is shuffled.
    """
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}']+"), lambda w: w != "")
    tokens = df.select(*key, words.alias("_w"))

    def before(i: Column, back: int) -> Column:
        return F.get(F.col("_w"), i - back)

    spread = tokens.select(
        *key,
        F.inline(
            F.transform(
                "_w",
                lambda w, i: F.struct(
                    w.alias("word"),
                    before(i, 1).alias("b1"),
                    before(i, 2).alias("b2"),
                    before(i, 3).alias("b3"),
                ),
            )
        ),
    )
    negated = F.lit(False)
    for b in ("b1", "b2", "b3"):
        negated = negated | F.coalesce(F.col(b).isin(*negators), F.lit(False))
    boosted = F.coalesce(F.col("b1").isin(*boosters), F.lit(False))
    base = F.col("valence") + F.when(boosted, F.signum("valence") * BOOST).otherwise(0.0)
    value = F.when(negated, base * NEGATION_FACTOR).otherwise(base)
    total = F.col("_s")
    scored = (
        spread.join(broadcast_if_small(lexicon.select("word", "valence"), "word"), "word")
        .groupBy(*key)
        .agg(F.sum(value).alias("_s"))
        .select(*key, (total / F.sqrt(total * total + NORMALISER)).alias(column))
    )
    return df.select(*key).join(scored, list(key), "left").withColumn(
        column, F.coalesce(column, F.lit(0.0))
    )


# --- leakage -------------------------------------------------------------------


def drop_labelled_texts(
    df: DataFrame, labelled: DataFrame, text: str = "review_text", context: str = "review_context"
) -> DataFrame:
    """Reviews whose cleaned text equals no cleaned labelled context.

    The review text arrives cleaned and is cleaned once more here, as the
    contexts are compared with the twice-cleaned form.
    """
    bounded_batches(df.sparkSession)
    contexts = labelled.where(F.col(context).isNotNull()).select(clean_text(F.col(context)).alias("_c"))
    keyed = df.withColumn("_fingerprint", clean_text(F.col(text), once=True))
    return drop_same_text(keyed, contexts, "_fingerprint", "_c").drop("_fingerprint")


def _runs(parts: Column, width: int) -> Column:
    """Distinct hashes of all runs of `width` parts that follow each other; none in a shorter list."""
    columns = [F.slice(parts, k + 1, F.greatest(F.size(parts) - (width - 1), F.lit(0))) for k in range(width)]
    return F.array_distinct(F.transform(F.arrays_zip(*columns), lambda z: F.xxhash64(F.lit(width), z)))


def _parts(text: Column, by_word: bool) -> Column:
    return F.split(text, " " if by_word else "")


def contained_texts(
    texts: DataFrame, text_id: str, text: str, needles: DataFrame, needle: str,
    max_bytes: int = NEEDLE_BYTES,
) -> DataFrame:
    """(text_id, needle): which needle strings occur anywhere inside which texts, exactly.

    A text that holds a needle holds the needle's inner words (all but the first and the last, which may be cut) one
    after the other. Hashed runs of up to `RUN` inner words are looked up in all texts, with the number of texts that
    hold each; a needle is anchored at its rarest run, and a needle whose anchor is common is held to its second
    rarest run as well. Only those candidates are proved on the text. Needles without an inner word are looked up by
    their characters. Hashes of the needles go to all tasks up to `max_bytes`, else they are joined; no needle passes
    the driver. Null and empty needles occur nowhere, nor does anything in a null text.
    """
    inner = F.slice(_parts(F.col("_n"), True), 2, F.greatest(F.size(_parts(F.col("_n"), True)) - 2, F.lit(0)))
    listed = needles.where(F.length(needle) > 0).select(F.col(needle).alias("_n")).distinct()
    words = F.size(inner)
    letters = F.pow(F.lit(2), F.floor(F.log2(F.least(F.length("_n"), F.lit(MOST_LETTERS))))).cast("int")
    listed = cut_lineage(
        listed.select("_n", (words > 0).alias("by_word"), F.when(words > 0, F.least(words, F.lit(RUN))).otherwise(letters).alias("width"))
    )
    source = texts.select(F.col(text_id).alias("_id"), F.col(text).alias("_text"))
    wanted = found = None
    for kind in listed.select("by_word", "width").distinct().collect():  # RUN word widths and a few of letters at most
        own = listed.where((F.col("by_word") == kind.by_word) & (F.col("width") == kind.width))
        parts = inner if kind.by_word else _parts(F.col("_n"), False)
        mine = own.select("_n", F.explode(_runs(parts, kind.width)).alias("run"))
        here = source.select("_id", F.explode(_runs(_parts(F.col("_text"), kind.by_word), kind.width)).alias("run"))
        wanted = mine if wanted is None else wanted.unionAll(mine)
        found = here if found is None else found.unionAll(here)
    if wanted is None:
        return source.select(F.col("_id").alias(text_id), F.col("_text").alias("needle")).where(F.lit(False))
    wanted = cut_lineage(wanted)
    runs = cut_lineage(wanted.select("run").distinct())
    few = runs.count() * RUN_BYTES <= max_bytes
    hits = cut_lineage(found.join(F.broadcast(runs) if few else runs, "run", "left_semi").distinct())
    held = hits.groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    ranked = (
        wanted.join(held, "run", "left")
        .groupBy("_n")
        .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "run"))).alias("r"))
        .select("_n", F.get("r", 0).alias("first"), F.get("r", 1).getField("run").alias("second"))
        .where("first.n > 0")
    )
    at = ranked.select("_n", F.col("first.run").alias("run"), "second", (F.col("first.n") > COMMON_RUN).alias("hot"))
    pairs = at.join(hits, "run").select("_n", "_id", "second", "hot")
    also = hits.select(F.col("_id").alias("_also"), F.col("run").alias("second"))
    long = pairs.where("hot and second is not null").join(
        also, (F.col("_id").eqNullSafe(F.col("_also"))) & (pairs["second"] == also["second"]), "left_semi"
    )
    pairs = pairs.where("not hot or second is null").select("_n", "_id").unionAll(long.select("_n", "_id"))
    proved = pairs.withColumnRenamed("_id", "_of").join(source, F.col("_of").eqNullSafe(F.col("_id")))
    return proved.where(F.contains("_text", "_n")).select(F.col("_id").alias(text_id), F.col("_n").alias("needle"))


def leakage_audit(
    training: DataFrame, text_id: str, text: str, labelled: DataFrame, context: str = "review_context",
    min_length: int = 20,
) -> DataFrame:
    """Cleaned labelled contexts (longer than `min_length`) found inside training texts."""
    bounded_batches(training.sparkSession)
    queries = (
        labelled.where(F.length(context) > min_length)
        .select(clean_text(strip_spaces(F.col(context))).alias("needle"))
        .distinct()
    )
    return (
        contained_texts(training, text_id, text, queries, "needle")
        .groupBy("needle")
        .agg(F.count(F.lit(1)).alias("n_texts"))
    )
