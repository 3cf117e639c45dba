"""The composed jobs: linking, preparation, sentence pools and training frames."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsift.functions import patterns as P
from starsift.functions.textclean import clean_text
from starsift.operators import clean, dedupe, labels, metrics, text
from starsift.operators.models import AspectModel
from starsift.operators.splits import SEED, sample_rows
from starsift.session import cut_lineage
from starsift.sources.readers import labelled_sentences

DOMAIN_SAMPLE = 300_000


def linked_reviews(reviews: DataFrame, products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(duplicate report, de-duplicated reviews) of the linked table."""
    linked = dedupe.link_reviews(reviews, products)
    return dedupe.duplicate_groups(linked), dedupe.first_per_key(linked, dedupe.REVIEW_KEY)


@dataclass(frozen=True)
class Preparation:
    """Parameters of the prepared review table."""

    excluded: str = P.EXCLUDED_MAIN_CATEGORY
    period_cuts: Sequence[str] = P.PERIOD_CUTS
    classes: Sequence[tuple[str, str]] = P.TITLE_CLASSES
    brand_pattern: str = P.BRAND_PATTERN
    brand_aliases: Mapping[str, str] | None = None
    contrast_pattern: str = P.CONTRAST_PATTERN
    negators: Sequence[str] = text.NEGATORS
    boosters: Sequence[str] = text.BOOSTERS

    def aliases(self) -> Mapping[str, str]:
        return P.BRAND_ALIASES if self.brand_aliases is None else self.brand_aliases


def prepare_columns(
    df: DataFrame,
    how: Preparation = Preparation(),
    overrides: DataFrame | None = None,
    denied: DataFrame | None = None,
) -> DataFrame:
    """Dates, tiers, periods, categories and brands: everything that needs no text model.

    Tiers are cut before categories are filtered, so their quantiles cover all products.
    Reviews linked to labelled products bring their title class and brand along.
    """
    out = (
        df.transform(clean.basic_clean, how.excluded)
        .transform(clean.with_price_tier)
        .transform(clean.with_period, "date", how.period_cuts)
        .transform(clean.with_category, how.classes, overrides, denied)
    )
    if "brand" in df.columns:
        return out
    return out.transform(clean.with_brand, "product_title", how.brand_pattern, how.aliases())


def prepared_reviews(
    df: DataFrame,
    key: Sequence[str],
    profiles: DataFrame,
    lexicon: DataFrame,
    how: Preparation = Preparation(),
    overrides: DataFrame | None = None,
    denied: DataFrame | None = None,
    translations: DataFrame | None = None,
) -> DataFrame:
    """The prepared table: columns, language, translated text, sentiment and trade-off flag."""
    base = prepare_columns(df, how, overrides, denied)
    spoken = text.with_language(base, key, "review_text", profiles)
    if translations is not None:
        spoken = text.apply_translations(spoken, translations)
    scores = text.lexicon_sentiment(
        spoken, lexicon, key, "review_text", negators=how.negators, boosters=how.boosters
    )
    return spoken.join(scores, list(key)).transform(
        clean.with_tradeoff_flag, "review_text", how.contrast_pattern
    )


@dataclass(frozen=True)
class SentencePools:
    """English sentences for display, and distinct unlabelled sentences for training."""

    display: DataFrame
    unlabelled: DataFrame
    english: DataFrame
    unleaked: DataFrame


def sentence_pools(
    reviews: DataFrame, labelled: DataFrame, profiles: DataFrame, key: str = "review_id",
    text_column: str = "review_text", context: str = "review_context",
) -> SentencePools:
    """Clean, keep English, remove labelled reviews, split, normalise and de-duplicate."""
    cleaned = reviews.withColumn(text_column, clean_text(F.col(text_column), once=True))
    spoken = text.with_language(cleaned, [key], text_column, profiles, "_language")
    english = spoken.where(F.col("_language") == "en").drop("_language")
    unleaked = text.drop_labelled_texts(english, labelled, text_column, context)
    pool = text.distinct_model_sentences(
        text.model_sentences(unleaked, text_column), [key, "sentence_no"]
    )
    return SentencePools(
        text.model_sentences(english, text_column),
        pool.select("sentence_for_model"),
        english,
        unleaked,
    )


@dataclass(frozen=True)
class TrainingFrames:
    """Labelled frames of the aspect model, with the vocabulary fitted on training rows."""

    train: DataFrame
    val: DataFrame
    test: DataFrame
    vocabulary: DataFrame
    rare: DataFrame
    technical: DataFrame
    others: DataFrame

    def triples(self) -> DataFrame:
        """(row_id, sentence, aspect, class, split) of every row with valid pairs, from the stored split."""
        rows = dedupe.stack_rows(self.technical, self.others)
        return labels.sentiment_triples(rows, columns=["split"])


def split_sentences(
    parsed: DataFrame, shares: Mapping[str, float] | None = None, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """(technical rows, other rows), each with its split."""
    technical = labels.technical_rows(parsed)
    divided = labels.split_technical(technical, shares=shares, seed=seed)
    others = labels.split_rest(parsed, technical, shares=shares, seed=seed)
    return divided, others


def stored_split(
    sentences: DataFrame, excluded: Sequence[str] = P.EXCLUDED_ASPECTS, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Ids, pairs and splits, stored once: every frame and class list is made from them."""
    parsed = cut_lineage(labels.with_pairs(labelled_sentences(sentences), excluded))
    technical, others = split_sentences(parsed, seed=seed)
    return cut_lineage(technical), cut_lineage(others)


def training_frames(
    sentences: DataFrame,
    excluded: Sequence[str] = P.EXCLUDED_ASPECTS,
    rare_below: int = labels.RARE_BELOW,
    copies: int = labels.COPIES,
    rewrites: DataFrame | None = None,
    seed: int = SEED,
) -> TrainingFrames:
    """Ids, pairs, splits, vocabulary, oversampled training frame and labelled val/test frames."""
    technical, others = stored_split(sentences, excluded, seed)

    def part(df: DataFrame, name: str) -> DataFrame:
        return df.where(F.col("split") == name)

    train = part(technical, "train")
    vocabulary = labels.aspect_vocabulary(train)
    entries: Column = labels.vocabulary_array(train)
    rare = labels.rare_classes(labels.aspect_counts(train, vocabulary), rare_below)
    oversampled = labels.oversample_rare(train, rare, entries, copies, rewrites)
    final = labels.final_training_frame(oversampled, part(others, "train"), entries, seed)

    def held_out(name: str) -> DataFrame:
        rows = dedupe.stack_rows(part(technical, name), part(others, name))
        return labels.with_aspect_labels(rows, part(technical, name), entries)

    return TrainingFrames(final, held_out("val"), held_out("test"), vocabulary, rare, technical, others)


def tuned_thresholds(
    val: DataFrame, triples: DataFrame, aspects: AspectModel, sentiment: Callable[[DataFrame], DataFrame],
    text_column: str = "sentence_for_model",
) -> DataFrame:
    """(head, class, threshold) from the models' own probabilities on validation rows.

    The heads and aspects are tuned on the kind of rows they were fitted on: all rows, related rows, technical rows
    with labels; the confidence on the (sentence, aspect) triples. What no row speaks for keeps the default.
    """
    scored = cut_lineage(
        aspects.probabilities(val, text_column).select(
            "is_related", "is_technical", "has_aspect_label", "aspect_labels", "p_related", "p_technical", "p_aspects"
        )
    )
    related = F.col("is_related") == 1
    each = scored.where(related & (F.col("is_technical") == 1) & F.col("has_aspect_label")).select(
        F.inline(
            F.transform(
                "p_aspects",
                lambda a, i: F.struct(
                    a["aspect"].alias("class"), a["prob"].alias("p"), (F.get("aspect_labels", i) > 0.5).cast("int").alias("y")
                ),
            )
        )
    )
    # stored, or every step of the grid would run the model again
    said = cut_lineage(sentiment(triples).select("label_idx", "p_positive")).select(
        F.col("label_idx").alias("y"),
        (F.col("p_positive") > 0.5).cast("int").alias("z"),
        F.greatest(F.col("p_positive"), 1 - F.col("p_positive")).alias("conf"),
    )
    names = val.sparkSession.createDataFrame([(a,) for a in aspects.aspects], "class string")
    default = F.lit(metrics.DEFAULT_THRESHOLD)
    parts = {
        "h1": metrics.tune_head(scored, "is_related", "p_related"),
        "h2": metrics.tune_head(scored.where(related), "is_technical", "p_technical"),
        "h3": names.join(metrics.tune_aspects(each, "class", "y", "p"), "class", "left").withColumn(
            "threshold", F.coalesce("threshold", default)
        ),
        "m2": metrics.tune_confidence(said, "y", "z", "conf"),
    }
    rows = [
        df.select(F.lit(head).alias("head"), (F.col("class") if head == "h3" else F.lit("")).alias("class"), "threshold")
        for head, df in parts.items()
    ]
    return reduce(DataFrame.unionAll, rows)


def domain_texts(
    unlabelled: DataFrame, held_out: DataFrame, train: DataFrame, sample: int = DOMAIN_SAMPLE,
    text_column: str = "sentence_for_model", seed: int = SEED,
) -> DataFrame:
    """Training texts plus a fixed-size sample of the pool without any held-out sentence.

    Pool sentences must be distinct (the pool job makes them so).
    """
    known = unlabelled.where(F.col(text_column).isNotNull())
    free = known.join(held_out.select(text_column).distinct(), text_column, "left_anti")
    chosen = sample_rows(free.select(text_column), [text_column], sample, seed)
    return train.select(text_column).unionByName(chosen)
