"""Declared schemas of every input."""

from __future__ import annotations

LABELLED_TITLES = "title string, label int"
PRODUCTS = (
    "main_category string, title string, parent_asin string, "
    "average_rating double, rating_number bigint, price double"
)
REVIEWS = (
    "parent_asin string, rating double, title string, text string, timestamp bigint, "
    "verified_purchase boolean, helpful_vote bigint"
)
LINKED_REVIEWS = (
    "parent_asin string, rating double, review_title string, review_text string, "
    "timestamp bigint, verified_purchase boolean, product_title string, price double, "
    "average_rating double, rating_number bigint, main_category string"
)
LABELLED_SENTENCES = (
    "sentence_for_model string, is_related int, is_technical int, "
    "target_aspect string, target_sentiment string, review_context string"
)
OVERRIDES = "parent_asin string, category string, priority int"
LEXICON = "word string, valence double"
TRANSLATIONS = "text_hash string, language string, text_en string"
REWRITES = "row_id string, copy int, new_text string"
SCORED_TEXT = (
    "text string, is_related boolean, is_technical boolean, "
    "sentiment_aspects array<struct<aspect:string,sentiment:string,confidence:double>>, "
    "mentioned_aspects array<string>"
)

SENTENCE_COLUMNS = (
    "sentence_for_model",
    "is_related",
    "is_technical",
    "target_aspect",
    "target_sentiment",
)
