"""Text normalisation and sentence splitting as column expressions."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Code point ranges of white space, so that every step and every
# regex dialect treats the same characters as space.
SPACE_RANGES = (
    (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
    (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
)
SPACE = "[" + "".join(f"\\x{{{first:x}}}-\\x{{{last:x}}}" for first, last in SPACE_RANGES) + "]"
SPACE_CHARACTERS = "".join(
    chr(c) for first, last in SPACE_RANGES for c in range(first, last + 1) if c not in (0x0A, 0x20)
)

# Ordered replacements of the normalisation ($n is a group). White
# space has become plain spaces and line breaks before the first step.
CLEAN_STEPS = (
    (r"(?i)\[\[[a-z0-9_]+:[^\]]+\]\]", " "),
    (r"(?i)<br[ \n]*/?>", ". "),
    (r"\n+", ". "),
    (r"<[^3>][^>]*>", " "),
    (r"http[^ ]+|www\.[^ ]+", " "),
    (r"#+ *(.*?) *#+", ". $1. "),
    (r" +- +", ". "),
    (r" +\* +", ". "),
    (r"([a-z])([.!?])([A-Z])", "$1$2 $3"),
    (r" {2,}", " "),
)

# Abbreviations after which a full stop does not end a sentence.
ABBREVIATIONS = ("Mr", "Mrs", "Ms", "Dr", "Prof", "St", "vs", "etc", "e\\.g", "i\\.e", "No", "approx")
SENTENCE_MARK = "\x01"
MIN_SENTENCE = 5
MIN_MODEL_TEXT = 1


def _unescape(text: pd.Series) -> pd.Series:
    """Character references to characters; the full list needs a parser, not a pattern."""
    return text.map(html.unescape, na_action="ignore")


unescape_entities = F.pandas_udf(_unescape, T.StringType())
# The same, marked so that the optimizer copies the steps built on it into no
# filter above them: cleaned text is computed once and then reused.
unescape_once = F.pandas_udf(_unescape, T.StringType()).asNondeterministic()


def plain_spaces(text: Column) -> Column:
    """Every white-space character except the line break as a space."""
    return F.translate(text, SPACE_CHARACTERS, " " * len(SPACE_CHARACTERS))


def clean_text(text: Column, once: bool = False) -> Column:
    """Entities, tags, links, headings, bullets and spacing made plain; no text gives ''.

    With `once` the result is not recomputed by filters that use it; filters on
    other columns should then come before it.
    """
    unescape = unescape_once if once else unescape_entities
    out = plain_spaces(F.coalesce(unescape(text), F.lit("")))
    for pattern, replacement in CLEAN_STEPS:
        out = F.regexp_replace(out, pattern, replacement)
    # single spaces are left, so the space before a full stop is one character;
    # after this no two full stops have a space between them
    out = F.replace(F.trim(out), F.lit(" ."), F.lit("."))
    return F.regexp_replace(out, r"\.{2,}", ".")


def strip_spaces(text: Column) -> Column:
    """Without white space at either end."""
    ends = SPACE_CHARACTERS + " \n"
    return F.btrim(text, F.lit(ends))


def model_text(text: Column, once: bool = False) -> Column:
    """Cleaned text in lower case (cleaning leaves single spaces and none at the ends)."""
    return F.lower(clean_text(text, once))


def sentences(text: Column) -> Column:
    """Sentences of a cleaned text: a break after . ! ? and space, but not after an abbreviation."""
    marked = F.regexp_replace(text, "([.!?]) +", f"$1{SENTENCE_MARK}")
    short = "|".join(ABBREVIATIONS)
    joined = F.regexp_replace(
        marked, rf"(?<![\p{{L}}\p{{N}}])({short}|[A-Z])\.{SENTENCE_MARK}", "$1. "
    )
    return F.filter(F.split(joined, SENTENCE_MARK), lambda s: s != "")


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, f"{SPACE}+"), lambda w: w != ""))
