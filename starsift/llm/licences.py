"""Licence scans: ordered signature rules behind a keyword filter, overlaps resolved by priority and containment."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsift.llm.common import id_and_text
from starsift.llm.licence_rules import rules

#: Fixed value: phrases that are always reported, with their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Characters between words once A-Z is lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a text as it stands.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: A text without any of these words has no keyword of any rule.
GATE = (
    r"(?i)licen[cs]|copyright|permission|redistribut|spdx|domain|(?<![0-9a-z])cc(?![0-9a-z])|cc0|creative|rights|wtfpl|warrant|software"
    r"|advertis|contributor|fuck|beer|evil|perl|confidential|restriction|complian|[a-z]v[0-9]"
)
BASE_WEIGHT = 0.9
START, STOP = "\x01", "\x02"


def whole_words(pattern: str) -> str:
    return f"(?<= )({pattern})(?= )"


def spans(norm: str, pattern: str) -> str:
    """SQL: structs (s, e) of the first word and the word after the last of every match, in order.

    Matches are marked in the text and the marks found again among its words, so the work follows the text's length.
    """
    marked = f"split(trim(regexp_replace({norm}, {pattern}, '{START}$1{STOP}')), ' ')"
    first = f"filter(transform({marked}, (w, i) -> if(startswith(w, '{START}'), i, null)), i -> i is not null)"
    after = f"filter(transform({marked}, (w, i) -> if(endswith(w, '{STOP}'), i + 1, null)), i -> i is not null)"
    return f"zip_with({first}, {after}, (s, e) -> named_struct('s', s, 'e', e))"


def rule_table(table: list[tuple[str, str, str, float]]) -> Column:
    return F.array(
        *[
            F.struct(F.lit(i).alias("p"), F.lit(label).alias("label"), F.lit(f" {key} " if " " in key else key).alias("keyword"),
                     F.lit(whole_words(pattern)).alias("pattern"), F.lit(weight).alias("weight"))
            for i, (label, key, pattern, weight) in enumerate(table)
        ]
    )


def scan_licences(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", signatures: list[tuple[str, str, str, float]] | None = None
) -> DataFrame:
    """Licence detections of every row, without a shuffle.

    Columns: doc_id, n_words, base (structs of label, first word s and end e of the base phrases), detections (structs
    s, e, p = place of the rule, label, weight, in text order), kept (label, best weight and number of detections that
    stand), base_labels and labels (sorted). A detection falls when one of a rule placed before it covers its whole
    interval; others stand beside each other. Rules are tried only where their keyword occurs, and texts without any
    word of the gate are only counted. Null and empty texts have no words and no labels; repeated rows stay; texts of
    any length are read whole, in time that follows their length; a null id stays null; other columns are not read.
    """
    table = rules() if signatures is None else signatures
    rows = id_and_text(docs, id_col, text_col)
    lower = F.translate(F.col("text"), string.ascii_uppercase, string.ascii_lowercase)
    norm = F.concat(F.lit(" "), F.trim(F.regexp_replace(lower, BETWEEN, " ")), F.lit(" "))
    rows = rows.select(
        "doc_id",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_words"),
        F.when(F.col("text").rlike(GATE), norm).alias("norm"),
    )
    base = [
        f"if(contains(norm, ' {phrase} '), transform({spans('norm', sql_text(whole_words(phrase)))}, "
        f"d -> named_struct('label', '{label}', 's', d.s, 'e', d.e)), no_base)"
        for phrase, label in BASE
    ]
    rows = rows.withColumn("no_base", F.expr("cast(array() as array<struct<label:string,s:int,e:int>>)"))
    rows = rows.withColumn("base", F.expr(f"coalesce(concat({', '.join(base)}), no_base)")).withColumn("rules", rule_table(table))
    found = f"""sort_array(flatten(transform(
        filter(rules, r -> contains(norm, r.keyword) and norm rlike r.pattern),
        r -> transform({spans('norm', 'r.pattern')},
          d -> named_struct('s', d.s, 'before', -d.e, 'p', r.p, 'e', d.e, 'label', r.label, 'weight', r.weight)))))"""
    none = "cast(array() as array<struct<s:int,before:int,p:int,e:int,label:string,weight:double>>)"
    rows = rows.withColumn("detections", F.expr(f"if(norm is null, {none}, {found})"))
    covered = "exists(t.open, a -> a.e >= d.e and a.p < d.p)"
    kept = f"""aggregate(detections,
        named_struct('open', cast(array() as array<struct<e:int,p:int>>), 'labels', cast(array() as array<string>),
                     'n', 0, 'weight', 0D),
        (t, d) -> named_struct(
          'open', concat(filter(t.open, a -> a.e > d.s), array(named_struct('e', d.e, 'p', d.p))),
          'labels', if({covered}, t.labels, array_union(t.labels, array(d.label))),
          'n', t.n + if({covered}, 0, 1),
          'weight', if({covered}, t.weight, greatest(t.weight, d.weight))),
        t -> named_struct('labels', t.labels, 'n', t.n, 'weight', t.weight))"""
    rows = rows.withColumn("kept", F.expr(kept))
    base_labels = F.sort_array(F.array_distinct(F.col("base.label")))
    return rows.select(
        "doc_id", "n_words", "base", "detections", "kept", base_labels.alias("base_labels"),
        F.sort_array(F.array_union(base_labels, "kept.labels")).alias("labels"),
    )


def sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def summary(scans: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score (the best weight of what stands)."""
    starts = F.col("base.s")
    return scans.select(
        "doc_id", "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        F.greatest(F.col("kept.weight"), F.when(F.size("base") > 0, F.lit(BASE_WEIGHT)).otherwise(F.lit(0.0))).alias("score"),
    )
