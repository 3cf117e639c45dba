"""Every registered query against its SQL, on the smallest tables."""

import re

import pytest
from compare import compare, connect

from starsift.catalog import ORACLE, QUERIES

# trained models, checked in test_models.py, and an order that SQL rows do not show
NO_SQL = {
    "m01_train_title_classifier", "m02_score_products", "m03_device_products", "g04_strongest_terms",
    "m04_aspect_probabilities", "m05_aspect_sentiment", "m07_score_sentences", "a11_model_thresholds", "m07_score_at_tuned_cuts",
}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - NO_SQL))
def test_same_rows_as_sql(spark, con, sf_dir, name):
    assert compare(spark, con, name, QUERIES[name], ORACLE[name], sf_dir) == []


def test_only_models_lack_sql():
    assert set(QUERIES) - set(ORACLE) == NO_SQL


def test_names_are_plain():
    assert all(re.fullmatch(r"[a-z][0-9]{2}_[a-z_]+", n) for n in QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["price_tier", "rating", "n", "proportion"]
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
