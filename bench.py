"""Wall seconds of registered queries.

BENCH_SF_DIR   table folder (default /root/testdata/sf0.1)
BENCH_CPUS     local threads (default 8)
BENCH_QUERIES  comma-separated name prefixes, or `all`; default is the headline list
BENCH_RUNS     timed runs per query, the fastest counts (default 1, after one warm-up of the session)

Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = (
    "b07_price_tiers", "b10_category_overrides", "b13_keyword_flags", "b16_fixed_width_bins", "b18_quantile_bins",
    "c01_link_reviews", "c06_drop_labelled_texts", "c07_leakage_audit", "d01_duplicate_report_reviews",
    "d02_keep_one_per_key", "d04_distinct_model_sentences", "e02_describe", "e06_top_brand_ratings",
    "e12_rating_share_deduplicated", "e19_keyword_rates", "e23_binned_ratings", "e25_length_by_rating",
    "e36_correlation_matrix", "f03_ecdf_price_by_category", "h02_spearman_price_rating", "h05_pairwise_periods",
    "h06_kruskal_quartiles", "h07_chi_square_rating", "h12_product_t_tests", "l02_split_technical",
    "l12_fixed_size_sample", "m06_two_stage_gate", "m11_tune_aspects", "p01_prepared_columns", "p03_unlabelled_pool",
    "p04_training_frames", "t01_clean_pages", "t04_detect_language", "t05_lexicon_sentiment", "x03_keyword_windows",
)


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from starsift.catalog import QUERIES
    from starsift.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    if wanted == "all":
        names = list(QUERIES)
    elif wanted:
        names = [n for n in QUERIES if n.startswith(tuple(wanted.split(",")))]
    else:
        names = [n for n in HEADLINE if n in QUERIES]

    spark = build_session(f"local[{cpus}]", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["e12_rating_share_by_tier"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}
    for name in names:
        best = float("inf")
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
        print(f"{name} {best:.2f}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of the registered queries run",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
