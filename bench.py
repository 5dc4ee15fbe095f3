"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every query is executed to its last row into Spark's ``noop`` sink, after one warm-up query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import registry  # noqa: E402
from meterline.session import local_session  # noqa: E402

HEADLINE = (
    "S3_ingest_many",
    "S6_sample_n_large",
    "C10_clean_all",
    "C11_clean_job",
    "V6_validate_all",
    "Q1_summary_stats",
    "Q6_correlation",
    "Q7_daily_counts",
    "T6_rolling_features",
    "T7_all_temporal",
    "G9_all_geo",
    "F9_all_features",
    "F10_feature_job",
    "F11_feature_dictionary",
    "F12_feature_store_long",
    "A1_trip_summary",
    "A4_payment_share",
    "R1_linear",
    "R2_ridge",
    "R3_lasso",
    "K1_logistic",
    "D1_pca",
    "E2_compare_regressors",
    "E4_compare_classifiers",
    "X5_compare_runs",
    "X8_champion_verdict",
    "X9_model_card",
    "B1_score_batch",
    "O1_drift_ks",
    "O6_cv_grids",
    "D3_lda_tips",
    "K4_mlp",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "bench")
    registry.QUERIES["A4_payment_share"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spent = {}
    for name in wanted:
        start = time.perf_counter()
        df = registry.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        spent[name] = round(time.perf_counter() - start, 3)
        print(name, spent[name], file=sys.stderr, flush=True)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(spent.values()), 3),
        "unit": "sec",
        "queries": spent,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
