"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from touchline.queries import QUERIES  # noqa: E402
from touchline.session import local_session  # noqa: E402

HEADLINE = [
    "rolling_sum_prior",
    "rolling_rates",
    "two_sided_rolling",
    "next_period_features",
    "order_numbers",
    "tenure_intervals",
    "point_in_time_join",
    "either_side_join",
    "conditional_lookup",
    "value_scores",
    "ranked_accuracy",
    "capped_topk",
    "selection_vs_best",
    "combined_error_by_supplier",
    "numeric_summary",
    "expanding_folds",
    "fuzzy_top1",
    "identity_cascade",
    "page_hrefs",
    "page_tables",
    "folded_texts",
    "team_form",
    "player_form",
    "prediction_report",
    "model_search",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus)
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
