"""Times the headline queries once each and prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local threads (default 8). Results go
to Spark's ``noop`` sink, so every row and column is computed but none is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from gridlore.plans.catalog import QUERIES
from gridlore.session import build_session

HEADLINE = [
    "profile_features", "clean_records", "eda_clean", "filter_common_year", "load_generation_like",
    "parse_locale_number", "record_key", "summary_category", "null_profile", "describe_quartiles", "quartiles_exact",
    "iqr_outliers", "zscore", "corr_pearson", "corr_spearman", "corr_spearman_lines", "percent_rank_global",
    "boxplot_stats", "topk_global", "sample_seeded", "page_cards", "page_links_resolved", "src_banner_csv",
    "sink_parquet_roundtrip", "upsert_merge", "upsert_counters", "upsert_table_reload", "stream_upsert_events",
    "kmeans_assign", "clf_decision_tree", "linreg_intensity", "dbscan_grid",
]


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["coll_count"](spark, folder).collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main(sys.argv[1:] or HEADLINE)
