"""Time the headline queries once each and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Every result is computed in full into a no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tallyguard import catalog
from tallyguard.session import build_session

HEADLINE = {
    # fit
    "a2_null_fraction": "documents", "a3_column_median_narrowed": "lineitem", "a4_column_mode": "part",
    "a5_scaler_fit": "lineitem", "e1_impute": "customer", "e2_standard_scale": "events", "e3_label_encode": "part",
    # velocity
    "w1_running_txn_count": "events", "w2_txn_count_24h": "events",
    # split, cap, resample
    "w5_stratified_split": "events", "o2_exact_fraction_sample": "events", "o5_random_undersample": "events",
    "o6_smote": "events", "j4_knn_self_join": "embeddings",
    "e8_recipe_ccf": "events", "e8_recipe_ieee_cis": "events", "e8_recipe_ibm_aml": "events",
    # examples
    "m7_row_to_example": "events", "f15_render_chat": "events", "f17_length_audit": "documents",
    # evaluation and scoring
    "f20_parse_verdict": "events", "m1_score_batch": "events", "m2_evaluate": "events",
    "a13_auroc": "events", "a15_per_dataset_breakdown": "events", "st1_stream_score": "events",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__ui__enabled="false", spark__driver__memory="20g",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or list(HEADLINE)
    rows = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in set(HEADLINE.values())}
    catalog.QUERIES["a15_per_dataset_breakdown"](spark, sf_dir).collect()      # start workers, compile
    times, rates = {}, {}
    for name in names:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        if name in HEADLINE:
            rates[name] = round(rows[HEADLINE[name]] / times[name])
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "rows_per_sec": rates, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
