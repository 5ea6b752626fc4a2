"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Each query runs once to warm up, then BENCH_RUNS times (default 1); the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "a0_latest_overview", "c1_tag_to_field", "c4_fact_context_join", "d1_first_in_document",
    "d2_newest_filing_wins", "d4_pivot_statement_rows", "r1_sign_normalisation", "r2_gap_fills",
    "r3_derived_metrics", "r4_validation_failures", "r7_cross_period", "e3_yoy_growth",
    "e4_cagr_3y_5y", "j4_j5_sector_job", "b7_b8_b9_j11_ingest", "b11_b12_backfill",
    "h16_metadata_merge", "a8_e1_newest_filings", "a12_markup_facts", "j2_merged_cells",
    "s6_e13_text_layer", "s7_s8_resolved_sections", "d21_d22_page_text", "s9_e15_page_roles",
    "s12_printed_facts", "s20_printed_sections",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from ledgermill.queries.catalog import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    only = sys.argv[1:] or HEADLINE
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "16g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in only:
        samples = []
        for i in range(runs + 1):
            t = time.perf_counter()
            QUERIES[name].run(spark, sf_dir).write.mode("overwrite").format("noop").save()
            if i:
                samples.append(time.perf_counter() - t)
        times[name] = round(statistics.median(samples), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir)}))
    spark.stop()


if __name__ == "__main__":
    main()
