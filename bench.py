"""Time headline queries; prints one JSON line.

BENCH_SF_DIR selects the tables, BENCH_CPUS the number of local threads. Each query runs
once to warm up and is then timed over complete results, written to a no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "top_pages", "loan_clean", "sales_by_city_currency", "sales_facts", "daily_sales_snapshot", "monthly_sales_snapshot",
    "customers_dim", "cdc_scd1", "cdc_scd2", "stream_cdc_scd1", "snapshot_change_set", "snapshot_scd2", "oldest_n",
    "c360_join_as_of", "categorized_transactions", "expectation_metrics", "quarantine", "customer_agg",
    "incremental_agg_merge", "time_weighted_average", "resample_gapfill", "tumbling_avg", "stream_file_ingest",
    "stream_dedup", "eventlog_expectations", "lineage_latest", "dash_status_weather", "union_distinct_zero",
    "untar_members", "unpack_posexplode", "rescued_data", "word_freq", "sentiment_lexicon", "score_table",
]


def main() -> None:
    from strata import session
    from strata.plans import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = sys.argv[1:] or HEADLINE
    spark = session.build("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(run(name), 3)
    line = {"metric": "total seconds over headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
            "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": int(cpus)}
    if "stream_file_ingest" in seconds:
        events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
        line["stream_events_per_sec"] = round(events / seconds["stream_file_ingest"])
    spark.stop()
    print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main()
