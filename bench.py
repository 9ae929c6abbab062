"""Time headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

import json
import os
import sys
import time

from provatab.cluster import session
from provatab.plans.all_queries import QUERIES

HEADLINE = (
    "p2_content_identity",
    "p5_latest_run",
    "s8_upsert",
    "n1_parsed_renderings",
    "n7_normalized_lines",
    "j4_block_roles",
    "d9_propagated_headers",
    "f8_resolved_cells",
    "f11_joined_records",
    "g4_prefiltered_evidence",
    "e1_set_metrics",
    "e20_compared_releases",
    "e23_p95_latency",
    "e31_numeric_coverage",
    "x1_bulletin_tables",
    "x4_export_preflight",
    "d1_sections",
    "d3_nearest_section",
    "d8_melted_rows",
    "d14_typed_values",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("OFF")
    # One small query first, so that the first timing is not the JVM's start.
    spark.read.parquet(f"{sf}/nation.parquet").groupBy("n_regionkey").count().collect()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
