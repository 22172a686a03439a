"""Times the headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time
from statistics import median

from sparkloom.queries import REGISTRY
from sparkloom.session import session

SF_DIR, CPUS, RUNS = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = [
    "pricing_summary", "predicates", "join_inner", "join_left", "join_lateral", "group_having", "group_rollup", "group_cube", "group_ordered_set", "window_row_number_sum", "window_frames", "top_k_per_group", "sort_limit", "set_union",
    "cte_chain", "cte_recursive", "math_functions", "json_extract", "json_edit", "json_table_items", "spatial_squares", "vector_distances", "vector_nearest", "fulltext_natural", "fulltext_boolean", "dml_upsert", "dml_replace_into", "session_windows",
]


def main() -> None:
    spark = session("bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS, spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in HEADLINE:
        times = []
        for _ in range(RUNS + 1):  # the first one warms up
            start = time.perf_counter()
            REGISTRY.run(name, spark, SF_DIR).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        took[name] = round(median(times[1:]), 4)
    print(json.dumps({"metric": "headline queries, warm, median, summed", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": SF_DIR, "cpus": int(CPUS)}))


if __name__ == "__main__":
    main()
