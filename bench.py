"""Time the registered queries and print one JSON line.

Each query runs several times in one session, into a sink that keeps nothing;
the best time after the first run counts. ``BENCH_QUERIES`` may name others, with commas, or be ``all``.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cellweave.plans import catalog  # noqa: E402
from cellweave.session import build_session  # noqa: E402

# The first run warms up; a stream runs many small jobs, and only once more.
RUNS = 4
STREAM_RUNS = 2
HEADLINE = [
    "word_count",
    "word_count_table",
    "log_total_length",
    "ingest_messages",
    "track_lang",
    "save_pairs",
    "latest_cells",
    "cell_versions3",
    "scan_range",
    "scan_rows",
    "cell_projection",
    "bulk_get",
    "bulk_get_hot",
    "bulk_put",
    "bulk_increment",
    "bulk_delete_rows",
    "tombstone_delete",
    "mixed_mutations",
    "mixed_hot_row",
    "cas_funnel",
    "cas_hotkey",
    "check_and_put",
    "partition_map",
    "partition_foreach",
    "stream_put",
    "stream_increment",
    "stream_check",
    "stream_get",
    "stream_ingest",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    spark = build_session(
        app="cellweave-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=cores,
        conf={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    asked = os.environ.get("BENCH_QUERIES", "")
    chosen = list(queries) if asked == "all" else [n for n in asked.split(",") if n] or HEADLINE
    seconds = {}
    for name in chosen:
        runs = []
        for _ in range(STREAM_RUNS if name.startswith("stream_") else RUNS):
            begin = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - begin)
        seconds[name] = round(min(runs[1:]), 3)
    spark.stop()
    result = {
        "metric": "total seconds over the queries, best run of each after a warm-up",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
