"""Time the headline queries, cold and warm, and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8). The documents are first dealt into as many files as
there are cores, as a large table has many; that is not timed. ``queries`` holds the first runs, ``warm`` the second ones
and ``rows_per_sec`` the documents taken in a second of the warm run.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "dataset_comparison",
    "full_report",
    "top_identifiers",
    "entry_lines",
    "manifest_tasks",
    "generation_prompts",
    "label_resolution",
    "first_success",
    "work_states",
    "pending_samples",
    "assembled_entries",
    "assembly_counts",
    "audit_summary",
    "pruned_snapshot",
    "symbol_lists",
)
#: A second run of a query that took longer than this tells nothing new.
WARM_LIMIT_S = 40


def dealt(spark, sf_dir: str, parts: int) -> str:
    """A folder with the tables, the documents in ``parts`` files."""
    from tessella.session import scratch_path

    folder = scratch_path(spark, "bench")
    for name in ("documents", "part", "labels", "conversations", "pages", "nation", "events"):
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        (df.repartition(parts) if name == "documents" else df).write.parquet(f"{folder}/{name}.parquet")
    return folder


def main() -> None:
    from tessella.plans.registry import REGISTRY
    from tessella.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=int(cpus) * 2,
        spark__driver__memory="20g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    folder = dealt(spark, sf_dir, int(cpus) * 2)
    rows = spark.read.parquet(f"{folder}/documents.parquet").count()
    REGISTRY["dataset_totals"](spark, folder).collect()  # start the engine before timing

    def timed(name: str) -> float:
        start = time.perf_counter()
        REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    cold, warm = {}, {}
    for name in names:
        cold[name] = timed(name)
        warm[name] = timed(name) if cold[name] < WARM_LIMIT_S else cold[name]
        print(name, cold[name], warm[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(cold.values()), 3),
                "unit": "sec",
                "queries": cold,
                "warm": warm,
                "rows_per_sec": {n: round(rows / t) for n, t in warm.items()},
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
