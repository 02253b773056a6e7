"""Time the headline queries: one warm-up, then the median of BENCH_RUNS full runs into a noop sink."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from fieldsync.catalog.queries import REGISTERED  # noqa: E402
from fieldsync.session import local_session  # noqa: E402

HEADLINE = [
    "install_pivot",
    "install_push",
    "install_repush",
    "previous_flag",
    "contact_new",
    "contact_changed",
    "technician_new",
    "technician_changed",
    "delete_feed",
    "swap_feed",
    "stock_ledger",
    "stock_balance",
    "stock_shared_serials",
    "receipt_log_once",
    "attributes_current",
    "contractor_first_wins",
    "material_cascade",
    "json_rejects",
    "repush_backlog",
    "decimal_qty",
]


def run(spark, name: str, sf_dir: str) -> float:
    began = time.perf_counter()
    REGISTERED[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores=cores, shuffle_partitions=int(cores))
    seconds = {}
    for name in HEADLINE:
        run(spark, name, sf_dir)
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cores": int(cores),
                "shuffle_partitions": int(cores),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
