"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from visitlens.catalog.queries import QUERIES
from visitlens.session import build_session, remove_intermediate

HEADLINES = (
    "derive_target",
    "time_since_last_visit",
    "visits_by_category",
    "mask_rare_columns",
    "people_per_day",
    "next_camp_in",
    "global_lag_diff",
    "row_number_global",
    "holdout_last_n",
    "label_encode",
    "auc_exact",
    "ensemble_mean",
    "feature_table",
    "train_gbt",
)


def run(spark, name: str, folder: str) -> float:
    """Seconds to compute every output column of a query, planning included."""
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINES
    spark = build_session(cpus, "bench", **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="visitlens-bench-")})
    QUERIES["scan_registrations"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        times = [run(spark, name, folder) for _ in range(1 if name == "train_gbt" else repeats)]
        seconds[name] = round(statistics.median(times), 3)
    remove_intermediate(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median query seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
