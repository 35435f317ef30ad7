"""Time every query of the catalogue and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores, BENCH_QUERIES a subset, BENCH_RUNS how often
each query runs (the median counts). A query is written to the noop sink: all rows are computed
and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from playbill.plans import catalog  # noqa: E402
from playbill.session import local_session  # noqa: E402


def timed(run, spark, folder: str) -> float:
    start = time.perf_counter()
    run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else list(catalog.QUERIES)
    spark = local_session("playbill-bench", cpus)
    catalog.QUERIES["page_text_clean"](spark, folder).count()  # start-up is not the queries' cost
    seconds = {}
    for name in names:
        seconds[name] = round(statistics.median(timed(catalog.QUERIES[name], spark, folder) for _ in range(runs)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": cpus,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
