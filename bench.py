"""Wall-clock time per query: one JSON line for the driver.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores, ``BENCH_QUERIES`` a
comma-separated choice of queries. Each query is planned and run to its end (every row
computed, none collected). The first query is run once before, so that the start of the
JVM is not counted as its work.
"""

from __future__ import annotations

import json
import os
import time

from sheafline.plans import QUERIES
from sheafline.session import local_session

#: All queries, the flagship first.
HEADLINE = ("flux_day", *(name for name in QUERIES if name != "flux_day"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = local_session("bench", cpus=cpus)
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        # a query must not profit from what another one left in memory
        spark.catalog.clearCache()
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run(names[0])
    seconds = {name: round(run(name), 3) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
