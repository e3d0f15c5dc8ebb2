"""Times the catalog and prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from footfall.plans.catalog import QUERIES
from footfall.plans.logs import LOG_QUERIES
from footfall.plans.streams import STREAM_QUERIES
from footfall.session import local_session


def run(df) -> None:
    """Computes every row and column without keeping them."""
    df.write.format("noop").mode("overwrite").save()


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    for name in ("page_views", "hot_items"):  # the first queries of a session pay for its start-up
        run(QUERIES[name](spark, sf_dir))
    seconds, queries = {}, {**QUERIES, **LOG_QUERIES, **STREAM_QUERIES}
    for name in names or queries:
        begin = time.perf_counter()
        run(queries[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - begin, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:])
