"""Time the queries and print one JSON line.

Every query is run to the end into a sink that discards rows, after one unmeasured query that warms
the session up. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pingloom.session import build_session  # noqa: E402
from testbed import queries  # noqa: E402


def run(spark, query, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, queries.latest_arrival, sf_dir)
    times = {name: round(run(spark, queries.ALL[name], sf_dir), 3) for name in names or queries.ALL}
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main(sys.argv[1:])
