"""Time the queries at BENCH_SF_DIR on local[BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from vitrine.queries import QUERIES
from vitrine.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]", **{
            "spark.sql.shuffle.partitions": CPUS, "spark.vitrine.textParallelism": CPUS, "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM and the Python workers outside the clock.
    QUERIES["clean_conversations"](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or sorted(QUERIES):
        begin = time.perf_counter()
        # All rows and columns are computed; nothing is stored.
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    print(json.dumps({"metric": "total query time", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
