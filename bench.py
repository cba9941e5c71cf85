"""Benchmark: the funnel refresh and headline queries on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (sum of query seconds), "unit", "queries", "sf"}.
Session start-up is excluded; every query is built from the Parquet tables and
run to completion (noop sink or files written).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from callfunnel.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = ("tab_meds", "funnel_grain", "latest_diagnosis", "reason_pivot", "call_rollup",
            "weekly_metrics", "ladder_optout", "ladder_therapy", "latest_per_key", "text_concat_per_key")


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="callfunnel-bench-")
    spark = build_session(f"local[{CPUS}]", shuffle_partitions=int(CPUS),
                          extra={"spark.ui.showConsoleProgress": "false",
                                 "spark.checkpoint.dir": os.path.join(scratch, "ckpt")})
    from callfunnel.plans import queries as Q
    from callfunnel.plans.refresh import publish, refresh
    from callfunnel.sources.adapters import ADAPTER_CONFIG, adapter_tables

    # warm the JVM (class loading, codegen caches) on the smallest input; not timed
    run_noop(Q.QUERIES["weekly_metrics"](spark, "/root/testdata/sf0.001"))
    Q._CTX.clear()

    times = {}
    t0 = time.time()
    t = adapter_tables(spark, SF_DIR)
    out = refresh(spark, t, ADAPTER_CONFIG)
    publish(spark, out, os.path.join(scratch, "out"), Q.run_stamp(Q.ctx(spark, SF_DIR)).select("updated"))
    out.release()
    times["refresh"] = round(time.time() - t0, 3)

    for name in HEADLINE:
        Q._CTX.clear()
        t0 = time.time()
        run_noop(Q.QUERIES[name](spark, SF_DIR))
        times[name] = round(time.time() - t0, 3)

    sf = re.search(r"sf([0-9.]+)", SF_DIR)
    print(json.dumps({"metric": "funnel_refresh_and_headline_queries", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf.group(1)) if sf else SF_DIR}))
    spark.stop()


if __name__ == "__main__":
    main()
