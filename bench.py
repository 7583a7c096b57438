"""Time the headline queries; prints one JSON line.

Each query is written out in full once to warm up and BENCH_RUNS (3) times more.
`queries` has the medians, `least` and `most` the ends, `rows_a_second` the
records that a query reads over its median.
"""

from __future__ import annotations

import json
import os
import statistics
import time

import pyspark
from pyspark.sql import SparkSession

from gridlode.plans import adapter, catalogue

NAMES = ("node_metrics", "node_pressure", "snapshot_resolution", "metrics_with_ambiguity", "integrity_audit", "collision_groups", "parse_point", "flag_counts", "quality_summary", "record_key", "upsert_nodes_merge", "text_normalize")
#: The table whose rows a query reads; lineitem for all others.
READS = {"collision_groups": "customer", "upsert_nodes_merge": "customer", "text_normalize": "documents"}


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", os.environ.get("BENCH_WAREHOUSE", "/tmp/gridlode-bench"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    took, least, most, rate = {}, {}, {}, {}
    for name in NAMES:
        runs = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "3")) + 1):  # the first warms up
            began = time.perf_counter()
            catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - began)
        took[name], least[name], most[name] = (round(f(runs[1:]), 3) for f in (statistics.median, min, max))
        rate[name] = round(adapter.table(spark, sf_dir, READS.get(name, "lineitem")).count() / took[name])
    out = {"metric": "total seconds of the headline queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/"))}
    print(json.dumps(out | {"least": least, "most": most, "rows_a_second": rate, "spark": pyspark.__version__, "cores": int(cpus)}))


if __name__ == "__main__":
    main()
