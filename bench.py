"""Times the registered queries and prints one JSON line.

``BENCH_SF_DIR`` is the table folder, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the timed runs
after one warm-up round; the median counts. Results go to a sink that discards them. The ``reference_form``
figures are the same results computed with one aggregate per summary, and with a count before a
write.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from lamina.functions import any_match, row_count, target_rule  # noqa: E402
from lamina.operators import child_rollup  # noqa: E402
from lamina.plans.table_queries import QUERIES, URGENT, table  # noqa: E402
from lamina.session import build_session, scratch_dir  # noqa: E402
from lamina.sinks import write_run  # noqa: E402


def two_aggregates(spark, sf_dir):
    child = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    counts = child_rollup(child, "c_custkey", n_orders=row_count())
    flags = child_rollup(child, "c_custkey", has_urgent=any_match(F.col("o_orderpriority") == URGENT))
    joined = table(spark, sf_dir, "customer").join(counts, "c_custkey", "left").join(flags, "c_custkey", "left")
    return joined.fillna({"n_orders": 0, "has_urgent": False}).withColumn(
        "is_target", target_rule("c_mktsegment", "BUILDING", "n_orders")
    )


def count_then_write(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("total", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    lines.count()
    lines.write.mode("overwrite").parquet(scratch_dir(spark, "bench"))


def observed_write(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("total", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    write_run(lines, scratch_dir(spark, "bench"))


def seconds(spark, sf_dir, functions, runs):
    """Median per function. Rounds go over all functions, so that each meets an equally warm JVM."""
    taken = {name: [] for name in functions}
    for _ in range(runs + 1):
        for name, function in functions.items():
            start = time.perf_counter()
            out = function(spark, sf_dir)
            if out is not None:
                out.write.format("noop").mode("overwrite").save()
            taken[name].append(time.perf_counter() - start)
    return {name: round(statistics.median(times[1:]), 4) for name, times in taken.items()}


def scale(sf_dir):
    name = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    try:
        return float(name)
    except ValueError:
        return name


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    compared = {f"form:{f.__name__}": f for f in (two_aggregates, count_then_write, observed_write)}
    taken = seconds(spark, sf_dir, {**QUERIES, **compared}, runs)
    times = {name: taken[name] for name in QUERIES}
    forms = {name.removeprefix("form:"): taken[name] for name in compared}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "reference_form": forms,
                "sf": scale(sf_dir),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
