"""Benchmark: one JSON line with the median seconds of every named query.

Every query runs as a full action on the sf table in $BENCH_SF_DIR with
next to the queries that correspond to them.
"""

from __future__ import annotations

import json
import os
import re

from fleetscope.fixed_values import DEFAULT_VIEW
from fleetscope.operators import topk
from fleetscope.plans import catalog, measure
from fleetscope.schema import TELEMETRY
from fleetscope.session import local_session
from fleetscope.sinks.writers import replace_table, shared_folder
from fleetscope.sources.events import damaged_telemetry, telemetry
from fleetscope.sources.readers import register_view

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))

PUBLISHED = {
    "top_unauthorized_cached": {"spark_sql": 0.74, "document_store": 0.0874},
    "csv_read_count": 1.3908,
    "parquet_read_count": 1.3116,
}


def main() -> None:
    spark = local_session(CPUS, "fleetscope-bench")
    times: dict[str, float] = {}

    # as in any analysis, the source is declared once and queried many times
    readings = telemetry(spark, SF_DIR)
    damaged = damaged_telemetry(spark, SF_DIR)
    sources = ((catalog.CLEAN, readings), (catalog.DAMAGED, damaged))
    for queries, source in sources:  # first of all warm up, so that the order does not matter
        for name in queries.keys() - catalog.LOADS.keys():
            measure.run(queries[name](source))
    for queries, source in sources:
        for name, query in queries.items():
            repeats = 1 if name in catalog.LOADS else REPEATS
            times[name] = measure.seconds(lambda: measure.run(query(source)), repeats)

    readings = readings.select(*TELEMETRY.fieldNames())
    folder = shared_folder(spark)
    replace_table(readings, f"{folder}/csv", "csv")
    replace_table(readings, f"{folder}/parquet")
    times |= measure.compare_formats(spark, f"{folder}/csv", f"{folder}/parquet", REPEATS)

    cached = spark.read.schema(TELEMETRY).parquet(f"{folder}/parquet").persist()
    rows = cached.count()
    register_view(cached)
    times["top_unauthorized_cached"] = measure.seconds(
        lambda: topk.top_unauthorized_forklifts(spark.table(DEFAULT_VIEW)).collect(), 3 * REPEATS, 5
    )
    cached.unpersist()

    scale = re.search(r"sf([0-9.]+)/?$", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": {name: round(value, 4) for name, value in times.items()},
                "sf": float(scale.group(1)) if scale else SF_DIR,
                "rows": rows,
                "cpus": CPUS,
                "repeats": REPEATS,
                "spark": spark.version,
                "published": PUBLISHED,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
