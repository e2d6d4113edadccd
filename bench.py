"""Times the headline queries on the test tables and prints one JSON line.

Model inputs are derived from the test tables and written once, outside the timing.  Each query
is run once to warm up and then ``REPEATS`` times; the median counts.  Rows are computed in full
and thrown away, so neither result transfer nor result files are timed.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from riskweave.checks import fixtures
from riskweave.checks.registry import queries
from riskweave.session import SETTINGS

HEADLINE = (
    "eds_physician", "eds_inpatient", "eds_outpatient", "eds_all", "eds_eligible_claims",
    "flag_eds_eligible",
    "dx_raps_v22", "dx_eds_raps_v23", "dx_to_hcc_v22", "hcc_flags_v22", "assemble_v22",
    "apply_hierarchies_v22", "bene_score_v22", "bene_hcc_v22", "run_v22", "run_v23",
)
REPEATS = 5


def _session(cpus: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("riskweave-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = _session(os.environ.get("BENCH_CPUS", "8"))
    fixtures.store(spark, sf_dir, tempfile.mkdtemp(prefix="riskweave-bench-"))
    available = queries()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        times = []
        for _ in range(1 + REPEATS):
            start = time.perf_counter()
            available[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total seconds of the headline queries, medians of five, on written inputs",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
