"""Headline queries timed at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query first runs on the smallest tables, so that class loading and just-in-time
compilation are not part of its time ($BENCH_WARM=0 leaves that out).  A time covers
planning, all jobs the query starts and computing every column of every row.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from locusflow.catalog.queries import QUERIES  # noqa: E402
from locusflow.session import local_session  # noqa: E402

HEADLINE = [
    "filter_mapped", "merge_intervals", "filter_known_sites", "interval_join", "interval_semi_join", "assign_regions",
    "count_reads_by_region", "count_features", "combine_variants", "filter_variants", "annotate_variants",
    "mark_duplicates", "depth", "pileup", "call_snps", "recalibration_table", "apply_recalibration", "read_sam",
    "split_n_reads", "run_dna",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cpus)
    spark.read.parquet(f"{sf_dir}/region.parquet").count()  # Session start-up is not part of any query.
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    warm = os.environ.get("BENCH_WARM", "1") != "0" and os.path.isdir(small)
    seconds = {}
    for name in names:
        if warm:
            QUERIES[name](spark, small).write.format("noop").mode("overwrite").save()
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    result = {
        "metric": "total wall time of headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rsplit("sf", 1)[-1],
        "cpus": cpus,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
