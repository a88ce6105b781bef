"""Time the headline queries: one warm-up, then the median of three runs into the noop sink."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from caseworks.session import local_session
from caseworks.workload import registry

HEADLINE = [
    "mrt_activite", "mrt_adhesion", "mrt_adv_facture", "mrt_benef_ca_prime", "mrt_facture",
    "mrt_formateur_portefeuille", "mrt_pilotage", "mrt_presence", "mrt_prime", "mrt_rdv", "mrt_rdv_detail",
    "mrt_referent_Ca", "mrt_referent_rdv_ca", "BDD_BU_SECURE", "deduplicate", "monthly_periods", "pivot", "unpivot",
    "surrogate_key", "histogram", "check_equality", "check_sequential_values", "check_sequential_values_grouped",
    "check_mutually_exclusive_ranges",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)), "bench", **{"spark.driver.memory": "16g"})
    wanted = sys.argv[1:] or HEADLINE
    queries, seconds = registry.queries(), {}

    def timed(name: str) -> float:
        started = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    for name in wanted:
        timed(name)
        seconds[name] = round(statistics.median(timed(name) for _ in range(runs)), 3)
    total = round(sum(seconds.values()), 3)
    scale = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "sum of median query seconds", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
