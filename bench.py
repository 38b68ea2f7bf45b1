"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

One warm-up (which also stores the derived tables), then the median of $BENCH_RUNS
runs, each written to the ``noop`` sink. A run includes every frame the query stages.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from checks.catalog import ENTRIES
from claimspark.session import build_session

HEADLINE = {
    "r1_attendance_summary": "r1_attendance_summary",
    "j1_full": "r12_reimbursement_denials",  # heads, ids, items, denials
    "h12_header_verdict": "h12_header_verdict",
    "a6_guide_totals": "a6_guide_totals",
    "p12_p13_payment_totals": "p13_payment_totals",
    "c1_account_name": "c1_account_name",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(f"local[{cpus}]", int(cpus), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for label, name in HEADLINE.items():
        took = []
        for _ in range(runs + 1):
            started = time.time()
            ENTRIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.time() - started)
        seconds[label] = round(statistics.median(took[1:]), 3)
        print(label, [round(x, 2) for x in took], file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "claims_headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
