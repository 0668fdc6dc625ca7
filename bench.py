"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one JSON line."""
from __future__ import annotations

import json
import os
import statistics
import time

from arraytide import session
from arraytide.queries import load_all

HEADLINE = ["place_on_axis", "gap_stats", "keep_runs", "interval_mask", "best_stretch", "stretch_verdict", "active_per_day",
            "overlap_groups", "fleet_event_flags", "fill_short_gaps", "lanczos_shift", "weighted_stack", "remote_choice",
            "guarded_upsert", "ledger_latest", "response_tests", "record_choice", "chunk_power", "segment_pairs",
            "despike", "decimated", "octave_coherence", "delivered_rows"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    repeats, budget_s = int(os.environ.get("BENCH_REPEATS", "3")), float(os.environ.get("BENCH_BUDGET_S", "420"))
    spark = session.build("bench", cores=os.environ.get("BENCH_CPUS", "8"), shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    q = load_all()[0]
    times = {}
    # one warm-up, then the median of the repeats; no repeats are started once the time for them is used up
    q[HEADLINE[0]](spark, folder).write.format("noop").mode("overwrite").save()
    began = time.time()
    for name in [n for n in HEADLINE if n in q]:
        runs = []
        for k in range(repeats):
            if k and time.time() - began > budget_s:
                break
            t0 = time.time()
            q[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - t0)
        times[name] = round(statistics.median(runs), 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
