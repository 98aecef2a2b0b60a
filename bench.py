"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 2 timed runs after one warm-up; the best counts). The reports and checks
(q*, k7) read marts that the warm-up has stored; build_marts_* times that store.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from millwright import fixtures  # noqa: E402
from millwright.config import local_session  # noqa: E402
from millwright.plans import build, checks, reports  # noqa: E402
from registry import queries as registered  # noqa: E402

HEADLINES = (
    "e1_dedup_events", "g4_events_classified", "g6_fact_machine_events",
    "g5_daily_machine_product", "g7_fact_oee_daily", "g8_monthly_summary", "g9_whatif_pm",
    "c7_top_reasons", "k8_quality_profile", "q1_kpi_oee", "q8_oee_machine", "q18_perf_gap",
    "e1_dedup_events_lines", "g6_fact_machine_events_lines", "g7_fact_oee_daily_lines",
    "g8_monthly_summary_lines", "q8_oee_machine_lines", "q18_perf_gap_lines",
)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus, **{"spark.sql.shuffle.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")

    def best(action) -> float:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            action()
            times.append(time.perf_counter() - start)
        return round(min(times[1:]), 3)

    seconds = {
        key: best(lambda key=key: drain(registered.run(spark, sf_dir, key))) for key in HEADLINES
    }
    for name, tables in (("events", fixtures.raw_tables), ("lines", fixtures.line_tables)):
        raw = tables(spark, sf_dir)
        seconds[f"build_marts_{name}"] = best(lambda: build.build_scratch(raw))
        stored = build.build_scratch(raw, events_stored=True)

        def all_reports():
            for key in reports.REPORTS:
                drain(reports.report(key, stored))

        seconds[f"reports_22_stored_{name}"] = best(all_reports)
        seconds[f"checks_72_stored_{name}"] = best(lambda: drain(checks.run_suite(stored.tables())))
    rows = {
        "events": fixtures.events(spark, sf_dir).count(),
        "lineitem": fixtures.lineitem(spark, sf_dir).count(),
    }
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, best of runs, summed",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": int(cpus),
        "input_rows": rows,
    }))


if __name__ == "__main__":
    main()
