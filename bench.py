"""Benchmark: full lake refresh and the five business reports.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line. Timed steps:

* ``refresh`` = ``stream_land`` (drain the event inbox into the landing) +
  ``bronze_ingest`` (seven datasets) + ``silver_refresh`` + ``gold_refresh``
  (six tables, fact quality gate, publish); every layer is written to disk.
  Each phase is the median of three runs, each into a fresh lake root.
* ``<report>``: each business report over the published gold tables
  (median of three warm runs), as users run them.
* ``dq_silver_payments``, ``constraint_report``: the silver suite and the gold
  key/constraint report over the written tables (median of three).
* ``e2e_<report>``: the same report as one plan straight from the raw test
  tables (mapping, cleaning, joins, gold and report in a single query).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from ledgerline.plans import refresh  # noqa: E402
from ledgerline.plans.catalog import REPORTS, Gold, Lake  # noqa: E402
from ledgerline.plans.io_jobs import RUN_DATE  # noqa: E402
from ledgerline.session import local_session, scratch_path  # noqa: E402
from ledgerline.sources import raw, testdata  # noqa: E402
from ledgerline.sources.lake import Layout  # noqa: E402
from ledgerline.streaming import landing  # noqa: E402

REFRESH_RUNS = 3


def _sf(sf_dir: str) -> float | str:
    name = Path(sf_dir).name
    try:
        return float(name.removeprefix("sf"))
    except ValueError:
        return name


def _timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(
        cpus,
        shuffle_partitions=max(8, 2 * int(cpus) if cpus.isdigit() else 16),
        advisory_partition_size=os.environ.get("BENCH_ADVISORY_PARTITION", "64m"),
    )
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-bench-"))

    # Warm-up: JVM, parquet footers, codegen caches.
    Lake.from_testdata(spark, sf_dir).dim_merchant.count()

    times: dict[str, float] = {}
    phases = ("stream_land", "bronze_ingest", "silver_refresh", "gold_refresh")
    runs: dict[str, list[float]] = {p: [] for p in phases}
    for _ in range(REFRESH_RUNS):
        # A fresh lake root per run, so every run does the same work.
        layout = Layout(scratch_path(spark, "bench"))
        # The producer's side (messages dropped into the inbox) is not timed.
        inbox = f"{layout.root}/inbox"
        raw.write_jsonl(testdata.event_messages(spark, sf_dir), f"{inbox}/0")
        runs["stream_land"].append(
            _timed(
                lambda: landing.land_events(
                    landing.file_messages(spark, f"{inbox}/*"), layout.stream_landing, layout.stream_checkpoint
                ).awaitTermination()
            )
        )
        runs["bronze_ingest"].append(
            _timed(lambda: refresh.bronze_ingest(spark, layout, RUN_DATE, testdata.raw_tables(spark, sf_dir)))
        )
        runs["silver_refresh"].append(_timed(lambda: refresh.silver_refresh(spark, layout, RUN_DATE)))
        runs["gold_refresh"].append(_timed(lambda: refresh.gold_refresh(spark, layout, gate=True)))
    for p in phases:
        times[p] = statistics.median(runs[p])
    times["refresh"] = sum(times[p] for p in phases)

    published = refresh.published_gold(spark, layout)
    for name in REPORTS:
        times[name] = statistics.median(_timed(lambda: getattr(published, name)().collect()) for _ in range(3))

    # Quality checks over the written layers (median of three).
    from ledgerline.operators import quality
    from ledgerline.sources import lake as lake_io

    checks = {
        "dq_silver_payments": lambda: quality.suite_report(
            lake_io.read_silver(spark, layout, "payments"), "silver_payments"
        ).collect(),
        "constraint_report": lambda: quality.constraint_report(published.tables).collect(),
    }
    for name, check in checks.items():
        times[name] = statistics.median(_timed(check) for _ in range(3))

    for name in REPORTS:
        times[f"e2e_{name}"] = _timed(lambda: getattr(Gold.of(Lake.from_testdata(spark, sf_dir)), name)().collect())

    result = {
        "metric": "refresh_plus_reports_sec",
        "value": round(times["refresh"] + sum(times[n] for n in REPORTS), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": _sf(sf_dir),
        "cpus": cpus,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
