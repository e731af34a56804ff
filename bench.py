"""Time the pipeline and the reports; prints one JSON line.

Input tables come from $BENCH_SF_DIR, and the session is local[$BENCH_CPUS]. The raw CSV files are
written from `lineitem` before the clock starts. Everything runs $BENCH_RUNS times in one session:
`value` and `queries` are of the run in the middle, `runs` holds the total of each, and `first` the steps of the
first, with cold code.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from asfalto.operators import layout
from asfalto.plans import dashboard, medallion, pages, star
from asfalto.registry.queries import SLICED_MEASURES, SLICES
from asfalto.session import new_folder, remove_staged, session
from asfalto.sources.accidents import raw_rows
from asfalto.sources.csv_files import read_folder, write_folder

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def total(seconds: dict[str, float]) -> float:
    """Of the steps that every round has had; whole pages come on top of the visuals they consist of."""
    return round(sum(v for k, v in seconds.items() if k != "pipeline_csv_to_gold" and k not in pages.PAGES), 3)


def landed(spark, sf_dir: str) -> str:
    folder = new_folder(spark, "bench-csv")
    write_folder(raw_rows(spark, sf_dir), folder)
    return folder


def pipeline(spark, folder: str, timed) -> medallion.Lake:
    lake = medallion.Lake(spark, new_folder(spark, "bench-lake"))
    timed("bronze_to_silver", lambda: medallion.build_silver(lake, read_folder(spark, folder)))
    timed("dims", lambda: medallion.build_dims(lake))
    timed("facts", lambda: medallion.build_facts(lake))
    return lake


def reports(lake: medallion.Lake, timed) -> None:
    for name in dashboard.VISUALS:
        timed(name, lambda: dashboard.visual(lake, name).collect())
    for name, where in SLICES.items():
        timed(name, lambda: star.ask(lake, SLICED_MEASURES, ["ano"], where).collect())
    for name in pages.PAGES:
        timed(name, lambda: pages.report(lake, name, SLICES["slicers_combined"]).collect())


def main() -> None:
    spark = session(
        f"local[{CPUS}]",
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": CPUS,
            # one listing task per core, not one per directory
            "spark.sql.sources.parallelPartitionDiscovery.parallelism": CPUS,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, work):
        start = time.monotonic()
        result = work()
        seconds[name] = round(time.monotonic() - start, 3)
        return result

    folder = landed(spark, SF_DIR)
    runs = []
    for _ in range(RUNS):
        seconds.clear()
        lake = pipeline(spark, folder, timed)
        seconds["pipeline_csv_to_gold"] = round(sum(seconds.values()), 3)
        reports(lake, timed)
        timed("optimize_facts", lambda: medallion.optimize(lake, new_folder(spark, "bench-optimized")))
        timed("compact_fact", lambda: layout.compact(
            spark, lake.path("gold_fato_acidente"), new_folder(spark, "bench-compact"), ["ano"]))
        runs.append(dict(seconds))
    middle = sorted(runs, key=total)[len(runs) // 2]
    rows = {t: lake[t].count() for t in ("silver_acidentes", *medallion.FACTS)}
    print(json.dumps({
        "metric": "pipeline and reports, wall time", "value": total(middle), "unit": "sec",
        "queries": middle, "sf": Path(SF_DIR).name.removeprefix("sf"), "cpus": CPUS, "rows": rows,
        "runs": [total(run) for run in runs], "first": runs[0],
    }))
    sys.stdout.flush()
    remove_staged(spark)
    spark.stop()


if __name__ == "__main__":
    main()
