"""Time the headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Three groups: single jobs from the raw tables, one whole rebuild of the mart, and the dashboard
KPIs over the mart that the rebuild published.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalogue.adapters import Tables  # noqa: E402
from catalogue.queries import mart_sources, registered  # noqa: E402
from starmart.plans import kpis  # noqa: E402
from starmart.plans import rebuild as mart  # noqa: E402
from starmart.session import build_session, new_folder  # noqa: E402

FROM_RAW = ["f01_consultation_fact", "f02_deaths_by_day_and_region", "f03_deaths_fact",
            "f04_satisfaction_fact", "f05_hospitalisation_fact", "d03_patients",
            "d11_practitioner_upsert", "a02_consultation_view", "g01_consultations_detail",
            "g05_consultations_by_establishment", "g09_demographics", "g12_deaths_by_region",
            "g14_consultations_volume", "g16_satisfaction_volume"]
OVER_MART = ["consultations_detail", "deaths_by_day", "satisfaction_by_day",
             "consultations_by_establishment", "consultations_by_diagnosis", "demographics",
             "consultations_by_practitioner", "deaths_by_region", "satisfaction_by_region",
             "consultations_volume", "top_establishments", "top_diagnosis_series"]


def timed(make) -> float:
    """Best of two runs after one warm-up; every row is produced, none is collected."""
    best = float("inf")
    for attempt in range(3):
        start = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        if attempt:
            best = min(best, time.perf_counter() - start)
    return round(best, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-")})
    spark.sparkContext.setLogLevel("ERROR")
    seconds, queries = {}, registered()
    for name in FROM_RAW:
        seconds[name] = timed(lambda: queries[name](spark, sf_dir))

    root, tables = new_folder(spark, "mart"), Tables(spark, sf_dir)
    start = time.perf_counter()
    mart.rebuild(spark, mart_sources(tables), root, mart.EXTENDED)
    seconds["rebuild_extended"] = round(time.perf_counter() - start, 3)
    star = mart.published_run(spark, root).star()
    for name in OVER_MART:
        seconds[f"mart_{name}"] = timed(lambda: getattr(kpis, name)(star))
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir)}))
    spark.stop()


if __name__ == "__main__":
    main()
