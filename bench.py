"""Headline timings; prints one JSON line.

Queries are run to the end with the ``noop`` sink, so that all columns are computed and no rows
travel to the driver.  ``job_*`` is the whole batch job in a fresh folder: raw JSON landed,
ETL, all result datasets, all models with their full settings, publishing.

    BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from collections.abc import Callable
from pathlib import Path

from vigia.bindings import star
from vigia.bindings.queries import QUERIES
from vigia.model import RAW_CASES, RAW_DIMENSIONS
from vigia.plans.pipeline import Audit, Settings, Zones, run_analytics, run_etl, run_models, run_publish
from vigia.session import get_session
from vigia.sources.landing import land_snapshot

HEADLINE = (
    "temporal_monthly", "temporal_weekly", "demo_age_sex", "geo_department", "geo_region",
    "geo_municipality_top50", "infra_capacity", "kpis", "time_to_diagnosis", "cfr_month_department",
    "recovery_time", "critical_municipalities", "attack_rate", "sex_ratio_pivot", "severity_index",
    "rank_departments", "age_region", "age_top_departments", "cumulative_cases", "cumulative_cfr",
    "national_cumulative", "consolidated", "dashboard_consolidated", "dedup_cases", "clean_dates",
    "clean_cases", "join_any", "join_first_match", "etl_trusted", "pk_fk_check",
)


def timed(action: Callable[[], object]) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/nation.parquet").count()

    def run(name: str) -> None:
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

    run(HEADLINE[0])  # compiles and loads what every query uses
    times = {name: timed(lambda: run(name)) for name in HEADLINE}

    root = tempfile.mkdtemp(prefix="run-bench-")
    zones = Zones(f"{root}/raw", f"{root}/trusted", f"{root}/refined")
    settings = Settings(star.THRESHOLDS, star.VOCABULARY)
    audit = Audit()

    def land() -> None:
        land_snapshot(star.raw_cases(spark, folder), zones.raw, RAW_CASES)
        dimensions = {"departamentos": star.departments, "municipios": star.municipalities,
                      "hospitales": star.hospitals}
        for name, build in dimensions.items():
            land_snapshot(build(spark, folder), zones.raw, RAW_DIMENSIONS[name])

    times["job_land"] = timed(land)
    times["job_etl"] = timed(lambda: run_etl(spark, zones, settings, audit))
    times["job_analytics"] = timed(lambda: run_analytics(spark, zones, settings, audit))
    times["job_models"] = timed(lambda: run_models(spark, zones, settings, audit))
    times["job_publish"] = timed(lambda: run_publish(spark, zones, audit, tables_root=f"{root}/tables"))
    print(json.dumps({
        "metric": "total time of the headline queries and the whole job",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(folder).name.removeprefix("sf"),
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
