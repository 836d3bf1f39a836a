"""``spark-submit`` / ``python -m vigia`` entry: etl, analytics, models, publish or all."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from vigia.model import DATE_FORMATS, EXTRA_DATE_FORMATS
from vigia.plans.pipeline import Settings, Zones, run_all, run_analytics, run_etl, run_models, run_publish
from vigia.session import get_session


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="vigia", description="Case-surveillance batch jobs")
    jobs = parser.add_subparsers(dest="job", required=True)
    folders = {
        "etl": ("raw", "trusted"),
        "analytics": ("trusted", "refined"),
        "models": ("trusted", "refined"),
        "publish": ("refined",),
        "all": ("raw", "trusted", "refined"),
    }
    for job, names in folders.items():
        command = jobs.add_parser(job)
        for name in names:
            command.add_argument(name, help=f"root folder of the {name} zone")
        command.add_argument("--extra-dates", action="store_true", help="accept more date patterns")
        command.add_argument("--first-match", action="store_true", help="department by code, else name")
        command.add_argument("--extra-reports", action="store_true", help="write the documented-only datasets too")
        command.add_argument("--resume", action="store_true", help="leave out what an earlier run has finished")
        command.add_argument("--database", help="catalogue database to publish to")
        command.add_argument("--tables-root", help="folder of the published tables; default: the session's warehouse")
    args = parser.parse_args(argv)

    zones = Zones(*(getattr(args, zone, "") for zone in ("raw", "trusted", "refined")))
    settings = Settings(
        date_formats=DATE_FORMATS + (EXTRA_DATE_FORMATS if args.extra_dates else ()),
        first_match=args.first_match,
        extra_reports=args.extra_reports,
    )
    spark = get_session(f"vigia-{args.job}")
    if args.job == "all":
        audit = run_all(spark, zones, settings, args.database, args.tables_root, args.resume)
    elif args.job == "publish":
        audit = run_publish(spark, zones, database=args.database, tables_root=args.tables_root).table(spark)
    else:
        stage = {"etl": run_etl, "analytics": run_analytics, "models": run_models}[args.job]
        audit = stage(spark, zones, settings).table(spark)
    audit.show(200, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
