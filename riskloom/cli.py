"""Command line for the load jobs (``spark-submit -m riskloom.cli ...`` or
``python -m riskloom.cli ...``).  Paths may be local, HDFS or object-store
URIs; the session's ``spark.checkpoint.dir`` must name a shared folder.

  daily-run       completeness -> [exclusions] -> [credit events] -> PD range -> history row
  pd-range        PD deliveries of a date range into the versioned table (+ forward fill)
  refresh         derived tables (panel, 2-day, website) from the versioned table
  ingest          one availableNow pass of the streaming version ingest
"""

from __future__ import annotations

import argparse
import datetime as dt

from riskloom.schemas import DAILY_ECONOMIES


def _date(s: str | None):
    return dt.date.fromisoformat(s) if s else None


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="riskloom")
    sub = p.add_subparsers(dest="cmd", required=True)

    d = sub.add_parser("daily-run")
    d.add_argument("--root", required=True, help="delivery root (<yyyymmdd>_cali_<yyyymmdd>/Products/...)")
    d.add_argument("--table", required=True, help="versioned PD table (month-partitioned Parquet)")
    d.add_argument("--log", required=True, help="run history table")
    d.add_argument("--start")
    d.add_argument("--end")
    d.add_argument("--registry", help="exclusion registry sheet (CSV)")
    d.add_argument("--exclusions", nargs=2, metavar=("TABLE", "OUT"))
    d.add_argument("--events", nargs=2, metavar=("ROOT", "TABLE"))

    r = sub.add_parser("pd-range")
    r.add_argument("--root", required=True)
    r.add_argument("--table", required=True)
    r.add_argument("--start", required=True)
    r.add_argument("--end", required=True)
    r.add_argument("--snapshot")
    r.add_argument("--fill-first", action="store_true", help="fill before insert (the source's order)")

    f = sub.add_parser("refresh")
    f.add_argument("--table", required=True)
    f.add_argument("--companies", required=True, help="company mapping table (Parquet)")
    f.add_argument("--exclusions", required=True, help="exclusion table (Parquet)")
    f.add_argument("--out", required=True)
    f.add_argument("--as-of")

    i = sub.add_parser("ingest")
    i.add_argument("--source", required=True, help="landing folder of version files (Parquet)")
    i.add_argument("--table", required=True)
    i.add_argument("--checkpoint", required=True)
    i.add_argument("--max-files", type=int)

    a = p.parse_args(argv)

    from riskloom.plans import derived, jobs
    from riskloom.session import get_session
    spark = get_session()
    op_time = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)   # one instant per run

    if a.cmd == "daily-run":
        jobs.daily_run(spark, a.root, _date(a.start), _date(a.end), op_time, a.table, DAILY_ECONOMIES, a.log,
                       registry=a.registry, exclusions=tuple(a.exclusions) if a.exclusions else None,
                       events=tuple(a.events) if a.events else None)
    elif a.cmd == "pd-range":
        jobs.pd_range(spark, a.root, _date(a.start), _date(a.end), op_time, a.table, snapshot=a.snapshot,
                      fill_first=a.fill_first)
    elif a.cmd == "refresh":
        table = spark.read.parquet(a.table).drop("data_month")
        derived.refresh_derived(spark, table, spark.read.parquet(a.companies), spark.read.parquet(a.exclusions),
                                a.out, _date(a.as_of))
    elif a.cmd == "ingest":
        from riskloom.schemas import PD_TABLE
        from riskloom.streaming.ingest import ingest_available
        ingest_available(spark, a.source, PD_TABLE, a.table, a.checkpoint, max_files_per_trigger=a.max_files)


if __name__ == "__main__":
    main()
