"""Command-line jobs (usable with spark-submit): the batch operations the reference runs as
scripts and cron jobs.

  python -m omnitally refresh-kpi --input DIR --out BASE [--dense]
  python -m omnitally resync-day  --input DIR --out BASE --day YYYY-MM-DD [--dense]
  python -m omnitally reconcile   --input DIR --out PATH [--fix]
  python -m omnitally report      --input DIR --out PATH --period weekly --date YYYY-MM-DD

On a cluster the master and ``spark.checkpoint.dir`` come from spark-submit; ``--master``
is only for local runs. ``reconcile`` loads PATH/facts on its first run and compares the
sources with it from then on; --fix pulls differing days again. Exit code of ``reconcile``: 0 all match, 1 mismatches, 2 errors.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="omnitally")
    ap.add_argument("job", choices=["refresh-kpi", "resync-day", "reconcile", "report"])
    ap.add_argument("--input", required=True, help="folder with the input Parquet tables")
    ap.add_argument("--out", required=True, help="output base path")
    ap.add_argument("--day")
    ap.add_argument("--date")
    ap.add_argument("--period", default="weekly", choices=["daily", "weekly", "monthly"])
    ap.add_argument("--fix", action="store_true", help="reconcile: pull the days that differ again")
    ap.add_argument("--dense", action="store_true", help="use the dense (folded dates) binding")
    ap.add_argument("--master")
    a = ap.parse_args(argv)

    from pyspark.sql import functions as F

    from omnitally.operators import quality as Q
    from omnitally.plans import jobs
    from omnitally.session import get_spark
    from omnitally.sources import star

    spark = get_spark(a.master, app=f"omnitally-{a.job}")
    orders = star.fact_order(spark, a.input, a.dense)
    lines = star.fact_order_line(spark, a.input)
    now = F.current_timestamp().cast("timestamp_ntz")
    if a.job == "refresh-kpi":
        ts = spark.range(1).select(now.cast("string")).first()[0]
        version, _ = jobs.refresh_kpi(spark, orders, lines, a.out, ts)
        print(version)
        return 0
    if a.job == "resync-day":
        if not a.day:
            ap.error("--day is required")
        jobs.resync_day(spark, orders, lines, jobs.current_version(spark, a.out), a.day)
        return 0
    if a.job == "reconcile":
        import uuid

        from omnitally.plans import recon
        from omnitally.plans.q_recon import sources
        feeds = {n: read for n, read in sources(spark, a.input).items() if n != "dtc"}
        facts, run = f"{a.out}/facts", f"{a.out}/runs/{uuid.uuid4().hex[:8]}"
        if not jobs.has_data(spark, facts):  # the first run loads the warehouse
            first = None
            for read in feeds.values():
                first = read() if first is None else first.unionByName(read())
            recon.store_facts(first, facts)
        r = recon.reconcile(spark, feeds, facts, run)
        if a.fix:
            ts = spark.range(1).select(now.cast("string")).first()[0]
            recon.resync(spark, feeds, Q.mismatch_actions(r), facts, f"{a.out}/totals", f"{a.out}/audit", ts,
                         spark.range(1).select(F.unix_micros(F.current_timestamp())).first()[0])
            r = recon.reconcile(spark, feeds, facts, f"{run}-fixed")
        r.write.mode("overwrite").parquet(f"{a.out}/results")
        s = Q.reconcile_summary(r).first()
        print(f"match={s.matches} mismatch={s.mismatches} error={s.errors}")
        return int(s.exit_level)
    if a.job == "report":
        if not a.date:
            ap.error("--date is required")
        kpi = jobs.read_current_kpi(spark, a.out + "/kpi") if jobs.path_exists(spark, a.out + "/kpi/_CURRENT") else None
        if kpi is None:
            _, kpi = jobs.refresh_kpi(spark, orders, lines, a.out + "/kpi", a.date + " 00:00:00")
        secs = jobs.report_sections(spark, kpi, orders, lines, star.static_channels(spark), a.period, a.date)
        for name, path in jobs.write_report(secs, a.out + "/report").items():
            print(name, path)
        return 0
    return 2


if __name__ == "__main__":
    sys.exit(main())
