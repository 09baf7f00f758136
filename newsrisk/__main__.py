"""Command line for the end-to-end jobs.

    python -m newsrisk events        --raw RAW --root ROOT --start 2025-10-01 --end 2026-01-10
    python -m newsrisk themes        --articles ART --root ROOT --start 2025-10-01 --end 2026-01-01
    python -m newsrisk risk-forecast --root ROOT [--variant weighted10] [--run-date D] [--trees 500]
    python -m newsrisk anomalies     --root ROOT [--trees 300]
    python -m newsrisk refresh       --raw RAW --root ROOT --start S --end E
    python -m newsrisk quality       --root ROOT
    python -m newsrisk runlog        --root ROOT

RAW / ART are ``dt``-partitioned Parquet folders; ROOT is the deployment
folder (extracts, processed, published, reports). ``--master`` defaults to the
one spark-submit provides.
"""

from __future__ import annotations

import argparse
import json
import sys


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="newsrisk")
    p.add_argument("job", choices=["events", "themes", "risk-forecast", "anomalies", "refresh", "quality", "runlog"])
    p.add_argument("--root", required=True)
    p.add_argument("--raw")
    p.add_argument("--articles")
    p.add_argument("--start")
    p.add_argument("--end")
    p.add_argument("--variant", default="share_log", choices=["share_log", "weighted10"])
    p.add_argument("--run-date")
    p.add_argument("--trees", type=int)
    p.add_argument("--top-k", type=int, default=200)
    p.add_argument("--master")
    p.add_argument("--shuffle-partitions", type=int, default=200)
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    from newsrisk.plans import jobs
    from newsrisk.session import get_spark
    from newsrisk.sources.readers import read_raw

    spark = get_spark(master=args.master, shuffle_partitions=args.shuffle_partitions)
    layout = jobs.Layout(args.root)

    def need(*names):
        missing = [n for n in names if getattr(args, n) is None]
        if missing:
            raise SystemExit(f"{args.job} needs --{' --'.join(m.replace('_', '-') for m in missing)}")

    if args.job == "events":
        need("raw", "start", "end")
        out = jobs.run_events(spark, read_raw(spark, args.raw), layout, args.start, args.end)
    elif args.job == "themes":
        need("articles", "start", "end")
        out = jobs.run_themes(spark, read_raw(spark, args.articles), layout, args.start, args.end, args.top_k)
    elif args.job == "risk-forecast":
        out = jobs.run_risk_forecast(spark, layout, args.variant, args.run_date, args.trees or 500)
    elif args.job == "anomalies":
        out = jobs.run_anomalies(spark, layout, args.trees or 300)
    elif args.job == "refresh":
        need("raw", "start", "end")
        row = jobs.run_refresh(spark, read_raw(spark, args.raw), layout, args.start, args.end, args.run_date,
                               args.trees or 500).first()
        out = row.asDict()
    elif args.job == "runlog":
        out = spark.read.parquet(jobs.refresh_run_log(spark, layout)).first().asDict()
    else:
        out = {name: [r.asDict() for r in df.collect()] for name, df in jobs.quality_report(spark, layout).items()}
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
