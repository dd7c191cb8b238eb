"""Command line for the daily jobs (the steps a scheduler runs).

    python -m lodestone.cli land --bronze B --silver S --feed metal --run-date 2026-04-08
    python -m lodestone.cli gather --responses P --bronze B --feed news --run-date 2026-04-08
    python -m lodestone.cli build-mart --silver S --mart M --run-date 2026-04-08
    python -m lodestone.cli backfill --root R [--out O]

Run it with spark-submit on a cluster; master and sizes come from there.
"""

from __future__ import annotations

import argparse
import json
import sys

from lodestone import config


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="lodestone")
    sub = p.add_subparsers(dest="cmd", required=True)
    land = sub.add_parser("land", help="bronze day -> silver day + rejects, for one feed")
    land.add_argument("--bronze", required=True)
    land.add_argument("--silver", required=True)
    land.add_argument("--feed", required=True, choices=config.FEEDS)
    land.add_argument("--run-date", required=True)
    land.add_argument("--run-ts", default=None, help="news timestamp (default: the run day)")
    land.add_argument("--whole-text", action="store_true", help="each file is one (pretty-printed) document")
    land.add_argument("--on-missing", choices=("fail", "skip"), default="fail", help="FX document without a configured currency")
    land.add_argument("--incomplete", action="store_true", help="take macro and news documents that lack configured keys")
    gather = sub.add_parser("gather", help="per-key responses (JSON lines: key, body, fetched_at) -> one bronze document")
    gather.add_argument("--responses", required=True)
    gather.add_argument("--bronze", required=True)
    gather.add_argument("--feed", required=True, choices=("fred", "news"))
    gather.add_argument("--run-date", required=True)
    mart = sub.add_parser("build-mart", help="silver tables -> fact mart (full rebuild)")
    mart.add_argument("--silver", required=True)
    mart.add_argument("--mart", required=True)
    mart.add_argument("--run-date", required=True)
    mart.add_argument("--start", default=config.PROJECTION_START)
    mart.add_argument("--dedupe-rates", action="store_true")
    mart.add_argument("--relaxed", action="store_true", help="keep rows when there is no IDR rate")
    bf = sub.add_parser("backfill", help="old object layout -> day partitions (never deletes)")
    bf.add_argument("--root", required=True)
    bf.add_argument("--out", default=None)
    bf.add_argument("--manifest", default=None, help="write the manifest table here")
    args = p.parse_args(argv)

    from lodestone.plans import daily
    from lodestone.session import build_session

    spark = build_session(app=f"lodestone-{args.cmd}")
    if args.cmd == "land":
        out = daily.land_to_silver(spark, args.bronze, args.silver, args.feed, args.run_date, args.run_ts,
                                   args.whole_text, args.on_missing, not args.incomplete)
        print(json.dumps(out))
    elif args.cmd == "gather":
        daily.land_responses(spark.read.schema("key string, body string, fetched_at string").json(args.responses),
                             args.bronze, args.feed, args.run_date)
    elif args.cmd == "build-mart":
        daily.build_mart(spark, args.silver, args.mart, args.run_date, args.start,
                         dedupe_rates=args.dedupe_rates, strict=not args.relaxed)
    else:
        from lodestone.operators import backfill

        man = backfill.run_backfill(spark, args.root, args.out).persist()
        if args.manifest:
            man.write.mode("overwrite").parquet(args.manifest)
        for r in backfill.summary(man, backfill.listing_complete(spark, args.root, man)).collect():   # one row per layer
            print(json.dumps(r.asDict()))
    return 0


if __name__ == "__main__":
    sys.exit(main())
