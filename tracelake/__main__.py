"""Command line: ``python -m tracelake <job> ...`` (see README)."""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tracelake")
    sub = ap.add_subparsers(dest="job", required=True)

    for name in ("itineraries", "daily"):
        p = sub.add_parser(name)
        src = p.add_mutually_exclusive_group(required=True)
        src.add_argument("--cells", help="tower directory text (file, dir or glob)")
        src.add_argument("--cells-table", dest="cells_table",
                         help="stored cell dimension (output of the cells job)")
        p.add_argument("--logs", required=True, help="log text (file, dir or glob)")
        p.add_argument("--out", required=True, help="output Parquet table")
        p.add_argument("--variant", default="default" if name == "itineraries" else "mapreduce",
                       choices=["default", "mapreduce", "rdd"])
        for opt in ("key", "unmatched", "cells_mode", "strip", "dedupe", "header", "mode"):
            p.add_argument("--" + opt.replace("_", "-"), dest=opt, default=None)
        if name == "daily":
            p.add_argument("--buckets", type=int, default=None,
                           help="store the table in buckets of the phone, for large batches of requests")
        p.add_argument("--quote-aware", dest="quote_aware", action="store_true", default=None,
                       help="read the directory as quoted CSV instead of by raw position")

    p = sub.add_parser("cells")
    p.add_argument("--cells", required=True, help="tower directory text (file, dir or glob)")
    p.add_argument("--out", required=True)
    p.add_argument("--header", default="per_file", choices=["per_file", "first_value", "none"])
    p.add_argument("--mode", default="drop", choices=["drop", "fail"])
    p.add_argument("--keep", default="largest", choices=["largest", "last"], help="the city of a tower with several")

    p = sub.add_parser("clean", help="remove old and failed versions of a stored table")
    p.add_argument("--table", required=True)
    p.add_argument("--keep", type=int, default=1, help="published versions to keep")

    p = sub.add_parser("lookup")
    p.add_argument("--daily", required=True)
    p.add_argument("--phone")
    p.add_argument("--start")
    p.add_argument("--end")
    p.add_argument("--requests", help="CSV of request_id,phone,start,end")
    p.add_argument("--out")
    p.add_argument("--level", default="city", choices=["city", "day_text"])
    p.add_argument("--strict", action="store_true", help="dates must be real calendar dates")

    p = sub.add_parser("regions")
    p.add_argument("--places", required=True)
    p.add_argument("--country", default=None)
    p.add_argument("--key", default=None)
    p.add_argument("--out", default=None)
    p.add_argument("--show", action="store_true",
                   help="print a preview of the prepared rows and the predictions, and the matrix's counts")
    p.add_argument("--variant", default="default", choices=["default", "original"])
    p.add_argument("--header", default="first_file", choices=["first_file", "per_file"],
                   help="whose header names the columns, where there are several files")

    args = ap.parse_args(argv)
    if args.job == "lookup":
        if args.requests and not args.out:
            ap.error("lookup --requests needs --out, the table to write the answers to")
        if not args.requests and not (args.phone and args.start and args.end):
            ap.error("lookup needs --phone, --start and --end, or --requests and --out")

    from tracelake.plans import jobs
    from tracelake.session import get_session

    spark = get_session()
    if args.job in ("itineraries", "daily"):
        overrides = {k: getattr(args, k) for k in
                     ("key", "unmatched", "cells_mode", "strip", "dedupe", "header", "mode",
                      "quote_aware")}
        if args.job == "daily":
            overrides["buckets"] = args.buckets
        fn = jobs.build_itineraries if args.job == "itineraries" else jobs.build_daily_itineraries
        fn(spark, args.cells, args.logs, args.out, variant=args.variant,
           cells_table=args.cells_table, **overrides)
        print(json.dumps({"job": args.job, "out": args.out}))
    elif args.job == "cells":
        jobs.build_cell_dimension(spark, args.cells, args.out, args.header, args.mode, args.keep)
        print(json.dumps({"job": "cells", "out": args.out}))
    elif args.job == "clean":
        from tracelake.sources import drop_old_versions
        print(json.dumps({"job": "clean", "removed": drop_old_versions(spark, args.table, args.keep)}))
    elif args.job == "lookup":
        if args.requests:
            jobs.answer_lookups(spark, args.daily, args.requests, args.out, args.level, args.strict)
            print(json.dumps({"job": "lookup", "out": args.out}))
        else:
            from tracelake.operators import validate_requests
            req = spark.createDataFrame([(0, args.phone, args.start, args.end)],
                                        "request_id long, phone string, start string, end string")
            checked = validate_requests(req).first()
            if not checked.valid or (args.strict and not checked.calendar_ok):
                print(json.dumps({"valid": checked.valid, "phone_ok": checked.phone_ok,
                                  "start_ok": checked.start_ok, "end_ok": checked.end_ok,
                                  "calendar_ok": checked.calendar_ok}))
                return 2
            row = jobs.lookup(spark, args.daily, checked.phone, checked.start, checked.end,
                              args.level).first()
            print(json.dumps({"visited": row.visited, "n_visited": row.n_visited,
                              "found": row.found}, ensure_ascii=False))
    else:
        from tracelake import schemas
        res = jobs.train_regions(spark, args.places, country=args.country or schemas.DEFAULT_COUNTRY,
                                 key=args.key, out_dir=args.out, variant=args.variant, header=args.header)
        if args.show:
            res.prepared.select("region", "lng", "lat").show()
            res.predictions.show()
            for row in res.counts.orderBy("label", "prediction").toLocalIterator():
                print(json.dumps(row.asDict()))
        acc = res.accuracy.first()
        print(json.dumps({"accuracy": acc.accuracy, "n": acc.n}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
