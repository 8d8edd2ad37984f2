"""Print the physical plans of the headline queries (for PLANS.md).

    python scripts/show_plans.py [--sf /root/testdata/sf0.1] > /tmp/plans.txt
"""

from __future__ import annotations

import argparse
import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

NAMES = ["itineraries", "itineraries_left", "daily_itineraries", "lookup_batch"]


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = buf.getvalue()
    # Keep operator names and keys; drop expression ids and long scan details.
    text = re.sub(r"#\d+L?", "", text)
    text = re.sub(r", \[plan_id=\d+\]", "", text)
    text = re.sub(r"(FileScan parquet \[[^\]]*\]).*?(PushedFilters: \[[^\]]*\])?, ReadSchema: (struct<[^>]*>)",
                  r"\1 \2 ReadSchema: \3", text)
    return "\n".join(line[:160] for line in text.splitlines())


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    args = ap.parse_args()
    from tracelake.operators import daily_itineraries, itineraries, lookup_by_range
    from tracelake.plans import fixtures as fx
    from tracelake.plans.catalog import QUERIES
    from tracelake.session import local_session
    from tracelake.sources import fresh_path, read_table, replace_table

    spark = local_session(8, 16)
    # Mimic a large cluster input: the tiny fixture tables (nation,
    # supplier) stay below Spark's automatic broadcast threshold, the fact
    # tables (lineitem, orders, events) do not.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "512k")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "512k")
    for name in NAMES:
        print(f"### {name}\n\n```")
        print(plan_text(QUERIES[name](spark, args.sf)))
        print("```\n")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    print("### itineraries, directory above the broadcast limit\n\n```")
    print(plan_text(itineraries(fx.trace_logs(spark, args.sf), fx.towers(spark, args.sf))))
    print("```\n")
    path = fresh_path(spark, "daily")
    daily = daily_itineraries(fx.event_logs(spark, args.sf), fx.towers(spark, args.sf), with_cities=True)
    replace_table(daily, path, ["phone", "day"], buckets=16)
    print("### lookup_stored_batch, requests above the broadcast limit\n\n```")
    print(plan_text(lookup_by_range(read_table(spark, path), fx.requests(spark, args.sf))))
    print("```\n\n### confusion_matrix\n\n```")
    print(plan_text(QUERIES["confusion_matrix"](spark, args.sf)))
    print("```")
    spark.stop()


if __name__ == "__main__":
    main()
