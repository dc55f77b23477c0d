"""Print the shuffle structure of each table build: every Exchange of the physical
plan (before AQE re-planning) and the scans' partition filters and read schemas.

usage: python tools/plan_shapes.py [sf_dir]
"""

from __future__ import annotations

import sys

sys.path.insert(0, "/root/repo")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from webtrail.plans.events import build_events
    from webtrail.plans.items import build_items
    from webtrail.plans.purchases import build_purchases
    from webtrail.plans.sessions import build_sessions
    from webtrail.queries import TB_DAILY
    from webtrail.session import local_session
    from webtrail.sources.testbed import Testbed

    spark = local_session()
    tb = Testbed(spark, sf_dir)
    no_new = spark.createDataFrame([], "event_date date, unique_user_id string")
    builds = {
        "events": build_events(tb.raw, tb.orders(), TB_DAILY),
        "purchases": build_purchases(tb.raw, tb.orders(), TB_DAILY),
        "items": build_items(tb.raw, tb.orders(), tb.products(), TB_DAILY),
        "sessions": build_sessions(tb.raw, tb.orders(), no_new, TB_DAILY),
    }
    for name, df in builds.items():
        plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
        ex = [line.strip(" :+-") for line in plan if "Exchange" in line]
        scans = [line.strip(" :+-") for line in plan if "FileScan" in line or "Scan ExistingRDD" in line]
        print(f"== {name}: {len(ex)} exchanges")
        for line in ex:
            print("   ", line[:150])
        for line in scans:
            print("   scan:", line[:220])


if __name__ == "__main__":
    main()
