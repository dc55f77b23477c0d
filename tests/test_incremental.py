"""Day-keyed incremental runs: empty target, idempotent re-run, newest day removed
even when the source lost it, schema sync."""

import datetime as dt

from pyspark.sql import functions as F

from webtrail.sources import incremental as inc


def _feed(spark, days):
    rows = [(dt.date(2024, 1, d), f"e{d}-{i}") for d in days for i in range(d)]
    return spark.createDataFrame(rows, "event_date date, id string")


def _build(batch):
    return batch.withColumn("n", F.length("id"))


def _days(spark, path):
    return sorted((r.event_date.day, r.c) for r in
                  inc.read_table(spark, path).groupBy("event_date").agg(F.count("*").alias("c")).collect())


def test_first_run_rerun_and_lost_day(spark):
    path = inc.scratch_target(spark, "t")
    assert not inc.table_exists(spark, path) and inc.high_water_mark(spark, path) == inc.NO_MARK
    mark = inc.run_daily(spark, _feed(spark, [1, 2, 3]), _build, path)
    assert mark == inc.NO_MARK and _days(spark, path) == [(1, 1), (2, 2), (3, 3)]
    inc.run_daily(spark, _feed(spark, [1, 2, 3]), _build, path)  # re-run: same rows
    assert _days(spark, path) == [(1, 1), (2, 2), (3, 3)]
    inc.run_daily(spark, _feed(spark, [1, 2, 4]), _build, path)  # day 3 vanished from the source
    assert _days(spark, path) == [(1, 1), (2, 2), (4, 4)]


def test_schema_sync_adds_and_drops_columns(spark):
    path = inc.scratch_target(spark, "s")
    old = _feed(spark, [1, 2]).withColumn("legacy", F.lit(1))
    inc.write_days(old, path)
    new_schema = _build(_feed(spark, [1])).schema
    assert inc.sync_schema(spark, path, new_schema)
    t = inc.read_table(spark, path)
    assert set(t.columns) == {"event_date", "id", "n"} and t.filter(F.col("n").isNotNull()).count() == 0


def _files(path):
    import glob
    import os
    base = path.removeprefix("file:")
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{base}/event_date=*/*")}


def test_one_day_tables_and_empty_batches(spark):
    path = inc.scratch_target(spark, "one")
    inc.run_daily(spark, _feed(spark, [1]), _build, path)
    assert _days(spark, path) == [(1, 1)]
    inc.run_daily(spark, _feed(spark, [1, 2]), _build, path)  # the only stored day is dropped first
    assert _days(spark, path) == [(1, 1), (2, 2)]
    inc.run_daily(spark, _feed(spark, [1]), _build, path)  # day 2 lost; nothing new past day 1
    assert _days(spark, path) == [(1, 1)]
    empty = inc.scratch_target(spark, "none")
    inc.run_daily(spark, _feed(spark, []), _build, empty)
    assert not inc.table_exists(spark, empty) and inc.read_table(spark, empty).count() == 0
    assert inc.high_water_mark(spark, empty) == inc.NO_MARK
    inc.run_daily(spark, _feed(spark, [3]), _build, empty)
    assert _days(spark, empty) == [(3, 3)]


def test_schema_sync_touches_no_data_and_survives_a_stop(spark):
    path = inc.scratch_target(spark, "m")
    inc.run_daily(spark, _feed(spark, [1, 2]).withColumn("legacy", F.lit(1)), lambda b: b, path)
    before = _files(path)
    target = _build(_feed(spark, [1])).schema
    # a run that stopped while it wrote the schema: its temporary file is no version
    fs, p = inc._fs(spark, f"{path}/_schema/.stopped")
    fs.create(p).close()
    assert "legacy" in inc.read_table(spark, path).columns
    assert inc.sync_schema(spark, path, target) and not inc.sync_schema(spark, path, target)
    assert _files(path) == before
    t = inc.read_table(spark, path)
    assert set(t.columns) == {"event_date", "id", "n"} and t.count() == 3
    inc.run_daily(spark, _feed(spark, [1, 2, 3]), _build, path)
    assert {r.n for r in inc.read_table(spark, path).filter("event_date >= '2024-01-02'").collect()} == {4}


def test_days_become_few_files(spark):
    path = inc.scratch_target(spark, "files")
    inc.write_days(spark.range(0, 3000, 1, 24).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 10).cast("int")).alias("event_date"), "id"), path)
    assert len([f for f in _files(path) if f.endswith(".parquet")]) <= 20


def test_runner_from_one_day_and_without_purchases(spark):
    """All four tables: a first day without purchases, then days 1-2; nothing staged is left."""
    import os
    from webtrail.plans.runner import run_daily_tables, scratch_tables
    from webtrail.queries import TB_DAILY
    from webtrail.session import shared_dir
    from webtrail.sources.testbed import Testbed

    tb = Testbed(spark, "/root/testdata/sf0.001")
    days = sorted(r[0] for r in tb.raw.select("event_date").distinct().collect())
    feed = lambda n, keep=F.lit(True): tb.raw.filter((F.col("event_date") <= F.lit(days[n - 1])) & keep)
    args = (tb.orders(), tb.customer_types(), tb.products())
    tables = scratch_tables(spark, "one")
    no_purchase = ~F.coalesce(F.lower(F.trim("event_name")) == "purchase", F.lit(False))
    run_daily_tables(spark, feed(1, no_purchase), *args, tables, TB_DAILY)
    assert inc.read_table(spark, tables.purchases).count() == 0 and inc.read_table(spark, tables.events).count() > 0
    run_daily_tables(spark, feed(2), *args, tables, TB_DAILY)
    for name in ("events", "purchases", "items", "sessions"):
        assert inc.stored_days(spark, getattr(tables, name)) == days[:2]
    base = shared_dir(spark, "webtrail-staged").removeprefix("file:")
    assert not {f for f in os.listdir(base)} - {spark.sparkContext.applicationId}


def test_look_back_reads_a_static_range_of_days(spark):
    from webtrail.operators.new_users import new_users
    path = inc.scratch_target(spark, "acts")
    ev = spark.sql("""SELECT date_add(date'2024-01-01', cast(id % 90 as int)) AS event_date,
                      if(id % 7 = 0, 'first_visit', 'page_view') AS event_name,
                      if(id % 50 = 0, null, cast(id % 40 as string)) AS unique_user_id FROM range(2000)""")
    inc.write_days(ev, path)
    t = inc.read_table(spark, path)
    pu = spark.createDataFrame([], "event_date date, unique_user_id string, shopify_order_id string")
    ct = spark.createDataFrame([], "shopify_order_id string, customer_type string")
    mark = dt.date(2024, 3, 20)
    out = new_users(t, [t], pu, ct, mark)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "2024-02-18" in plan or "19771" in plan  # mark - 31 as a partition filter
    rows = {(r.event_date, r.unique_user_id) for r in out.collect()}
    assert any(u is None for _, u in rows)
    strict = {(r.event_date, r.unique_user_id) for r in new_users(t, [t], pu, ct, mark, keep_null_user=False).collect()}
    assert strict == {r for r in rows if r[1] is not None}


def test_daily_runner_shares_numbering_and_matches_builders(spark):
    """The runner's tables (one shared numbering) equal the stand-alone builders'."""
    import __spark_entry__ as E
    from webtrail.plans.runner import run_daily_tables, run_intraday_tables, scratch_tables
    from webtrail.present import present
    from webtrail.queries import TB_DAILY, TB_INTRADAY
    from webtrail.sources.testbed import Testbed

    sf = "/root/testdata/sf0.001"
    tb = Testbed(spark, sf)
    daily = scratch_tables(spark, "d")
    run_daily_tables(spark, tb.raw, tb.orders(), tb.customer_types(), tb.products(), daily, TB_DAILY)
    q = E.queries()
    for name, key in (("sessions", "sessions_full"), ("items", "items_union"), ("events", "events_wide")):
        stored = inc.read_table(spark, getattr(daily, name))
        want = q[key](spark, sf)
        got = present(stored.select(*want.columns))
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, name
    # intraday tails past the daily marks are empty when the daily run covered every day
    tail = scratch_tables(spark, "t")
    run_intraday_tables(spark, tb.intraday_feed(), tb.orders(), tb.customer_types(), tb.products(), daily, tail,
                        TB_INTRADAY)
    assert inc.read_table(spark, tail.events).count() == 0


def test_mark_from_listing_equals_max_over_data(spark):
    path = inc.scratch_target(spark, "m")
    inc.write_days(_feed(spark, [3, 5, 9]), path)
    assert inc.high_water_mark(spark, path) == dt.date(2024, 1, 9)
    assert inc.high_water_mark_df(inc.read_table(spark, path)).first()[0] == dt.date(2024, 1, 9)
    assert inc.stored_days(spark, path) == [dt.date(2024, 1, d) for d in (3, 5, 9)]
