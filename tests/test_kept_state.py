"""Stored activity days, rebuilt tail days, the type check of a schema sync, the dimension's guard and the
bounds of the order scan."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webtrail.operators.new_users import new_users, user_days
from webtrail.operators.orders import id_bounds, orders_in_batch
from webtrail.plans import runner
from webtrail.plans.items import unique_products
from webtrail.plans.runner import keep_activity, run_daily_tables, scratch_tables
from webtrail.queries import TB_DAILY, TB_INTRADAY
from webtrail.sources import incremental as inc
from webtrail.sources.testbed import Testbed
from webtrail.streaming import intraday as stream

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_kept_activity_days_follow_the_events_table(spark):
    ev = spark.sql("""SELECT date_add(date'2024-01-01', cast(id % 60 as int)) AS event_date,
                      if(id % 7 = 0, 'first_visit', if(id % 11 = 0, null, 'page_view')) AS event_name,
                      if(id % 50 = 0, null, cast(id % 40 as string)) AS unique_user_id FROM range(2000)""")
    path = inc.scratch_target(spark, "kept")
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    keep_activity(spark, ev.filter(F.col("event_date") <= F.lit(day(30))), path, inc.NO_MARK)
    # the newest day was dropped and comes back with other rows
    changed = ev.filter((F.col("event_date") != F.lit(day(30))) | (F.col("unique_user_id") != "5"))
    keep_activity(spark, changed, path, day(29))
    kept = inc.read_table(spark, path)
    assert _rows(kept.select("event_date", "unique_user_id")) == _rows(user_days(changed))
    pu = spark.createDataFrame([], "event_date date, unique_user_id string, shopify_order_id string")
    ct = spark.createDataFrame([], "shopify_order_id string, customer_type string")
    mark = day(20)
    want = new_users(changed, [changed], pu, ct, mark)
    got = new_users(changed, [], pu, ct, mark, stored_activity=[kept])
    assert _rows(got) == _rows(want) and want.count() > 0
    assert "2024-01-21" in (plan := got._jdf.queryExecution().executedPlan().toString()) or "PartitionFilters" in plan


def test_runner_with_kept_activity_gives_the_same_sessions(spark):
    tb = Testbed(spark, SF)
    days = sorted(r[0] for r in tb.raw.select("event_date").distinct().collect())
    args = (tb.orders(), tb.customer_types(), tb.products())
    sessions = []
    for activity in (False, True):
        tables = scratch_tables(spark, "act", activity)
        for n in (len(days) // 2, len(days)):
            run_daily_tables(spark, tb.raw.filter(F.col("event_date") <= F.lit(days[n - 1])), *args, tables, TB_DAILY)
        sessions.append(_rows(inc.read_table(spark, tables.sessions)))
    assert sessions[0] == sessions[1]
    assert inc.stored_days(spark, tables.activity) == inc.stored_days(spark, tables.events)


def _files(path):
    import glob
    import os
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path.removeprefix('file:')}/event_date=*/*.parquet")}


def test_a_refresh_rebuilds_only_touched_days(spark):
    tb = Testbed(spark, SF)
    daily, tail = scratch_tables(spark, "d"), scratch_tables(spark, "t")
    base = inc.scratch_target(spark, "touch")
    args = (f"{base}/landing", tb.raw.schema, f"{base}/raw", f"{base}/_ckpt", tb.orders(), tb.customer_types(),
            tb.products(), daily, tail, TB_INTRADAY)
    run_daily_tables(spark, tb.daily_feed(), tb.orders(), tb.customer_types(), tb.products(), daily, TB_DAILY)
    mark = inc.high_water_mark(spark, daily.events)
    feed = tb.intraday_feed()
    late = (F.col("event_date") == feed.agg(F.max("event_date")).first()[0]) & (F.col("event_bundle_sequence_id") % 2 == 0)
    feed.filter(~F.coalesce(late, F.lit(False))).coalesce(1).write.mode("append").parquet(f"{base}/landing")
    stream.refresh_tails(spark, *args)
    assert inc.stored_days(spark, f"{base}/raw", nested=True)[0] > mark  # settled raw days are gone
    before = _files(tail.events)
    stream.refresh_tails(spark, *args)  # nothing new
    assert _files(tail.events) == before
    feed.filter(late).coalesce(1).write.mode("append").parquet(f"{base}/landing")
    stream.refresh_tails(spark, *args)
    after = _files(tail.events)
    newest = max(inc.stored_days(spark, tail.events)).isoformat()
    assert {f: t for f, t in after.items() if newest not in f} == {f: t for f, t in before.items() if newest not in f}
    assert {f for f in after if newest in f}.isdisjoint(before)
    past = feed.filter(F.col("event_date") > F.lit(mark))
    assert inc.read_table(spark, tail.events).count() == past.filter(F.size("event_params") > 0).count()
    # a daily run over everything moves the marks: the tail becomes empty
    run_daily_tables(spark, tb.raw, tb.orders(), tb.customer_types(), tb.products(), daily, TB_DAILY)
    stream.refresh_tails(spark, *args)
    assert all(inc.stored_days(spark, p) == [] for p in tail.as_dict().values())


@pytest.mark.parametrize("old,new", [("int", "bigint"), ("int", "double"), ("float", "double"), ("decimal(10,2)", "decimal(14,4)"),
                                     ("int", "decimal(12,1)"), ("date", "timestamp_ntz"), ("smallint", "int")])
def test_widened_columns_read_old_files(spark, old, new):
    assert inc.readable_as(*[T._parse_datatype_string(t) for t in (old, new)])
    path = inc.scratch_target(spark, "wide")
    one = "date'2024-02-03'" if old == "date" else "7"
    frame = lambda day, kind: spark.sql(f"SELECT date'2024-01-0{day}' AS event_date, cast({one} AS {kind}) AS v")
    inc.run_daily(spark, frame(1, old).union(frame(2, old)), lambda b: b, path)
    inc.run_daily(spark, frame(2, new).union(frame(3, new)), lambda b: b, path)
    got = inc.read_table(spark, path)
    assert got.schema["v"].dataType.simpleString() == new
    assert got.select("v").distinct().count() == 1 and got.count() == 3


@pytest.mark.parametrize("old,new", [("bigint", "int"), ("string", "bigint"), ("double", "float"), ("decimal(14,4)", "decimal(10,2)"),
                                     ("bigint", "double"), ("bigint", "string")])
def test_other_changes_of_type_are_refused_before_anything_is_stored(spark, old, new):
    path = inc.scratch_target(spark, "narrow")
    frame = lambda kind: spark.sql(f"SELECT explode(array(date'2024-01-01', date'2024-01-02')) AS event_date, cast(7 AS {kind}) AS v, 1 AS k")
    inc.run_daily(spark, frame(old), lambda b: b, path)
    with pytest.raises(TypeError, match="column v"):
        inc.sync_schema(spark, path, frame(new).schema)
    assert inc.stored_schema(spark, path)["v"].dataType.simpleString() == old
    # dropped and then added again with another type: the old files still hold it
    assert inc.sync_schema(spark, path, frame(old).drop("v").schema)
    with pytest.raises(TypeError, match="column v"):
        inc.sync_schema(spark, path, frame(new).schema)


def test_a_repeated_product_fails_the_run(spark):
    tb = Testbed(spark, SF)
    assert _rows(unique_products(tb.products())) == _rows(tb.products().filter("externalid is not null").select(
        *unique_products(tb.products()).columns))
    twice = tb.products().filter("externalid is not null").limit(1)
    with pytest.raises(PySparkException, match="is not unique"):
        unique_products(tb.products().unionByName(twice)).collect()
    none = twice.withColumn("externalid", F.lit(None).cast("string"))
    assert unique_products(tb.products().unionByName(none).unionByName(none)).count() == unique_products(tb.products()).count()


def test_bounds_of_the_batch_reach_the_order_scan(spark):
    tb = Testbed(spark, SF)
    path = inc.scratch_target(spark, "orders")
    tb.orders().write.parquet(path)
    orders = spark.read.parquet(path)
    some = [r[0] for r in orders.select("shopify_order_id").distinct().orderBy("shopify_order_id").limit(9).collect()]
    ids = spark.createDataFrame([(x,) for x in some[2:5]], "shopify_order_id string")
    got = orders_in_batch(orders, ids, id_bounds(ids))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = got._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert f"GreaterThanOrEqual(shopify_order_id,{some[2]})" in plan and f"LessThanOrEqual(shopify_order_id,{some[4]})" in plan
    assert _rows(got) == _rows(orders_in_batch(orders, ids)) and got.count() > 0
    empty = ids.limit(0)
    assert orders_in_batch(orders, empty, id_bounds(empty)).count() == 0


def test_a_run_of_the_tails_cuts_the_order_fact_once(spark, monkeypatch):
    tb, tails, read = Testbed(spark, SF), scratch_tables(spark, "cut-tail"), {}
    daily = scratch_tables(spark, "cut-daily")
    facts = (tb.orders(), tb.customer_types(), tb.products())
    run_daily_tables(spark, tb.daily_feed(), *facts, daily, TB_DAILY)

    def recorded(name):
        build = getattr(runner, name)

        def call(feed, orders, *args):
            read[name] = (set(orders.inputFiles()), orders.count())
            return build(feed, orders, *args)
        monkeypatch.setattr(runner, name, call)

    for name in ("build_events", "build_purchases", "build_items", "build_sessions"):
        recorded(name)
    for days in (None, [tb.cutoff + dt.timedelta(days=2)]):
        read.clear()
        runner.run_intraday_tables(spark, tb.intraday_feed(), *facts, daily, tails, TB_INTRADAY, days)
        assert len(read) == 4 and len({n for _, n in read.values()}) == 1
        assert not any(files & set(facts[0].inputFiles()) for files, _ in read.values())
