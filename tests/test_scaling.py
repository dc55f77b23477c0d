"""Steps that must scale with real tables: size estimates, what is shuffled, what is broadcast, what stays on disk."""

import datetime as dt
import time

from conftest import frame, p, raw
from pyspark.sql import functions as F

from webtrail import queries
from webtrail.operators.sequence import RANGE_BYTES, _num_ranges
from webtrail.plans import common, items
from webtrail.plans import sessions as se
from webtrail.schema import ORDER_FACT_DDL
from webtrail.session import BROADCAST_BYTES, limit_broadcasts
from webtrail.sources import incremental as inc
from webtrail.sources import testbed

BROADCAST = 10 << 20


def _nodes(plan):
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def _compressible(spark, tmp_path):
    """600,000 order ids: about 40 MB as rows, far less as a Parquet file."""
    path = str(tmp_path / "ids")
    spark.range(600_000, numPartitions=1).select(
        F.concat(F.lit("order-of-the-shop-number-"), F.col("id").cast("string")).alias("shopify_order_id")).write.parquet(path)
    return spark.read.parquet(path)


def test_a_compressed_table_is_not_taken_for_a_small_one(spark, tmp_path):
    ids = _compressible(spark, tmp_path)
    size = int(str(ids._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    assert size > BROADCAST
    joined = ids.join(ids.withColumnRenamed("shopify_order_id", "o"), F.col("shopify_order_id") == F.col("o"))
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().sparkPlan().toString()


def test_ranges_follow_the_size_of_rows(spark, tmp_path):
    ids = _compressible(spark, tmp_path)
    many = ids
    for _ in range(5):
        many = many.unionByName(many)  # 32 times the files
    size = 32 * int(str(ids._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    assert _num_ranges(many) == -(-size // RANGE_BYTES) > spark.sparkContext.defaultParallelism


def test_the_feed_is_dealt_by_day_as_narrow_rows(spark):
    raw = testbed.raw_events(spark, "/root/testdata/sf0.001")
    plan = raw._jdf.queryExecution().optimizedPlan()
    found = [n for n in _nodes(plan) if n.nodeName() == "RebalancePartitions"]
    assert len(found) == 1 and found[0].output().size() < 12 < len(raw.columns)
    assert plan.outputOrdering().size() == 1  # a write by day need not sort the wide rows


def test_lines_are_kept_for_orders_that_events_name(spark, tmp_path):
    event = "event_id long, ts timestamp_ntz, event_type string"
    spark.createDataFrame([(1, None, "purchase"), (2, None, "view"), (3, None, None), (None, None, "click")], event
                          ).write.parquet(f"{tmp_path}/events.parquet")
    line = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
            "l_extendedprice double, l_discount double")
    spark.createDataFrame([(1, 9, 1, 2, 3.0, 10.0, 0.5), (1, 8, 1, 1, 3.0, 20.0, 0.0), (2, 8, 1, 1, 1.0, 1.0, 0.0),
                           (4, 8, 1, 1, 1.0, 1.0, 0.0), (None, 8, 1, 1, 1.0, 1.0, 0.0)], line
                          ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(8, "socks", "B1", "PROMO"), (9, "cap", "B1", "X")], "p_partkey long, p_name string, p_brand string, p_type string"
                          ).write.parquet(f"{tmp_path}/part.parquet")
    rows = testbed.lines_by_order(spark, str(tmp_path))
    items = rows.select("item_order", F.transform("lines", testbed.line_item).alias("items")).collect()
    assert [r["item_order"] for r in items] == [1]
    assert [(i["item_id"], i["item_name"], i["item_revenue_in_usd"]) for i in items[0]["items"]] == [
        ("8", "Gift Card socks", 20.0), ("9", "cap", 5.0)]


def test_hot_sessions_are_not_forced_into_the_driver(spark):
    ev = spark.range(4).select(F.lit("2024-01-01").cast("date").alias("event_date"),
                               F.col("id").cast("string").alias("unique_session_id"))
    key = F.struct("event_date", "unique_session_id")
    seen = []
    kept = se._sessions
    se._sessions = lambda rows, together: seen.append(rows) or rows
    try:
        se.all_sessions(ev, ev.filter("unique_session_id < 2").select("event_date", "unique_session_id"))
    finally:
        se._sessions = kept
    assert [sorted(r[1] for r in d.select(key.alias("k")).select("k.*").collect()) for d in seen] == [["2", "3"], ["0", "1"]]
    assert all("broadcast" not in d._jdf.queryExecution().optimizedPlan().toString().lower() for d in seen)


def test_session_final_deals_the_events_once(spark):
    class Tables:
        raw = raw(spark, [{"ts": f"2024-01-01 {10 + i // 2}:{i:02d}:00", "user_pseudo_id": f"u{i % 2}", "event_name": "page_view",
                           "geo_city": "abc"[i // 2], "event_params": [p("ga_session_id", int_=str(i % 2))]} for i in range(6)])

        def orders(self):
            return frame(spark, ORDER_FACT_DDL, [])

    found = queries.session_final(Tables())
    plan = found._jdf.queryExecution().executedPlan().toString()
    dealt = [x for x in plan.splitlines() if "Exchange hashpartitioning(event_date" in x or "Exchange hashpartitioning(__k" in x]
    assert len(dealt) == 1
    ev = se.session_events(Tables.raw, Tables().orders(), queries.TB_DAILY)
    minutes = se.session_rollup(se.session_index(se.attribute_rollup(ev))).select(found.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, minutes.collect()))
    assert found.count() == 6


def _sides(spark, tmp_path, rows):
    """The plan of a join whose one side has ``rows`` rows, which Spark knows once they were shuffled."""
    path = str(tmp_path / f"side{rows}")
    spark.range(rows, numPartitions=2).select(F.sha2(F.col("id").cast("string"), 256).alias("k")).write.parquet(path)
    ids = spark.read.parquet(path)
    joined = ids.join(ids.distinct().withColumnRenamed("k", "o"), F.col("k") == F.col("o"))
    counted = joined.agg(F.count("o"))
    assert counted.collect()[0][0] == rows
    return counted._jdf.queryExecution().executedPlan().toString()


def test_only_small_sides_go_through_the_driver(spark, tmp_path):
    assert "BroadcastHashJoin" in _sides(spark, tmp_path, 1_000)
    assert "BroadcastHashJoin" not in _sides(spark, tmp_path, 40_000)  # some 3 MB, under Spark's own limit


def test_a_lower_limit_of_the_session_stays(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    try:
        spark.conf.unset(name)
        limit_broadcasts(spark)
        assert spark.conf.get(name) == str(BROADCAST_BYTES)
        for given, kept in (("10m", str(BROADCAST_BYTES)), ("256k", "256k"), ("-1", "-1"), ("-1b", "-1b")):
            spark.conf.set(name, given)
            limit_broadcasts(spark)
            assert spark.conf.get(name) == kept
    finally:
        spark.conf.set(name, before)


def test_the_feed_is_read_without_the_lookups(spark, tmp_path):
    event = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame([(i, dt.datetime(2024, 1, 1 + i, 3), 5, "click", 1.0, '{"k": 1}') for i in range(5)], event
                          ).write.parquet(f"{tmp_path}/events.parquet")
    line = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
            "l_extendedprice double, l_discount double")
    spark.createDataFrame([(1, 8, 1, 1, 3.0, 20.0, 0.0)], line).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(8, "socks", "B1", "X", 3)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int"
                          ).write.parquet(f"{tmp_path}/part.parquet")
    tb = testbed.Testbed(spark, str(tmp_path))  # there are no orders and no customers to derive lookups from
    assert [r["normalized_source"] for r in queries.normalize_source(tb).filter("source_value = 'data not available'").collect()]
    assert sorted(r[0] for r in tb.raw.select(F.size("items")).collect()) == [0, 0, 0, 0, 1]
    assert tb.cutoff == dt.date(2024, 1, 2) and tb.daily_feed().count() == 2 and tb.intraday_feed().count() == 4


def test_items_are_numbered_without_the_params(spark, monkeypatch):
    item = {"item_id": "a", "item_params": [p("item_product_id", string="7")]}
    feed = raw(spark, [{"ts": "2024-01-01 10:00:00", "user_pseudo_id": "u", "event_name": n, "event_bundle_sequence_id": 1,
                        "event_params": ps, "items": i} for n, ps, i in (
        ("view_item", [p("ga_session_id", string=" s1 "), p("coupon", string="x"), p("coupon", string=" y ")], [item]),
        ("view_item", [p("ga_session_id", string="s2")], [item]), ("view_item", [], [item]), ("view_item", None, [item]),
        ("scroll", [p("ga_session_id", string="s3")], []))])
    shared = common.number_batch(feed)
    dealt, number = [], common.global_sequence
    monkeypatch.setattr(common, "global_sequence", lambda df, *a: dealt.append(df.columns) or number(df, *a))
    alone = items.item_events(feed, queries.TB_DAILY)
    assert len(dealt) == 1 and "event_params" not in dealt[0]
    wanted = items.item_events(feed, queries.TB_DAILY, shared)
    assert alone.columns == wanted.columns and alone.count() == 2
    assert sorted(map(str, alone.collect())) == sorted(map(str, wanted.collect()))
    assert {(r["ga_session_id"], r["coupon"]) for r in alone.collect()} == {("s1", "y"), ("s2", None)}


def test_order_lines_are_cut_once_for_all_runs(spark):
    class Tables:
        raw = raw(spark, [{"ts": f"2024-01-0{d} 10:00:00", "user_pseudo_id": "u", "event_name": "purchase",
                           "ecommerce_transaction_id": f" {d} "} for d in (1, 2, 3)])
        asked = 0

        def orders(self):
            self.asked += 1
            return frame(spark, ORDER_FACT_DDL, [{"shopify_order_id": str(d), "sale_kind": "ORDER", "country": "US",
                                                  "quantity": d} for d in range(9)])

    tb = Tables()
    tb.spark = spark
    found = queries.incremental_one_day(tb).select("event_date", "total_item_quantity").collect()
    assert sorted((r[0].day, r[1]) for r in found) == [(1, 1), (2, 2), (3, 3)]
    assert tb.asked == 1


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_shuffle_files_go_when_a_table_is_written(spark):
    before = _shuffle_files(spark)
    df = spark.range(1000).selectExpr("date_add(date'2024-01-01', cast(id % 3 as int)) AS event_date", "id % 100 AS k")
    df = df.groupBy("event_date", "k").count()
    path = inc.scratch_target(spark, "released")
    inc.write_days(df, path)
    until = time.time() + 20  # the executors delete them a moment later
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    # what is read again is shuffled again
    assert len(df.collect()) == len(df.collect()) == inc.read_table(spark, path).count() == 300


def _exchanges(spark, df):
    """Output sizes and keys of the shuffles that Spark plans for ``df`` if no side is small."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    kept = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        nodes = _nodes(df.select("*")._jdf.queryExecution().executedPlan())
        return [(n.output().size(), n.outputPartitioning().toString()) for n in nodes if n.nodeName() == "Exchange"]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_purchased_items_meet_their_money_where_they_are(spark):
    g = frame(spark, "shopify_order_id string, __item_key string, quantity int, pos int",
              [("1", "a", 1, 0), ("1", None, 2, 1), (None, "a", 3, 2), (None, None, 4, 3), ("2", "a", 5, 4), ("1", "cap", 6, 5)])
    g = g.groupBy("shopify_order_id", "__item_key").agg(F.max("quantity").alias("quantity"), F.max("pos").alias("pos"))
    line = {"sale_kind": "ORDER", "country": "US", "gift_card_flag": "OTHERS"}
    orders = frame(spark, ORDER_FACT_DDL, [
        {**line, "shopify_order_id": "1", "sku": "a", "quantity": 7}, {**line, "shopify_order_id": "1", "sku": None, "quantity": 8},
        {**line, "shopify_order_id": None, "sku": "a", "quantity": 9},
        {**line, "shopify_order_id": "1", "sku": "x", "title": "CAP", "gift_card_flag": "GIFT CARD", "quantity": 10}])
    ids = frame(spark, "shopify_order_id string", [("1",), ("2",)])
    g = g.withColumns({"s_no": F.col("pos"), "__item_pos": F.lit(0)})
    joined = items.attach_item_money(g, orders, ids)
    assert {r["pos"]: int(r["quantity"]) for r in joined.collect()} == {0: 7, 1: 2, 2: 3, 3: 4, 4: 5, 5: 10}
    assert set(joined.columns) == {*g.columns, "__shp_qty", *items.MONEY}
    apart = len(_exchanges(spark, g)) + len(_exchanges(spark, items.order_item_money(items.orders_in_batch(orders, ids))))
    assert len(_exchanges(spark, joined)) == apart + 1  # the money, by order and item key


def test_session_rows_are_not_dealt_again_for_the_visitor_flag(spark):
    # (user, session id): two users may have one unique session, "x:a:b"
    seen = [("a:b", "x"), ("b", "x:a"), ("new", "1"), ("new", "2"), ("old", "1"), (None, "1"), ("new", None)]
    batch = raw(spark, [{"ts": f"2024-01-0{1 + day} 15:0{i}:00", "user_pseudo_id": u, "event_name": "page_view",
                         "event_params": [p("ga_session_id", int_=sid), p("other", int_="1")]}
                        for day in (0, 1) for i, (u, sid) in enumerate(seen)])
    new = frame(spark, "event_date date, unique_user_id string",
                [(dt.date(2024, 1, 1), u) for u in ("b", "new", None)] + [(dt.date(2024, 1, 2), "old")])
    for hot_rows in (se.HOT_ROWS, 1):
        built = se.build_sessions(batch, frame(spark, ORDER_FACT_DDL, []), new, queries.TB_DAILY, hot_rows=hot_rows)
        found = sorted((r["event_date"].day, r["unique_user_id"] or "", r["unique_session_id"])
                       for r in built.filter("visitor_flag = 'NEW'").collect())
        assert found == [(1, "b", "x:a:b"), (1, "new", "1:new"), (1, "new", "2:new"), (1, "new", "new"), (2, "old", "1:old")]
        assert built.count() == 2 * len(seen)
    built = se.build_sessions(batch, frame(spark, ORDER_FACT_DDL, []), new, queries.TB_DAILY)
    # rows of events are dealt, rows of sessions, with first and last attributes, are not
    sizes = [size for size, _ in _exchanges(spark, built)]
    assert len(se.FIRST_LAST) < max(sizes) < 2 * len(se.FIRST_LAST)


def test_items_of_json_are_built_after_the_order_fact_is_cut(spark, monkeypatch):
    tb, given = testbed.Testbed(spark, "/root/testdata/sf0.001"), []
    build = items.build_items
    monkeypatch.setattr(items, "build_items", lambda feed, orders, *args: given.append(orders) or build(feed, orders, *args))
    assert queries.QUERIES["items_json"](spark, tb.sf_dir).count() > 0
    (cut,) = given
    assert 0 < cut.count() < tb.orders().count()
    assert not set(cut.inputFiles()) & set(tb.orders().inputFiles())


def test_hot_and_other_sessions_read_the_marked_events_from_one_store(spark, monkeypatch):
    ev = spark.range(6).selectExpr("date'2024-01-01' AS event_date", "if(id = 5, null, cast(id as string)) AS unique_session_id")
    seen = {}
    monkeypatch.setattr(se, "_sessions", lambda rows, together: seen.setdefault(together, rows))
    hot = ev.filter("coalesce(unique_session_id, '') IN ('', '1')")
    assert se.all_sessions(ev, hot).columns == ev.columns
    files = [set(rows.inputFiles()) for rows in seen.values()]
    assert files[0] and files[0] == files[1]
    found = {together: sorted(r["unique_session_id"] or "" for r in rows.collect()) for together, rows in seen.items()}
    assert found == {True: ["0", "2", "3", "4"], False: ["", "1"]}
