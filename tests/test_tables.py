"""Table builders on hand-made rows: the traps listed in FIXTURES.md section 2."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import frame, p, raw
from webtrail.functions.rules import ChannelConfig
from webtrail.operators.new_users import new_users
from webtrail.operators.orders import order_money
from webtrail.plans.events import build_events
from webtrail.plans.items import build_items
from webtrail.plans.purchases import build_purchases
from webtrail.plans.sessions import build_sessions
from webtrail.schema import (CUSTOMER_TYPE_DDL, DAILY, INTRADAY, ORDER_FACT_DDL, PRODUCT_DIM_DDL, FeedOptions)

D2 = Decimal("2.00")


def orders(spark, rows):
    full = []
    for r in rows:
        base = dict(shopify_order_id="1", sku="A", title="t", gift_card_flag="OTHERS", quantity=1, gross_sales=D2,
                    gsnd=D2, gross_merchandise_value=D2, shipping_price=D2, total_tax=D2, vat_value=D2,
                    sale_kind="ORDER", country="US")
        base.update(r)
        full.append(tuple(base.values()))
    return frame(spark, ORDER_FACT_DDL, full)


def test_order_money_null_vat_and_unique_items(spark):
    o = orders(spark, [dict(sku="A"), dict(sku="B", vat_value=None), dict(gift_card_flag="GIFT CARD", title="Card"),
                       dict(gift_card_flag="GIFT CARD", title="card"), dict(gift_card_flag=None, sku=None)])
    r = order_money(o).first()
    assert r.unique_items == 4  # A, B, 'card', 'NA'
    assert r.total_tax == Decimal("16.00")  # the null-vat line adds no tax
    assert r.quantity == 5


def _money_events(spark):
    return raw(spark, [
        dict(ts="2024-01-01 10:00:00", event_name=" purchase ", ecommerce_transaction_id=" 12 ", user_pseudo_id="u"),
        dict(ts="2024-01-01 10:01:00", event_name="add_to_cart", ecommerce_transaction_id="12", user_pseudo_id="u"),
        dict(ts="2024-01-01 10:02:00", event_name="purchase", ecommerce_transaction_id="(not set)", user_pseudo_id="u"),
        dict(ts="2024-01-01 10:03:00", event_name="Purchase", ecommerce_transaction_id="12", user_pseudo_id="u"),
        dict(ts="2024-01-01 10:04:00", event_name="x", event_params=[], user_pseudo_id="u"),
    ])


def test_events_purchase_only_join_daily_vs_intraday(spark):
    ev = _money_events(spark)
    o = orders(spark, [dict(shopify_order_id="12")])
    daily = {r.event_bundle_sequence_id: r for r in build_events(ev, o, DAILY).collect()}
    intra = {r.event_bundle_sequence_id: r for r in build_events(ev, o, INTRADAY).collect()}
    assert len(daily) == 4  # the event without params is dropped
    assert daily[0].gross_sales == D2 and daily[0].shopify_order_id == "12"
    assert daily[1].gross_sales is None and intra[1].gross_sales == D2
    assert daily[2].shopify_order_id is None
    assert daily[3].gross_sales is None  # 'Purchase' is not the events table's purchase


def test_purchases_keep_only_lowercase_match(spark):
    pu = build_purchases(_money_events(spark), orders(spark, [dict(shopify_order_id="12")]), DAILY)
    names = sorted(r.shopify_order_id or "-" for r in pu.collect())
    assert names == ["-", "12"]  # 'purchase' with '(not set)' and 'Purchase'; ' purchase ' is not lower()=='purchase'


def test_identity_keys_and_session_id_trim(spark):
    ev = raw(spark, [
        dict(ts="2024-01-01 10:00:00", event_name="e", user_pseudo_id=None, user_id=" u1 ",
             event_params=[p("ga_session_id", " 7")]),
        dict(ts="2024-01-01 10:00:01", event_name="e", user_pseudo_id=None, user_id=None,
             event_params=[p("ga_session_id", "8")]),
        dict(ts="2024-01-01 10:00:02", event_name="e", user_pseudo_id=None, user_id=None, event_params=[p("k", "v")]),
        dict(ts="2024-01-01 10:00:03", event_name="e", user_pseudo_id="p9", event_params=[p("ga_session_id", " 7")]),
    ])
    rows = sorted(build_events(ev, orders(spark, []), DAILY).collect(), key=lambda r: r.s_no)
    assert [(r.unique_user_id, r.unique_session_id, r.ga_session_id) for r in rows] == [
        ("u1", "u1", "7"), (None, "8", "8"), (None, None, None), ("p9", " 7:p9", "7")]


def _session_rows(spark, specs, **kw):
    rows = []
    for i, (ts, name, extra) in enumerate(specs):
        params = [p("ga_session_id", "1"), p("engagement_time_msec", int_=str(extra.pop("eng", 0)))]
        row = dict(ts=ts, event_name=name, user_pseudo_id="u", event_params=params, platform="WEB")
        row.update(extra)
        rows.append(row)
    return raw(spark, rows)


def _sessions(spark, ev, new=None):
    nu = new if new is not None else spark.createDataFrame([], "event_date date, unique_user_id string")
    return sorted(build_sessions(ev, orders(spark, []), nu, DAILY).collect(), key=lambda r: r.session_index)


def test_session_gap_boundaries_and_end_time(spark):
    ev = _session_rows(spark, [
        ("2024-01-01 15:00:59", "page_view", {"platform": "A"}),
        ("2024-01-01 15:31:00", "page_view", {"platform": "B"}),   # 31 boundary minutes later: new session
        ("2024-01-01 16:00:00", "page_view", {"platform": "C"}),
        ("2024-01-01 16:30:59", "page_view", {"platform": "D", "eng": 1500}),  # 30: same session
    ])
    s = _sessions(spark, ev)
    assert [r.session_index for r in s] == [1, 2]
    assert s[1].session_end_timestamp == dt.datetime(2024, 1, 1, 11, 31, 0, 500000)  # local (UTC-5) + 1.5 s
    assert s[1].time_on_site == (59 * 60 + 59) * 1000 + 1500  # 15:31:00 -> 16:30:59 + 1.5 s


def test_equal_attributes_never_split(spark):
    ev = _session_rows(spark, [("2024-01-01 15:00:00", "page_view", {}), ("2024-01-01 18:00:00", "page_view", {})])
    s = _sessions(spark, ev)
    assert len(s) == 1 and s[0].page_view == 2


def test_engaged_threshold(spark):
    a = _sessions(spark, _session_rows(spark, [("2024-01-01 15:00:00", "x", {"eng": 10000})]))
    b = _sessions(spark, _session_rows(spark, [("2024-01-01 15:00:00", "x", {"eng": 10001})]))
    assert a[0].engaged_session_flag == 0 and b[0].engaged_session_flag == 1


def test_first_touch_keeps_null_of_first_event(spark):
    ev = _session_rows(spark, [("2024-01-01 15:00:00", "x", {"geo_city": None}),
                               ("2024-01-01 15:05:00", "x", {"geo_city": "Austin"})])
    s = _sessions(spark, ev)
    assert s[0].first_event_geo_city is None and s[0].last_event_geo_city == "Austin"


def test_visitor_flag(spark):
    ev = _session_rows(spark, [("2024-01-01 15:00:00", "x", {})])
    nu = spark.createDataFrame([(dt.date(2024, 1, 1), "u")], "event_date date, unique_user_id string")
    assert _sessions(spark, ev, nu)[0].visitor_flag == "NEW"
    assert _sessions(spark, ev)[0].visitor_flag == "RETURNING"


def test_new_user_lookback_and_return_buyer(spark):
    d = dt.date(2024, 2, 10)
    rows = [(d, "first_visit", u) for u in ("a", "b", "c", "d", "e", "r")]
    rows += [(d - dt.timedelta(days=32), "page_view", "a"), (d - dt.timedelta(days=31), "page_view", "b"),
             (d - dt.timedelta(days=1), "page_view", "c"), (d, "page_view", "d"),
             (d - dt.timedelta(days=5), None, "e")]
    ev = spark.createDataFrame(rows, "event_date date, event_name string, unique_user_id string")
    pu = spark.createDataFrame([(d, "r", "o1"), (d - dt.timedelta(days=1), "a", "o2")],
                               "event_date date, unique_user_id string, shopify_order_id string")
    ct = frame(spark, CUSTOMER_TYPE_DDL, [("o1", "RETURN"), ("o2", "RETURN")])
    got = sorted(r.unique_user_id for r in new_users(ev, [ev], pu, ct, dt.date(1900, 1, 1)).collect())
    assert got == ["a", "d", "e"]  # 31 and 1 day before count; a nameless event does not; same-day RETURN buyer out


def _item(item_id, name="Tee", variant=None, list_name=None, price=10.0, revenue=10.0, params=None):
    return dict(item_brand="B", item_category="C", item_id=item_id, item_list_name=list_name, item_name=name,
                quantity=Decimal(1), price_in_usd=price, item_params=params, item_variant=variant,
                item_revenue_in_usd=revenue)


def _dim(spark, rows):
    return frame(spark, PRODUCT_DIM_DDL, rows)


def test_items_branches(spark):
    two = [p("item_product_id", "P"), p("item_variant_id", int_="9")]
    ev = raw(spark, [
        dict(ts="2024-01-01 15:00:00", event_name="view_item", user_pseudo_id="u",
             items=[_item("1", params=two, variant="A / B"), _item("1", params=two, variant="A / B"),
                    _item("2", params=[], variant="x")]),
        dict(ts="2024-01-01 15:01:00", event_name="purchase", user_pseudo_id="u", ecommerce_transaction_id="o1",
             items=[_item("3", params=[p("item_product_id", "P3")]), _item("4", params=two),
                    _item("5", params=two + [p("item_list_position", int_="1")]),
                    _item("6", name="Women Gift card", params=two)]),
        dict(ts="2024-01-01 15:02:00", event_name="view_item_list", user_pseudo_id="u",
             items=[_item("7", list_name="(not set)"), _item("8", list_name=" Home ")]),
    ])
    dim = _dim(spark, [("1", "d", "c", "s", "Tops", "pp", "FEMALE", "APPAREL", "A"),
                       ("4", "d", "c", "s", None, "pp", "MALE", "APPAREL", "M")])
    o = orders(spark, [dict(shopify_order_id="o1", sku="4", quantity=3)])
    opts = FeedOptions(list_view_brand="HOUSE")
    rows = build_items(ev, o, dim, opts).collect()
    browse = [r for r in rows if r.event_name == "view_item"]
    assert len(browse) == 1  # equal items collapse; the item without params drops
    assert (browse[0].color, browse[0].size) == ("B", "A")  # colour A is a known size: swapped
    pur = {r.item_id: r for r in rows if r.event_name == "purchase"}
    assert pur["3"].item_revenue_in_usd == 5.0 and pur["4"].item_revenue_in_usd == 10.0
    assert pur["5"].item_revenue_in_usd == 15.0
    assert pur["4"].quantity == 3 and pur["4"].total_tax == Decimal("4.00")
    assert pur["6"].gender == "UNISEX"
    lv = [r for r in rows if r.event_name == "view_item_list"]
    assert len(lv) == 1 and lv[0].item_list_name == "Home" and lv[0].item_brand == "HOUSE"


def test_session_index_of_a_hot_group(spark):
    """Sessions are numbered as by one pass over each group; two thirds of all rows have no ids."""
    import random
    from webtrail.plans.sessions import session_gaps, session_index
    rnd = random.Random(7)
    rows = []
    base = dt.datetime(2024, 1, 1, 0, 0)
    for i in range(900):
        hot = i % 3 != 0
        sid, uid = (None, None) if hot else (f"s{i % 7}", f"u{i % 5}")
        minutes = rnd.choice([0, 1, 5, 29, 30, 31, 32, 45, 90]) * (i // 9)
        ts = None if i % 97 == 0 else base + dt.timedelta(minutes=minutes % 1440, seconds=rnd.randint(0, 59))
        rows.append((dt.date(2024, 1, 1 + i % 2), sid, uid, ts, i))
    combos = spark.createDataFrame(rows, "event_date date, unique_session_id string, unique_user_id string, "
                                         "event_timestamp timestamp_ntz, s_no long").repartition(5)
    want, last = {}, {}
    for r in sorted(rows, key=lambda r: (r[3] is not None, r[3] or base, r[4])):
        before, index = last.get(r[:3], (None, 0))
        boundaries = None if before is None else (r[3].replace(second=0) - before.replace(second=0)).total_seconds() // 60
        index += before is None or boundaries > 30
        want[r[4]] = (index, before)
        last[r[:3]] = (r[3], index)
    got = {r.s_no: r.session_index for r in session_index(combos).collect()}
    assert got == {k: v[0] for k, v in want.items()}
    gaps = session_gaps(combos)
    assert gaps.columns == combos.columns + ["previous_timestamp", "newsession"]
    assert {r.s_no: r.previous_timestamp for r in gaps.collect()} == {k: v[1] for k, v in want.items()}


def test_a_hot_product_and_colour_are_split(spark):
    """Without broadcasts AQE splits the rows of one product and one colour; null keys spread."""
    from pyspark.sql import functions as F
    from webtrail.plans import items as it
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 60000, 1, 8).select(
            F.col("id").alias("s_no"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")
                                                                                ).alias("__item_id_raw"),
            F.concat(F.lit("n"), "id").alias("__item_name_raw"))
        dim = spark.createDataFrame([("hot", "A", "X"), ("1", None, None)],
                                    "externalid string, division string, gender string").select(
            "*", *[F.lit(None).cast("string").alias(c) for c in it.DIM_COLUMNS if c != "division"],
            F.lit(None).cast("string").alias("strategic_business_unit"))
        out = it._product(rows, dim)
        got = out.collect()
        assert len(got) == 60000 and sum(r.division == "A" for r in got) == 20000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()  # in several tasks
        colours = rows.select("s_no", F.col("__item_id_raw").alias("color"), F.lit("s").alias("size"),
                              F.lit("i").alias("item_id"), F.lit("v").alias("item_variant"))
        sizes = spark.createDataFrame([("hot",), (None,)], "product_size string")
        swapped = it.swap_color_size(colours, sizes)
        got = swapped.collect()
        assert len(got) == 60000 and sum((r.size, r.color) == ("hot", "s") for r in got) == 20000
        assert "skew=true" in swapped._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_sessions_are_found_and_built_like_the_others(spark):
    from webtrail.plans.common import number_batch
    from webtrail.plans.sessions import RAW_COLUMNS, hot_sessions
    rows = [("2024-01-01 %02d:%02d:00" % (8 + i // 50, i % 50), "page_view", {"sid": "1"}) for i in range(120)]
    ev = _session_rows(spark, rows)
    numbered = number_batch(ev.select(*RAW_COLUMNS))
    assert hot_sessions(numbered, 1000) is None
    assert hot_sessions(numbered, 100).count() == 1
    nu = spark.createDataFrame([], "event_date date, unique_user_id string")
    args = (ev, orders(spark, []), nu, DAILY)
    cold, hot = (sorted(map(repr, build_sessions(*args, hot_rows=n).collect())) for n in (1000, 100))
    assert cold == hot and len(cold) >= 1
