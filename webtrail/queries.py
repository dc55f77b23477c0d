"""Query registry: one callable per operator of the survey, over the driver tables.

Each callable takes ``(spark, sf_dir)`` and returns a presented DataFrame (see
:mod:`webtrail.present`).  Daily builders run over the whole adapted event table
as a first run (no stored days).  Intraday builders run over the provisional
feed against daily tables built from the settled days.  Every query reads the
driver tables; none runs on made-up input.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webtrail.functions import rules, sqlfuncs
from webtrail.functions.params import has_params, param, param_value
from webtrail.functions.params import parse_params_json as parse_json_params
from webtrail.functions.rules import ChannelConfig
from webtrail.functions.scalars import blank_to_null, lower_trim
from webtrail.functions.scalars import variant_color_size as split_variant
from webtrail.functions.timeops import to_local
from webtrail.operators import new_users as nu
from webtrail.operators.orders import batch_order_ids, id_bounds, orders_in_batch
from webtrail.operators.sequence import staged
from webtrail.plans import items as it
from webtrail.plans import sessions as se
from webtrail.plans.common import batch_money, number_batch
from webtrail.plans.events import EVENTS_COLUMNS, TRAFFIC_OUT, build_events, cleaned_events
from webtrail.plans.events import RAW_COLUMNS as EVENTS_RAW
from webtrail.plans.purchases import build_purchases
from webtrail.present import present
from webtrail.schema import (CT, DAILY, EVENT_PARAM_KEYS, INTRADAY, ITEM_PARAM_KEYS, LC, SESSION_COUNTERS)
from webtrail.sources import incremental as inc
from webtrail.sources.testbed import TESTBED_LIST_BRAND, TESTBED_PARTNERSHIP, Testbed
from webtrail.streaming import intraday as stream

TB_CHANNELS = ChannelConfig(partnership_campaigns=TESTBED_PARTNERSHIP)
TB_DAILY = replace(DAILY, channels=TB_CHANNELS, list_view_brand=TESTBED_LIST_BRAND)
TB_INTRADAY = replace(INTRADAY, channels=TB_CHANNELS, list_view_brand=TESTBED_LIST_BRAND)
NO_MARK = inc.NO_MARK
# what events and sessions read of a batch that is numbered for both (items are the widest column, and neither reads them)
SESSION_BATCH = list(dict.fromkeys(EVENTS_RAW + se.RAW_COLUMNS))

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = lambda spark, sf_dir, _fn=fn: present(_fn(Testbed(spark, sf_dir)))
    return fn


# ---------------------------------------------------------------------------
# shared pieces
# ---------------------------------------------------------------------------

def _events(tb: Testbed) -> DataFrame:
    return build_events(tb.raw, tb.orders(), TB_DAILY)


def _purchases(tb: Testbed) -> DataFrame:
    return build_purchases(tb.raw, tb.orders(), TB_DAILY)


def _new_users(tb: Testbed, numbered: DataFrame | None = None) -> DataFrame:
    ev = build_events(tb.raw, tb.orders(), TB_DAILY, numbered)
    return nu.new_users(ev, [ev], _purchases(tb), tb.customer_types(), NO_MARK)


def _sessions(tb: Testbed) -> DataFrame:
    """Sessions of a first daily run; the events table it reads shares the batch numbering."""
    numbered = number_batch(tb.raw.select(*SESSION_BATCH))
    return se.build_sessions(tb.raw, tb.orders(), _new_users(tb, numbered), TB_DAILY, numbered)


def _session_events(tb: Testbed) -> DataFrame:
    return se.session_events(tb.raw, tb.orders(), TB_DAILY)


def _combos(tb: Testbed) -> DataFrame:
    return se.attribute_rollup(_session_events(tb)).drop("end_event")


def _feed_orders(tb: Testbed) -> DataFrame:
    """The order lines of the whole feed, cut from the order fact and stored."""
    ids = staged(batch_order_ids(tb.raw))
    return staged(orders_in_batch(tb.orders(), ids, id_bounds(ids)))


def _item_events(tb: Testbed) -> DataFrame:
    return it.item_events(tb.raw, TB_DAILY)


def _raw_scalars(df: DataFrame) -> DataFrame:
    return df.select("event_date", F.col("event_timestamp").alias("raw_event_micros"), "event_name",
                     "event_bundle_sequence_id", "user_id", "user_pseudo_id", "ecommerce_transaction_id",
                     F.size("event_params").alias("n_params"), F.size("items").alias("n_items"))


SES_KEYS = ["event_date", "unique_session_id", "unique_user_id", "session_index"]


_JSON_FEEDS: dict = {}


def _json_feed(tb: Testbed) -> DataFrame:
    """The raw feed as an export that holds params and items as JSON text, stored once per
    application; the params of every 37th event are damaged text."""
    key = (tb.spark.sparkContext.applicationId, tb.sf_dir)
    if key not in _JSON_FEEDS:
        path = inc.scratch_target(tb.spark, "json-feed")
        text = F.to_json("event_params")
        bad = F.col("event_bundle_sequence_id") % 37 == 0
        tb.raw.withColumns({"event_params": F.when(bad, F.concat(F.lit("{damaged"), text)).otherwise(text),
                            "items": F.to_json("items")}).write.parquet(path)
        _JSON_FEEDS[key] = path
    return tb.spark.read.parquet(_JSON_FEEDS[key])


# ---------------------------------------------------------------------------
# whole tables
# ---------------------------------------------------------------------------

@query
def events_wide(tb: Testbed) -> DataFrame:
    return _events(tb)


@query
def purchases(tb: Testbed) -> DataFrame:
    return _purchases(tb)


@query
def new_users(tb: Testbed) -> DataFrame:
    return _new_users(tb)


@query
def sessions_full(tb: Testbed) -> DataFrame:
    return _sessions(tb)


@query
def sessions_hot_split(tb: Testbed) -> DataFrame:
    """Sessions of more than three events take the path of hot sessions, the rest the other one."""
    numbered = number_batch(tb.raw.select(*SESSION_BATCH))
    return se.build_sessions(tb.raw, tb.orders(), _new_users(tb, numbered), TB_DAILY, numbered, hot_rows=3)


@query
def items_union(tb: Testbed) -> DataFrame:
    return it.build_items(tb.raw, tb.orders(), tb.products(), TB_DAILY)


# ---------------------------------------------------------------------------
# sources, projection, filters
# ---------------------------------------------------------------------------

@query
def scan_events(tb: Testbed) -> DataFrame:
    return _raw_scalars(tb.raw.filter(F.col("event_date") > F.lit(NO_MARK)))


@query
def project_clean(tb: Testbed) -> DataFrame:
    ev = cleaned_events(tb.raw, tb.orders(), TB_DAILY)
    return ev.select("event_date", "event_timestamp", "s_no", "event_name", "event_bundle_sequence_id", "user_id",
                     "user_pseudo_id", "is_active_user", "user_first_touch_timestamp", *TRAFFIC_OUT, "shopify_order_id")


@query
def filter_in_notin(tb: Testbed) -> DataFrame:
    ex = it._explode_items(_item_events(tb).filter(F.col("event_name") == it.LIST_VIEW), distinct=False)
    ex = ex.filter(~F.col("__list_raw").isin(*it.NO_LIST) & F.col("__list_raw").isNotNull())
    return ex.select("s_no", F.trim("__item_id_raw").alias("item_id"), F.col("__list_raw").alias("list_name_raw"))


@query
def filter_after_watermark(tb: Testbed) -> DataFrame:
    mark = inc.high_water_mark(tb.spark, _stored_daily(tb).events)
    return _raw_scalars(tb.intraday_feed().filter(F.col("event_date") > F.lit(mark)))


@query
def filter_nonempty_items(tb: Testbed) -> DataFrame:
    n = number_batch(tb.raw.select("event_date", "event_timestamp", "event_name", "event_bundle_sequence_id",
                                   "user_pseudo_id", "event_params", "items"))
    return n.filter(F.size("items") > 0).select("s_no", "event_bundle_sequence_id", F.size("items").alias("n_items"))


def _distinct_values(tb: Testbed, suffix: str) -> DataFrame:
    cols = [f"traffic_source_{suffix}", f"{CT}{suffix}", f"{LC}{suffix}"]
    parts = [tb.raw.select(lower_trim(c).alias("value")) for c in cols]
    return reduce(lambda a, b: a.unionByName(b), parts).distinct()


@query
def normalize_source(tb: Testbed) -> DataFrame:
    v = _distinct_values(tb, "source")
    return v.select(F.col("value").alias("source_value"), rules.normalize_source("value").alias("normalized_source"))


@query
def normalize_medium(tb: Testbed) -> DataFrame:
    v = _distinct_values(tb, "medium")
    return v.select(F.col("value").alias("medium_value"), rules.normalize_medium("value").alias("normalized_medium"))


def _acq_inputs() -> list:
    return [F.coalesce("traffic_source_source", CT + "source").alias("acq_source"),
            F.coalesce("traffic_source_medium", CT + "medium").alias("acq_medium"),
            F.coalesce("traffic_source_name", CT + "campaign_name").alias("acq_campaign")]


def _ses_inputs() -> list:
    return [F.coalesce(LC + f, CT + f).alias(f"ses_{n}") for f, n in
            (("source", "source"), ("medium", "medium"), ("campaign_name", "campaign"), ("source_platform", "platform"))]


@query
def channel_acquisition(tb: Testbed) -> DataFrame:
    d = _events(tb).select(*_acq_inputs()).distinct()
    return d.withColumn("channel", rules.channel_acquisition("acq_source", "acq_medium", "acq_campaign", TB_CHANNELS))


@query
def channel_session(tb: Testbed) -> DataFrame:
    d = _events(tb).select(*_ses_inputs()).distinct()
    return d.withColumn("channel", rules.channel_session("ses_source", "ses_medium", "ses_campaign", "ses_platform",
                                                         TB_CHANNELS))


@query
def channel_wiring(tb: Testbed) -> DataFrame:
    return _events(tb).select("s_no", *_acq_inputs(), *_ses_inputs(), "acquisition_channel_group",
                              "session_channel_group")


def _items_with_product(tb: Testbed) -> DataFrame:
    ex = it._explode_items(_item_events(tb), distinct=False)
    return it._product(ex, tb.products())


@query
def product_gender_rules(tb: Testbed) -> DataFrame:
    return _items_with_product(tb).select("externalid", F.col("__item_name_raw").alias("item_name_raw"),
                                          F.col("__dim_gender").alias("dim_gender"), "gender").distinct()


@query
def clean_not_set(tb: Testbed) -> DataFrame:
    ex = it._explode_items(_item_events(tb), distinct=False)
    return ex.select(F.col("__list_raw").alias("list_name_raw"), blank_to_null("__list_raw").alias("item_list_name"),
                     F.col("__variant_raw").alias("variant_raw"), blank_to_null("__variant_raw").alias("item_variant")
                     ).distinct()


@query
def variant_color_size(tb: Testbed) -> DataFrame:
    d = _items_with_product(tb)
    color, size = split_variant(F.col("__variant_raw"), F.col("product_family"))
    return d.select(F.col("__variant_raw").alias("variant_raw"), "product_family", color.alias("color"),
                    size.alias("size")).distinct()


# ---------------------------------------------------------------------------
# joins
# ---------------------------------------------------------------------------

MONEY_EVENT = ["shopify_order_id", "unique_items", "total_item_quantity", "tax_value", "shipping_value",
               "gross_sales", "gsnd", "gmv"]


@query
def join_order_money(tb: Testbed) -> DataFrame:
    return cleaned_events(tb.raw, tb.orders(), TB_DAILY).select("s_no", "event_name", *MONEY_EVENT)


@query
def join_order_money_all(tb: Testbed) -> DataFrame:
    return cleaned_events(tb.raw, tb.orders(), TB_INTRADAY).select("s_no", "event_name", *MONEY_EVENT)


@query
def semi_orders_in_batch(tb: Testbed) -> DataFrame:
    ids = staged(batch_order_ids(tb.raw))
    return orders_in_batch(tb.orders(), ids, id_bounds(ids))


@query
def anti_return_buyers(tb: Testbed) -> DataFrame:
    fv = nu.first_visit_users(_events(tb), NO_MARK)
    ret = nu.returning_buyers(_purchases(tb), tb.customer_types(), NO_MARK)
    return fv.join(ret, ["unique_user_id", "event_date"], "left_anti").select("event_date", "unique_user_id")


@query
def lookback_activity(tb: Testbed) -> DataFrame:
    ev = _events(tb)
    fv = nu.first_visit_users(ev, NO_MARK)
    counts = (ev.filter(F.col("event_name").isNotNull() & F.col("unique_user_id").isNotNull())
              .groupBy("unique_user_id", F.col("event_date").alias("active_date")).agg(F.count("event_name").alias("n")))
    days = F.sequence(F.date_sub("event_date", nu.LOOKBACK_DAYS), F.date_sub("event_date", 1))
    ex = fv.select("unique_user_id", "event_date", F.explode(days).alias("active_date"))
    j = ex.join(counts, ["unique_user_id", "active_date"], "left")
    return j.groupBy("event_date", "unique_user_id").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("activity"))


@query
def join_customer_type(tb: Testbed) -> DataFrame:
    p = _purchases(tb).select("event_date", "unique_user_id", "shopify_order_id")
    ct = tb.customer_types().withColumnRenamed("shopify_order_id", "__oid")
    cond = (p["shopify_order_id"] == ct["__oid"]) & (p["event_date"] > F.lit(NO_MARK))
    return p.join(ct, cond, "left").select("event_date", "unique_user_id", "shopify_order_id", "customer_type")


def _purchase_dedup(tb: Testbed) -> DataFrame:
    return it.purchase_dedup(it.purchase_rows(_item_events(tb)))


@query
def join_item_money(tb: Testbed) -> DataFrame:
    ids = batch_order_ids(tb.raw)
    j = it.attach_item_money(_purchase_dedup(tb), tb.orders(), ids)
    return j.select("shopify_order_id", F.col("__item_key").alias("item_key"), "quantity", *it.MONEY)


@query
def join_product_dim(tb: Testbed) -> DataFrame:
    b = it.browse_items(_item_events(tb), tb.products())
    return b.select("s_no", "item_id", *it.DIM_COLUMNS, "gender", "strategic_business_unit")


@query
def swap_color_size(tb: Testbed) -> DataFrame:
    return it.build_items(tb.raw, tb.orders(), tb.products(), TB_DAILY).select(
        "s_no", "event_name", "item_id", "item_variant", "color", "size")


@query
def session_end(tb: Testbed) -> DataFrame:
    return _sessions(tb).select(*SES_KEYS, "last_event_s_no", "session_end_timestamp")


@query
def visitor_flag(tb: Testbed) -> DataFrame:
    return _sessions(tb).select(*SES_KEYS, "visitor_flag")


@query
def explode_params(tb: Testbed) -> DataFrame:
    n = number_batch(tb.raw.select("event_date", "event_timestamp", "event_name", "event_bundle_sequence_id",
                                   "user_pseudo_id", "event_params"))
    from webtrail.functions.params import explode_params as explode
    return explode(n, "event_params").select("s_no", "param_key", "param_value")


# Daily tables stored by a daily run over the settled feed: (app id, sf_dir) -> Tables.
_STORED_DAILY: dict = {}


def _stored_daily(tb: Testbed):
    """The four daily tables as a scheduler leaves them: one daily run over the
    settled days, written once per application to the shared checkpoint folder."""
    from webtrail.plans.runner import run_daily_tables, scratch_tables
    key = (tb.spark.sparkContext.applicationId, tb.sf_dir)
    if key not in _STORED_DAILY:
        tables = scratch_tables(tb.spark, "daily")
        run_daily_tables(tb.spark, tb.daily_feed(), tb.orders(), tb.customer_types(), tb.products(), tables, TB_DAILY)
        _STORED_DAILY[key] = tables
    return _STORED_DAILY[key]


def _intraday(tb: Testbed) -> dict:
    """Stored daily tables, their marks (from the partition listing) and the
    intraday tables built from the provisional feed past those marks."""
    spark, orders = tb.spark, tb.orders()
    daily = _stored_daily(tb)
    marks = {k: inc.high_water_mark(spark, p) for k, p in daily.as_dict().items()}
    feed = tb.intraday_feed()
    evi = build_events(feed.filter(F.col("event_date") > F.lit(marks["events"])), orders, TB_INTRADAY)
    pui = build_purchases(feed.filter(F.col("event_date") > F.lit(marks["purchases"])), orders, TB_INTRADAY)
    return {"evd": inc.read_table(spark, daily.events), "evi": evi, "pui": pui, "marks": marks, "feed": feed,
            "daily": daily}


@query
def new_users_intraday(tb: Testbed) -> DataFrame:
    d = _intraday(tb)
    return nu.new_users(d["evi"], [d["evd"], d["evi"]], d["pui"], tb.customer_types(), d["marks"]["sessions"],
                        keep_null_user=False)


@query
def intraday_tail(tb: Testbed) -> DataFrame:
    return _intraday(tb)["evi"]


@query
def purchases_intraday(tb: Testbed) -> DataFrame:
    return _intraday(tb)["pui"]


@query
def sessions_intraday(tb: Testbed) -> DataFrame:
    d = _intraday(tb)
    mark = d["marks"]["sessions"]
    nui = nu.new_users(d["evi"], [d["evd"], d["evi"]], d["pui"], tb.customer_types(), mark, keep_null_user=False)
    return se.build_sessions(d["feed"].filter(F.col("event_date") > F.lit(mark)), tb.orders(), nui, TB_INTRADAY)


@query
def items_intraday(tb: Testbed) -> DataFrame:
    mark = inc.high_water_mark(tb.spark, _stored_daily(tb).items)
    return it.build_items(tb.intraday_feed().filter(F.col("event_date") > F.lit(mark)), tb.orders(), tb.products(),
                          TB_INTRADAY)


# ---------------------------------------------------------------------------
# aggregations
# ---------------------------------------------------------------------------

@query
def order_money(tb: Testbed) -> DataFrame:
    return batch_money(tb.raw, tb.orders(), purchase_only_semi=False)


@query
def order_item_money(tb: Testbed) -> DataFrame:
    from webtrail.operators.orders import order_item_money as per_item
    return per_item(orders_in_batch(tb.orders(), batch_order_ids(tb.raw)))


@query
def order_unique_items(tb: Testbed) -> DataFrame:
    return batch_money(tb.raw, tb.orders(), purchase_only_semi=False).select("shopify_order_id", "unique_items")


@query
def session_event_counts(tb: Testbed) -> DataFrame:
    return _sessions(tb).select(*SES_KEYS, *[c for c, _ in SESSION_COUNTERS])


@query
def session_attribute_rollup(tb: Testbed) -> DataFrame:
    return _combos(tb).select(*se.COMBO_KEYS, "event_timestamp", "s_no", "last_s_no", "engagement_time_msec",
                              "orders", *[c for c, _ in SESSION_COUNTERS])


@query
def first_visit_users(tb: Testbed) -> DataFrame:
    return nu.first_visit_users(_events(tb), NO_MARK)


@query
def first_last_touch(tb: Testbed) -> DataFrame:
    fl = [f"{p}_event_{c}" for c in se.FIRST_LAST for p in ("first", "last")]
    return _sessions(tb).select(*SES_KEYS, *fl)


@query
def session_final(tb: Testbed) -> DataFrame:
    numbered = number_batch(tb.raw.select(*se.RAW_COLUMNS))
    ev = se.session_events(tb.raw, tb.orders(), TB_DAILY, numbered)
    return se.all_sessions(ev, se.hot_sessions(numbered, se.HOT_ROWS)).select(
        *SES_KEYS, "session_start_timestamp", "last_event_s_no", "user_id", "user_pseudo_id", "ga_session_id",
        "engagement_time_msec", *[c for c, _ in SESSION_COUNTERS], "orders", *se.MONEY_SUMS)


@query
def high_water_mark(tb: Testbed) -> DataFrame:
    return inc.high_water_mark_df(inc.read_table(tb.spark, _stored_daily(tb).events))


@query
def high_water_mark_listing(tb: Testbed) -> DataFrame:
    """The mark as the runner takes it: from the names of the stored day folders."""
    mark = inc.high_water_mark(tb.spark, _stored_daily(tb).events)
    return tb.spark.range(1).select(F.lit(mark).alias("high_water_mark"))


@query
def new_users_stored_days(tb: Testbed) -> DataFrame:
    """New users by the kept activity days: a run over the settled days, then one over the whole feed, which
    drops and redoes the newest of them."""
    from webtrail.plans.runner import keep_activity
    path = inc.scratch_target(tb.spark, "activity")
    settled = tb.daily_feed().agg(F.max("event_date")).first()[0]
    ev = _events(tb)
    keep_activity(tb.spark, ev.filter(F.col("event_date") <= F.lit(settled)), path, NO_MARK)
    keep_activity(tb.spark, ev, path, settled - dt.timedelta(days=1))
    return nu.new_users(ev, [], _purchases(tb), tb.customer_types(), NO_MARK,
                        stored_activity=[inc.read_table(tb.spark, path)])


@query
def pivot_params(tb: Testbed) -> DataFrame:
    return _events(tb).select("s_no", "ga_session_id", *EVENT_PARAM_KEYS)


@query
def items_list_views(tb: Testbed) -> DataFrame:
    return it.list_view_items(_item_events(tb), tb.products(), TB_DAILY.list_view_brand).select(*it.ITEMS_COLUMNS)


# ---------------------------------------------------------------------------
# windows
# ---------------------------------------------------------------------------

@query
def global_sequence(tb: Testbed) -> DataFrame:
    return number_batch(tb.raw).select("event_bundle_sequence_id", "s_no")


@query
def session_gap(tb: Testbed) -> DataFrame:
    return se.session_gaps(_combos(tb)).select("event_date", "unique_session_id", "unique_user_id", "s_no",
                                                "event_timestamp", "previous_timestamp", "newsession")


@query
def session_index(tb: Testbed) -> DataFrame:
    return se.session_index(_combos(tb)).select("event_date", "unique_session_id", "unique_user_id", "s_no",
                                                 "session_index")


@query
def purchase_item_dedup(tb: Testbed) -> DataFrame:
    g = _purchase_dedup(tb)
    return g.select("shopify_order_id", F.col("__item_key").alias("item_key"), "s_no",
                    F.trim("__item_id_raw").alias("item_id"), "price_in_usd", *ITEM_PARAM_KEYS)


@query
def purchase_item_revenue(tb: Testbed) -> DataFrame:
    return _purchase_dedup(tb).select("shopify_order_id", F.col("__item_key").alias("item_key"), "item_revenue_in_usd")


@query
def engaged_flag(tb: Testbed) -> DataFrame:
    return _sessions(tb).select(*SES_KEYS, "page_view", "engagement_time_msec", "orders", "engaged_session_flag")


# ---------------------------------------------------------------------------
# nested data, scalars, time
# ---------------------------------------------------------------------------

@query
def param_value_coalesce(tb: Testbed) -> DataFrame:
    ex = it._explode_items(_item_events(tb), distinct=False)
    p = ex.select("s_no", F.trim("__item_id_raw").alias("item_id"), F.explode("item_params").alias("p"))
    return p.select("s_no", "item_id", F.col("p")["key"].alias("param_key"),
                    param_value(F.col("p"), trim=True).alias("param_value"))


@query
def explode_items(tb: Testbed) -> DataFrame:
    ex = it._explode_items(_item_events(tb), distinct=False)
    return ex.select("s_no", "item_brand", F.col("__item_id_raw").alias("item_id"),
                     F.col("__list_raw").alias("item_list_name"), F.col("__item_name_raw").alias("item_name"),
                     "quantity", "price_in_usd", F.col("__variant_raw").alias("item_variant"), "item_revenue_in_usd")


@query
def item_params_pivot(tb: Testbed) -> DataFrame:
    ex = it._explode_items(_item_events(tb), distinct=True).filter(has_params("item_params"))
    return ex.select("s_no", F.trim("__item_id_raw").alias("item_id"),
                     *[param("item_params", k, trim_values=True).alias(k) for k in ITEM_PARAM_KEYS])


@query
def items_browse(tb: Testbed) -> DataFrame:
    return it.browse_items(_item_events(tb), tb.products()).select(*it.ITEMS_COLUMNS)


@query
def items_purchase(tb: Testbed) -> DataFrame:
    ids = batch_order_ids(tb.raw)
    return it.purchase_items(_item_events(tb), tb.orders(), ids, tb.products()).select(*it.ITEMS_COLUMNS)


@query
def parse_params_json(tb: Testbed) -> DataFrame:
    """Params stored as JSON text, all four value types, every 37th text damaged."""
    stored = _json_feed(tb).select("event_bundle_sequence_id", "event_params")
    p = stored.select("event_bundle_sequence_id", F.explode(parse_json_params("event_params")).alias("p"))
    return p.select("event_bundle_sequence_id", F.col("p")["key"].alias("param_key"),
                    param_value(F.col("p")).alias("param_value"))


@query
def items_json(tb: Testbed) -> DataFrame:
    """The items table from a feed that holds params and items as JSON text; the order lines are cut first, as in
    a run of all tables, so that the shuffle of the order fact is gone when the items are built."""
    return it.build_items(_json_feed(tb), _feed_orders(tb), tb.products(), TB_DAILY)


@query
def sql_functions(tb: Testbed) -> DataFrame:
    """The classification functions called from SQL text."""
    sqlfuncs.register(tb.spark, TB_CHANNELS)
    ev = _events(tb)
    acq, ses = ev.select(*_acq_inputs()).distinct(), ev.select(*_ses_inputs()).distinct()
    return tb.spark.sql("""
        SELECT 'source' AS fn, value AS s, CAST(NULL AS STRING) AS m, CAST(NULL AS STRING) AS c, CAST(NULL AS STRING) AS p,
               normalize_source(value) AS result FROM {sources}
        UNION ALL SELECT 'medium', value, NULL, NULL, NULL, normalize_medium(value) FROM {mediums}
        UNION ALL SELECT 'acquisition', acq_source, acq_medium, acq_campaign, NULL,
                         channel_acquisition(acq_source, acq_medium, acq_campaign) FROM {acq}
        UNION ALL SELECT 'session', ses_source, ses_medium, ses_campaign, ses_platform,
                         channel_session(ses_source, ses_medium, ses_campaign, ses_platform) FROM {ses}""",
                        sources=_distinct_values(tb, "source"), mediums=_distinct_values(tb, "medium"), acq=acq, ses=ses)


@query
def identity_keys(tb: Testbed) -> DataFrame:
    return _events(tb).select("s_no", "user_id", "user_pseudo_id", "unique_user_id", "ga_session_id",
                              "unique_session_id")


@query
def engagement_sum(tb: Testbed) -> DataFrame:
    return _session_events(tb).groupBy("event_date", "unique_user_id").agg(
        F.sum("engagement_ms").alias("engagement_time_msec"))


@query
def local_time(tb: Testbed) -> DataFrame:
    r = tb.raw
    ts = to_local("event_timestamp", r.schema["event_timestamp"].dataType, TB_DAILY.zone)
    return r.select("event_bundle_sequence_id", ts.alias("event_timestamp"), F.hour(ts).alias("hourofday"),
                    to_local("user_first_touch_timestamp", r.schema["user_first_touch_timestamp"].dataType,
                             TB_DAILY.zone).alias("user_first_touch_timestamp"))


@query
def time_on_site(tb: Testbed) -> DataFrame:
    return _sessions(tb).select(*SES_KEYS, "session_start_timestamp", "session_end_timestamp", "time_on_site")


# ---------------------------------------------------------------------------
# incremental and streaming (state in the shared checkpoint folder)
# ---------------------------------------------------------------------------

def _events_builder(tb: Testbed):
    """Builds events of any batch of the feed; the order lines of the whole feed are cut from the order fact
    once, as in a run of all tables, so that its shuffle is not paid again by each run of a query."""
    orders = _feed_orders(tb)
    return lambda batch: build_events(batch, orders, TB_DAILY)


@query
def incremental_daily(tb: Testbed) -> DataFrame:
    """Run 1 over the settled days; run 2 over the whole feed redoes the newest day and adds the rest."""
    path = inc.scratch_target(tb.spark, "events")
    build = _events_builder(tb)
    inc.run_daily(tb.spark, tb.daily_feed(), build, path)
    inc.run_daily(tb.spark, tb.raw, build, path)
    return inc.read_table(tb.spark, path).select(*EVENTS_COLUMNS)


@query
def reprocess_latest_day(tb: Testbed) -> DataFrame:
    """After run 1, the pre-run drop removes the newest stored day (rows per day remaining)."""
    path = inc.scratch_target(tb.spark, "events")
    inc.run_daily(tb.spark, tb.daily_feed(), _events_builder(tb), path)
    inc.drop_latest_day(tb.spark, path)
    return inc.read_table(tb.spark, path).groupBy("event_date").agg(F.count(F.lit(1)).alias("rows"))


@query
def schema_sync(tb: Testbed) -> DataFrame:
    """A table stored with an older schema (no label/currency, an extra column) synced to the current one."""
    path = inc.scratch_target(tb.spark, "events")
    ev = build_events(tb.daily_feed(), tb.orders(), TB_DAILY)
    old = ev.drop("label", "currency").withColumn("legacy_flag", F.lit(1))
    inc.write_days(old, path)
    inc.sync_schema(tb.spark, path, ev.schema)
    return inc.read_table(tb.spark, path).select("event_date", "s_no", "page_title", "label", "currency")


@query
def incremental_one_day(tb: Testbed) -> DataFrame:
    """A first run on one day, one on two (the only stored day is dropped before it), one on the whole feed."""
    path = inc.scratch_target(tb.spark, "events")
    first = tb.raw.agg(F.min("event_date")).first()[0]
    build = _events_builder(tb)
    for n in (0, 1):
        inc.run_daily(tb.spark, tb.raw.filter(F.col("event_date") <= F.lit(first + dt.timedelta(days=n))), build, path)
    inc.run_daily(tb.spark, tb.raw, build, path)
    return inc.read_table(tb.spark, path).select(*EVENTS_COLUMNS)


_STREAMED: dict = {}


def _stream_tails(tb: Testbed):
    """Raw intraday files streamed into a raw tail table, and the four tail tables rebuilt from it,
    once per application."""
    from webtrail.plans.runner import scratch_tables
    key = (tb.spark.sparkContext.applicationId, tb.sf_dir)
    if key not in _STREAMED:
        base = inc.scratch_target(tb.spark, "stream")
        tb.intraday_feed().repartition("event_date").write.mode("overwrite").parquet(f"{base}/landing")
        tails = scratch_tables(tb.spark, "tail")
        stream.refresh_tails(tb.spark, f"{base}/landing", tb.raw.schema, f"{base}/raw_tail", f"{base}/_checkpoint",
                             tb.orders(), tb.customer_types(), tb.products(), _stored_daily(tb), tails, TB_INTRADAY,
                             max_files_per_trigger=1)
        _STREAMED[key] = tails
    return _STREAMED[key]


@query
def intraday_stream(tb: Testbed) -> DataFrame:
    return inc.read_table(tb.spark, _stream_tails(tb).events).select(*EVENTS_COLUMNS)


@query
def purchases_stream(tb: Testbed) -> DataFrame:
    return inc.read_table(tb.spark, _stream_tails(tb).purchases)


@query
def items_stream(tb: Testbed) -> DataFrame:
    return inc.read_table(tb.spark, _stream_tails(tb).items)


@query
def sessions_stream(tb: Testbed) -> DataFrame:
    return inc.read_table(tb.spark, _stream_tails(tb).sessions)


@query
def sessions_stream_days(tb: Testbed) -> DataFrame:
    """The sessions tail after two refreshes, the second of which rebuilds only what its files touch.
    ``s_no`` numbers the rows built together, so it is left out."""
    from webtrail.plans.runner import scratch_tables
    base, tails = inc.scratch_target(tb.spark, "stream-days"), scratch_tables(tb.spark, "tail-days")
    feed, newest = tb.intraday_feed(), tb.intraday_feed().agg(F.max("event_date")).first()[0]
    for now in (F.col("event_date") < F.lit(newest), F.col("event_date") == F.lit(newest)):
        feed.filter(now).write.mode("append").parquet(f"{base}/landing")
        stream.refresh_tails(tb.spark, f"{base}/landing", tb.raw.schema, f"{base}/raw_tail", f"{base}/_checkpoint",
                             tb.orders(), tb.customer_types(), tb.products(), _stored_daily(tb), tails, TB_INTRADAY)
    return inc.read_table(tb.spark, tails.sessions).drop("last_event_s_no")
