"""The events table: one row per raw event that carries at least one param."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtrail.functions.params import has_params, widen_params
from webtrail.functions.scalars import unique_session_id, unique_user_id
from webtrail.plans.common import (acquisition_channel, attach_order_money, batch_money, local_times,
                                   normalized_traffic, number_batch, session_channel, shopify_order_id,
                                   traffic_clean, typed_feed)
from webtrail.schema import ACQ_CHANNEL, COLLECTED, EVENT_PARAM_KEYS, LAST_CLICK, SES_CHANNEL, TS_TRAFFIC, FeedOptions

TRAFFIC_OUT = TS_TRAFFIC + COLLECTED + LAST_CLICK
MONEY_OUT = ["shopify_order_id", "unique_items", "total_item_quantity", "ecommerce_purchase_revenue_in_usd",
             "tax_value", "shipping_value", "gross_sales", "gsnd", "gmv"]
EVENTS_COLUMNS = (["event_date", "event_timestamp", "hourofday", "s_no", "event_name", "event_bundle_sequence_id",
                   "user_id", "user_pseudo_id", "unique_user_id", "is_active_user", "user_first_touch_timestamp",
                   "ga_session_id", "unique_session_id"] + TRAFFIC_OUT + EVENT_PARAM_KEYS + MONEY_OUT
                  + [ACQ_CHANNEL, SES_CHANNEL])

RAW_COLUMNS = ["event_date", "event_timestamp", "event_name", "event_bundle_sequence_id", "user_id",
               "user_pseudo_id", "is_active_user", "user_first_touch_timestamp", "event_params",
               "ecommerce_transaction_id", "ecommerce_unique_items", "ecommerce_total_item_quantity",
               "ecommerce_purchase_revenue_in_usd"] + TRAFFIC_OUT


def cleaned_events(raw_batch: DataFrame, orders: DataFrame, opts: FeedOptions,
                   numbered: DataFrame | None = None) -> DataFrame:
    """Numbered, cleaned events with order money; before param widening.

    ``numbered`` may pass the batch already numbered (shared with other tables)."""
    raw = typed_feed(raw_batch.select(*RAW_COLUMNS))
    money = batch_money(raw, orders, opts.purchase_only_semi)
    numbered = number_batch(raw) if numbered is None else numbered.select(*RAW_COLUMNS, "s_no")
    joined = attach_order_money(numbered, money, only_purchases=opts.purchase_only_join)
    cols = {
        **local_times(raw, opts),
        "event_name": F.trim("event_name"),
        "user_id": F.trim("user_id"),
        "user_pseudo_id": F.trim(F.col("user_pseudo_id").cast("string")),
        **traffic_clean(TRAFFIC_OUT),
        "shopify_order_id": shopify_order_id(),
        "unique_items": F.coalesce("__shp_unique_items", "ecommerce_unique_items"),
        "total_item_quantity": F.coalesce("__shp_quantity", "ecommerce_total_item_quantity"),
    }
    return joined.withColumns(cols)


def build_events(raw_batch: DataFrame, orders: DataFrame, opts: FeedOptions = FeedOptions(),
                 numbered: DataFrame | None = None) -> DataFrame:
    """Events table for the days in ``raw_batch`` (already cut at the watermark)."""
    ev = cleaned_events(raw_batch, orders, opts, numbered).filter(has_params("event_params"))
    # params: max over duplicates first, trim after
    widened = widen_params(ev, "event_params", dict.fromkeys(["ga_session_id", *EVENT_PARAM_KEYS]))
    out = widened.withColumns({
        "hourofday": F.hour("event_timestamp"),
        "unique_user_id": unique_user_id("user_pseudo_id", "user_id"),
        "ga_session_id": F.trim("__p_ga_session_id"),
        "unique_session_id": unique_session_id("__p_ga_session_id", "user_pseudo_id", "user_id"),
        **{k: F.trim(f"__p_{k}") for k in EVENT_PARAM_KEYS},
        **normalized_traffic(),
    })
    out = out.withColumns({ACQ_CHANNEL: acquisition_channel(opts), SES_CHANNEL: session_channel(opts)})
    return out.select(*EVENTS_COLUMNS)
