"""The purchases (ecommerce) table: one row per purchase event that has params."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtrail.functions.params import has_params, param
from webtrail.functions.scalars import unique_session_id, unique_user_id
from webtrail.plans.common import (acquisition_channel, attach_order_money, batch_money, local_times,
                                   normalized_traffic, session_channel, shopify_order_id, traffic_clean, typed_feed)
from webtrail.plans.events import MONEY_OUT, RAW_COLUMNS, TRAFFIC_OUT
from webtrail.schema import ACQ_CHANNEL, PURCHASE_PARAM_KEYS, SES_CHANNEL, FeedOptions

PURCHASES_COLUMNS = (["event_date", "event_timestamp", "hourofday", "user_id", "user_pseudo_id", "unique_user_id",
                      "is_active_user", "user_first_touch_timestamp", "ga_session_id", "unique_session_id",
                      "ga_session_number", "coupon", "currency"] + MONEY_OUT + TRAFFIC_OUT + [ACQ_CHANNEL, SES_CHANNEL])


def purchase_events(raw_batch: DataFrame) -> DataFrame:
    """Purchase test of this table: lower-cased, not trimmed."""
    return raw_batch.filter(F.lower("event_name") == "purchase")


def build_purchases(raw_batch: DataFrame, orders: DataFrame, opts: FeedOptions = FeedOptions()) -> DataFrame:
    raw = typed_feed(raw_batch.select(*RAW_COLUMNS))
    # the order fact is cut by every transaction id of the batch, purchase or not
    money = batch_money(raw, orders, purchase_only_semi=False)
    # no row of this table carries a position in the batch, so the purchases are not numbered
    joined = attach_order_money(purchase_events(raw), money, only_purchases=False)
    ev = joined.filter(has_params("event_params")).withColumns({
        **local_times(raw, opts),
        "user_id": F.trim("user_id"),
        "user_pseudo_id": F.trim(F.col("user_pseudo_id").cast("string")),
        **traffic_clean(TRAFFIC_OUT),
        "shopify_order_id": shopify_order_id(),
        "unique_items": F.coalesce("__shp_unique_items", "ecommerce_unique_items"),
        "total_item_quantity": F.coalesce("__shp_quantity", "ecommerce_total_item_quantity"),
        # params: trimmed before the max
        **{k: param("event_params", k, trim_values=True) for k in PURCHASE_PARAM_KEYS},
    })
    out = ev.withColumns({
        "hourofday": F.hour("event_timestamp"),
        "unique_user_id": unique_user_id("user_pseudo_id", "user_id"),
        "unique_session_id": unique_session_id("ga_session_id", "user_pseudo_id", "user_id"),
        **normalized_traffic(),
    })
    out = out.withColumns({ACQ_CHANNEL: acquisition_channel(opts), SES_CHANNEL: session_channel(opts)})
    return out.select(*PURCHASES_COLUMNS)
