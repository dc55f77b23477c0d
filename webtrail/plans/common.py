"""Steps shared by the table builders: batch numbering, cleaning, order money, channels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webtrail.functions import rules
from webtrail.functions.scalars import NOT_SET, not_set_to_null, lower_trim
from webtrail.functions.timeops import to_local, utc_micros
from webtrail.operators.joins import left_join_split
from webtrail.operators.orders import batch_order_ids, order_money, orders_in_batch
from webtrail.operators.sequence import global_sequence
from webtrail.schema import CT, ITEMS_DDL, LC, LOWERED_TRAFFIC, PARAMS_DDL, FeedOptions

RAW_TS, RAW_TIE = "__raw_ts_us", "__raw_tie"


def sequence_order(raw: DataFrame) -> list[Column]:
    """Order of the batch numbering: event time, then a tie-break over raw columns
    (the raw feed has no row id)."""
    return [
        F.col(RAW_TS).asc(),
        F.col("user_pseudo_id").cast("string").asc_nulls_first(),
        F.col("event_name").asc_nulls_first(),
        F.col("event_bundle_sequence_id").asc_nulls_first(),
        F.xxhash64("event_params"),  # never null, ascending
    ]


def typed_feed(raw: DataFrame) -> DataFrame:
    """The feed with ``event_params`` and ``items`` as typed arrays.

    An export may hold them as JSON text; text that is no such JSON reads as null,
    and its event has no params (no items).  Typed columns stay as they are."""
    types = {"event_params": PARAMS_DDL, "items": ITEMS_DDL}
    texts = [c for c in types if c in raw.columns and isinstance(raw.schema[c].dataType, T.StringType)]
    return raw.withColumns({c: F.from_json(c, types[c]) for c in texts}) if texts else raw


def number_batch(raw: DataFrame, instead_of_params: dict[str, Column] | None = None) -> DataFrame:
    """Add ``s_no``: the event's position in the batch by raw UTC time.

    A table that reads little of the params gives it as ``instead_of_params``: these columns are numbered
    in the place of ``event_params``, the widest part of most rows, so the array is neither shuffled nor
    staged.  The order is the same, its tie-break is taken from the array before."""
    raw = typed_feed(raw)
    dtype = raw.schema["event_timestamp"].dataType
    with_key = raw.withColumn(RAW_TS, utc_micros("event_timestamp", dtype))
    order = sequence_order(with_key)
    if instead_of_params:
        with_key = with_key.withColumns({RAW_TIE: order[-1], **instead_of_params}).drop("event_params")
        order[-1] = F.col(RAW_TIE)
    return global_sequence(with_key, order, "s_no").drop(RAW_TS, RAW_TIE)


def local_times(raw: DataFrame, opts: FeedOptions) -> dict[str, Column]:
    out = {"event_timestamp": to_local("event_timestamp", raw.schema["event_timestamp"].dataType, opts.zone)}
    if "user_first_touch_timestamp" in raw.columns:
        out["user_first_touch_timestamp"] = to_local(
            "user_first_touch_timestamp", raw.schema["user_first_touch_timestamp"].dataType, opts.zone)
    return out


def traffic_clean(names: list[str]) -> dict[str, Column]:
    """lower(trim()) for traffic strings, trim() for the two campaign ids."""
    return {c: (lower_trim(c) if c in LOWERED_TRAFFIC else F.trim(c)) for c in names}


def normalized_traffic() -> dict[str, Column]:
    """Source/medium normalisers over the already cleaned traffic columns."""
    out = {}
    for prefix in ("traffic_source_", CT, LC):
        out[prefix + "source"] = rules.normalize_source(prefix + "source")
        out[prefix + "medium"] = rules.normalize_medium(prefix + "medium")
    return out


def shopify_order_id() -> Column:
    return not_set_to_null("ecommerce_transaction_id")


def attach_order_money(df: DataFrame, money: DataFrame, only_purchases: bool, purchase_test: Column | None = None,
                       with_unique_items: bool = True) -> DataFrame:
    """Left join order money on trim(transaction id), optionally only for purchase rows.

    Only rows that can match are shuffled (see ``left_join_split``); the batch
    is checkpointed by the numbering, so reading it twice is a plain scan.
    """
    keep = None
    if only_purchases:
        keep = purchase_test if purchase_test is not None else (F.trim("event_name") == "purchase")
    m = money.select(
        "shopify_order_id",
        *([F.col("unique_items").alias("__shp_unique_items")] if with_unique_items else []),
        F.col("quantity").alias("__shp_quantity"),
        F.col("total_tax").alias("tax_value"),
        F.col("shipping").alias("shipping_value"),
        "gross_sales", "gsnd", "gmv",
    )
    return left_join_split(df, m, F.trim("ecommerce_transaction_id"), "shopify_order_id", keep=keep,
                           placeholders=(NOT_SET,))


def batch_money(raw_batch: DataFrame, orders: DataFrame, purchase_only_semi: bool, with_unique_items: bool = True
                ) -> DataFrame:
    ids = batch_order_ids(raw_batch, purchase_only_semi)
    return order_money(orders_in_batch(orders, ids), with_unique_items)


def acquisition_channel(opts: FeedOptions, prefix: str = "") -> Column:
    p = prefix
    return rules.channel_acquisition(
        F.coalesce(F.col(p + "traffic_source_source"), F.col(p + CT + "source")),
        F.coalesce(F.col(p + "traffic_source_medium"), F.col(p + CT + "medium")),
        F.coalesce(F.col(p + "traffic_source_name"), F.col(p + CT + "campaign_name")),
        opts.channels,
        lowercase_inputs=True,  # traffic columns are lower(trim())-cleaned, normaliser outputs are lower case
    )


def session_channel(opts: FeedOptions, prefix: str = "") -> Column:
    p = prefix
    if opts.session_channel_from_last_click:
        args = [F.coalesce(F.col(p + LC + f), F.col(p + CT + f2)) for f, f2 in
                (("source", "source"), ("medium", "medium"), ("campaign_name", "campaign_name"),
                 ("source_platform", "source_platform"))]
    else:
        args = [F.col(p + CT + f) for f in ("source", "medium", "campaign_name", "source_platform")]
    return rules.channel_session(*args, cfg=opts.channels, lowercase_inputs=True)
