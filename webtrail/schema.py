"""Column lists of the raw feed and of the output tables, and the feed options."""

from __future__ import annotations

from dataclasses import dataclass, field

from webtrail.functions.rules import ChannelConfig

# Raw event columns read by the builders (anything else in the feed is pruned).
DEVICE_GEO = [
    "platform", "device_category", "device_mobile_brand_name", "device_mobile_model_name",
    "device_operating_system", "device_operating_system_version", "device_language",
    "device_is_limited_ad_tracking", "device_web_info_browser", "device_web_info_browser_version",
    "geo_country", "geo_region", "geo_city", "geo_metro",
]

TS_TRAFFIC = ["traffic_source_source", "traffic_source_medium", "traffic_source_name"]
CT = "collected_traffic_source_manual_"
LC = "session_traffic_source_last_click_manual_campaign_"
COLLECTED = [CT + c for c in ("source", "medium", "campaign_id", "campaign_name", "source_platform", "term", "content")]
# The raw names of the last-click id and name carry a doubled ``campaign_``.
LAST_CLICK = [LC + c for c in ("source", "medium", "campaign_id", "campaign_name", "source_platform", "term", "content")]
GCLID = "collected_traffic_source_gclid"

# Columns that are lower-cased as well as trimmed (ids are only trimmed).
LOWERED_TRAFFIC = set(TS_TRAFFIC + COLLECTED + LAST_CLICK) - {CT + "campaign_id", LC + "campaign_id"}

# Param keys widened by each table (fixed values, in output order).
EVENT_PARAM_KEYS = [
    "ga_session_number", "page_location", "link_url", "link_domain", "page_title", "page_referrer",
    "batch_page_id", "batch_ordering_id", "exp_variant_string", "engagement_time_msec", "category",
    "action", "percent_scrolled", "visitor_type", "search_term", "label", "currency",
]
PURCHASE_PARAM_KEYS = ["ga_session_id", "ga_session_number", "coupon", "currency"]
ITEM_EVENT_PARAM_KEYS = ["ga_session_id", "ga_session_number", "coupon", "page_location"]
ITEM_PARAM_KEYS = ["item_product_id", "item_variant_id"]
SESSION_PARAM_KEYS = ["ga_session_id", "engagement_time_msec", "visitor_type"]

# Session event counters: output column -> event name (fixed values).
SESSION_COUNTERS = [
    ("view_search_results", "view_search_results"),
    ("view_item", "view_item"),
    ("view_item_list", "view_item_list"),
    ("select_item", "select_item"),
    ("login", "login"),
    ("page_view", "page_view"),
    ("add_to_cart", "add_to_cart"),
    ("remove_from_cart", "remove_from_cart"),
    ("checkouts_initiated", "begin_checkout"),
    ("add_shipping_info", "add_shipping_info"),
    ("add_payment_info", "add_payment_info"),
]

# The 28 session attribute dimensions, in output order.
SESSION_DIMENSIONS = DEVICE_GEO + [
    "traffic_source_source", "traffic_source_medium", "traffic_source_name",
    CT + "source", CT + "medium", CT + "campaign_id", CT + "campaign_name", CT + "source_platform",
    GCLID,
    LC + "source", LC + "medium", LC + "campaign_id", LC + "campaign_name", LC + "source_platform",
]

ORDER_MEASURES = ["tax_value", "shipping_value", "gross_sales", "gsnd", "gmv"]

ACQ_CHANNEL = "acquisition_channel_group"
SES_CHANNEL = "session_channel_group"


@dataclass(frozen=True)
class FeedOptions:
    """Everything that differs between the settled daily feed and the intraday tail.

    * ``purchase_only_join`` - order money only on purchase events (daily) or on
      every event carrying the transaction id (intraday events table).
    * ``purchase_only_semi`` - the order fact is pre-filtered by purchase events
      only (intraday events table) or by any event with the id.
    * ``session_channel_from_last_click`` - session channel inputs are
      last-click with collected fallback (daily) or collected only (intraday).
    * ``zone`` - wall-clock zone of the output timestamps.
    """

    purchase_only_join: bool = True
    purchase_only_semi: bool = False
    session_channel_from_last_click: bool = True
    zone: str = "America/New_York"
    channels: ChannelConfig = field(default_factory=ChannelConfig)
    list_view_brand: str | None = None


DAILY = FeedOptions()
INTRADAY = FeedOptions(purchase_only_join=False, purchase_only_semi=True, session_channel_from_last_click=False)

# The raw export feed as the builders read it (event_timestamp may also be
# TIMESTAMP or TIMESTAMP_NTZ in UTC; extra columns are ignored).
PARAMS_DDL = ("array<struct<key:string,value:struct<string_value:string,int_value:string,"
              "double_value:string,float_value:string>>>")
ITEMS_DDL = ("array<struct<item_brand:string,item_category:string,item_id:string,item_list_name:string,"
             "item_name:string,quantity:decimal(38,0),price_in_usd:double,item_params:" + PARAMS_DDL +
             ",item_variant:string,item_revenue_in_usd:double>>")
RAW_EVENT_DDL = ", ".join(
    ["event_date date", "event_timestamp bigint", "event_name string", "event_bundle_sequence_id bigint",
     "user_id string", "user_pseudo_id string", "is_active_user boolean", "user_first_touch_timestamp bigint",
     f"event_params {PARAMS_DDL}"]
    + [f"{c} string" for c in DEVICE_GEO + TS_TRAFFIC + COLLECTED[:5]]
    + [f"{c} string" for c in COLLECTED[5:]] + [f"{GCLID} string"]
    + [f"{c} string" for c in LAST_CLICK]
    + ["ecommerce_transaction_id string", "ecommerce_unique_items bigint", "ecommerce_total_item_quantity bigint",
       "ecommerce_purchase_revenue_in_usd double", f"items {ITEMS_DDL}"]
)
ORDER_FACT_DDL = ("shopify_order_id string, sku string, title string, gift_card_flag string, quantity bigint, "
                  "gross_sales decimal(18,2), gsnd decimal(18,2), gross_merchandise_value decimal(18,2), "
                  "shipping_price decimal(18,2), total_tax decimal(18,2), vat_value decimal(18,2), "
                  "sale_kind string, country string")
CUSTOMER_TYPE_DDL = "shopify_order_id string, customer_type string"
PRODUCT_DIM_DDL = ("externalid string, division string, product_category string, product_subcategory string, "
                   "product_family string, planning_parent string, gender string, strategic_business_unit string, "
                   "product_size string")
