"""Adapters from the driver's test tables to the raw event feed and the lookups.

The driver tables (``events``, ``orders``, ``lineitem``, ``part``, ``customer``)
hold no key/value params, items or traffic columns, so these are derived with
plain arithmetic on ids.  :mod:`oracle.testbed_sql` renders the very same
arithmetic as DuckDB SQL; the lists below are shared by both so they cannot
drift apart.

Every derived table is computed from the whole input table; the only collected
value is one date (the last settled day of the feed pair).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webtrail.functions.params import PARAM_TYPE, PARAMS_TYPE

DAY_MICROS = 86_400_000_000
NOON_MICROS = 43_200_000_000
# the adapter squeezes each day's timeline eight-fold so that same-user gaps are often <= 30 min
TIME_SQUEEZE = 8
# the daily feed holds every day up to (last day - SETTLE_DAYS); the intraday feed the rest
SETTLE_DAYS = 3

CLICK_NAMES = ["view_item", "add_to_cart", "select_item", "view_search_results", "begin_checkout",
               "remove_from_cart", "add_shipping_info", "add_payment_info", "login", " view_item "]
SOURCES = ["google", "Facebook ", "fb", "fb-ad 7", "(direct)", "tiktok", "bing", "YouTube",
           "data not available", None, "instagram", "attentive", "spotify", "klaviyo", "tiktok ads", "api.id.me",
           "yahoo", "tb12 club", "twitter", "yandex", "en.wikipedia.org", "adwords", "FB Pixel", "breakaway", "mntn",
           "pinterest", "impact", "podcast", "snapchat", "bluecore", "narvar"]
MEDIUMS = ["cpc", "organic", "paid_social", "email", "(none)", "paid", "referral", "direct-mail",
           "affiliate", "sms", None, "web_app", "social_media", "ppc", "tv", "data not available",
           "aff", "shop", "shop_web", "ema", "Paid Social", "organic instagram", "partnership", "social feed", "koala",
           "text", "audio", "sm", "link", "directmail", "paid-social"]
CAMPAIGNS = ["brand_search", "pmax_us", "display", "pla", "summer brand", None, "demandgen",
             "Performance Max Brand", "ebates", "shop_now", "(organic)", "junky", "creator collective",
             "search_generic", "pla_x", "retarget"]
PLATFORMS = [None, "Google Ads", "Manual", "SA360"]
DEVICE_CATEGORIES = ["desktop", "mobile", "tablet"]
BRANDS = ["Apple", "Samsung", None, "Google"]
MODELS = ["iPhone", "Galaxy S23", None, "Pixel 8", " Chrome "]
OSES = ["Windows", "iOS", "Android", "Macintosh"]
BROWSERS = ["Chrome", "Safari", "Firefox", "Edge"]
REGIONS = ["New York", "California", "Texas", "Ohio", None]
CITIES = ["Brooklyn", "Austin", "Columbus", "San Diego", "Boston", "(not set)", " Miami "]
METROS = ["(not set)", "New York NY", "Austin TX"]
LIST_NAMES = ["(not set)", "Search Results", "", " Featured ", None, "Home"]
COLORS = ["Red", "Black", "White", "Blue", "Green"]
VARIANT_SIZES = ["S", "M", "L", "XL", "10", "8"]
DIM_SIZES = ["XS", "S", "M", "L", "XL", "10"]
GENDERS = ["FEMALE", "MALE", "UNISEX"]
# campaign names of the partnership rule and the list-view brand used by the testbed
TESTBED_PARTNERSHIP = ("creator collective",)
TESTBED_LIST_BRAND = "HOUSE"


def pick(values: list, idx: Column) -> Column:
    """``values[idx]`` with a 0-based index (a literal array lookup)."""
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), idx.cast("int") + 1)


def _s(c: Column) -> Column:
    return c.cast("string")


def _param(key: str, string=None, int_=None, double=None, float_=None, when: Column | None = None) -> Column:
    k = F.lit(key) if when is None else F.when(when, F.lit(key))
    none = F.lit(None).cast("string")
    v = F.struct(
        (string if string is not None else none).alias("string_value"),
        (int_ if int_ is not None else none).alias("int_value"),
        (double if double is not None else none).alias("double_value"),
        (float_ if float_ is not None else none).alias("float_value"),
    )
    return F.struct(k.alias("key"), v.alias("value"))


def _keep_keyed(arr: Column) -> Column:
    return F.filter(arr, lambda p: p["key"].isNotNull())


def sku(p_partkey: Column) -> Column:
    return F.when(p_partkey % 97 == 0, F.concat(F.lit("NVD"), _s(p_partkey))).otherwise(_s(p_partkey))


def title(p_partkey: Column, p_type: Column, p_name: Column) -> Column:
    return (F.when(p_type == "PROMO", F.concat(F.lit("Gift Card "), p_name))
            .when(p_partkey % 5 == 0, F.concat(F.lit("Women's "), p_name))
            .when(p_partkey % 5 == 1, F.concat(F.lit("Men's "), p_name))
            .otherwise(p_name))


def variant(p_partkey: Column) -> Column:
    color = pick(COLORS, (p_partkey / 5).cast("long") % 5)
    size = pick(VARIANT_SIZES, (p_partkey / 3).cast("long") % 6)
    m = p_partkey % 5
    return (F.when(m == 0, F.concat(color, F.lit(" / "), size))
            .when(m == 1, F.concat(F.lit("Classic / "), color, F.lit(" / "), size))
            .when(m == 2, F.lit("(not set)"))
            .when(m == 3, F.concat(size, F.lit(" / "), color))
            .otherwise(color))


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Event types whose order lines become the event's items.
ITEM_EVENTS = ["purchase", "click", "error"]


def lines_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order key, its lines in order) from lineitem x part, for orders that an event with items names.

    Lines stay as narrow as the tables hold them while they are shuffled; :func:`line_item` widens them
    where the feed is written."""
    wanted = _read(spark, sf_dir, "events").filter(F.col("event_type").isin(*ITEM_EVENTS)).select(
        F.col("event_id").alias("l_orderkey"))
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount")
    part = _read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    j = li.join(wanted, "l_orderkey", "left_semi").join(part, li.l_partkey == part.p_partkey, "left")
    # a total order of the lines (line numbers repeat within an order in the driver data)
    line = F.struct(F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"),
                    F.col("l_quantity").alias("q"), F.col("l_extendedprice").alias("e"), F.col("l_discount").alias("d"),
                    F.col("p_brand").alias("brand"), F.col("p_type").alias("type"), F.col("p_name").alias("name"),
                    F.col("p_partkey").alias("pk"))
    return j.groupBy(F.col("l_orderkey").alias("item_order")).agg(F.array_sort(F.collect_list(line)).alias("lines"))


def line_item(x: Column) -> Column:
    """The item of one order line."""
    pk, ln = x["pk"], x["n"]
    item_sku = sku(pk)
    pid = _param("item_product_id", string=_s(pk))
    vid = _param("item_variant_id", int_=_s(x["s"]))
    pos = _param("item_list_position", int_=_s(ln))
    m = ln % 7
    iparams = (F.when(m == 1, F.array(pid))
               .when(m == 2, F.array(pid, vid, pos))
               .when(m == 6, F.array().cast(PARAMS_TYPE))
               .otherwise(F.array(pid, vid)))
    return F.struct(
        x["brand"].alias("item_brand"),
        x["type"].alias("item_category"),
        F.when(ln == 3, F.concat(F.lit(" "), item_sku, F.lit(" "))).otherwise(item_sku).alias("item_id"),
        pick(LIST_NAMES, ln % 6).alias("item_list_name"),
        title(pk, x["type"], x["name"]).alias("item_name"),
        x["q"].cast("decimal(38,0)").alias("quantity"),
        (x["e"] / F.lit(10.0)).alias("price_in_usd"),
        iparams.alias("item_params"),
        variant(pk).alias("item_variant"),
        (x["e"] * (F.lit(1.0) - x["d"])).alias("item_revenue_in_usd"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw event feed (both days of the feed pair) derived from ``events``.

    Events and order lines meet as narrow rows; they are dealt and sorted by day before the columns are
    derived, so no wide row is shuffled or sorted, and a write by day makes a few files a day."""
    eid, u, etype = F.col("event_id"), F.col("user_id"), F.col("event_type")
    us = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("ts"))
    k = F.get_json_object("props", "$.k").cast("long")
    day = F.dayofmonth("ts")
    is_purchase = etype == "purchase"
    sid = _s(u * 100 + day)
    none = F.lit(None).cast("string")

    params = _keep_keyed(F.array(
        F.when(eid % 19 == 0, _param("ga_session_id", string=F.concat(F.lit(" "), sid)))
        .otherwise(_param("ga_session_id", int_=sid)),
        _param("ga_session_number", int_=_s(day)),
        _param("engagement_time_msec", int_=_s(k * 100), when=eid % 3 != 0),
        _param("visitor_type", string=F.when(eid % 2 == 0, F.lit("new")).otherwise(F.lit("returning"))),
        _param("page_location", string=F.concat(F.lit("https://shop.example/p/"), _s(eid % 50))),
        _param("page_title", string=F.when(eid % 13 == 0, F.lit("9")).otherwise(F.concat(F.lit("Title "), _s(u % 7)))),
        _param("page_title", string=F.lit("10"), when=eid % 13 == 0),
        _param("percent_scrolled", float_=F.lit("0.5"), when=eid % 5 == 1),
        _param("label", int_=_s(eid % 7), double=F.lit("1.5"), when=eid % 4 == 2),
        _param("currency", string=F.lit("USD"), when=is_purchase),
        _param("coupon", string=F.concat(F.lit(" SAVE"), _s(eid % 3)), when=is_purchase & (eid % 3 == 0)),
        _param("search_term", string=F.lit(" shoes "), when=eid % 10 == 3),
        _param("session_engaged", string=F.lit("1")),
    ))
    params = (F.when(eid % 41 == 0, F.lit(None).cast(PARAMS_TYPE))
              .when(eid % 23 == 0, F.array().cast(PARAMS_TYPE))
              .otherwise(params))

    name = (F.when(etype == "signup", F.lit("first_visit"))
            .when((etype == "view") & (eid % 43 == 0), none)
            .when(etype == "view", F.lit("page_view"))
            .when(etype == "error", F.lit("view_item_list"))
            .when(etype == "click", pick(CLICK_NAMES, eid % 10))
            .when(is_purchase & (eid % 29 == 0), F.lit("Purchase"))
            .when(is_purchase & (eid % 31 == 0), F.lit(" purchase "))
            .when(is_purchase, F.lit("purchase")))
    ts_raw = us - us % DAY_MICROS + NOON_MICROS + F.floor((us % DAY_MICROS) / TIME_SQUEEZE).cast("long")
    collected = eid % 4 == 0
    q = (eid / 4).cast("long")
    txn = (F.when(is_purchase & (eid % 11 == 0), F.lit("(not set)"))
           .when(is_purchase & (eid % 2 == 0), F.concat(F.lit(" "), _s(eid)))
           .when(is_purchase, _s(eid))
           .when((etype == "click") & (eid % 8 == 0), _s(eid)))
    cols = {
        "event_date": F.col("event_date"),
        "event_timestamp": ts_raw,
        "event_name": name,
        "event_bundle_sequence_id": eid,
        "user_id": (F.when(eid % 5 == 0, none)
                    .when(eid % 7 == 0, F.concat(F.lit(" c"), _s(u), F.lit(" ")))
                    .otherwise(F.concat(F.lit("c"), _s(u)))),
        "user_pseudo_id": F.when(eid % 17 == 0, none).otherwise(_s(u)),
        "is_active_user": eid % 9 != 0,
        "user_first_touch_timestamp": ts_raw - u * 3_600_000_000,
        "event_params": params,
        "platform": F.when(eid % 10 == 0, F.lit("IOS")).otherwise(F.lit("WEB")),
        "device_category": pick(DEVICE_CATEGORIES, u % 3),
        "device_mobile_brand_name": pick(BRANDS, u % 4),
        "device_mobile_model_name": pick(MODELS, u % 5),
        "device_operating_system": pick(OSES, u % 4),
        "device_operating_system_version": F.concat(F.lit("v"), _s(u % 6)),
        "device_language": F.when(u % 8 == 0, F.lit("es-us")).otherwise(F.lit("en-us")),
        "device_is_limited_ad_tracking": F.when(eid % 12 == 0, F.lit("Yes")).otherwise(F.lit("No")),
        "device_web_info_browser": pick(BROWSERS, u % 4),
        "device_web_info_browser_version": _s(u % 3 + 118),
        "geo_country": F.when(u % 10 == 0, F.lit("Canada")).otherwise(F.lit("United States")),
        "geo_region": pick(REGIONS, u % 5),
        "geo_city": pick(CITIES, u % 7),
        "geo_metro": pick(METROS, u % 3),
        "traffic_source_source": pick(SOURCES, u % 31),
        "traffic_source_medium": pick(MEDIUMS, (u * 7) % 31),
        "traffic_source_name": pick(CAMPAIGNS, (u * 5 + 3) % 16),
        "collected_traffic_source_manual_source": F.when(collected, pick(SOURCES, q % 31)),
        "collected_traffic_source_manual_medium": F.when(collected, pick(MEDIUMS, (q * 3 + 1) % 31)),
        "collected_traffic_source_manual_campaign_id": F.when(collected, F.concat(F.lit(" c"), _s(eid % 100))),
        "collected_traffic_source_manual_campaign_name": F.when(collected, pick(CAMPAIGNS, (q * 5) % 16)),
        "collected_traffic_source_manual_source_platform": F.when(collected, pick(PLATFORMS, q % 4)),
        "collected_traffic_source_manual_term": F.when(collected, F.concat(F.lit("Term"), _s(eid % 3))),
        "collected_traffic_source_manual_content": F.when(collected & (eid % 8 != 0), F.lit(" AD ")),
        "collected_traffic_source_gclid": F.when(eid % 6 == 0, F.concat(F.lit("gclid"), _s(u))),
        "session_traffic_source_last_click_manual_campaign_source": pick(SOURCES, (u + day) % 31),
        "session_traffic_source_last_click_manual_campaign_medium": pick(MEDIUMS, (u * 3 + day) % 31),
        "session_traffic_source_last_click_manual_campaign_campaign_id": F.concat(F.lit("lc"), _s((u + day) % 10)),
        "session_traffic_source_last_click_manual_campaign_campaign_name": pick(CAMPAIGNS, (u + day * 2) % 16),
        "session_traffic_source_last_click_manual_campaign_source_platform": pick(PLATFORMS, (u + day) % 4),
        "session_traffic_source_last_click_manual_campaign_term": none,
        "session_traffic_source_last_click_manual_campaign_content": F.lit("LC"),
        "ecommerce_transaction_id": txn,
        "ecommerce_unique_items": F.when(is_purchase, k % 5 + 1),
        "ecommerce_total_item_quantity": F.when(is_purchase, k),
        "ecommerce_purchase_revenue_in_usd": F.when(is_purchase, F.col("value")),
    }
    ev = _read(spark, sf_dir, "events").withColumn("event_date", F.to_date("ts"))
    lines = lines_by_order(spark, sf_dir)
    rows = (ev.join(lines, ev.event_id == lines.item_order, "left")
            .hint("rebalance", "event_date").sortWithinPartitions("event_date"))
    items = F.transform("lines", line_item)
    has_items = etype.isin(*ITEM_EVENTS) & F.col("lines").isNotNull()
    items_col = (F.when(has_items & (eid % 20 == 0), F.concat(items, F.slice(items, 1, 1)))
                 .when(has_items, items)
                 .otherwise(F.array().cast(rows.select(items).schema[0].dataType)))
    return rows.select(*[c.alias(n) for n, c in cols.items()], items_col.alias("items"))


def order_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    p = _read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # customers meet the orders, not their lines, and the part's texts come last: they are shuffled with no line
    o = o.join(c, o.o_custkey == c.c_custkey, "left").select("o_orderkey", "o_orderstatus", "c_nationkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "left").join(p, li.l_partkey == p.p_partkey, "left")
    ep, qty, ln = F.col("l_extendedprice"), F.col("l_quantity"), F.col("l_linenumber")
    d = "decimal(18,2)"
    return j.select(
        _s(F.col("l_orderkey")).alias("shopify_order_id"),
        sku(F.col("l_partkey")).alias("sku"),
        title(F.col("l_partkey"), F.col("p_type"), F.col("p_name")).alias("title"),
        F.when(F.col("p_type") == "PROMO", F.lit("GIFT CARD")).when(ln == 6, F.lit(None).cast("string"))
        .otherwise(F.lit("OTHERS")).alias("gift_card_flag"),
        qty.cast("long").alias("quantity"),
        # money is exact in decimals (no double rounding), so every engine gets the same cents
        ep.cast(d).alias("gross_sales"),
        (ep.cast(d) - qty.cast(d)).cast(d).alias("gsnd"),
        (ep.cast(d) + (qty * 0.5).cast(d)).cast(d).alias("gross_merchandise_value"),
        (qty * 0.25).cast(d).alias("shipping_price"),
        (qty * 0.75).cast(d).alias("total_tax"),
        F.when(ln == 4, F.lit(None).cast(d)).otherwise((qty * 0.5).cast(d)).alias("vat_value"),
        F.when(F.col("o_orderstatus") == "P", F.lit("RETURN")).otherwise(F.lit("ORDER")).alias("sale_kind"),
        F.when(F.col("c_nationkey") == 0, F.lit("CA")).otherwise(F.lit("US")).alias("country"),
    )


def customer_type_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    return o.select(_s(F.col("o_orderkey")).alias("shopify_order_id"),
                    F.when(F.col("o_custkey") % 4 == 0, F.lit("RETURN")).otherwise(F.lit("NEW")).alias("customer_type"))


def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    pk, size = F.col("p_partkey"), F.col("p_size")
    return p.select(
        sku(pk).alias("externalid"),
        F.col("p_brand").alias("division"),
        F.col("p_type").alias("product_category"),
        F.concat(F.col("p_type"), F.lit("-"), _s(size % 5)).alias("product_subcategory"),
        F.when(pk % 6 == 0, F.lit("Sports Bras")).when(pk % 6 == 1, F.lit(None).cast("string"))
        .otherwise(F.col("p_type")).alias("product_family"),
        F.col("p_name").alias("planning_parent"),
        pick(GENDERS, pk % 3).alias("gender"),
        F.when(size > 25, F.lit("FOOTWEAR")).otherwise(F.lit("APPAREL")).alias("strategic_business_unit"),
        F.when(size % 7 == 0, F.lit(None).cast("string")).otherwise(pick(DIM_SIZES, size % 6)).alias("product_size"),
    )


def settled_cutoff(spark: SparkSession, sf_dir: str):
    """Last day of the settled daily feed: (last event day - SETTLE_DAYS).  One scalar."""
    ev = _read(spark, sf_dir, "events")
    last = ev.agg(F.max(F.to_date("ts")).alias("d")).first()["d"]
    import datetime as _dt
    return last - _dt.timedelta(days=SETTLE_DAYS)


# How each derived input table is made.
DERIVED = {"raw": raw_events, "orders": order_fact, "customer_types": customer_type_fact, "products": product_dim}

# Derived input tables already written in this application: (app id, sf_dir, name) -> path.
_WRITTEN: dict[tuple[str, str, str], str] = {}
# Last settled days already found in this application: (app id, sf_dir) -> day.
_CUTOFFS: dict = {}


def _written_input(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Path of one derived input, written once per application into the shared checkpoint folder when
    it is first read: a query that reads the feed alone does not pay for the order fact.

    They stand for the stored export and lookup tables the builders read in
    production: the raw feed is partitioned by ``event_date`` (so watermark
    filters prune whole days), the lookups are plain Parquet.
    """
    from webtrail.session import shared_dir
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        import hashlib
        path = shared_dir(spark, "webtrail-inputs", hashlib.sha1(sf_dir.encode()).hexdigest()[:12], name)
        out = DERIVED[name](spark, sf_dir).write.mode("overwrite")
        (out.partitionBy("event_date") if name == "raw" else out).parquet(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


class Testbed:
    """All inputs of the builders, derived from one driver data directory.

    ``materialize=True`` (default) reads the derived tables, each written once per
    application; ``False`` derives them lazily in every plan.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self.materialize = materialize

    @property
    def raw(self) -> DataFrame:
        if not self.materialize:
            return raw_events(self.spark, self.sf_dir)
        df = self.spark.read.parquet(_written_input(self.spark, self.sf_dir, "raw"))
        cols = [c for c in df.columns if c != "event_date"]
        return df.select("event_date", *cols)

    @property
    def cutoff(self):
        if not self.materialize:
            return settled_cutoff(self.spark, self.sf_dir)
        key = (self.spark.sparkContext.applicationId, self.sf_dir)
        if key not in _CUTOFFS:
            _CUTOFFS[key] = settled_cutoff(self.spark, self.sf_dir)
        return _CUTOFFS[key]

    def daily_feed(self) -> DataFrame:
        """Settled days only (what the daily tables were built from)."""
        return self.raw.filter(F.col("event_date") <= F.lit(self.cutoff))

    def intraday_feed(self) -> DataFrame:
        """Provisional feed: the last day of the settled feed and every later day."""
        return self.raw.filter(F.col("event_date") >= F.lit(self.cutoff))

    def _lookup(self, name: str) -> DataFrame:
        if not self.materialize:
            return DERIVED[name](self.spark, self.sf_dir)
        return self.spark.read.parquet(_written_input(self.spark, self.sf_dir, name))

    def orders(self) -> DataFrame:
        return self._lookup("orders")

    def customer_types(self) -> DataFrame:
        return self._lookup("customer_types")

    def products(self) -> DataFrame:
        return self._lookup("products")
