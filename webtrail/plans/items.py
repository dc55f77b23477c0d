"""The items table: one row per product touched by an event, three branches.

* browse   - events other than list views and purchases; identical items of an
  event collapse; an item needs at least one param; no money.
* purchase - one row per (order, item key) in the batch: the kept param row is
  the one with the highest price (nulls first), revenue is the sum over all
  (item x param) rows / 2, money comes from the order fact by item key.
* list view - view_item_list rows grouped by day, hour, user, session, product
  attributes and list name.

The purchase dedup is a grouped ``min_by`` (partial aggregation map-side)
instead of a ranked window, so one order with many lines, or all purchases
without an order id, never sit in one unsorted window partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webtrail.functions.params import has_params, param, param_value
from webtrail.functions.rules import product_gender
from webtrail.functions.scalars import (blank_to_null, item_key, not_set_to_null, unique_session_id,
                                        unique_user_id, variant_color_size)
from webtrail.operators.joins import salted_key
from webtrail.operators.orders import batch_order_ids, order_item_money, orders_in_batch
from webtrail.plans.common import local_times, number_batch, typed_feed
from webtrail.schema import ITEM_EVENT_PARAM_KEYS, ITEM_PARAM_KEYS, FeedOptions

# Event names of the branches and list names that mean "no list".
LIST_VIEW = "view_item_list"
PURCHASE = "purchase"
NO_LIST = ("", "(not set)")

DIM_COLUMNS = ["division", "product_category", "product_subcategory", "product_family", "planning_parent"]
ITEMS_COLUMNS = ["event_date", "event_timestamp", "hourofday", "s_no", "event_name", "user_id", "user_pseudo_id",
                 "unique_user_id", "is_active_user", "ga_session_id", "unique_session_id", "ga_session_number",
                 "shopify_order_id", "page_location", "coupon", "item_brand", "item_id"] + DIM_COLUMNS + [
                 "gender", "strategic_business_unit", "item_list_name", "item_name", "item_variant", "quantity",
                 "price_in_usd", "item_revenue_in_usd", "total_tax", "shipping", "gross_sales", "gsnd", "gmv",
                 "item_product_id", "item_variant_id", "color", "size"]
EVENT_COLUMNS = ["event_date", "event_timestamp", "hourofday", "s_no", "event_name", "user_id", "user_pseudo_id",
                 "unique_user_id", "is_active_user", "ga_session_id", "unique_session_id", "ga_session_number",
                 "shopify_order_id", "page_location", "coupon"]
ITEM_FIELDS = [("item_brand", "string"), ("item_category", "string"), ("item_id", "string"),
               ("item_list_name", "string"), ("item_name", "string"), ("quantity", "decimal(38,0)"),
               ("price_in_usd", "double"), ("item_variant", "string"), ("item_revenue_in_usd", "double")]
RAW_COLUMNS = ["event_date", "event_timestamp", "event_name", "event_bundle_sequence_id", "user_id",
               "user_pseudo_id", "is_active_user", "event_params", "ecommerce_transaction_id", "items"]
MONEY = ["total_tax", "shipping", "gross_sales", "gsnd", "gmv"]


def typed_items(items: Column) -> Column:
    """Items reduced to the extracted, typed fields plus their params."""
    return F.transform(items, lambda i: F.struct(
        *[i[f].cast(t).alias(f) for f, t in ITEM_FIELDS], i["item_params"].alias("item_params")))


def item_events(raw_batch: DataFrame, opts: FeedOptions, numbered: DataFrame | None = None) -> DataFrame:
    """Events with items and params; ``s_no`` counts every event of the batch."""
    raw = typed_feed(raw_batch.select(*RAW_COLUMNS))
    # all that is read of the arrays; a batch that only items read is numbered without the rest of them
    read = {"__has_params": has_params("event_params"), "items": typed_items(F.col("items")),
            **{k: param("event_params", k, trim_values=True) for k in ITEM_EVENT_PARAM_KEYS}}
    numbered = (number_batch(raw, instead_of_params=read) if numbered is None
                else numbered.select(*RAW_COLUMNS, "s_no").withColumns(read))
    ev = numbered.filter((F.size("items") > 0) & F.col("__has_params")).withColumns({
        **local_times(raw, opts),
        "event_name": F.trim("event_name"),
        "user_id": F.trim("user_id"),
        "user_pseudo_id": F.trim(F.col("user_pseudo_id").cast("string")),
        "shopify_order_id": not_set_to_null("ecommerce_transaction_id"),
    })
    return ev.withColumns({
        "hourofday": F.hour("event_timestamp"),
        "unique_user_id": unique_user_id("user_pseudo_id", "user_id"),
        "unique_session_id": unique_session_id("ga_session_id", "user_pseudo_id", "user_id"),
    }).select(*EVENT_COLUMNS, "items")


def unique_products(dim: DataFrame) -> DataFrame:
    """The dimension, which must hold each ``externalid`` once: a repeated one would double items and
    money, so the run that reads it fails and names it.  The check shuffles the dimension on the key
    that the join uses anyway."""
    values = [c for c in dim.columns if c != "externalid"]
    found = dim.filter(F.col("externalid").isNotNull()).groupBy("externalid").agg(
        F.count(F.lit(1)).alias("__n"), F.first(F.struct(*values)).alias("__v"))
    message = F.concat(F.lit("product dimension: externalid "), F.col("externalid"), F.lit(" is not unique"))
    key = F.when(F.col("__n") == 1, F.col("externalid")).otherwise(F.raise_error(message).cast("string"))
    return found.select(key.alias("externalid"), "__v.*")


def _product(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Left join of the product dimension on trim(item_id) (J8) and the gender rule.

    Items without an id get keys of their own that match nothing, so they spread over
    the tasks; a best seller's rows are split by AQE (a left join may split its left
    side).  Whether the dimension is broadcast is left to Spark's size estimate."""
    d = unique_products(dim).select("externalid", *DIM_COLUMNS, F.col("gender").alias("__dim_gender"),
                                    "strategic_business_unit")
    key = salted_key(F.trim("__item_id_raw"), F.xxhash64("s_no", "__item_name_raw"))
    j = df.withColumn("__product_key", key).join(d, F.col("__product_key") == d["externalid"], "left").drop("__product_key")
    return j.withColumn("gender", product_gender(F.col("externalid"), F.col("__item_name_raw"), F.col("__dim_gender")))


def _explode_items(ev: DataFrame, distinct: bool, with_pos: bool = False) -> DataFrame:
    items = F.array_distinct("items") if distinct else F.col("items")
    if with_pos:
        ex = ev.select(*EVENT_COLUMNS, F.posexplode(items).alias("__item_pos", "__it"))
    else:
        ex = ev.select(*EVENT_COLUMNS, F.explode(items).alias("__it"))
    it = F.col("__it")
    return ex.withColumns({
        "item_brand": it["item_brand"], "__item_id_raw": it["item_id"], "__list_raw": it["item_list_name"],
        "__item_name_raw": it["item_name"], "quantity": it["quantity"], "price_in_usd": it["price_in_usd"],
        "item_params": it["item_params"], "__variant_raw": it["item_variant"],
        "item_revenue_in_usd": it["item_revenue_in_usd"],
    }).drop("__it")


def _item_text(df: DataFrame) -> DataFrame:
    color, size = variant_color_size(F.col("__variant_raw"), F.col("product_family"))
    return df.withColumns({
        "item_id": F.trim("__item_id_raw"),
        "item_list_name": blank_to_null("__list_raw"),
        "item_name": F.trim("__item_name_raw"),
        "item_variant": blank_to_null("__variant_raw"),
        "color": color,
        "size": size,
    })


def browse_items(ev: DataFrame, dim: DataFrame) -> DataFrame:
    """B1: equal items of an event collapse (distinct before explode); an item needs params."""
    b = ev.filter(~F.col("event_name").isin(LIST_VIEW, PURCHASE))
    ex = _explode_items(b, distinct=True).filter(has_params("item_params"))
    ex = ex.withColumns({k: param("item_params", k, trim_values=True) for k in ITEM_PARAM_KEYS})
    out = _item_text(_product(ex, dim))
    none = F.lit(None)
    return out.withColumns({c: none.cast("decimal(28,2)") for c in MONEY})


def purchase_rows(ev: DataFrame) -> DataFrame:
    """Purchase events exploded to (item x param) rows, with the item key."""
    p = ev.filter(F.col("event_name") == PURCHASE)
    ex = _explode_items(p, distinct=False, with_pos=True)
    return ex.select("*", F.posexplode("item_params").alias("__param_pos", "__ip")).withColumns({
        "__item_key": item_key(F.col("__item_name_raw"), F.col("__item_id_raw")),
        "__pkey": F.col("__ip")["key"],
        "__pval": param_value(F.col("__ip"), trim=True),
    }).drop("item_params", "__ip")


def purchase_dedup(rows: DataFrame) -> DataFrame:
    """W5/W6 as one grouped aggregate per (order, item key): revenue = sum / 2 over
    all rows; the kept row has the highest price (a null price counts as highest),
    then the lowest s_no, item and param position."""
    keep = [c for c in rows.columns if c not in ("shopify_order_id", "__item_key", "item_revenue_in_usd")]
    rank = F.struct((F.col("price_in_usd").isNotNull()).alias("a"), (-F.col("price_in_usd")).alias("b"),
                    F.col("s_no").alias("c"), F.col("__item_pos").alias("d"), F.col("__param_pos").alias("e"))
    g = rows.groupBy("shopify_order_id", "__item_key").agg(
        (F.sum("item_revenue_in_usd") / 2).alias("item_revenue_in_usd"),
        F.min_by(F.struct(*[F.col(c) for c in keep]), rank).alias("__r"),
    )
    g = g.select("shopify_order_id", "__item_key", "item_revenue_in_usd", "__r.*")
    return g.withColumns({k: F.when(F.col("__pkey") == k, F.col("__pval")) for k in ITEM_PARAM_KEYS})


def attach_item_money(g: DataFrame, orders: DataFrame, ids: DataFrame) -> DataFrame:
    """Order-line money by (order, item key); quantity from the order fact first."""
    money = order_item_money(orders_in_batch(orders, ids)).select(
        "shopify_order_id", "sku", F.col("quantity").alias("__shp_qty"), "total_tax", "shipping", "gross_sales",
        "gsnd", "gmv")
    # ``g`` has each (order, item key) once, so nulls pile up nowhere and the pair is the key as it is: ``g`` is
    # dealt by it already and not shuffled again
    money = money.withColumnsRenamed({"shopify_order_id": "__money_order", "sku": "__money_key"})
    j = g.join(money, (F.col("shopify_order_id") == F.col("__money_order")) & (F.col("__item_key") == F.col("__money_key")),
               "left").drop("__money_order", "__money_key")
    return j.withColumn("quantity", F.coalesce(F.col("__shp_qty").cast("decimal(38,0)"), F.col("quantity")))


def purchase_items(ev: DataFrame, orders: DataFrame, ids: DataFrame, dim: DataFrame) -> DataFrame:
    """B2: one row per (order, item key) of the batch's purchases."""
    return _item_text(_product(attach_item_money(purchase_dedup(purchase_rows(ev)), orders, ids), dim))


def list_view_items(ev: DataFrame, dim: DataFrame, brand: str | None) -> DataFrame:
    """List views grouped by day, hour, user, session, product attributes and list name."""
    lv = ev.filter(F.col("event_name") == LIST_VIEW)
    ex = _explode_items(lv, distinct=False).filter(~F.col("__list_raw").isin(*NO_LIST) & F.col("__list_raw").isNotNull())
    j = _product(ex, dim).withColumn("item_list_name", F.trim("__list_raw"))
    keys = ["event_date", "hourofday", "event_name", "unique_user_id", "unique_session_id"] + DIM_COLUMNS + [
        "gender", "strategic_business_unit", "item_list_name"]
    g = j.groupBy(*keys).agg(
        F.min("event_timestamp").alias("event_timestamp"),
        F.min("s_no").alias("s_no"),
        F.max("user_id").alias("user_id"),
        F.max("user_pseudo_id").alias("user_pseudo_id"),
        F.min("is_active_user").alias("is_active_user"),
        F.max("ga_session_id").alias("ga_session_id"),
        F.min("ga_session_number").alias("ga_session_number"),
        F.max("page_location").alias("page_location"),
    )
    s = T.StringType()
    return g.withColumns({
        "shopify_order_id": F.lit(None).cast(s), "coupon": F.lit(None).cast(s),
        "item_brand": F.lit(brand).cast(s), "item_id": F.lit(None).cast(s),
        "item_name": F.lit(None).cast(s), "item_variant": F.lit(None).cast(s),
        "quantity": F.lit(None).cast("decimal(38,0)"), "price_in_usd": F.lit(None).cast("double"),
        "item_revenue_in_usd": F.lit(None).cast("double"),
        **{c: F.lit(None).cast("decimal(28,2)") for c in MONEY},
        "item_product_id": F.lit(None).cast(s), "item_variant_id": F.lit(None).cast(s),
        "color": F.lit(None).cast(s), "size": F.lit(None).cast(s),
    })


def swap_color_size(df: DataFrame, dim: DataFrame) -> DataFrame:
    """When the colour is a known product size, colour and size change places.

    Rows without a colour get keys that match nothing and spread over the tasks;
    the few colours that many rows share are split by AQE, unless Spark's own
    size estimate broadcasts the size list.
    """
    # an expression as key: a join on the distinct's own partitioning could not be split by AQE
    sizes = dim.filter(F.col("product_size").isNotNull()).select("product_size").distinct().select(
        F.concat("product_size", F.lit("")).alias("__size_value"), F.lit(True).alias("__is_size"))
    key = salted_key(F.col("color"), F.xxhash64("s_no", "item_id", "item_variant"))
    j = df.withColumn("__color_key", key).join(sizes, F.col("__color_key") == F.col("__size_value"), "left")
    swap = F.coalesce(F.col("__is_size"), F.lit(False))
    return j.withColumns({
        "color": F.when(swap, F.col("size")).otherwise(F.col("color")),
        "size": F.when(swap, F.col("color")).otherwise(F.col("size")),
    }).drop("__size_value", "__is_size", "__color_key")


def build_items(raw_batch: DataFrame, orders: DataFrame, products: DataFrame,
                opts: FeedOptions = FeedOptions(), numbered: DataFrame | None = None) -> DataFrame:
    ids = batch_order_ids(raw_batch.select("event_name", "ecommerce_transaction_id"), purchase_only=False)
    ev = item_events(raw_batch, opts, numbered)
    parts = [browse_items(ev, products), purchase_items(ev, orders, ids, products),
             list_view_items(ev, products, opts.list_view_brand)]
    union = parts[0].select(*ITEMS_COLUMNS)
    for p in parts[1:]:
        union = union.unionByName(p.select(*ITEMS_COLUMNS))
    return swap_color_size(union, products).select(*ITEMS_COLUMNS)
