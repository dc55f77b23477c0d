"""Order money from the order fact (A1-A3) pre-filtered by the batch's ids.

The order fact holds every order line ever sold; a batch touches few of them.
The batch's distinct transaction ids are semi-joined first, so only the lines
of those orders reach the aggregation (and the aggregation is partial, map-side).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Which order lines count.
SALE_KIND_ORDER = "ORDER"
COUNTRY = "US"
FLAG_OTHERS = "OTHERS"
FLAG_GIFT = "GIFT CARD"
NO_ITEM = "NA"


def batch_order_ids(raw_batch: DataFrame, purchase_only: bool = False) -> DataFrame:
    """Distinct trimmed transaction ids seen in the batch (optionally purchases only)."""
    ids = raw_batch
    if purchase_only:
        ids = ids.filter(F.trim("event_name") == "purchase")
    ids = ids.select(F.trim("ecommerce_transaction_id").alias("shopify_order_id"))
    return ids.filter(F.col("shopify_order_id").isNotNull()).distinct()


def id_bounds(ids: DataFrame) -> tuple[str | None, str | None]:
    """Least and greatest id of the batch (one row is collected); read from stored ids."""
    return tuple(ids.agg(F.min("shopify_order_id"), F.max("shopify_order_id")).first())


def orders_in_batch(orders: DataFrame, ids: DataFrame, bounds: tuple[str | None, str | None] | None = None) -> DataFrame:
    """Order lines of kept orders (US sales) whose id appears in ``ids`` (left semi join).

    ``bounds`` of the ids become filters of the scan: ids grow with time, so the row groups of
    orders long before the batch are skipped by their statistics instead of read and joined."""
    kept = orders.filter((F.col("sale_kind") == SALE_KIND_ORDER) & (F.col("country") == COUNTRY))
    if bounds is not None:
        low, high = bounds
        kept = kept.filter(F.lit(False) if low is None else F.col("shopify_order_id").between(low, high))
    return kept.join(ids, "shopify_order_id", "left_semi")


def _money() -> list[Column]:
    return [
        F.sum("quantity").alias("quantity"),
        F.sum("gross_sales").alias("gross_sales"),
        F.sum("gsnd").alias("gsnd"),
        F.sum("gross_merchandise_value").alias("gmv"),
        F.sum("shipping_price").alias("shipping"),
        # row-wise first: a null in either column drops that line's tax
        F.sum(F.col("total_tax") + F.col("vat_value")).alias("total_tax"),
    ]


def unique_item_key() -> Column:
    return (F.when(F.col("gift_card_flag") == FLAG_OTHERS, F.col("sku"))
            .when(F.col("gift_card_flag") == FLAG_GIFT, F.lower("title"))
            .otherwise(F.lit(NO_ITEM)))


def order_money(lines: DataFrame, with_unique_items: bool = True) -> DataFrame:
    """Per order: quantity, unique items, gross sales, gsnd, gmv, shipping, total tax."""
    aggs = _money()
    if with_unique_items:
        aggs.insert(1, F.count_distinct(unique_item_key()).alias("unique_items"))
    return lines.groupBy("shopify_order_id").agg(*aggs)


def order_item_money(lines: DataFrame) -> DataFrame:
    """Per (order, item key); the key is lower(title) for gift cards, else the sku."""
    key = F.when(F.col("gift_card_flag") == FLAG_GIFT, F.lower("title")).otherwise(F.col("sku"))
    return lines.groupBy("shopify_order_id", key.alias("sku")).agg(*_money())
