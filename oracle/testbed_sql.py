"""The testbed adapters of :mod:`webtrail.sources.testbed` as DuckDB SQL CTEs.

Same arithmetic, same literal lists; the result tables are ``raw`` (whole feed),
``raw_daily``, ``raw_intraday``, ``order_fact``, ``customer_type_fact`` and
``product_dim``.
"""

from __future__ import annotations

from oracle.rulesql import lit
from webtrail.sources import testbed as tb


def pick(values: list, idx: str) -> str:
    return "[" + ", ".join(f"CAST({lit(v)} AS VARCHAR)" for v in values) + f"][({idx}) + 1]"


def _param(key: str, string="NULL", int_="NULL", double="NULL", float_="NULL", when: str | None = None) -> str:
    k = lit(key) if when is None else f"CASE WHEN {when} THEN {lit(key)} END"
    return ("{'key': CAST(" + k + " AS VARCHAR), 'value': {"
            f"'string_value': CAST({string} AS VARCHAR), 'int_value': CAST({int_} AS VARCHAR), "
            f"'double_value': CAST({double} AS VARCHAR), 'float_value': CAST({float_} AS VARCHAR)" + "}}")


def _sku(pk: str) -> str:
    return f"CASE WHEN {pk} % 97 = 0 THEN 'NVD' || CAST({pk} AS VARCHAR) ELSE CAST({pk} AS VARCHAR) END"


def _title(pk: str, ptype: str, pname: str) -> str:
    return (f"CASE WHEN {ptype} = 'PROMO' THEN 'Gift Card ' || {pname} WHEN {pk} % 5 = 0 THEN 'Women''s ' || {pname}"
            f" WHEN {pk} % 5 = 1 THEN 'Men''s ' || {pname} ELSE {pname} END")


def _variant(pk: str) -> str:
    color = pick(tb.COLORS, f"({pk} // 5) % 5")
    size = pick(tb.VARIANT_SIZES, f"({pk} // 3) % 6")
    return (f"CASE WHEN {pk} % 5 = 0 THEN {color} || ' / ' || {size}"
            f" WHEN {pk} % 5 = 1 THEN 'Classic / ' || {color} || ' / ' || {size}"
            f" WHEN {pk} % 5 = 2 THEN '(not set)'"
            f" WHEN {pk} % 5 = 3 THEN {size} || ' / ' || {color} ELSE {color} END")


def ctes() -> list[str]:
    pk, ln = "p.p_partkey", "l.l_linenumber"
    pid = _param("item_product_id", string=f"CAST({pk} AS VARCHAR)")
    vid = _param("item_variant_id", int_="CAST(l.l_suppkey AS VARCHAR)")
    pos = _param("item_list_position", int_=f"CAST({ln} AS VARCHAR)")
    iparams = (f"CASE WHEN {ln} % 7 = 1 THEN [{pid}] WHEN {ln} % 7 = 2 THEN [{pid}, {vid}, {pos}]"
               f" WHEN {ln} % 7 = 6 THEN list_filter([{pid}], lambda x: false) ELSE [{pid}, {vid}] END")
    item = ("{"
            f"'item_brand': p.p_brand, 'item_category': p.p_type, "
            f"'item_id': CASE WHEN {ln} = 3 THEN ' ' || {_sku(pk)} || ' ' ELSE {_sku(pk)} END, "
            f"'item_list_name': {pick(tb.LIST_NAMES, f'{ln} % 6')}, "
            f"'item_name': {_title(pk, 'p.p_type', 'p.p_name')}, "
            f"'quantity': CAST(l.l_quantity AS DECIMAL(38,0)), "
            f"'price_in_usd': l.l_extendedprice / 10.0, "
            f"'item_params': {iparams}, "
            f"'item_variant': {_variant(pk)}, "
            f"'item_revenue_in_usd': l.l_extendedprice * (1.0 - l.l_discount)"
            "}")
    items_by_order = (
        "items_by_order AS (SELECT l.l_orderkey AS item_order, "
        f"list({item} ORDER BY {ln}, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice, l.l_discount) AS items "
        "FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey GROUP BY l.l_orderkey)"
    )
    eid, u = "e.event_id", "e.user_id"
    is_p = "e.event_type = 'purchase'"
    sid = f"CAST({u} * 100 + e.dd AS VARCHAR)"
    params = "list_filter([" + ", ".join([
        f"CASE WHEN {eid} % 19 = 0 THEN {_param('ga_session_id', string="' ' || " + sid)}"
        f" ELSE {_param('ga_session_id', int_=sid)} END",
        _param("ga_session_number", int_="CAST(e.dd AS VARCHAR)"),
        _param("engagement_time_msec", int_="CAST(e.k * 100 AS VARCHAR)", when=f"{eid} % 3 <> 0"),
        _param("visitor_type", string=f"CASE WHEN {eid} % 2 = 0 THEN 'new' ELSE 'returning' END"),
        _param("page_location", string=f"'https://shop.example/p/' || CAST({eid} % 50 AS VARCHAR)"),
        _param("page_title", string=f"CASE WHEN {eid} % 13 = 0 THEN '9' ELSE 'Title ' || CAST({u} % 7 AS VARCHAR) END"),
        _param("page_title", string="'10'", when=f"{eid} % 13 = 0"),
        _param("percent_scrolled", float_="'0.5'", when=f"{eid} % 5 = 1"),
        _param("label", int_=f"CAST({eid} % 7 AS VARCHAR)", double="'1.5'", when=f"{eid} % 4 = 2"),
        _param("currency", string="'USD'", when=is_p),
        _param("coupon", string=f"' SAVE' || CAST({eid} % 3 AS VARCHAR)", when=f"{is_p} AND {eid} % 3 = 0"),
        _param("search_term", string="' shoes '", when=f"{eid} % 10 = 3"),
        _param("session_engaged", string="'1'"),
    ]) + "], lambda p: p['key'] IS NOT NULL)"
    params = (f"CASE WHEN {eid} % 41 = 0 THEN NULL WHEN {eid} % 23 = 0 THEN list_filter({params}, lambda p: false)"
              f" ELSE {params} END")
    name = (f"CASE WHEN e.event_type = 'signup' THEN 'first_visit'"
            f" WHEN e.event_type = 'view' AND {eid} % 43 = 0 THEN NULL"
            f" WHEN e.event_type = 'view' THEN 'page_view'"
            f" WHEN e.event_type = 'error' THEN 'view_item_list'"
            f" WHEN e.event_type = 'click' THEN {pick(tb.CLICK_NAMES, f'{eid} % 10')}"
            f" WHEN {is_p} AND {eid} % 29 = 0 THEN 'Purchase'"
            f" WHEN {is_p} AND {eid} % 31 = 0 THEN ' purchase '"
            f" WHEN {is_p} THEN 'purchase' END")
    D, N, S = tb.DAY_MICROS, tb.NOON_MICROS, tb.TIME_SQUEEZE
    ts_raw = f"(e.us - e.us % {D} + {N} + (e.us % {D}) // {S})"
    coll = f"{eid} % 4 = 0"
    q = f"({eid} // 4)"
    txn = (f"CASE WHEN {is_p} AND {eid} % 11 = 0 THEN '(not set)'"
           f" WHEN {is_p} AND {eid} % 2 = 0 THEN ' ' || CAST({eid} AS VARCHAR)"
           f" WHEN {is_p} THEN CAST({eid} AS VARCHAR)"
           f" WHEN e.event_type = 'click' AND {eid} % 8 = 0 THEN CAST({eid} AS VARCHAR) END")
    cols = {
        "event_date": "CAST(e.ts AS DATE)",
        "event_timestamp": ts_raw,
        "event_name": name,
        "event_bundle_sequence_id": eid,
        "user_id": (f"CASE WHEN {eid} % 5 = 0 THEN NULL WHEN {eid} % 7 = 0 THEN ' c' || CAST({u} AS VARCHAR) || ' '"
                    f" ELSE 'c' || CAST({u} AS VARCHAR) END"),
        "user_pseudo_id": f"CASE WHEN {eid} % 17 = 0 THEN NULL ELSE CAST({u} AS VARCHAR) END",
        "is_active_user": f"({eid} % 9 <> 0)",
        "user_first_touch_timestamp": f"({ts_raw} - {u} * 3600000000)",
        "event_params": params,
        "platform": f"CASE WHEN {eid} % 10 = 0 THEN 'IOS' ELSE 'WEB' END",
        "device_category": pick(tb.DEVICE_CATEGORIES, f"{u} % 3"),
        "device_mobile_brand_name": pick(tb.BRANDS, f"{u} % 4"),
        "device_mobile_model_name": pick(tb.MODELS, f"{u} % 5"),
        "device_operating_system": pick(tb.OSES, f"{u} % 4"),
        "device_operating_system_version": f"'v' || CAST({u} % 6 AS VARCHAR)",
        "device_language": f"CASE WHEN {u} % 8 = 0 THEN 'es-us' ELSE 'en-us' END",
        "device_is_limited_ad_tracking": f"CASE WHEN {eid} % 12 = 0 THEN 'Yes' ELSE 'No' END",
        "device_web_info_browser": pick(tb.BROWSERS, f"{u} % 4"),
        "device_web_info_browser_version": f"CAST({u} % 3 + 118 AS VARCHAR)",
        "geo_country": f"CASE WHEN {u} % 10 = 0 THEN 'Canada' ELSE 'United States' END",
        "geo_region": pick(tb.REGIONS, f"{u} % 5"),
        "geo_city": pick(tb.CITIES, f"{u} % 7"),
        "geo_metro": pick(tb.METROS, f"{u} % 3"),
        "traffic_source_source": pick(tb.SOURCES, f"{u} % 31"),
        "traffic_source_medium": pick(tb.MEDIUMS, f"({u} * 7) % 31"),
        "traffic_source_name": pick(tb.CAMPAIGNS, f"({u} * 5 + 3) % 16"),
        "collected_traffic_source_manual_source": f"CASE WHEN {coll} THEN {pick(tb.SOURCES, f'{q} % 31')} END",
        "collected_traffic_source_manual_medium": f"CASE WHEN {coll} THEN {pick(tb.MEDIUMS, f'({q} * 3 + 1) % 31')} END",
        "collected_traffic_source_manual_campaign_id": f"CASE WHEN {coll} THEN ' c' || CAST({eid} % 100 AS VARCHAR) END",
        "collected_traffic_source_manual_campaign_name": f"CASE WHEN {coll} THEN {pick(tb.CAMPAIGNS, f'({q} * 5) % 16')} END",
        "collected_traffic_source_manual_source_platform": f"CASE WHEN {coll} THEN {pick(tb.PLATFORMS, f'{q} % 4')} END",
        "collected_traffic_source_manual_term": f"CASE WHEN {coll} THEN 'Term' || CAST({eid} % 3 AS VARCHAR) END",
        "collected_traffic_source_manual_content": f"CASE WHEN {coll} AND {eid} % 8 <> 0 THEN ' AD ' END",
        "collected_traffic_source_gclid": f"CASE WHEN {eid} % 6 = 0 THEN 'gclid' || CAST({u} AS VARCHAR) END",
        "session_traffic_source_last_click_manual_campaign_source": pick(tb.SOURCES, f"({u} + e.dd) % 31"),
        "session_traffic_source_last_click_manual_campaign_medium": pick(tb.MEDIUMS, f"({u} * 3 + e.dd) % 31"),
        "session_traffic_source_last_click_manual_campaign_campaign_id": f"'lc' || CAST(({u} + e.dd) % 10 AS VARCHAR)",
        "session_traffic_source_last_click_manual_campaign_campaign_name": pick(tb.CAMPAIGNS, f"({u} + e.dd * 2) % 16"),
        "session_traffic_source_last_click_manual_campaign_source_platform": pick(tb.PLATFORMS, f"({u} + e.dd) % 4"),
        "session_traffic_source_last_click_manual_campaign_term": "CAST(NULL AS VARCHAR)",
        "session_traffic_source_last_click_manual_campaign_content": "'LC'",
        "ecommerce_transaction_id": txn,
        "ecommerce_unique_items": f"CASE WHEN {is_p} THEN e.k % 5 + 1 END",
        "ecommerce_total_item_quantity": f"CASE WHEN {is_p} THEN e.k END",
        "ecommerce_purchase_revenue_in_usd": f"CASE WHEN {is_p} THEN e.value END",
    }
    has_items = "e.event_type IN ('purchase', 'click', 'error') AND i.items IS NOT NULL"
    items_col = (f"CASE WHEN {has_items} AND {eid} % 20 = 0 THEN list_concat(i.items, i.items[1:1])"
                 f" WHEN {has_items} THEN i.items ELSE list_filter(i.items, lambda x: false) END")
    raw = ("raw AS (SELECT " + ", ".join(f"{v} AS {k}" for k, v in cols.items())
           + f", coalesce({items_col}, list_filter((SELECT items FROM items_by_order LIMIT 1), lambda x: false)) AS items"
           " FROM (SELECT *, epoch_us(ts) AS us, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,"
           " day(ts) AS dd FROM events) e LEFT JOIN items_by_order i ON e.event_id = i.item_order)")
    cutoff = f"((SELECT max(CAST(ts AS DATE)) FROM events) - {tb.SETTLE_DAYS})"
    feeds = [
        f"raw_daily AS (SELECT * FROM raw WHERE event_date <= {cutoff})",
        f"raw_intraday AS (SELECT * FROM raw WHERE event_date >= {cutoff})",
    ]
    d = "DECIMAL(18,2)"
    order_fact = (
        "order_fact AS (SELECT CAST(l.l_orderkey AS VARCHAR) AS shopify_order_id, "
        f"{_sku('l.l_partkey')} AS sku, {_title('l.l_partkey', 'p.p_type', 'p.p_name')} AS title, "
        "CASE WHEN p.p_type = 'PROMO' THEN 'GIFT CARD' WHEN l.l_linenumber = 6 THEN NULL ELSE 'OTHERS' END AS gift_card_flag, "
        "CAST(l.l_quantity AS BIGINT) AS quantity, "
        f"CAST(l.l_extendedprice AS {d}) AS gross_sales, "
        f"CAST(CAST(l.l_extendedprice AS {d}) - CAST(l.l_quantity AS {d}) AS {d}) AS gsnd, "
        f"CAST(CAST(l.l_extendedprice AS {d}) + CAST(l.l_quantity * 0.5 AS {d}) AS {d}) AS gross_merchandise_value, "
        f"CAST(l.l_quantity * 0.25 AS {d}) AS shipping_price, "
        f"CAST(l.l_quantity * 0.75 AS {d}) AS total_tax, "
        f"CASE WHEN l.l_linenumber = 4 THEN NULL ELSE CAST(l.l_quantity * 0.5 AS {d}) END AS vat_value, "
        "CASE WHEN o.o_orderstatus = 'P' THEN 'RETURN' ELSE 'ORDER' END AS sale_kind, "
        "CASE WHEN c.c_nationkey = 0 THEN 'CA' ELSE 'US' END AS country "
        "FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey "
        "LEFT JOIN part p ON l.l_partkey = p.p_partkey LEFT JOIN customer c ON o.o_custkey = c.c_custkey)"
    )
    ctf = ("customer_type_fact AS (SELECT CAST(o_orderkey AS VARCHAR) AS shopify_order_id, "
           "CASE WHEN o_custkey % 4 = 0 THEN 'RETURN' ELSE 'NEW' END AS customer_type FROM orders)")
    pdim = (
        "product_dim AS (SELECT "
        f"{_sku('p_partkey')} AS externalid, p_brand AS division, p_type AS product_category, "
        "p_type || '-' || CAST(p_size % 5 AS VARCHAR) AS product_subcategory, "
        "CASE WHEN p_partkey % 6 = 0 THEN 'Sports Bras' WHEN p_partkey % 6 = 1 THEN NULL ELSE p_type END AS product_family, "
        "p_name AS planning_parent, "
        f"{pick(tb.GENDERS, 'p_partkey % 3')} AS gender, "
        "CASE WHEN p_size > 25 THEN 'FOOTWEAR' ELSE 'APPAREL' END AS strategic_business_unit, "
        f"CASE WHEN p_size % 7 = 0 THEN NULL ELSE {pick(tb.DIM_SIZES, 'p_size % 6')} END AS product_size "
        "FROM part)"
    )
    return [items_by_order, raw, *feeds, order_fact, ctf, pdim]
