"""DuckDB SQL for the table models: a literal, row-by-row formulation (explode,
pivot by GROUP BY, rank windows, range joins) used as the cross-check of the
Spark builders, which take the shorter paths (array expressions, min_by/max_by,
exploded date keys).
"""

from __future__ import annotations

from oracle.rulesql import channel_sql, medium_sql, source_sql
from webtrail.schema import (COLLECTED, CT, EVENT_PARAM_KEYS, LAST_CLICK, LC, LOWERED_TRAFFIC, TS_TRAFFIC,
                             SESSION_COUNTERS, SESSION_DIMENSIONS, DEVICE_GEO, GCLID, ITEM_EVENT_PARAM_KEYS,
                             ITEM_PARAM_KEYS, PURCHASE_PARAM_KEYS)
from webtrail.sources import testbed as tb

ZONE = "America/New_York"
NO_MARK = "DATE '1900-01-01'"
TRAFFIC = TS_TRAFFIC + COLLECTED + LAST_CLICK
PARTNERSHIP = tb.TESTBED_PARTNERSHIP


def local(c: str) -> str:
    return f"timezone('{ZONE}', timezone('UTC', make_timestamp(CAST({c} AS BIGINT))))"


def clean_traffic(prefix: str, names) -> str:
    return ", ".join(
        (f"lower(trim({prefix}{c})) AS {c}" if c in LOWERED_TRAFFIC else f"trim({prefix}{c}) AS {c}") for c in names)


def normalized_traffic(prefix: str = "") -> str:
    out = []
    for c in TRAFFIC:
        if c.endswith("_source") and not c.endswith("source_platform") and c != CT + "source_platform":
            out.append(f"{source_sql(prefix + c)} AS {c}")
        elif c.endswith("_medium"):
            out.append(f"{medium_sql(prefix + c)} AS {c}")
        else:
            out.append(f"{prefix}{c} AS {c}")
    return ", ".join(out)


def acq_channel(p: str = "") -> str:
    return channel_sql(f"coalesce({p}traffic_source_source, {p}{CT}source)",
                       f"coalesce({p}traffic_source_medium, {p}{CT}medium)",
                       f"coalesce({p}traffic_source_name, {p}{CT}campaign_name)", partnership=PARTNERSHIP)


def ses_channel(p: str = "", last_click: bool = True) -> str:
    if last_click:
        a = [f"coalesce({p}{LC}{f}, {p}{CT}{f})" for f in ("source", "medium", "campaign_name", "source_platform")]
    else:
        a = [f"{p}{CT}{f}" for f in ("source", "medium", "campaign_name", "source_platform")]
    return channel_sql(*a, partnership=PARTNERSHIP)


def value_sql(p: str, trim: bool) -> str:
    v = (f"coalesce({p}['value']['string_value'], {p}['value']['int_value'], "
         f"{p}['value']['double_value'], {p}['value']['float_value'])")
    return f"trim({v})" if trim else v


SEQ_ORDER = ("event_timestamp, CAST(user_pseudo_id AS VARCHAR) NULLS FIRST, event_name NULLS FIRST, "
             "event_bundle_sequence_id NULLS FIRST")

MONEY_AGG = ("sum(quantity) AS quantity, sum(gross_sales) AS gross_sales, sum(gsnd) AS gsnd, "
             "sum(gross_merchandise_value) AS gmv, sum(shipping_price) AS shipping, "
             "sum(total_tax + vat_value) AS total_tax")
UNIQUE_ITEMS = ("count(DISTINCT CASE WHEN gift_card_flag = 'OTHERS' THEN sku WHEN gift_card_flag = 'GIFT CARD' "
                "THEN lower(title) ELSE 'NA' END) AS unique_items")


def money_cte(name: str, batch: str, purchase_semi: bool, unique_items: bool = True) -> str:
    extra = " AND trim(g.event_name) = 'purchase'" if purchase_semi else ""
    ui = UNIQUE_ITEMS + ", " if unique_items else ""
    return (f"{name} AS (SELECT shopify_order_id, {ui}{MONEY_AGG} FROM order_fact f "
            f"WHERE sale_kind = 'ORDER' AND country = 'US' AND EXISTS (SELECT 1 FROM {batch} g "
            f"WHERE trim(g.ecommerce_transaction_id) = f.shopify_order_id{extra}) GROUP BY shopify_order_id)")


def pivot_cte(name: str, src: str, keys, trim: bool) -> list[str]:
    kv = (f"{name}_kv AS (SELECT s_no, p['key'] AS k, {value_sql('p', trim)} AS v "
          f"FROM (SELECT s_no, unnest(event_params) AS p FROM {src}))")
    cols = ", ".join(f"max(v) FILTER (WHERE k = '{k}') AS \"{k}\"" for k in keys)
    pv = f"{name} AS (SELECT s_no, {cols} FROM {name}_kv GROUP BY s_no)"
    return [kv, pv]


def events_ctes(n: str = "ev", feed: str = "raw", mark: str = NO_MARK, intraday: bool = False) -> list[str]:
    """Events table as CTE ``n``."""
    purchase_on = "" if intraday else " AND trim(g.event_name) = 'purchase'"
    out = [
        f"{n}_batch AS (SELECT * FROM {feed} WHERE event_date > {mark})",
        money_cte(f"{n}_money", f"{n}_batch", purchase_semi=intraday),
        f"{n}_num AS (SELECT *, row_number() OVER (ORDER BY {SEQ_ORDER}) AS s_no FROM {n}_batch)",
        (f"{n}_ga AS (SELECT g.event_date, {local('g.event_timestamp')} AS event_timestamp, "
         "trim(g.event_name) AS event_name, g.event_bundle_sequence_id, trim(g.user_id) AS user_id, "
         "trim(CAST(g.user_pseudo_id AS VARCHAR)) AS user_pseudo_id, g.is_active_user, "
         f"{local('g.user_first_touch_timestamp')} AS user_first_touch_timestamp, "
         f"{clean_traffic('g.', TRAFFIC)}, "
         "CASE WHEN trim(g.ecommerce_transaction_id) = '(not set)' THEN NULL ELSE trim(g.ecommerce_transaction_id) END "
         "AS shopify_order_id, coalesce(m.unique_items, g.ecommerce_unique_items) AS unique_items, "
         "coalesce(m.quantity, g.ecommerce_total_item_quantity) AS total_item_quantity, "
         "g.ecommerce_purchase_revenue_in_usd, m.total_tax AS tax_value, m.shipping AS shipping_value, "
         "m.gross_sales, m.gsnd, m.gmv, g.event_params, g.s_no "
         f"FROM {n}_num g LEFT JOIN {n}_money m ON trim(g.ecommerce_transaction_id) = m.shopify_order_id{purchase_on})"),
        *pivot_cte(f"{n}_pv", f"{n}_ga", ["ga_session_id"] + EVENT_PARAM_KEYS, trim=False),
        (f"{n}_res AS (SELECT g.event_date, g.event_timestamp, hour(g.event_timestamp) AS hourofday, g.s_no, "
         "g.event_name, g.event_bundle_sequence_id, g.user_id, g.user_pseudo_id, "
         "coalesce(g.user_pseudo_id, g.user_id) AS unique_user_id, g.is_active_user, g.user_first_touch_timestamp, "
         "trim(pv.ga_session_id) AS ga_session_id, "
         "coalesce(pv.ga_session_id || ':' || g.user_pseudo_id, coalesce(g.user_pseudo_id, g.user_id), "
         "pv.ga_session_id) AS unique_session_id, "
         f"{normalized_traffic('g.')}, "
         + ", ".join(f"trim(pv.\"{k}\") AS {k}" for k in EVENT_PARAM_KEYS) + ", "
         "g.shopify_order_id, g.unique_items, g.total_item_quantity, g.ecommerce_purchase_revenue_in_usd, "
         "g.tax_value, g.shipping_value, g.gross_sales, g.gsnd, g.gmv "
         f"FROM {n}_ga g JOIN {n}_pv pv ON g.s_no = pv.s_no)"),
        (f"{n} AS (SELECT *, {acq_channel()} AS acquisition_channel_group, "
         f"{ses_channel(last_click=not intraday)} AS session_channel_group FROM {n}_res)"),
    ]
    return out


def purchases_ctes(n: str = "pu", feed: str = "raw", mark: str = NO_MARK, intraday: bool = False) -> list[str]:
    """Purchases (ecommerce) table as CTE ``n``."""
    return [
        f"{n}_all AS (SELECT * FROM {feed} WHERE event_date > {mark})",
        money_cte(f"{n}_money", f"{n}_all", purchase_semi=False),
        (f"{n}_num AS (SELECT *, row_number() OVER (ORDER BY {SEQ_ORDER}) AS s_no FROM {n}_all "
         "WHERE lower(event_name) = 'purchase')"),
        (f"{n}_ga AS (SELECT g.event_date, {local('g.event_timestamp')} AS event_timestamp, "
         "trim(g.user_id) AS user_id, trim(CAST(g.user_pseudo_id AS VARCHAR)) AS user_pseudo_id, g.is_active_user, "
         f"{local('g.user_first_touch_timestamp')} AS user_first_touch_timestamp, g.event_params, "
         "CASE WHEN trim(g.ecommerce_transaction_id) = '(not set)' THEN NULL ELSE trim(g.ecommerce_transaction_id) END "
         "AS shopify_order_id, coalesce(m.unique_items, g.ecommerce_unique_items) AS unique_items, "
         "coalesce(m.quantity, g.ecommerce_total_item_quantity) AS total_item_quantity, "
         "g.ecommerce_purchase_revenue_in_usd, m.total_tax AS tax_value, m.shipping AS shipping_value, "
         f"m.gross_sales, m.gsnd, m.gmv, {clean_traffic('g.', TRAFFIC)}, g.s_no "
         f"FROM {n}_num g LEFT JOIN {n}_money m ON trim(g.ecommerce_transaction_id) = m.shopify_order_id)"),
        *pivot_cte(f"{n}_pv", f"{n}_ga", PURCHASE_PARAM_KEYS, trim=True),
        (f"{n}_res AS (SELECT g.event_date, g.event_timestamp, hour(g.event_timestamp) AS hourofday, g.user_id, "
         "g.user_pseudo_id, coalesce(g.user_pseudo_id, g.user_id) AS unique_user_id, g.is_active_user, "
         "g.user_first_touch_timestamp, pv.ga_session_id, "
         "coalesce(pv.ga_session_id || ':' || g.user_pseudo_id, coalesce(g.user_pseudo_id, g.user_id), "
         "pv.ga_session_id) AS unique_session_id, pv.ga_session_number, pv.coupon, pv.currency, "
         "g.shopify_order_id, g.unique_items, g.total_item_quantity, g.ecommerce_purchase_revenue_in_usd, "
         "g.tax_value, g.shipping_value, g.gross_sales, g.gsnd, g.gmv, "
         f"{normalized_traffic('g.')} FROM {n}_ga g JOIN {n}_pv pv ON g.s_no = pv.s_no)"),
        (f"{n} AS (SELECT *, {acq_channel()} AS acquisition_channel_group, "
         f"{ses_channel(last_click=not intraday)} AS session_channel_group FROM {n}_res)"),
    ]


SES_TRAFFIC = (TS_TRAFFIC + [CT + c for c in ("source", "medium", "campaign_id", "campaign_name", "source_platform")]
               + [LC + c for c in ("source", "medium", "campaign_id", "campaign_name", "source_platform")])


def _norm_traffic_subset(prefix: str, names) -> str:
    out = []
    for c in names:
        if c in (TS_TRAFFIC[0], CT + "source", LC + "source"):
            out.append(f"{source_sql(prefix + c)} AS {c}")
        elif c in (TS_TRAFFIC[1], CT + "medium", LC + "medium"):
            out.append(f"{medium_sql(prefix + c)} AS {c}")
        else:
            out.append(f"{prefix}{c} AS {c}")
    return ", ".join(out)


def new_users_ctes(n: str, fv_src: str, act_srcs: list[str], pu_src: str, mark: str) -> list[str]:
    """New users (CTE ``n``): first visits, 31-day look-back over each of ``act_srcs``, return buyers."""
    out = [f"{n}_fv AS (SELECT DISTINCT event_date, unique_user_id FROM {fv_src} "
           f"WHERE event_name = 'first_visit' AND event_date > {mark})"]
    conds = []
    # several counts are joined by user and day with plain equality: a null user has no partner and goes
    same = "IS NOT DISTINCT FROM" if len(act_srcs) == 1 else "="
    for i, src in enumerate(act_srcs):
        out.append(f"{n}_act{i} AS (SELECT t1.event_date, t1.unique_user_id, count(t2.event_name) AS activity "
                   f"FROM {n}_fv t1 LEFT JOIN {src} t2 ON t1.unique_user_id = t2.unique_user_id "
                   "AND t2.event_date BETWEEN t1.event_date - 31 AND t1.event_date - 1 "
                   "GROUP BY t1.unique_user_id, t1.event_date)")
        conds.append(f"EXISTS (SELECT 1 FROM {n}_act{i} a WHERE a.event_date = f.event_date "
                     f"AND a.unique_user_id {same} f.unique_user_id AND a.activity = 0)")
    out.append(f"{n}_pc AS (SELECT p.event_date, p.unique_user_id, p.shopify_order_id, ct.customer_type "
               f"FROM {pu_src} p LEFT JOIN customer_type_fact ct ON p.shopify_order_id = ct.shopify_order_id "
               f"AND p.event_date > {mark})")
    out.append(f"{n} AS (SELECT DISTINCT f.event_date, f.unique_user_id FROM {n}_fv f WHERE "
               + " AND ".join(conds)
               + f" AND NOT EXISTS (SELECT 1 FROM {n}_pc p WHERE p.unique_user_id = f.unique_user_id "
               "AND p.event_date = f.event_date AND p.customer_type = 'RETURN'))")
    return out


def sessions_ctes(n: str, feed: str, mark: str, nu: str, intraday: bool = False) -> list[str]:
    """Sessions (CTE ``n``) over ``feed`` past ``mark``; ``nu`` is the new-users CTE."""
    dims_clean = ", ".join(f"trim(g.{c}) AS {c}" for c in DEVICE_GEO + [GCLID])
    keys = ["event_date", "unique_user_id", "unique_session_id", "is_active_user", "visitor_type"] + SESSION_DIMENSIONS
    counters = ", ".join(f"sum(CASE WHEN event_name = '{ev}' THEN 1 ELSE 0 END) AS {c}" for c, ev in SESSION_COUNTERS)
    money = ["total_item_quantity", "ecommerce_purchase_revenue_in_usd", "tax_value", "shipping_value",
             "gross_sales", "gsnd", "gmv"]
    fl = ["is_active_user", "visitor_type"] + SESSION_DIMENSIONS
    firstlast = ", ".join(f"min(CASE WHEN minn = 1 THEN {c} END) AS first_event_{c}, "
                          f"max(CASE WHEN maxx = 1 THEN {c} END) AS last_event_{c}" for c in fl)
    part = "PARTITION BY event_date, unique_session_id, unique_user_id"
    w3 = "PARTITION BY f.event_date, f.unique_session_id, f.session_index"
    return [
        f"{n}_batch AS (SELECT * FROM {feed} WHERE event_date > {mark})",
        money_cte(f"{n}_money", f"{n}_batch", purchase_semi=False, unique_items=False),
        f"{n}_num AS (SELECT *, row_number() OVER (ORDER BY {SEQ_ORDER}) AS s_no FROM {n}_batch)",
        (f"{n}_ga AS (SELECT g.event_date, {local('g.event_timestamp')} AS event_timestamp, "
         "trim(g.event_name) AS event_name, trim(g.user_id) AS user_id, "
         "trim(CAST(g.user_pseudo_id AS VARCHAR)) AS user_pseudo_id, g.is_active_user, g.event_params, "
         f"{dims_clean}, {clean_traffic('g.', SES_TRAFFIC)}, "
         "CASE WHEN trim(g.ecommerce_transaction_id) = '(not set)' THEN NULL ELSE trim(g.ecommerce_transaction_id) END "
         "AS shopify_order_id, coalesce(m.quantity, g.ecommerce_total_item_quantity) AS total_item_quantity, "
         "g.ecommerce_purchase_revenue_in_usd, m.total_tax AS tax_value, m.shipping AS shipping_value, "
         "m.gross_sales, m.gsnd, m.gmv, g.s_no "
         f"FROM {n}_num g LEFT JOIN {n}_money m ON trim(g.ecommerce_transaction_id) = m.shopify_order_id "
         "AND trim(g.event_name) = 'purchase')"),
        *pivot_cte(f"{n}_pv", f"{n}_ga", ["ga_session_id", "engagement_time_msec", "visitor_type"], trim=True),
        (f"{n}_ev AS (SELECT g.*, pv.ga_session_id, pv.visitor_type, "
         "coalesce(TRY_CAST(pv.engagement_time_msec AS DECIMAL(38,0)), 0) AS engagement_ms, "
         "coalesce(g.user_pseudo_id, g.user_id) AS unique_user_id, "
         "coalesce(pv.ga_session_id || ':' || g.user_pseudo_id, coalesce(g.user_pseudo_id, g.user_id), "
         "pv.ga_session_id) AS unique_session_id "
         f"FROM {n}_ga g JOIN {n}_pv pv ON g.s_no = pv.s_no)"),
        (f"{n}_evn AS (SELECT * REPLACE ({_norm_traffic_subset('', [TS_TRAFFIC[0], TS_TRAFFIC[1], CT + 'source', CT + 'medium', LC + 'source', LC + 'medium'])}) "
         f"FROM {n}_ev)"),
        (f"{n}_combo AS (SELECT {', '.join(keys)}, min(event_timestamp) AS event_timestamp, min(s_no) AS s_no, "
         "max(user_id) AS user_id, max(user_pseudo_id) AS user_pseudo_id, max(ga_session_id) AS ga_session_id, "
         f"sum(engagement_ms) AS engagement_time_msec, {counters}, count(DISTINCT shopify_order_id) AS orders, "
         + ", ".join(f"sum({c}) AS {c}" for c in money) + ", max(s_no) AS last_s_no "
         f"FROM {n}_evn GROUP BY {', '.join(keys)})"),
        (f"{n}_gap AS (SELECT *, lag(event_timestamp) OVER ({part} ORDER BY event_timestamp, s_no) AS prev_ts "
         f"FROM {n}_combo)"),
        (f"{n}_flag AS (SELECT *, CASE WHEN prev_ts IS NULL THEN 1 "
         "WHEN date_diff('minute', prev_ts, event_timestamp) > 30 THEN 1 ELSE 0 END AS newsession FROM "
         f"{n}_gap)"),
        (f"{n}_idx AS (SELECT *, sum(newsession) OVER ({part} ORDER BY event_timestamp, s_no "
         f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_index FROM {n}_flag)"),
        (f"{n}_rank AS (SELECT *, row_number() OVER (PARTITION BY event_date, unique_session_id, unique_user_id, "
         "session_index ORDER BY event_timestamp ASC, s_no ASC) AS minn, "
         "row_number() OVER (PARTITION BY event_date, unique_session_id, unique_user_id, session_index "
         f"ORDER BY event_timestamp DESC, s_no DESC) AS maxx FROM {n}_idx)"),
        (f"{n}_final AS (SELECT event_date, min(event_timestamp) AS session_start_timestamp, "
         "hour(min(event_timestamp)) AS hourofday, max(last_s_no) AS last_event_s_no, max(user_id) AS user_id, "
         "max(user_pseudo_id) AS user_pseudo_id, unique_user_id, max(ga_session_id) AS ga_session_id, "
         "unique_session_id, CAST(session_index AS BIGINT) AS session_index, "
         "CAST(sum(engagement_time_msec) AS DECIMAL(38,0)) AS engagement_time_msec, "
         + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c, _ in SESSION_COUNTERS) + ", "
         f"{firstlast}, CAST(sum(orders) AS BIGINT) AS orders, "
         + ", ".join(f"sum({c}) AS {c}" for c in money)
         + f" FROM {n}_rank GROUP BY event_date, unique_session_id, unique_user_id, session_index)"),
        f"{n}_engt AS (SELECT s_no, event_timestamp, engagement_ms FROM {n}_ev)",
        (f"{n} AS (SELECT f.*, "
         "et.event_timestamp + to_milliseconds(CAST(et.engagement_ms AS BIGINT)) AS session_end_timestamp, "
         "(epoch_us(et.event_timestamp + to_milliseconds(CAST(et.engagement_ms AS BIGINT))) // 1000) "
         "- (epoch_us(f.session_start_timestamp) // 1000) AS time_on_site, "
         f"CASE WHEN sum(f.page_view) OVER ({w3}) > 1 OR sum(f.engagement_time_msec) OVER ({w3}) > 10000 "
         f"OR sum(f.orders) OVER ({w3}) > 0 THEN 1 ELSE 0 END AS engaged_session_flag, "
         "CASE WHEN nu.unique_user_id IS NOT NULL THEN 'NEW' ELSE 'RETURNING' END AS visitor_flag, "
         f"{acq_channel('f.first_event_')} AS first_event_acquisition_channel_group, "
         f"{acq_channel('f.last_event_')} AS last_event_acquisition_channel_group, "
         f"{ses_channel('f.first_event_', last_click=not intraday)} AS first_event_session_channel_group, "
         f"{ses_channel('f.last_event_', last_click=not intraday)} AS last_event_session_channel_group "
         f"FROM {n}_final f LEFT JOIN {nu} nu ON f.unique_user_id = nu.unique_user_id AND f.event_date = nu.event_date "
         f"LEFT JOIN {n}_engt et ON f.last_event_s_no = et.s_no)"),
    ]


def _color_size(v: str, fam: str) -> tuple[str, str]:
    parts = f"string_split(trim({v}), ' / ')"
    three = f"len({parts}) > 2 AND {fam} NOT ILIKE '%bras%'"
    has = f"contains(trim({v}), ' / ')"

    def part(i):  # 0-based like the reference's [i]
        return f"replace({parts}[{i + 1}], '\"', '')"
    color = f"CASE WHEN {has} THEN CASE WHEN {three} THEN {part(1)} ELSE {part(0)} END END"
    size = f"CASE WHEN {has} THEN CASE WHEN {three} THEN {part(2)} ELSE {part(1)} END END"
    return color, size


def _blank(x: str) -> str:
    return f"CASE WHEN trim({x}) IN ('', '(not set)') THEN NULL ELSE trim({x}) END"


def items_ctes(n: str = "it", feed: str = "raw", mark: str = NO_MARK, brand: str | None = None) -> list[str]:
    from oracle.rulesql import gender_sql, lit
    ev_cols = ("event_date, event_timestamp, hourofday, s_no, event_name, user_id, user_pseudo_id, unique_user_id, "
               "is_active_user, ga_session_id, unique_session_id, ga_session_number, shopify_order_id, page_location, "
               "coupon")
    dimc = "p.division, p.product_category, p.product_subcategory, p.product_family, p.planning_parent"
    money = "total_tax, shipping, gross_sales, gsnd, gmv"
    c, s = _color_size("it['item_variant']", "p.product_family")
    gender = gender_sql("p.externalid", "it['item_name']", "p.gender")
    common_item = (f"trim(it['item_id']) AS item_id, {dimc}, {gender} AS gender, p.strategic_business_unit, "
                   f"{_blank("it['item_list_name']")} AS item_list_name, "
                   "trim(it['item_name']) AS item_name, "
                   f"{_blank("it['item_variant']")} AS item_variant")
    return [
        f"{n}_batch AS (SELECT * FROM {feed} WHERE event_date > {mark})",
        (f"{n}_money AS (SELECT shopify_order_id, CASE WHEN gift_card_flag = 'GIFT CARD' THEN lower(title) ELSE sku END "
         f"AS sku, {MONEY_AGG} FROM order_fact f WHERE sale_kind = 'ORDER' AND country = 'US' AND EXISTS "
         f"(SELECT 1 FROM {n}_batch g WHERE trim(g.ecommerce_transaction_id) = f.shopify_order_id) GROUP BY 1, 2)"),
        f"{n}_num AS (SELECT *, row_number() OVER (ORDER BY {SEQ_ORDER}) AS s_no FROM {n}_batch)",
        (f"{n}_ga AS (SELECT event_date, {local('event_timestamp')} AS event_timestamp, s_no, "
         "trim(event_name) AS event_name, trim(user_id) AS user_id, trim(CAST(user_pseudo_id AS VARCHAR)) AS "
         "user_pseudo_id, is_active_user, CASE WHEN trim(ecommerce_transaction_id) = '(not set)' THEN NULL "
         "ELSE trim(ecommerce_transaction_id) END AS shopify_order_id, event_params, items "
         f"FROM {n}_num WHERE len(items) > 0)"),
        *pivot_cte(f"{n}_pv", f"{n}_ga", ITEM_EVENT_PARAM_KEYS, trim=True),
        (f"{n}_res AS (SELECT g.event_date, g.event_timestamp, hour(g.event_timestamp) AS hourofday, g.s_no, "
         "g.event_name, g.user_id, g.user_pseudo_id, coalesce(g.user_pseudo_id, g.user_id) AS unique_user_id, "
         "g.is_active_user, pv.ga_session_id, coalesce(pv.ga_session_id || ':' || g.user_pseudo_id, "
         "coalesce(g.user_pseudo_id, g.user_id), pv.ga_session_id) AS unique_session_id, pv.ga_session_number, "
         f"g.shopify_order_id, pv.page_location, pv.coupon, g.items FROM {n}_ga g JOIN {n}_pv pv ON g.s_no = pv.s_no)"),
        (f"{n}_items AS (SELECT r.*, unnest(r.items) AS it, generate_subscripts(r.items, 1) AS item_pos "
         f"FROM {n}_res r)"),
        (f"{n}_ip AS (SELECT i.*, unnest(i.it['item_params']) AS ip, "
         f"generate_subscripts(i.it['item_params'], 1) AS param_pos FROM {n}_items i)"),
        (f"{n}_kv AS (SELECT *, ip['key'] AS k, {value_sql('ip', True)} AS v FROM {n}_ip)"),
        # browse: the pivot groups by every remaining column, so equal items of an event collapse
        (f"{n}_b AS (SELECT s_no, it, max(v) FILTER (WHERE k = 'item_product_id') AS item_product_id, "
         f"max(v) FILTER (WHERE k = 'item_variant_id') AS item_variant_id FROM {n}_kv "
         "WHERE event_name NOT IN ('view_item_list', 'purchase') GROUP BY s_no, it)"),
        (f"{n}_bo AS (SELECT r.event_date, r.event_timestamp, r.hourofday, r.s_no, r.event_name, r.user_id, "
         "r.user_pseudo_id, r.unique_user_id, r.is_active_user, r.ga_session_id, r.unique_session_id, "
         "r.ga_session_number, r.shopify_order_id, r.page_location, r.coupon, it['item_brand'] AS item_brand, "
         f"{common_item}, it['quantity'] AS quantity, it['price_in_usd'] AS price_in_usd, "
         "it['item_revenue_in_usd'] AS item_revenue_in_usd, CAST(NULL AS DECIMAL(38,2)) AS total_tax, "
         "CAST(NULL AS DECIMAL(38,2)) AS shipping, CAST(NULL AS DECIMAL(38,2)) AS gross_sales, "
         "CAST(NULL AS DECIMAL(38,2)) AS gsnd, CAST(NULL AS DECIMAL(38,2)) AS gmv, b.item_product_id, "
         f"b.item_variant_id, {c} AS color, {s} AS size FROM {n}_b b JOIN {n}_res r ON b.s_no = r.s_no "
         "LEFT JOIN product_dim p ON p.externalid = trim(b.it['item_id']))"),
        # purchases: window total / 2 and the top-priced row per (order, item key)
        (f"{n}_p AS (SELECT *, CASE WHEN lower(it['item_name']) LIKE '%gift card%' THEN lower(trim(it['item_name'])) "
         f"ELSE trim(it['item_id']) END AS item_key FROM {n}_kv WHERE event_name = 'purchase')"),
        (f"{n}_pr AS (SELECT *, sum(it['item_revenue_in_usd']) OVER (PARTITION BY shopify_order_id, item_key) / 2 "
         "AS rev_agg, row_number() OVER (PARTITION BY shopify_order_id, item_key ORDER BY it['price_in_usd'] DESC "
         f"NULLS FIRST, s_no, item_pos, param_pos) AS rnk FROM {n}_p)"),
        (f"{n}_po AS (SELECT q.event_date, q.event_timestamp, q.hourofday, q.s_no, q.event_name, q.user_id, "
         "q.user_pseudo_id, q.unique_user_id, q.is_active_user, q.ga_session_id, q.unique_session_id, "
         "q.ga_session_number, q.shopify_order_id, q.page_location, q.coupon, it['item_brand'] AS item_brand, "
         f"{common_item}, coalesce(CAST(m.quantity AS DECIMAL(38,0)), it['quantity']) AS quantity, "
         "it['price_in_usd'] AS price_in_usd, q.rev_agg AS item_revenue_in_usd, m.total_tax, m.shipping, "
         "m.gross_sales, m.gsnd, m.gmv, CASE WHEN q.k = 'item_product_id' THEN q.v END AS item_product_id, "
         f"CASE WHEN q.k = 'item_variant_id' THEN q.v END AS item_variant_id, {c} AS color, {s} AS size "
         f"FROM (SELECT * FROM {n}_pr WHERE rnk = 1) q LEFT JOIN {n}_money m ON q.shopify_order_id = m.shopify_order_id "
         "AND q.item_key = m.sku LEFT JOIN product_dim p ON p.externalid = trim(q.it['item_id']))"),
        # list views
        (f"{n}_l AS (SELECT i.*, {dimc}, p.strategic_business_unit, {gender} AS gender, "
         f"trim(it['item_list_name']) AS list_name FROM {n}_items i "
         "LEFT JOIN product_dim p ON p.externalid = trim(i.it['item_id']) WHERE event_name = 'view_item_list' "
         "AND it['item_list_name'] NOT IN ('', '(not set)') AND it['item_list_name'] IS NOT NULL)"),
        (f"{n}_lo AS (SELECT event_date, min(event_timestamp) AS event_timestamp, hourofday, min(s_no) AS s_no, "
         "event_name, max(user_id) AS user_id, max(user_pseudo_id) AS user_pseudo_id, unique_user_id, "
         "min(is_active_user) AS is_active_user, max(ga_session_id) AS ga_session_id, unique_session_id, "
         "min(ga_session_number) AS ga_session_number, CAST(NULL AS VARCHAR) AS shopify_order_id, "
         f"max(page_location) AS page_location, CAST(NULL AS VARCHAR) AS coupon, CAST({lit(brand)} AS VARCHAR) AS item_brand, "
         "CAST(NULL AS VARCHAR) AS item_id, division, product_category, product_subcategory, product_family, "
         "planning_parent, gender, strategic_business_unit, list_name AS item_list_name, "
         "CAST(NULL AS VARCHAR) AS item_name, CAST(NULL AS VARCHAR) AS item_variant, "
         "CAST(NULL AS DECIMAL(38,0)) AS quantity, CAST(NULL AS DOUBLE) AS price_in_usd, "
         "CAST(NULL AS DOUBLE) AS item_revenue_in_usd, CAST(NULL AS DECIMAL(38,2)) AS total_tax, "
         "CAST(NULL AS DECIMAL(38,2)) AS shipping, CAST(NULL AS DECIMAL(38,2)) AS gross_sales, "
         "CAST(NULL AS DECIMAL(38,2)) AS gsnd, CAST(NULL AS DECIMAL(38,2)) AS gmv, "
         "CAST(NULL AS VARCHAR) AS item_product_id, CAST(NULL AS VARCHAR) AS item_variant_id, "
         f"CAST(NULL AS VARCHAR) AS color, CAST(NULL AS VARCHAR) AS size FROM {n}_l "
         "GROUP BY event_date, hourofday, event_name, unique_user_id, unique_session_id, division, product_category, "
         "product_subcategory, product_family, planning_parent, gender, strategic_business_unit, list_name)"),
        (f"{n}_u AS (SELECT * FROM {n}_bo UNION ALL SELECT * FROM {n}_po UNION ALL SELECT * FROM {n}_lo)"),
        (f"{n} AS (SELECT * REPLACE ("
         "CASE WHEN color IN (SELECT DISTINCT product_size FROM product_dim WHERE product_size IS NOT NULL) "
         "THEN size ELSE color END AS color, "
         "CASE WHEN color IN (SELECT DISTINCT product_size FROM product_dim WHERE product_size IS NOT NULL) "
         f"THEN color ELSE size END AS size) FROM {n}_u)"),
    ]
