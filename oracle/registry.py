"""Oracle SQL per query key (DuckDB), built from the testbed and model CTEs."""

from __future__ import annotations

from oracle import models_sql as M
from oracle.present import present_sql
from oracle.rulesql import channel_sql, gender_sql, medium_sql, source_sql
from oracle.testbed_sql import ctes as testbed_ctes
from webtrail.plans.events import EVENTS_COLUMNS, TRAFFIC_OUT
from webtrail.plans.items import DIM_COLUMNS, ITEMS_COLUMNS
from webtrail.plans.purchases import PURCHASES_COLUMNS
from webtrail.plans.sessions import COMBO_KEYS, FIRST_LAST, MONEY_SUMS, SESSIONS_COLUMNS
from webtrail.schema import CT, EVENT_PARAM_KEYS, LC, SESSION_COUNTERS
from webtrail.sources.testbed import TESTBED_LIST_BRAND, TESTBED_PARTNERSHIP

ORACLE: dict[str, str] = {}

MONEY = ["tax_value", "shipping_value", "gross_sales", "gsnd", "gmv", "total_tax", "shipping",
         "gross_merchandise_value", "shipping_price", "vat_value"]
SES_DEC = ["engagement_time_msec"]
DOUBLES = ["ecommerce_purchase_revenue_in_usd", "price_in_usd", "item_revenue_in_usd"]
COUNTERS = [c for c, _ in SESSION_COUNTERS]
INTS = ["hourofday", "s_no", "last_s_no", "last_event_s_no", "session_index", "orders", "total_item_quantity",
        "unique_items", "activity", "time_on_site", "engaged_session_flag", "newsession", "n_params", "n_items",
        "rows", "event_bundle_sequence_id", "raw_event_micros", "event_id"] + COUNTERS


def with_ctes(*groups: list[str]) -> str:
    seen, out = set(), []
    for g in (testbed_ctes(), *groups):
        for c in g:
            name = c.split(" AS ", 1)[0]
            if name not in seen:
                seen.add(name)
                out.append(c)
    return "WITH " + ",\n".join(out) + "\n"


def register(key: str, ctes: list[list[str]], body: str, columns: list[str], decimals=(), ints=()):
    ORACLE[key] = with_ctes(*ctes) + present_sql(body, columns, decimals=list(MONEY) + list(decimals),
                                                 doubles=DOUBLES, ints=list(INTS) + list(ints))


# ---------------------------------------------------------------------------
# CTE groups
# ---------------------------------------------------------------------------
NO_MARK = M.NO_MARK
EV = M.events_ctes()
PU = M.purchases_ctes()
NU = M.new_users_ctes("nu", "ev", ["ev"], "pu", NO_MARK)
SE = M.sessions_ctes("se", "raw", NO_MARK, "nu")
IT = M.items_ctes(brand=TESTBED_LIST_BRAND)
SES_ALL = [EV, PU, NU, SE]

EVD = M.events_ctes("evd", "raw_daily")
PUD = M.purchases_ctes("pud", "raw_daily")
EV_MARK = "(SELECT coalesce(max(event_date), DATE '1900-01-01') FROM evd)"
PU_MARK = "(SELECT coalesce(max(event_date), DATE '1900-01-01') FROM pud)"
EVI = M.events_ctes("evi", "raw_intraday", EV_MARK, intraday=True)
PUI = M.purchases_ctes("pui", "raw_intraday", PU_MARK, intraday=True)
NUI = M.new_users_ctes("nui", "evi", ["evd", "evi"], "pui", EV_MARK)
SEI = M.sessions_ctes("sei", "raw_intraday", EV_MARK, "nui", intraday=True)
ITD = M.items_ctes("itd", "raw_daily", brand=TESTBED_LIST_BRAND)
IT_MARK = "(SELECT coalesce(max(event_date), DATE '1900-01-01') FROM itd)"
ITI = M.items_ctes("iti", "raw_intraday", IT_MARK, brand=TESTBED_LIST_BRAND)
INTRA = [EVD, PUD, EVI, PUI]

R1 = M.events_ctes("r1", "raw_daily")
M1 = "(SELECT max(event_date) FROM r1)"
M1_PREV = f"(SELECT coalesce(max(event_date), DATE '1900-01-01') FROM r1 WHERE event_date < {M1})"
R2 = M.events_ctes("r2", "raw", M1_PREV)

SES_KEYS = ["event_date", "unique_session_id", "unique_user_id", "session_index"]
RAW_SCALARS = ["event_date", "raw_event_micros", "event_name", "event_bundle_sequence_id", "user_id",
               "user_pseudo_id", "ecommerce_transaction_id", "n_params", "n_items"]
RAW_SCALARS_SQL = ("event_date, event_timestamp AS raw_event_micros, event_name, event_bundle_sequence_id, user_id, "
                   "user_pseudo_id, ecommerce_transaction_id, len(event_params) AS n_params, len(items) AS n_items")
ORDER_FACT = ["shopify_order_id", "sku", "title", "gift_card_flag", "quantity", "gross_sales", "gsnd",
              "gross_merchandise_value", "shipping_price", "total_tax", "vat_value", "sale_kind", "country"]
ITEM_DEC = ["quantity"]


def cols(*names) -> str:
    return ", ".join(names)


# ---------------------------------------------------------------------------
# whole tables
# ---------------------------------------------------------------------------
register("events_wide", [EV], "SELECT * FROM ev", EVENTS_COLUMNS)
register("purchases", [PU], "SELECT * FROM pu", PURCHASES_COLUMNS)
register("new_users", [EV, PU, NU], "SELECT * FROM nu", ["event_date", "unique_user_id"])
register("new_users_stored_days", [EV, PU, NU], "SELECT * FROM nu", ["event_date", "unique_user_id"])
register("sessions_full", SES_ALL, "SELECT * FROM se", SESSIONS_COLUMNS, decimals=SES_DEC)
register("sessions_hot_split", SES_ALL, "SELECT * FROM se", SESSIONS_COLUMNS, decimals=SES_DEC)
register("items_union", [IT], "SELECT * FROM it", ITEMS_COLUMNS, decimals=ITEM_DEC)

# ---------------------------------------------------------------------------
# sources, projection, filters
# ---------------------------------------------------------------------------
register("scan_events", [], f"SELECT {RAW_SCALARS_SQL} FROM raw WHERE event_date > {NO_MARK}", RAW_SCALARS)
PROJECT = ["event_date", "event_timestamp", "s_no", "event_name", "event_bundle_sequence_id", "user_id",
           "user_pseudo_id", "is_active_user", "user_first_touch_timestamp", *TRAFFIC_OUT, "shopify_order_id"]
register("project_clean", [EV], f"SELECT {cols(*PROJECT)} FROM ev_ga", PROJECT)
register("filter_in_notin", [IT],
         "SELECT s_no, trim(it['item_id']) AS item_id, it['item_list_name'] AS list_name_raw FROM it_items "
         "WHERE event_name = 'view_item_list' AND it['item_list_name'] NOT IN ('', '(not set)') "
         "AND it['item_list_name'] IS NOT NULL", ["s_no", "item_id", "list_name_raw"])
register("filter_after_watermark", [EVD], f"SELECT {RAW_SCALARS_SQL} FROM raw_intraday WHERE event_date > {EV_MARK}",
         RAW_SCALARS)
register("filter_nonempty_items", [IT],
         "SELECT s_no, event_bundle_sequence_id, len(items) AS n_items FROM it_num WHERE len(items) > 0",
         ["s_no", "event_bundle_sequence_id", "n_items"])


def _distinct_sql(suffix: str, alias: str, fn) -> str:
    srcs = [f"traffic_source_{suffix}", f"{CT}{suffix}", f"{LC}{suffix}"]
    union = " UNION ALL ".join(f"SELECT lower(trim({c})) AS value FROM raw" for c in srcs)
    return f"SELECT DISTINCT value AS {alias}_value, {fn('value')} AS normalized_{alias} FROM ({union})"


register("normalize_source", [], _distinct_sql("source", "source", source_sql), ["source_value", "normalized_source"])
register("normalize_medium", [], _distinct_sql("medium", "medium", medium_sql), ["medium_value", "normalized_medium"])

ACQ_IN = [(f"coalesce(traffic_source_source, {CT}source)", "acq_source"),
          (f"coalesce(traffic_source_medium, {CT}medium)", "acq_medium"),
          (f"coalesce(traffic_source_name, {CT}campaign_name)", "acq_campaign")]
SES_IN = [(f"coalesce({LC}{f}, {CT}{f})", f"ses_{n}") for f, n in
          (("source", "source"), ("medium", "medium"), ("campaign_name", "campaign"), ("source_platform", "platform"))]
ACQ_SQL = ", ".join(f"{e} AS {a}" for e, a in ACQ_IN)
SES_SQL = ", ".join(f"{e} AS {a}" for e, a in SES_IN)
register("channel_acquisition", [EV],
         f"SELECT DISTINCT {ACQ_SQL}, "
         f"{channel_sql('coalesce(traffic_source_source, ' + CT + 'source)', 'coalesce(traffic_source_medium, ' + CT + 'medium)', 'coalesce(traffic_source_name, ' + CT + 'campaign_name)', partnership=TESTBED_PARTNERSHIP)} "
         "AS channel FROM ev", [a for _, a in ACQ_IN] + ["channel"])
register("channel_session", [EV],
         f"SELECT DISTINCT {SES_SQL}, {channel_sql(*[e for e, _ in SES_IN], partnership=TESTBED_PARTNERSHIP)} "
         "AS channel FROM ev", [a for _, a in SES_IN] + ["channel"])
register("channel_wiring", [EV],
         f"SELECT s_no, {ACQ_SQL}, {SES_SQL}, acquisition_channel_group, session_channel_group FROM ev",
         ["s_no"] + [a for _, a in ACQ_IN] + [a for _, a in SES_IN] + ["acquisition_channel_group",
                                                                        "session_channel_group"])
ITEM_DIM_JOIN = "FROM it_items i LEFT JOIN product_dim p ON p.externalid = trim(i.it['item_id'])"
register("product_gender_rules", [IT],
         f"SELECT DISTINCT p.externalid, it['item_name'] AS item_name_raw, p.gender AS dim_gender, "
         f"{gender_sql('p.externalid', "it['item_name']", 'p.gender')} AS gender "
         + ITEM_DIM_JOIN, ["externalid", "item_name_raw", "dim_gender", "gender"])
register("clean_not_set", [IT],
         "SELECT DISTINCT it['item_list_name'] AS list_name_raw, "
         f"{M._blank("it['item_list_name']")} AS item_list_name, "
         "it['item_variant'] AS variant_raw, "
         f"{M._blank("it['item_variant']")} AS item_variant FROM it_items",
         ["list_name_raw", "item_list_name", "variant_raw", "item_variant"])
_c, _s = M._color_size("it['item_variant']", "p.product_family")
register("variant_color_size", [IT],
         f"SELECT DISTINCT it['item_variant'] AS variant_raw, p.product_family, {_c} AS color, {_s} AS size "
         + ITEM_DIM_JOIN, ["variant_raw", "product_family", "color", "size"])

# ---------------------------------------------------------------------------
# joins
# ---------------------------------------------------------------------------
MONEY_EVENT = ["shopify_order_id", "unique_items", "total_item_quantity", "tax_value", "shipping_value",
               "gross_sales", "gsnd", "gmv"]
register("join_order_money", [EV], f"SELECT s_no, event_name, {cols(*MONEY_EVENT)} FROM ev_ga",
         ["s_no", "event_name"] + MONEY_EVENT)
EVX = M.events_ctes("evx", "raw", NO_MARK, intraday=True)
register("join_order_money_all", [EVX], f"SELECT s_no, event_name, {cols(*MONEY_EVENT)} FROM evx_ga",
         ["s_no", "event_name"] + MONEY_EVENT)
register("semi_orders_in_batch", [],
         "SELECT * FROM order_fact f WHERE sale_kind = 'ORDER' AND country = 'US' AND EXISTS (SELECT 1 FROM raw g "
         f"WHERE trim(g.ecommerce_transaction_id) = f.shopify_order_id AND g.event_date > {NO_MARK})", ORDER_FACT,
         ints=["quantity"])
register("anti_return_buyers", [EV, PU, NU],
         "SELECT DISTINCT f.event_date, f.unique_user_id FROM nu_fv f WHERE NOT EXISTS (SELECT 1 FROM nu_pc p "
         "WHERE p.unique_user_id = f.unique_user_id AND p.event_date = f.event_date AND p.customer_type = 'RETURN')",
         ["event_date", "unique_user_id"])
register("lookback_activity", [EV, PU, NU], "SELECT event_date, unique_user_id, activity FROM nu_act0",
         ["event_date", "unique_user_id", "activity"])
register("join_customer_type", [EV, PU, NU],
         "SELECT event_date, unique_user_id, shopify_order_id, customer_type FROM nu_pc",
         ["event_date", "unique_user_id", "shopify_order_id", "customer_type"])
register("join_item_money", [IT],
         "SELECT q.shopify_order_id, q.item_key, coalesce(CAST(m.quantity AS DECIMAL(38,0)), q.it['quantity']) AS "
         "quantity, m.total_tax, m.shipping, m.gross_sales, m.gsnd, m.gmv FROM (SELECT * FROM it_pr WHERE rnk = 1) q "
         "LEFT JOIN it_money m ON q.shopify_order_id = m.shopify_order_id AND q.item_key = m.sku",
         ["shopify_order_id", "item_key", "quantity", "total_tax", "shipping", "gross_sales", "gsnd", "gmv"],
         decimals=ITEM_DEC)
register("join_product_dim", [IT],
         f"SELECT s_no, item_id, {cols(*DIM_COLUMNS)}, gender, strategic_business_unit FROM it_bo",
         ["s_no", "item_id", *DIM_COLUMNS, "gender", "strategic_business_unit"])
register("swap_color_size", [IT], "SELECT s_no, event_name, item_id, item_variant, color, size FROM it",
         ["s_no", "event_name", "item_id", "item_variant", "color", "size"])
register("session_end", SES_ALL, f"SELECT {cols(*SES_KEYS)}, last_event_s_no, session_end_timestamp FROM se",
         SES_KEYS + ["last_event_s_no", "session_end_timestamp"])
register("visitor_flag", SES_ALL, f"SELECT {cols(*SES_KEYS)}, visitor_flag FROM se", SES_KEYS + ["visitor_flag"])
register("explode_params", [EV], "SELECT s_no, k AS param_key, v AS param_value FROM ev_pv_kv",
         ["s_no", "param_key", "param_value"])
register("new_users_intraday", INTRA + [NUI], "SELECT * FROM nui", ["event_date", "unique_user_id"])
register("intraday_tail", [EVD, EVI], "SELECT * FROM evi", EVENTS_COLUMNS)
register("purchases_intraday", [PUD, PUI], "SELECT * FROM pui", PURCHASES_COLUMNS)
register("sessions_intraday", INTRA + [NUI, SEI], "SELECT * FROM sei", SESSIONS_COLUMNS, decimals=SES_DEC)
register("items_intraday", [ITD, ITI], "SELECT * FROM iti", ITEMS_COLUMNS, decimals=ITEM_DEC)

# ---------------------------------------------------------------------------
# aggregations
# ---------------------------------------------------------------------------
ORDER_MONEY = ["shopify_order_id", "quantity", "unique_items", "gross_sales", "gsnd", "gmv", "shipping", "total_tax"]
register("order_money", [EV], f"SELECT {cols(*ORDER_MONEY)} FROM ev_money", ORDER_MONEY, ints=["quantity"])
ITEM_MONEY = ["shopify_order_id", "sku", "quantity", "gross_sales", "gsnd", "gmv", "shipping", "total_tax"]
register("order_item_money", [IT], f"SELECT {cols(*ITEM_MONEY)} FROM it_money", ITEM_MONEY, ints=["quantity"])
register("order_unique_items", [EV], "SELECT shopify_order_id, unique_items FROM ev_money",
         ["shopify_order_id", "unique_items"])
register("session_event_counts", SES_ALL, f"SELECT {cols(*SES_KEYS, *COUNTERS)} FROM se", SES_KEYS + COUNTERS)
COMBO_OUT = COMBO_KEYS + ["event_timestamp", "s_no", "last_s_no", "engagement_time_msec", "orders"] + COUNTERS
register("session_attribute_rollup", SES_ALL, f"SELECT {cols(*COMBO_OUT)} FROM se_combo", COMBO_OUT, decimals=SES_DEC)
register("first_visit_users", [EV, PU, NU], "SELECT event_date, unique_user_id FROM nu_fv",
         ["event_date", "unique_user_id"])
FL = [f"{p}_event_{c}" for c in FIRST_LAST for p in ("first", "last")]
register("first_last_touch", SES_ALL, f"SELECT {cols(*SES_KEYS, *FL)} FROM se", SES_KEYS + FL)
FINAL = SES_KEYS + ["session_start_timestamp", "last_event_s_no", "user_id", "user_pseudo_id", "ga_session_id",
                    "engagement_time_msec"] + COUNTERS + ["orders"] + MONEY_SUMS
register("session_final", SES_ALL, f"SELECT {cols(*FINAL)} FROM se_final", FINAL, decimals=SES_DEC)
register("high_water_mark_listing", [EVD], f"SELECT {EV_MARK} AS high_water_mark", ["high_water_mark"])
register("high_water_mark", [EVD], f"SELECT {EV_MARK} AS high_water_mark", ["high_water_mark"])
PIVOT = ["s_no", "ga_session_id"] + EVENT_PARAM_KEYS
register("pivot_params", [EV], f"SELECT {cols(*PIVOT)} FROM ev", PIVOT)
register("items_list_views", [IT], "SELECT * FROM it_lo", ITEMS_COLUMNS, decimals=ITEM_DEC)

# ---------------------------------------------------------------------------
# windows
# ---------------------------------------------------------------------------
register("global_sequence", [EV], "SELECT event_bundle_sequence_id, s_no FROM ev_num",
         ["event_bundle_sequence_id", "s_no"])
GAP = ["event_date", "unique_session_id", "unique_user_id", "s_no", "event_timestamp", "previous_timestamp",
       "newsession"]
register("session_gap", SES_ALL,
         "SELECT event_date, unique_session_id, unique_user_id, s_no, event_timestamp, "
         "strftime(prev_ts, '%Y-%m-%d %H:%M:%S.%f') AS previous_timestamp, newsession FROM se_flag", GAP)
register("session_index", SES_ALL,
         "SELECT event_date, unique_session_id, unique_user_id, s_no, session_index FROM se_idx",
         ["event_date", "unique_session_id", "unique_user_id", "s_no", "session_index"])
DEDUP = ["shopify_order_id", "item_key", "s_no", "item_id", "price_in_usd", "item_product_id", "item_variant_id"]
register("purchase_item_dedup", [IT],
         "SELECT shopify_order_id, item_key, s_no, trim(it['item_id']) AS item_id, it['price_in_usd'] AS price_in_usd, "
         "CASE WHEN k = 'item_product_id' THEN v END AS item_product_id, "
         "CASE WHEN k = 'item_variant_id' THEN v END AS item_variant_id FROM it_pr WHERE rnk = 1", DEDUP)
register("purchase_item_revenue", [IT],
         "SELECT DISTINCT shopify_order_id, item_key, rev_agg AS item_revenue_in_usd FROM it_pr",
         ["shopify_order_id", "item_key", "item_revenue_in_usd"])
ENG = SES_KEYS + ["page_view", "engagement_time_msec", "orders", "engaged_session_flag"]
register("engaged_flag", SES_ALL, f"SELECT {cols(*ENG)} FROM se", ENG, decimals=SES_DEC)

# ---------------------------------------------------------------------------
# nested data, scalars, time
# ---------------------------------------------------------------------------
register("param_value_coalesce", [IT],
         "SELECT s_no, trim(it['item_id']) AS item_id, k AS param_key, v AS param_value FROM it_kv",
         ["s_no", "item_id", "param_key", "param_value"])
EXPLODED = ["s_no", "item_brand", "item_id", "item_list_name", "item_name", "quantity", "price_in_usd",
            "item_variant", "item_revenue_in_usd"]
register("explode_items", [IT],
         "SELECT s_no, " + ", ".join(f"it['{c}'] AS {c}" for c in EXPLODED[1:]) + " FROM it_items", EXPLODED,
         decimals=ITEM_DEC)
register("item_params_pivot", [IT],
         "SELECT s_no, trim(it['item_id']) AS item_id, max(v) FILTER (WHERE k = 'item_product_id') AS item_product_id, "
         "max(v) FILTER (WHERE k = 'item_variant_id') AS item_variant_id FROM it_kv GROUP BY s_no, it",
         ["s_no", "item_id", "item_product_id", "item_variant_id"])
register("items_browse", [IT], "SELECT * FROM it_bo", ITEMS_COLUMNS, decimals=ITEM_DEC)
register("items_purchase", [IT], "SELECT * FROM it_po", ITEMS_COLUMNS, decimals=ITEM_DEC)
register("parse_params_json", [],
         "SELECT event_bundle_sequence_id, p['key'] AS param_key, " + M.value_sql("p", False) + " AS param_value FROM ("
         "SELECT event_bundle_sequence_id, unnest(event_params) AS p FROM raw WHERE event_bundle_sequence_id % 37 <> 0)",
         ["event_bundle_sequence_id", "param_key", "param_value"])
ITJ = M.items_ctes("itj", "raw_json", brand=TESTBED_LIST_BRAND)
register("items_json", [["raw_json AS (SELECT * REPLACE (CASE WHEN event_bundle_sequence_id % 37 <> 0 THEN event_params END "
                         "AS event_params) FROM raw)"], ITJ], "SELECT * FROM itj", ITEMS_COLUMNS, decimals=ITEM_DEC)
_CALLS = [("source", "normalize_source", ["source_value"], "normalized_source"),
          ("medium", "normalize_medium", ["medium_value"], "normalized_medium"),
          ("acquisition", "channel_acquisition", [a for _, a in ACQ_IN], "channel"),
          ("session", "channel_session", [a for _, a in SES_IN], "channel")]
ORACLE["sql_functions"] = " UNION ALL ".join(
    f"SELECT '{fn}' AS fn, " + ", ".join(f"{(a + [None] * 4)[i] or 'CAST(NULL AS VARCHAR)'} AS {x}" for i, x in enumerate("smcp"))
    + f", {result} AS result FROM ({ORACLE[key]})" for fn, key, a, result in _CALLS)
register("identity_keys", [EV],
         "SELECT s_no, user_id, user_pseudo_id, unique_user_id, ga_session_id, unique_session_id FROM ev",
         ["s_no", "user_id", "user_pseudo_id", "unique_user_id", "ga_session_id", "unique_session_id"])
register("engagement_sum", SES_ALL,
         "SELECT event_date, unique_user_id, sum(engagement_ms) AS engagement_time_msec FROM se_ev GROUP BY 1, 2",
         ["event_date", "unique_user_id", "engagement_time_msec"], decimals=SES_DEC)
register("local_time", [],
         f"SELECT event_bundle_sequence_id, {M.local('event_timestamp')} AS event_timestamp, "
         f"hour({M.local('event_timestamp')}) AS hourofday, "
         f"{M.local('user_first_touch_timestamp')} AS user_first_touch_timestamp FROM raw",
         ["event_bundle_sequence_id", "event_timestamp", "hourofday", "user_first_touch_timestamp"])
register("time_on_site", SES_ALL,
         f"SELECT {cols(*SES_KEYS)}, session_start_timestamp, session_end_timestamp, time_on_site FROM se",
         SES_KEYS + ["session_start_timestamp", "session_end_timestamp", "time_on_site"])

# ---------------------------------------------------------------------------
# incremental and streaming: the stored result after the runs
# ---------------------------------------------------------------------------
register("incremental_daily", [R1, R2],
         f"SELECT * FROM r1 WHERE event_date <= {M1_PREV} UNION ALL SELECT * FROM r2", EVENTS_COLUMNS)
register("reprocess_latest_day", [R1],
         f"SELECT event_date, count(*) AS rows FROM r1 WHERE event_date < {M1} GROUP BY event_date",
         ["event_date", "rows"])
register("schema_sync", [R1],
         "SELECT event_date, s_no, page_title, CAST(NULL AS VARCHAR) AS label, CAST(NULL AS VARCHAR) AS currency "
         "FROM r1", ["event_date", "s_no", "page_title", "label", "currency"])
register("intraday_stream", [EVD, EVI], "SELECT * FROM evi", EVENTS_COLUMNS)
TWO_DAYS = M.events_ctes("r0", "raw_two")
FIRST_DAY = "(SELECT coalesce(max(event_date), DATE '1900-01-01') FROM r0 WHERE event_date < (SELECT max(event_date) FROM r0))"
LATER_DAYS = M.events_ctes("r3", "raw", FIRST_DAY)
register("incremental_one_day",
         [["raw_two AS (SELECT * FROM raw WHERE event_date <= (SELECT min(event_date) + 1 FROM raw))"], TWO_DAYS, LATER_DAYS],
         f"SELECT * FROM r0 WHERE event_date <= {FIRST_DAY} UNION ALL SELECT * FROM r3", EVENTS_COLUMNS)
register("purchases_stream", [PUD, PUI], "SELECT * FROM pui", PURCHASES_COLUMNS)
register("items_stream", [ITD, ITI], "SELECT * FROM iti", ITEMS_COLUMNS, decimals=ITEM_DEC)
register("sessions_stream", INTRA + [NUI, SEI], "SELECT * FROM sei", SESSIONS_COLUMNS, decimals=SES_DEC)
SES_DAYS = [c for c in SESSIONS_COLUMNS if c != "last_event_s_no"]
register("sessions_stream_days", INTRA + [NUI, SEI], f"SELECT {cols(*SES_DAYS)} FROM sei", SES_DAYS, decimals=SES_DEC)
