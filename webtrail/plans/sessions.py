"""The sessions table: events -> attribute combinations -> sessions.

1. widen the session params and clean the event (one row per event with params);
2. collapse events to attribute combinations per (day, session, user): the 33
   grouping keys, with first time, first/last ``s_no``, counters and money;
3. a combination starts a new session when it is the first or when more than 30
   minute boundaries lie between its first event and the previous combination's
   first event; a running sum numbers the sessions;
4. roll combinations up to sessions; first/last attributes come from
   ``min_by``/``max_by`` over (first time, first ``s_no``), and the end event
   (highest ``s_no``) travels through both aggregates as a struct, so no rank
   windows and no join back to the events are needed;
5. engagement flag, visitor flag and the four channel groupings.

Shuffles: the events are dealt once by (day, session), and the combinations with their distinct
orders, the gaps, the index, the session rollup, the engagement totals and the visitor flag all
reuse that (any key that holds day and session is clustered by it).  Few events share all 33 keys, so a partial
aggregate in front of a shuffle on them saves next to nothing (README has the times).

One (day, session) may hold a large share of all rows: events without any id, a bot.  Such
sessions are found beforehand by a narrow count and take the other path: partial aggregates, and
windows on (group, minute) with one row a minute carried through the group.  Both paths are
exact; the count only decides where a session is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webtrail.functions.params import has_params, param
from webtrail.functions.scalars import unique_session_id, unique_user_id
from webtrail.functions.timeops import add_millis, millisecond_boundaries, minute_boundaries
from webtrail.operators.sequence import staged
from webtrail.plans.common import (acquisition_channel, attach_order_money, batch_money, local_times,
                                   normalized_traffic, number_batch, session_channel, shopify_order_id,
                                   traffic_clean, typed_feed)
from webtrail.schema import (ACQ_CHANNEL, CT, DEVICE_GEO, GCLID, LC, SES_CHANNEL, SESSION_COUNTERS,
                             SESSION_DIMENSIONS, TS_TRAFFIC, FeedOptions)

# Session rules.
SESSION_GAP_MINUTES = 30
ENGAGED_MIN_PAGE_VIEWS = 1
ENGAGED_MIN_MSEC = 10_000
#: Events of one (day, session) from which it is spread over several tasks.
HOT_ROWS = 200_000
NEW, RETURNING = "NEW", "RETURNING"

TRAFFIC_IN = (TS_TRAFFIC + [CT + c for c in ("source", "medium", "campaign_id", "campaign_name", "source_platform")]
              + [LC + c for c in ("source", "medium", "campaign_id", "campaign_name", "source_platform")])
RAW_COLUMNS = (["event_date", "event_timestamp", "event_name", "event_bundle_sequence_id", "user_id",
                "user_pseudo_id", "is_active_user", "event_params", "ecommerce_transaction_id",
                "ecommerce_total_item_quantity", "ecommerce_purchase_revenue_in_usd", GCLID]
               + DEVICE_GEO + TRAFFIC_IN)
MONEY_SUMS = ["total_item_quantity", "ecommerce_purchase_revenue_in_usd", "tax_value", "shipping_value",
              "gross_sales", "gsnd", "gmv"]
COMBO_KEYS = ["event_date", "unique_user_id", "unique_session_id", "is_active_user", "visitor_type"] + SESSION_DIMENSIONS
SESSION_KEYS = ["event_date", "unique_session_id", "unique_user_id", "session_index"]
FIRST_LAST = ["is_active_user", "visitor_type"] + SESSION_DIMENSIONS

SESSIONS_COLUMNS = (
    ["event_date", "session_start_timestamp", "hourofday", "last_event_s_no", "user_id", "user_pseudo_id",
     "unique_user_id", "first_event_is_active_user", "last_event_is_active_user", "ga_session_id",
     "unique_session_id", "session_index", "engagement_time_msec", "first_event_visitor_type",
     "last_event_visitor_type"]
    + [c for c, _ in SESSION_COUNTERS]
    + [f"{fl}_event_{d}" for d in SESSION_DIMENSIONS for fl in ("first", "last")]
    + ["orders"] + MONEY_SUMS
    + ["session_end_timestamp", "time_on_site", "engaged_session_flag", "visitor_flag",
       "first_event_" + ACQ_CHANNEL, "last_event_" + ACQ_CHANNEL, "first_event_" + SES_CHANNEL, "last_event_" + SES_CHANNEL]
)


def session_events(raw_batch: DataFrame, orders: DataFrame, opts: FeedOptions,
                   numbered: DataFrame | None = None) -> DataFrame:
    """One cleaned row per event with params: ids, session params, dims, money."""
    raw = typed_feed(raw_batch.select(*RAW_COLUMNS))
    money = batch_money(raw, orders, purchase_only_semi=False, with_unique_items=False)
    numbered = number_batch(raw) if numbered is None else numbered.select(*RAW_COLUMNS, "s_no")
    joined = attach_order_money(numbered, money, only_purchases=True, with_unique_items=False)
    ev = joined.filter(has_params("event_params")).withColumns({
        **local_times(raw, opts),
        "event_name": F.trim("event_name"),
        "user_id": F.trim("user_id"),
        "user_pseudo_id": F.trim(F.col("user_pseudo_id").cast("string")),
        **{c: F.trim(c) for c in DEVICE_GEO + [GCLID]},
        **traffic_clean(TRAFFIC_IN),
        "shopify_order_id": shopify_order_id(),
        "total_item_quantity": F.coalesce("__shp_quantity", "ecommerce_total_item_quantity"),
        # params: trimmed before the max
        "ga_session_id": param("event_params", "ga_session_id", trim_values=True),
        "visitor_type": param("event_params", "visitor_type", trim_values=True),
        "engagement_ms": F.coalesce(
            param("event_params", "engagement_time_msec", trim_values=True).try_cast("decimal(38,0)"),
            F.lit(0).cast("decimal(38,0)")),
    })
    return ev.withColumns({
        "unique_user_id": unique_user_id("user_pseudo_id", "user_id"),
        "unique_session_id": unique_session_id("ga_session_id", "user_pseudo_id", "user_id"),
        **{k: v for k, v in normalized_traffic().items() if k in TRAFFIC_IN},
    })


def attribute_rollup(ev: DataFrame) -> DataFrame:
    """Step 2: one row per attribute combination of a (day, session, user)."""
    counters = [F.sum(F.when(F.col("event_name") == name, 1).otherwise(0)).alias(out) for out, name in SESSION_COUNTERS]
    return ev.groupBy(*COMBO_KEYS).agg(
        F.min("event_timestamp").alias("event_timestamp"),
        F.min("s_no").alias("s_no"),
        F.max("s_no").alias("last_s_no"),
        F.max("user_id").alias("user_id"),
        F.max("user_pseudo_id").alias("user_pseudo_id"),
        F.max("ga_session_id").alias("ga_session_id"),
        F.sum("engagement_ms").alias("engagement_time_msec"),
        *counters,
        F.count_distinct("shopify_order_id").alias("orders"),
        *[F.sum(c).alias(c) for c in MONEY_SUMS],
        # the combination's last event, carried for the session end time
        F.max_by(F.struct(F.col("event_timestamp").alias("ts"), F.col("engagement_ms").alias("ms")), "s_no")
        .alias("end_event"),
    )


GROUP = ["event_date", "unique_session_id", "unique_user_id"]


def _minutes(combos: DataFrame) -> DataFrame:
    """Combinations keyed by (group, minute), with the previous one of the same minute.

    A (day, session, user) group may hold a large share of all rows (events without any
    id, a bot).  Its minutes are separate window partitions; what passes from minute to
    minute is one row each, so no task ever holds a whole group of combinations."""
    key = F.struct(F.struct(*GROUP).alias("group"), F.date_trunc("minute", "event_timestamp").alias("minute"))
    w = Window.partitionBy("__k").orderBy("event_timestamp", "s_no")
    return combos.withColumn("__k", key).withColumns({
        "__first": F.row_number().over(w) == 1, "__prev": F.lag("event_timestamp").over(w)})


def _starts(previous: Column, now: Column) -> Column:
    """1 where a session starts: no previous time, or too many minute boundaries since."""
    return F.when(previous.isNull(), 1).when(minute_boundaries(previous, now) > SESSION_GAP_MINUTES, 1).otherwise(0)


def _numbered_minutes(combos: DataFrame) -> DataFrame:
    """Rows with the last time of the minute before (``__before``) and the sessions that start
    earlier in the group (``__earlier``), and inside the minute up to the row (``__inside``)."""
    rows = _minutes(combos).withColumn("__start", F.when(F.col("__first"), 0).otherwise(
        _starts(F.col("__prev"), F.col("event_timestamp"))))
    run = Window.partitionBy("__k").orderBy("event_timestamp", "s_no").rowsBetween(Window.unboundedPreceding,
                                                                                     Window.currentRow)
    rows = rows.withColumn("__inside", F.sum("__start").over(run))
    # at most 1,441 rows a group: one for each minute of its day, and one without a time
    minutes = rows.groupBy("__k").agg(F.min("event_timestamp").alias("__lo"), F.max("event_timestamp").alias("__hi"),
                                      F.sum("__start").alias("__starts"))
    by_group = Window.partitionBy("__k.group").orderBy(F.col("__k.minute").asc_nulls_first())
    minutes = minutes.withColumn("__before", F.lag("__hi").over(by_group))
    minutes = minutes.withColumn("__opens", _starts(F.col("__before"), F.col("__lo")))
    earlier = F.sum(F.col("__opens") + F.col("__starts")).over(by_group.rowsBetween(Window.unboundedPreceding, -1))
    minutes = minutes.select("__k", "__before", "__opens", F.coalesce(earlier, F.lit(0)).alias("__earlier"))
    return rows.join(minutes, "__k")


def session_gaps(combos: DataFrame) -> DataFrame:
    """Step 3a: previous combination's first time and the new-session flag."""
    rows = _numbered_minutes(combos)
    return rows.withColumns({
        "previous_timestamp": F.when(F.col("__first"), F.col("__before")).otherwise(F.col("__prev")),
        "newsession": F.when(F.col("__first"), F.col("__opens")).otherwise(F.col("__start")),
    }).drop(*[c for c in rows.columns if c.startswith("__")])


def session_index(combos: DataFrame) -> DataFrame:
    """Step 3b: running count of new-session flags numbers the sessions from 1."""
    rows = _numbered_minutes(combos)
    return rows.withColumn("session_index", F.col("__earlier") + F.col("__opens") + F.col("__inside")).drop(
        *[c for c in rows.columns if c.startswith("__")])


def session_index_together(combos: DataFrame) -> DataFrame:
    """:func:`session_index` where no group is large: windows over whole groups."""
    w = Window.partitionBy(*GROUP).orderBy("event_timestamp", "s_no")
    start = _starts(F.lag("event_timestamp").over(w), F.col("event_timestamp"))
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return combos.withColumn("__start", start).withColumn("session_index", F.sum("__start").over(run)).drop("__start")


def session_rollup(indexed: DataFrame) -> DataFrame:
    """Step 4: one row per session with first/last attributes, sums and the end event.

    All 30 first-touch (and last-touch) attributes come from a single ``min_by``
    (``max_by``) over one struct, so each row is compared once per direction,
    not once per attribute; a null at the first row stays null."""
    order = F.struct("event_timestamp", "s_no")
    attrs = F.struct(*[F.col(c) for c in FIRST_LAST])
    g = indexed.groupBy(*SESSION_KEYS).agg(
        F.min("event_timestamp").alias("session_start_timestamp"),
        F.max("last_s_no").alias("last_event_s_no"),
        F.max("user_id").alias("user_id"),
        F.max("user_pseudo_id").alias("user_pseudo_id"),
        F.max("ga_session_id").alias("ga_session_id"),
        F.sum("engagement_time_msec").cast("decimal(38,0)").alias("engagement_time_msec"),
        *[F.sum(c).alias(c) for c, _ in SESSION_COUNTERS],
        F.min_by(attrs, order).alias("__first"),
        F.max_by(attrs, order).alias("__last"),
        F.sum("orders").alias("orders"),
        *[F.sum(c).alias(c) for c in MONEY_SUMS],
        F.max_by("end_event", "last_s_no").alias("end_event"),
    )
    expand = {}
    for c in FIRST_LAST:
        expand[f"first_event_{c}"] = F.col("__first")[c]
        expand[f"last_event_{c}"] = F.col("__last")[c]
    return g.withColumns(expand).drop("__first", "__last")


def engaged_flag() -> Column:
    w = Window.partitionBy("event_date", "unique_session_id", "session_index")
    cond = ((F.sum("page_view").over(w) > ENGAGED_MIN_PAGE_VIEWS)
            | (F.sum("engagement_time_msec").over(w) > ENGAGED_MIN_MSEC)
            | (F.sum("orders").over(w) > 0))
    return F.when(F.coalesce(cond, F.lit(False)), 1).otherwise(0)


def _ids(numbered: DataFrame) -> tuple[Column, Column]:
    """Unique session and user of an event of the batch, as :func:`session_events` gives them."""
    pseudo, user = F.trim(F.col("user_pseudo_id").cast("string")), F.trim("user_id")
    session = param("event_params", "ga_session_id", trim_values=True)
    return unique_session_id(session, pseudo, user), unique_user_id(pseudo, user)


def hot_sessions(numbered: DataFrame, hot_rows: int) -> DataFrame | None:
    """Stored (event_date, unique_session_id) of sessions with more than ``hot_rows`` events, None if there
    are none.  A session's events are one visitor's, so a count by visitor over every 16th row of three
    narrow columns comes first; params are read for the rows of large visitors alone, mostly none."""
    every = max(1, min(16, hot_rows // 1000))
    session, user = _ids(numbered)
    rows = numbered.withColumn("__visitor", F.struct("event_date", user.alias("user")))
    visitors = (rows.filter(F.col("s_no") % every == 0).groupBy("__visitor").count()
                .filter(F.col("count") * every > hot_rows // 2).select("__visitor"))
    visitors = staged(visitors)
    if visitors.isEmpty():
        return None
    # at most one row for each hot_rows / 2 events: broadcast if Spark finds the stored rows small, else shuffled
    rows = rows.join(visitors, "__visitor", "left_semi")
    hot = staged(rows.groupBy("event_date", session.alias("unique_session_id")).count().filter(F.col("count") > hot_rows)
                 .drop("count"))
    return None if hot.isEmpty() else hot


def _sessions(ev: DataFrame, together: bool) -> DataFrame:
    combos = attribute_rollup(ev.repartition("event_date", "unique_session_id") if together else ev)
    indexed = session_index_together(combos) if together else session_index(combos)
    return session_rollup(indexed).withColumn("engaged_session_flag", engaged_flag())


def all_sessions(ev: DataFrame, hot: DataFrame | None) -> DataFrame:
    """Steps 2 to 4 and the engagement flag, ``hot`` sessions on a path of their own."""
    if hot is None:
        return _sessions(ev, together=True)
    # at most one row for each hot_rows events; a session is a whole (day, session), so it is built on one path
    key = F.struct("event_date", "unique_session_id")
    marked = ev.withColumn("__s", key).join(hot.select(key.alias("__s"), F.lit(True).alias("__hot")), "__s", "left")
    # stored, so that the events are cleaned and marked once for both paths, and those shuffles need not stay for theirs
    marked = staged(marked.drop("__s"))
    is_hot = F.col("__hot").isNotNull()
    rest = _sessions(marked.filter(~is_hot).drop("__hot"), together=True)
    return rest.unionByName(_sessions(marked.filter(is_hot).drop("__hot"), together=False))


def new_visitors(numbered: DataFrame, new_user_days: DataFrame) -> DataFrame:
    """The new users of each (day, session), an array that is keyed as the sessions are dealt: the wide session
    rows meet it where they are.  A session id holds its user, so the arrays are short."""
    session, user = _ids(numbered)
    seen = numbered.filter(has_params("event_params")).select(
        "event_date", session.alias("unique_session_id"), user.alias("unique_user_id")).distinct()
    new = seen.join(new_user_days, ["unique_user_id", "event_date"], "left_semi")
    return new.groupBy("event_date", "unique_session_id").agg(F.collect_set("unique_user_id").alias("__new_users"))


def build_sessions(raw_batch: DataFrame, orders: DataFrame, new_user_days: DataFrame,
                   opts: FeedOptions = FeedOptions(), numbered: DataFrame | None = None,
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """Sessions for the days in ``raw_batch``; ``new_user_days`` is (event_date, unique_user_id)."""
    if numbered is None:
        numbered = number_batch(typed_feed(raw_batch.select(*RAW_COLUMNS)))
    ev = session_events(raw_batch, orders, opts, numbered)
    sessions = all_sessions(ev, hot_sessions(numbered, hot_rows))
    sessions = sessions.join(new_visitors(numbered, new_user_days), ["event_date", "unique_session_id"], "left")
    end = F.col("end_event")
    out = sessions.withColumns({
        "hourofday": F.hour("session_start_timestamp"),
        "session_end_timestamp": add_millis(end["ts"], end["ms"]),
    }).withColumn("time_on_site", millisecond_boundaries(F.col("session_start_timestamp"), F.col("session_end_timestamp")))
    is_new = F.array_contains("__new_users", F.col("unique_user_id"))
    out = out.withColumn("visitor_flag", F.when(is_new, F.lit(NEW)).otherwise(F.lit(RETURNING)))
    out = out.withColumns({
        "first_event_" + ACQ_CHANNEL: acquisition_channel(opts, "first_event_"),
        "last_event_" + ACQ_CHANNEL: acquisition_channel(opts, "last_event_"),
        "first_event_" + SES_CHANNEL: session_channel(opts, "first_event_"),
        "last_event_" + SES_CHANNEL: session_channel(opts, "last_event_"),
    })
    return out.select(*SESSIONS_COLUMNS)
