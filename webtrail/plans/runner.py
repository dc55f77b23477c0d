"""Runs of all four tables for one feed, as a scheduler would call them.

Daily run (per table: I2 drop newest day, I1 mark, build, I5 sync, I4 write):
the events, items and sessions tables number the *same* batch the same way, so
when their marks agree the batch is range-sorted and staged once and
shared (one shuffle of the batch instead of three).  All four tables need the order
lines of the batch: they are cut from the order fact once (its scan is bounded by the least and
greatest id of the batch) and stored for the run.
Sessions are built last: their new-user test reads the events and purchases tables
just written.  If ``Tables.activity`` is set, the run also keeps (day, user) rows of its events
there, and the 31-day look-back reads them instead of the events.  What the run has staged is
deleted once all tables are written.

Intraday run: each tail table is built from the provisional feed past the
newest day of its daily twin (the sessions tail uses the daily sessions mark)
and fully overwritten (S6), or only some of its days are rebuilt.  The order lines
are cut once for all four here, too.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webtrail.operators.new_users import new_users, user_days
from webtrail.operators.orders import batch_order_ids, id_bounds, orders_in_batch
from webtrail.operators.sequence import staged, staging
from webtrail.plans import events as ev_plan
from webtrail.plans import items as it_plan
from webtrail.plans import sessions as se_plan
from webtrail.plans.common import number_batch
from webtrail.plans.events import build_events
from webtrail.plans.items import build_items
from webtrail.plans.purchases import build_purchases
from webtrail.plans.sessions import build_sessions
from webtrail.schema import DAILY, INTRADAY, FeedOptions
from webtrail.sources import incremental as inc

#: Later than any day.
NO_DAY = dt.date(9999, 12, 31)
SHARED_COLUMNS = list(dict.fromkeys(ev_plan.RAW_COLUMNS + it_plan.RAW_COLUMNS + se_plan.RAW_COLUMNS))


@dataclass(frozen=True)
class Tables:
    """Locations of the four tables."""

    events: str
    purchases: str
    items: str
    sessions: str
    #: Kept activity days, not one of the four tables.
    activity: str | None = None

    def as_dict(self) -> dict[str, str]:
        return {"events": self.events, "purchases": self.purchases, "items": self.items, "sessions": self.sessions}


def _after(feed: DataFrame, mark: dt.date) -> DataFrame:
    return feed.filter(F.col("event_date") > F.lit(mark))


def _write(spark: SparkSession, df: DataFrame, path: str) -> None:
    inc.sync_schema(spark, path, df.schema)
    inc.write_days(df, path)


def keep_activity(spark: SparkSession, events: DataFrame, path: str, mark: dt.date) -> None:
    """Bring the stored activity days up to the events table, whose days past ``mark`` were just rebuilt:
    those days are dropped first, then every day past the last kept one is added."""
    inc.drop_days(spark, path, [d for d in inc.stored_days(spark, path) if d > mark])
    _write(spark, user_days(_after(events, inc.high_water_mark(spark, path))), path)


def _activity(spark: SparkSession, tables: Tables) -> tuple[list[DataFrame], list[DataFrame]]:
    """Where the daily look-back finds active days: (events tables, stored activity tables)."""
    if tables.activity and inc.table_exists(spark, tables.activity):
        return [], [inc.read_table(spark, tables.activity)]
    return [inc.read_table(spark, tables.events)], []


def run_daily_tables(spark: SparkSession, feed: DataFrame, orders: DataFrame, customer_types: DataFrame,
                     products: DataFrame, tables: Tables, opts: FeedOptions = DAILY) -> dict[str, dt.date]:
    """One daily run of events, purchases, items and sessions; returns each table's mark."""
    paths = tables.as_dict()
    for p in paths.values():
        inc.drop_latest_day(spark, p)
    marks = {k: inc.high_water_mark(spark, p) for k, p in paths.items()}
    with staging(spark):
        oldest = _after(feed, min(marks.values()))
        ids = staged(batch_order_ids(oldest))
        orders = staged(orders_in_batch(orders, ids, id_bounds(ids)))
        shared = None
        if marks["events"] == marks["items"] == marks["sessions"]:
            shared = number_batch(_after(feed, marks["events"]).select(*SHARED_COLUMNS))

        _write(spark, build_events(_after(feed, marks["events"]), orders, opts, shared), tables.events)
        _write(spark, build_purchases(_after(feed, marks["purchases"]), orders, opts), tables.purchases)
        _write(spark, build_items(_after(feed, marks["items"]), orders, products, opts, shared), tables.items)

        stored_events = inc.read_table(spark, tables.events)
        stored_purchases = inc.read_table(spark, tables.purchases)
        if tables.activity:
            keep_activity(spark, stored_events, tables.activity, marks["events"])
        events, stored = _activity(spark, tables)
        nu = new_users(stored_events, events, stored_purchases, customer_types, marks["sessions"], stored_activity=stored)
        _write(spark, build_sessions(_after(feed, marks["sessions"]), orders, nu, opts, shared), tables.sessions)
        return marks


def run_intraday_tables(spark: SparkSession, feed: DataFrame, orders: DataFrame, customer_types: DataFrame,
                        products: DataFrame, daily: Tables, tail: Tables, opts: FeedOptions = INTRADAY,
                        days: Collection[dt.date] | None = None) -> dict[str, dt.date]:
    """Rebuild the four tail tables from the provisional feed (full overwrite).

    With ``days``, only those days are rebuilt, and in the sessions table also every later day, as a
    user seen on one day is not new on the next 31; the files of other days stay as they are.  Days
    that the daily table holds by now are dropped.  As in a daily run, ``s_no`` numbers the rows that
    are built together."""
    marks = {k: inc.high_water_mark(spark, p) for k, p in daily.as_dict().items()}

    def part(name: str) -> DataFrame:
        rows = _after(feed, marks[name])
        if days is None:
            return rows
        first = min(days, default=NO_DAY)
        return rows.filter(F.col("event_date") >= F.lit(first) if name == "sessions" else F.col("event_date").isin(*days))

    def put(name: str, df: DataFrame) -> None:
        path = tail.as_dict()[name]
        if days is None:
            inc.overwrite_table(df, path)
            return
        _write(spark, df, path)
        inc.drop_days(spark, path, [d for d in inc.stored_days(spark, path) if d <= marks[name]])

    with staging(spark):
        oldest = _after(feed, min(marks.values()))
        if days is not None:
            oldest = oldest.filter(F.col("event_date") >= F.lit(min(days, default=NO_DAY)))
        ids = staged(batch_order_ids(oldest))
        orders = staged(orders_in_batch(orders, ids, id_bounds(ids)))
        put("events", build_events(part("events"), orders, opts))
        put("purchases", build_purchases(part("purchases"), orders, opts))
        put("items", build_items(part("items"), orders, products, opts))
        tail_events = inc.read_table(spark, tail.events)
        events, stored = _activity(spark, daily)
        nu = new_users(tail_events, [*events, tail_events], inc.read_table(spark, tail.purchases), customer_types,
                       marks["sessions"], keep_null_user=False, stored_activity=stored)
        put("sessions", build_sessions(part("sessions"), orders, nu, opts))
        return marks


def scratch_tables(spark: SparkSession, prefix: str, activity: bool = False) -> Tables:
    names = ("events", "purchases", "items", "sessions", *(["activity"] if activity else []))
    return Tables(*[inc.scratch_target(spark, f"{prefix}-{n}") for n in names])
