"""New users of a day - a first visit, no activity in the 31 days before, and no
same-day purchase of an order whose customer is a returning buyer.

The 31-day range join is rewritten as an equi-join: each first-visit row is
expanded to its 31 look-back dates and semi-joined with the distinct
(user, day) pairs that had a named event.  Both sides are keyed by (user, day),
so the join shuffles on an equality key and never compares ranges; a user's
row count on the activity side is at most one per day.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# New-user rule constants.
FIRST_VISIT = "first_visit"
LOOKBACK_DAYS = 31
RETURN_CUSTOMER = "RETURN"


def first_visit_users(events: DataFrame, mark) -> DataFrame:
    return (events.filter((F.col("event_name") == FIRST_VISIT) & (F.col("event_date") > F.lit(mark)))
            .select("event_date", "unique_user_id").distinct())


def user_days(events: DataFrame) -> DataFrame:
    """Distinct (event_date, user) with at least one named event (``count(event_name) > 0``): what a run
    stores of its days, so that later look-backs need not read their events again."""
    return (events.filter(F.col("event_name").isNotNull() & F.col("unique_user_id").isNotNull())
            .select("event_date", "unique_user_id").distinct())


def _in_reach(days: DataFrame, mark) -> DataFrame:
    """The days that a look-back from past ``mark`` can reach: a static bound on the scanned partitions."""
    return days.filter(F.col("event_date") > F.date_sub(F.lit(mark), LOOKBACK_DAYS))


def active_days(events: DataFrame, mark) -> DataFrame:
    """(user, active day) of the events in reach."""
    return user_days(_in_reach(events, mark)).select("unique_user_id", F.col("event_date").alias("active_date"))


def users_with_lookback_activity(fv: DataFrame, activity: DataFrame) -> DataFrame:
    days = F.sequence(F.date_sub("event_date", LOOKBACK_DAYS), F.date_sub("event_date", 1))
    expanded = fv.select("unique_user_id", "event_date", F.explode(days).alias("active_date"))
    return (expanded.join(activity, ["unique_user_id", "active_date"], "left_semi")
            .select("unique_user_id", "event_date").distinct())


def returning_buyers(purchases: DataFrame, customer_types: DataFrame, mark) -> DataFrame:
    """(user, day) with a purchase of a returning customer's order, on days past the mark."""
    ret = customer_types.filter(F.col("customer_type") == RETURN_CUSTOMER).select("shopify_order_id")
    p = purchases.filter(F.col("event_date") > F.lit(mark)).select("event_date", "unique_user_id", "shopify_order_id")
    return p.join(ret, "shopify_order_id", "left_semi").select("unique_user_id", "event_date").distinct()


def new_users(first_visit_events: DataFrame, activity_events: Sequence[DataFrame], purchases: DataFrame,
              customer_types: DataFrame, mark, keep_null_user: bool = True,
              stored_activity: Sequence[DataFrame] = ()) -> DataFrame:
    """(event_date, unique_user_id) of new users for days past ``mark``.

    ``activity_events`` lists every events table whose look-back activity
    disqualifies a user (the daily table; intraday adds the provisional one);
    ``stored_activity`` lists tables of :func:`user_days` that stand in for events.
    A null user never matches any activity: the daily rule keeps it (no activity
    found), the intraday rule drops it (no count to compare with zero).
    """
    fv = first_visit_users(first_visit_events, mark)
    if not keep_null_user:
        fv = fv.filter(F.col("unique_user_id").isNotNull())
    stored = [_in_reach(a, mark).select("unique_user_id", F.col("event_date").alias("active_date")) for a in stored_activity]
    activity = reduce(lambda a, b: a.unionByName(b), [active_days(e, mark) for e in activity_events] + stored)
    seen = users_with_lookback_activity(fv, activity)
    out = fv.join(seen, ["unique_user_id", "event_date"], "left_anti")
    out = out.join(returning_buyers(purchases, customer_types, mark), ["unique_user_id", "event_date"], "left_anti")
    return out.select("event_date", "unique_user_id")
