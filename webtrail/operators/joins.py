"""Join helpers: skew-safe left joins on nullable keys."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_SALT_PREFIX = "\u0000unmatched:"


def salted_key(key: Column, salt: Column) -> Column:
    """Replace a null join key by a unique value that can match nothing.

    Rows whose key is null (or that must not join) would all hash to one shuffle
    partition; salting spreads them while keeping them unmatched.
    """
    return F.coalesce(key, F.concat(F.lit(NULL_SALT_PREFIX), salt.cast("string")))


def left_join_split(left: DataFrame, right: DataFrame, left_key: Column, right_key: str, keep: Column | None = None,
                    placeholders: Sequence[str] = ()) -> DataFrame:
    """Left join where only rows with ``keep`` and a non-null key that is no placeholder can match.

    Those rows go through the join; every other row bypasses it with null right
    columns and is unioned back, so it is never shuffled.  Meant for a ``left``
    that is cheap to read twice (a checkpointed or stored batch): when a small
    share of rows can match (purchases among all events) the shuffle shrinks to
    that share.  ``right`` must be unique on ``right_key``.
    """
    k = left_key.cast("string")
    can = k.isNotNull() if keep is None else (F.coalesce(keep, F.lit(False)) & k.isNotNull())
    if placeholders:
        can = can & ~F.coalesce(k.isin(*placeholders), F.lit(False))
        right = right.filter(~F.col(right_key).cast("string").isin(*placeholders))
    extra = [c for c in right.columns if c != right_key]
    joinable = left.filter(can).withColumn("__jk", k)
    r = right.select(F.col(right_key).cast("string").alias("__jk"), *extra)
    joined = joinable.join(r, "__jk", "left").drop("__jk")
    rest = left.filter(~can).withColumns({c: F.lit(None).cast(right.schema[c].dataType) for c in extra})
    return joined.unionByName(rest)
