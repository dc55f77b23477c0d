"""Small scalar helpers: identity keys, text cleaning, variant colour/size split."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Placeholders that mean "no value".
NOT_SET = "(not set)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def unique_user_id(user_pseudo_id, user_id) -> Column:
    """Pseudo id, else the signed-in user id."""
    return F.coalesce(_c(user_pseudo_id), _c(user_id))


def unique_session_id(session_id, user_pseudo_id, user_id) -> Column:
    """``session:pseudo``; else the unique user; else the bare session id.

    ``concat`` is null when any part is null, like SQL ``||``.
    """
    return F.coalesce(
        F.concat(_c(session_id), F.lit(":"), _c(user_pseudo_id)),
        unique_user_id(user_pseudo_id, user_id),
        _c(session_id),
    )


def not_set_to_null(x) -> Column:
    """trim(x), null when it is ``(not set)``."""
    t = F.trim(_c(x))
    return F.when(t == F.lit(NOT_SET), F.lit(None).cast("string")).otherwise(t)


def blank_to_null(x) -> Column:
    """trim(x), null when it is empty or ``(not set)``."""
    t = F.trim(_c(x))
    return F.when(t.isin("", NOT_SET), F.lit(None).cast("string")).otherwise(t)


def lower_trim(x) -> Column:
    return F.lower(F.trim(_c(x)))


def variant_color_size(variant, product_family) -> tuple[Column, Column]:
    """Split ``'A / B'`` or ``'X / A / B'`` into (colour, size).

    Three or more parts and a family not like ``%bras%`` take parts 1 and 2,
    otherwise parts 0 and 1; a null family gives the second case.  Double quotes
    are removed from the parts.  No `` / `` gives (null, null).
    """
    v = F.trim(_c(variant))
    parts = F.split(v, " / ", -1)
    three = (F.size(parts) > 2) & ~F.coalesce(_c(product_family).ilike("%bras%"), F.lit(True))
    has_sep = F.coalesce(v.contains(" / "), F.lit(False))

    def part(i):
        return F.replace(F.get(parts, i), F.lit('"'), F.lit(""))

    color = F.when(has_sep, F.when(three, part(1)).otherwise(part(0)))
    size = F.when(has_sep, F.when(three, part(2)).otherwise(part(1)))
    return color, size


def item_key(item_name, item_id) -> Column:
    """Order-line key of an item: lower(trim(name)) for gift cards, else trim(id)."""
    return F.when(F.lower(_c(item_name)).like("%gift card%"), F.lower(F.trim(_c(item_name)))) \
        .otherwise(F.trim(_c(item_id)))
