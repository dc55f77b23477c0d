"""The DuckDB half of :mod:`webtrail.present`: format columns by their known kind."""

from __future__ import annotations

TS = {"event_timestamp", "user_first_touch_timestamp", "session_start_timestamp", "session_end_timestamp"}
DATES = {"event_date", "high_water_mark"}


def present_sql(body: str, columns: list[str], decimals=(), doubles=(), ints=()) -> str:
    """``SELECT`` over ``body`` that formats ``columns`` like ``webtrail.present.present``.

    Timestamps and dates are recognised by name; ``decimals`` and ``ints`` are
    cast to double, ``doubles`` rounded to six places.
    """
    out = []
    for c in columns:
        q = f'"{c}"'
        if c in TS:
            e = f"strftime({q}, '%Y-%m-%d %H:%M:%S.%f')"
        elif c in DATES:
            e = f"strftime({q}, '%Y-%m-%d')"
        elif c in decimals:
            e = f"CAST({q} AS DOUBLE)"
        elif c in doubles:
            e = f"round(CAST({q} AS DOUBLE), 6)"
        elif c in ints:
            e = f"CAST({q} AS DOUBLE)"
        else:
            e = q
        out.append(f"{e} AS {q}")
    return "SELECT " + ", ".join(out) + f" FROM ({body}) AS _r"
