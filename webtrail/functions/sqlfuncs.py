"""The four classification functions as temporary SQL functions of a session.

The rule tables of :mod:`webtrail.functions.rules` are rendered as SQL text, so a
``spark.sql`` user gets the same native expressions as the ``Column`` functions.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from webtrail.functions import rules
from webtrail.functions.rules import ChannelConfig


def _text(value: str | None) -> str:
    return "NULL" if value is None else "r'" + value + "'"


def _condition(cond, columns: dict[str, str]) -> str:
    kind, *rest = cond
    if kind in ("or", "and"):
        return "(" + f" {kind.upper()} ".join(_condition(c, columns) for c in rest[0]) + ")"
    if kind == "not":
        return f"(NOT {_condition(rest[0], columns)})"
    operator = {"like": "LIKE", "ilike": "ILIKE", "rlike": "RLIKE", "eq": "="}[kind]
    return f"{columns[rest[0]]} {operator} {_text(rest[1])}"


def _case(table, columns: dict[str, str], default: str) -> str:
    whens = " ".join(f"WHEN {_condition(c, columns)} THEN {_text(result)}" for result, c in table)
    return f"CASE {whens} ELSE {default} END"


def register(spark: SparkSession, cfg: ChannelConfig = ChannelConfig()) -> list[str]:
    """Create ``normalize_source(x)``, ``normalize_medium(x)``, ``channel_acquisition(source, medium,
    campaign)`` and ``channel_session(source, medium, campaign, platform)``; returns their names."""
    found = {
        "normalize_source": (["x"], _case(rules.SOURCE_RULES, {"x": "x"}, "x")),
        "normalize_medium": (["x"], _case(rules.MEDIUM_RULES, {"x": "x"}, "x")),
    }
    for name, fields in (("channel_acquisition", ["source", "medium", "campaign"]),
                         ("channel_session", ["source", "medium", "campaign", "platform"])):
        columns = {f[0]: f"coalesce({f}, '')" for f in fields}
        table = rules.channel_rules("platform" in fields, cfg.partnership_campaigns, cfg.fix_domain_tokens)
        columns = {"s": columns["s"], "m": columns["m"], "c": columns["c"], **({"p": columns["p"]} if "p" in columns else {})}
        found[name] = (fields, _case(table, columns, _text(rules.UNASSIGNED)))
    for name, (fields, body) in found.items():
        arguments = ", ".join(f"{f} STRING" for f in fields)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS STRING RETURN {body}")
    return list(found)
