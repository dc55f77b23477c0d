"""Ordered classification rules compiled to native Spark ``Column`` expressions.

Each rule table is plain data: a list of ``(result, condition)`` pairs evaluated
first-hit-wins, like a searched ``CASE``.  A condition is a small tree:

* ``("like", field, pattern)``   case-sensitive LIKE (``%`` and ``_`` wildcards)
* ``("ilike", field, pattern)``  case-insensitive LIKE
* ``("eq", field, value)``       equality
* ``("rlike", field, regex)``    regex search anywhere in the string
* ``("or", [..])`` / ``("and", [..])`` / ``("not", cond)``

``compile_rules`` turns a table into one ``F.when`` chain, so Catalyst keeps it
inside whole-stage codegen and no Python runs per row.  The same tables are
rendered to SQL text by :mod:`oracle.rulesql` for the DuckDB cross-check.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Any, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Cond = tuple

# ---------------------------------------------------------------------------
# These literals must equal the reference behaviour exactly.
# ---------------------------------------------------------------------------

# Traffic-source normaliser; input is already lower-cased and trimmed.
SOURCE_RULES: list[tuple[Any, Cond]] = [
    ("facebook", ("or", [("like", "x", "%fb pixel%"), ("like", "x", "%facebook%"),
                         ("eq", "x", "fb"), ("like", "x", "%fb-ad%")])),
    ("yahoo", ("like", "x", "%yahoo%")),
    ("google", ("or", [("like", "x", "%google%"), ("like", "x", "%adwords%")])),
    ("youtube", ("like", "x", "%youtube%")),
    ("tb12", ("like", "x", "%tb12%")),
    ("tiktok", ("like", "x", "%tiktok%")),
    ("yandex", ("like", "x", "%yandex%")),
    ("wikipedia", ("like", "x", "%wikipedia%")),
    (None, ("eq", "x", "data not available")),
]

# Traffic-medium normaliser; ``_`` is a one-character wildcard here.
MEDIUM_RULES: list[tuple[Any, Cond]] = [
    ("affiliate", ("or", [("eq", "x", "aff"), ("like", "x", "%affiliate%")])),
    ("shop", ("or", [("eq", "x", "shop"), ("eq", "x", "shop_web")])),
    ("email", ("or", [("eq", "x", "ema"), ("like", "x", "%email%")])),
    ("organic instagram", ("like", "x", "%organic instagram%")),
    ("web", ("like", "x", "web%")),
    ("partnership", ("like", "x", "%partnership%")),
    ("direct mail", ("or", [("like", "x", "%directmail%"), ("like", "x", "%direct_mail%"),
                            ("like", "x", "%direct mail%")])),
    ("paid social", ("or", [("like", "x", "%paid social%"), ("like", "x", "%paid_social%"),
                            ("like", "x", "%paid-social%"), ("like", "x", "%paidsocial%")])),
    ("social feed", ("or", [("like", "x", "%social feed%"), ("like", "x", "%social_feed%"),
                            ("like", "x", "%socialfeed%")])),
    ("social media", ("or", [("like", "x", "%social media%"), ("like", "x", "%social_media%"),
                             ("like", "x", "%socialmedia%")])),
    ("koala inspector", ("like", "x", "%koala%")),
    (None, ("eq", "x", "data not available")),
]

# Organic-search source tokens (regex alternatives, case-sensitive), in the reference's order.
# The dotted domains carry a doubled backslash in the reference's SQL text, which the
# warehouse reads as "backslash + any character"; so they never match a plain domain.
ORGANIC_SEARCH_TOKENS: list[str] = [
    "360\\\\.cn", "alice", "aol", "ask", "auone", "avg", "babylon", "baidu", "biglobe", "bing",
    "centrum\\\\.cz", "cnn", "comcast", "conduit", "daum", "dogpile", "duckduckgo",
    "ecosia\\\\.org", "seznam", "eniro", "exalead\\\\.com", "excite\\\\.com", "firmy", "globo",
    "go\\\\.mail\\\\.ru", "google", "google-play", "incredimail", "kvasir", "qwant", "lycos",
    "naver", "sogou", "yandex", "rambler", "msn", "najdi", "onet", "rakuten", "search",
    "so\\\\.com", "startsiden", "terra", "tut\\\\.by", "ukr", "virgilio", "google shopping",
    "igshopping", "amazon", "alibaba", "shopify", "stripe", "ebay", "etsy", "mercadolibre",
    "shopping", "walmart", "shop",
]

# Organic-social source tokens (regex alternatives, case-sensitive).
ORGANIC_SOCIAL_TOKENS: list[str] = [
    "facebook", "instagram", "twitter", "linkedin", "pinterest", "reddit", "igshopping", "meta",
    "tiktok", "ig", "social", "snapchat",
]

# Channel names, in rule order.
CHANNELS: list[str] = [
    "TV", "YouTube", "Paid Brand Search", "Partnership", "Affiliates", "Paid Non-Brand Search",
    "Paid Social", "TikTok", "Email", "SMS", "Audio", "Twitter", "Pinterest", "Organic Search",
    "Organic Social", "Direct", "Referral", "Unassigned",
]


def _il(f: str, *pats: str) -> list[Cond]:
    return [("ilike", f, p) for p in pats]


def _fix_domain(tok: str) -> str:
    return tok.replace("\\\\.", "\\.")


def _regex(tokens: Sequence[str], fix_domain_tokens: bool) -> str:
    toks = [_fix_domain(t) if fix_domain_tokens else t for t in tokens]
    return "|".join(toks)


def channel_rules(
    with_platform: bool,
    partnership_campaigns: Sequence[str] = (),
    fix_domain_tokens: bool = False,
) -> list[tuple[Any, Cond]]:
    """The 17 ordered channel rules plus the ``Unassigned`` default.

    Fields: ``s`` source, ``m`` medium, ``c`` campaign, ``p`` platform; all are
    ``coalesce(x, '')`` so no condition is ever null.  ``with_platform`` adds the
    platform test of the session form to the paid non-brand search rule.
    ``partnership_campaigns`` are the brand-specific campaign names of the
    partnership rule (configuration, not code).
    """
    nonbrand_any = _il("m", "%cpc%", "%paid_shopping%", "%paid_search%")
    if with_platform:
        nonbrand_any += _il("p", "%google ads%")
    nonbrand_any += _il("c", "%pla_%", "%pmax%", "%search%")
    email_any = (_il("s", "%email%", "%e-mail%", "%e_mail%", "%e mail%")
                 + _il("m", "%email%", "%e-mail%", "%e_mail%", "%e mail%")
                 + _il("s", "%bluecore%", "%emarsys%"))
    partnership_any = _il("m", "%partnership%") + _il("s", "%partnership%") + [
        ("ilike", "c", f"%{name}%") for name in partnership_campaigns
    ]
    return [
        ("TV", ("or", _il("s", "%mntn%") + _il("m", "%tv%") + _il("s", "%tatari%")
                + _il("m", "%television_prospecting%") + _il("s", "%ctv%"))),
        ("YouTube", ("or", _il("s", "%youtube%") + _il("c", "%youtube%", "%demandgen%", "%dgen%"))),
        ("Paid Brand Search", ("and", [("or", _il("m", "%ppc%", "%cpc%")), ("ilike", "c", "%brand%"),
                                       ("not", ("ilike", "c", "%performance max%"))])),
        ("Partnership", ("or", partnership_any)),
        ("Affiliates", ("and", [
            ("or", _il("m", "%affiliate%") + _il("s", "%impact%", "%api.id.me%", "%shop.id.me%")
             + _il("c", "%Ebates%", "%BeFrugal.com%")),
            ("not", ("or", _il("s", "%spotify%", "%tb12%"))),
        ])),
        ("Paid Non-Brand Search", ("and", [
            ("or", nonbrand_any),
            ("not", ("or", _il("c", "%brand%", "%junky%", "%Ebates%"))),
        ])),
        ("Paid Social", ("and", [
            ("or", _il("s", "%facebook%", "%instagram%", "%meta%", "%igshopping%") + [("eq", "s", "tinuiti")]),
            ("ilike", "m", "%paid%"),
        ])),
        ("TikTok", ("and", [("ilike", "s", "%tiktok%"), ("ilike", "m", "%paid%")])),
        ("Email", ("or", email_any)),
        ("SMS", ("or", _il("m", "%sms%", "%text%") + _il("s", "%attentive%") + [("eq", "s", "sms")])),
        ("Audio", ("or", _il("s", "%spotify%", "%podcast%") + _il("m", "%audio%"))),
        ("Twitter", ("and", [("ilike", "s", "%twitter%"), ("ilike", "m", "%paid%")])),
        ("Pinterest", ("and", [("ilike", "s", "%pinterest%"), ("ilike", "m", "%paid%")])),
        ("Organic Search", ("or", [("eq", "m", "organic"),
                                   ("rlike", "s", _regex(ORGANIC_SEARCH_TOKENS, fix_domain_tokens)),
                                   ("ilike", "c", "%shop%")])),
        ("Organic Social", ("and", [
            ("or", [("rlike", "s", _regex(ORGANIC_SOCIAL_TOKENS, fix_domain_tokens)),
                    ("ilike", "m", "%social%"), ("eq", "m", "sm"), ("ilike", "s", "%x.com%")]),
            ("not", ("ilike", "m", "%paid%")),
        ])),
        ("Direct", ("or", _il("s", "%narvar%", "%direct%") + _il("m", "%(not set)%", "%(none)%", "%direct%"))),
        ("Referral", ("and", [
            ("or", _il("m", "%referral%", "%app%", "%link%") + _il("s", "%TB12%", "%Klaviyo%", "%breakaway%")),
            ("not", ("or", _il("s", "%api.id.me%", "%klarna%"))),
        ])),
    ]


UNASSIGNED = "Unassigned"


# ---------------------------------------------------------------------------
# compiler
# ---------------------------------------------------------------------------

def compile_cond(cond: Cond, cols: Mapping[str, Column], lowercase_inputs: bool = False) -> Column:
    """``lowercase_inputs``: the inputs are known to be lower case, so ILIKE is a
    plain LIKE with a lower-cased pattern (no per-pattern ``lower()`` of the input)."""
    op = cond[0]
    if op == "or":
        return reduce(lambda a, b: a | b, [compile_cond(c, cols, lowercase_inputs) for c in cond[1]])
    if op == "and":
        return reduce(lambda a, b: a & b, [compile_cond(c, cols, lowercase_inputs) for c in cond[1]])
    if op == "not":
        return ~compile_cond(cond[1], cols, lowercase_inputs)
    col = cols[cond[1]]
    arg = cond[2]
    if op == "like":
        return col.like(arg)
    if op == "ilike":
        return col.like(arg.lower()) if lowercase_inputs else col.ilike(arg)
    if op == "eq":
        return col == F.lit(arg)
    if op == "rlike":
        return col.rlike(arg)
    raise ValueError(f"unknown rule op {op!r}")


def compile_rules(rules: Sequence[tuple[Any, Cond]], cols: Mapping[str, Column], default: Column,
                  lowercase_inputs: bool = False) -> Column:
    expr = None
    for result, cond in rules:
        c = compile_cond(cond, cols, lowercase_inputs)
        value = F.lit(result).cast("string")
        expr = F.when(c, value) if expr is None else expr.when(c, value)
    return expr.otherwise(default)


# ---------------------------------------------------------------------------
# public Column -> Column functions
# ---------------------------------------------------------------------------

def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def normalize_source(source) -> Column:
    """Map raw traffic sources to a canonical name; unknown values pass through."""
    x = _c(source)
    return compile_rules(SOURCE_RULES, {"x": x}, x)


def normalize_medium(medium) -> Column:
    """Map raw traffic mediums to a canonical name; unknown values pass through."""
    x = _c(medium)
    return compile_rules(MEDIUM_RULES, {"x": x}, x)


@dataclass(frozen=True)
class ChannelConfig:
    """Brand-specific literals of the channel rules; neutral by default."""

    partnership_campaigns: tuple[str, ...] = ()
    fix_domain_tokens: bool = False


def _channel(cols: dict[str, Column], with_platform: bool, cfg: ChannelConfig, lowercase_inputs: bool) -> Column:
    cols = {k: F.coalesce(v, F.lit("")) for k, v in cols.items()}
    rules = channel_rules(with_platform, cfg.partnership_campaigns, cfg.fix_domain_tokens)
    return compile_rules(rules, cols, F.lit(UNASSIGNED), lowercase_inputs)


def channel_acquisition(source, medium, campaign, cfg: ChannelConfig = ChannelConfig(),
                        lowercase_inputs: bool = False) -> Column:
    """Acquisition channel grouping of (source, medium, campaign).

    Pass ``lowercase_inputs=True`` only when every input is already lower case
    (the table builders clean traffic columns with ``lower(trim())``)."""
    return _channel({"s": _c(source), "m": _c(medium), "c": _c(campaign)}, False, cfg, lowercase_inputs)


def channel_session(source, medium, campaign, platform, cfg: ChannelConfig = ChannelConfig(),
                    lowercase_inputs: bool = False) -> Column:
    """Session channel grouping; as acquisition plus the platform test."""
    return _channel({"s": _c(source), "m": _c(medium), "c": _c(campaign), "p": _c(platform)}, True, cfg,
                    lowercase_inputs)


# ---------------------------------------------------------------------------
# product gender rule
# ---------------------------------------------------------------------------

# Gender labels of the product rule.
GENDER_SHIPPING = "SHIPPING PROTECTION SKU"
GENDER_UNISEX = "UNISEX"
GENDER_MALE = "MALE"
GENDER_FEMALE = "FEMALE"


def product_gender(externalid, item_name, dim_gender) -> Column:
    """Gender from id and name rules, else the dimension's gender; first match wins."""
    eid = F.lower(_c(externalid))
    name = F.lower(_c(item_name))
    return (
        F.when(eid.like("%nvd%"), F.lit(GENDER_SHIPPING))
        .when(name.like("%gift%"), F.lit(GENDER_UNISEX))
        .when(name.like("%men%") & ~name.like("%women%"), F.lit(GENDER_MALE))
        .when(name.like("%women%"), F.lit(GENDER_FEMALE))
        .otherwise(_c(dim_gender))
    )
