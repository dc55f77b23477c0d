"""Classification rules: one fixture per rule and trap, plus a randomised check
against a plain-Python evaluator of the same rule tables."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from webtrail.functions import rules


def _eval(spark, expr_fn, rows, cols):
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    return [r[0] for r in df.select(expr_fn(*[F.col(c) for c in cols])).collect()]


@pytest.mark.parametrize("value,expected", [
    ("my fb pixel", "facebook"), ("facebook.com", "facebook"), ("fb", "facebook"), ("fbx", "fbx"),
    ("m.fb-ad", "facebook"), ("yahoo", "yahoo"), ("adwords", "google"), ("google.com", "google"),
    ("youtube", "youtube"), ("tb12sports", "tb12"), ("tiktok", "tiktok"), ("yandex.ru", "yandex"),
    ("en.wikipedia.org", "wikipedia"), ("data not available", None), (None, None), ("bing", "bing"),
])
def test_normalize_source(spark, value, expected):
    assert _eval(spark, rules.normalize_source, [(value,)], ["x"]) == [expected]


@pytest.mark.parametrize("value,expected", [
    ("aff", "affiliate"), ("my affiliate", "affiliate"), ("shop", "shop"), ("shop_web", "shop"),
    ("shopping", "shopping"), ("ema", "email"), ("email", "email"), ("organic instagram", "organic instagram"),
    ("web_app", "web"), ("partnership", "partnership"), ("direct-mail", "direct mail"), ("directmail", "direct mail"),
    ("paid-social", "paid social"), ("social_feed", "social feed"), ("socialmedia", "social media"),
    ("koala", "koala inspector"), ("data not available", None), (None, None), ("cpc", "cpc"),
])
def test_normalize_medium(spark, value, expected):
    assert _eval(spark, rules.normalize_medium, [(value,)], ["x"]) == [expected]


CFG = rules.ChannelConfig(partnership_campaigns=("creator collective",))


@pytest.mark.parametrize("s,m,c,expected", [
    ("mntn", None, None, "TV"), (None, "ctv", None, "TV"), ("youtube", "cpc", None, "YouTube"),
    (None, "cpc", "brand_x", "Paid Brand Search"), (None, "cpc", "performance max brand", "Unassigned"),
    (None, None, "Creator Collective", "Partnership"), ("impact", None, None, "Affiliates"),
    ("spotify", "affiliate", None, "Audio"), (None, None, "display", "Paid Non-Brand Search"),
    (None, None, "pla", "Unassigned"), ("facebook", "paid", None, "Paid Social"), ("tinuiti", "paid", None, "Paid Social"),
    ("tiktok", "paid", None, "TikTok"), ("bluecore", None, None, "Email"), (None, "e mail", None, "Email"),
    (None, "sms", None, "SMS"), ("attentive", None, None, "SMS"), ("podcast", None, None, "Audio"),
    ("twitter", "paid", None, "Twitter"), ("pinterest", "paid", None, "Pinterest"),
    (None, "organic", None, "Organic Search"), ("bing", None, None, "Organic Search"),
    ("360.cn", None, None, "Unassigned"), ("instagram", None, None, "Organic Social"),
    ("x.com", None, None, "Organic Social"), ("narvar", None, None, "Direct"), (None, "(none)", None, "Direct"),
    (None, "referral", None, "Referral"), ("klarna", "referral", None, "Unassigned"),
    (None, None, None, "Unassigned"),
])
def test_channel_acquisition(spark, s, m, c, expected):
    got = _eval(spark, lambda a, b, d: rules.channel_acquisition(a, b, d, CFG), [(s, m, c)], ["s", "m", "c"])
    assert got == [expected]


def test_platform_only_in_session_form(spark):
    row = [("newsletter2", "none2", "x", "Google Ads")]
    acq = _eval(spark, lambda a, b, c, d: rules.channel_acquisition(a, b, c, CFG), row, ["s", "m", "c", "p"])
    ses = _eval(spark, lambda a, b, c, d: rules.channel_session(a, b, c, d, CFG), row, ["s", "m", "c", "p"])
    assert acq == ["Unassigned"] and ses == ["Paid Non-Brand Search"]


def test_fixed_domain_tokens_option(spark):
    cfg = rules.ChannelConfig(fix_domain_tokens=True)
    got = _eval(spark, lambda a, b, c: rules.channel_acquisition(a, b, c, cfg), [("360.cn", None, None)], ["s", "m", "c"])
    assert got == ["Organic Search"]


# ---- randomised: the compiled Column equals a plain-Python reading of the same table ----

def _like(value, pattern, ci):
    rx = "".join(".*" if ch == "%" else "." if ch == "_" else re.escape(ch) for ch in pattern)
    flags = re.S | (re.I if ci else 0)
    return re.fullmatch(rx, value, flags) is not None


def _py_cond(cond, vals):
    op = cond[0]
    if op == "or":
        return any(_py_cond(c, vals) for c in cond[1])
    if op == "and":
        return all(_py_cond(c, vals) for c in cond[1])
    if op == "not":
        return not _py_cond(cond[1], vals)
    v = vals[cond[1]]
    if op == "like":
        return _like(v, cond[2], False)
    if op == "ilike":
        return _like(v.lower(), cond[2].lower(), False)
    if op == "eq":
        return v == cond[2]
    if op == "rlike":
        return re.search(cond[2], v) is not None
    raise ValueError(op)


def _py_channel(s, m, c, p, with_platform):
    vals = {"s": s or "", "m": m or "", "c": c or "", "p": p or ""}
    for result, cond in rules.channel_rules(with_platform, CFG.partnership_campaigns):
        if _py_cond(cond, vals):
            return result
    return rules.UNASSIGNED


TOKENS = ["google", "cpc", "paid", "brand", "social", "ig", "e_mail", "pla", "x", "TV", "Shop", "sms", "app",
          "referral", "klarna", "(none)", "direct", "ebates", "search", "360.cn", "meta", "", " "]
text = st.one_of(st.none(), st.lists(st.sampled_from(TOKENS), max_size=3).map("".join))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(text, text, text, text), min_size=1, max_size=20))
def test_channels_match_plain_python(spark, rows):
    got = _eval(spark, lambda a, b, c, d: rules.channel_session(a, b, c, d, CFG), rows, ["s", "m", "c", "p"])
    assert got == [_py_channel(*r, with_platform=True) for r in rows]
