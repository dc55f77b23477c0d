"""The classification rules as DuckDB SQL, written by hand from the rules' definition.

Nothing is taken from the engine's rule tables: patterns are regular expressions here (a
LIKE wildcard ``_`` is ``.``), so a wrong literal on either side shows as a difference.
"""

from __future__ import annotations


def lit(v) -> str:
    if v is None:
        return "NULL"
    return "'" + str(v).replace("'", "''") + "'"


def _has(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {lit(pattern)}, 's')"


def source_sql(x: str) -> str:
    return f"""CASE
        WHEN {_has(x, 'fb pixel|facebook|fb-ad')} OR {x} = 'fb' THEN 'facebook'
        WHEN contains({x}, 'yahoo') THEN 'yahoo'
        WHEN contains({x}, 'google') OR contains({x}, 'adwords') THEN 'google'
        WHEN contains({x}, 'youtube') THEN 'youtube'
        WHEN contains({x}, 'tb12') THEN 'tb12'
        WHEN contains({x}, 'tiktok') THEN 'tiktok'
        WHEN contains({x}, 'yandex') THEN 'yandex'
        WHEN contains({x}, 'wikipedia') THEN 'wikipedia'
        ELSE nullif({x}, 'data not available') END"""


def medium_sql(x: str) -> str:
    return f"""CASE
        WHEN {x} = 'aff' OR contains({x}, 'affiliate') THEN 'affiliate'
        WHEN {x} IN ('shop', 'shop_web') THEN 'shop'
        WHEN {x} = 'ema' OR contains({x}, 'email') THEN 'email'
        WHEN contains({x}, 'organic instagram') THEN 'organic instagram'
        WHEN starts_with({x}, 'web') THEN 'web'
        WHEN contains({x}, 'partnership') THEN 'partnership'
        WHEN {_has(x, 'directmail|direct.mail')} THEN 'direct mail'
        WHEN {_has(x, 'paid.social|paidsocial')} THEN 'paid social'
        WHEN {_has(x, 'social.feed|socialfeed')} THEN 'social feed'
        WHEN {_has(x, 'social.media|socialmedia')} THEN 'social media'
        WHEN contains({x}, 'koala') THEN 'koala inspector'
        ELSE nullif({x}, 'data not available') END"""


# Source names of the two organic channels (searched for, case-sensitive).  A
# doubled backslash is one backslash and then any character, as the warehouse reads it.
_SEARCH = (r"360\\.cn|alice|aol|ask|auone|avg|babylon|baidu|biglobe|bing|centrum\\.cz|cnn|comcast|conduit|daum|dogpile|"
           r"duckduckgo|ecosia\\.org|seznam|eniro|exalead\\.com|excite\\.com|firmy|globo|go\\.mail\\.ru|google|google-play|"
           r"incredimail|kvasir|qwant|lycos|naver|sogou|yandex|rambler|msn|najdi|onet|rakuten|search|so\\.com|startsiden|"
           r"terra|tut\\.by|ukr|virgilio|google shopping|igshopping|amazon|alibaba|shopify|stripe|ebay|etsy|mercadolibre|"
           r"shopping|walmart|shop")
_SOCIAL = "facebook|instagram|twitter|linkedin|pinterest|reddit|igshopping|meta|tiktok|ig|social|snapchat"


def channel_sql(source: str, medium: str, campaign: str, platform: str | None = None, partnership=(), fix=False) -> str:
    """The 17 channel rules in order, else Unassigned; ``platform`` only in the session form."""
    s, m, c, p = (f"coalesce({x}, '')" if x else "''" for x in (source, medium, campaign, platform))

    def low(x: str, pattern: str) -> str:
        return f"regexp_matches(lower({x}), {lit(pattern)}, 's')"

    partner = "".join(f" OR contains(lower({c}), {lit(x.lower())})" for x in partnership)
    search = _SEARCH.replace(r"\\.", r"\.") if fix else _SEARCH
    return f"""CASE
        WHEN {low(s, 'mntn|tatari|ctv')} OR {low(m, 'tv|television.prospecting')} THEN 'TV'
        WHEN {low(s, 'youtube')} OR {low(c, 'youtube|demandgen|dgen')} THEN 'YouTube'
        WHEN {low(m, 'ppc|cpc')} AND {low(c, 'brand')} AND NOT {low(c, 'performance max')} THEN 'Paid Brand Search'
        WHEN {low(m, 'partnership')} OR {low(s, 'partnership')}{partner} THEN 'Partnership'
        WHEN ({low(m, 'affiliate')} OR {low(s, r'impact|(api|shop)[.]id[.]me')} OR {low(c, 'ebates|befrugal[.]com')})
             AND NOT {low(s, 'spotify|tb12')} THEN 'Affiliates'
        WHEN ({low(m, 'cpc|paid.shopping|paid.search')} OR {low(p, 'google ads')} OR {low(c, 'pla.|pmax|search')})
             AND NOT {low(c, 'brand|junky|ebates')} THEN 'Paid Non-Brand Search'
        WHEN ({low(s, 'facebook|instagram|meta|igshopping')} OR {s} = 'tinuiti') AND {low(m, 'paid')} THEN 'Paid Social'
        WHEN {low(s, 'tiktok')} AND {low(m, 'paid')} THEN 'TikTok'
        WHEN {low(s, 'email|e.mail|bluecore|emarsys')} OR {low(m, 'email|e.mail')} THEN 'Email'
        WHEN {low(m, 'sms|text')} OR {low(s, 'attentive')} OR {s} = 'sms' THEN 'SMS'
        WHEN {low(s, 'spotify|podcast')} OR {low(m, 'audio')} THEN 'Audio'
        WHEN {low(s, 'twitter')} AND {low(m, 'paid')} THEN 'Twitter'
        WHEN {low(s, 'pinterest')} AND {low(m, 'paid')} THEN 'Pinterest'
        WHEN {m} = 'organic' OR regexp_matches({s}, {lit(search)}) OR {low(c, 'shop')} THEN 'Organic Search'
        WHEN (regexp_matches({s}, {lit(_SOCIAL)}) OR {low(m, 'social')} OR {m} = 'sm' OR {low(s, 'x[.]com')})
             AND NOT {low(m, 'paid')} THEN 'Organic Social'
        WHEN {low(s, 'narvar|direct')} OR {low(m, '[(]not set[)]|[(]none[)]|direct')} THEN 'Direct'
        WHEN ({low(m, 'referral|app|link')} OR {low(s, 'tb12|klaviyo|breakaway')})
             AND NOT {low(s, r'api[.]id[.]me|klarna')} THEN 'Referral'
        ELSE 'Unassigned' END"""


def gender_sql(externalid: str, item_name: str, dim_gender: str) -> str:
    name = f"lower({item_name})"
    return f"""CASE
        WHEN contains(lower({externalid}), 'nvd') THEN 'SHIPPING PROTECTION SKU'
        WHEN contains({name}, 'gift') THEN 'UNISEX'
        WHEN contains({name}, 'women') THEN 'FEMALE'
        WHEN contains({name}, 'men') THEN 'MALE'
        ELSE {dim_gender} END"""
