"""Channel classification rules as Column expressions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from adtrail.functions.measures import as_column
from adtrail.functions.text import is_blank, trimmed

# --- fixed values -----------------------------------------------------------
ORGANIC_WORDS = ["organic", "search", "natural", "seo", "unpaid"]
SEARCH_ENGINES = ["bing", "yahoo", "duckduckgo", "baidu", "yandex", "qwant"]
META_WORDS = ["facebook", "fb", "instagram", "ig", "meta", "igshopping"]
DIRECT_WORDS = ["direct", "none", "null", ""]
EMPTY_WORDS = ["", "null", "none"]
DOMAIN_PARTS = [".com", ".co.", ".org", ".net", ".in", ".uk"]
SOCIAL_MEDIUMS = ["social", "social-media", "socialmedia"]

SEARCH_SITES = ["google.com", "bing.com", "yahoo.com", "duckduckgo.com"]
SOCIAL_SITES = ["facebook.com", "instagram.com", "twitter.com", "linkedin.com"]
SITE_PARTS = [".com", ".co.", ".org", ".net"]
ORGANIC_HINTS = ["search", "organic", "seo", "unpaid", "natural", "shopify"]
SOCIAL_HINTS = ["social", "facebook", "instagram", "fb", "ig", "igshopping"]

PAID_CHANNELS = ["Meta", "Google"]

SOURCE_CHANNELS = {
    "google": "Google",
    "an": "Google",
    "Google": "Google",
    "facebook": "Meta",
    "Facebook": "Meta",
    "fb": "Meta",
    "instagram": "Meta",
    "ig": "Meta",
    "IGShopping": "Meta",
    "shopify": "Organic",
    "duckduckgo": "Organic",
    "organic": "Organic",
    "search": "Organic",
    "direct": "Direct",
    "{{site_source_name}}": "Meta",
    "null": "Direct/Unknown",
    "": "Direct/Unknown",
}

UTM_SOURCE_CHANNELS = {
    "facebook": "Facebook",
    "fb": "Facebook",
    "instagram": "Instagram",
    "ig": "Instagram",
    "google": "Google",
    "shopify": "Direct",
    "duckduckgo": "DuckDuckGo",
    "email": "Email",
    "mail": "Email",
    "referral": "Referral",
    "direct": "Direct",
    "organic": "Organic",
    "social": "Social",
}

# (source, medium, campaign, content patterns, channel, sub channel, category, platform, priority)
CHANNEL_RULES = [
    ("facebook|fb", "cpc|paid", None, None, "Facebook", "Paid Social", "paid", "facebook", 10),
    ("instagram|ig", "cpc|paid", None, None, "Instagram", "Paid Social", "paid", "instagram", 10),
    ("google", "cpc|paid", None, None, "Google", "Paid Search", "paid", "google", 10),
    ("google", "display", None, None, "Google", "Display", "paid", "google", 9),
    ("facebook|fb", "social|organic", None, None, "Facebook", "Organic Social", "organic", "facebook", 5),
    ("instagram|ig", "social|organic", None, None, "Instagram", "Organic Social", "organic", "instagram", 5),
    ("email|mail", "email", None, None, "Email", "Newsletter", "email", "email", 8),
    ("direct|(null)|^$", None, None, None, "Direct", "Direct", "direct", "direct", 1),
    ("referral", None, None, None, "Referral", "External Sites", "organic", "referral", 3),
]
# ----------------------------------------------------------------------------

RULE_OUTPUTS = ["channel", "sub_channel", "channel_category", "platform"]


def any_of(value: Column, words: list[str]) -> Column:
    """True where the text contains one of the words (plain text, one pattern for all)."""
    return value.rlike("|".join(re.escape(w) for w in words))


def clean(value) -> Column:
    """Trimmed lower-case text, '' for null."""
    return F.lower(trimmed(F.coalesce(as_column(value), F.lit(""))))


def channel_of(source, medium, campaign, content, term, cleaned: bool = False) -> Column:
    """Meta / Google / Organic / Direct from the UTM fields; the first rule that fits wins.

    ``cleaned`` tells that the fields went through ``clean`` already, in a
    projection of their own, so that the rules do not clean them again each.
    """
    prepare = as_column if cleaned else clean
    source, medium, campaign, content, term = map(prepare, (source, medium, campaign, content, term))
    google = source.contains("google") | medium.contains("google")
    named_campaign = ~campaign.isin(EMPTY_WORDS)
    return (
        F.when(named_campaign & google, "Google")
        .when(named_campaign, "Meta")
        .when(any_of(medium, ORGANIC_WORDS) | any_of(source, ORGANIC_WORDS), "Organic")
        .when(any_of(source, SEARCH_ENGINES), "Organic")
        .when(google & ((content != "") | (term != "")), "Google")
        .when(google, "Organic")
        .when(any_of(source, META_WORDS) | (source == "{{site_source_name}}"), "Meta")
        .when(source.contains("an"), "Google")
        .when(
            source.isin(DIRECT_WORDS) | medium.isin(DIRECT_WORDS),
            F.when(~source.isin(EMPTY_WORDS) & (F.length(source) > 1), "Organic").otherwise("Direct"),
        )
        .when(medium == "referral", "Organic")
        .when(any_of(source, DOMAIN_PARTS), "Organic")
        .when(medium.isin(SOCIAL_MEDIUMS), "Meta")
        .when(medium == "email", "Direct")
        .when(medium == "cpc", "Google")
        .otherwise("Organic")
    )


def hinted_channel(referrer, journey, attributes) -> Column:
    """Channel guessed from referrer URL, then journey text, then attribute text."""
    url = F.when(~is_blank(referrer), F.lower(as_column(referrer)))
    steps = F.lower(F.when(~is_blank(journey), as_column(journey)))
    pairs = F.lower(F.when(~is_blank(attributes, array=True), as_column(attributes)))
    return (
        F.when(any_of(url, SEARCH_SITES), "Organic")
        .when(any_of(url, SOCIAL_SITES), "Meta")
        .when(url.contains("shopify.com") | any_of(url, SITE_PARTS), "Organic")
        .when(any_of(steps, ORGANIC_HINTS), "Organic")
        .when(any_of(steps, SOCIAL_HINTS), "Meta")
        .when(any_of(pairs, ORGANIC_HINTS), "Organic")
        .when(any_of(pairs, SOCIAL_HINTS), "Meta")
        .otherwise("Direct")
    )


def mapped_channel(source, default: str | None = None) -> Column:
    """Exact lookup of the source in the static dictionary."""
    source = as_column(source)
    chain = F
    for word, channel in SOURCE_CHANNELS.items():
        chain = chain.when(source == word, channel)
    return chain.otherwise(F.lit(default))


def utm_channel_of(source, medium) -> Column:
    """Facebook / Instagram / Google / Paid / Social / Email / ... of the UTM session model."""
    source = F.lower(as_column(source))
    medium = F.lower(F.coalesce(as_column(medium), F.lit("")))
    facebook = any_of(source, ["facebook", "fb"])
    instagram = any_of(source, ["instagram", "ig"])
    chain = (
        F.when(source.isNull() | (source == ""), "Direct")
        .when(
            medium.isin("cpc", "paid", "ppc"),
            F.when(facebook, "Facebook")
            .when(instagram, "Instagram")
            .when(source.contains("google"), "Google")
            .otherwise("Paid"),
        )
        .when(
            medium.isin("social", "organic"),
            F.when(facebook, "Facebook").when(instagram, "Instagram").otherwise("Social"),
        )
        .when((medium == "email") | source.contains("email"), "Email")
        .when(medium == "referral", "Referral")
    )
    for word, channel in UTM_SOURCE_CHANNELS.items():
        chain = chain.when(source.contains(word), channel)
    return chain.otherwise("Other")


def _pattern_fits(value: Column, pattern: str | None) -> Column:
    return value.isNull() if pattern is None else F.coalesce(value.rlike(pattern), F.lit(False))


def ruled_channel(source, medium, campaign, content, rules=None) -> Column:
    """Struct (channel, sub_channel, channel_category, platform) of the best rule, or null.

    Rules are configuration, so they become one CASE chain in priority order:
    no join, no cross product, nothing to broadcast. Equal priorities keep the
    order the rules are given in.
    """
    rules = CHANNEL_RULES if rules is None else rules
    values = [as_column(v) for v in (source, medium, campaign, content)]
    chain = None
    for rule in sorted(rules, key=lambda r: -r[8]):
        fits = reduce(lambda a, b: a & b, [_pattern_fits(v, p) for v, p in zip(values, rule[:4])])
        result = F.struct(*[F.lit(v).alias(n) for v, n in zip(rule[4:8], RULE_OUTPUTS)])
        chain = (F if chain is None else chain).when(fits, result)
    return chain


def ruled_by_table(df, table, columns: list[str], out: str = "rule"):
    """``df`` with the best active rule of a rule table as a struct (null where none fits).

    ``columns`` are the source, medium, campaign and content columns. Each
    distinct tuple of them meets the rules once; the rules, hand-kept
    configuration, are one array inside the plan, so patterns need no join of
    every tuple with every rule. Equal priorities go by the lower rule id.
    """
    patterns = ["utm_source_pattern", "utm_medium_pattern", "utm_campaign_pattern", "utm_content_pattern"]
    rank = [F.col("priority").alias("priority"), (-F.col("rule_id")).alias("last")]
    rules = table.where("is_active").agg(F.collect_list(F.struct(*rank, *RULE_OUTPUTS, *patterns))).scalar()
    tuples = df.select(*columns).distinct().withColumn("_rules", rules)

    def fits(rule):
        each = [
            F.when(rule[p].isNull(), F.col(c).isNull()).otherwise(F.coalesce(F.regexp_like(F.col(c), rule[p]), F.lit(False)))
            for c, p in zip(columns, patterns)
        ]
        return reduce(lambda a, b: a & b, each)

    best = F.array_max(F.filter("_rules", fits))
    found = tuples.select(
        *[F.col(c).alias(f"_of_{c}") for c in columns], F.when(best.isNotNull(), F.struct(*[best[o].alias(o) for o in RULE_OUTPUTS])).alias(out)
    )
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in columns])
    return df.join(found, same, "left").drop(*[f"_of_{c}" for c in columns])


def platform_of(source, medium) -> Column:
    """Google / Meta / Other ad platform."""
    source, medium = as_column(source), as_column(medium)
    return (
        F.when(source.isin("google", "googleads") | medium.isin("cpc", "paid_search"), "Google")
        .when(source.isin("facebook", "instagram") | medium.isin("social"), "Meta")
        .otherwise("Other")
    )


def match_status(ads_key, utm_key) -> Column:
    ads_key, utm_key = as_column(ads_key), as_column(utm_key)
    return (
        F.when(ads_key.isNotNull() & utm_key.isNotNull(), "matched")
        .when(ads_key.isNotNull(), "ads_only")
        .when(utm_key.isNotNull(), "utm_only")
        .otherwise("unmatched")
    )
