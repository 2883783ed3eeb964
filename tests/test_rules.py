"""Scalar rules on tiny frames: one row per rule or edge case."""

import pytest
from pyspark.sql import functions as F

from adtrail.functions import channels, journey, measures, text

CHANNELS = [
    ("google", "cpc", "c1", None, None, "Google"),
    ("newsletter", "email", "c1", None, None, "Meta"),
    ("ig", "organic", None, None, None, "Organic"),
    ("search", "x", None, None, None, "Organic"),
    ("bing", "cpc", None, None, None, "Organic"),
    ("google", "cpc", None, "5", None, "Google"),
    ("google", "cpc", None, None, None, "Organic"),
    ("digital", "x", None, None, None, "Meta"),
    ("{{site_source_name}}", "x", None, None, None, "Meta"),
    ("brand", "x", None, None, None, "Google"),
    ("direct", "x", None, None, None, "Organic"),
    ("klaviyo", None, None, None, None, "Organic"),
    (None, None, None, None, None, "Direct"),
    (None, "email", None, None, None, "Direct"),
    ("blog", "referral", None, None, None, "Organic"),
    ("shop.co.uk", "x", None, None, None, "Organic"),
    ("twitter", "social", None, None, None, "Meta"),
    ("klaviyo", "email", None, None, None, "Direct"),
    ("klaviyo", "cpc", None, None, None, "Google"),
    ("klaviyo", "x", None, None, None, "Organic"),
    (" Google ", "CPC", "null", "5", None, "Google"),
]


def test_channel_rules(spark):
    schema = "source string, medium string, campaign string, content string, term string, expected string"
    df = spark.createDataFrame(CHANNELS, schema)
    got = df.withColumn("got", channels.channel_of("source", "medium", "campaign", "content", "term"))
    assert [r.asDict() for r in got.where("got <> expected").collect()] == []


def test_utm_channel_rules(spark):
    cases = [
        (None, "cpc", "Direct"), ("", None, "Direct"), ("fb", "cpc", "Facebook"), ("IG", "PPC", "Instagram"),
        ("google", "paid", "Google"), ("bing", "cpc", "Paid"), ("facebook", "social", "Facebook"), ("x", "organic", "Social"),
        ("x", "email", "Email"), ("my-email", "y", "Email"), ("x", "referral", "Referral"), ("shopify", "y", "Direct"),
        ("duckduckgo", None, "DuckDuckGo"), ("mailer", None, "Email"), ("zzz", None, "Other"),
    ]
    df = spark.createDataFrame(cases, "s string, m string, expected string")
    rows = df.withColumn("got", channels.utm_channel_of("s", "m")).where("got <> expected").collect()
    assert rows == []


JOURNEYS = [
    ('{"moments":[{"utmParameters":{"source":"ig","content":"11"}},{"utmParameters":{"source":"fb","content":"22"}}]}', "22", "content"),
    ('{"moments":[{"utmParameters":{"content":"{{ad.id}}","campaign":"33"}}]}', "33", "campaign"),
    ('{"moments":[{"utmParameters":{"content":"11"}},{"utmParameters":{"source":"fb"}}]}', "11", "content"),
    ('{"moments":[{"utmParameters":{"medium":"44"}}]}', "44", "medium"),
    ('{"moments":[null,{"utmParameters":{"content":"null"}}]}', None, None),
    ('{"moments":[{"utmParameters":{"content":12}}]}', "12", "content"),
    ("", None, None), ("  ", None, None), ("null", None, None), ("None", None, None),
    ("{}", None, None), ('{"moments":[]}', None, None), ("{bad", None, None), (None, None, None),
]


def test_journey_cases(spark):
    df = spark.createDataFrame(JOURNEYS, "j string, id string, kind string")
    touch = journey.journey_touch("j")
    rows = df.select("*", touch["attribution_id"].alias("got"), touch["attribution_type"].alias("got_kind")).collect()
    assert [(r.got, r.got_kind) for r in rows] == [(r.id, r.kind) for r in rows]


def test_attribute_cases(spark):
    cases = [
        ('[{"key":"utm_content","value":"9"},{"key":"x","value":"y"}]', "9", "9"),
        ('[{"key":"utm_content","value":"1"},{"key":"utm_content","value":"2"}]', "2", "1"),
        ('[{"key":"fbclid","value":"z"}]', None, None),
        ("[]", None, None), (" ", None, None), ("[bad", None, None),
    ]
    df = spark.createDataFrame(cases, "a string, last string, first string")
    rows = df.select(
        "*", journey.attributes_touch("a")["attribution_id"].alias("got_last"), journey.attributes_ad_id("a").alias("got_first")
    ).collect()
    assert [(r.got_last, r.got_first) for r in rows] == [(r.last, r.first) for r in rows]


def test_ids_and_hours(spark):
    ids = [("1.2e+4", "12000"), ("123456789012345678", "123456789012345678"), ("", "Unknown"), ("Unknown", "Unknown"), (None, "Unknown"), ("Facebook_UA", "Facebook_UA")]
    df = spark.createDataFrame(ids, "v string, expected string")
    assert df.withColumn("got", text.normal_id("v")).where("got <> expected").count() == 0
    hours = [("5", 5), ("05:00", 5), ("23:00:00 - 23:59:59", 23), ("24", 0), ("abc", None), (None, None)]
    rows = spark.createDataFrame(hours, "v string, hour int").withColumn("got", text.normal_hour_window("v")).collect()
    assert [r.got for r in rows] == [None if h is None else f"{h:02d}:00:00 - {h:02d}:59:59" for _, h in hours]


def test_rule_table(spark):
    cases = [
        ("facebook", "cpc", None, None, "Paid Social"), ("facebook", "social", None, None, "Organic Social"),
        ("google", "display", None, None, "Display"), ("direct", None, None, None, "Direct"),
        ("referral", None, None, None, "External Sites"), ("google", "cpc", "c", None, None), ("Google", "cpc", None, None, None),
    ]
    df = spark.createDataFrame(cases, "s string, m string, c string, n string, expected string")
    rows = df.withColumn("got", channels.ruled_channel("s", "m", "c", "n")["sub_channel"]).collect()
    assert [r.got for r in rows] == [r.expected for r in rows]


def test_a_rule_table_gives_what_the_rules_give(spark):
    rows = [(i, *r, True) for i, r in enumerate(channels.CHANNEL_RULES)] + [(99, ".*", ".*", ".*", ".*", "X", "X", "x", "x", 99, False)]
    schema = (
        "rule_id int, utm_source_pattern string, utm_medium_pattern string, utm_campaign_pattern string, utm_content_pattern string, "
        "channel string, sub_channel string, channel_category string, platform string, priority int, is_active boolean"
    )
    table = spark.createDataFrame(rows, schema)
    values = [None, "facebook", "fb", "google", "Google", "cpc", "social", "display", "direct", "referral", "email", "x"]
    df = spark.createDataFrame([(s, m, c, None) for s in values for m in values for c in (None, "c")], "s string, m string, c string, n string")
    got = channels.ruled_by_table(df, table, ["s", "m", "c", "n"]).withColumn("want", channels.ruled_channel("s", "m", "c", "n"))
    assert got.where(~F.col("rule").eqNullSafe(F.col("want"))).count() == 0 and got.count() == df.count()
    assert got.where("rule is not null").count() >= 9


def test_safe_ratios(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (1.0, 4.0), (41.0, 40.0)], "a double, b double")
    rows = df.select(
        measures.safe_div("a", "b").alias("s"), measures.ratio("a", "b").alias("r"), measures.safe_div("a", "b", 1, 2).alias("h")
    ).collect()
    assert [r.s for r in rows] == [0.0, 0.0, 0.25, 1.025]
    assert [r.r for r in rows] == [None, None, 0.25, 1.025]
    assert rows[3].h == 1.03


def test_hinted_channel(spark):
    cases = [
        ("https://www.google.com/x", None, None, "Organic"), ("http://l.facebook.com", None, None, "Meta"),
        ("https://admin.shopify.com", None, None, "Organic"), ("https://blog.example.org", None, None, "Organic"),
        (None, '{"a":"organic"}', None, "Organic"), ("null", '{"a":"fb"}', None, "Meta"), (None, None, '[{"k":"social"}]', "Meta"),
        (None, "null", "[]", "Direct"), (None, None, None, "Direct"),
    ]
    df = spark.createDataFrame(cases, "u string, j string, a string, expected string")
    assert df.withColumn("got", channels.hinted_channel("u", "j", "a")).where("got <> expected").count() == 0


def test_price_check(spark):
    df = spark.createDataFrame([(10.0, 5.0, 2.0), (10.0, 5.0, 3.0), (10.0, None, 3.0)], "a double, p double, u double")
    got = [r[0] for r in df.select(measures.price_check("a", "p", "u")).collect()]
    assert got == ["Matches", "Mismatch (Actual: 10.00, Expected: 15.00)", "Matches"]
