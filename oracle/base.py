"""Shared pieces of the check SQL: the mapped tables and the attributed orders, as CTEs."""

from __future__ import annotations

import re

from adtrail.sources.testbed import BOOK, UTM_CASES


def rnd(expr: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def div(num: str, den: str, scale: float = 1, digits: int | None = None) -> str:
    """0 where the denominator is not positive."""
    q = f"CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE)" + ("" if scale == 1 else f" * {float(scale)}")
    out = f"(CASE WHEN {den} > 0 THEN {q} ELSE 0.0 END)"
    return out if digits is None else rnd(out, digits)


def rat(num: str, den: str, scale: float = 1, digits: int | None = None) -> str:
    """Null where the denominator is 0."""
    q = f"CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE)" + ("" if scale == 1 else f" * {float(scale)}")
    out = f"(CASE WHEN {den} <> 0 THEN {q} END)"
    return out if digits is None else rnd(out, digits)


def avg(expr: str) -> str:
    return rat(f"SUM({expr})", f"COUNT({expr})")


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def day(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def ts(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def cond(test: str) -> str:
    return f"CAST(COUNT(*) FILTER (WHERE {test}) AS BIGINT)"


def text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


N = "CAST(COUNT(*) AS BIGINT)"
AD_KEYS = "campaign_id, campaign_name, adset_id, adset_name, ad_id, ad_name"
UTM = "utm_source, utm_medium, utm_campaign, utm_content, utm_term"

CTE: dict[str, str] = {}

CTE["cases"] = (
    "SELECT * FROM (VALUES "
    + ", ".join("(" + ", ".join([str(i), *[text(v) for v in c]]) + ")" for i, c in enumerate(UTM_CASES))
    + ") AS v(idx, s, m, c, n, t)"
)
CTE["book"] = (
    "SELECT * FROM (VALUES "
    + ", ".join(f"({i}, {text(p)}, {text(t)}, {price}, {margin})" for i, (p, t, price, margin) in enumerate(BOOK))
    + ") AS v(book_order, product, search, price, margin)"
)

CTE["ev"] = """SELECT event_id, ts, user_id, event_type, CAST(value AS DECIMAL(15,2)) AS value,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"""

_NAMES = """'1202213430906' || (k % 5 + 40000) AS campaign_id, 'Campaign ' || (k % 5) AS campaign_name,
    '1202213430907' || (k % 20 + 50000) AS adset_id, 'Adset ' || (k % 20) AS adset_name,
    '1202213430908' || (k + 60000) AS ad_id, 'Ad ' || k AS ad_name"""
CTE["evk"] = f"SELECT *, {_NAMES} FROM ev"

CTE["ads0"] = """SELECT CAST(ts AS DATE) AS date_start, hour(ts) AS h, k,
    COUNT(*) FILTER (WHERE event_type = 'view') AS impressions,
    COUNT(*) FILTER (WHERE event_type = 'click') AS clicks,
    COALESCE(SUM(value) FILTER (WHERE event_type IN ('view', 'click')), 0) AS spend,
    COUNT(*) FILTER (WHERE event_type = 'purchase') AS purchases,
    COALESCE(SUM(value) FILTER (WHERE event_type = 'purchase'), 0) AS pvalue,
    COUNT(*) FILTER (WHERE event_type = 'signup') AS carts,
    COUNT(*) FILTER (WHERE event_type = 'error') AS checkouts
    FROM ev GROUP BY ALL"""
CTE["ads"] = f"""SELECT *, {_NAMES}, printf('%02d:00:00 - %02d:59:59', h, h) AS hour_label,
    {div('spend', 'impressions', 1000)} AS cpm, {div('spend', 'clicks')} AS cpc, {div('clicks', 'impressions', 100)} AS ctr
    FROM ads0"""
CTE["daily"] = f"""SELECT date_start, {AD_KEYS}, SUM(impressions) AS impressions, SUM(clicks) AS clicks, SUM(spend) AS spend,
    SUM(purchases) AS purchases, SUM(pvalue) AS pvalue, SUM(carts) AS carts, SUM(checkouts) AS checkouts
    FROM ads GROUP BY date_start, {AD_KEYS}"""

_IDS = """CASE {f} WHEN '@ad' THEN '1202213430908' || (kk + 60000) WHEN '@adset' THEN '1202213430907' || (kk % 20 + 50000)
    WHEN '@campaign' THEN '1202213430906' || (kk % 5 + 40000) ELSE {f} END"""
CTE["ord0"] = f"""SELECT o.*, (o_orderkey // 7) % 120 AS kk, o_orderkey % 7 AS path,
    DATE '1992-01-01' AS base, v.s AS s0, v.m AS m0, v.c AS c0, v.n AS n0, v.t AS t0
    FROM orders o JOIN cases v ON v.idx = o.o_custkey % {len(UTM_CASES)}"""
CTE["ord1"] = "SELECT *, " + ", ".join(f"{_IDS.format(f=f + '0')} AS {f}" for f in "smcnt") + """,
    DATE '2024-01-01' + CAST(date_diff('day', base, CAST(o_orderdate AS DATE)) % 30 AS INTEGER) AS order_date FROM ord0"""


def _moment(fields: dict[str, str]) -> str:
    parts = " || ',' || ".join(
        f"""'"{name}":' || COALESCE('"' || {sql} || '"', 'null')""" for name, sql in fields.items()
    )
    return "('{\"utmParameters\":{' || " + parts + " || '}}')"


_THIS = _moment({"source": "s", "medium": "m", "campaign": "c", "content": "n", "term": "t"})
_EARLIER = _moment({
    "source": "'google'", "medium": "'organic'", "campaign": "CAST(NULL AS VARCHAR)",
    "content": "('1202213430908' || ((kk + 1) % 120 + 60000))", "term": "CAST(NULL AS VARCHAR)",
})


def _pair(key: str, sql: str) -> str:
    return f"""'{{"key":"{key}","value":"' || {sql} || '"}}'"""


_STAMP = "strftime(order_ts, '%Y-%m-%d %H:%M:%S') || '+0530'"
CTE["ord2"] = "SELECT *, order_date + INTERVAL 1 HOUR * (o_orderkey % 24) + INTERVAL 1 MINUTE * ((o_orderkey // 24) % 60) AS order_ts FROM ord1"
CTE["ord"] = f"""SELECT 'gid://shop/Order/' || o_orderkey AS order_id, '#' || o_orderkey AS order_name, order_date, order_ts,
    CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN {_STAMP} END AS cancelled_at_ist,
    CAST(o_totalprice AS DECIMAL(15,2)) AS order_value, 'cust_' || o_custkey AS customer_id, o_custkey,
    {', '.join(f"CASE WHEN path >= 5 OR o_orderkey % 2 = 0 THEN {a} END AS d_{b}" for a, b in zip('smcnt', ('source', 'medium', 'campaign', 'content', 'term')))},
    CASE path WHEN 0 THEN '{{"moments":[' || {_EARLIER} || ',' || {_THIS} || ']}}'
        WHEN 1 THEN '{{"moments":[' || {_THIS} || ']}}'
        WHEN 2 THEN '{{"moments":[' || {_THIS} || ',null]}}'
        WHEN 6 THEN CASE WHEN o_orderkey % 2 = 0 THEN '{{bad' ELSE 'null' END END AS journey,
    CASE WHEN path IN (3, 4) THEN '[' || concat_ws(',', '{{"key":"gift","value":"yes"}}',
            CASE WHEN path = 4 THEN {_pair('utm_content', "('1202213430908' || ((kk + 2) % 120 + 60000))")} END,
            {_pair('utm_source', 's')}, {_pair('utm_medium', 'm')}, {_pair('utm_campaign', 'c')},
            {_pair('utm_content', 'n')}, {_pair('utm_term', 't')}) || ']'
        WHEN path = 5 THEN '[]' END AS attrs
    FROM ord2"""

# Journey: the last moment with a usable id.
CTE["mom"] = """SELECT order_id, unnest(l) AS m, generate_subscripts(l, 1) AS i FROM (
    SELECT order_id, json_extract(journey, '$.moments[*]') AS l FROM ord WHERE json_valid(journey) AND journey <> 'null')"""
_OK = "({0} IS NOT NULL AND {0} NOT IN ('', 'null') AND NOT starts_with({0}, '{{{{'))"
CTE["momf"] = """SELECT order_id, i, json_extract_string(m, '$.utmParameters.source') AS s, json_extract_string(m, '$.utmParameters.medium') AS m,
    json_extract_string(m, '$.utmParameters.campaign') AS c, json_extract_string(m, '$.utmParameters.content') AS n,
    json_extract_string(m, '$.utmParameters.term') AS t FROM mom"""
CTE["jt"] = f"""SELECT * FROM (SELECT order_id, s, m, c, n, t,
    CASE WHEN {_OK.format('n')} THEN n WHEN {_OK.format('c')} THEN c WHEN {_OK.format('m')} THEN m END AS id,
    CASE WHEN {_OK.format('n')} THEN 'content' WHEN {_OK.format('c')} THEN 'campaign' WHEN {_OK.format('m')} THEN 'medium' END AS kind, i
    FROM momf) WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY i DESC) = 1"""
CTE["att"] = """SELECT order_id, json_extract_string(p, '$.key') AS key, json_extract_string(p, '$.value') AS value, i FROM (
    SELECT order_id, unnest(l) AS p, generate_subscripts(l, 1) AS i FROM (SELECT order_id, json_extract(attrs, '$[*]') AS l FROM ord WHERE attrs IS NOT NULL))"""
_LAST = "arg_max(value, i) FILTER (WHERE key = 'utm_{0}')"
_FIRST_ID = "COALESCE(NULLIF(n, ''), NULLIF(c, ''), NULLIF(m, ''))"
_FIRST_KIND = "CASE WHEN NULLIF(n, '') IS NOT NULL THEN 'content' WHEN NULLIF(c, '') IS NOT NULL THEN 'campaign' WHEN NULLIF(m, '') IS NOT NULL THEN 'medium' END"
CTE["att2"] = "SELECT order_id, " + ", ".join(
    f"{_LAST.format(f)} AS {a}" for a, f in zip("smcnt", ("source", "medium", "campaign", "content", "term"))
) + " FROM att GROUP BY order_id"
CTE["att3"] = f"SELECT *, {_FIRST_ID} AS id, {_FIRST_KIND} AS kind FROM att2 WHERE {_FIRST_ID} IS NOT NULL"
CTE["dt0"] = "SELECT order_id, " + ", ".join(
    f"CASE WHEN trim(d_{f}) <> '' THEN d_{f} END AS {a}" for a, f in zip("smcnt", ("source", "medium", "campaign", "content", "term"))
) + " FROM ord"
CTE["dt"] = f"SELECT *, {_FIRST_ID} AS id, {_FIRST_KIND} AS kind FROM dt0 WHERE {_FIRST_ID} IS NOT NULL"


def channel_case(s: str, m: str, c: str, n: str, t: str) -> str:
    """The 18 ordered channel rules."""
    return f"""(SELECT CASE
        WHEN c NOT IN ('', 'null', 'none') AND (contains(s, 'google') OR contains(m, 'google')) THEN 'Google'
        WHEN c NOT IN ('', 'null', 'none') THEN 'Meta'
        WHEN regexp_matches(m, 'organic|search|natural|seo|unpaid') THEN 'Organic'
        WHEN regexp_matches(s, 'organic|search|natural|seo|unpaid') THEN 'Organic'
        WHEN regexp_matches(s, 'bing|yahoo|duckduckgo|baidu|yandex|qwant') THEN 'Organic'
        WHEN (contains(s, 'google') OR contains(m, 'google')) AND (n <> '' OR t <> '') THEN 'Google'
        WHEN contains(s, 'google') OR contains(m, 'google') THEN 'Organic'
        WHEN regexp_matches(s, 'facebook|fb|instagram|ig|meta') THEN 'Meta'
        WHEN s = '{{{{site_source_name}}}}' THEN 'Meta'
        WHEN contains(s, 'an') THEN 'Google'
        WHEN s IN ('direct', 'none', 'null', '') OR m IN ('direct', 'none', 'null', '')
            THEN CASE WHEN s NOT IN ('', 'null', 'none') AND length(s) > 1 THEN 'Organic' ELSE 'Direct' END
        WHEN m = 'referral' THEN 'Organic'
        WHEN regexp_matches(s, '\\.com|\\.co\\.|\\.org|\\.net|\\.in|\\.uk') THEN 'Organic'
        WHEN m IN ('social', 'social-media', 'socialmedia') THEN 'Meta'
        WHEN m = 'email' THEN 'Direct'
        WHEN m = 'cpc' THEN 'Google'
        ELSE 'Organic' END
        FROM (SELECT lower(trim(COALESCE({s}, ''))) AS s, lower(trim(COALESCE({m}, ''))) AS m,
            lower(trim(COALESCE({c}, ''))) AS c, lower(trim(COALESCE({n}, ''))) AS n, lower(trim(COALESCE({t}, ''))) AS t))"""


_PICK = "CASE WHEN j.id IS NOT NULL THEN j.{0} WHEN a.id IS NOT NULL THEN a.{0} ELSE d.{0} END AS {1}"
CTE["tch"] = f"""SELECT o.*, CASE WHEN j.id IS NOT NULL THEN 'customer_journey' WHEN a.id IS NOT NULL THEN 'custom_attributes'
    WHEN d.id IS NOT NULL THEN 'direct_utm' END AS attribution_source,
    {', '.join(_PICK.format(x, y) for x, y in zip(('id', 'kind', 's', 'm', 'c', 'n', 't'), ('attribution_id', 'attribution_type', 'utm_source', 'utm_medium', 'utm_campaign', 'utm_content', 'utm_term')))}
    FROM ord o LEFT JOIN jt j USING (order_id) LEFT JOIN att3 a USING (order_id) LEFT JOIN dt d USING (order_id)"""
CTE["tch2"] = f"SELECT *, attribution_source IS NOT NULL AS is_attributed, {channel_case(*UTM.split(', '))} AS ch0 FROM tch"
CTE["tch3"] = "SELECT *, CASE WHEN NOT is_attributed AND ch0 = 'Meta' THEN 'Organic' ELSE ch0 END AS first_channel FROM tch2"
CTE["chan"] = """SELECT *, CASE WHEN first_channel = 'Direct' AND is_attributed THEN 'Meta' ELSE first_channel END AS channel,
    first_channel IN ('Meta', 'Google') OR (first_channel = 'Direct' AND is_attributed) AS is_paid_channel FROM tch3"""
CTE["act"] = "SELECT * FROM chan WHERE cancelled_at_ist IS NULL"

# Line items and their fold.
CTE["items"] = f"""SELECT 'gid://shop/Order/' || l_orderkey AS order_id,
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS INTEGER)) AS item_id,
    'var_' || l_partkey AS variant_id, 'Item ' || l_partkey AS product_title, CAST(l_quantity AS INTEGER) AS quantity,
    CAST({rnd('l_extendedprice / l_quantity', 2)} AS DECIMAL(10,2)) AS orig,
    CASE WHEN l_discount = 0 THEN 0 ELSE CAST({rnd('l_extendedprice / l_quantity * (1.0 - l_discount)', 2)} AS DECIMAL(10,2)) END AS disc
    FROM lineitem"""
CTE["vars"] = """SELECT 'var_' || p_partkey AS variant_id, CASE WHEN p_size = 2 THEN '' WHEN p_size > 1 THEN 'SKU-' || p_partkey END AS raw_sku,
    p_brand AS variant_title, CASE WHEN p_size <> 3 THEN CAST(p_retailprice AS DECIMAL(10,2)) END AS unit_cost, p_name AS variant_product_title,
    p_brand AS vendor, CAST(p_retailprice AS DECIMAL(10,2)) AS selling_price, CASE WHEN p_type <> 'PROMO' THEN p_type END AS product_category FROM part"""
CTE["lin"] = """SELECT *, CAST(quantity * unit_price AS DECIMAL(18,2)) AS rev, CAST(quantity * unit_cost AS DECIMAL(18,2)) AS cogs FROM (
    SELECT i.order_id, i.item_id, i.product_title, v.variant_title, NULLIF(v.raw_sku, '') AS sku, i.quantity,
        CASE WHEN i.disc = 0 THEN i.orig ELSE i.disc END AS unit_price, COALESCE(v.unit_cost, 0) AS unit_cost
    FROM items i LEFT JOIN vars v USING (variant_id))"""
CTE["fold"] = """SELECT order_id, SUM(cogs) AS total_cogs, COUNT(*) AS line_items_count,
    string_agg(DISTINCT sku, ', ' ORDER BY sku) AS skus, COUNT(DISTINCT sku) AS unique_skus_count,
    COALESCE(SUM(quantity) FILTER (WHERE sku IS NOT NULL), 0) AS total_sku_quantity FROM lin GROUP BY order_id"""

# First daily ad record under each id.
_REC = f"date_start, {AD_KEYS}, impressions, clicks, spend, purchases, pvalue"
CTE["firstad"] = f"""SELECT * FROM (
    SELECT 'content' AS kind, ad_id AS id, {_REC} FROM daily UNION ALL SELECT 'campaign', campaign_id, {_REC} FROM daily
    UNION ALL SELECT 'medium', adset_id, {_REC} FROM daily)
    QUALIFY row_number() OVER (PARTITION BY kind, id ORDER BY {_REC.split(', impressions')[0]}) = 1"""
_UNKNOWN = "CASE WHEN a.id IS NULL AND first_channel IN ('Meta', 'Google', 'Organic') THEN 'Unknown {0} - ' || first_channel ELSE a.{1} END AS {1}"
CTE["raw"] = f"""SELECT c.*, COALESCE(f.total_cogs, 0) AS total_cogs, COALESCE(f.line_items_count, 1) AS line_items_count, f.skus,
    COALESCE(f.unique_skus_count, 0) AS unique_skus_count, COALESCE(f.total_sku_quantity, 0) AS total_sku_quantity,
    a.campaign_id, {_UNKNOWN.format('Campaign', 'campaign_name')}, a.adset_id, {_UNKNOWN.format('Adset', 'adset_name')},
    a.ad_id, {_UNKNOWN.format('Ad', 'ad_name')}, COALESCE(a.impressions, 0) AS mi, COALESCE(a.clicks, 0) AS mc, COALESCE(a.spend, 0) AS ms,
    COALESCE(a.purchases, 0) AS mp, COALESCE(a.pvalue, 0) AS mv
    FROM act c LEFT JOIN fold f USING (order_id) LEFT JOIN firstad a ON a.kind = c.attribution_type AND a.id = c.attribution_id"""

CTE["adtot"] = "SELECT campaign_name, adset_name, ad_name, SUM(impressions) AS impressions, SUM(clicks) AS clicks, SUM(spend) AS spend FROM ads GROUP BY ALL"
CTE["adsum"] = f"SELECT {AD_KEYS}, SUM(impressions) AS impressions, SUM(clicks) AS clicks, SUM(spend) AS spend FROM ads GROUP BY ALL"

# Ad level.
CTE["olev"] = f"""SELECT {AD_KEYS}, channel, bool_and(is_attributed) AS attributed, COUNT(*) AS orders,
    COUNT(*) FILTER (WHERE is_attributed) AS attributed_orders, SUM(order_value) AS total_sales, SUM(total_cogs) AS total_cogs,
    SUM(unique_skus_count) AS total_unique_skus, SUM(total_sku_quantity) AS total_sku_quantity
    FROM raw WHERE campaign_name IS NOT NULL GROUP BY ALL"""
CTE["olevs"] = f"""SELECT {AD_KEYS}, channel, string_agg(DISTINCT sku, ', ' ORDER BY sku) AS all_skus FROM raw JOIN lin USING (order_id)
    WHERE campaign_name IS NOT NULL AND sku IS NOT NULL GROUP BY ALL"""


def same(left: str, right: str, columns: str) -> str:
    return " AND ".join(f"{left}.{c} IS NOT DISTINCT FROM {right}.{c}" for c in columns.split(", "))


CTE["lev"] = f"""SELECT {', '.join(f'COALESCE(a.{c}, o.{c}) AS {c}' for c in AD_KEYS.split(', '))}, COALESCE(o.channel, 'Unknown') AS channel,
    COALESCE(o.attributed, TRUE) AS attributed, COALESCE(o.orders, 0) AS orders, COALESCE(o.attributed_orders, 0) AS attributed_orders,
    COALESCE(o.total_sales, 0) AS total_sales, COALESCE(o.total_cogs, 0) AS total_cogs, COALESCE(a.impressions, 0) AS impressions,
    COALESCE(a.clicks, 0) AS clicks, COALESCE(a.spend, 0) AS spend, COALESCE(s.all_skus, '') AS all_skus,
    COALESCE(o.total_unique_skus, 0) AS total_unique_skus, COALESCE(o.total_sku_quantity, 0) AS total_sku_quantity,
    COALESCE(o.total_sales, 0) - COALESCE(o.total_cogs, 0) - COALESCE(a.spend, 0) AS net_profit
    FROM adsum a FULL JOIN olev o ON {same('a', 'o', AD_KEYS)}
    LEFT JOIN olevs s ON {same('o', 's', AD_KEYS + ', channel')} AND o.channel IS NOT NULL"""
CTE["level"] = f"""SELECT *, {div('total_sales', 'spend')} AS roas, {div('clicks', 'impressions', 100)} AS ctr,
    {div('orders', 'clicks', 100)} AS conversion_rate, {div('total_sales', 'orders')} AS avg_order_value,
    {div('net_profit', 'total_sales', 100)} AS profit_margin FROM lev"""

# SKU-to-ad mapping.
CTE["adid"] = f"""SELECT o.*, COALESCE(
    (SELECT NULLIF(arg_max(n, i), '') FROM momf WHERE momf.order_id = o.order_id AND {_OK.format('n')}),
    (SELECT NULLIF(arg_min(value, i), '') FROM att WHERE att.order_id = o.order_id AND key = 'utm_content'),
    NULLIF(trim(d_content), '')) AS ad_id FROM ord o"""
CTE["mapp"] = f"""SELECT o.order_id, o.order_name, o.order_date, o.order_value, o.ad_id, o.d_source, o.d_medium, o.d_campaign, o.d_content, o.d_term,
    l.item_id, l.sku, l.product_title, l.variant_title, l.quantity, l.unit_price, l.unit_cost, l.rev AS line_item_revenue,
    l.cogs AS line_item_cogs, l.rev - l.cogs AS line_item_profit, {div('(l.rev - l.cogs)', 'l.rev', 100)} AS profit_margin,
    a.campaign_id, a.campaign_name, a.adset_id, a.adset_name, a.ad_name, a.impressions, a.clicks, a.spend AS ad_spend, a.purchases, a.pvalue,
    {div('l.rev', 'a.spend')} AS roas, {div('a.spend', 'a.purchases')} AS cost_per_order
    FROM adid o JOIN daily a ON a.date_start = o.order_date AND a.ad_id = o.ad_id JOIN lin l ON l.order_id = o.order_id
    WHERE o.cancelled_at_ist IS NULL AND l.sku IS NOT NULL"""

# UTM model.
UTM_CHANNEL = """CASE WHEN COALESCE(d_source, '') = '' THEN 'Direct'
    WHEN lower(COALESCE(d_medium, '')) IN ('cpc', 'paid', 'ppc') THEN CASE WHEN regexp_matches(lower(d_source), 'facebook|fb') THEN 'Facebook'
        WHEN regexp_matches(lower(d_source), 'instagram|ig') THEN 'Instagram' WHEN contains(lower(d_source), 'google') THEN 'Google' ELSE 'Paid' END
    WHEN lower(COALESCE(d_medium, '')) IN ('social', 'organic') THEN CASE WHEN regexp_matches(lower(d_source), 'facebook|fb') THEN 'Facebook'
        WHEN regexp_matches(lower(d_source), 'instagram|ig') THEN 'Instagram' ELSE 'Social' END
    WHEN lower(COALESCE(d_medium, '')) = 'email' OR contains(lower(d_source), 'email') THEN 'Email'
    WHEN lower(COALESCE(d_medium, '')) = 'referral' THEN 'Referral'
    WHEN regexp_matches(lower(d_source), 'facebook|fb') THEN 'Facebook' WHEN regexp_matches(lower(d_source), 'instagram|ig') THEN 'Instagram'
    WHEN contains(lower(d_source), 'google') THEN 'Google' WHEN contains(lower(d_source), 'shopify') THEN 'Direct'
    WHEN contains(lower(d_source), 'duckduckgo') THEN 'DuckDuckGo' WHEN contains(lower(d_source), 'mail') THEN 'Email'
    WHEN contains(lower(d_source), 'referral') THEN 'Referral' WHEN contains(lower(d_source), 'direct') THEN 'Direct'
    WHEN contains(lower(d_source), 'organic') THEN 'Organic' WHEN contains(lower(d_source), 'social') THEN 'Social' ELSE 'Other' END"""
# The seed rules.
CTE["rules"] = """SELECT * FROM (VALUES (1, 'facebook|fb', 'cpc|paid', 'Facebook', 'Paid Social', 'paid', 'facebook', 10),
    (2, 'instagram|ig', 'cpc|paid', 'Instagram', 'Paid Social', 'paid', 'instagram', 10), (3, 'google', 'cpc|paid', 'Google', 'Paid Search', 'paid', 'google', 10),
    (4, 'google', 'display', 'Google', 'Display', 'paid', 'google', 9), (5, 'facebook|fb', 'social|organic', 'Facebook', 'Organic Social', 'organic', 'facebook', 5),
    (6, 'instagram|ig', 'social|organic', 'Instagram', 'Organic Social', 'organic', 'instagram', 5), (7, 'email|mail', 'email', 'Email', 'Newsletter', 'email', 'email', 8),
    (8, 'direct|(null)|^$', NULL, 'Direct', 'Direct', 'direct', 'direct', 1), (9, 'referral', NULL, 'Referral', 'External Sites', 'organic', 'referral', 3)
    ) AS v(id, sp, mp, channel, sub_channel, channel_category, platform, priority)"""
CTE["ruled"] = """SELECT o.order_id, r.channel, r.sub_channel, r.channel_category, r.platform FROM ord o LEFT JOIN rules r
    ON regexp_matches(o.d_source, r.sp) AND (regexp_matches(o.d_medium, r.mp) OR (r.mp IS NULL AND o.d_medium IS NULL))
        AND o.d_campaign IS NULL AND o.d_content IS NULL
    QUALIFY row_number() OVER (PARTITION BY o.order_id ORDER BY r.priority DESC NULLS LAST, r.id) = 1"""
CTE["umap"] = f"""SELECT o.*, {UTM_CHANNEL} AS channel, r.sub_channel,
    CASE WHEN regexp_full_match(d_content, '[0-9]+') THEN d_content END AS ad_id, d_campaign AS campaign_id
    FROM ord o LEFT JOIN ruled r USING (order_id) WHERE cancelled_at_ist IS NULL AND (d_source IS NOT NULL OR d_medium IS NOT NULL)"""
_FILLED = " + ".join(
    f"CASE WHEN COALESCE(CAST({c} AS VARCHAR), '') <> '' THEN 1 ELSE 0 END"
    for c in ("order_id", "order_ts", "order_value", "d_source", "d_medium", "d_campaign", "ad_id", "channel")
)
CTE["hrly"] = f"""SELECT order_date AS date_start, hour(order_ts) AS hour_start, printf('%02d:00:00 - %02d:59:59', hour(order_ts), hour(order_ts)) AS hour_window,
    campaign_id, ad_id, d_source AS utm_source, d_medium AS utm_medium, d_campaign AS utm_campaign, d_content AS utm_content, d_term AS utm_term,
    channel, sub_channel, COUNT(*) AS total_sessions, 0 AS unique_visitors, COUNT(DISTINCT customer_id) AS unique_customers, COUNT(*) AS total_conversions,
    SUM(order_value) AS total_revenue, COUNT(*) AS total_orders, {avg('order_value')} AS avg_order_value,
    COALESCE(SUM(order_value) FILTER (WHERE d_source IS NOT NULL OR d_campaign IS NOT NULL), 0) AS attributed_revenue,
    COUNT(*) FILTER (WHERE d_source IS NOT NULL OR d_campaign IS NOT NULL) AS attributed_orders, 100.0 AS conversion_rate,
    {div('COUNT(*) FILTER (WHERE d_source IS NOT NULL OR d_campaign IS NOT NULL)', 'COUNT(*)', 100, 4)} AS attribution_rate,
    {rnd(avg(f'(({_FILLED}) * 12.5)'), 2)} AS data_completeness_score FROM umap GROUP BY ALL"""
# ALL would group by the rates' inner columns as well; the key is spelled out.
CTE["hrly"] = CTE["hrly"].replace("GROUP BY ALL", "GROUP BY order_date, hour(order_ts), campaign_id, ad_id, d_source, d_medium, d_campaign, d_content, d_term, channel, sub_channel")


# Output columns of the joined hour and where each comes from.
_OF_UTM = {"utm_sessions": "total_sessions", "utm_visitors": "unique_visitors", "utm_customers": "unique_customers", "utm_conversions": "total_conversions",
    "utm_conversion_rate": "conversion_rate", "utm_revenue": "total_revenue", "utm_orders": "total_orders", "utm_avg_order_value": "avg_order_value",
    "attributed_revenue": "attributed_revenue", "attributed_orders": "attributed_orders", "attribution_rate": "attribution_rate", "utm_data_quality": "data_completeness_score"}
_OF_ADS = {"ad_impressions": "impressions", "ad_clicks": "clicks", "ad_spend": "spend", "ad_cpm": "cpm", "ad_cpc": "cpc", "ad_ctr": "ctr"}


def keyed(table: str, hour: str, mark: str) -> str:
    """A side with its key as one struct (missing ids count as equal) and a mark that says it is there and has a campaign."""
    return f"(SELECT *, {{'d': date_start, 'h': {hour}, 'c': ifnull(campaign_id, ''), 'a': ifnull(ad_id, '')}} AS join_key, campaign_id IS NOT NULL AS {mark} FROM {table})"


def utm_join(kind: str) -> str:
    left, right = keyed("hrly", "hour_start", "in_utm"), keyed("ads", "h", "in_ads")
    either = lambda name, other=None: f"ifnull(lhs.{name}, rhs.{other or name}) AS {name}"
    status = "['unmatched', 'utm_only', 'ads_only', 'matched'][1 + ifnull(in_utm, FALSE)::INT + 2 * ifnull(in_ads, FALSE)::INT]"
    return f"""SELECT {either('date_start')}, {either('hour_start', 'h')}, {either('hour_window', 'hour_label')}, {either('campaign_id')}, {either('ad_id')},
    rhs.campaign_name, rhs.adset_id, rhs.adset_name, rhs.ad_name, {', '.join(f'lhs.{c}' for c in ('utm_source', 'utm_medium', 'utm_campaign', 'utm_content', 'utm_term', 'channel', 'sub_channel'))},
    {', '.join(f'ifnull(rhs.{c}, 0) AS {name}' for name, c in _OF_ADS.items())},
    {', '.join(f'ifnull(lhs.{c}, 0) AS {name}' for name, c in _OF_UTM.items())},
    {status} AS data_match_status, IF(lhs.date_start IS NULL, NULL, 'batch_1') AS utm_batch_id, rhs.date_start AS ads_date_start
    FROM {left} lhs {kind} JOIN {right} rhs ON lhs.join_key = rhs.join_key"""


CTE["perf"] = utm_join("LEFT")
CTE["perffull"] = utm_join("FULL")

# SKU rows per order.
CTE["skl"] = """SELECT order_id, sku, MAX(product_title) AS product_title, MAX(variant_title) AS variant_title, SUM(quantity) AS quantity,
    MAX(unit_price) AS unit_price, MAX(unit_cost) AS unit_cost, SUM(rev) AS sku_revenue, SUM(cogs) AS sku_cogs, SUM(rev - cogs) AS sku_profit
    FROM lin WHERE sku IS NOT NULL GROUP BY order_id, sku"""
CTE["sko"] = """SELECT r.*, COALESCE(CASE WHEN r.ad_id IS NOT NULL THEN a.spend END, 0) AS ad_spend FROM raw r
    LEFT JOIN adtot a USING (campaign_name, adset_name, ad_name) WHERE r.is_attributed"""
CTE["skr"] = "SELECT o.*, l.* EXCLUDE (order_id) FROM sko o JOIN skl l USING (order_id)"
CTE["fact"] = """SELECT f.*, t.product_title, t.product_category FROM (
    SELECT sku, campaign_id, campaign_name, channel, order_date AS date_start, COUNT(*) AS total_orders, SUM(quantity) AS total_quantity_sold,
        SUM(sku_revenue) AS total_revenue, SUM(sku_cogs) AS total_cogs FROM skr GROUP BY ALL) f
    LEFT JOIN (SELECT raw_sku AS sku, MIN(variant_product_title) AS product_title, MIN(product_category) AS product_category FROM vars
        WHERE raw_sku IS NOT NULL GROUP BY raw_sku) t USING (sku)"""

# Run log.
CTE["rlog"] = f"""SELECT 'pipeline_' || (k % 10) AS pipeline_name, 'run_' || k || '_' || strftime(d, '%Y%m%d') AS pipeline_run_id,
    'batch_' || strftime(d, '%Y%m%d') AS batch_id, st AS execution_start_time, CASE WHEN status <> 'RUNNING' THEN en END AS execution_end_time,
    status AS execution_status, n AS total_orders_processed, ads AS total_ads_processed, good AS attributed_orders_count,
    n - good AS unattributed_orders_count, spend AS total_spend_processed, sales AS total_sales_processed,
    {div('(n - bad)', 'n', 100, 2)} AS data_quality_score, CASE WHEN status = 'FAILED' THEN 'too many errors' END AS error_message, d AS analysis_date
    FROM (SELECT *, CASE WHEN bad > good THEN 'FAILED' WHEN good > 0 THEN 'SUCCESS' WHEN views > 0 THEN 'CANCELLED' ELSE 'RUNNING' END AS status FROM (
        SELECT k, CAST(ts AS DATE) AS d, MIN(ts) AS st, MAX(ts) AS en, COUNT(*) AS n, COUNT(*) FILTER (WHERE event_type = 'error') AS bad,
            COUNT(*) FILTER (WHERE event_type = 'purchase') AS good, COUNT(*) FILTER (WHERE event_type = 'view') AS views,
            COUNT(*) FILTER (WHERE event_type IN ('view', 'click')) AS ads,
            COALESCE(SUM(value) FILTER (WHERE event_type IN ('view', 'click')), 0) AS spend,
            COALESCE(SUM(value) FILTER (WHERE event_type = 'purchase'), 0) AS sales FROM ev GROUP BY ALL))"""

# Touches and conversions.
CTE["tou"] = "SELECT user_id, event_id AS touch_id, ts AS touch_time, campaign_id, ad_id FROM evk WHERE event_type IN ('view', 'click')"
CTE["con"] = "SELECT user_id, event_id AS order_id, ts AS order_time, value AS order_value FROM ev WHERE event_type = 'purchase'"

# Platforms.
CTE["plat"] = """SELECT *, CASE WHEN lower(utm_source) IN ('google', 'googleads') OR lower(utm_medium) IN ('cpc', 'paid_search') THEN 'Google'
    WHEN lower(utm_source) IN ('facebook', 'instagram') OR lower(utm_medium) = 'social' THEN 'Meta' ELSE 'Other' END AS platform_group FROM act"""
CTE["platr"] = """SELECT *, CASE WHEN platform_group = 'Google' THEN utm_campaign END AS google_campaign, CASE WHEN platform_group = 'Google' THEN utm_content END AS google_ad_group,
    CASE WHEN platform_group = 'Google' THEN utm_term END AS google_keyword, CASE WHEN platform_group = 'Meta' THEN utm_campaign END AS meta_campaign,
    CASE WHEN platform_group = 'Meta' THEN utm_content END AS meta_ad, CASE WHEN platform_group = 'Meta' THEN utm_term END AS meta_adset,
    CASE WHEN platform_group = 'Meta' THEN CASE WHEN contains(lower(utm_source), 'instagram') OR lower(utm_source) = 'ig' THEN 'Instagram' ELSE 'Facebook' END END AS meta_platform
    FROM plat"""

_ORDER = list(CTE)


def build(select: str) -> str:
    """Prefix a SELECT with the CTEs it uses, in order of definition."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in _ORDER:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql):
                needed.add(name)
                visit(CTE[name])

    visit(select)
    chosen = [n for n in _ORDER if n in needed]
    return ("WITH " + ",\n".join(f"{n} AS ({CTE[n]})" for n in chosen) + "\n" if chosen else "") + select
