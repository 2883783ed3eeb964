"""The SQL each Spark query is checked against, by query name."""

from __future__ import annotations

from oracle.base import (
    AD_KEYS, N, UTM, UTM_CHANNEL, _OK, avg, big, build, channel_case, cond, day, dbl, div, rat, rnd, same, ts,
)

SQL: dict[str, str] = {}
BATCH = "'batch_1'"


def bigs(*columns: str) -> str:
    return ", ".join(f"{big(c)} AS {c}" for c in columns)


def dbls(*columns: str) -> str:
    return ", ".join(f"{dbl(c)} AS {c}" for c in columns)


# --- scans ---------------------------------------------------------------------
SQL["wide_order_scan"] = f"""SELECT o.order_id, {ts('o.order_ts')} AS order_ts, {dbl('o.order_value')} AS total_price_amount, i.item_id, i.product_title,
    {big('i.quantity')} AS quantity, {dbl('i.orig')} AS original_unit_price_amount, {dbl('i.disc')} AS discounted_unit_price_amount,
    v.raw_sku AS sku, {dbl('v.unit_cost')} AS unit_cost_amount, v.variant_product_title, v.vendor, {dbl('v.selling_price')} AS selling_price
    FROM ord o LEFT JOIN items i USING (order_id) LEFT JOIN vars v USING (variant_id) WHERE o.cancelled_at_ist IS NULL"""
SQL["slim_order_scan"] = f"""SELECT o.order_id, {day('o.order_date')} AS order_date, {dbl('o.order_value')} AS order_value, o.d_content AS customer_utm_content,
    i.item_id, v.raw_sku AS sku, {big('i.quantity')} AS quantity, {dbl('v.unit_cost')} AS unit_cost_amount
    FROM ord o LEFT JOIN items i USING (order_id) LEFT JOIN vars v USING (variant_id) WHERE o.cancelled_at_ist IS NULL"""
SQL["utm_order_scan"] = f"""SELECT order_id, order_name, {ts('order_ts')} AS order_ts, {dbl('order_value')} AS total_price_amount,
    d_source AS customer_utm_source, d_medium AS customer_utm_medium, customer_id FROM ord
    WHERE cancelled_at_ist IS NULL AND (d_source IS NOT NULL OR d_medium IS NOT NULL)"""
_PROFILE = """SELECT '{0}' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count, strftime(MIN({1}), '%Y-%m-%d') AS min_date, strftime(MAX({1}), '%Y-%m-%d') AS max_date,
    CAST(COUNT(*) FILTER (WHERE {1} BETWEEN DATE '2024-01-10' AND DATE '2024-01-20') AS BIGINT) AS rows_in_window FROM {2}"""
SQL["source_profile"] = _PROFILE.format("orders", "order_date", "ord") + " UNION ALL " + _PROFILE.format("ads", "date_start", "ads")
SQL["newest_parameters"] = f"""SELECT pipeline_run_id, batch_id, {ts('execution_start_time')} AS created_at FROM rlog
    WHERE execution_status = 'SUCCESS' ORDER BY execution_start_time DESC LIMIT 1"""

# --- ad rollups ----------------------------------------------------------------
_METRICS = {
    "impressions": ("impressions", "daily_impressions"), "clicks": ("clicks", "daily_clicks"),
    "purchases": ("action_onsite_web_purchase", "daily_purchases"), "carts": ("action_onsite_web_add_to_cart", "daily_add_to_cart"),
    "checkouts": ("action_onsite_web_initiate_checkout", "daily_checkout"),
}


def _daily(i: int, prefix: str, value: str, views: str, links: str) -> str:
    counts = ", ".join(f"{big(c)} AS {names[i]}" for c, names in _METRICS.items())
    return f"""SELECT {day('date_start')} AS date_start, {AD_KEYS}, {counts}, {dbl('spend')} AS {prefix}spend, {dbl('pvalue')} AS {value},
        {big('impressions')} AS {views}, {big('clicks')} AS {links}, {div('spend', 'impressions', 1000)} AS {prefix}cpm,
        {div('spend', 'clicks')} AS {prefix}cpc, {div('clicks', 'impressions', 100)} AS {prefix}ctr FROM daily"""


SQL["ads_daily_rollup"] = _daily(0, "", "value_onsite_web_purchase", "action_onsite_web_view_content", "action_link_click")
SQL["ads_daily_named"] = _daily(1, "daily_", "daily_revenue", "daily_content_views", "daily_link_clicks")

# --- channels and touches --------------------------------------------------------
SQL["channel_classify"] = f"SELECT order_id, {channel_case('d_source', 'd_medium', 'd_campaign', 'd_content', 'd_term')} AS channel FROM ord"
SQL["utm_channel_classify"] = f"SELECT order_id, {UTM_CHANNEL} AS channel FROM ord"
SQL["regex_channel_rules"] = "SELECT order_id, channel, sub_channel, channel_category, platform FROM ruled"
SQL["rule_table_channels"] = SQL["regex_channel_rules"]
SQL["source_dictionary"] = """SELECT order_id, CASE WHEN d_source IN ('google', 'an', 'Google') THEN 'Google'
    WHEN d_source IN ('facebook', 'Facebook', 'fb', 'instagram', 'ig', 'IGShopping', '{{site_source_name}}') THEN 'Meta'
    WHEN d_source IN ('shopify', 'duckduckgo', 'organic', 'search') THEN 'Organic' WHEN d_source = 'direct' THEN 'Direct'
    WHEN d_source IN ('null', '') THEN 'Direct/Unknown' ELSE 'Other' END AS channel FROM ord"""
SQL["referrer_channel"] = """SELECT o.order_id, CASE
    WHEN regexp_matches(lower(p.url), 'google\\.com|bing\\.com|yahoo\\.com|duckduckgo\\.com') THEN 'Organic'
    WHEN regexp_matches(lower(p.url), 'facebook\\.com|instagram\\.com|twitter\\.com|linkedin\\.com') THEN 'Meta'
    WHEN regexp_matches(lower(p.url), 'shopify\\.com|\\.com|\\.co\\.|\\.org|\\.net') THEN 'Organic'
    WHEN trim(o.journey) NOT IN ('', 'null', 'None') AND regexp_matches(lower(o.journey), 'search|organic|seo|unpaid|natural|shopify') THEN 'Organic'
    WHEN trim(o.journey) NOT IN ('', 'null', 'None') AND regexp_matches(lower(o.journey), 'social|facebook|instagram|fb|ig') THEN 'Meta'
    WHEN trim(o.attrs) NOT IN ('', 'null', 'None', '[]') AND regexp_matches(lower(o.attrs), 'search|organic|seo|unpaid|natural|shopify') THEN 'Organic'
    WHEN trim(o.attrs) NOT IN ('', 'null', 'None', '[]') AND regexp_matches(lower(o.attrs), 'social|facebook|instagram|fb|ig') THEN 'Meta'
    ELSE 'Direct' END AS channel FROM ord o LEFT JOIN pages p ON p.page_id = o.o_custkey"""
SQL["attribution_cascade"] = f"SELECT order_id, attribution_source, attribution_id, attribution_type, {UTM}, ch0 AS channel, is_attributed FROM tch2"
SQL["channel_settled"] = "SELECT order_id, first_channel, channel, is_paid_channel FROM chan"
SQL["order_ad_ids"] = "SELECT order_id, ad_id FROM adid"
SQL["id_and_hour_normaliser"] = """SELECT event_id,
    CASE event_id % 5 WHEN 0 THEN '1202213430908' || (k + 60000) WHEN 1 THEN CAST(k * 1000 + 500 AS VARCHAR) WHEN 3 THEN 'Facebook_' || k ELSE 'Unknown' END AS ad_id,
    CASE WHEN event_id % 5 < 3 THEN printf('%02d:00:00 - %02d:59:59', hour(ts), hour(ts)) END AS hour_label,
    CASE WHEN event_id % 5 < 3 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS parsed_ts,
    CASE WHEN event_id % 5 < 2 THEN CAST(k AS DOUBLE) ELSE 0.0 END AS number,
    event_id % 5 IN (2, 4) AS blank_id, event_id % 5 = 0 AS digits FROM ev"""

# --- orders and attribution -------------------------------------------------------
SQL["order_fold"] = f"SELECT order_id, {dbl('total_cogs')} AS total_cogs, {bigs('line_items_count', 'unique_skus_count', 'total_sku_quantity')}, skus FROM fold"
SQL["attribution_match"] = f"""SELECT order_id, {AD_KEYS}, {big('mi')} AS matched_impressions, {big('mc')} AS matched_clicks, {dbl('ms')} AS matched_spend,
    {big('mp')} AS matched_purchases, {dbl('mv')} AS matched_revenue, channel FROM raw"""
SQL["attribution_export"] = f"""SELECT order_id, order_name, {day('order_date')} AS order_date, {dbl('order_value')} AS price, {dbl('total_cogs')} AS cogs, skus AS sku,
    campaign_name, adset_name, ad_name, channel, attribution_source FROM raw"""
_PLACE = """raw LEFT JOIN (SELECT c_custkey, n_name, r_name, n_name || ' ' || c_mktsegment AS city FROM customer
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) g ON raw.o_custkey = g.c_custkey"""
SQL["attribution_tagged"] = f"""SELECT order_id, order_name, {day('order_date')} AS order_date, {dbl('order_value')} AS order_value, 'INR' AS order_currency,
    {dbl('total_cogs')} AS total_cogs, {bigs('line_items_count', 'unique_skus_count', 'total_sku_quantity')}, skus, channel, attribution_source, attribution_id,
    attribution_type, {UTM}, {AD_KEYS}, is_attributed, is_paid_channel, journey IS NOT NULL AS has_customer_journey, attrs IS NOT NULL AS has_custom_attributes,
    city AS ship_city, n_name AS ship_province, r_name AS ship_country, {BATCH} AS batch_id FROM {_PLACE}"""


def _share(by: str) -> str:
    return f"""SELECT {by}, {N} AS orders, {dbl('SUM(order_value)')} AS revenue, {div('COUNT(*)', '(SELECT COUNT(*) FROM act)', 100)} AS percentage
        FROM act WHERE {by} IS NOT NULL GROUP BY {by}"""


SQL["channel_breakdown"] = _share("channel")
SQL["source_breakdown"] = _share("attribution_source")
SQL["grand_totals"] = f"""SELECT {N} AS total_orders, {dbl('SUM(order_value)')} AS total_revenue, {cond('is_attributed')} AS attributed_orders,
    {div('COUNT(*) FILTER (WHERE is_attributed)', 'COUNT(*)', 100)} AS attribution_rate FROM act"""


def _performance(by: str, names: str, extra: str = "") -> str:
    return f"""SELECT p.*, {big('orders')} AS shopify_purchases, total_sales AS shopify_revenue, {div('total_sales', 'ad_spend')} AS roas,
        {div('ad_clicks', 'ad_impressions', 100)} AS ctr, {div('orders', 'ad_clicks', 100)} AS conversion_rate,
        {div('total_sales', 'orders')} AS avg_order_value{extra} FROM (
        SELECT s.*, {big('COALESCE(a.i, 0)')} AS ad_impressions, {big('COALESCE(a.c, 0)')} AS ad_clicks, {dbl('COALESCE(a.s, 0)')} AS ad_spend FROM (
            SELECT {by}, {N} AS orders, {dbl('SUM(order_value)')} AS total_sales, {dbl('SUM(total_cogs)')} AS total_cogs FROM raw
            WHERE is_attributed AND campaign_name IS NOT NULL AND adset_name IS NOT NULL AND ad_name IS NOT NULL GROUP BY {by}) s
        LEFT JOIN (SELECT {names}, SUM(impressions) AS i, SUM(clicks) AS c, SUM(spend) AS s FROM daily GROUP BY {names}) a USING ({names})) p"""


_NAMES = "campaign_name, adset_name, ad_name"
SQL["campaign_performance"] = _performance(
    _NAMES + ", channel", _NAMES,
    f", CASE WHEN row_number() OVER (PARTITION BY {_NAMES} ORDER BY total_sales DESC, channel) = 1 THEN ad_spend ELSE 0.0 END AS spend_once",
)
SQL["campaign_summary"] = _performance("campaign_name", "campaign_name")
SQL["ad_performance"] = _performance(_NAMES, _NAMES)
SQL["batch_metrics"] = f"""SELECT o.*, a.* FROM (SELECT {N} AS total_orders, {cond('is_attributed')} AS attributed_orders, {cond('NOT is_attributed')} AS unattributed_orders,
    {dbl('SUM(order_value)')} AS total_sales FROM act) o, (SELECT {N} AS total_ads, {dbl('SUM(spend)')} AS total_spend FROM lev) a"""

# --- granular ---------------------------------------------------------------------
_IDKEY = ", ".join(f"COALESCE(NULLIF({c}, ''), 'Unknown') AS {c}" if c.endswith("_id") else f"COALESCE({c}, '') AS {c}" for c in AD_KEYS.split(", "))
_FIRSTS = ["channel", "attribution_source", *UTM.split(", ")]
_BYHOUR = f"""SELECT {AD_KEYS}, order_date, hl, COUNT(*) AS so, SUM(order_value) AS sr, SUM(total_cogs) AS sc, SUM(total_sku_quantity) AS sq,
    {', '.join(f"arg_min({c}, order_id) FILTER (WHERE {c} <> '') AS {c}" for c in _FIRSTS)}
    FROM (SELECT {_IDKEY}, order_date, printf('%02d:00:00 - %02d:59:59', hour(order_ts), hour(order_ts)) AS hl, order_id, order_value, total_cogs,
        total_sku_quantity, {', '.join(_FIRSTS)} FROM raw) GROUP BY {AD_KEYS}, order_date, hl"""
_JOINED = f"""SELECT {', '.join(f'COALESCE(a.{c}, o.{c}) AS {c}' for c in AD_KEYS.split(', '))}, COALESCE(a.date_start, o.order_date) AS date_start,
    COALESCE(a.hour_label, o.hl) AS hour_label, a.ad_id IS NOT NULL AS has_ads, o.ad_id IS NOT NULL AS has_orders,
    COALESCE(a.impressions, 0) AS impressions, COALESCE(a.clicks, 0) AS clicks, COALESCE(a.spend, 0) AS spend, COALESCE(a.purchases, 0) AS purchases,
    COALESCE(a.pvalue, 0) AS pvalue, COALESCE(so, 0) AS so, COALESCE(sr, 0) AS sr, COALESCE(sc, 0) AS sc, COALESCE(sq, 0) AS sq,
    {', '.join(f"COALESCE({c}, '') AS {c}" for c in _FIRSTS)}
    FROM ads a FULL JOIN ({_BYHOUR}) o ON {same('a', 'o', AD_KEYS)} AND a.date_start = o.order_date AND a.hour_label = o.hl"""
_SETTLED = f"""SELECT *, CASE WHEN moved THEN 'Meta Campaign - ' || CASE WHEN utm_campaign IN ('', 'null') THEN 'Unknown' ELSE utm_campaign END ELSE campaign_name END AS campaign2,
    CASE WHEN moved THEN 'Meta' WHEN ch1 = 'Direct' AND (utm_source NOT IN ('', 'null') OR utm_medium NOT IN ('', 'null')) THEN 'Organic' ELSE ch1 END AS ch2 FROM (
    SELECT *, ch1 = 'Direct' AND (utm_campaign NOT IN ('', 'null') OR attribution_source <> '' OR (campaign_name <> '' AND NOT contains(campaign_name, 'Unknown'))) AS moved FROM (
    SELECT *, CASE WHEN again <> 'Direct' THEN again ELSE channel END AS ch1 FROM (SELECT *, {channel_case(*UTM.split(', '))} AS again FROM ({_JOINED}))))"""
_LABEL = "CASE WHEN ch2 = '' THEN 'Direct/Unknown' ELSE ch2 END"
_GRAN = f"""SELECT campaign_id, CASE WHEN has_ads THEN campaign2 ELSE 'Unknown Campaign - ' || {_LABEL} END AS campaign_name, adset_id,
    CASE WHEN has_ads THEN adset_name ELSE 'Unknown Adset - ' || {_LABEL} END AS adset_name, ad_id,
    CASE WHEN has_ads THEN ad_name ELSE 'Unknown Ad - ' || {_LABEL} END AS ad_name, date_start, hour_label, has_ads, has_orders,
    impressions, clicks, spend, purchases, pvalue, so, sr, sc, sq, ch2 AS channel, attribution_source, {UTM} FROM ({_SETTLED})"""
_TEXTS = ", ".join(_FIRSTS)
SQL["granular_hourly"] = f"""SELECT {AD_KEYS}, {day('date_start')} AS date_start, hour_label, {big('SUM(impressions)')} AS impressions, {big('SUM(clicks)')} AS clicks,
    {dbl('SUM(spend)')} AS spend, {big('SUM(purchases)')} AS action_onsite_web_purchase, {dbl('SUM(pvalue)')} AS value_onsite_web_purchase,
    {big('SUM(so)')} AS shopify_orders, {dbl('SUM(sr)')} AS shopify_revenue, {dbl('SUM(sc)')} AS shopify_cogs, {big('SUM(sq)')} AS total_sku_quantity,
    bool_or(has_ads) AS has_ads, bool_or(has_orders) AS has_orders,
    {', '.join(f"first({c} ORDER BY NOT has_orders, {_TEXTS}) AS {c}" for c in _FIRSTS)},
    {div('SUM(spend)', 'SUM(impressions)', 1000)} AS cpm, {div('SUM(spend)', 'SUM(clicks)')} AS cpc, {div('SUM(clicks)', 'SUM(impressions)', 100)} AS ctr
    FROM ({_GRAN}) GROUP BY {AD_KEYS}, date_start, hour_label"""
SQL["granular_order_ids"] = f"""SELECT {AD_KEYS}, {day('order_date')} AS date_start, hl AS hour_label, string_agg(order_id, ', ' ORDER BY order_id) AS order_ids
    FROM (SELECT {_IDKEY}, order_date, printf('%02d:00:00 - %02d:59:59', hour(order_ts), hour(order_ts)) AS hl, order_id FROM raw)
    GROUP BY {AD_KEYS}, order_date, hl"""
# The report labels a merged key by its first row, so the summary reads the merged rows.
SQL["order_time_backfill"] = f"""SELECT order_id, {ts('order_ts')} AS order_ts, printf('%02d:00:00 - %02d:59:59', hour(order_ts), hour(order_ts)) AS hour_label FROM raw"""
SQL["granular_channel_summary"] = f"""SELECT channel, {big('SUM(shopify_orders)')} AS shopify_orders, ROUND(SUM(CAST(shopify_revenue AS DECIMAL(20,2))), 2)::DOUBLE AS shopify_revenue,
    ROUND(SUM(CAST(shopify_cogs AS DECIMAL(20,2))), 2)::DOUBLE AS shopify_cogs FROM ({SQL['granular_hourly']}) GROUP BY channel"""
SQL["granular_unmatched_summary"] = f"""SELECT channel, {big('SUM(shopify_orders)')} AS shopify_orders, ROUND(SUM(CAST(shopify_revenue AS DECIMAL(20,2))), 2)::DOUBLE AS shopify_revenue
    FROM ({SQL['granular_hourly']}) WHERE contains(campaign_name, 'Unknown Campaign') GROUP BY channel"""

# --- ad level ---------------------------------------------------------------------
_LEVEL = f"""{AD_KEYS}, channel, attributed, {bigs('orders', 'attributed_orders', 'impressions', 'clicks', 'total_unique_skus', 'total_sku_quantity')},
    {dbls('total_sales', 'total_cogs', 'net_profit', 'spend', 'roas', 'ctr', 'conversion_rate', 'avg_order_value', 'profit_margin')}"""
SQL["ad_level_summary"] = f"""SELECT {_LEVEL}, all_skus, '2024-01-01' AS analysis_date_start, '2024-01-30' AS analysis_date_end, {BATCH} AS batch_id FROM level"""
SQL["ad_level_spend_once"] = f"""SELECT ad_id, campaign_name, channel, {dbl('spend')} AS spend, CASE WHEN row_number() OVER (PARTITION BY {AD_KEYS}
    ORDER BY total_sales DESC, channel) = 1 THEN {dbl('spend')} ELSE 0.0 END AS spend_once FROM level"""
_BYDAY = f"""SELECT {_NAMES}, order_date, COUNT(*) AS so, SUM(order_value) AS sr, SUM(total_cogs) AS sc, SUM(unique_skus_count) AS su, SUM(total_sku_quantity) AS sq,
    {', '.join(f"arg_min({c}, order_id) FILTER (WHERE {c} <> '') AS {c}" for c in ['channel', *UTM.split(', ')])}
    FROM raw WHERE campaign_name IS NOT NULL GROUP BY {_NAMES}, order_date"""
_DAYSKUS = f"""SELECT {_NAMES}, order_date, string_agg(DISTINCT sku, ', ' ORDER BY sku) AS skus FROM raw JOIN lin USING (order_id)
    WHERE campaign_name IS NOT NULL AND sku IS NOT NULL GROUP BY {_NAMES}, order_date"""
SQL["daily_platform_comparison"] = f"""SELECT {', '.join(f'd.{c}' for c in _NAMES.split(', '))}, {day('d.date_start')} AS date_start, {bigs('impressions', 'clicks')}, {dbl('spend')} AS spend,
    {big('purchases')} AS fb_action_onsite_web_purchase, {dbl('pvalue')} AS fb_value_onsite_web_purchase, {big('so')} AS shopify_orders,
    {dbl('sr')} AS shopify_revenue, {dbl('sc')} AS shopify_cogs, {big('su')} AS unique_sku_count, {big('sq')} AS total_sku_quantity,
    channel, {UTM}, {div('clicks', 'impressions', 100)} AS ctr, {div('spend', 'impressions', 1000)} AS cpm, {div('spend', 'clicks')} AS cpc,
    {div('pvalue', 'spend')} AS fb_roas, {dbl('sr - sc')} AS shopify_profit, {div('sr', 'spend')} AS shopify_roas,
    {div('so', 'clicks', 100)} AS shopify_conversion_rate, {div('sr', 'so')} AS shopify_avg_order_value, {dbl('sr - pvalue')} AS revenue_difference,
    coalesce(skus, '') AS unique_skus, {big('so - purchases')} AS orders_difference, {div('sr', 'spend')} - {div('pvalue', 'spend')} AS roas_difference FROM (
    SELECT {', '.join(f'COALESCE(p.{c}, o.{c}) AS {c}' for c in _NAMES.split(', '))}, COALESCE(p.date_start, o.order_date) AS date_start,
        COALESCE(impressions, 0) AS impressions, COALESCE(clicks, 0) AS clicks, COALESCE(spend, 0) AS spend, COALESCE(purchases, 0) AS purchases,
        COALESCE(pvalue, 0) AS pvalue, COALESCE(so, 0) AS so, COALESCE(sr, 0) AS sr, COALESCE(sc, 0) AS sc, COALESCE(su, 0) AS su, COALESCE(sq, 0) AS sq,
        {', '.join(f"COALESCE({c}, '') AS {c}" for c in ['channel', *UTM.split(', ')])}
    FROM daily p FULL JOIN ({_BYDAY}) o ON {same('p', 'o', _NAMES)} AND p.date_start = o.order_date) d
    LEFT JOIN ({_DAYSKUS}) k ON {same('d', 'k', _NAMES)} AND d.date_start = k.order_date"""


def _range(spend: str) -> str:
    return f"""SELECT channel, {big('n')} AS total_orders, {big('na')} AS attributed_orders, {div('na', 'n', 100, 2)} AS attribution_rate,
        {dbl('sales')} AS total_sales, {dbl('sp')} AS total_spend, {div('sales', 'sp', 1, 4)} AS roas,
        {div('(sales - cogs - sp)', 'sales', 100, 2)} AS profit_margin FROM ({spend})"""


_RANGE_JOIN = """raw r LEFT JOIN lev l ON r.ad_id = l.ad_id AND r.campaign_id = l.campaign_id
    AND r.order_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'"""
SQL["range_join_kpis"] = _range(f"""SELECT r.channel, COUNT(*) AS n, COUNT(*) FILTER (WHERE r.is_attributed) AS na, SUM(r.order_value) AS sales,
    SUM(r.total_cogs) AS cogs, COALESCE(SUM(l.spend), 0) AS sp FROM {_RANGE_JOIN} GROUP BY r.channel""")
SQL["range_join_kpis_once"] = _range(f"""SELECT channel, SUM(n) AS n, SUM(na) AS na, SUM(sales) AS sales, SUM(cogs) AS cogs, COALESCE(SUM(sp), 0) AS sp FROM (
    SELECT r.channel, l.ad_id, l.campaign_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE r.is_attributed) AS na, SUM(r.order_value) AS sales,
        SUM(r.total_cogs) AS cogs, MAX(l.spend) AS sp FROM {_RANGE_JOIN} GROUP BY r.channel, l.ad_id, l.campaign_id) GROUP BY channel""")

# --- views over attributed orders ---------------------------------------------------
_T = {
    "orders": f"{N} AS total_orders",
    "revenue": f"{dbl('SUM(order_value)')} AS total_revenue",
    "cogs": f"{dbl('SUM(total_cogs)')} AS total_cogs",
    "att": f"{cond('is_attributed')} AS attributed_orders",
    "rate": f"{rat('COUNT(*) FILTER (WHERE is_attributed)', 'COUNT(*)', 100, 2)} AS attribution_rate",
    "paid": f"{cond('is_paid_channel')} AS paid_channel_orders",
    "prate": f"{rat('COUNT(*) FILTER (WHERE is_paid_channel)', 'COUNT(*)', 100, 2)} AS paid_channel_rate",
    "cshare": f"{rat('SUM(total_cogs)', 'SUM(order_value)', 100, 2)} AS cogs_percentage",
    "aov": f"{avg('order_value')} AS avg_order_value",
    "dates": f"{ts('MIN(order_ts)')} AS first_order_date, {ts('MAX(order_ts)')} AS last_order_date",
    "sources": ", ".join(
        f"{cond(chr(39).join(['attribution_source = ', s, '']))} AS {n}"
        for s, n in (("customer_journey", "journey_attributions"), ("custom_attributes", "attributes_attributions"), ("direct_utm", "direct_utm_attributions"))
    ),
}


def t(*names: str) -> str:
    return ", ".join(_T[n] for n in names)


SQL["daily_attribution_summary"] = f"SELECT {day('order_date')} AS date_start, {t('orders', 'revenue', 'cogs', 'att', 'paid', 'rate', 'prate', 'cshare', 'aov')} FROM raw GROUP BY order_date"
SQL["channel_performance"] = f"SELECT channel, {t('orders', 'revenue', 'cogs', 'att', 'rate', 'cshare', 'aov', 'dates')} FROM raw GROUP BY channel"
SQL["campaign_performance_view"] = f"""SELECT {AD_KEYS}, channel, {t('orders', 'revenue', 'cogs', 'cshare', 'aov')}, {big('COUNT(DISTINCT order_id)')} AS unique_orders,
    {t('dates', 'sources')} FROM raw WHERE is_attributed GROUP BY {AD_KEYS}, channel"""
SQL["attribution_source_analysis"] = f"""SELECT attribution_source, channel, {t('orders', 'revenue', 'aov')}, {big('COUNT(DISTINCT attribution_id)')} AS unique_attribution_ids,
    {t('dates')} FROM act WHERE is_attributed GROUP BY attribution_source, channel"""
SQL["sku_performance"] = f"""SELECT sku, channel, campaign_name, {N} AS orders, {dbl('SUM(order_value)')} AS revenue, {dbl('SUM(total_cogs)')} AS cogs, {t('cshare', 'aov')},
    {big('SUM(total_sku_quantity)')} AS total_quantity_sold FROM (SELECT *, unnest(string_split(skus, ', ')) AS sku FROM raw WHERE is_attributed AND skus IS NOT NULL)
    GROUP BY sku, channel, campaign_name"""
SQL["monthly_attribution_trends"] = f"""SELECT {day("date_trunc('month', order_date)")} AS month_start, {t('orders', 'revenue', 'att', 'paid', 'rate', 'prate', 'aov')},
    {cond("channel = 'Meta'")} AS meta_orders, {cond("channel = 'Google'")} AS google_orders, {cond("channel = 'Organic'")} AS organic_orders,
    {cond("channel = 'Direct'")} AS direct_orders FROM act GROUP BY date_trunc('month', order_date)"""
SQL["attribution_quality_analysis"] = f"""SELECT {day('order_date')} AS date_start, {t('orders', 'att', 'sources')}, {big('COUNT(campaign_id)')} AS campaign_matched_orders, {t('rate')},
    {rat('COUNT(campaign_id)', 'COUNT(*) FILTER (WHERE is_attributed)', 100, 2)} AS campaign_match_rate FROM raw GROUP BY order_date"""
SQL["top_performing_campaigns"] = f"""SELECT campaign_name, channel, {t('orders', 'revenue', 'cogs')}, {dbl('SUM(order_value) - SUM(total_cogs)')} AS gross_profit,
    {rat('(SUM(order_value) - SUM(total_cogs))', 'SUM(order_value)', 100, 2)} AS profit_margin, {t('aov')}, {big('COUNT(DISTINCT order_date)')} AS active_days, {t('dates')}
    FROM raw WHERE is_attributed AND campaign_name IS NOT NULL GROUP BY campaign_name, channel HAVING COUNT(*) >= 5 ORDER BY SUM(order_value) DESC, 1, 2 LIMIT 100"""


def _funnel(join: str) -> str:
    return f"""SELECT campaign_name, channel, {big('i')} AS total_impressions, {big('c')} AS total_clicks, {dbl('s')} AS total_spend, {big('n')} AS total_orders,
        {dbl('v')} AS total_revenue, {rat('c', 'i', 100, 2)} AS ctr, {rat('n', 'c', 100, 2)} AS conversion_rate, {rat('v', 's', 1, 2)} AS roas,
        {rat('s', 'n', 1, 2)} AS cost_per_order FROM ({join}) WHERE i > 0"""


_CAMP = "(SELECT campaign_id, SUM(impressions) AS i, SUM(clicks) AS c, SUM(spend) AS s FROM daily GROUP BY campaign_id)"
SQL["attribution_funnel"] = _funnel(f"""SELECT campaign_name, channel, SUM(i) AS i, SUM(c) AS c, SUM(s) AS s, COUNT(*) AS n, SUM(order_value) AS v
    FROM raw LEFT JOIN {_CAMP} USING (campaign_id) WHERE is_attributed GROUP BY campaign_name, channel""")
SQL["attribution_funnel_once"] = _funnel(f"""SELECT campaign_name, channel, SUM(i) AS i, SUM(c) AS c, SUM(s) AS s, SUM(n) AS n, SUM(v) AS v FROM (
    SELECT campaign_id, campaign_name, channel, COUNT(*) AS n, SUM(order_value) AS v FROM raw WHERE is_attributed GROUP BY ALL) LEFT JOIN {_CAMP} USING (campaign_id)
    GROUP BY campaign_name, channel""")
SQL["geographic_attribution"] = f"""SELECT r_name AS ship_country, n_name AS ship_province, city AS ship_city, channel, {t('orders', 'revenue', 'aov', 'att', 'rate')}
    FROM {_PLACE} WHERE r_name IS NOT NULL GROUP BY r_name, n_name, city, channel"""
SQL["attribution_daily_summary"] = f"""SELECT {day('order_date')} AS analysis_date, channel, {t('orders', 'att')}, {t('rate')}_percent, {t('revenue', 'cogs')},
    {dbl('SUM(order_value - total_cogs)')} AS total_profit, {big('COUNT(DISTINCT campaign_id)')} AS unique_campaigns, {big('COUNT(DISTINCT ad_id)')} AS unique_ads
    FROM raw GROUP BY order_date, channel"""
_LSUM = f"""SUM(orders) AS total_orders, SUM(attributed_orders) AS total_attributed_orders, SUM(total_sales) AS total_sales, SUM(spend) AS total_spend,
    SUM(net_profit) AS total_net_profit, SUM(impressions) AS i, SUM(clicks) AS c"""
_CSUM = f"""SELECT campaign_id, campaign_name, channel, {bigs('total_orders', 'total_attributed_orders')}, {dbls('total_sales', 'total_spend', 'total_net_profit')},
    {div('total_sales', 'total_spend', 1, 4)} AS roas, {div('c', 'i', 100, 4)} AS ctr_percent, {div('total_orders', 'c', 100, 4)} AS conversion_rate_percent,
    {div('total_sales', 'total_orders', 1, 2)} AS avg_order_value, {div('total_net_profit', 'total_sales', 100, 2)} AS profit_margin_percent
    FROM (SELECT campaign_id, campaign_name, channel, {_LSUM} FROM lev GROUP BY ALL)"""
SQL["campaign_performance_summary"] = _CSUM
SQL["ad_performance_summary"] = f"""SELECT ad_id, ad_name, campaign_name, adset_name, channel, attributed, {bigs('orders', 'attributed_orders', 'total_unique_skus')},
    {dbls('total_sales', 'spend', 'net_profit', 'roas', 'ctr', 'conversion_rate', 'avg_order_value', 'profit_margin')},
    '2024-01-01' AS analysis_date_start, '2024-01-30' AS analysis_date_end FROM level"""
SQL["channel_performance_summary"] = f"""SELECT channel, {bigs('unique_campaigns', 'unique_ads', 'total_orders', 'total_attributed_orders')},
    {rat('total_attributed_orders', 'total_orders', 100, 2)} AS attribution_rate_percent, {dbls('total_sales', 'total_spend', 'total_net_profit')},
    {div('total_sales', 'total_spend', 1, 4)} AS roas, {div('total_net_profit', 'total_sales', 100, 2)} AS profit_margin_percent FROM (
    SELECT channel, COUNT(DISTINCT campaign_id) AS unique_campaigns, COUNT(DISTINCT ad_id) AS unique_ads, {_LSUM} FROM lev GROUP BY channel)"""
SQL["top_campaigns_by_roas"] = f"SELECT * FROM ({_CSUM}) WHERE total_sales > 10000 ORDER BY roas DESC, total_sales DESC, campaign_name, channel LIMIT 10"
SQL["attribution_rate_by_channel"] = f"SELECT channel, {t('orders', 'att')}, {t('rate')}_percent FROM act GROUP BY channel"

# --- SKU-to-ad mapping ---------------------------------------------------------------
SQL["order_ad_mapping"] = f"""SELECT order_id, order_name, {day('order_date')} AS order_date, {dbl('order_value')} AS order_value, 'INR' AS order_currency, ad_id,
    d_source AS utm_source, d_medium AS utm_medium, d_campaign AS utm_campaign, d_content AS utm_content, d_term AS utm_term,
    campaign_id, campaign_name, adset_id, adset_name, ad_name, {big('impressions')} AS ad_impressions, {big('clicks')} AS ad_clicks, {dbl('ad_spend')} AS ad_spend,
    {big('purchases')} AS ad_purchases, {dbl('pvalue')} AS ad_revenue, {div('ad_spend', 'impressions', 1000)} AS ad_cpm, {div('ad_spend', 'clicks')} AS ad_cpc,
    {div('clicks', 'impressions', 100)} AS ad_ctr, item_id, sku, product_title, variant_title, {big('quantity')} AS quantity,
    {dbls('unit_price', 'unit_cost', 'line_item_revenue', 'line_item_cogs', 'line_item_profit')}, profit_margin, roas, cost_per_order FROM mapp"""
_R, _P, _S, _Q = "SUM(line_item_revenue)", "SUM(line_item_profit)", "SUM(ad_spend)", "SUM(quantity)"
_SK, _SD, _AD = "COUNT(DISTINCT sku)", "COUNT(DISTINCT ad_id)", "ad_id, ad_name, campaign_name"


def m(select: str, by: str, tail: str = "") -> str:
    return f"SELECT {by}, {select} FROM mapp GROUP BY {by} {tail}"


def per(a: str, b: str, name: str, scale: int = 1) -> str:
    return f"{rat(a, b, scale, 2)} AS {name}"


_UNITS, _REV, _SPEND = f"{big(_Q)} AS total_quantity_sold", f"{dbl(_R)} AS total_revenue", f"{dbl(_S)} AS total_spend"
_MARGIN = f"{rnd(avg('profit_margin'), 2)} AS avg_profit_margin"
SQL["sku_ad_performance"] = m(f"""{N} AS orders, {_UNITS}, {_REV}, {dbl('SUM(line_item_cogs)')} AS total_cogs, {dbl(_P)} AS total_profit, {_MARGIN},
    {rnd(avg('roas'), 2)} AS avg_roas, {per(_R, _Q, 'revenue_per_unit')}, {per(_P, _R, 'overall_profit_margin', 100)}""", f"sku, product_title, {_AD}")
SQL["ad_sku_performance"] = m(f"""{big(_SK)} AS unique_skus, {N} AS total_orders, {_UNITS}, {_REV}, {_SPEND}, {rnd(avg('roas'), 2)} AS avg_roas,
    {per(_R, _S, 'overall_roas')}, {per(_S, 'COUNT(*)', 'cost_per_order')}, {per(_R, 'COUNT(*)', 'revenue_per_order')}""", _AD)
_OD = "COUNT(DISTINCT order_id)"
SQL["daily_order_ad_performance"] = f"""SELECT {day('order_date')} AS order_date, {big(_OD)} AS total_orders, {big(_SK)} AS unique_skus, {big(_SD)} AS unique_ads,
    {big('COUNT(DISTINCT campaign_name)')} AS unique_campaigns, {_REV}, {_SPEND}, {per(_R, _S, 'daily_roas')}, {per(_S, _OD, 'cost_per_order')},
    {per(_R, _OD, 'revenue_per_order')} FROM mapp GROUP BY order_date"""
SQL["campaign_sku_breakdown"] = m(f"""{big(_SK)} AS unique_skus, {big(_SD)} AS unique_ads, {N} AS total_orders, {_UNITS}, {_REV}, {_SPEND}, {per(_R, _S, 'campaign_roas')},
    {per(_R, _SK, 'revenue_per_sku')}, {per(_S, _SD, 'spend_per_ad')}, {per(_R, 'COUNT(*)', 'revenue_per_order')}""", "campaign_name")
SQL["top_performing_skus"] = m(f"""{big(_SD)} AS ads_count, {N} AS total_orders, {_UNITS}, {_REV}, {dbl(_P)} AS total_profit, {_MARGIN},
    {per(_R, _Q, 'revenue_per_unit')}, {per(_P, _R, 'overall_profit_margin', 100)}""", "sku, product_title", "HAVING COUNT(*) >= 5")
SQL["top_performing_ads"] = m(f"""{big(_SK)} AS unique_skus, {N} AS total_orders, {_REV}, {_SPEND}, {per(_R, _S, 'overall_roas')}, {per(_S, 'COUNT(*)', 'cost_per_order')},
    {per(_R, 'COUNT(*)', 'revenue_per_order')}""", _AD, "HAVING COUNT(*) >= 3")
SQL["sku_ad_efficiency"] = m(f"""{N} AS orders, {big(_Q)} AS quantity_sold, {dbl(_R)} AS revenue, {dbl(_S)} AS spend, {per(_R, _S, 'roas')}, {per(_S, 'COUNT(*)', 'cost_per_order')},
    {per(_R, 'COUNT(*)', 'revenue_per_order')}, {per(_R, _Q, 'revenue_per_unit')}, {per(_R, _S, 'efficiency_score')}""", f"sku, product_title, {_AD}", f"HAVING {_S} > 0")
SQL["campaign_sku_matrix"] = m(f"""{N} AS orders, {big(_Q)} AS quantity_sold, {dbl(_R)} AS revenue, {dbl(_S)} AS spend, {per(_R, _S, 'roas')},
    {per(_R, 'COUNT(*)', 'revenue_per_order')}""", "campaign_name, sku, product_title")
SQL["daily_sku_performance"] = f"""SELECT {day('order_date')} AS order_date, sku, product_title, {N} AS orders, {big(_Q)} AS quantity_sold, {dbl(_R)} AS revenue,
    {per(_R, 'COUNT(*)', 'revenue_per_order')}, {per(_R, _Q, 'revenue_per_unit')} FROM mapp GROUP BY order_date, sku, product_title"""
SQL["daily_ad_performance"] = f"""SELECT {day('order_date')} AS order_date, {_AD}, {N} AS orders, {dbl(_R)} AS revenue, {dbl(_S)} AS spend, {per(_R, _S, 'roas')},
    {per(_S, 'COUNT(*)', 'cost_per_order')} FROM mapp GROUP BY order_date, {_AD}"""
SQL["best_sku_ads"] = m(f"{dbl(_R)} AS revenue, {per(_R, _S, 'roas')}", "sku, product_title, ad_name, campaign_name",
    f"HAVING {_S} > 0 ORDER BY roas DESC, revenue DESC, sku, product_title, ad_name, campaign_name LIMIT 10")
SQL["underperforming_ads"] = m(f"{dbl(_R)} AS revenue, {dbl(_S)} AS spend, {per(_R, _S, 'roas')}", _AD, f"HAVING {_S} > 100 ORDER BY roas, spend DESC, {_AD} LIMIT 10")
SQL["daily_trend"] = f"""SELECT {day('order_date')} AS order_date, {big(_OD)} AS orders, {dbl(_R)} AS revenue, {per(_R, _S, 'roas')} FROM mapp
    GROUP BY order_date"""
SQL["mapping_spend_once"] = f"""SELECT campaign_name, {dbl('SUM(s)')} AS spend_once FROM (SELECT DISTINCT campaign_name, order_date, ad_id, ad_spend AS s FROM mapp) GROUP BY campaign_name"""

# --- UTM model -------------------------------------------------------------------------
_DUTM = "d_source AS utm_source, d_medium AS utm_medium, d_campaign AS utm_campaign, d_content AS utm_content, d_term AS utm_term"
SQL["utm_sessions"] = f"""SELECT 'session_' || order_id AS session_token, CAST(NULL AS VARCHAR) AS visitor_id, customer_id, {_DUTM}, campaign_id, ad_id,
    {ts('order_ts')} AS session_start_time, {ts('order_ts')} AS first_pageview_time, TRUE AS is_conversion_session, 'purchase' AS conversion_type,
    {dbl('order_value')} AS conversion_value, 'INR' AS conversion_currency, 'shopify_orders' AS data_source FROM umap"""
SQL["utm_order_mapping"] = f"""SELECT order_id, order_name, {ts('order_ts')} AS order_date, {dbl('order_value')} AS order_value, 'INR' AS order_currency,
    'session_' || order_id AS session_token, 'last_click' AS attribution_model, CAST(1.0 AS DOUBLE) AS attribution_weight, TRUE AS is_primary_attribution, {_DUTM}, campaign_id,
    {', '.join(f'CAST(NULL AS VARCHAR) AS {c}' for c in ('campaign_name', 'adset_id', 'adset_name', 'ad_name'))}, ad_id, channel, sub_channel,
    'order_utm' AS data_source, {BATCH} AS batch_id FROM umap"""
SQL["utm_hourly_metrics"] = f"""SELECT {day('date_start')} AS date_start, {big('hour_start')} AS hour_start, hour_window, campaign_id, ad_id,
    {', '.join(f'CAST(NULL AS VARCHAR) AS {c}' for c in ('campaign_name', 'adset_id', 'adset_name', 'ad_name'))}, {UTM}, channel, sub_channel,
    {bigs('total_sessions', 'unique_visitors', 'unique_customers', 'total_conversions', 'total_orders', 'attributed_orders')},
    {dbls('total_revenue', 'avg_order_value', 'attributed_revenue', 'conversion_rate', 'attribution_rate', 'data_completeness_score')}, {BATCH} AS batch_id FROM hrly"""
SQL["utm_period_slice"] = f"""SELECT {day('date_start')} AS date_start, {big('hour_start')} AS hour_start, campaign_id, ad_id, utm_source, utm_medium, utm_campaign, channel,
    {big('total_sessions')} AS sessions, {big('total_conversions')} AS conversions, {dbl('total_revenue')} AS revenue, {big('total_orders')} AS orders
    FROM hrly WHERE date_start BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'"""
_RATES = f"""{div('attributed_revenue', 'ad_spend', 1, 4)} AS roas, {div('utm_conversions', 'ad_clicks', 100, 4)} AS conversion_rate_percent"""
_PCOUNT = bigs("ad_impressions", "ad_clicks", "utm_sessions", "utm_visitors", "utm_customers", "utm_conversions", "utm_orders", "attributed_orders")
_PMONEY = dbls("ad_spend", "ad_cpm", "ad_cpc", "ad_ctr", "utm_conversion_rate", "utm_revenue", "utm_avg_order_value", "attributed_revenue", "attribution_rate", "utm_data_quality")


def _perf(source: str) -> str:
    return f"""SELECT {day('date_start')} AS date_start, {big('hour_start')} AS hour_start, hour_window, {AD_KEYS}, {UTM}, channel, sub_channel, {_PCOUNT}, {_PMONEY}, {_RATES},
        {div('utm_conversions', 'utm_sessions', 100, 4)} AS session_to_conversion_rate, data_match_status, utm_batch_id, {day('ads_date_start')} AS ads_date_start FROM {source}"""


SQL["utm_ads_hourly"] = _perf("perf")
SQL["utm_ads_full_outer"] = _perf("perffull")
_DAILY5 = "channel, sub_channel, utm_source, utm_campaign"
SQL["utm_daily_summary"] = f"""SELECT {day('date_start')} AS date_start, {_DAILY5}, {bigs('total_sessions', 'total_visitors', 'total_customers', 'total_conversions', 'total_orders', 'total_attributed_orders')},
    {dbls('total_revenue', 'total_ad_spend', 'total_attributed_revenue')}, {div('total_conversions', 'total_sessions', 100, 4)} AS conversion_rate_percent,
    {div('total_revenue', 'total_ad_spend', 1, 4)} AS roas, {div('total_revenue', 'total_orders', 1, 2)} AS avg_order_value,
    {div('total_attributed_revenue', 'total_revenue', 100, 4)} AS attribution_rate_percent FROM (
    SELECT date_start, {_DAILY5}, SUM(utm_sessions) AS total_sessions, SUM(utm_visitors) AS total_visitors, SUM(utm_customers) AS total_customers,
        SUM(utm_conversions) AS total_conversions, SUM(utm_revenue) AS total_revenue, SUM(utm_orders) AS total_orders, SUM(ad_spend) AS total_ad_spend,
        SUM(attributed_revenue) AS total_attributed_revenue, SUM(attributed_orders) AS total_attributed_orders FROM perf GROUP BY date_start, {_DAILY5})"""
SQL["utm_purchase_analysis"] = f"""SELECT {day('date_start')} AS date_start, {big('hour_start')} AS hour_start, hour_window, campaign_id, campaign_name, ad_id, ad_name,
    utm_source, utm_medium, utm_campaign, channel, sub_channel, {bigs('ad_impressions', 'ad_clicks', 'utm_sessions', 'utm_conversions', 'utm_orders', 'attributed_orders')},
    {_PMONEY}, {_RATES}, data_match_status FROM perf"""
_SUMS = lambda *cols: ", ".join(
    f"{big(f'SUM({c})')} AS {c}" if c in ("utm_orders", "utm_conversions") else f"{dbl(f'ROUND(SUM({c}), 2)')} AS {c}" for c in cols
)
SQL["utm_analysis_by_channel"] = f"SELECT channel, {_SUMS('utm_revenue', 'utm_orders', 'ad_spend', 'utm_conversions')} FROM perf WHERE channel IS NOT NULL GROUP BY channel"
SQL["utm_analysis_top_campaigns"] = f"""SELECT COALESCE(campaign_name, campaign_id) AS campaign_name, channel, {_SUMS('utm_revenue', 'ad_spend', 'utm_conversions')} FROM perf
    WHERE COALESCE(campaign_name, campaign_id) IS NOT NULL AND channel IS NOT NULL GROUP BY 1, 2 ORDER BY SUM(perf.utm_revenue) DESC, 1, 2 LIMIT 10"""
SQL["utm_analysis_by_hour"] = f"SELECT {big('hour_start')} AS hour_start, {_SUMS('utm_revenue', 'utm_orders', 'utm_conversions')} FROM perf GROUP BY hour_start"
SQL["utm_recent_hours"] = f"""SELECT {day('date_start')} AS date_start, {big('hour_start')} AS hour_start, hour_window, channel, utm_source, utm_campaign,
    {bigs('total_sessions', 'total_conversions', 'total_orders')}, {dbls('total_revenue', 'conversion_rate', 'attribution_rate')} FROM hrly WHERE date_start >= DATE '2024-01-23'"""
SQL["utm_recent_hours_with_ads"] = f"""SELECT {day('date_start')} AS date_start, {big('hour_start')} AS hour_start, hour_window, campaign_id, campaign_name, ad_id, ad_name,
    utm_source, utm_medium, utm_campaign, channel, {bigs('ad_impressions', 'ad_clicks', 'utm_sessions', 'utm_conversions', 'utm_orders')},
    {dbls('ad_spend', 'ad_cpm', 'ad_cpc', 'ad_ctr', 'utm_revenue', 'utm_avg_order_value')}, {div('utm_revenue', 'ad_spend', 1, 4)} AS roas,
    {div('utm_conversions', 'ad_clicks', 100, 4)} AS conversion_rate_percent FROM perf WHERE date_start >= DATE '2024-01-23'"""


def _summary(by: str, since: str, tail: str = "", having: str = "WHERE r > 0") -> str:
    prefix = f"{big('hour_start')} AS hour_start" if by == "hour_start" else by
    return f"""SELECT {prefix}, {big('d')} AS active_days, {big('s')} AS total_sessions, {big('c')} AS total_conversions, {dbl('r')} AS total_revenue, {big('o')} AS total_orders,
        {div('c', 's', 100, 4)} AS conversion_rate_percent, {div('r', 'o', 1, 2)} AS avg_order_value FROM (
        SELECT {by}, COUNT(DISTINCT date_start) AS d, SUM(total_sessions) AS s, SUM(total_conversions) AS c, SUM(total_revenue) AS r, SUM(total_orders) AS o
        FROM (SELECT *, CAST(NULL AS VARCHAR) AS campaign_name FROM hrly) WHERE date_start >= DATE '{since}' GROUP BY {by}) {having} {tail}"""


SQL["utm_channel_summary"] = _summary("channel, sub_channel", "2023-12-31")
SQL["utm_top_campaigns"] = _summary("campaign_name, channel, utm_source, utm_medium", "2023-12-31", "ORDER BY r DESC, channel NULLS FIRST, utm_source NULLS FIRST, utm_medium NULLS FIRST LIMIT 20")
SQL["utm_hour_pattern"] = _summary("hour_start", "2024-01-23", having="")
SQL["utm_source_summary"] = _summary("utm_source, utm_medium, utm_campaign", "2023-12-31")
SQL["utm_attribution_by_campaign"] = f"""SELECT channel, CAST(NULL AS VARCHAR) AS campaign_name, {dbl('SUM(attributed_revenue)')} AS attributed_revenue, {big('SUM(attributed_orders)')} AS attributed_orders,
    {dbl('SUM(total_revenue)')} AS total_revenue, {big('SUM(total_orders)')} AS total_orders, {div('SUM(attributed_revenue)', 'SUM(total_revenue)', 100, 4)} AS attribution_rate_percent
    FROM hrly GROUP BY channel HAVING SUM(total_revenue) > 0"""
SQL["utm_batch_quality"] = f"""SELECT 'batch_' || strftime(date_start, '%Y%m%d') AS batch_id, {N} AS total_records, {avg('data_completeness_score')} AS avg_data_quality,
    MIN(data_completeness_score) AS min_data_quality, MAX(data_completeness_score) AS max_data_quality, {cond('data_completeness_score >= 90')} AS high_quality_records,
    {cond('data_completeness_score < 70')} AS low_quality_records, {day('date_start')} AS last_created FROM hrly WHERE date_start >= DATE '2024-01-23' GROUP BY date_start"""
SQL["coverage_comparison"] = f"""SELECT {day('u.date_start')} AS date_start, {big('u.hour_start')} AS hour_start, {big('COUNT(DISTINCT u.campaign_id)')} AS utm_campaigns,
    {big('COUNT(DISTINCT u.ad_id)')} AS utm_ads, {big('COUNT(DISTINCT a.campaign_id)')} AS ads_campaigns, {big('COUNT(DISTINCT a.ad_id)')} AS ads_ads,
    {dbl('SUM(u.total_revenue)')} AS utm_revenue, {dbl('SUM(a.spend)')} AS ads_spend, {div('SUM(u.total_revenue)', 'COALESCE(SUM(a.spend), 0)', 1, 4)} AS roas
    FROM hrly u FULL JOIN ads a ON u.date_start = a.date_start AND u.hour_start = a.h WHERE u.date_start >= DATE '2024-01-23' GROUP BY u.date_start, u.hour_start"""
SQL["coverage_comparison_once"] = f"""SELECT {day('u.date_start')} AS date_start, {big('u.hour_start')} AS hour_start, utm_campaigns, utm_ads, COALESCE(ads_campaigns, 0) AS ads_campaigns,
    COALESCE(ads_ads, 0) AS ads_ads, {dbl('r')} AS utm_revenue, {dbl('s')} AS ads_spend, {div('r', 'COALESCE(s, 0)', 1, 4)} AS roas FROM (
    SELECT date_start, hour_start, COUNT(DISTINCT campaign_id) AS utm_campaigns, COUNT(DISTINCT ad_id) AS utm_ads, SUM(total_revenue) AS r FROM hrly
        WHERE date_start >= DATE '2024-01-23' GROUP BY ALL) u
    LEFT JOIN (SELECT date_start, h, COUNT(DISTINCT campaign_id) AS ads_campaigns, COUNT(DISTINCT ad_id) AS ads_ads, SUM(spend) AS s FROM ads GROUP BY ALL) a
    ON u.date_start = a.date_start AND u.hour_start = a.h"""


def _period(name: str, test: str) -> str:
    return f"""SELECT '{name}' AS period, {big('COUNT(DISTINCT campaign_id)')} AS active_campaigns, {big('COUNT(DISTINCT ad_id)')} AS active_ads,
        {big('SUM(total_sessions)')} AS total_sessions, {big('SUM(total_conversions)')} AS total_conversions, {dbl('SUM(total_revenue)')} AS total_revenue,
        {big('SUM(total_orders)')} AS total_orders, {div('SUM(total_conversions)', 'SUM(total_sessions)', 100, 4)} AS conversion_rate_percent FROM hrly WHERE {test}"""


SQL["period_dashboard"] = " UNION ALL ".join([
    _period("Today", "date_start = DATE '2024-01-30'"), _period("Yesterday", "date_start = DATE '2024-01-29'"), _period("Last 7 Days", "date_start >= DATE '2024-01-23'"),
])
SQL["utm_campaign_roas"] = f"""SELECT campaign_name, channel, {dbl('SUM(utm_revenue)')} AS total_revenue, {dbl('SUM(ad_spend)')} AS total_spend,
    {div('SUM(utm_revenue)', 'SUM(ad_spend)', 1, 4)} AS roas, {big('SUM(utm_conversions)')} AS total_conversions, {big('SUM(utm_sessions)')} AS total_sessions
    FROM perf GROUP BY campaign_name, channel HAVING SUM(utm_revenue) > 0"""
SQL["utm_source_performance"] = f"""SELECT utm_source, utm_medium, utm_campaign, {big('COUNT(DISTINCT date_start)')} AS active_days, {big('SUM(utm_sessions)')} AS total_sessions,
    {big('SUM(utm_conversions)')} AS total_conversions, {dbl('SUM(utm_revenue)')} AS total_revenue, {div('SUM(utm_conversions)', 'SUM(utm_sessions)', 100, 4)} AS conversion_rate_percent
    FROM perf GROUP BY utm_source, utm_medium, utm_campaign HAVING SUM(utm_revenue) > 0"""
SQL["utm_conversion_pattern"] = f"""SELECT {big('hour_start')} AS hour_start, {big('SUM(utm_conversions)')} AS total_conversions, {dbl('SUM(utm_revenue)')} AS total_revenue,
    {avg('utm_avg_order_value')} AS avg_order_value, {big('COUNT(DISTINCT campaign_id)')} AS active_campaigns FROM perf WHERE date_start >= DATE '2024-01-23' GROUP BY hour_start"""
SQL["utm_hourly_check"] = f"""SELECT {day('date_start')} AS date_start, {big('hour_start')} AS hour_start, {N} AS record_count, {dbl('SUM(total_revenue)')} AS total_revenue
    FROM hrly WHERE date_start >= DATE '2024-01-23' GROUP BY date_start, hour_start"""
SQL["orphan_mappings"] = f"""SELECT order_id, 'session_' || order_id AS session_token, {ts('order_ts')} AS order_date FROM umap WHERE order_ts < TIMESTAMP '2024-01-20'"""

# --- SKU detail ----------------------------------------------------------------------------
SQL["sku_detail"] = f"""SELECT order_id, order_name, {day('order_date')} AS order_date, {dbl('order_value')} AS order_value, {AD_KEYS}, channel, attribution_source, {UTM},
    {dbl('ad_spend')} AS ad_spend, sku, product_title, variant_title, {big('quantity')} AS quantity, {dbls('unit_price', 'unit_cost', 'sku_revenue', 'sku_cogs', 'sku_profit')},
    {div('sku_profit', 'sku_revenue', 100)} AS sku_profit_margin, {div('sku_revenue', 'ad_spend')} AS sku_roas, {dbl('sku_profit - ad_spend')} AS sku_net_profit FROM skr"""
SQL["sku_detail_last_line"] = f"""SELECT order_id, sku, {big('quantity')} AS quantity, {dbl('unit_price')} AS unit_price, {dbl('rev')} AS sku_revenue, {dbl('cogs')} AS sku_cogs,
    {dbl('rev - cogs')} AS sku_profit, {dbl('ad_spend')} AS ad_spend, {div('rev', 'ad_spend')} AS sku_roas FROM sko JOIN (
    SELECT * FROM lin WHERE sku IS NOT NULL QUALIFY row_number() OVER (PARTITION BY order_id, sku ORDER BY item_id DESC, product_title DESC, variant_title DESC,
        quantity DESC, unit_price DESC, unit_cost DESC) = 1) l USING (order_id)"""
_LV = "campaign_name, adset_name, ad_name"
_AS = f"""SELECT COALESCE(campaign_name, 'Unknown') AS campaign_name, COALESCE(adset_name, 'Unknown') AS adset_name, COALESCE(ad_name, 'Unknown') AS ad_name, sku,
    SUM(sku_revenue) AS rev, SUM(sku_cogs) AS cogs, COUNT(*) AS orders FROM skr GROUP BY ALL"""
_ASJ = f"SELECT s.*, COALESCE(a.spend, 0) AS spend, COALESCE(a.clicks, 0) AS clicks, COALESCE(a.impressions, 0) AS impr FROM ({_AS}) s LEFT JOIN adtot a USING ({_LV})"
_ADR = f"SELECT {_LV}, SUM(rev) AS rev, SUM(cogs) AS cogs, SUM(orders) AS orders, MAX(spend) AS spend, SUM(spend) AS rep, MAX(clicks) AS clicks, MAX(impr) AS impr FROM ({_ASJ}) GROUP BY {_LV}"


def _level(name: str, keys: list[str], source: str, total: bool, group: bool) -> str:
    cols = ["campaign_name", "adset_name", "ad_name", "sku"]
    shown = ", ".join(c if c in keys else f"CAST(NULL AS VARCHAR) AS {c}" for c in cols)
    if group:
        source = f"""SELECT {', '.join(keys)}, SUM(rev) AS rev, SUM(cogs) AS cogs, SUM(orders) AS orders, SUM(spend) AS spend, SUM(rep) AS rep, SUM(clicks) AS clicks,
            SUM(impr) AS impr FROM ({source}) GROUP BY {', '.join(keys)}"""
    return f"""SELECT '{name}' AS level, {shown}, {big('orders')} AS orders, {dbl('rev')} AS total_sales, {dbl('cogs')} AS total_cogs,
        {dbl('spend') if total else 'CAST(NULL AS DOUBLE)'} AS ad_spent,
        {(dbl('spend') if name == 'Ad Total' else dbl('rep')) if total else 'CAST(NULL AS DOUBLE)'} AS ad_spent_repeated,
        {dbl('rev - cogs - spend') if total else 'CAST(NULL AS DOUBLE)'} AS net_profit, {big('clicks')} AS clicks,
        {div('clicks', 'impr', 100, 2)} AS ctr, {div('rev', 'spend', 1, 2)} AS purchase_roas, {div('orders', 'clicks', 100, 2)} AS conversion_rate FROM ({source})"""


_HIER = " UNION ALL ".join([
    _level("SKU", ["campaign_name", "adset_name", "ad_name", "sku"], _ASJ, False, False),
    _level("Ad Total", ["campaign_name", "adset_name", "ad_name"], _ADR, True, False),
    _level("Adset Total", ["campaign_name", "adset_name"], _ADR, True, True),
    _level("Campaign Total", ["campaign_name"], _ADR, True, True),
])
SQL["hierarchy_rollup"] = _HIER
_RUN = "PARTITION BY campaign_name ORDER BY adset_name NULLS LAST, ad_name NULLS LAST, CASE WHEN level = 'SKU' THEN 0 ELSE 1 END, total_sales DESC, sku NULLS FIRST"
SQL["hierarchy_report"] = f"""SELECT level, campaign_name, adset_name, ad_name, sku, CASE WHEN rn = 1 THEN campaign_name ELSE '' END AS shown_campaign,
    CASE WHEN rn = 1 OR pa IS DISTINCT FROM adset_name THEN adset_name ELSE '' END AS shown_adset,
    CASE WHEN rn = 1 OR pa IS DISTINCT FROM adset_name OR pd IS DISTINCT FROM ad_name THEN ad_name ELSE '' END AS shown_ad, total_sales FROM (
    SELECT *, row_number() OVER ({_RUN}) AS rn, lag(adset_name) OVER ({_RUN}) AS pa, lag(ad_name) OVER ({_RUN}) AS pd FROM ({_HIER}))"""
_FSUM = f"""{big('SUM(total_orders)')} AS total_orders, {dbl('SUM(total_revenue)')} AS total_revenue, {dbl('SUM(total_cogs)')} AS total_cogs"""
_FQ = f"{big('SUM(total_quantity_sold)')} AS total_quantity_sold"
_FO, _FR, _FC, _FU = "SUM(total_orders)", "SUM(total_revenue)", "SUM(total_cogs)", "SUM(total_quantity_sold)"
SQL["sku_campaign_fact"] = f"""SELECT sku, campaign_id, campaign_name, channel, {day('date_start')} AS date_start, {bigs('total_orders', 'total_quantity_sold')},
    {dbls('total_revenue', 'total_cogs')}, product_title, product_category, {per('total_quantity_sold', 'total_orders', 'quantity_per_order')},
    {per('total_revenue', 'total_orders', 'revenue_per_order')}, {div('(total_revenue - total_cogs)', 'total_revenue', 100, 2)} AS profit_margin FROM fact"""
SQL["sku_campaign_performance"] = f"""SELECT sku, product_title, product_category, campaign_name, channel, {_FSUM}, {_FQ}, {per(_FC, _FR, 'cogs_percentage', 100)},
    {per(_FR, _FO, 'revenue_per_order')}, {per(_FU, _FO, 'quantity_per_order')} FROM fact GROUP BY sku, product_title, product_category, campaign_name, channel"""
SQL["campaign_sku_fact_breakdown"] = f"""SELECT campaign_name, channel, {big(_SK)} AS unique_skus, {_FSUM}, {per(_FC, _FR, 'cogs_percentage', 100)},
    {per(_FR, _SK, 'revenue_per_sku')}, {per(_FO, _SK, 'orders_per_sku')} FROM fact GROUP BY campaign_name, channel"""
SQL["product_category_performance"] = f"""SELECT product_category, channel, {big(_SK)} AS unique_skus, {_FSUM}, {per(_FC, _FR, 'cogs_percentage', 100)},
    {per(_FR, _SK, 'revenue_per_sku')} FROM fact WHERE product_category IS NOT NULL GROUP BY product_category, channel"""
SQL["sku_performance_detailed"] = f"""SELECT sku, product_title, product_category, campaign_id, campaign_name, channel, {_FSUM}, {_FQ}, {per(_FR, _FU, 'avg_unit_price')},
    {per(_FC, _FU, 'avg_unit_cost')}, {div(f'({_FR} - {_FC})', _FR, 100, 2)} AS profit_margin, {per(_FR, _FO, 'revenue_per_order')}, {per(_FU, _FO, 'quantity_per_order')},
    {day('MIN(date_start)')} AS date_start, {day('MAX(date_start)')} AS date_end FROM fact GROUP BY sku, product_title, product_category, campaign_id, campaign_name, channel"""
SQL["campaign_performance_detailed"] = f"""SELECT {AD_KEYS}, channel, {bigs('impressions', 'clicks', 'orders')}, {dbls('spend', 'total_sales', 'total_cogs')},
    {rnd('roas', 2)} AS roas, {rnd('ctr', 2)} AS ctr, {rnd('conversion_rate', 2)} AS conversion_rate, {div('spend', 'orders', 1, 2)} AS cost_per_order,
    {rnd('profit_margin', 2)} AS profit_margin, {div('attributed_orders', 'orders', 100, 2)} AS attribution_rate,
    {div('(CASE WHEN campaign_id IS NOT NULL THEN orders ELSE 0 END)', 'orders', 100, 2)} AS campaign_match_rate FROM level"""

# --- products --------------------------------------------------------------------------------
_TITLE = "upper(p_name[1]) || substr(regexp_replace(p_name, ' .*', ''), 2) || ' ' || upper(regexp_replace(p_name, '^[^ ]* ', '')[1]) || substr(regexp_replace(p_name, '^[^ ]* ', ''), 2)"
_EXPORT = f"""SELECT {_TITLE} AS ad_name, CAST(l_tax AS DECIMAL(15,2)) AS spent, CAST(l_quantity AS DECIMAL(15,2)) AS units, CAST(l_extendedprice AS DECIMAL(15,2)) AS value
    FROM lineitem JOIN part ON l_partkey = p_partkey"""
_TERMS = "SELECT book_order, product, lower(trim(x)) AS term FROM (SELECT book_order, product, unnest(string_split(search, ',')) AS x FROM book) WHERE trim(x) <> ''"
_MATCH = f"""SELECT n.ad_name, COALESCE(arg_min(t.product, t.book_order), 'Brand Awareness') AS product FROM (SELECT DISTINCT ad_name FROM ({_EXPORT})) n
    LEFT JOIN ({_TERMS}) t ON contains(lower(n.ad_name), t.term) GROUP BY n.ad_name"""
SQL["product_match"] = f"""SELECT e.ad_name, m.product AS matched_product, b.price::DOUBLE AS price, b.margin::DOUBLE AS margin, {N} AS rows, {dbl('SUM(value)')} AS purchase_value
    FROM ({_EXPORT}) e JOIN ({_MATCH}) m USING (ad_name) LEFT JOIN book b ON b.product = m.product GROUP BY ALL"""
SQL["product_match_by_substring"] = _MATCH
SQL["product_metrics"] = f"""SELECT s.product, {dbl('sp')} AS total_ad_spent, {dbl('un')} AS total_sales, {dbl('va')} AS total_revenue, {div('va', 'sp')} AS roas,
    b.price::DOUBLE AS price, b.margin::DOUBLE AS margin, b.price::DOUBLE * un::DOUBLE AS expected_revenue,
    CASE WHEN b.price IS NULL OR abs(va::DOUBLE - b.price::DOUBLE * un::DOUBLE) < 1e-6 THEN 'Matches'
        ELSE printf('Mismatch (Actual: %.2f, Expected: %.2f)', va::DOUBLE, b.price::DOUBLE * un::DOUBLE) END AS revenue_validation
    FROM (SELECT m.product, SUM(spent) AS sp, SUM(units) AS un, SUM(value) AS va FROM ({_EXPORT}) e JOIN ({_MATCH}) m USING (ad_name) GROUP BY m.product) s
    LEFT JOIN book b ON b.product = s.product"""

# --- multi-touch -----------------------------------------------------------------------------
_PAIRS = """SELECT c.order_id, c.order_time, c.order_value, c.user_id, t.touch_id, t.touch_time, t.campaign_id, t.ad_id FROM con c JOIN tou t
    ON c.user_id = t.user_id AND t.touch_time <= c.order_time AND t.touch_time >= c.order_time - INTERVAL {0} DAY"""


def _single(model: str, order: str) -> str:
    return f"""SELECT order_id, {ts('order_time')} AS order_time, {dbl('order_value')} AS order_value, user_id, touch_id, {ts('touch_time')} AS touch_time, campaign_id, ad_id,
        '{model}' AS attribution_model, CAST(1.0 AS DOUBLE) AS attribution_weight FROM ({_PAIRS.format(7)})
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY touch_time {order}, CAST(touch_id AS VARCHAR) {order}) = 1"""


SQL["touch_first"] = _single("first_click", "ASC")
SQL["touch_last"] = _single("last_click", "DESC")
_WEIGHTED = f"""SELECT *, w / SUM(w) OVER (PARTITION BY order_id) AS part FROM (
    SELECT *, {{0}} AS w FROM ({_PAIRS.format(7)}))"""
_LINEAR = _WEIGHTED.format("CAST(1.0 AS DOUBLE)")
_DECAY = _WEIGHTED.format("pow(2.0, -(epoch_us(order_time) - epoch_us(touch_time)) / (2.0 * 86400000000))")


def _shared(model: str, weighted: str) -> str:
    return f"""SELECT t.user_id, t.touch_id, {ts('t.touch_time')} AS touch_time, t.campaign_id, t.ad_id, '{model}' AS attribution_model,
        {rnd('COALESCE(p.r, 0.0)', 4)} AS credited_revenue, {rnd('COALESCE(p.o, 0.0)', 4)} AS credited_orders FROM tou t LEFT JOIN (
        SELECT touch_id, SUM(part * order_value::DOUBLE) AS r, SUM(part) AS o FROM ({weighted}) GROUP BY touch_id) p USING (touch_id)"""


SQL["live_orders"] = f"""SELECT c.order_id, {ts('c.order_time')} AS order_time, {dbl('c.order_value')} AS order_value, c.user_id, l.touch_id, l.touch_time, l.campaign_id, l.ad_id,
    'last_click' AS attribution_model FROM con c LEFT JOIN ({SQL['touch_last']}) l USING (order_id)"""
SQL["touch_linear"] = _shared("linear", _LINEAR)
SQL["touch_decay"] = _shared("time_decay", _DECAY)
_LAST28 = f"SELECT * FROM ({_PAIRS.format(28)}) QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY touch_time DESC, CAST(touch_id AS VARCHAR) DESC) = 1"
SQL["touch_windows"] = f"""SELECT campaign_id, CAST(w AS BIGINT) AS window_days, {N} AS orders, {dbl('SUM(order_value)')} AS revenue FROM ({_LAST28}) JOIN (VALUES (1), (7), (28)) v(w)
    ON touch_time >= order_time - INTERVAL 1 DAY * w GROUP BY campaign_id, w"""
_BYCAMP = f"SELECT campaign_id, {rnd('SUM(o)', 4)} AS credited_orders, {rnd('SUM(r)', 4)} AS credited_revenue, '{{0}}' AS model FROM ({{1}}) GROUP BY campaign_id"
_ALLTOUCH = "SELECT t.campaign_id, COALESCE(part, 0) AS o, COALESCE(part * order_value::DOUBLE, 0) AS r FROM tou t LEFT JOIN ({0}) p USING (touch_id)"
SQL["touch_credit_by_campaign"] = " UNION ALL ".join([
    _BYCAMP.format("first_click", f"SELECT campaign_id, 1.0::DOUBLE AS o, order_value AS r FROM ({SQL['touch_first']})"),
    _BYCAMP.format("last_click", f"SELECT campaign_id, 1.0::DOUBLE AS o, order_value AS r FROM ({SQL['touch_last']})"),
    _BYCAMP.format("linear", _ALLTOUCH.format(_LINEAR)), _BYCAMP.format("time_decay", _ALLTOUCH.format(_DECAY)),
])

SQL["sql_channel_rules"] = SQL["regex_channel_rules"]


def _credited(model: str, rows: str) -> str:
    return f"""SELECT '{model}' AS model, {day('CAST(touch_time AS TIMESTAMP)')} AS date_start, {big('hour(CAST(touch_time AS TIMESTAMP))')} AS hour_start, campaign_id, ad_id, NULL AS utm_source, NULL AS utm_medium,
        NULL AS utm_campaign, NULL AS channel, NULL::BIGINT AS sessions, NULL::BIGINT AS conversions, {rnd('SUM(r)', 4)} AS revenue, {rnd('SUM(o)', 4)} AS orders
        FROM ({rows}) WHERE CAST(touch_time AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY ALL"""


_BY_TOUCH = "SELECT touch_time, campaign_id, ad_id, credited_revenue AS r, credited_orders AS o FROM ({0}) WHERE credited_orders > 0"
SQL["utm_period_by_model"] = " UNION ALL ".join([
    f"""SELECT 'last_click' AS model, {day('date_start')} AS date_start, {big('hour_start')} AS hour_start, campaign_id, ad_id, utm_source, utm_medium, utm_campaign, channel,
        {big('total_sessions')} AS sessions, {big('total_conversions')} AS conversions, {rnd('total_revenue', 4)} AS revenue, {rnd('total_orders', 4)} AS orders
        FROM hrly WHERE date_start BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""",
    _credited("first_click", f"SELECT touch_time, campaign_id, ad_id, order_value AS r, 1.0::DOUBLE AS o FROM ({SQL['touch_first']})"),
    _credited("linear", _BY_TOUCH.format(SQL["touch_linear"])), _credited("time_decay", _BY_TOUCH.format(SQL["touch_decay"])),
])

# --- platforms ---------------------------------------------------------------------------------
SQL["platform_roles"] = """SELECT order_id, platform_group, meta_platform, google_campaign, google_ad_group, google_keyword, meta_campaign, meta_ad, meta_adset,
    CASE platform_group WHEN 'Google' THEN COALESCE(NULLIF(google_ad_group, ''), NULLIF(google_campaign, ''), NULLIF(google_keyword, ''))
        WHEN 'Meta' THEN COALESCE(NULLIF(meta_ad, ''), NULLIF(meta_campaign, ''), NULLIF(meta_adset, '')) END AS platform_id FROM platr"""


def _plat(by: str, platform: str | None, extra: str = "") -> str:
    where = f"WHERE platform_group = '{platform}'" if platform else ""
    return f"SELECT {by}, {t('orders', 'revenue', 'aov', 'att', 'rate')}{extra} FROM platr {where} GROUP BY {by}"


def _distinct(column: str, name: str) -> str:
    return f", {big(f'COUNT(DISTINCT {column})')} AS {name}"


SQL["google_campaign_performance"] = _plat("google_campaign", "Google", _distinct("google_ad_group", "unique_ad_groups") + _distinct("google_keyword", "unique_keywords"))
SQL["google_keyword_performance"] = _plat("google_campaign, google_ad_group, google_keyword", "Google")
SQL["google_ad_group_performance"] = _plat("google_campaign, google_ad_group", "Google", _distinct("google_keyword", "unique_keywords"))
SQL["meta_campaign_performance"] = _plat("meta_campaign, meta_platform", "Meta", _distinct("meta_adset", "unique_adsets") + _distinct("meta_ad", "unique_ads"))
SQL["meta_adset_performance"] = _plat("meta_campaign, meta_adset, meta_platform", "Meta", _distinct("meta_ad", "unique_ads"))
SQL["meta_ad_performance"] = _plat("meta_campaign, meta_adset, meta_ad, meta_platform", "Meta")
SQL["platform_comparison"] = _plat("platform_group", None)
SQL["source_effectiveness_by_platform"] = _plat("platform_group, attribution_source", None)
SQL["top_google_keywords"] = f"""SELECT google_campaign, google_keyword, {big('SUM(total_orders)')} AS orders, SUM(total_revenue) AS revenue, {avg('avg_order_value')} AS aov
    FROM ({SQL['google_keyword_performance']}) GROUP BY 1, 2 ORDER BY SUM(total_revenue) DESC, 1 NULLS FIRST, 2 NULLS FIRST LIMIT 10"""
SQL["top_meta_ads"] = f"""SELECT meta_campaign, meta_ad, meta_platform, {big('SUM(total_orders)')} AS orders, SUM(total_revenue) AS revenue
    FROM ({SQL['meta_ad_performance']}) GROUP BY 1, 2, 3 ORDER BY SUM(total_revenue) DESC, 1 NULLS FIRST, 2 NULLS FIRST, 3 LIMIT 10"""
SQL["meta_platform_totals"] = f"""SELECT meta_platform, {N} AS orders, {dbl('SUM(order_value)')} AS revenue, {rat('SUM(order_value)', 'COUNT(*)')} AS aov
    FROM platr WHERE platform_group = 'Meta' GROUP BY meta_platform"""

# --- quality and monitoring -------------------------------------------------------------------
_Q3 = f"""SELECT 'batch_' || strftime(order_date, '%Y%m%d') AS batch_id, {N} AS total_records,
    {rat("COUNT(*) FILTER (WHERE order_value > 0)", 'COUNT(*)', 100, 2)} AS completeness_score,
    {rat("COUNT(*) FILTER (WHERE is_attributed = (attribution_source IS NOT NULL))", 'COUNT(*)', 100, 2)} AS consistency_score,
    {rat("COUNT(*) FILTER (WHERE order_value >= total_cogs AND total_cogs >= 0)", 'COUNT(*)', 100, 2)} AS accuracy_score FROM raw GROUP BY order_date"""
_SCORE = f"SELECT *, LEAST({rnd('completeness_score * 0.4 + consistency_score * 0.3 + accuracy_score * 0.3', 2)}, 100.0) AS quality_score FROM ({_Q3})"
SQL["quality_score"] = _SCORE
SQL["quality_validation"] = f"""SELECT batch_id, quality_score, completeness_score, consistency_score, accuracy_score, total_records, FALSE AS has_error,
    {rnd('total_records - accuracy_score * total_records / 100', 2)} AS accuracy_issues FROM ({_SCORE}) WHERE batch_id = 'batch_20240115'
    UNION ALL SELECT 'batch_20990101', 0.0, 0.0, 0.0, 0.0, 0, TRUE, NULL"""
_MIN = "(epoch_us(execution_end_time) / 1000000.0 - epoch_us(execution_start_time) / 1000000.0) / 60"
SQL["pipeline_health"] = f"""SELECT *, CASE WHEN last_successful_run > '2024-01-27 12:00:00' THEN 'HEALTHY' WHEN last_failed_run > '2024-01-27 12:00:00' THEN 'UNHEALTHY'
    ELSE 'NO_RECENT_RUNS' END AS health_status FROM (
    SELECT pipeline_name, strftime(MAX(execution_end_time) FILTER (WHERE execution_status = 'SUCCESS'), '%Y-%m-%d %H:%M:%S') AS last_successful_run,
    strftime(MAX(execution_end_time) FILTER (WHERE execution_status = 'FAILED'), '%Y-%m-%d %H:%M:%S') AS last_failed_run,
    {rat("COUNT(*) FILTER (WHERE execution_status = 'SUCCESS')", 'COUNT(*)', 100, 2)} AS success_rate,
    {rnd(f'SUM({_MIN}) / COUNT(execution_end_time)', 2)} AS avg_execution_time_minutes, {N} AS total_runs,
    {cond("execution_status = 'SUCCESS'")} AS successful_runs, {cond("execution_status = 'FAILED'")} AS failed_runs
    FROM rlog WHERE execution_start_time >= TIMESTAMP '2024-01-27 12:00:00' GROUP BY pipeline_name)"""
SQL["quality_alerts"] = f"""SELECT batch_id, pipeline_name, {ts('execution_start_time')} AS execution_time, data_quality_score, {big('total_orders_processed')} AS total_records,
    CASE WHEN data_quality_score < 80 THEN 'CRITICAL' WHEN data_quality_score < 90 THEN 'WARNING' ELSE 'INFO' END AS alert_level,
    CASE WHEN data_quality_score < 80 THEN 'Data quality score is critically low' WHEN data_quality_score < 90 THEN 'Data quality score is below recommended threshold'
        ELSE 'Data quality is within acceptable range' END AS alert_message
    FROM rlog WHERE execution_start_time >= TIMESTAMP '2024-01-20 12:00:00' AND execution_status = 'SUCCESS' AND data_quality_score < 95"""
_RUNCOUNTS = bigs("total_orders_processed", "total_ads_processed", "attributed_orders_count", "unattributed_orders_count")
SQL["run_summary"] = f"""SELECT pipeline_name, batch_id, execution_status, {ts('execution_start_time')} AS execution_start_time, {ts('execution_end_time')} AS execution_end_time,
    {rnd(_MIN, 2)} AS execution_duration_minutes, {_RUNCOUNTS}, {dbls('total_spend_processed', 'total_sales_processed')}, data_quality_score, error_message FROM rlog"""
SQL["pipeline_monitoring"] = f"""SELECT pipeline_name, batch_id, {ts('execution_start_time')} AS execution_start_time, {ts('execution_end_time')} AS execution_end_time, execution_status,
    {bigs('total_orders_processed', 'total_ads_processed')}, data_quality_score, error_message,
    CASE execution_status WHEN 'SUCCESS' THEN '✅' WHEN 'FAILED' THEN '❌' WHEN 'RUNNING' THEN '🔄' ELSE '❓' END AS status_icon FROM rlog"""
_ALERT = f"""SELECT '{{0}}' AS alert, pipeline_name, pipeline_run_id, {ts('execution_start_time')} AS execution_start_time, execution_status, data_quality_score,
    {big('total_orders_processed')} AS total_orders_processed, {big('prev')} AS previous_orders FROM (
    SELECT *, lag(total_orders_processed) OVER (PARTITION BY pipeline_name ORDER BY rlog.execution_start_time, pipeline_run_id) AS prev FROM rlog) r WHERE {{1}}"""
SQL["run_alerts"] = " UNION ALL ".join([
    _ALERT.format("pipeline failure", "execution_status = 'FAILED'"), _ALERT.format("data quality", "data_quality_score < 90"),
    _ALERT.format("performance", "epoch_us(r.execution_end_time) - epoch_us(r.execution_start_time) > 7200000000"),
    _ALERT.format("data volume", "total_orders_processed < prev * 0.8"),
])
SQL["run_states"] = f"""SELECT pipeline_run_id, {ts('execution_start_time')} AS execution_start_time, pipeline_name, execution_status,
    {big("CASE WHEN execution_status = 'RUNNING' THEN 0 ELSE total_orders_processed END")} AS total_orders_processed,
    {big("CASE WHEN execution_status = 'RUNNING' THEN 0 ELSE attributed_orders_count END")} AS attributed_orders_count,
    {ts('rlog.execution_end_time + INTERVAL 1 MINUTE')} AS execution_end_time,
    {rnd('(epoch_us(rlog.execution_end_time + INTERVAL 1 MINUTE) / 1000000.0 - epoch_us(rlog.execution_start_time) / 1000000.0) / 60', 2)} AS duration_minutes,
    {big("CASE WHEN execution_status = 'RUNNING' THEN 0 ELSE total_orders_processed - attributed_orders_count END")} AS unattributed_orders_count FROM rlog"""
_HOURS = f"""SELECT {day('ts')} AS date_start, {big('hour(ts)')} AS hour_start, printf('%02d:00:00 - %02d:59:59', hour(ts), hour(ts)) AS hour_window, ad_id,
    {cond("event_type = 'view'")} AS impressions, {cond("event_type = 'click'")} AS clicks, {dbl("COALESCE(SUM(value) FILTER (WHERE event_type IN ('view', 'click')), 0)")} AS spend,
    {cond("event_type = 'purchase'")} AS purchases, {dbl("COALESCE(SUM(value) FILTER (WHERE event_type = 'purchase'), 0)")} AS revenue FROM evk {{0}} GROUP BY 1, 2, 3, 4"""
_LATE, _EARLY = _HOURS.format("WHERE ts >= TIMESTAMP '2024-01-15' OR event_type = 'purchase'"), _HOURS.format("WHERE event_type <> 'purchase'")
SQL["latest_upsert"] = f"SELECT * FROM ({_LATE}) UNION ALL SELECT e.* FROM ({_EARLY}) e ANTI JOIN ({_LATE}) l USING (date_start, hour_start, ad_id)"
SQL["rule_seed_insert"] = """SELECT p.*, CAST(NULL AS VARCHAR) AS utm_campaign_pattern, 'Custom' AS channel, CAST(3 AS BIGINT) AS priority FROM (
    SELECT DISTINCT CASE WHEN d_source = 'blog' THEN 'referral' ELSE d_source END AS utm_source_pattern, CASE WHEN d_source <> 'blog' THEN d_medium END AS utm_medium_pattern
    FROM ord WHERE d_source IS NOT NULL) p WHERE NOT EXISTS (SELECT 1 FROM rules r WHERE r.sp = p.utm_source_pattern AND r.mp IS NOT DISTINCT FROM p.utm_medium_pattern AND r.priority = 3)"""
SQL["constraint_violations"] = f"""SELECT 'line_items' AS table_name, 'order_value_positive' AS constraint, item_id AS key, {N} AS rows FROM items WHERE NOT disc > 0 GROUP BY item_id
    UNION ALL SELECT 'line_items', 'unique', item_id, {N} FROM items GROUP BY item_id HAVING COUNT(*) > 1
    UNION ALL SELECT 'ad_level', 'unique', concat_ws('|', campaign_id, adset_id, ad_id, '2024-01-01', '2024-01-30', {BATCH}), {N} FROM lev
        WHERE campaign_id IS NOT NULL AND ad_id IS NOT NULL AND adset_id IS NOT NULL GROUP BY campaign_id, adset_id, ad_id HAVING COUNT(*) > 1"""
SQL["duplicate_items"] = f"SELECT item_id, {N} AS rows FROM items GROUP BY item_id HAVING COUNT(*) > 1"
SQL["rejected_orders"] = "SELECT order_id, 'unreadable customer_journey' AS reject_reasons FROM ord WHERE journey = '{bad'"


def _kept(name: str, column: str, source: str, cutoff: str) -> str:
    return f"SELECT '{name}' AS table_name, {cond(f'{column} < DATE {chr(39)}{cutoff}{chr(39)}')} AS rows_deleted, {cond(f'{column} >= DATE {chr(39)}{cutoff}{chr(39)}')} AS rows_kept FROM {source}"


SQL["retention_counts"] = " UNION ALL ".join([
    _kept("orders", "order_date", "act", "2024-01-20"), _kept("ads", "date_start", "ads", "2024-01-20"), _kept("runs", "analysis_date", "rlog", "2024-01-15"),
])
_CUT = "CASE WHEN length({0}) > 500 THEN substr({0}, 1, 500) || '...' ELSE {0} END"
_BLANK_J, _BLANK_A = "COALESCE(trim(journey), '') IN ('', 'null', 'None')", "COALESCE(trim(attrs), '') IN ('', 'null', 'None', '[]')"
SQL["audit_sample"] = f"""SELECT order_id, order_name, {day('order_date')} AS order_date, {dbl('order_value')} AS order_value,
    CASE WHEN {_BLANK_J} THEN 'No data' ELSE {_CUT.format('journey')} END AS customer_journey_raw, CASE WHEN {_BLANK_A} THEN 'No data' ELSE {_CUT.format('attrs')} END AS custom_attributes_raw,
    {', '.join(f'd_{f} AS customer_utm_{f}' for f in ('source', 'medium', 'campaign', 'content', 'term'))}, CAST(NULL AS VARCHAR) AS customer_referrer_url,
    NOT {_BLANK_J} AS has_customer_journey, NOT {_BLANK_A} AS has_custom_attributes, {big("length(COALESCE(journey, ''))")} AS journey_length,
    {big("length(COALESCE(attrs, ''))")} AS attributes_length FROM (
    SELECT *, row_number() OVER (ORDER BY order_date DESC, md5(order_id), order_id) - 1 AS rn, COUNT(*) OVER () AS n FROM ord WHERE cancelled_at_ist IS NULL)
    WHERE rn % (n // 50) = 0 AND rn // (n // 50) < 50"""
SQL["unreferenced_variants"] = f"SELECT variant_id, {N} AS rows FROM items WHERE variant_id NOT IN (SELECT variant_id FROM vars WHERE raw_sku IS NOT NULL) GROUP BY variant_id"

# --- sessions and hours ---------------------------------------------------------------------------
_SESS = """SELECT user_id, MIN(ts) AS st, MAX(ts) AS en, COUNT(*) AS n, COUNT(*) FILTER (WHERE event_type = 'view') AS pv, COUNT(*) FILTER (WHERE event_type = 'purchase') AS cv,
    COALESCE(SUM(value) FILTER (WHERE event_type = 'purchase'), 0) AS val, (epoch_us(MAX(ts)) - epoch_us(MIN(ts))) / 1000000.0 AS secs FROM (
    SELECT *, SUM(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, CAST(event_id AS VARCHAR)) AS sid FROM (
    SELECT *, COALESCE(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, CAST(event_id AS VARCHAR)) > INTERVAL 240 MINUTE, TRUE) AS opens FROM ev)) GROUP BY user_id, sid"""
SQL["event_sessions"] = f"""SELECT user_id, {ts('st')} AS session_start_time, {ts('en')} AS session_end_time, {big('n')} AS events, {big('pv')} AS pageviews_count, {big('cv')} AS conversions,
    {dbl('val')} AS conversion_value, secs AS time_on_site_seconds, cv > 0 AS is_conversion_session FROM ({_SESS})"""
SQL["engagement_by_hour"] = f"""SELECT {day('st')} AS date_start, {big('hour(st)')} AS hour_start, {N} AS total_sessions, {big('SUM(pv)')} AS total_pageviews,
    {rat('SUM(CAST(secs AS DECIMAL(28,6)))', 'COUNT(*)')} AS avg_session_duration_seconds, {div('COUNT(*) FILTER (WHERE n = 1)', 'COUNT(*)', 100, 4)} AS bounce_rate,
    printf('%02d:00:00 - %02d:59:59', hour(st), hour(st)) AS hour_window FROM ({_SESS}) GROUP BY CAST(st AS DATE), hour(st), strftime(st, '%Y-%m-%d')"""
SQL["hourly_window"] = f"SELECT date_start || printf(' %02d:00:00', hour_start) AS window_start, * FROM ({_HOURS.format('')})"

SQL["incremental_last_events"] = f"""SELECT {day('ts')} AS day, user_id, CAST(event_id AS VARCHAR) AS event_id, event_type FROM ev
    QUALIFY row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC) = 1"""


def _report(table: str, source: str, key: list[str], rules: dict[str, str]) -> str:
    """Rows of a table and how many break each rule; UNIQUE counts all rows of repeated keys without a null."""
    whole = " AND ".join(f"{k} IS NOT NULL" for k in key)
    said = {"unique": f"(SELECT COALESCE(SUM(c), 0) FROM (SELECT COUNT(*) AS c FROM ({source}) WHERE {whole} GROUP BY {', '.join(key)} HAVING COUNT(*) > 1))"}
    said |= {name: f"(SELECT COUNT(*) FROM ({source}) WHERE {broken})" for name, broken in rules.items()}
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS constraint, CAST((SELECT COUNT(*) FROM ({source})) AS BIGINT) AS rows, CAST({n} AS BIGINT) AS broken" for name, n in said.items()
    )


SQL["constraint_report"] = " UNION ALL ".join([
    _report("event_sessions", _SESS, ["user_id"], {"times_ordered": "st > en", "conversion_value_not_negative": "val < 0", "user_id_present": "user_id IS NULL"}),
    _report("utm_order_mapping", "SELECT * FROM umap", ["order_id"], {
        "order_value_positive": "order_value <= 0", "weight_in_range": "FALSE", "campaign_id_present": "campaign_id IS NULL", "utm_medium_present": "d_medium IS NULL"}),
    _report("hourly_utm_metrics", "SELECT * FROM hrly", ["date_start", "hour_start", "campaign_id"], {
        "hour_in_range": "hour_start NOT BETWEEN 0 AND 23", "metrics_not_negative": "total_sessions < 0 OR total_revenue < 0",
        "campaign_id_present": "campaign_id IS NULL", "ad_id_present": "ad_id IS NULL"}),
    _report("runs", "SELECT * FROM rlog", ["batch_id"], {
        "status_known": "execution_status NOT IN ('RUNNING', 'SUCCESS', 'FAILED', 'CANCELLED')", "date_range_ordered": "FALSE",
        "execution_end_time_present": "execution_end_time IS NULL", "error_message_present": "error_message IS NULL"}),
    _report("channel_rules", SQL["rule_seed_insert"], ["utm_source_pattern"], {"priority_positive": "priority <= 0", "utm_medium_pattern_present": "utm_medium_pattern IS NULL"}),
])

ORACLE = {name: build(sql) for name, sql in SQL.items()}
