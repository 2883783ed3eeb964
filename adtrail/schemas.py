"""Explicit schemas of every table; nothing in the library infers a schema."""

from __future__ import annotations


def _ddl(text: str) -> str:
    """DDL text, which readers take as a schema without a running session."""
    return " ".join(text.split())


ORDERS = _ddl("""
    order_id string, order_name string, created_at timestamp, processed_at timestamp,
    updated_at timestamp, closed_at timestamp, cancelled_at timestamp,
    created_at_ist string, processed_at_ist string, updated_at_ist string,
    closed_at_ist string, cancelled_at_ist string,
    total_price_amount decimal(15,2), total_price_currency string,
    total_shipping_amount decimal(15,2), total_shipping_currency string,
    display_fulfillment_status string, ship_city string, ship_province string, ship_country string,
    customer_id string, customer_referrer_url string,
    customer_utm_source string, customer_utm_medium string, customer_utm_campaign string,
    customer_utm_content string, customer_utm_term string,
    customer_journey string, custom_attributes string, order_date date
""")

LINE_ITEMS = _ddl("""
    item_id string, order_id string, variant_id string, title string, quantity int,
    original_unit_price_amount decimal(10,2), original_unit_price_currency string,
    discounted_unit_price_amount decimal(10,2), discounted_unit_price_currency string
""")

VARIANTS = _ddl("""
    variant_id string, sku string, variant_title string, unit_cost_amount decimal(10,2),
    unit_cost_currency string, product_id string, product_title string, vendor string,
    selling_price decimal(10,2), product_category string
""")

ADS_HOURLY = _ddl("""
    campaign_id string, campaign_name string, adset_id string, adset_name string,
    ad_id string, ad_name string, date_start date, date_stop date, hourly_window string,
    impressions bigint, clicks bigint, spend decimal(15,2),
    cpm decimal(10,4), cpc decimal(10,4), ctr decimal(8,4),
    action_onsite_web_purchase bigint, value_onsite_web_purchase decimal(15,2),
    action_onsite_web_add_to_cart bigint, action_onsite_web_initiate_checkout bigint,
    action_onsite_web_view_content bigint, action_link_click bigint
""")

UTM_SESSIONS = _ddl("""
    session_token string, visitor_id string, customer_id string,
    utm_source string, utm_medium string, utm_campaign string, utm_content string, utm_term string,
    campaign_id string, adset_id string, ad_id string,
    session_start_time timestamp_ntz, session_end_time timestamp_ntz,
    first_pageview_time timestamp_ntz, last_pageview_time timestamp_ntz,
    pageviews_count int, time_on_site_seconds int, is_conversion_session boolean,
    conversion_type string, conversion_value decimal(15,2), conversion_currency string,
    is_bot_traffic boolean, data_source string
""")

UTM_ORDER_MAPPING = _ddl("""
    order_id string, order_name string, order_date timestamp_ntz, order_value decimal(15,2),
    order_currency string, session_token string, attribution_model string,
    attribution_weight decimal(5,4), is_primary_attribution boolean,
    utm_source string, utm_medium string, utm_campaign string, utm_content string, utm_term string,
    campaign_id string, campaign_name string, adset_id string, adset_name string,
    ad_id string, ad_name string, channel string, sub_channel string,
    data_source string, batch_id string
""")

CHANNEL_RULES = _ddl("""
    rule_id int, utm_source_pattern string, utm_medium_pattern string, utm_campaign_pattern string,
    utm_content_pattern string, channel string, sub_channel string, channel_category string,
    platform string, priority int, is_active boolean
""")

RUN_LOG = _ddl("""
    pipeline_name string, pipeline_run_id string, batch_id string,
    execution_start_time timestamp_ntz, execution_end_time timestamp_ntz, execution_status string,
    total_orders_processed bigint, total_ads_processed bigint,
    attributed_orders_count bigint, unattributed_orders_count bigint,
    total_spend_processed decimal(15,2), total_sales_processed decimal(15,2),
    data_quality_score decimal(5,2), error_message string, error_details string,
    analysis_date_start date, analysis_date_end date, time_range_days int
""")

PRODUCT_BOOK = _ddl("""
    Product string, Search string, SKU string, Price double, Margin double,
    `Total Ad Spent` double, Revenue double, `Gross Roas` double, Breakeven double,
    `Net Roas` double, `Puchase Count` double
""")

AD_EXPORT = _ddl("""
    `Ad name` string, Product string, `Amount spent (INR)` double, Purchases double,
    `Purchase Value` double
""")

TABLES = {
    "shopify_orders": ORDERS,
    "shopify_order_line_items": LINE_ITEMS,
    "shopify_product_variants": VARIANTS,
    "ads_insights_hourly": ADS_HOURLY,
    "utm_sessions": UTM_SESSIONS,
    "utm_order_mapping": UTM_ORDER_MAPPING,
    "utm_channel_mapping": CHANNEL_RULES,
    "attribution_pipeline_log": RUN_LOG,
}
