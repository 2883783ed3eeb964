"""The given star-schema tables read as shop, ad and event tables.

Every column is an expression over the given rows. Orders' dates are folded
into the events' 30 days so that orders and ads meet; the UTM data comes from a
short list of cases, one per channel rule.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adtrail.functions.measures import safe_div
from adtrail.functions.text import hour_label
from adtrail.plans.runs import Store

# (source, medium, campaign, content, term); @ad, @adset and @campaign stand for ids.
UTM_CASES = [
    ("facebook", "cpc", "spring_sale", "@ad", "lookalike"),
    ("ig", "paid", "@campaign", None, None),
    ("google", "cpc", "brand_search", "@ad", "shoes"),
    ("fb", "@adset", None, None, None),
    ("google", "cpc", None, "@ad", None),
    ("google", "cpc", None, None, None),
    ("google", "organic", None, None, None),
    ("bing", "cpc", None, None, None),
    ("newsletter", "email", "winter", None, None),
    ("ig", "organic", None, None, None),
    ("search", "x", None, None, None),
    ("digital", "x", None, None, None),
    ("{{site_source_name}}", "x", None, "{{ad.id}}", None),
    ("brand", "x", None, None, None),
    ("direct", "x", None, None, None),
    ("klaviyo", None, None, None, None),
    (None, None, None, None, None),
    (None, "email", None, None, None),
    ("blog", "referral", None, None, None),
    ("shop.co.uk", "x", None, None, None),
    ("twitter", "social", None, None, None),
    ("klaviyo", "email", None, None, None),
    ("klaviyo", "cpc", None, None, None),
    ("instagram", "social", "@campaign", "@ad", "interest"),
    ("facebook", "cpc", None, "@ad", None),
]
FIELDS = ["source", "medium", "campaign", "content", "term"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt over all tasks by ``keys``, for work that costs far more than the read, such as building and parsing JSON.

    A file is read by as many tasks as it has row groups, which for narrow tables are few and large. Several keys, so
    that nulls or repeats in one of them gather no rows; the number of tasks is left to adaptive execution.
    """
    return rows.repartition(*keys)


def ad_id(k) -> Column:
    return F.concat(F.lit("1202213430908"), (k + 60000).cast("string"))


def adset_id(k) -> Column:
    return F.concat(F.lit("1202213430907"), (k % 20 + 50000).cast("string"))


def campaign_id(k) -> Column:
    return F.concat(F.lit("1202213430906"), (k % 5 + 40000).cast("string"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their ad keys; value as money.

    ``k`` comes out of a one-row generator, so that filters on the ad keys read it and don't parse ``props`` again each.
    """
    k = F.get_json_object("props", "$.k").cast("int")
    return spread(table(spark, sf_dir, "events"), "event_id", "ts", "props").select(
        "event_id", "ts", "user_id", "event_type", F.col("value").cast("decimal(15,2)").alias("value"), F.inline(F.array(F.struct(k.alias("k"))))
    )


def with_ad_keys(rows: DataFrame) -> DataFrame:
    k = F.col("k")
    return rows.withColumns(
        {
            "campaign_id": campaign_id(k),
            "campaign_name": F.concat(F.lit("Campaign "), (k % 5).cast("string")),
            "adset_id": adset_id(k),
            "adset_name": F.concat(F.lit("Adset "), (k % 20).cast("string")),
            "ad_id": ad_id(k),
            "ad_name": F.concat(F.lit("Ad "), k.cast("string")),
        }
    )


def ads_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    count = lambda name: F.count_if(kind == name)
    money = lambda *names: F.coalesce(F.sum(F.when(kind.isin(*names), value)), F.lit(0)).cast("decimal(15,2)")
    grouped = events(spark, sf_dir).groupBy(F.to_date("ts").alias("date_start"), F.hour("ts").alias("_hour"), "k").agg(
        count("view").alias("impressions"), count("click").alias("clicks"), money("view", "click").alias("spend"),
        count("purchase").alias("action_onsite_web_purchase"), money("purchase").alias("value_onsite_web_purchase"),
        count("signup").alias("action_onsite_web_add_to_cart"), count("error").alias("action_onsite_web_initiate_checkout"),
        count("view").alias("action_onsite_web_view_content"), count("click").alias("action_link_click"),
    )
    rated = grouped.withColumns(
        {
            "date_stop": F.col("date_start"),
            "hourly_window": hour_label("_hour"),
            "cpm": safe_div("spend", "impressions", 1000),
            "cpc": safe_div("spend", "clicks"),
            "ctr": safe_div("clicks", "impressions", 100),
        }
    )
    return with_ad_keys(rated).drop("_hour", "k")


def _quoted(value: str | None) -> str:
    return "cast(null as string)" if value is None else f"'{value}'"


def _cases() -> str:
    struct = lambda case: "struct(" + ", ".join(f"{_quoted(v)} as {f}" for f, v in zip(FIELDS, case)) + ")"
    return "array(" + ", ".join(struct(c) for c in UTM_CASES) + ")"


def _moment(value) -> str:
    """JSON text of one journey moment; ``value`` gives the SQL of a field."""
    fields = [f"""'"{f}":', coalesce(concat('"', {value(f)}, '"'), 'null')""" for f in FIELDS]
    return """concat('{"utmParameters":{', """ + ", ',', ".join(fields) + ", '}}')"


def _pair(key: str, value: str) -> str:
    return f"""concat('{{"key":"{key}","value":"', {value}, '"}}')"""


def _ad(k: str) -> str:
    return f"concat('1202213430908', {k} + 60000)"


EARLIER = {"source": "'google'", "medium": "'organic'", "content": _ad("(_k + 1) % 120")}


def orders(spark: SparkSession, sf_dir: str, geography: bool = False, referrers: bool = False) -> DataFrame:
    base = spread(table(spark, sf_dir, "orders"), "o_orderkey", "o_custkey", "o_orderdate").selectExpr(
        "*",
        "cast(floor(o_orderkey / 7) % 120 as int) as _k",
        "o_orderkey % 7 as _path",
        f"element_at({_cases()}, cast(o_custkey % {len(UTM_CASES)} + 1 as int)) as _case",
        "date_add(date'2024-01-01', datediff(to_date(o_orderdate), date'1992-01-01') % 30) as order_date",
    )
    ids = {"@ad": _ad("_k"), "@adset": "concat('1202213430907', _k % 20 + 50000)", "@campaign": "concat('1202213430906', _k % 5 + 40000)"}
    whens = " ".join(f"when '{mark}' then {sql}" for mark, sql in ids.items())
    rows = base.selectExpr("*", *[f"case _case.{f} {whens} else _case.{f} end as _{f}" for f in FIELDS])
    earlier = _moment(lambda f: EARLIER.get(f, "cast(null as string)"))
    this = _moment(lambda f: f"_{f}")
    twice = f"if(_path = 4, {_pair('utm_content', _ad('(_k + 2) % 120'))}, null)"
    pairs = ", ".join(_pair(f"utm_{f}", f"_{f}") for f in FIELDS)
    stamp = (
        "concat(cast(order_date as string), ' ', lpad(o_orderkey % 24, 2, '0'), ':', "
        "lpad(floor(o_orderkey / 24) % 60, 2, '0'), ':00+0530')"
    )
    out = rows.selectExpr(
        "concat('gid://shop/Order/', o_orderkey) as order_id",
        "concat('#', o_orderkey) as order_name",
        "order_date",
        f"{stamp} as created_at_ist",
        f"if(o_orderstatus = 'P' and o_orderpriority = '5-LOW', {stamp}, null) as cancelled_at_ist",
        "cast(o_totalprice as decimal(15,2)) as total_price_amount",
        "'INR' as total_price_currency",
        "concat('cust_', o_custkey) as customer_id",
        *[f"if(_path >= 5 or o_orderkey % 2 = 0, _{f}, null) as customer_utm_{f}" for f in FIELDS],
        f"""case _path when 0 then concat('{{"moments":[', {earlier}, ',', {this}, ']}}')
                 when 1 then concat('{{"moments":[', {this}, ']}}')
                 when 2 then concat('{{"moments":[', {this}, ',null]}}')
                 when 6 then if(o_orderkey % 2 = 0, '{{bad', 'null') end as customer_journey""",
        f"""case when _path in (3, 4) then concat('[', concat_ws(',', '{{"key":"gift","value":"yes"}}', {twice}, {pairs}), ']')
                 when _path = 5 then '[]' end as custom_attributes""",
        "o_custkey",
    )
    nothing = F.lit(None).cast("string")
    if geography:
        customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        nation = table(spark, sf_dir, "nation")
        region = table(spark, sf_dir, "region")
        places = (
            customer.join(nation, customer.c_nationkey == nation.n_nationkey)
            .join(region, nation.n_regionkey == region.r_regionkey)
            .selectExpr(
                "c_custkey", "r_name as ship_country", "n_name as ship_province",
                "concat(n_name, ' ', c_mktsegment) as ship_city",
            )
        )
        out = out.join(places, out.o_custkey == places.c_custkey, "left").drop("c_custkey")
    else:
        out = out.withColumns({c: nothing for c in ("ship_city", "ship_province", "ship_country")})
    if referrers:
        pages = table(spark, sf_dir, "pages").selectExpr("page_id", "url as customer_referrer_url")
        out = out.join(pages, out.o_custkey == pages.page_id, "left").drop("page_id")
    else:
        out = out.withColumn("customer_referrer_url", nothing)
    return out.drop("o_custkey")


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    money = lambda sql: f"cast(round(cast({sql} as decimal(38,10)), 2) as decimal(10,2))"
    price = "l_extendedprice / l_quantity"
    return spread(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey", "l_extendedprice").selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, cast(l_quantity as int)) as item_id",
        "concat('gid://shop/Order/', l_orderkey) as order_id",
        "concat('var_', l_partkey) as variant_id",
        "concat('Item ', l_partkey) as title",
        "cast(l_quantity as int) as quantity",
        f"{money(price)} as original_unit_price_amount",
        f"if(l_discount = 0, cast(0 as decimal(10,2)), {money(f'{price} * (1.0D - l_discount)')}) as discounted_unit_price_amount",
    )


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "concat('var_', p_partkey) as variant_id",
        "case when p_size = 2 then '' when p_size > 1 then concat('SKU-', p_partkey) end as sku",
        "p_brand as variant_title",
        "if(p_size <> 3, cast(p_retailprice as decimal(10,2)), null) as unit_cost_amount",
        "cast(p_partkey as string) as product_id",
        "p_name as product_title",
        "p_brand as vendor",
        "cast(p_retailprice as decimal(10,2)) as selling_price",
        "if(p_type <> 'PROMO', p_type, null) as product_category",
    )


def store(spark: SparkSession, sf_dir: str, geography: bool = False, referrers: bool = False) -> Store:
    return Store(
        orders(spark, sf_dir, geography, referrers), line_items(spark, sf_dir), variants(spark, sf_dir), ads_hourly(spark, sf_dir)
    )


def touches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_ad_keys(events(spark, sf_dir).where(F.col("event_type").isin("view", "click")))
    return rows.select(
        "user_id", F.col("event_id").alias("touch_id"), F.col("ts").alias("touch_time"), "campaign_id", "ad_id"
    )


def conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).where(F.col("event_type") == "purchase").select(
        "user_id", F.col("event_id").alias("order_id"), F.col("ts").alias("order_time"), F.col("value").alias("order_value")
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per (event key, day); more errors than purchases is a failure."""
    kind = F.col("event_type")
    bad, good, all_rows = F.count_if(kind == "error"), F.count_if(kind == "purchase"), F.count(F.lit(1))
    day = F.to_date("ts")
    status = F.when(bad > good, "FAILED").when(good > 0, "SUCCESS").when(F.count_if(kind == "view") > 0, "CANCELLED").otherwise("RUNNING")
    return events(spark, sf_dir).groupBy("k", day.alias("day")).agg(
        status.alias("execution_status"),
        F.min("ts").alias("execution_start_time"), F.max("ts").alias("_end"),
        all_rows.alias("total_orders_processed"),
        F.count_if(kind.isin("view", "click")).alias("total_ads_processed"),
        good.alias("attributed_orders_count"),
        (all_rows - good).alias("unattributed_orders_count"),
        F.coalesce(F.sum(F.when(kind.isin("view", "click"), F.col("value"))), F.lit(0)).cast("decimal(15,2)").alias("total_spend_processed"),
        F.coalesce(F.sum(F.when(kind == "purchase", F.col("value"))), F.lit(0)).cast("decimal(15,2)").alias("total_sales_processed"),
        safe_div(all_rows - bad, all_rows, 100, 2).alias("data_quality_score"),
    ).select(
        F.concat(F.lit("pipeline_"), (F.col("k") % 10).cast("string")).alias("pipeline_name"),
        F.concat(F.lit("run_"), F.col("k").cast("string"), F.lit("_"), F.date_format("day", "yyyyMMdd")).alias("pipeline_run_id"),
        F.concat(F.lit("batch_"), F.date_format("day", "yyyyMMdd")).alias("batch_id"),
        "execution_start_time", F.when(F.col("execution_status") != "RUNNING", F.col("_end")).alias("execution_end_time"),
        "execution_status", "total_orders_processed", "total_ads_processed", "attributed_orders_count",
        "unattributed_orders_count", "total_spend_processed", "total_sales_processed", "data_quality_score",
        F.when(F.col("execution_status") == "FAILED", "too many errors").alias("error_message"),
        F.col("day").alias("analysis_date_start"), F.col("day").alias("analysis_date_end"),
    )


# Product book over the given part names: (product, terms, price, margin).
BOOK = [
    ("Brand Awareness", "awareness, UGC", 0.0, 0.0),
    ("Ring Light", "ring, RNG", 799.0, 499.0),
    ("Widget Pro", "Widget, new gizmo", 399.0, 115.0),
    ("Bolt Set", "BOLT,,  nut", 919.0, 495.0),
    ("Red Line", "red ", 1399.0, 498.0),
    ("Gear Box", "gear, hot plate", 499.0, 238.0),
]


def product_book(spark: SparkSession) -> DataFrame:
    rows = [(i, p, t, price, margin) for i, (p, t, price, margin) in enumerate(BOOK)]
    return spark.createDataFrame(rows, "book_order int, Product string, Search string, Price double, Margin double")


def ad_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad rows whose names are sold products' names: spend, purchases and value per line item."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity", "l_extendedprice", "l_tax")
    return lines.join(part, lines.l_partkey == part.p_partkey).select(
        F.initcap("p_name").alias("Ad name"),
        F.col("l_tax").cast("decimal(15,2)").alias("Amount spent (INR)"),
        F.col("l_quantity").cast("decimal(15,2)").alias("Purchases"),
        F.col("l_extendedprice").cast("decimal(15,2)").alias("Purchase Value"),
    )
