"""Joins, folds, sinks and invariants on small frames."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from adtrail.functions.text import wall_clock
from adtrail.operators import adlevel, ads, granular, mapping, orders, products, quality, sku, utm
from adtrail.operators.attribution import attribute
from adtrail.plans import runs
from adtrail.sources import sinks, tables, testbed

WINDOW = tables.DateWindow(date(2024, 1, 1), date(2024, 1, 30))


@pytest.fixture(scope="module")
def store(spark, small):
    return testbed.store(spark, small)


@pytest.fixture(scope="module")
def attributed(spark, store, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw"))
    rows = attribute(store.orders, store.line_items, store.variants, store.ads)
    rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def test_line_money(spark):
    items = spark.createDataFrame(
        [("i1", "o1", "v1", "t", 2, 10.0, 0.0), ("i2", "o1", "v2", "t", 3, 10.0, 4.0), ("i3", "o1", "v9", "t", None, None, None), ("i4", "o1", "v1", "t", 1, 7.0, None)],
        "item_id string, order_id string, variant_id string, title string, quantity int, original_unit_price_amount double, discounted_unit_price_amount double",
    )
    variants = spark.createDataFrame([("v1", "A", "x", 3.0), ("v2", "", "x", None)], "variant_id string, sku string, variant_title string, unit_cost_amount double")
    items = items.withColumns({c: F.col(c).cast("decimal(10,2)") for c in ("original_unit_price_amount", "discounted_unit_price_amount")})
    variants = variants.withColumn("unit_cost_amount", F.col("unit_cost_amount").cast("decimal(10,2)"))
    lines = orders.priced_lines(items, variants)
    got = {r.item_id: (float(r.line_item_revenue), float(r.line_item_cogs), r.sku) for r in lines.collect()}
    assert got == {"i1": (20.0, 6.0, "A"), "i2": (12.0, 0.0, None), "i3": (0.0, 0.0, None), "i4": (7.0, 3.0, "A")}
    row = orders.fold_lines(lines).first()
    assert (float(row.total_cogs), row.line_items_count, row.skus, row.unique_skus_count, row.total_sku_quantity) == (9.0, 4, "A", 1, 3)


def test_every_order_is_kept_once(store, attributed):
    kept = tables.order_window(store.orders)
    assert attributed.count() == kept.count() == attributed.select("order_id").distinct().count()


def test_granular_conserves_revenue_and_ads(store, attributed):
    rows = granular.granular_insights(attributed, store.ads)
    got = rows.agg(F.sum("shopify_revenue"), F.sum("shopify_orders"), F.sum("spend"), F.count_if("has_ads")).first()
    want = attributed.agg(F.sum("order_value"), F.count("*")).first()
    ad_side = store.ads.agg(F.sum("spend"), F.count("*")).first()
    assert (got[0], got[1]) == (want[0], want[1])
    assert got[2] == ad_side[0] and got[3] == ad_side[1]
    assert rows.groupBy(*granular.HOUR_KEY).count().where("count > 1").count() == 0


def test_granular_null_keys_meet(spark, store, attributed):
    one = attributed.where("ad_id is not null").limit(1).withColumn("adset_name", F.lit(None).cast("string"))
    row = one.first()
    ad = store.ads.limit(1).withColumns(
        {c: F.lit(row[c]) for c in ("campaign_id", "campaign_name", "adset_id", "ad_id", "ad_name")}
    ).withColumns({"adset_name": F.lit(""), "date_start": F.to_date(F.lit(row.order_ts)), "hourly_window": F.lit(str(row.order_ts.hour))})
    merged = granular.granular_insights(one, ad).collect()
    assert len(merged) == 1 and merged[0].has_ads and merged[0].has_orders


def test_order_id_lists_are_whole(attributed):
    count = F.sum(F.size(F.split("order_ids", ", ")))
    for dealt in (1, 7):
        assert granular.order_ids_by_hour(attributed, dealt).agg(count).first()[0] == attributed.count()


def test_granular_with_ids_has_the_export_columns(store, attributed):
    rows = sinks.granular_export(granular.granular_insights(attributed, store.ads, order_ids=True))
    assert rows.columns == sinks.GRANULAR_EXPORT
    assert rows.where("order_ids <> ''").agg(F.sum(F.size(F.split("order_ids", ", ")))).first()[0] == attributed.count()


def test_ad_level_spend_once_sums_to_spend(store, attributed):
    daily = ads.daily_ads(store.ads)
    rows = adlevel.ad_level_summary(attributed, daily)
    assert rows.agg(F.sum("spend_once")).first()[0] == store.ads.agg(F.sum("spend")).first()[0]
    assert rows.agg(F.sum("orders")).first()[0] == attributed.where("campaign_name is not null").count()


def test_hierarchy_totals_equal_their_children(store, attributed):
    lines = orders.priced_lines(store.line_items, store.variants)
    per_sku = sku.ad_sku_performance(sku.sku_attribution(attributed, lines, store.ads))
    rows = sku.hierarchy(per_sku, ads.ad_totals(store.ads))
    by_level = {r.level: (r.s, r.sp) for r in rows.groupBy("level").agg(F.sum("total_sales").alias("s"), F.sum("ad_spent").alias("sp")).collect()}
    assert len({v[0] for v in by_level.values()}) == 1
    assert by_level["Ad Total"][1] == by_level["Adset Total"][1] == by_level["Campaign Total"][1]


def test_mapping_takes_the_day_and_attribution_the_first_day(spark, store):
    mapped = mapping.order_ad_mapping(store.orders, store.line_items, store.variants, store.ads)
    days = mapped.select("order_date", "ad_id").distinct()
    ad_days = store.ads.select(F.col("date_start").alias("order_date"), "ad_id").distinct()
    assert days.join(ad_days, ["order_date", "ad_id"], "left_anti").count() == 0
    first = ads.first_ad_per_id(ads.daily_ads(store.ads)).where("attribution_type = 'content'")
    earliest = store.ads.groupBy("ad_id").agg(F.min("date_start").alias("d"))
    assert first.join(earliest, first.attribution_id == earliest.ad_id).where("ad.date_start <> d").count() == 0


def test_product_match(spark):
    names = spark.createDataFrame([("Big FMB sale",), ("tote NC",), ("nothing here",), (None,), ("x",)], "name string")
    book = spark.createDataFrame(
        [(0, "Brush", "FMB, MISTBRU", 1.0, 1.0), (1, "Nail", "Nail Cutter, NC,", 1.0, 1.0), (2, "Tote", "TOTE", 1.0, 1.0), (3, "None", None, 1.0, 1.0)],
        "ord int, Product string, Search string, Price double, Margin double",
    )
    terms = products.search_terms(book, "ord")
    found = {r.name: r["product"] for r in products.match_products(names, terms, "name").collect()}
    assert found == {"Big FMB sale": "Brush", "tote NC": "Nail", "nothing here": products.NO_PRODUCT, None: products.NO_PRODUCT, "x": products.NO_PRODUCT}
    none = products.match_products(names, terms.limit(0), "name").collect()
    assert {r["product"] for r in none} == {products.NO_PRODUCT}


def test_upsert_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "hourly")
    first = spark.createDataFrame([("2024-01-01", "a", 1), ("2024-01-01", None, 2), ("2024-01-02", "a", 3)], "date_start string, k string, v int")
    second = spark.createDataFrame([("2024-01-01", "a", 10), ("2024-01-01", None, 20), ("2024-01-03", "b", 4)], "date_start string, k string, v int")
    key = ["date_start", "k"]
    sinks.upsert_partitions(spark, first, path, key)
    for _ in range(2):
        sinks.upsert_partitions(spark, second, path, key)
    got = sorted((str(r.date_start), r.k or "", r.v) for r in spark.read.parquet(path).collect())
    assert got == [("2024-01-01", "", 20), ("2024-01-01", "a", 10), ("2024-01-02", "a", 3), ("2024-01-03", "b", 4)]
    removed = sinks.drop_expired_partitions(spark, path, "date_start", date(2024, 4, 2), 91)
    assert removed == [date(2024, 1, 1)]
    assert spark.read.parquet(path).count() == 2


def test_a_repeated_write_replaces_its_days(spark, tmp_path):
    df = spark.range(1000).withColumn("order_date", F.lit("2024-01-01"))
    for rows in (df.withColumn("order_date", F.lit("2024-01-02")), df, df):
        sinks.write_partitioned(rows, str(tmp_path / "m"), "order_date")
    assert spark.read.parquet(str(tmp_path / "m")).count() == 2000


def test_rejected_orders_are_not_lost(store):
    bad_errors = quality.order_errors(store.orders)
    good, bad = quality.quarantine(store.orders, bad_errors)
    assert good.count() + bad.count() == store.orders.count()
    assert bad.count() > 0


def test_validation_rules(spark):
    df = spark.createDataFrame([("1", "5", "x"), ("", "abc", "y"), ("2", "500", None)], "id string, n string, z string")
    errors = quality.validation_errors(df, ["id", "z"], {"n": "int"}, {"n": (0, 100)})
    got = [r.e for r in df.select(errors.alias("e")).collect()]
    assert got == [[], ["missing id", "not int: n"], ["missing z", "out of range: n"]]


def test_violations(spark):
    df = spark.createDataFrame([("a", 1), ("a", -1), ("b", None), (None, 2)], "order_id string, order_value int")
    got = {(r.constraint, r.key): r.rows for r in quality.violations(df, "t", ["order_id"], {"positive": "order_value >= 0"}).collect()}
    assert got == {("positive", "a"): 1, ("unique", "a"): 2}


def test_health_windows(spark):
    now = datetime(2024, 1, 2)
    rows = [("p", datetime(2024, 1, 1, 12), datetime(2024, 1, 1, 13), "SUCCESS"), ("q", datetime(2024, 1, 1, 12), datetime(2024, 1, 1, 13), "FAILED"), ("r", datetime(2024, 1, 1, 12), None, "RUNNING"), ("p", datetime(2023, 1, 1), datetime(2023, 1, 1, 1), "FAILED")]
    log = spark.createDataFrame(rows, "pipeline_name string, execution_start_time timestamp_ntz, execution_end_time timestamp_ntz, execution_status string")
    got = {r.pipeline_name: (r.health_status, r.total_runs, r.avg_execution_time_minutes) for r in quality.pipeline_health(log, now).collect()}
    assert got == {"p": ("HEALTHY", 1, 60.0), "q": ("UNHEALTHY", 1, 60.0), "r": ("NO_RECENT_RUNS", 1, None)}


def test_audit_sample_size(store):
    rows = quality.audit_sample(tables.order_window(store.orders), 50)
    assert rows.count() == 50 and rows.select("order_id").distinct().count() == 50
    few = tables.order_window(store.orders).limit(7)
    assert quality.audit_sample(few, 50).count() == 7


def test_runs_store_what_they_report(spark, store, tmp_path):
    out = runs.attribution_run(store, WINDOW, str(tmp_path), "b1")
    assert out["channel_breakdown"].agg(F.sum("orders")).first()[0] == out["attributed"].count()
    hours = spark.read.parquet(f"{tmp_path}/granular/batch_id=b1")
    assert hours.agg(F.sum("shopify_orders")).first()[0] == out["attributed"].count()
    assert hours.select(*sinks.GRANULAR_EXPORT).where("order_ids <> ''").agg(F.sum(F.size(F.split("order_ids", ", ")))).first()[0] == out["attributed"].count()
    assert spark.sql("select sum(total_orders) from v_channel_performance").first()[0] == out["attributed"].count()
    runs.mapping_run(store, WINDOW, str(tmp_path))
    before = spark.read.parquet(f"{tmp_path}/order_ad_mapping").count()
    stored = runs.mapping_run(store, WINDOW, str(tmp_path))
    assert stored.count() == before
    assert spark.sql("select sum(orders) from v_daily_ad_performance").first()[0] == stored.count()
    first = runs.utm_run(store, WINDOW, str(tmp_path), "b1")["hourly"].count()
    assert spark.sql("select sum(total_orders) from v_utm_daily_summary").first()[0] > 0 and spark.table("v_utm_ad_hourly_performance").count() > 0
    assert spark.table("v_attribution_funnel_analysis").count() > 0
    again = runs.utm_run(store, WINDOW, str(tmp_path), "b1")
    assert again["hourly"].count() == first
    assert again["mapping"].count() == again["mapping"].select("order_id").distinct().count() == again["sessions"].count()


def test_an_unreadable_time_goes_to_quarantine(spark, store, tmp_path):
    some = store.orders.limit(30)
    bad = some.limit(1).withColumns({"order_id": F.lit("gid://x/1"), "created_at_ist": F.lit("bad")})
    orders = some.unionByName(bad)
    if "order_date" in orders.columns:
        orders = orders.withColumn("order_date", F.when(F.col("order_id") == "gid://x/1", None).otherwise(F.col("order_date")))
    for _ in range(2):
        out = runs.attribution_run(runs.Store(orders, store.line_items, store.variants, store.ads), WINDOW, str(tmp_path), "b2")
        assert [r.reject_reasons for r in out["rejected"].collect()] == [["unreadable created_at_ist"]]
        assert out["attributed"].where("order_id = 'gid://x/1'").count() == 0


def test_sessions_stored_twice_count_once(store):
    sessions, mapped = utm.utm_sessions(store.orders, WINDOW), utm.utm_order_mapping(store.orders, WINDOW, "b")
    total = lambda s: utm.hourly_utm_metrics(mapped, s, "b").agg(F.sum("total_orders"), F.sum("total_revenue")).first()
    assert total(sessions) == total(sessions.unionByName(sessions))


def test_wall_clock_reads_what_it_can(spark):
    texts = ["2025-07-01 00:59:44+0530", "2025-07-01 00:59", "2025-07-01T00:59:44.25Z", "2025-07-01", "bad", "2025-13-01 00:00:00", "", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    got = [str(r.t) for r in df.select("i", wall_clock("x").alias("t")).orderBy("i").collect()]
    assert got == ["2025-07-01 00:59:44", "2025-07-01 00:59:00", "2025-07-01 00:59:44.250000", "2025-07-01 00:00:00", "None", "None", "None", "None"]


def test_csv_sources(spark, tmp_path):
    (tmp_path / "book.csv").write_text('Product,Search,SKU,Price,Margin,a,b,c,d,e,f\nBrush,"FMB, MIST",S1,799,499,,,,,,\n')
    row = tables.read_product_book(spark, str(tmp_path / "book.csv")).first()
    assert (row.Product, row.Search, row.Price) == ("Brush", "FMB, MIST", 799.0)
    sinks.write_csv(spark.range(3), str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 3


def test_windows_resolve():
    assert tables.resolve_window("2024-01-01", "2024-01-05").end == date(2024, 1, 5)
    w = tables.resolve_window(days=7, as_of=date(2024, 1, 10))
    assert (w.start, w.end) == (date(2024, 1, 3), date(2024, 1, 10))


def test_constraint_report_finds_each_broken_rule(spark):
    from adtrail.operators import quality

    report = lambda df, key, checks, required=(): {
        r.constraint: (r.rows, r.broken) for r in quality.constraint_report(df, "t", key, checks, list(required)).collect()
    }
    runs = spark.createDataFrame(
        [("a", "DONE", "2024-01-02", "2024-01-01"), ("a", "FAILED", "2024-01-01", None), (None, None, "2024-01-01", "2024-01-01"), (None, "RUNNING", None, None)],
        "id string, execution_status string, analysis_date_start string, analysis_date_end string",
    )
    assert report(runs, ["id"], quality.RUN_CHECKS, ["execution_status"]) == {
        "unique": (4, 2), "status_known": (4, 1), "date_range_ordered": (4, 1), "execution_status_present": (4, 1)}
    sessions = spark.createDataFrame([(1, 5, 4, -1.0), (2, 4, 5, None)], "id int, session_start_time int, session_end_time int, conversion_value double")
    assert report(sessions, ["id"], quality.SESSION_CHECKS) == {"unique": (2, 0), "times_ordered": (2, 1), "conversion_value_not_negative": (2, 1)}
    mapping = spark.createDataFrame([(1, 0.0, 1.5), (2, 3.0, -0.1), (3, 1.0, 1.0)], "id int, order_value double, attribution_weight double")
    assert report(mapping, ["id"], quality.MAPPING_CHECKS) == {"unique": (3, 0), "order_value_positive": (3, 1), "weight_in_range": (3, 2)}
    hours = spark.createDataFrame([(1, 24, 1, -5.0), (1, 0, 1, 1.0)], "id int, hour_start int, total_sessions int, total_revenue double")
    assert report(hours, ["id"], quality.HOURLY_CHECKS) == {"unique": (2, 2), "hour_in_range": (2, 1), "metrics_not_negative": (2, 1)}
    rules = spark.createDataFrame([("x", 0), ("y", None)], "id string, priority int")
    assert report(rules, ["id"], quality.RULE_CHECKS) == {"unique": (2, 0), "priority_positive": (2, 1)}
    assert report(rules.limit(0), ["id"], quality.RULE_CHECKS) == {"unique": (0, 0), "priority_positive": (0, 0)}


def test_costly_work_is_spread_over_tasks_whatever_the_files(spark, tmp_path):
    from adtrail.operators.ads import daily_ads
    from adtrail.sources import testbed

    tables = {
        "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
        "events": "event_id long, ts timestamp, user_id long, event_type string, value double, props string",
        "lineitem": "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double",
    }
    for name, columns in tables.items():
        spark.createDataFrame([], columns).write.parquet(f"{tmp_path}/{name}.parquet")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    for read in (testbed.orders, testbed.events, testbed.line_items):
        top, bottom = plan(read(spark, str(tmp_path))).split("RepartitionByExpression")
        assert "concat" not in bottom and "get_json_object" not in bottom
    # Filters on the ad keys read the parsed key; they neither parse it again nor go below the spread rows.
    assert plan(daily_ads(testbed.ads_hourly(spark, str(tmp_path)))).count("get_json_object") == 1
