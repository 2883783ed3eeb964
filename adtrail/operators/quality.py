"""Data-quality scores, constraint checks, rejected rows and run monitoring."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtrail.functions.measures import half_up, ratio
from adtrail.functions.text import is_blank, trimmed, wall_clock


def _conditions() -> dict[str, Column]:
    value, cogs = F.col("order_value"), F.col("total_cogs")
    return {
        "completeness": F.col("order_id").isNotNull() & F.col("order_date").isNotNull() & F.coalesce(value > 0, F.lit(False)),
        "consistency": F.col("is_attributed") == F.col("attribution_source").isNotNull(),
        "accuracy": F.coalesce((value >= cogs) & (cogs >= 0), F.lit(False)),
    }


def batch_quality(orders: DataFrame, by: str = "batch_id") -> DataFrame:
    """Quality score per batch with its three parts, in one pass.

    0.4 completeness + 0.3 consistency + 0.3 accuracy, each the percentage of
    good rows rounded to 2 places; at most 100.
    """
    rows = F.count(F.lit(1))
    counted = orders.groupBy(by).agg(
        rows.alias("total_records"),
        *[F.count_if(c).alias(f"_{name}") for name, c in _conditions().items()],
    )
    parts = ["completeness", "consistency", "accuracy"]
    scored = counted.withColumns({f"{p}_score": ratio(f"_{p}", "total_records", 100, 2) for p in parts})
    score = F.col("completeness_score") * 0.4 + F.col("consistency_score") * 0.3 + F.col("accuracy_score") * 0.3
    return scored.withColumn("quality_score", F.least(half_up(score, 2), F.lit(100.0))).drop(*[f"_{p}" for p in parts])


def validate_batch(orders: DataFrame, batch_id: str, as_of: datetime) -> DataFrame:
    """One row: the batch's scores and JSON details; an empty batch scores 0 with an error."""
    scored = batch_quality(orders.where(F.col("batch_id") == batch_id))
    wanted = orders.sparkSession.createDataFrame([(batch_id,)], "batch_id string")
    issues = lambda part: half_up(
        F.col("total_records") - F.col(f"{part}_score") * F.col("total_records") / 100, 2
    )
    details = F.to_json(
        F.struct(
            F.col("total_records"),
            issues("completeness").alias("completeness_issues"),
            issues("consistency").alias("consistency_issues"),
            issues("accuracy").alias("accuracy_issues"),
            F.lit(as_of).alias("validation_timestamp"),
        )
    )
    empty = F.lit('{"error": "No records found for batch"}')
    joined = wanted.join(scored, "batch_id", "left")
    none = F.col("total_records").isNull()
    return joined.select(
        "batch_id",
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("quality_score", "completeness_score", "consistency_score", "accuracy_score")],
        F.coalesce("total_records", F.lit(0)).alias("total_records"),
        F.when(none, empty).otherwise(details).alias("validation_details"),
    )


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


ORDER_CHECKS = {"order_date_present": "order_date IS NOT NULL", "order_value_not_negative": "order_value >= 0"}
AD_LEVEL_CHECKS = {
    "orders_not_negative": "orders >= 0",
    "attributed_orders_in_range": "attributed_orders >= 0 AND attributed_orders <= orders",
    "spend_not_negative": "spend >= 0",
    "date_range_ordered": "analysis_date_end >= analysis_date_start",
}
RUN_CHECKS = {
    "status_known": "execution_status IN ('RUNNING', 'SUCCESS', 'FAILED', 'CANCELLED')",
    "date_range_ordered": "analysis_date_end >= analysis_date_start",
}
SESSION_CHECKS = {
    "times_ordered": "session_start_time <= session_end_time",
    "conversion_value_not_negative": "conversion_value >= 0",
}
MAPPING_CHECKS = {
    "order_value_positive": "order_value > 0",
    "weight_in_range": "attribution_weight >= 0 AND attribution_weight <= 1",
}
HOURLY_CHECKS = {
    "hour_in_range": "hour_start >= 0 AND hour_start <= 23",
    "metrics_not_negative": "total_sessions >= 0 AND total_revenue >= 0",
}
RULE_CHECKS = {"priority_positive": "priority > 0"}


def violations(df: DataFrame, table: str, key: list[str], checks: dict[str, str], unique: bool = True) -> DataFrame:
    """(table, constraint, key, rows) of every broken UNIQUE or CHECK.

    As in SQL, a check that evaluates to null holds. All checks read the table
    in one pass; duplicates take a second one.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key])
    broken = F.filter(
        F.array(*[F.when(F.expr(f"NOT ({rule})"), F.lit(name)) for name, rule in checks.items()]),
        lambda name: name.isNotNull(),
    )
    found = (
        df.select(text.alias("key"), F.explode(broken).alias("constraint"))
        .groupBy("constraint", "key").agg(F.count(F.lit(1)).alias("rows"))
    )
    if unique:
        repeated = (
            df.dropna(subset=key).groupBy(text.alias("key")).agg(F.count(F.lit(1)).alias("rows"))
            .where(F.col("rows") > 1).select(F.lit("unique").alias("constraint"), "key", "rows")
        )
        found = found.unionByName(repeated)
    return found.select(F.lit(table).alias("table_name"), "constraint", "key", "rows")


def constraint_report(df: DataFrame, table: str, key: list[str], checks: dict[str, str], required: list[str] = ()) -> DataFrame:
    """(table_name, constraint, rows, broken) of every CHECK, NOT NULL and the UNIQUE of ``key``, broken or not.

    One scan and one shuffle: rows fold by key before it, with a count for each rule. As in SQL, a check that evaluates to
    null holds, and keys with a null do not repeat. ``broken`` of UNIQUE counts all rows of repeated keys.
    """
    rules = {**checks, **{f"{c}_present": f"{c} IS NOT NULL" for c in required}}
    folded = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.expr(f"NOT ({rule})")).alias(f"_{i}") for i, rule in enumerate(rules.values())]
    )
    repeated = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key]) & (F.col("_n") > 1)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    counts = folded.agg(
        total(F.col("_n")).alias("rows"), total(F.when(repeated, F.col("_n"))).alias("_unique"),
        *[total(F.col(f"_{i}")).alias(f"_{i}") for i in range(len(rules))],
    )
    named = [("unique", "_unique"), *[(name, f"_{i}") for i, name in enumerate(rules)]]
    each = F.array(*[F.struct(F.lit(name).alias("constraint"), F.col(c).alias("broken")) for name, c in named])
    return counts.select(F.lit(table).alias("table_name"), "rows", F.inline(each))


def validation_errors(
    df: DataFrame, required: list[str] = (), types: dict[str, str] | None = None, ranges: dict[str, tuple] | None = None
) -> Column:
    """Array of the rules a row breaks: required field, type, range."""
    rules = [F.when(is_blank(F.col(c).cast("string")), F.lit(f"missing {c}")) for c in required]
    for c, kind in (types or {}).items():
        bad = F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull()
        rules.append(F.when(bad, F.lit(f"not {kind}: {c}")))
    for c, (low, high) in (ranges or {}).items():
        value = F.col(c).try_cast("double")
        rules.append(F.when(~value.between(low, high), F.lit(f"out of range: {c}")))
    return F.filter(F.array(*rules), lambda r: r.isNotNull())


def quarantine(df: DataFrame, errors: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with their reasons); together they are all rows."""
    marked = df.withColumn("reject_reasons", errors)
    bad = F.size("reject_reasons") > 0
    return marked.where(~bad).drop("reject_reasons"), marked.where(bad)


def unusable_order(orders: DataFrame) -> Column:
    """Why an order cannot enter a run: no id, value or time, or a time that cannot be read."""
    base = validation_errors(
        orders, ["order_id", "created_at_ist", "total_price_amount"], {"total_price_amount": "decimal(15,2)"}, {"total_price_amount": (0, 1e12)}
    )
    unread = ~is_blank(F.col("created_at_ist")) & wall_clock("created_at_ist").isNull()
    return F.concat(base, F.filter(F.array(F.when(unread, F.lit("unreadable created_at_ist"))), lambda r: r.isNotNull()))


def order_errors(orders: DataFrame) -> Column:
    """Why an order cannot be attributed: no id, value or time, or JSON that does not parse."""
    base = validation_errors(
        orders, ["order_id", "created_at_ist", "total_price_amount"], None, {"total_price_amount": (0, 1e12)}
    )
    journey_bad = ~is_blank("customer_journey") & F.get_json_object("customer_journey", "$").isNull()
    pairs_bad = ~is_blank("custom_attributes", array=True) & F.get_json_object("custom_attributes", "$").isNull()
    return F.concat(
        base,
        F.filter(
            F.array(
                F.when(journey_bad, F.lit("unreadable customer_journey")),
                F.when(pairs_bad, F.lit("unreadable custom_attributes")),
            ),
            lambda r: r.isNotNull(),
        ),
    )


def missing_references(child: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """Child rows whose (non-null) reference is not in the parent."""
    return child.where(F.col(column).isNotNull()).join(parent.select(column), column, "left_anti")


# --- run monitoring ----------------------------------------------------------

def _recent(log: DataFrame, as_of: datetime, hours: int) -> DataFrame:
    return log.where(F.col("execution_start_time") >= _cutoff(as_of, hours))


def _cutoff(as_of: datetime, hours: int) -> Column:
    return F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.lit(hours))


def minutes_between(start: str, end: str) -> Column:
    seconds = lambda c: F.unix_micros(F.col(c).cast("timestamp")) / F.lit(1_000_000)
    return (seconds(end) - seconds(start)) / F.lit(60)


def pipeline_health(log: DataFrame, as_of: datetime, hours: int = 24) -> DataFrame:
    """Per pipeline over the look-back: last good and failed run, success rate, mean minutes, status."""
    ok, failed = F.col("execution_status") == "SUCCESS", F.col("execution_status") == "FAILED"
    end = F.col("execution_end_time")
    runs = F.count(F.lit(1))
    minutes = minutes_between("execution_start_time", "execution_end_time")
    return (
        _recent(log, as_of, hours)
        .groupBy("pipeline_name")
        .agg(
            F.max(F.when(ok, end)).alias("last_successful_run"),
            F.max(F.when(failed, end)).alias("last_failed_run"),
            ratio(F.count_if(ok), runs, 100, 2).alias("success_rate"),
            half_up(F.sum(minutes) / F.count(end), 2).alias("avg_execution_time_minutes"),
            runs.alias("total_runs"),
            F.count_if(ok).alias("successful_runs"),
            F.count_if(failed).alias("failed_runs"),
        )
        .withColumn(
            "health_status",
            F.when(F.col("last_successful_run") > _cutoff(as_of, hours), "HEALTHY")
            .when(F.col("last_failed_run") > _cutoff(as_of, hours), "UNHEALTHY")
            .otherwise("NO_RECENT_RUNS"),
        )
        .orderBy("pipeline_name")
    )


def quality_alerts(log: DataFrame, as_of: datetime, hours: int = 24) -> DataFrame:
    """Successful runs scoring under 95, graded."""
    score = F.col("data_quality_score")
    grade = lambda low, mid, rest: F.when(score < 80, low).when(score < 90, mid).otherwise(rest)
    return (
        _recent(log, as_of, hours)
        .where((F.col("execution_status") == "SUCCESS") & (score < 95))
        .select(
            "batch_id", "pipeline_name", F.col("execution_start_time").alias("execution_time"),
            "data_quality_score", F.col("total_orders_processed").alias("total_records"),
            grade("CRITICAL", "WARNING", "INFO").alias("alert_level"),
            grade(
                "Data quality score is critically low",
                "Data quality score is below recommended threshold",
                "Data quality is within acceptable range",
            ).alias("alert_message"),
        )
        .orderBy("data_quality_score", F.col("execution_time").desc())
    )


def run_summary(log: DataFrame, batch_id: str | None = None) -> DataFrame:
    rows = log.where(F.col("batch_id") == batch_id) if batch_id else log
    return rows.select(
        "pipeline_name", "batch_id", "execution_status", "execution_start_time", "execution_end_time",
        half_up(minutes_between("execution_start_time", "execution_end_time"), 2).alias("execution_duration_minutes"),
        "total_orders_processed", "total_ads_processed", "attributed_orders_count", "unattributed_orders_count",
        "total_spend_processed", "total_sales_processed", "data_quality_score", "error_message",
    )


def monitoring(log: DataFrame) -> DataFrame:
    status = F.col("execution_status")
    icon = F.when(status == "SUCCESS", "✅").when(status == "FAILED", "❌").when(status == "RUNNING", "🔄").otherwise("❓")
    return log.select(
        "pipeline_name", "batch_id", "execution_start_time", "execution_end_time", "execution_status",
        "total_orders_processed", "total_ads_processed", "data_quality_score", "error_message",
        icon.alias("status_icon"),
    ).orderBy(F.col("execution_start_time").desc())


def run_alerts(log: DataFrame, drop_percent: float = 20, max_hours: float = 2, min_score: float = 90) -> DataFrame:
    """One row per alert: failed run, low score, long run, order count fallen against the run before."""
    # A pipeline's runs are its schedule's ticks: the history window stays small.
    runs = Window.partitionBy("pipeline_name").orderBy("execution_start_time", "pipeline_run_id")
    before = F.lag("total_orders_processed").over(runs)
    minutes = minutes_between("execution_start_time", "execution_end_time")
    rules = F.array(
        F.when(F.col("execution_status") == "FAILED", F.lit("pipeline failure")),
        F.when(F.col("data_quality_score") < min_score, F.lit("data quality")),
        F.when(minutes > max_hours * 60, F.lit("performance")),
        F.when(F.col("total_orders_processed") < F.col("previous_orders") * F.lit(1 - drop_percent / 100), F.lit("data volume")),
    )
    return (
        log.withColumn("previous_orders", before)
        .withColumn("alert", F.explode(F.filter(rules, lambda r: r.isNotNull())))
        .select(
            "alert", "pipeline_name", "pipeline_run_id", "execution_start_time", "execution_status",
            "data_quality_score", "total_orders_processed", "previous_orders",
        )
    )


def run_states(events: DataFrame) -> DataFrame:
    """Latest state of each run from its start and end events.

    Runs are never updated in place: a run appends an event when it starts and
    one when it ends. The newest event gives state and metrics.
    """
    payload = [c for c in events.columns if c not in ("pipeline_run_id", "event_time")]
    return (
        events.groupBy("pipeline_run_id")
        .agg(
            F.min("event_time").alias("execution_start_time"),
            F.max(F.struct("event_time", *payload)).alias("_last"),
        )
        .select("pipeline_run_id", "execution_start_time", F.col("_last.event_time").alias("_time"), *[f"_last.{c}" for c in payload])
        .withColumn("execution_end_time", F.when(F.col("execution_status") != "RUNNING", F.col("_time")))
        .withColumn("duration_minutes", half_up(minutes_between("execution_start_time", "execution_end_time"), 2))
        .withColumn("unattributed_orders_count", F.col("total_orders_processed") - F.col("attributed_orders_count"))
        .drop("_time")
    )


def attributes_length(column: str) -> Column:
    return F.length(F.coalesce(F.col(column), F.lit("")))


def shown_json(column: str, array: bool = False) -> Column:
    """'No data' for blanks, else the text cut to 500 characters."""
    text = F.col(column)
    cut = F.when(F.length(text) > 500, F.concat(F.substring(text, 1, 500), F.lit("..."))).otherwise(text)
    return F.when(is_blank(column, array), "No data").otherwise(cut)


def audit_sample(orders: DataFrame, size: int = 50) -> DataFrame:
    """Every k-th order, newest day first, at most ``size`` rows, with raw JSON and flags.

    Inside a day orders stand by a hash of their id. Row numbers come from
    counts per (day, hash prefix); only the cells that hold a wanted place are
    numbered, by id alone, and only the orders picked are fetched whole.
    """
    keyed = orders.select("order_id", "order_date", F.md5("order_id").alias("_hash")).withColumn("_cell", F.substring("_hash", 1, 4))
    cells = keyed.groupBy("order_date", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    days = cells.groupBy("order_date").agg(F.sum("_n").alias("_day"))
    # One row per day here, and no more than 65536 cells a day below.
    earlier = Window.orderBy(F.col("order_date").desc()).rowsBetween(Window.unboundedPreceding, -1)
    days = days.select("order_date", F.coalesce(F.sum("_day").over(earlier), F.lit(0)).alias("_before"), F.sum("_day").over(Window.partitionBy()).alias("_total"))
    inside_day = Window.partitionBy("order_date").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    placed = cells.withColumn("_offset", F.coalesce(F.sum("_n").over(inside_day), F.lit(0))).join(days, "order_date")
    step = F.greatest(F.lit(1), F.floor(F.col("_total") / F.least(F.lit(size), F.col("_total"))))
    first = F.col("_before") + F.col("_offset")
    wanted = F.ceil(first / F.col("_step")) * F.col("_step")
    hit = placed.withColumn("_step", step).withColumn("_first", first).where(
        (wanted < F.col("_first") + F.col("_n")) & (F.floor(F.col("_first") / F.col("_step")) < size)
    )
    inside = Window.partitionBy("order_date", "_cell").orderBy("_hash", "order_id")
    numbered = keyed.join(hit.select("order_date", "_cell", "_first", "_step"), ["order_date", "_cell"]).withColumn(
        "_position", F.col("_first") + F.row_number().over(inside) - 1
    )
    chosen = numbered.where((F.col("_position") % F.col("_step") == 0) & (F.floor(F.col("_position") / F.col("_step")) < size))
    picked = orders.join(chosen.select("order_id", "order_date"), ["order_id", "order_date"], "left_semi")
    return picked.select(
        "order_id", "order_name", "order_date", F.col("total_price_amount").alias("order_value"),
        shown_json("customer_journey").alias("customer_journey_raw"),
        shown_json("custom_attributes", True).alias("custom_attributes_raw"),
        *[f"customer_utm_{f}" for f in ("source", "medium", "campaign", "content", "term")],
        "customer_referrer_url",
        (~is_blank("customer_journey")).alias("has_customer_journey"),
        (~is_blank("custom_attributes", True)).alias("has_custom_attributes"),
        attributes_length("customer_journey").alias("journey_length"),
        attributes_length("custom_attributes").alias("attributes_length"),
    )
