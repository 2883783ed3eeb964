"""Streams over files give what the batch gives."""

import random
from datetime import datetime, timedelta
from uuid import uuid4

from pyspark.sql import functions as F

from adtrail.operators import touch
from adtrail.operators.sessions import sessionize
from adtrail.sources import testbed
from adtrail.streaming import hourly, live


def _files(spark, small, path, parts=3):
    events = testbed.with_ad_keys(testbed.events(spark, small)).withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartitionByRange(parts, "ts").sortWithinPartitions("ts").write.parquet(path)
    return spark.read.parquet(path)


def test_hourly_stream_equals_batch(spark, small, tmp_path):
    batch = _files(spark, small, str(tmp_path / "in"))
    stream = hourly.read_table_stream(spark, batch.schema, str(tmp_path / "in"), files_per_batch=1)
    metrics = hourly.hourly_metrics(hourly.watermarked(stream, late="40 days"))
    out = str(tmp_path / "out")
    name = f"hours-{uuid4()}"  # the checkpoint folder may outlive the test
    for _ in range(2):  # the second run finds nothing new
        query = hourly.incremental(metrics, name, hourly.upsert_hours(out), str(tmp_path / "state"))
        query.awaitTermination(300)
        assert query.exception() is None
    columns = ["date_start", "hour_start", "ad_id", "impressions", "clicks", "spend", "purchases", "revenue"]
    want = hourly.hourly_metrics(batch).select(*columns)
    got = spark.read.parquet(out).select(*columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_session_stream_equals_batch(spark, small, tmp_path):
    batch = _files(spark, small, str(tmp_path / "in"))
    stream = hourly.read_table_stream(spark, batch.schema, str(tmp_path / "in"))
    sessions = hourly.stream_sessions(stream.withWatermark("ts", "1 hour"), 240)
    query = (
        sessions.writeStream.outputMode("append").format("memory").queryName("sessions_out")
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    )
    query.awaitTermination(300)
    got = {(r.user_id, r.session_start_time): r.events for r in spark.table("sessions_out").collect()}
    want = {(r.user_id, r.session_start_time): r.events for r in sessionize(batch, 240).collect()}
    # Sessions still open at the watermark are not emitted; all others agree.
    assert len(got) > 0.9 * len(want)
    assert all(want[k] == n for k, n in got.items())


def test_late_rows_are_counted(spark, small, tmp_path):
    batch = _files(spark, small, str(tmp_path / "all"), 1)
    batch.where("ts >= '2024-01-20'").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = hourly.read_table_stream(spark, batch.schema, str(tmp_path / "in"))
    metrics = hourly.hourly_metrics(hourly.watermarked(stream, late="1 hour", id=None))
    name = f"late-{uuid4()}"
    run = lambda: hourly.incremental(metrics, name, lambda df, i: df.write.format("noop").mode("overwrite").save(), str(tmp_path / "state"))
    first = run()
    first.awaitTermination(300)
    batch.where("ts < '2024-01-10'").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    second = run()
    second.awaitTermination(300)
    assert hourly.late_rows(second) > 0


def test_live_last_click_is_the_batch_model(spark, tmp_path):
    rng = random.Random(4)
    start = datetime(2024, 3, 1)
    touches = [(rng.choice([None, 1, 2, 3]), i, start + timedelta(minutes=rng.randint(0, 3000)), f"c{i % 3}", f"a{i % 5}") for i in range(120)]
    orders = [(rng.choice([None, 1, 2, 3, 4]), 1000 + i, start + timedelta(minutes=rng.randint(0, 3000)), float(i)) for i in range(60)]
    touches.append((1, 500, orders[0][2], "c0", "a1"))
    t_schema = "user_id long, touch_id long, touch_time timestamp, campaign_id string, ad_id string"
    c_schema = "user_id long, order_id long, order_time timestamp, order_value double"
    late = timedelta(minutes=40)
    far = start + timedelta(days=60)

    def feed(rows, schema, name, last):
        # Files in the order of arrival: rows come up to 40 minutes late, and a far row closes the stream.
        arrived = sorted(rows, key=lambda r: r[2] + late * rng.random())
        parts = arrived
        size = -(-len(parts) // 4)
        for i in range(4):
            spark.createDataFrame(parts[i * size : (i + 1) * size], schema).coalesce(1).write.parquet(f"{tmp_path}/{name}/{i}")
        for i in (4, 5):
            spark.createDataFrame([last], schema).coalesce(1).write.parquet(f"{tmp_path}/{name}/{i}")
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/{name}")

    t = feed(touches, t_schema, "touches", (9, 9000, far, "x", "x"))
    c = feed(orders, c_schema, "orders", (9, 9001, far, 0.0))
    names = spark.createDataFrame([(f"a{i}", f"ad {i}") for i in range(4)], "ad_id string, ad_name string")
    out = live.live_named(t, c, names, days=1, late="1 hour")
    query = out.writeStream.format("memory").queryName("live_orders").outputMode("append").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    assert query.awaitTermination(180)
    got = {r.order_id: (r.touch_id, r.ad_name) for r in spark.table("live_orders").collect()}
    batch = live.live_named(spark.createDataFrame(touches, t_schema), spark.createDataFrame(orders, c_schema), names, days=1).collect()
    assert got == {r.order_id: (r.touch_id, r.ad_name) for r in batch} and len(got) == len(orders)
    model = touch.last_click(spark.createDataFrame(touches, t_schema), spark.createDataFrame(orders, c_schema), days=1)
    assert {r.order_id: r.touch_id for r in model.collect()} == {o: t for o, (t, _) in got.items() if t is not None}
