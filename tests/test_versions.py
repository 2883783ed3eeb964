"""Loads by ``updated_at``: broken off, repeated, late, at once and filled in again, they give the batch result."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from adtrail.sources import versions
from adtrail.sources.sinks import latest_per_key

SCHEMA = "id long, day date, value double, updated_at timestamp"
START = datetime(2024, 5, 1, 8)


def row(id, minutes, value, day=None):
    return (id, date(2024, 5, 1 + id % 3) if day is None else day, float(value), None if minutes is None else START + timedelta(minutes=minutes))


def table(spark, path):
    return sorted((r.id, r.value) for r in versions.read_version(spark, path, spark.createDataFrame([], SCHEMA).schema).collect())


def add(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


def test_loads_give_the_batch(spark, tmp_path, monkeypatch):
    source, out = f"{tmp_path}/source", f"{tmp_path}/out"
    load = lambda: versions.load_new(spark.read.schema(SCHEMA).parquet(source), out, ["id"], "day")
    add(spark, source, [row(i, i, i) for i in range(10)] + [row(20, None, 1)])
    assert load() == 1 and len(table(spark, out)) == 11
    # Half an hour late, two hours late, and new: the first and the last are met.
    add(spark, source, [row(3, -20, 33), row(4, 200, 44), row(20, 210, 2)])
    assert load() == 2
    assert dict(table(spark, out)) == {**{i: float(i) for i in range(10)}, 4: 44.0, 20: 2.0}
    add(spark, source, [row(30, 175, 30), row(31, 20, 31), row(5, 300, 55)])
    publish = versions._publish
    with monkeypatch.context() as m:
        m.setattr(versions, "_publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            load()
    assert versions.newest_version(spark, out) == 2 and dict(table(spark, out))[5] == 5.0
    assert load() == 3
    assert {30: 30.0, 5: 55.0}.items() <= dict(table(spark, out)).items() and 31 not in dict(table(spark, out))
    before = table(spark, out)
    load()  # the overlap alone
    assert table(spark, out) == before
    everything = spark.read.schema(SCHEMA).parquet(source)
    versions.backfill(everything, out, ["id"], "day", "2024-05-01 00:00:00", "2024-05-01 09:00:00")
    batch = latest_per_key(everything, ["id"], versions._newest(everything, "updated_at"))
    assert table(spark, out) == sorted((r.id, r.value) for r in batch.collect())
    assert versions._publish is publish


def test_two_writers_at_once_lose_nothing(spark, tmp_path, monkeypatch):
    out, publish, calls = f"{tmp_path}/out", versions._publish, []
    one = spark.createDataFrame([row(1, 1, 1), row(4, 1, 4)], SCHEMA)
    two = spark.createDataFrame([row(1, 2, 100), row(7, 1, 7), (8, None, 8.0, START)], SCHEMA)
    put = lambda rows: versions.put(rows, out, ["id"], "day", F.col("updated_at"))
    put(spark.createDataFrame([row(2, 1, 2)], SCHEMA))

    def overtaken(*names):
        if not calls:  # the other writer publishes between this one's stage and swap
            calls.append(1)
            put(two)
        return publish(*names)

    monkeypatch.setattr(versions, "_publish", overtaken)
    assert put(one) == 3
    assert dict(table(spark, out)) == {1: 100.0, 2: 2.0, 4: 4.0, 7: 7.0, 8: 8.0}


def test_empty_source_and_refused_partition(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert versions.load_new(empty, f"{tmp_path}/out", ["id"], "day") is None
    assert table(spark, f"{tmp_path}/out") == []
    with pytest.raises(ValueError):
        versions.put(empty, f"{tmp_path}/out", ["id"], "value", F.col("updated_at"))


def test_mark_reaches_the_scan(spark, tmp_path):
    source = add(spark, f"{tmp_path}/s", [row(1, 1, 1)])
    versions.load_new(source, f"{tmp_path}/out", ["id"], "day")
    after = versions.mark_of(spark, f"{tmp_path}/out") - F.expr("INTERVAL 1 hour")
    plan = source.where(F.col("updated_at") >= after)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(updated_at,2024-05-01" in plan
