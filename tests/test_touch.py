"""Attribution models against brute force, with a user who holds most rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from adtrail.operators import sessions, timeline, touch

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def data():
    rng = random.Random(5)
    touches, conversions = [], []
    for i in range(120):
        user = 1 if rng.random() < 0.7 else rng.randint(2, 5)
        at = START + timedelta(minutes=rng.randint(0, 60 * 24 * 20))
        touches.append((user, i, at, f"c{i % 3}", f"a{i % 7}"))
    for i in range(60):
        user = 1 if rng.random() < 0.7 else rng.randint(2, 6)
        at = START + timedelta(minutes=rng.randint(0, 60 * 24 * 22))
        conversions.append((user, 1000 + i, at, float(rng.randint(1, 500))))
    # A conversion at the very instant of a touch, and one exactly at the look-back's end.
    conversions.append((touches[0][0], 2000, touches[0][2], 77.0))
    conversions.append((touches[1][0], 2001, touches[1][2] + timedelta(days=7), 55.0))
    return touches, conversions


@pytest.fixture()
def frames(spark, data):
    touches, conversions = data
    t = spark.createDataFrame(touches, "user_id long, touch_id long, touch_time timestamp_ntz, campaign_id string, ad_id string")
    c = spark.createDataFrame(conversions, "user_id long, order_id long, order_time timestamp_ntz, order_value double")
    return t, c.withColumn("order_value", F.col("order_value").cast("decimal(15,2)"))


def alive(touches, conversion, days):
    return [t for t in touches if t[0] == conversion[0] and timedelta(0) <= conversion[2] - t[2] <= timedelta(days=days)]


def expected_credit(data, days, half_life):
    touches, conversions = data
    credit = {t[1]: 0.0 for t in touches}
    for c in conversions:
        near = alive(touches, c, days)
        weight = lambda t: 1.0 if half_life is None else 2.0 ** (-((c[2] - t[2]) / timedelta(days=1)) / half_life)
        whole = sum(weight(t) for t in near)
        for t in near:
            credit[t[1]] += c[3] * weight(t) / whole
    return credit


@pytest.mark.parametrize("half_life", [None, 1 / 24, 1.0, 1.5, 7.0])
def test_shared_credit(frames, data, half_life):
    got = {r.touch_id: r.credited_revenue for r in touch.shared_credit(*frames, days=7, half_life_days=half_life).collect()}
    want = expected_credit(data, 7, half_life)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-6 for k in want)


@pytest.mark.parametrize("half_life", [1 / 24, 1.0, 7.0])
def test_decay_at_any_date(spark, data, half_life):
    moved = timedelta(days=366 * 2 + 310)
    late = tuple([tuple(x + moved if isinstance(x, datetime) else x for x in row) for row in rows] for rows in data)
    t = spark.createDataFrame(late[0], "user_id long, touch_id long, touch_time timestamp_ntz, campaign_id string, ad_id string")
    c = spark.createDataFrame(late[1], "user_id long, order_id long, order_time timestamp_ntz, order_value double")
    got = {r.touch_id: r.credited_revenue for r in touch.shared_credit(t, c, days=7, half_life_days=half_life).collect()}
    want = expected_credit(late, 7, half_life)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_a_look_back_of_too_many_half_lives_is_refused(frames):
    with pytest.raises(ValueError, match="half-lives"):
        touch.time_decay(*frames, days=30, half_life_days=0.01)


def test_rows_without_a_user_stay(spark, data):
    anonymous = lambda rows: [(None if r[0] == 1 else r[0], *r[1:]) for r in rows]
    t = spark.createDataFrame(anonymous(data[0]), "user_id long, touch_id long, touch_time timestamp_ntz, campaign_id string, ad_id string")
    c = spark.createDataFrame(anonymous(data[1]), "user_id long, order_id long, order_time timestamp_ntz, order_value double")
    got = {r.touch_id: r.credited_revenue for r in touch.linear(t, c, days=7).collect()}
    want = expected_credit(data, 7, None)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)


@pytest.mark.parametrize("first", [True, False])
def test_single_touch(frames, data, first):
    touches, conversions = data
    model = touch.first_click if first else touch.last_click
    got = {r.order_id: r.touch_id for r in model(*frames, days=7).collect()}
    want = {}
    for c in conversions:
        near = sorted(alive(touches, c, 7), key=lambda t: (t[2], str(t[1])))
        if near:
            want[c[1]] = near[0 if first else -1][1]
    assert got == want


def test_weights_sum_to_one(frames, data):
    touches, conversions = data
    reached = sum(1 for c in conversions if alive(touches, c, 7))
    for model in touch.MODELS:
        total = touch.credit_by(*frames, by=["campaign_id"], model=model, days=7).agg(F.sum("credited_orders")).first()[0]
        assert total == pytest.approx(reached, abs=1e-6)


def test_windows(frames, data):
    touches, conversions = data
    got = {r.window_days: r.n for r in touch.last_click_windows(*frames, by=["campaign_id"]).groupBy("window_days").agg(F.sum("orders").alias("n")).collect()}
    assert got == {d: sum(1 for c in conversions if alive(touches, c, d)) for d in (1, 7, 28)}


def test_the_cut_does_not_matter(spark):
    rows = [(1, i * 1_000_000 // 3, i, 1 if i % 4 else None) for i in range(400)] + [(2, i * 86_400_000_000, i, 1) for i in range(5)]
    df = spark.createDataFrame(rows, "k long, t long, id long, v long")
    frames = {}
    for name, ranges in (("split", 40), ("whole", 1)):
        laid = timeline.with_segments(df, ["k"], ["t", "id"], ranges)
        assert laid.where("k = 1").select(timeline.SEGMENT).distinct().count() > (20 if name == "split" else 0)
        summed = timeline.running_sums(laid, ["k"], ["t", "id"], {"s": F.col("v")})
        carried = timeline.carry_last(summed, ["k"], ["t", "id"], F.when(F.col("id") % 7 == 0, F.col("id")), "c", descending=True)
        frames[name] = {(r.k, r.id): (r.s, r.c) for r in carried.collect()}
    assert frames["split"] == frames["whole"]
    running, want = 0, {}
    for i in range(400):
        running += 1 if i % 4 else 0
        want[(1, i)] = running
    assert all(frames["whole"][k][0] == v for k, v in want.items())
    assert frames["whole"][(1, 8)][1] == 14 and frames["whole"][(1, 398)][1] == 399


def crowded(spark, n=6000):
    """Touches and orders, a third of them in one hour of nobody; many at the same instant."""
    rng = random.Random(8)
    user = lambda i: None if i % 3 == 0 else rng.randint(1, 400)
    at = lambda u: START + (timedelta(seconds=rng.randint(0, 40) * 90) if u is None else timedelta(minutes=rng.randint(0, 30 * 1440)))
    touches = [(u, i, at(u), f"c{i % 3}", f"a{i % 7}") for i, u in ((i, user(i)) for i in range(n))]
    orders = [(u, n + i, at(u), float(i % 50)) for i, u in ((i, user(i)) for i in range(n // 10))]
    t = spark.createDataFrame(touches, "user_id long, touch_id long, touch_time timestamp_ntz, campaign_id string, ad_id string")
    c = spark.createDataFrame(orders, "user_id long, order_id long, order_time timestamp_ntz, order_value double")
    return touches, orders, t, c


def test_a_crowded_hour_is_cut_by_rows(spark):
    touches, orders, t, c = crowded(spark)
    rows = touch._touch_rows(t, []).unionByName(touch._conversion_rows(c, touch.CONVERSION), allowMissingColumns=True)
    laid = timeline.with_segments(rows, ["user_id"], touch.ORDER, 40)
    nobody = sum(1 for r in touches + orders if r[0] is None)
    sizes = [r["count"] for r in laid.groupBy("user_id", timeline.SEGMENT).count().collect()]
    assert sum(sizes) == len(touches) + len(orders) and max(sizes) < nobody / 10


def test_models_with_a_crowded_hour(spark):
    touches, orders, t, c = crowded(spark, 1500)
    want = expected_credit((touches, orders), 7, None)
    got = {r.touch_id: r.credited_revenue for r in touch.linear(t, c, days=7).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)
    last = {r.order_id: r.touch_id for r in touch.last_click(t, c, days=7).collect()}
    for o in orders:
        near = sorted(alive(touches, o, 7), key=lambda x: (x[2], str(x[1])))
        assert last.get(o[1]) == (near[-1][1] if near else None)


def test_events_are_read_once_for_shared_credit(spark, frames, tmp_path):
    frames[0].write.parquet(f"{tmp_path}/touches")
    frames[1].write.parquet(f"{tmp_path}/orders")
    credit = touch.linear(spark.read.parquet(f"{tmp_path}/touches"), spark.read.parquet(f"{tmp_path}/orders"), days=7)
    assert not [f for f in credit.inputFiles() if str(tmp_path) in f]  # the rows cut into ranges are all it reads again


def test_sessions(spark):
    at = lambda m: START + timedelta(minutes=m)
    rows = [(1, 1, at(0), "view", 0.0), (1, 2, at(20), "purchase", 9.0), (1, 3, at(51), "view", 0.0), (2, 4, at(1430), "view", 0.0), (2, 5, at(1450), "click", 1.0), (None, 6, at(1), "view", 0.0), (None, 7, at(90), "view", 0.0)]
    df = spark.createDataFrame(rows, "user_id long, event_id long, ts timestamp_ntz, event_type string, value double")
    got = sorted((r.user_id or 0, r.events, r.pageviews_count, r.conversions, r.time_on_site_seconds) for r in sessions.sessionize(df).collect())
    assert got == [(0, 1, 1, 0, 0.0), (0, 1, 1, 0, 0.0), (1, 1, 1, 0, 0.0), (1, 2, 1, 1, 1200.0), (2, 2, 1, 0, 1200.0)]
