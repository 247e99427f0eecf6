from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lake_rows import ts
from marquee.functions.tokens import Salt, rotated, rotation, token, tokenized
from marquee.operators import activity, skew
from marquee.operators.asof import asof_join
from marquee.plans import extensions
from marquee.plans.catalog import Tables
from marquee.session import run_folder
from marquee.sources.landing import write_json

SF = "/root/testdata/sf0.001"
T0 = datetime(2024, 1, 1, 23, 0)


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


@pytest.fixture
def conf(spark):
    held = {}

    def use(**values):
        for name, value in values.items():
            key = "spark.sql." + name.replace("__", ".")
            held.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield use
    for key, value in held.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


# --- as-of join -------------------------------------------------------------------

VERSIONS = [
    (1, "a", "2024-01-01T00:00:00", "2024-02-01T00:00:00"), (1, "b", "2024-02-01T00:00:00", "2024-03-01T00:00:00"),
    (1, "c", "2024-03-05T00:00:00", None), (2, "z", "2024-01-01T00:00:00", None), (None, "n", "2024-01-01T00:00:00", None),
]
EVENTS = [
    (10, 1, "2023-12-31T23:59:59", None), (11, 1, "2024-01-01T00:00:00", "a"), (12, 1, "2024-02-01T00:00:00", "b"),
    (13, 1, "2024-03-01T00:00:00", None), (14, 1, "2030-01-01T00:00:00", "c"), (15, 2, "2024-01-05T00:00:00", "z"),
    (16, 3, "2024-01-05T00:00:00", None), (17, None, "2024-01-05T00:00:00", None), (18, 1, None, None), (11, 1, "2024-01-01T00:00:00", "a"),
]


def frames(spark):
    versions = spark.createDataFrame(
        [(k, v, ts(a), ts(b) if b else None) for k, v, a, b in VERSIONS],
        "k long, name string, effective_start timestamp_ntz, effective_end timestamp_ntz")
    events = spark.createDataFrame([(i, k, ts(t) if t else None) for i, k, t, _ in EVENTS], "id long, k long, at timestamp_ntz")
    return events, versions


@pytest.mark.parametrize("hot_rows", [None, 1, 3])
def test_asof_takes_the_version_valid_at_the_time(spark, hot_rows):
    events, versions = frames(spark)
    hot = skew.hot_keys(events, "k", hot_rows) if hot_rows else None
    got = asof_join(events, versions, "k", "at", {"name": "name"}, hot=hot).collect()
    assert sorted(((r.id, r.name) for r in got), key=str) == sorted(((i, n) for i, _, _, n in EVENTS), key=str)


def test_asof_of_overlapping_versions_is_the_latest_start(spark):
    events, versions = frames(spark)
    more = versions.unionByName(versions.where("name = 'z'").selectExpr(
        "k", "'y' name", "effective_start + INTERVAL 1 DAY effective_start", "effective_end"))
    got = {r.id: r.name for r in asof_join(events, more, "k", "at", {"name": "name"}).collect()}
    assert got[15] == "y"


def test_asof_fact_has_no_range_join(spark, conf):
    conf(autoBroadcastJoinThreshold="-1")
    t = Tables(spark, SF)
    fact = extensions.fact_bookings_asof(t.silver_bookings, t.timeline("dim_show"), t.timeline("dim_venue"))
    assert "NestedLoop" not in plan_of(fact) and "Cartesian" not in plan_of(fact)
    bookings = t.silver_bookings.count()
    assert fact.count() == bookings  # no row multiplied


def test_hot_show_is_split_off_the_shuffled_join(spark, conf):
    """A show with a third of the bookings: its rows meet a broadcast, the
    others the shuffled join, and the result is the same."""
    conf(autoBroadcastJoinThreshold="-1")
    t = Tables(spark, SF)
    bookings = t.silver_bookings.withColumn("show_id", F.expr("if(booking_id % 3 = 0, 5L, show_id)"))
    hot = skew.hot_keys(bookings, "show_id", bookings.count() // 4)
    assert [r.show_id for r in hot.collect()] == [5]
    shows, venues = t.timeline("dim_show"), t.timeline("dim_venue")
    split = extensions.fact_bookings_asof(bookings, shows, venues, hot=hot)
    plain = extensions.fact_bookings_asof(bookings, shows, venues)
    assert "BroadcastHashJoin" in plan_of(split) and "BroadcastHashJoin" not in plan_of(plain)
    assert split.exceptAll(plain).count() == 0 and plain.exceptAll(split).count() == 0


def test_keys_that_cannot_be_hot_are_not_shuffled(spark):
    rows = spark.range(50_000).selectExpr("IF(id < 9, -1L, id) AS k")
    tracker, group = spark.sparkContext.statusTracker(), "test-hot-keys"
    spark.sparkContext.setJobGroup(group, group)
    try:
        assert skew.hot_keys(rows, "k", 10) is None
        quiet = len(tracker.getJobIdsForGroup(group))
        assert [r.k for r in skew.hot_keys(rows, "k", 9).collect()] == [-1]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert quiet < len(tracker.getJobIdsForGroup(group)) - quiet
    # keys that share a slot with others are told apart by the exact count
    assert [r.k for r in skew.hot_keys(rows, "k", 9, slots=2).collect()] == [-1]


def test_hot_keys_are_bounded_and_commonest_first(spark):
    rows = spark.createDataFrame([(k,) for k in range(6) for _ in range(k + 1)] + [(None,)] * 50, "k int")
    assert [r.k for r in skew.hot_keys(rows, "k", 3, most=2).collect()] == [5, 4]
    assert skew.hot_keys(rows, "k", 100) is None


# --- sessions and windows ---------------------------------------------------------


def clicks(spark, rows):
    return spark.createDataFrame(
        [(i, at, user, kind, value, "{}") for i, (user, at, kind, value) in enumerate(rows)], extensions.EVENTS)


ACTIVITY = [
    (1, T0, "view", 1.0), (1, T0 + timedelta(minutes=30), "view", 1.5), (1, T0 + timedelta(minutes=60), "purchase", 1.0),
    (1, T0 + timedelta(minutes=90, microseconds=1), "error", 2.0), (2, T0, "view", None), (2, T0, "view", None),
    (None, T0, "view", 9.0), (3, None, "view", 9.0),
]


def test_sessions_join_across_midnight_and_end_after_the_gap(spark):
    got = activity.sessions(clicks(spark, ACTIVITY)).orderBy("user_id", "session_start").collect()
    assert [(r.user_id, r.session_start, r.duration_ms, r.n_events, r.n_purchases, r.n_errors, r.total_value) for r in got] == [
        (1, T0, 3_600_000, 3, 1, 0, 3.5), (1, T0 + timedelta(minutes=90, microseconds=1), 0, 1, 0, 1, 2.0),
        (2, T0, 0, 2, 0, 0, None),
    ]


def test_a_users_days_are_cut_apart_before_the_users_shuffle(spark):
    """What is ordered per user are day sessions, not events."""
    hot = [(7, T0 + timedelta(seconds=20 * i), "view", 1.0) for i in range(10_000)]
    (row,) = activity.sessions(clicks(spark, hot)).collect()
    assert row.n_events == 10_000 and row.session_end == hot[-1][1]
    plan = plan_of(activity.sessions(clicks(spark, hot)))
    assert "_day" in plan


def land(spark, root, n, rows):
    write_json(clicks(spark, rows), f"{root}/landing/{n}")


def run(spark, root, shape):
    extensions.run_stream(spark, f"{root}/landing", f"{root}/out", f"{root}/checkpoint", shape)


def test_late_event_joins_its_session_until_the_watermark_has_passed(spark):
    root = run_folder(spark, "test-late")
    shape = lambda s: activity.stream_sessions(s, "1 hour")
    minutes = lambda m: T0 + timedelta(minutes=m)
    land(spark, root, 1, [(1, minutes(0), "view", 1.0), (1, minutes(50), "view", 1.0)])
    run(spark, root, shape)
    # 25 minutes late: bridges the two sessions; then time moves on
    land(spark, root, 2, [(1, minutes(25), "purchase", 1.0)])
    run(spark, root, shape)
    land(spark, root, 3, [(extensions.END, minutes(200), "end", 0.0)])
    run(spark, root, shape)
    # behind the watermark now: that session has been given out
    land(spark, root, 4, [(1, minutes(51), "view", 1.0), (extensions.END, minutes(500), "end", 0.0)])
    run(spark, root, shape)
    got = [r for r in spark.read.parquet(f"{root}/out").collect() if r.user_id != extensions.END]
    assert [(r.user_id, r.session_start, r.session_end, r.n_events) for r in got] == [(1, minutes(0), minutes(50), 3)]


def test_velocity_counts_every_window_that_covers_an_event(spark):
    rows = [(1, T0 + timedelta(minutes=m), k, 1.0) for m, k in ((0, "a"), (10, "a"), (59, "b"), (61, "c"))] + [(None, T0, "a", 1.0)]
    got = activity.velocity(clicks(spark, rows), "user_id", "ts", "event_type", 7200, 3600, 3).orderBy("window_start").collect()
    assert [(r.window_start, r.window_end, r.n_events, r.n_items) for r in got] == [
        (T0 - timedelta(hours=1), T0 + timedelta(hours=1), 3, 2), (T0, T0 + timedelta(hours=2), 4, 3)]
    with pytest.raises(ValueError):
        activity.velocity(clicks(spark, rows), "user_id", "ts", "event_type", 5000, 3600, 3)


def test_velocity_deals_its_counts_to_as_many_more_tasks_as_windows(spark):
    rows = [(u, T0 + timedelta(minutes=u), "a", 1.0) for u in range(40)]
    df = activity.velocity(clicks(spark, rows), "user_id", "ts", "event_type", 12 * 3600, 3600, 1)
    assert df.count() == 12 * len(rows)
    n = 12 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert f", {n}), REPARTITION_BY_NUM" in df._jdf.queryExecution().executedPlan().toString()


def test_velocity_never_sorts_events(spark):
    df = activity.velocity(spark.read.parquet(f"{SF}/events.parquet"), "user_id", "ts", "event_type", 7200, 3600, 3)
    physical = df._jdf.queryExecution().executedPlan().toString()
    assert "Sort " not in physical and "Window" not in physical.replace("window_", "").replace("precisetimestamp", "")


# --- rollup, calendar, drift ------------------------------------------------------


def bookings_of(spark, rows):
    return spark.createDataFrame(rows, "venue_id long, booking_status string, revenue double, booking_date date")


def test_rollup_tells_subtotals_from_unknown_venues(spark):
    day = T0.date()
    facts = bookings_of(spark, [(1, "CONFIRMED", 10.0, day), (1, "CANCELLED", 0.0, day), (2, "CONFIRMED", 5.0, day), (None, "CONFIRMED", 7.0, day)])
    venues = spark.createDataFrame([(1, "A", "S", True), (2, None, "S", True), (2, "old", "S", False)], "venue_id long, city string, state string, is_current boolean")
    got = {(r.level, r.state, r.city, r.venue_id): (r.total_bookings, r.cancelled_count, r.total_revenue)
           for r in extensions.regional_revenue(facts, venues).collect()}
    assert got == {
        ("venue", "S", "A", 1): (2, 1, 10.0), ("venue", "S", None, 2): (1, 0, 5.0), ("venue", None, None, None): (1, 0, 7.0),
        ("city", "S", "A", None): (2, 1, 10.0), ("city", "S", None, None): (1, 0, 5.0), ("city", None, None, None): (1, 0, 7.0),
        ("state", "S", None, None): (3, 1, 15.0), ("state", None, None, None): (1, 0, 7.0), ("all", None, None, None): (4, 1, 22.0),
    }


def test_calendar_has_each_day_once(spark):
    days = [T0.date() + timedelta(days=d) for d in (0, 0, 9)]
    facts = bookings_of(spark, [(1, "CONFIRMED", 10.0, d) for d in days] + [(1, "CONFIRMED", 1.0, None)])
    got = extensions.daily_revenue_calendar(facts).orderBy("date").collect()
    assert [r.date for r in got] == [days[0] + timedelta(days=d) for d in range(10)]
    assert [r.total_bookings for r in got] == [2, *[0] * 8, 1]
    assert [r.revenue_7_days for r in got] == [20.0] * 7 + [0.0] * 2 + [10.0]
    assert extensions.calendar_of(facts.where("false"), "booking_date").count() == 0


def test_drift_is_seen_when_the_values_move(spark):
    rows = [(T0 + timedelta(days=31 * m), float(v)) for m in range(3) for v in range(100) if m < 2] + [
        (T0 + timedelta(days=62), None if v % 4 == 0 else 500.0 + v) for v in range(100)]
    df = spark.createDataFrame(rows, "at timestamp_ntz, v double")
    got = extensions.drift_report([extensions.histogram(df, "t", "v", "floor(v / 25)", "at")]).orderBy("period").collect()
    assert [r.drifted for r in got] == [False, False, True] and got[0].psi is None and got[1].psi == 0.0
    assert got[2].null_share == 0.25 and got[2].mean_change > 400


# --- tokens -----------------------------------------------------------------------


def test_tokens_stand_for_values_and_hide_them(spark):
    users = spark.createDataFrame([(1, "a@x.y", "555", "n"), (2, None, "555", "m"), (12, "a@x.y", None, "n")], "user_id long, email string, phone string, name string")
    salt, other = Salt("v1", "pepper"), Salt("v2", "salt")
    out = tokenized(users, {"user_id": "user_token", "email": "email_token", "phone": "phone_token"}, salt, drop=["name"])
    assert out.columns == ["user_token", "email_token", "phone_token"]
    rows = out.collect()
    assert rows[0].email_token == rows[2].email_token != rows[0].phone_token and rows[1].email_token is None
    raw = {"a@x.y", "555", "n", "m"}
    assert not any(str(v) in raw or any(x in str(v) for x in ("a@x", "555@")) for r in rows for v in r)
    assert "pepper" not in repr(salt)
    orders = spark.createDataFrame([(1,), (1,), (12,), (99,), (None,)], "user_id long")
    spent = tokenized(orders, {"user_id": "user_token"}, salt)
    raw_join = orders.join(users, "user_id").count()
    assert spent.join(out, "user_token").count() == raw_join == 3
    fresh = rotated(spent, "user_token", rotation(orders, "user_id", salt, other))
    assert fresh.join(tokenized(users, {"user_id": "user_token"}, other), "user_token").count() == raw_join
    assert fresh.where("user_token IS NULL").count() == 1
    with pytest.raises(Exception, match="without a successor"):
        rotated(spent, "user_token", rotation(orders.where("user_id = 1"), "user_id", salt, other)).collect()


def test_salt_and_value_are_kept_apart(spark):
    row = spark.range(1).select(token(F.lit("bc"), Salt("v", "a")).alias("a"), token(F.lit("c"), Salt("v", "ab")).alias("b")).first()
    assert row.a != row.b
