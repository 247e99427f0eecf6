from pyspark.sql import functions as F

from lake_rows import ts
from marquee.operators.cdc import drop_tombstones, latest_by_key


def test_the_newest_version_of_each_key_wins(spark):
    df = spark.createDataFrame(
        [("k1", 3, ts("2025-04-02T09:00:00")), ("k2", 8, ts("2025-04-01T07:00:00")), ("k1", 1, ts("2025-04-02T09:00:01")),
         ("k1", 9, ts("2025-03-31T00:00:00")), ("k3", None, ts("2025-04-05T00:00:00"))],
        "k string, v int, updated_at timestamp_ntz",
    )
    assert sorted((r.k, r.v) for r in latest_by_key(df, ["k"], ["updated_at"]).collect()) == [("k1", 1), ("k2", 8), ("k3", None)]


def test_ties_are_broken_by_later_order_columns(spark):
    df = spark.createDataFrame(
        [(1, "A", ts("2026-01-01T00:00:00")), (1, "B", ts("2026-01-01T00:00:00"))],
        "k long, v string, updated_at timestamp_ntz",
    )
    for _ in range(3):
        out = latest_by_key(df.repartition(4), ["k"], ["updated_at", "v"]).collect()
        assert [r.v for r in out] == ["B"]


def test_null_order_values_sort_last(spark):
    df = spark.createDataFrame([(1, "old", ts("2026-01-01T00:00:00")), (1, "none", None)],
                               "k long, v string, updated_at timestamp_ntz")
    assert [r.v for r in latest_by_key(df, ["k"], ["updated_at"]).collect()] == ["old"]


def test_null_keys_bypass_drop_or_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3), (1, 4)], "k long, v int")
    assert latest_by_key(df, ["k"], ["v"], null_keys="bypass").count() == 3
    assert latest_by_key(df, ["k"], ["v"], null_keys="drop").count() == 1
    assert latest_by_key(df, ["k"], ["v"], null_keys="group").count() == 2


def test_composite_key(spark):
    df = spark.createDataFrame([(1, "A1", 1), (1, "A1", 2), (1, "A2", 1), (2, "A1", 1)], "s long, seat string, v int")
    out = latest_by_key(df, ["s", "seat"], ["v"]).orderBy("s", "seat").collect()
    assert [(r.s, r.seat, r.v) for r in out] == [(1, "A1", 2), (1, "A2", 1), (2, "A1", 1)]


def test_drop_tombstones_treats_null_as_live(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "k long, is_deleted boolean")
    assert sorted(r.k for r in drop_tombstones(df).collect()) == [2, 3]


def test_dedup_plan_reduces_before_the_shuffle(spark, capsys):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    latest_by_key(df, ["k"], ["v"]).explain()
    plan = capsys.readouterr().out
    assert "partial_max" in plan  # one row per key and map task crosses the exchange
    latest_by_key(df, ["k"], ["v"], method="window").explain()
    plan = capsys.readouterr().out
    assert plan.count("WindowGroupLimit") == 2  # partial before, final after the exchange


def test_window_and_aggregate_methods_agree(spark):
    df = spark.createDataFrame(
        [(1, None, "a"), (1, 2, "b"), (1, 2, "c"), (2, None, "x"), (2, None, "y"), (None, 5, "n")],
        "k long, t int, v string",
    )
    for null_keys in ("bypass", "drop", "group"):
        a = latest_by_key(df, ["k"], ["t"], null_keys=null_keys, method="aggregate")
        w = latest_by_key(df, ["k"], ["t"], null_keys=null_keys, method="window")
        assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, w.collect()), key=str)


def test_unorderable_columns_fall_back_to_the_window(spark):
    df = spark.createDataFrame([(1, 1, {"a": 1}), (1, 2, {"b": 2})], "k long, t int, m map<string,int>")
    assert [r.m for r in latest_by_key(df, ["k"], ["t"]).collect()] == [{"b": 2}]
