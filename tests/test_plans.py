"""Plan shapes that matter at scale, read from ``explain``."""

import re

import pytest

from marquee.plans.catalog import Tables

SF = "/root/testdata/sf0.001"


def _plan(df, capsys) -> str:
    df.explain("formatted")
    return capsys.readouterr().out


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SF)


def test_payments_join_reuses_the_booking_partitioning(tables, capsys):
    plan = _plan(tables.fact_payments, capsys)
    # only the payments side is shuffled on booking_id; fact_bookings keeps the
    # hash partitioning its dedup produced
    assert len(re.findall(r"hashpartitioning\(booking_id#\d+L?, \d+\)", plan)) == 2  # dedup + payments side


def test_dedups_limit_before_the_shuffle(tables, capsys):
    plan = _plan(tables.fact_promotion_redemptions, capsys)
    # redemptions, bookings, promotions and shows: a partial max(struct) below each dedup exchange
    assert plan.count("partial_max(struct(") >= 4


def test_occupancy_counts_without_distinct(tables, capsys):
    plan = _plan(tables.fact_seat_occupancy, capsys)
    assert "Expand" not in plan  # a distinct aggregate would multiply the rows first
    assert "partial_bool_or" in plan or "partial_max" in plan


def test_filters_and_columns_reach_the_scan(tables, capsys):
    plan = _plan(tables.silver_payments, capsys)
    read_schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "l_partkey" not in read_schema and "l_tax" not in read_schema


def test_no_python_in_the_plans(tables, capsys):
    for df in (tables.gold_daily_revenue, tables.gold_user_booking_summary, tables.fact_promotion_redemptions):
        plan = _plan(df, capsys)
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_bucketed_fact_spares_the_join_a_shuffle(spark, tables, capsys):
    from marquee.plans import facts
    from marquee.session import run_folder
    from marquee.sources.snapshots import SnapshotStore

    store = SnapshotStore(spark, run_folder(spark, "test-bucketed"), fresh=True)
    staged = {"fact_bookings": store.stage(tables.fact_bookings, "fact_bookings", bucket_by=(8, "booking_id")),
              "silver_payments": store.stage(tables.silver_payments, "silver_payments")}
    store.commit(staged)
    files = spark.read.format("binaryFile").load(store.path("fact_bookings", staged["fact_bookings"])).select("path")
    assert files.where("path LIKE '%.parquet'").count() <= 8  # one per bucket
    store = SnapshotStore(spark, store.root)  # as another process would open it
    fact, pays = store.read("fact_bookings"), store.read("silver_payments")
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")  # as when the fact is too large to broadcast
        both = {"silver_payments": pays, "fact_bookings": fact}
        plan = _plan(facts.build(facts.FACTS["fact_payments"], both.__getitem__), capsys)
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "Bucketed: true" in plan
    assert len(re.findall(r"^\(\d+\) Exchange$", plan, flags=re.M)) == 1  # the payments side only
    assert fact.count() == tables.fact_bookings.count()


@pytest.mark.parametrize("checked", ["checked_bookings", "checked_payments", "checked_seat_holds", "checked_users"])
def test_gated_table_is_one_scan_and_one_shuffle(spark, checked, capsys):
    from marquee.plans.layered import GATED, checked_table
    from marquee.session import run_folder

    entity = GATED[checked][0]
    folder = run_folder(spark, "test-one-scan")
    Tables(spark, SF).bronze(entity).selectExpr("*", "cast(null as string) _corrupt_record").write.parquet(folder)
    both = checked_table(spark.read.parquet(folder), entity)
    assert both.count() > 0
    plan = _plan(both, capsys)
    assert len(re.findall(r"^\(\d+\) Scan parquet", plan, flags=re.M)) == 1
    assert len(re.findall(r"^\(\d+\) Exchange", plan, flags=re.M)) == 1


@pytest.mark.parametrize("fact", ["fact_payments", "fact_promotion_redemptions"])
def test_hot_booking_is_joined_apart(spark, fact, capsys):
    """A booking with a third of the payments: with the broadcast of whole
    tables off, its rows meet a few broadcast rows, and the result is the same."""
    from pyspark.sql import functions as F

    from marquee.plans import facts

    source = Tables(spark, SF)
    base = facts.FACTS[fact].base
    some = source.fact_bookings.orderBy("booking_id").first().booking_id
    frames = {base: source.table(base).withColumn("booking_id", F.expr(f"if(booking_id % 3 = 0, {some}L, booking_id)")),
              "fact_bookings": source.fact_bookings, "silver_promotions": source.silver_promotions}
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        plain = facts.build(facts.FACTS[fact], frames.__getitem__)
        split = facts.build(facts.FACTS[fact], frames.__getitem__, hot_rows=frames[base].count() // 4)
        assert "BroadcastHashJoin" in _plan(split, capsys) and "BroadcastHashJoin" not in _plan(plain, capsys)
        assert split.columns == plain.columns
        assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
