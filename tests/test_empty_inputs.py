from lake_rows import rows
from marquee.operators import scd2
from marquee.plans import facts, marts, silver


def test_empty_inputs_give_empty_outputs(spark):
    bookings = rows(spark, "bookings", [])
    valid, quarantined = silver.clean_bookings(bookings)
    assert valid.count() == 0 and quarantined.count() == 0
    holds, q = silver.clean_seat_holds(rows(spark, "seat_holds", []))
    assert holds.count() == 0 and q.count() == 0
    tables = {"silver_bookings": valid}
    for dim, entity in (("dim_show", "shows"), ("dim_user", "users")):
        tables[dim] = scd2.bootstrap(silver.clean_dimension(rows(spark, entity, []), entity)[0], "2026-01-01 00:00:00")
    tables["fact_bookings"] = facts.build(facts.FACTS["fact_bookings"], tables.__getitem__)
    for mart in ("gold_daily_revenue", "gold_user_booking_summary"):
        assert marts.build(marts.MARTS[mart], tables.__getitem__).count() == 0


def test_scd2_merge_with_empty_snapshot_keeps_everything(spark):
    venues = rows(spark, "venues", [dict(venue_id=1, capacity=100), dict(venue_id=2, capacity=200)])
    dim = scd2.bootstrap(venues, "2026-01-01 00:00:00")
    merged = scd2.merge(dim, rows(spark, "venues", []), "venue_id", ["capacity"], "2026-02-01 00:00:00")
    assert merged.filter("is_current").count() == 2
    closed = scd2.merge(dim, rows(spark, "venues", []), "venue_id", ["capacity"], "2026-02-01 00:00:00",
                        on_missing="close")
    assert closed.filter("is_current").count() == 0 and closed.count() == 2


def test_scale_conf_sizes_partitions_from_the_largest_shuffle():
    from marquee.session import scale_conf

    conf = scale_conf(100 * (1 << 40))  # 100 TiB through the largest shuffle
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert scale_conf(1 << 20)["spark.sql.shuffle.partitions"] == "200"


def test_fact_buckets_stay_below_sparks_limit(spark):
    from marquee.plans.layered import bucket_count
    from marquee.session import scale_conf

    saved = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", scale_conf(100 * (1 << 40))["spark.sql.shuffle.partitions"])
        assert bucket_count(spark) <= 100_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", saved)
