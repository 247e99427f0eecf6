from pyspark.sql import functions as F

from lake_rows import rows, ts
from marquee.plans import silver


def test_a_booking_is_its_newest_live_version(spark):
    def version(key, day, status, deleted):
        return dict(booking_id=key, user_id=61, show_id=17, num_seats=5, total_amount=71.5, booking_time=ts("2025-05-02T18:00:00"),
                    booking_status=status, updated_at=ts(f"2025-05-{day:02}T00:00:00"), is_deleted=deleted)

    df = rows(spark, "bookings", [
        version(900, 9, "CANCELLED", None), version(900, 3, "PENDING", False), version(900, 5, "CONFIRMED", True),
        version(901, 4, "CONFIRMED", True), version(901, 3, "CONFIRMED", False), version(902, 3, "PENDING", False),
    ])
    valid, quarantined = silver.clean_bookings(df)
    assert sorted((r.booking_id, r.booking_status) for r in valid.collect()) == [(900, "CANCELLED"), (902, "PENDING")]
    assert quarantined.count() == 0


def test_bad_newest_booking_quarantines_the_key(spark):
    base = dict(booking_id=1, user_id=1, show_id=1, num_seats=2, booking_time=ts("2026-01-01T00:00:00"))
    df = rows(spark, "bookings", [
        dict(base, total_amount=300.0, booking_status="CONFIRMED", updated_at=ts("2026-01-01T00:00:00")),
        dict(base, total_amount=-1.0, booking_status="CONFIRMED", updated_at=ts("2026-01-02T00:00:00")),
    ])
    valid, quarantined = silver.clean_bookings(df)
    assert valid.count() == 0
    assert quarantined.collect()[0].total_amount == -1.0


def test_newer_live_row_revives_a_deleted_booking(spark):
    base = dict(booking_id=1, user_id=1, show_id=1, num_seats=2, total_amount=10.0, booking_status="PENDING",
                booking_time=ts("2026-01-01T00:00:00"))
    df = rows(spark, "bookings", [
        dict(base, updated_at=ts("2026-01-01T00:00:00"), is_deleted=True),
        dict(base, updated_at=ts("2026-01-02T00:00:00"), is_deleted=None),
    ])
    assert silver.clean_bookings(df)[0].count() == 1


def test_padded_status_is_checked_as_landed(spark):
    base = dict(booking_id=1, user_id=1, show_id=1, num_seats=2, total_amount=10.0,
                booking_time=ts("2026-01-01T00:00:00"), updated_at=ts("2026-01-01T00:00:00"))
    df = rows(spark, "bookings", [dict(base, booking_status=" confirmed ")])
    valid, quarantined = silver.clean_bookings(df)
    assert (valid.count(), quarantined.count()) == (0, 1)
    valid, _ = silver.clean_bookings(df, normalize_first=True)
    assert valid.collect()[0].booking_status == "CONFIRMED"


def test_null_booking_id_goes_to_quarantine(spark):
    base = dict(user_id=1, show_id=1, num_seats=2, total_amount=10.0, booking_status="PENDING",
                booking_time=ts("2026-01-01T00:00:00"), updated_at=ts("2026-01-01T00:00:00"))
    df = rows(spark, "bookings", [dict(base, booking_id=None), dict(base, booking_id=None), dict(base, booking_id=5)])
    valid, quarantined = silver.clean_bookings(df)
    assert valid.count() == 1
    assert [r._dq_failures for r in quarantined.collect()] == ["booking_id_present"] * 2


def test_payments_gate_and_normalise(spark):
    t = ts("2025-06-11T06:00:00")
    df = rows(spark, "payments", [
        dict(payment_id=21, booking_id=5, amount=0.0, payment_status="\tpending ".strip("\t"), updated_at=t),
        dict(payment_id=22, booking_id=None, amount=3.5, payment_status="Success ", updated_at=t),
        dict(payment_id=23, booking_id=6, amount=None, payment_status="Success ", updated_at=t),
        dict(payment_id=None, booking_id=6, amount=-8.0, payment_status="Success ", updated_at=t),
    ])
    valid, quarantined = silver.clean_payments(df)
    assert [(r.payment_id, r.payment_status) for r in valid.collect()] == [(21, "PENDING")]
    assert {r.payment_id: r._dq_failures for r in quarantined.collect()} == {
        22: "booking_id_present", 23: "amount_non_negative", None: "payment_id_present,amount_non_negative",
    }


def test_dimension_keeps_the_latest_and_quarantines_rows_without_key(spark):
    df = rows(spark, "users", [
        dict(user_id=33, city="Lyon", updated_at=ts("2025-07-04T10:00:00")),
        dict(user_id=None, city="Brno", updated_at=ts("2025-07-09T10:00:00")),
        dict(user_id=33, city="Gent", updated_at=ts("2025-07-04T10:00:01")),
    ])
    valid, quarantined = silver.clean_dimension(df, "users")
    assert [(r.user_id, r.city) for r in valid.collect()] == [(33, "Gent")]
    assert [(r.city, r._dq_failures) for r in quarantined.collect()] == [("Brno", "user_id_present")]


def test_seat_holds_latest_state_and_quarantine(spark):
    df = rows(spark, "seat_holds", [
        dict(hold_id=1, show_id=1, seat_no="A1", hold_status="HELD", updated_at=ts("2026-01-01T00:00:00")),
        dict(hold_id=2, show_id=1, seat_no="A1", hold_status="BOOKED", updated_at=ts("2026-01-01T00:05:00")),
        dict(hold_id=3, show_id=None, seat_no="A2", hold_status="HELD", updated_at=ts("2026-01-01T00:00:00")),
        dict(hold_id=4, show_id=1, seat_no="A3", hold_status="BOGUS", updated_at=ts("2026-01-01T00:00:00")),
        dict(hold_id=5, show_id=1, seat_no="A4", hold_status=None, updated_at=ts("2026-01-01T00:00:00")),
    ])
    latest, quarantined = silver.clean_seat_holds(df)
    assert [(r.seat_no, r.hold_status) for r in latest.collect()] == [("A1", "BOOKED")]
    assert sorted(r.hold_id for r in quarantined.collect()) == [3, 4, 5]


def test_bad_newest_seat_event_falls_back_to_older_good_one(spark):
    df = rows(spark, "seat_holds", [
        dict(hold_id=1, show_id=1, seat_no="A1", hold_status="HELD", updated_at=ts("2026-01-01T00:00:00")),
        dict(hold_id=2, show_id=1, seat_no="A1", hold_status="???", updated_at=ts("2026-01-02T00:00:00")),
    ])
    latest, _ = silver.clean_seat_holds(df)
    assert [r.hold_status for r in latest.collect()] == ["HELD"]


def test_promotions_gate(spark):
    t = ts("2026-01-01T00:00:00")
    df = rows(spark, "promotions", [
        dict(promotion_id=1, discount_type="PERCENT", discount_value=10.0, status="ACTIVE", updated_at=t),
        dict(promotion_id=2, discount_type="BOGUS", discount_value=10.0, status="ACTIVE", updated_at=t),
        dict(promotion_id=3, discount_type="FLAT", discount_value=0.0, status="ACTIVE", updated_at=t),
        dict(promotion_id=4, discount_type="FLAT", discount_value=5.0, status="WHATEVER", updated_at=t),
    ])
    valid, quarantined = silver.clean_promotions(df)
    assert [r.promotion_id for r in valid.collect()] == [1]
    assert quarantined.count() == 3


def test_redemptions_quarantine_bad_references(spark):
    t = ts("2025-08-20T20:20:20")
    df = rows(spark, "promotion_redemptions", [
        dict(redemption_id=310, promotion_id=None, booking_id=None, discount_amount=0.0, updated_at=t),
        dict(redemption_id=311, promotion_id=9, booking_id=77, discount_amount=-0.5, updated_at=t),
        dict(redemption_id=312, promotion_id=9, booking_id=77, discount_amount=12.25, updated_at=t),
    ])
    valid, quarantined = silver.clean_redemptions(df)
    assert [r.redemption_id for r in valid.collect()] == [312]
    assert {r.redemption_id: r._dq_failures for r in quarantined.collect()} == {
        310: "promotion_id_present,booking_id_present", 311: "discount_amount_non_negative",
    }


def test_one_pass_check_equals_both_sides_of_clean(spark):
    """Every entity, with malformed lines, rows without keys and ties."""
    from marquee.operators.quality import FAILURES
    from marquee.plans.catalog import ENTITIES, INGESTED_AT, Tables
    from marquee.session import run_folder
    from marquee.sources.landing import CORRUPT, bronze, read_json, write_with_cut_lines

    tables = Tables(spark, "/root/testdata/sf0.001")
    root = run_folder(spark, "test-checked")
    for entity in ENTITIES:
        write_with_cut_lines(tables.landed(entity), f"{root}/{entity}", entity)
        lines = bronze(read_json(spark, f"{root}/{entity}", entity), entity, INGESTED_AT)
        valid, quarantined = silver.clean(lines, entity)
        both = silver.checked(lines, entity)
        good = both.where(f"{FAILURES} IS NULL").drop(FAILURES, CORRUPT)
        bad = both.where(f"{FAILURES} IS NOT NULL")
        assert sorted(map(str, good.select(*valid.columns).collect())) == sorted(map(str, valid.collect())), entity
        assert sorted(map(str, bad.select(*quarantined.columns).collect())) == sorted(map(str, quarantined.collect())), entity
        assert bad.where(F.col(FAILURES) == silver.PARSE_FAILURE).count() > 0 or entity == "venues"
