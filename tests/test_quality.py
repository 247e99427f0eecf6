from marquee.operators.quality import Rule, expectation_metrics, expect, gate
from marquee.plans.silver import BOOKING_RULES


def _bookings(spark, data):
    return spark.createDataFrame(
        data, "booking_id long, user_id long, show_id long, num_seats int, total_amount double, booking_status string"
    )


def test_each_rule_of_the_bookings_gate_fails_on_its_own(spark):
    good = dict(booking_id=810, user_id=44, show_id=7, num_seats=6, total_amount=0.0, booking_status="PENDING")
    broken = {
        "booking_id_present": dict(booking_id=None),
        "user_id_present": dict(user_id=None),
        "show_id_present": dict(show_id=None),
        "num_seats_positive": dict(num_seats=-2),
        "total_amount_non_negative": dict(total_amount=-0.01),
        "booking_status_known": dict(booking_status="confirmed"),
    }
    rows = [tuple({**good, **change}.values()) for change in ({}, *broken.values())]
    valid, quarantined = gate(_bookings(spark, rows), BOOKING_RULES)
    assert [tuple(r) for r in valid.collect()] == rows[:1]
    assert sorted(r._dq_failures for r in quarantined.collect()) == sorted(broken)


def test_null_status_is_quarantined_not_lost(spark):
    df = _bookings(spark, [(1, 1, 1, 2, 300.0, None), (2, 1, 1, 2, 300.0, "PENDING")])
    valid, quarantined = gate(df, BOOKING_RULES)
    assert valid.count() + quarantined.count() == 2
    assert quarantined.collect()[0]._dq_failures == "booking_status_known"
    # the plain filter / not-filter split loses the NULL-status row
    valid, quarantined = gate(df, BOOKING_RULES, null_safe=False)
    assert valid.count() + quarantined.count() == 1


def test_several_failures_are_listed_in_rule_order(spark):
    df = _bookings(spark, [(None, None, 1, None, None, "X")])
    _, quarantined = gate(df, BOOKING_RULES)
    assert quarantined.collect()[0]._dq_failures == (
        "booking_id_present,user_id_present,num_seats_positive,total_amount_non_negative,booking_status_known"
    )


def test_expectations_drop_and_metrics(spark):
    df = spark.createDataFrame([(1, 5.0), (None, 1.0), (2, -1.0), (3, None)], "booking_id long, total_amount double")
    exps = {"valid_booking_id": "booking_id IS NOT NULL", "valid_amount": "total_amount >= 0"}
    assert [r.booking_id for r in expect(df, exps).collect()] == [1]
    assert expect(df, exps, action="warn").count() == 4
    m = {r.expectation: (r.passed_records, r.failed_records) for r in expectation_metrics(df, "t", exps).collect()}
    assert m == {"valid_booking_id": (3, 1), "valid_amount": (2, 2)}


def test_rule_from_sql_text(spark):
    df = spark.createDataFrame([(1,), (None,)], "k long")
    valid, quarantined = gate(df, [Rule("k_present", "k IS NOT NULL")])
    assert valid.count() == 1 and quarantined.count() == 1
