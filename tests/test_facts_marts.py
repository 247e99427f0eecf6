from datetime import date

from lake_rows import ts
from marquee.operators.scd2 import bootstrap
from marquee.plans import facts, marts
from marquee.plans.facts import FACTS
from marquee.plans.marts import MARTS

OPENED = "2025-03-01 00:00:00"


def _shows(spark, *shows):
    rows = [(s, f"film-{s}", v, ts("2025-03-20T21:15:00"), p) for s, v, p in shows]
    return bootstrap(
        spark.createDataFrame(rows, "show_id long, movie_id string, venue_id long, show_time timestamp_ntz, base_price double"),
        OPENED,
    )


def _booking_fact(spark):
    bookings = spark.createDataFrame(
        [(70, 5, 31, 4, 92.4, "CONFIRMED", ts("2025-03-09T23:59:59")),
         (71, 5, 32, 2, 18.0, "PENDING", ts("2025-03-10T00:00:00")),
         (72, 6, 31, 1, 23.1, "CANCELLED", ts("2025-03-09T08:30:00")),
         (73, 6, 99, 3, 40.5, "CONFIRMED", ts("2025-03-10T12:00:00"))],
        "booking_id long, user_id long, show_id long, num_seats int, total_amount double, booking_status string, "
        "booking_time timestamp_ntz",
    )
    tables = {"silver_bookings": bookings, "dim_show": _shows(spark, (31, 8, 23.1), (32, 9, 9.0))}
    return facts.build(FACTS["fact_bookings"], tables.__getitem__)


def test_only_confirmed_bookings_earn_and_unknown_shows_stay(spark):
    got = {r.booking_id: (r.revenue, r.venue_id, r.base_price, r.booking_date) for r in _booking_fact(spark).collect()}
    assert got == {
        70: (92.4, 8, 23.1, date(2025, 3, 9)),
        71: (0.0, 9, 9.0, date(2025, 3, 10)),
        72: (0.0, 8, 23.1, date(2025, 3, 9)),
        73: (40.5, None, None, date(2025, 3, 10)),
    }


def test_closed_versions_lend_nothing(spark):
    shows = _shows(spark, (31, 8, 23.1))
    closed = shows.selectExpr(*[f"{'false' if c == 'is_current' else '4.0D' if c == 'base_price' else c} AS {c}" for c in shows.columns])
    lookup = FACTS["fact_bookings"].lookups[0]
    out = facts.enrich(spark.createDataFrame([(31,)], "show_id long"), shows.unionByName(closed), lookup).collect()
    assert [r.base_price for r in out] == [23.1]


def test_a_day_of_a_venue_and_the_unknown_venue(spark):
    tables = {"fact_bookings": _booking_fact(spark)}
    got = {(r.booking_date.day, r.venue_id): (r.total_bookings, r.cancelled_count, r.total_seats_booked, r.total_revenue)
           for r in marts.build(MARTS["gold_daily_revenue"], tables.__getitem__).collect()}
    assert got == {(9, 8): (2, 1, 5, 92.4), (10, 9): (1, 0, 2, 0.0), (10, None): (1, 0, 3, 40.5)}


def test_payments_take_the_status_their_booking_has_now(spark):
    payments = spark.createDataFrame([(1, 72, 23.1), (2, 70, 92.4), (3, 404, 7.0), (4, None, 7.0)],
                                     "payment_id long, booking_id long, amount double")
    tables = {"silver_payments": payments, "fact_bookings": _booking_fact(spark)}
    got = {r.payment_id: (r.booking_status_at_fact_time, r.movie_id)
           for r in facts.build(FACTS["fact_payments"], tables.__getitem__).collect()}
    assert got == {1: ("CANCELLED", "film-31"), 2: ("CONFIRMED", "film-31"), 3: (None, None), 4: (None, None)}


def test_occupancy_counts_a_seat_once(spark):
    seats = spark.createDataFrame(
        [(31, "row4-12", "BOOKED"), (31, "row4-12", "HELD"), (31, "row4-13", "EXPIRED"), (31, "row5-1", "HELD"),
         (32, "row1-1", "RELEASED"), (31, None, "HELD")],
        "show_id long, seat_no string, hold_status string",
    )
    venues = bootstrap(spark.createDataFrame([(8, 48), (9, 0)], "venue_id long, capacity int"), OPENED)
    tables = {"dim_show": _shows(spark, (31, 8, 1.0), (32, 9, 1.0), (33, 77, 1.0)), "dim_venue": venues,
              "occupied_seats": facts.occupied_seats(seats)}
    got = {r.show_id: (r.occupied_seats, r.occupancy_pct)
           for r in facts.build(FACTS["fact_seat_occupancy"], tables.__getitem__).collect()}
    assert got == {31: (2, 4.17), 32: (0, None), 33: (0, None)}


def test_net_revenue_is_never_negative(spark):
    promos = spark.createDataFrame([(3, "SPRING", "PERCENT")], "promotion_id long, code string, discount_type string")
    redeemed = spark.createDataFrame([(1, 3, 70, 12.4), (2, 3, 73, 41.0), (3, 4, 70, 2.4), (4, 3, 1234, 1.0)],
                                     "redemption_id long, promotion_id long, booking_id long, discount_amount double")
    tables = {"silver_promotion_redemptions": redeemed, "silver_promotions": promos, "fact_bookings": _booking_fact(spark)}
    fact = facts.build(FACTS["fact_promotion_redemptions"], tables.__getitem__)
    got = {r.redemption_id: (r.code, r.gross_revenue, r.net_revenue) for r in fact.collect()}
    assert got == {1: ("SPRING", 92.4, 80.0), 2: ("SPRING", 40.5, 0.0), 3: (None, 92.4, 90.0), 4: ("SPRING", None, 0.0)}
    tables["fact_promotion_redemptions"] = fact
    by_promo = {(r.promotion_id, r.code): (r.total_redemptions, r.total_discount_given, r.total_net_revenue)
                for r in marts.build(MARTS["gold_promotion_performance"], tables.__getitem__).collect()}
    assert by_promo == {(3, "SPRING"): (3, 54.4, 80.0), (4, None): (1, 2.4, 90.0)}


def test_every_current_user_has_a_summary(spark):
    users = bootstrap(spark.createDataFrame([(5, "Oslo"), (6, None), (7, "Turin")], "user_id long, city string")
                      .selectExpr("*", "CAST(NULL AS TIMESTAMP_NTZ) AS signup_date"), OPENED)
    tables = {"fact_bookings": _booking_fact(spark), "dim_user": users}
    got = {r.user_id: (r.total_bookings, r.cancelled_bookings, r.cancellation_rate, r.lifetime_spend, r.avg_seats_per_booking,
                       r.first_booking_date, r.last_booking_date)
           for r in marts.build(MARTS["gold_user_booking_summary"], tables.__getitem__).collect()}
    assert got == {
        5: (2, 0, 0.0, 92.4, 3.0, date(2025, 3, 9), date(2025, 3, 10)),
        6: (2, 1, 0.5, 40.5, 2.0, date(2025, 3, 9), date(2025, 3, 10)),
        7: (0, 0, 0.0, 0.0, None, None, None),
    }


def test_top_k_is_total_ordered(spark):
    df = spark.createDataFrame([(i, float(i % 3)) for i in range(30)], "show_id long, occupancy_pct double")
    out = [r.show_id for r in marts.top_shows_by_occupancy(df).collect()]
    assert out == [2, 5, 8, 11, 14, 17, 20, 23, 26, 29]
