"""Every registered query against its DuckDB oracle on the smallest tables."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from marquee.operators.quality import Rule
from marquee.plans import oracle, oracle_extensions, silver
from marquee.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def oracle_sql():
    return oracle.oracle_sql() | oracle_extensions.oracle_sql()


def _canon(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_canon(r[i]) for i in order) for r in data), key=lambda t: tuple(map(str, t)))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    res = duck.execute(oracle_sql()[name])
    d_names = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(d_names)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(d_names, res.fetchall())


@pytest.mark.parametrize("rules, name, query", [
    ("BOOKING_RULES", "num_seats_positive", "silver_bookings"),
    ("PAYMENT_RULES", "amount_non_negative", "quarantine_payments"),
    ("SEAT_HOLD_RULES", "hold_status_known", "silver_seat_holds"),
    ("PROMOTION_RULES", "status_known", "silver_promotions"),
    ("REDEMPTION_RULES", "discount_amount_non_negative", "silver_promotion_redemptions"),
])
def test_a_wrong_rule_turns_its_query_red(spark, duck, monkeypatch, rules, name, query):
    wrong = [Rule(r.name, "updated_at > TIMESTAMP_NTZ '1994-01-01 00:00:00' AND updated_at IS NULL") if r.name == name else r
             for r in getattr(silver, rules)]
    monkeypatch.setattr(silver, rules, wrong)
    got = QUERIES[query](spark, SF).count()
    assert got != len(duck.execute(oracle_sql()[query]).fetchall())


def test_masked_users_show_no_local_part(spark):
    leaks = QUERIES["dim_user_masked"](spark, SF).where("email LIKE '%user%' OR email LIKE '%name@%'")
    assert leaks.count() == 0
    assert QUERIES["dim_user_unmasked"](spark, SF).where("email LIKE '%\n%'").count() > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert sorted(df.columns) == ["booking_date", "cancelled_count", "total_bookings", "total_revenue",
                                  "total_seats_booked", "venue_id"]
