"""Tables beyond the three layers: facts as of event time, activity, calendar,
regional and drift reports, tokenised personal data.

Builders take DataFrames; the registered queries at the end wire them to the
test tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

from marquee.functions.money import MONEY
from marquee.functions.tokens import Salt, rotated, rotation, tokenized
from marquee.operators import activity, scd2
from marquee.operators.asof import asof_join
from marquee.plans.catalog import DIM_AS_OF, Tables
from marquee.plans.marts import CANCELLED, money
from marquee.session import run_folder
from marquee.sources.landing import JSON_OPTIONS, write_json

Query = Callable[[SparkSession, str], DataFrame]

# --- facts as of event time -------------------------------------------------------

# fixed values: what an as-of fact carries of each dimension's version
ASOF_SHOW = {"movie_id": "movie_id", "venue_id": "venue_id", "screen_no": "screen_no", "base_price": "base_price",
             "show_version_start": "effective_start"}
ASOF_VENUE = {"venue_name": "venue_name", "capacity": "capacity", "venue_version_start": "effective_start"}


def fact_bookings_asof(bookings: DataFrame, shows: DataFrame, venues: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Bookings with the show and the venue as they were when the booking was
    made. A booking from before a show's first version has no context.
    ``hot``: show ids that a join has to take out (``skew.hot_keys``)."""
    with_show = asof_join(bookings, shows, "show_id", "booking_time", ASOF_SHOW, hot=hot)
    with_venue = asof_join(with_show, venues, "venue_id", "booking_time", ASOF_VENUE)
    return with_venue.withColumns({
        "list_amount": F.expr(f"CAST(CAST(base_price AS {MONEY}) * num_seats AS DOUBLE)"),
        "revenue": F.expr("CASE booking_status WHEN 'CONFIRMED' THEN total_amount ELSE 0D END"),
    })


# --- regional rollup --------------------------------------------------------------

LEVELS = ("venue", "city", "state", "all")


def regional_revenue(fact_bookings: DataFrame, dim_venue: DataFrame) -> DataFrame:
    """Bookings and revenue per venue, city, state and in all.

    The facts are added up per venue first, once; the four levels come from
    those few rows. ``level`` is the grouping's own, so the subtotal of a level
    and the row of bookings whose venue is unknown are told apart.
    """
    per_venue = fact_bookings.groupBy("venue_id").agg(
        F.expr("count(1)").alias("n"), F.expr(CANCELLED).alias("c"), F.expr(f"sum(CAST(revenue AS {MONEY}))").alias("r")
    )
    places = scd2.current(dim_venue).select("venue_id", "city", "state")
    placed = per_venue.join(places, "venue_id", "left")
    rolled = placed.rollup("state", "city", "venue_id").agg(
        F.grouping_id().alias("_g"), F.sum("n").alias("total_bookings"), F.sum("c").alias("cancelled_count"),
        F.sum("r").cast("double").alias("total_revenue"),
    )
    # one bit per column that is summed over: 0, 1, 3, 7
    level = F.element_at(F.array(*map(F.lit, LEVELS)), (F.log2(F.col("_g") + 1) + 1).cast("int"))
    rate = F.expr("round(cancelled_count / total_bookings, 4)")
    return rolled.select(level.alias("level"), "state", "city", "venue_id", "total_bookings", "cancelled_count",
                         rate.alias("cancellation_rate"), "total_revenue")


# --- calendar ---------------------------------------------------------------------


def date_dimension(first: Column, last: Column, spark: SparkSession, bounds: DataFrame | None = None) -> DataFrame:
    """One row per day from ``first`` to ``last``, which are expressions over
    the single row of ``bounds`` (or literals)."""
    one = bounds if bounds is not None else spark.range(1)
    days = one.select(F.explode(F.sequence(first.cast("date"), last.cast("date"))).alias("date"))
    return days.selectExpr(
        "date", "CAST(date_format(date, 'yyyyMMdd') AS INT) AS date_key", "year(date) AS year", "quarter(date) AS quarter",
        "month(date) AS month", "day(date) AS day", "weekday(date) + 1 AS iso_weekday", "weekofyear(date) AS iso_week",
        "weekday(date) >= 5 AS is_weekend", "last_day(date) = date AS is_month_end",
    )


def calendar_of(facts: DataFrame, day: str) -> DataFrame:
    """The days from the first to the last in column ``day``, none left out. An
    empty table has no days."""
    bounds = facts.agg(F.min(day).alias("a"), F.max(day).alias("b")).where("a IS NOT NULL")
    return date_dimension(F.col("a"), F.col("b"), facts.sparkSession, bounds)


def daily_revenue_calendar(fact_bookings: DataFrame) -> DataFrame:
    """Revenue and bookings of every day, days without bookings included, with
    the sum of the seven days up to it."""
    daily = fact_bookings.groupBy(F.col("booking_date").alias("date")).agg(
        F.expr("count(1)").alias("n"), F.expr(f"sum(CAST(revenue AS {MONEY}))").alias("r")
    )
    filled = calendar_of(fact_bookings, "booking_date").select("date", "iso_weekday").join(daily, "date", "left").fillna(0, ["n"])
    # one row per day of the calendar: a window over all of them is small
    week = Window.orderBy("date").rowsBetween(-6, 0)
    filled = filled.withColumn("r", F.coalesce("r", F.lit(0).cast(MONEY)))
    return filled.select("date", "iso_weekday", F.col("n").alias("total_bookings"), F.col("r").cast("double").alias("total_revenue"),
                         F.sum("r").over(week).cast("double").alias("revenue_7_days"))


# --- drift ------------------------------------------------------------------------

#: (table, value, its bin as SQL, time). Bins are fixed, so counts of parts of a
#: period can be added up
DRIFT = (
    ("bronze_bookings", "total_amount", "floor(total_amount / 10000)", "booking_time"),
    ("bronze_payments", "amount", "floor(amount / 10000)", "payment_time"),
    ("bronze_promotion_redemptions", "discount_amount", "floor(discount_amount / 2500)", "redeemed_at"),
)


def histogram(df: DataFrame, table: str, value: str, bin_sql: str, at: str, period: str = "MONTH") -> DataFrame:
    """Rows per period and bin; NULL values are a bin of their own."""
    return df.where(F.col(at).isNotNull()).groupBy(
        F.lit(table).alias("table_name"), F.lit(value).alias("column_name"),
        F.expr(f"CAST(date_trunc('{period}', {at}) AS DATE)").alias("period"), F.expr(f"CAST({bin_sql} AS BIGINT)").alias("bin"),
    ).agg(F.count(F.lit(1)).alias("n"), F.sum(F.expr(f"CAST({value} AS {MONEY})")).alias("s"))


def drift_report(histograms: Sequence[DataFrame], limit: float = 0.2) -> DataFrame:
    """Per table, column and period: rows, share of NULLs, mean, the change of
    the mean, and the population stability index against the period before
    (with half a row added to every bin); ``drifted`` if it exceeds ``limit``.

    Everything after the histograms works on one row per period and bin.
    """
    bins = histograms[0]
    for more in histograms[1:]:
        bins = bins.unionByName(more)
    of = ["table_name", "column_name"]
    periods = bins.groupBy(*of, "period").agg(
        F.sum("n").alias("n_rows"), F.sum(F.when(F.col("bin").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
        F.sum("s").cast("double").alias("s"),
    )
    in_time = Window.partitionBy(*of).orderBy("period")
    periods = periods.withColumns({
        "mean": F.expr("CASE WHEN n_rows > n_null THEN s / (n_rows - n_null) END"),
        "before": F.lag("period").over(in_time),
        "rows_before": F.lag("n_rows").over(in_time),
    }).withColumn("mean_before", F.lag("mean").over(in_time))
    # each bin of a period beside the same bin of the period before; a bin that only one has counts 0 in the other
    here = periods.select(*of, "period", "before", "n_rows", "rows_before")
    now = here.join(bins, [*of, "period"]).select(*of, "period", "n_rows", "rows_before", "bin", "n", F.lit(0).alias("m"))
    then = here.join(bins.withColumnRenamed("period", "before"), [*of, "before"]).select(
        *of, "period", "n_rows", "rows_before", "bin", F.lit(0).alias("n"), F.col("n").alias("m")
    )
    paired = now.unionByName(then).groupBy(*of, "period", "n_rows", "rows_before", "bin").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    every = Window.partitionBy(*of, "period")
    shares = paired.withColumn("k", F.count(F.lit(1)).over(every)).selectExpr(
        *of, "period", "(n + 0.5D) / (n_rows + 0.5D * k) AS p", "(m + 0.5D) / (rows_before + 0.5D * k) AS q"
    )
    index = shares.groupBy(*of, "period").agg(F.round(F.sum(F.expr("(p - q) * ln(p / q)")), 6).alias("psi"))
    return periods.join(index, [*of, "period"], "left").selectExpr(
        *of, "period", "n_rows", "n_null / n_rows AS null_share", "mean AS mean_value", "mean - mean_before AS mean_change",
        "psi", f"coalesce(psi > {limit}D, false) AS drifted",
    )


# --- streams of activity ----------------------------------------------------------

EVENTS = StructType([
    StructField("event_id", LongType()), StructField("ts", TimestampNTZType()), StructField("user_id", LongType()),
    StructField("event_type", StringType()), StructField("value", DoubleType()), StructField("props", StringType()),
])
#: no user's id: the event that ends a stream, so that what is open gets closed
END = -1


def run_stream(
    spark: SparkSession, landing: str, out: str, checkpoint: str, shape: Callable[[DataFrame], DataFrame]
) -> None:
    """One triggered run: what has landed since the last one goes through
    ``shape`` and is appended to ``out``."""
    stream = spark.readStream.options(**JSON_OPTIONS).schema(EVENTS).json(f"{landing}/*")
    query = (
        shape(stream).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    )
    query.awaitTermination()


def end_of(events: DataFrame, after: str) -> DataFrame:
    """An event ``after`` the latest one, of nobody."""
    last = events.agg(F.max("ts").alias("ts")).where("ts IS NOT NULL")
    fields = {"event_id": "0", "ts": f"ts + INTERVAL {after}", "user_id": str(END), "event_type": "'end'", "value": "0", "props": "'{}'"}
    return last.selectExpr(*[f"CAST({fields[f.name]} AS {f.dataType.simpleString()}) AS {f.name}" for f in EVENTS.fields])


def in_deliveries(
    spark: SparkSession, events: DataFrame, purpose: str, shape: Callable[[DataFrame], DataFrame], split: Sequence[str], closing: str
) -> DataFrame:
    """The events land in several deliveries, cut at the times of ``split``; a
    run picks up each, and a last one the event that ends the stream."""
    root = run_folder(spark, purpose)
    cuts = [None, *split, None]
    parts = []
    for low, high in zip(cuts[:-1], cuts[1:]):
        part = events
        if low:
            part = part.where(F.col("ts") >= F.lit(low).cast("timestamp_ntz"))
        if high:
            part = part.where(F.col("ts") < F.lit(high).cast("timestamp_ntz"))
        parts.append(part)
    for i, part in enumerate([*parts, end_of(events, closing)]):
        write_json(part.select(*EVENTS.names), f"{root}/landing/{i:04d}")
        run_stream(spark, f"{root}/landing", f"{root}/out", f"{root}/checkpoint", shape)
    return spark.read.parquet(f"{root}/out")


# --- registered queries -----------------------------------------------------------

SPLIT = ("2024-01-11 12:00:00", "2024-01-21 06:30:00")
LATE_BY = "1 hour"
VELOCITY = {"window_seconds": 12 * 3600, "slide_seconds": 3600, "least": 4}
SALT, NEXT_SALT = Salt("v1", "salt of the test tables"), Salt("v2", "the salt that follows")
USER_TOKENS = {"user_id": "user_token", "email": "email_token", "phone": "phone_token"}


def ext_fact_bookings_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return fact_bookings_asof(t.silver_bookings, t.timeline("dim_show"), t.timeline("dim_venue"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def ext_clickstream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.sessions(_events(spark, sf_dir))


def stream_clickstream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_deliveries(spark, _events(spark, sf_dir), "stream-sessions",
                         lambda s: activity.stream_sessions(s, LATE_BY), SPLIT, "2 HOURS")


def ext_velocity_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.velocity(_events(spark, sf_dir), "user_id", "ts", "event_type", **VELOCITY)


def stream_velocity_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_deliveries(spark, _events(spark, sf_dir), "stream-velocity",
                         lambda s: activity.stream_velocity(s, LATE_BY, "user_id", "ts", **VELOCITY), SPLIT, "14 HOURS")


def ext_regional_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return regional_revenue(t.fact_bookings, t.dim_venue)


def ext_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar_of(Tables(spark, sf_dir).fact_bookings, "booking_date")


def ext_daily_revenue_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_revenue_calendar(Tables(spark, sf_dir).fact_bookings)


def ext_dim_movie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.bootstrap(Tables(spark, sf_dir).silver_movies, DIM_AS_OF)


def ext_dim_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.bootstrap(Tables(spark, sf_dir).silver_promotions, DIM_AS_OF)


def ext_drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    parts = [histogram(t.bronze(table.removeprefix("bronze_")), table, value, bins, at) for table, value, bins, at in DRIFT]
    return drift_report(parts)


def ext_tokenized_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenized(Tables(spark, sf_dir).dim_user, USER_TOKENS, SALT, drop=["name", "_ingested_at"])


def ext_tokenized_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend per city, joined on tokens alone after the salt was changed."""
    t = Tables(spark, sf_dir)
    users = tokenized(t.dim_user, USER_TOKENS, NEXT_SALT, drop=["name"])
    spent = tokenized(t.fact_bookings.select("user_id", "revenue"), {"user_id": "user_token"}, SALT)
    fresh = rotated(spent, "user_token", rotation(t.fact_bookings.select("user_id"), "user_id", SALT, NEXT_SALT))
    joined = fresh.join(scd2.current(users).select("user_token", "city"), "user_token", "left")
    return joined.groupBy("city").agg(F.expr("count(1)").alias("total_bookings"), F.expr(money("revenue")).alias("total_revenue"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    ext_fact_bookings_asof, ext_clickstream_sessions, stream_clickstream_sessions, ext_velocity_flags, stream_velocity_flags,
    ext_regional_revenue, ext_dim_date, ext_daily_revenue_calendar, ext_dim_movie, ext_dim_promotion, ext_drift_report,
    ext_tokenized_users, ext_tokenized_spend,
)}
