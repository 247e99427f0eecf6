"""Event-time operators on activity: sessions and sliding-window counts.

Both are built so that one user with a third of all events is no single task's
work: what is shuffled by user has been reduced per user and stretch of time.
Events without a user or a time belong to nobody's session and are left out.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.money import MONEY

GAP = "30 minutes"

# name -> aggregate over a session's events; all of them can be added up
SESSION_METRICS = {
    "n_events": "count(1)",
    "n_purchases": "count_if(event_type = 'purchase')",
    "n_errors": "count_if(event_type = 'error')",
    "total_value": f"sum(CAST(value AS {MONEY}))",
}


def _metrics() -> list[Column]:
    return [F.expr(sql).alias(name) for name, sql in SESSION_METRICS.items()]


def _shaped(sessions: DataFrame, user: str) -> DataFrame:
    return sessions.select(
        user, "session_start", "session_end",
        F.expr("CAST(timestampdiff(MILLISECOND, session_start, session_end) AS BIGINT)").alias("duration_ms"),
        "n_events", "n_purchases", "n_errors", F.col("total_value").cast("double").alias("total_value"),
    )


def sessions(events: DataFrame, user: str = "user_id", at: str = "ts", gap: str = GAP) -> DataFrame:
    """Sessions of all users: an event belongs to the session before it unless
    more than ``gap`` lies between them.

    First every user's day is cut into sessions by Spark's session window, then
    those that touch across midnight are joined. A day holds at most a day over
    ``gap`` sessions of a user, so the second step is small whatever the events,
    and the first has a hot user's days in different groups.
    """
    known = events.where(F.col(user).isNotNull() & F.col(at).isNotNull())
    daily = known.groupBy(user, F.to_date(at).alias("_day"), F.session_window(at, gap).alias("_w")).agg(
        F.min(at).alias("session_start"), F.max(at).alias("session_end"), *_metrics()
    )
    in_order = Window.partitionBy(user).orderBy("session_start")
    before = F.lag("session_end").over(in_order)
    opens = before.isNull() | (F.col("session_start") > before + F.expr(f"INTERVAL {gap}"))
    numbered = daily.withColumn("_opens", opens.cast("int")).withColumn("_n", F.sum("_opens").over(in_order))
    joined = numbered.groupBy(user, "_n").agg(
        F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"),
        *[F.sum(name).alias(name) for name in SESSION_METRICS],
    )
    return _shaped(joined, user)


def stream_sessions(
    events: DataFrame, late_by: str, user: str = "user_id", at: str = "ts", gap: str = GAP
) -> DataFrame:
    """The same over a stream: a session is given out once the watermark, which
    stays ``late_by`` behind the latest event, has passed its end. Sessions that
    are still open are the operator's state."""
    known = events.where(F.col(user).isNotNull()).withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", late_by)
    grouped = known.groupBy(user, F.session_window("_at", gap).alias("_w")).agg(
        F.min(at).alias("session_start"), F.max(at).alias("session_end"), *_metrics()
    )
    return _shaped(grouped, user)


def _window_bounds(seconds: int) -> Mapping[str, Column]:
    return {"window_start": F.col("_start").cast("timestamp_ntz"),
            "window_end": F.expr(f"CAST(_start + INTERVAL {seconds} SECONDS AS TIMESTAMP_NTZ)")}


def velocity(
    events: DataFrame,
    user: str,
    at: str,
    item: str,
    window_seconds: int,
    slide_seconds: int,
    least: int,
) -> DataFrame:
    """Windows in which a user did ``least`` things or more: user, window_start,
    window_end, n_events and n_items (different values of ``item``).

    Events are first counted per user, item and slide, map-side and then once;
    only these counts are dealt to the windows that cover the slide. So the
    shuffle by user has a row per slide and item at most, and no user's events
    are ever sorted. A count becomes a row in each of its windows, so counts are
    dealt to so many times more tasks than other shuffles have; left to its own,
    Spark sizes the tasks by the counts and brings small ones together.
    """
    if window_seconds % slide_seconds:
        raise ValueError("the window must be a multiple of the slide")
    known = events.where(F.col(user).isNotNull() & F.col(at).isNotNull())
    slide = F.window(F.col(at).cast("timestamp"), f"{slide_seconds} seconds")["start"].alias("_slide")
    counts = known.groupBy(user, F.col(item).alias("_item"), slide).agg(F.count(F.lit(1)).alias("_n"))
    tasks = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions")) * (window_seconds // slide_seconds)
    counts = counts.repartition(tasks, user, "_item")
    first = F.expr(f"_slide - INTERVAL {window_seconds - slide_seconds} SECONDS")
    covering = F.explode(F.sequence(first, F.col("_slide"), F.expr(f"INTERVAL {slide_seconds} SECONDS")))
    per_item = counts.withColumn("_start", covering).groupBy(user, "_start", "_item").agg(F.sum("_n").alias("_n"))
    windows = per_item.groupBy(user, "_start").agg(F.sum("_n").alias("n_events"), F.count("_item").alias("n_items"))
    return windows.where(F.col("n_events") >= least).withColumns(_window_bounds(window_seconds)).select(
        user, "window_start", "window_end", "n_events", "n_items"
    )


def stream_velocity(
    events: DataFrame, late_by: str, user: str, at: str, window_seconds: int, slide_seconds: int, least: int
) -> DataFrame:
    """The windows of a stream that reach ``least`` events, given out when the
    watermark has passed them: user, window_start, window_end, n_events. State
    is one count per user and window that is still open."""
    timed = events.where(F.col(user).isNotNull()).withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", late_by)
    window = F.window("_at", f"{window_seconds} seconds", f"{slide_seconds} seconds").alias("_w")
    counted = timed.groupBy(user, window).agg(F.count(F.lit(1)).alias("n_events"))
    flagged = counted.where(F.col("n_events") >= least).withColumn("_start", F.col("_w.start"))
    return flagged.withColumns(_window_bounds(window_seconds)).select(user, "window_start", "window_end", "n_events")
