"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the test tables under ``sf_dir`` through the conform
layer, so its work grows with them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marquee.operators.quality import FAILURES, expectation_metrics
from marquee.plans import extensions, layered, marts, silver
from marquee.plans.catalog import ENTITIES, INGESTED_AT, Tables
from marquee.plans.views import create_user_view, user_view
from marquee.session import TABLE_OPTIONS, run_folder
from marquee.sources import conform
from marquee.sources.landing import CORRUPT, bronze, read_json, write_json, write_with_cut_lines
from marquee.streaming import runs
from marquee.streaming.incremental import Incremental, row_counts

Query = Callable[[SparkSession, str], DataFrame]

NEXT_INGESTED_AT = "2024-06-02 00:00:00"


def _table(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(Tables(spark, sf_dir), name)

    run.__name__ = name
    return run


def _bronze(entity: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Batch JSON scan of the landed files against the declared contract."""
        landing = f"{run_folder(spark, 'landing')}/{entity}"
        write_json(conform.landed(spark, sf_dir, entity), landing)
        return bronze(read_json(spark, landing, entity), entity, INGESTED_AT)

    run.__name__ = f"bronze_{entity}"
    return run


def _outcomes(spark: SparkSession, sf_dir: str, root: str, entity: str) -> DataFrame:
    """Land an entity with lines cut off, write bronze once and count what
    became of its lines: one scan of bronze, one aggregation beside the dedup."""
    write_with_cut_lines(conform.landed(spark, sf_dir, entity), f"{root}/{entity}", entity)
    lines = bronze(read_json(spark, f"{root}/{entity}", entity), entity, INGESTED_AT)
    landed = Observation(f"landed_{entity}")
    lines.observe(landed, F.count(F.lit(1)).alias("n")).write.options(**TABLE_OPTIONS).parquet(f"{root}/bronze_{entity}")
    checked = silver.checked(spark.read.schema(lines.schema).parquet(f"{root}/bronze_{entity}"), entity)
    return checked.agg(
        F.lit(entity).alias("entity"),
        F.lit(landed.get["n"]).cast("long").alias("landed_lines"),
        F.count_if(F.col(FAILURES) == silver.PARSE_FAILURE).alias("malformed_lines"),
        F.count_if(F.col(FAILURES).isNull()).alias("valid_rows"),
        F.count_if(F.col(FAILURES).isNotNull()).alias("quarantined_rows"),
    ).withColumn("superseded_rows", F.expr("landed_lines - valid_rows - quarantined_rows"))


def quarantine_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nine entities landed with lines cut off, read back, and accounted
    for: per entity the landed and malformed lines, valid and quarantined rows,
    and the versions that a newer one or a delete supersedes. The entities are
    independent jobs."""
    root = run_folder(spark, "landing-cut")
    with ThreadPoolExecutor(layered.PARALLEL_TABLES) as pool:
        parts = list(pool.map(lambda entity: _outcomes(spark, sf_dir, root, entity), ENTITIES))
    return reduce(DataFrame.unionByName, parts)


def dim_user_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Through the SQL view: dim_user registered by name, masked view on top."""
    source = f"dim_user_{uuid.uuid4().hex[:8]}"
    Tables(spark, sf_dir).dim_user.createOrReplaceTempView(source)
    return create_user_view(spark, source, f"{source}_masked", privileged=False)


def dim_user_unmasked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_view(Tables(spark, sf_dir).dim_user, privileged=True)


def expectation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    frames = [expectation_metrics(t.before_expectations(table), table, exps)
              for table, exps in silver.EXPECTATIONS.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def expectation_report_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same expectations on the rows as they arrive, where they fail."""
    t = Tables(spark, sf_dir)
    out = None
    for table, expectations in silver.EXPECTATIONS.items():
        entity = table.removeprefix("silver_")
        part = expectation_metrics(t.bronze(entity), f"bronze_{entity}", expectations)
        out = part if out is None else out.unionByName(part)
    return out


def _merged(dim: str, on_missing: str = "keep") -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return Tables(spark, sf_dir).merged_dim(dim, on_missing)

    return run


def scd2_three_snapshots_venue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Tables(spark, sf_dir).scd2_three_snapshots_venue()


def dim_venue_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.venue_history(layered.incremental_dim_venue(spark, sf_dir))


def _top(report: Callable[[DataFrame], DataFrame], table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return report(getattr(Tables(spark, sf_dir), table))

    run.__name__ = report.__name__
    return run


def stream_bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.stream_bronze(spark, sf_dir, "seat_holds", INGESTED_AT).drop(CORRUPT)


def stream_silver_seat_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    state, _ = runs.stream_seat_state(spark, sf_dir, INGESTED_AT)
    return state


def stream_seat_state_resized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second delivery's run asks for another number of buckets."""
    state, _ = runs.stream_seat_state(spark, sf_dir, INGESTED_AT, buckets=(4, 6))
    return state


def _stream_bronze(entity: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Two deliveries of landed files, each picked up by a triggered stream."""
        return runs.stream_bronze(spark, sf_dir, entity, INGESTED_AT, layered.DELIVERY_SPLIT[entity])

    run.__name__ = f"stream_bronze_{entity}"
    return run


def _two_deliveries(spark: SparkSession, sf_dir: str, entities: Sequence[str], ingested_at: Sequence[str]) -> Incremental:
    """Bronze and silver after two deliveries, the older rows first."""
    root = run_folder(spark, "incremental-silver")
    lake = Incremental(spark, root)
    for i, at in enumerate(ingested_at):
        with ThreadPoolExecutor(layered.PARALLEL_TABLES) as pool:
            list(pool.map(lambda e: layered.land_delivery(spark, sf_dir, e, f"{root}/landing", i + 1), entities))
        lake.run(f"{root}/landing", at, entities)
    return lake


def incremental_silver_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze appended and silver upserted by two deliveries: nothing is read
    or computed twice. Reports the rows that the tables then hold."""
    return row_counts(_two_deliveries(spark, sf_dir, ENTITIES, (INGESTED_AT, INGESTED_AT)))


def incremental_silver_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_deliveries(spark, sf_dir, ("bookings",), (INGESTED_AT, INGESTED_AT)).silver("bookings")


def bronze_of_one_ingest_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second of two deliveries, read back by its ingest date alone."""
    lake = _two_deliveries(spark, sf_dir, ("payments",), (INGESTED_AT, NEXT_INGESTED_AT))
    return lake.bronze("payments", NEXT_INGESTED_AT[:10]).drop(CORRUPT)


def stream_live_seat_occupancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occupancy from counts that follow the stream, after two deliveries."""
    return runs.stream_live_seat_occupancy(spark, sf_dir, INGESTED_AT)


QUERIES: dict[str, Query] = {
    **{f"bronze_{entity}": _bronze(entity) for entity in ENTITIES},
    "quarantine_malformed": quarantine_malformed,
    **{name: _table(name) for name in (
        "latest_bookings", "silver_bookings", "quarantine_bookings", "silver_payments", "silver_users",
        "silver_venues", "silver_movies", "silver_shows", "silver_seat_holds", "quarantine_seat_holds",
        "silver_promotions", "quarantine_promotions", "silver_promotion_redemptions",
        "quarantine_payments", "quarantine_redemptions",
        "quarantine_users", "quarantine_venues", "quarantine_movies", "quarantine_shows",
        "dim_show", "dim_venue", "dim_user",
        "fact_bookings", "fact_payments", "fact_seat_occupancy", "fact_promotion_redemptions",
        "gold_daily_revenue", "gold_promotion_performance", "gold_user_booking_summary",
    )},
    "expectation_report": expectation_report,
    "layer_row_counts": layered.layer_row_counts,
    "incremental_layer_row_counts": layered.incremental_layer_row_counts,
    "expectation_report_bronze": expectation_report_bronze,
    "scd2_merge_venue": _merged("dim_venue"),
    "scd2_merge_show": _merged("dim_show"),
    "scd2_merge_user": _merged("dim_user"),
    "scd2_close_missing_venue": _merged("dim_venue", "close"),
    "scd2_three_snapshots_venue": scd2_three_snapshots_venue,
    "dim_venue_after_failed_run": layered.dim_venue_after_failed_run,
    "incremental_dim_venue": layered.incremental_dim_venue,
    "dim_venue_history": dim_venue_history,
    "top_shows_by_occupancy": _top(marts.top_shows_by_occupancy, "fact_seat_occupancy"),
    "top_promotions": _top(marts.top_promotions, "gold_promotion_performance"),
    "top_users_by_spend": _top(marts.top_users_by_spend, "gold_user_booking_summary"),
    "top_venue_days": _top(marts.top_venue_days, "gold_daily_revenue"),
    "dim_user_masked": dim_user_masked,
    "dim_user_unmasked": dim_user_unmasked,
    "stream_bronze_events": stream_bronze_events,
    "stream_silver_seat_state": stream_silver_seat_state,
    "stream_seat_state_resized": stream_seat_state_resized,
    **{f"stream_bronze_{entity}": _stream_bronze(entity) for entity in ENTITIES if entity != "seat_holds"},
    "incremental_silver_row_counts": incremental_silver_row_counts,
    "incremental_silver_bookings": incremental_silver_bookings,
    "bronze_of_one_ingest_date": bronze_of_one_ingest_date,
    "stream_live_seat_occupancy": stream_live_seat_occupancy,
    **extensions.QUERIES,
}

