"""End-to-end incremental runs over landed JSON, used by the registered
streaming queries: rows land in two deliveries (newer half first, older half
second), and each delivery is picked up by an ``availableNow`` run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import contracts as C
from marquee.plans import facts, silver
from marquee.plans.catalog import Tables
from marquee.session import run_folder
from marquee.sources import conform
from marquee.sources.landing import add_ingestion_metadata, write_json
from marquee.streaming.bronze import ingest_available, read_landing_stream
from marquee.streaming.state import LatestStateSink, Live

SPLIT_AT = "2024-01-16 00:00:00"


def deliveries(landed: DataFrame, split_col: str = "updated_at", split_at: str = SPLIT_AT) -> list[DataFrame]:
    cut = F.lit(split_at).cast("timestamp_ntz")
    newer = landed.filter(F.col(split_col) >= cut)
    older = landed.filter((F.col(split_col) < cut) | F.col(split_col).isNull())
    return [newer, older]


def stream_bronze(
    spark: SparkSession, sf_dir: str, entity: str, ingested_at: str | None, split_at: str = SPLIT_AT
) -> DataFrame:
    root = run_folder(spark, f"stream-bronze-{entity}")
    landing, bronze_dir, checkpoint = f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint"
    for i, part in enumerate(deliveries(conform.landed(spark, sf_dir, entity), split_at=split_at), start=1):
        write_json(part, f"{landing}/delivery-{i}")
        ingest_available(spark, f"{landing}/*", entity, bronze_dir, checkpoint, ingested_at)
    return spark.read.parquet(bronze_dir)


# what a seat's state adds to the occupancy of its show
OCCUPANCY = Live(
    "occupancy", "show_id", f"hold_status IN ({', '.join(map(repr, C.OCCUPIED_STATUSES))}) AND seat_no IS NOT NULL"
)


def seat_sink(spark: SparkSession, root: str, buckets: int = 8) -> LatestStateSink:
    return LatestStateSink(
        spark,
        state_dir=f"{root}/state",
        quarantine_dir=f"{root}/quarantine",
        keys=C.KEYS["seat_holds"],
        order_cols=C.version_order("seat_holds"),
        rules=silver.SEAT_HOLD_RULES,
        buckets=buckets,
        live=[OCCUPANCY],
    )


def run_seat_stream(spark: SparkSession, root: str, sink: LatestStateSink, ingested_at: str | None) -> None:
    """One triggered run over what has landed under ``root`` since the last."""
    stream = add_ingestion_metadata(
        read_landing_stream(spark, f"{root}/landing/*", "seat_holds"), C.SOURCE_SYSTEMS["seat_holds"], ingested_at
    )
    query = (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_seat_state(
    spark: SparkSession, sf_dir: str, ingested_at: str | None, buckets: tuple[int, int] = (8, 8)
) -> tuple[DataFrame, DataFrame]:
    """Seat holds: gate each micro-batch, upsert the latest state per seat.

    ``buckets`` are the bucket counts that the two runs ask for; the state
    keeps the first. Returns (latest state, quarantined rows).
    """
    root = run_folder(spark, "stream-seat-state")
    for i, part in enumerate(deliveries(conform.landed(spark, sf_dir, "seat_holds")), start=1):
        sink = seat_sink(spark, root, buckets[i - 1])
        write_json(part, f"{root}/landing/delivery-{i}")
        run_seat_stream(spark, root, sink, ingested_at)
    return sink.read(), sink.read_quarantine()


def live_occupancy(sink: LatestStateSink, dim_show: DataFrame, dim_venue: DataFrame) -> DataFrame:
    """fact_seat_occupancy from the counts that the stream keeps: no seat is
    read, only one count per show."""
    counts = sink.read_live(OCCUPANCY.name).select("show_id", F.col("n").alias("occupied_seats"))
    tables = {"dim_show": dim_show, "dim_venue": dim_venue, "occupied_seats": counts}
    return facts.build(facts.FACTS["fact_seat_occupancy"], tables.__getitem__)


def stream_live_seat_occupancy(spark: SparkSession, sf_dir: str, ingested_at: str | None) -> DataFrame:
    root = run_folder(spark, "stream-occupancy")
    sink = seat_sink(spark, root)
    tables = Tables(spark, sf_dir)
    for i, part in enumerate(deliveries(conform.landed(spark, sf_dir, "seat_holds")), start=1):
        write_json(part, f"{root}/landing/delivery-{i}")
        run_seat_stream(spark, root, sink, ingested_at)
    return live_occupancy(sink, tables.dim_show, tables.dim_venue)
