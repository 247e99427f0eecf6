"""Bronze ingest as a triggered file stream.

``availableNow`` processes every landed file not yet recorded in the
checkpoint and stops, so a scheduled run picks up exactly the new files and
a re-run without new files is a no-op.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee import contracts as C
from marquee.session import TABLE_OPTIONS
from marquee.sources.landing import CORRUPT, JSON_OPTIONS, add_ingestion_metadata, with_corrupt_column


# a backlog is worked off in batches of so many files
MAX_FILES_PER_TRIGGER = 1000


def read_landing_stream(
    spark: SparkSession, landing_dir: str, entity: str, max_files_per_trigger: int = MAX_FILES_PER_TRIGGER
) -> DataFrame:
    """Landed lines as they arrive; the raw text of a malformed line is kept in
    ``_corrupt_record``, so nothing that was landed is lost."""
    return (
        spark.readStream.options(**JSON_OPTIONS)
        .schema(with_corrupt_column(C.CONTRACTS[entity]))
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .json(landing_dir)
    )


def ingest_available(
    spark: SparkSession,
    landing_dir: str,
    entity: str,
    bronze_dir: str,
    checkpoint_dir: str,
    ingested_at: str | None = None,
) -> None:
    """Append every new landed file of ``entity`` to the bronze Parquet table."""
    stream = add_ingestion_metadata(read_landing_stream(spark, landing_dir, entity), C.SOURCE_SYSTEMS[entity], ingested_at)
    query = (
        stream.writeStream.format("parquet").options(**TABLE_OPTIONS)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start(bronze_dir)
    )
    query.awaitTermination()
