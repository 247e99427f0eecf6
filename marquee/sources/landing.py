"""Landing zone: JSON-lines files read against a declared contract.

Timestamps are written and read with microseconds; Spark's default JSON
format keeps milliseconds only and would silently change ``updated_at``
values, and with them which version wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marquee import contracts as C

TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
CORRUPT = "_corrupt_record"
JSON_OPTIONS = {"timestampNTZFormat": TS_FORMAT, "timestampFormat": TS_FORMAT}
# a landed line repeats every field's name, so it is many times its table row:
# files are compressed, at a level that costs half the time for a fifth more bytes,
# and short, as a compressed file is read by one task
FILE_OPTIONS = {"compression": "gzip", "zlib.compress.level": "THREE", "maxRecordsPerFile": "250000"}


def add_ingestion_metadata(df: DataFrame, source_system: str, ingested_at: str | Column | None = None) -> DataFrame:
    """Bronze metadata: ingest time and source-system tag.

    ``ingested_at`` defaults to the query's current time; pass a literal where
    results are compared.
    """
    if ingested_at is None:
        when = F.current_timestamp().cast("timestamp_ntz")
    elif isinstance(ingested_at, Column):
        when = ingested_at.cast("timestamp_ntz")
    else:
        when = F.lit(ingested_at).cast("timestamp_ntz")
    return df.withColumns({"_ingested_at": when, "_source_system": F.lit(source_system)})


def with_corrupt_column(schema: StructType) -> StructType:
    return StructType(list(schema.fields) + [StructField(CORRUPT, StringType(), True)])


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").options(**JSON_OPTIONS, **FILE_OPTIONS).json(path)


# by entity, which landed rows are landed once more with their line cut off
CUT_LINES = {
    "users": "user_id % 101 = 0",
    "venues": "venue_id % 11 = 0",
    "movies": "duration_min % 13 = 0",
    "shows": "show_id % 101 = 0",
    "bookings": "booking_id % 1009 = 0",
    "payments": "payment_id % 1009 = 0",
    "seat_holds": "hold_id % 101 = 0",
    "promotions": "promotion_id % 7 = 0",
    "promotion_redemptions": "redemption_id % 1009 = 0",
}


def write_with_cut_lines(df: DataFrame, path: str, entity: str) -> None:
    """Land every row as a JSON line, and the rows of ``CUT_LINES`` once more
    with the second half of the line missing, as a transfer that broke off
    leaves it."""
    line = F.to_json(F.struct(*df.columns), JSON_OPTIONS)
    cut = f"CASE WHEN {CUT_LINES[entity]} THEN array(line, left(line, CAST(length(line) / 2 AS INT))) ELSE array(line) END"
    lines = df.withColumn("line", line).select(F.explode(F.expr(cut)).alias("value"))
    lines.write.mode("errorifexists").options(**FILE_OPTIONS).text(path)


def read_json(spark: SparkSession, path: str | list[str], entity: str, keep_corrupt: bool = True) -> DataFrame:
    """Batch scan of every landed file under ``path`` (globs allowed) or several.

    PERMISSIVE mode: a wrongly typed field becomes NULL; a malformed line
    becomes a row whose ``_corrupt_record`` holds the raw text, so a gate can
    quarantine it. ``keep_corrupt=False`` is for files that are known to be
    whole: the column is left out.
    """
    schema = C.CONTRACTS[entity]
    reader = spark.read.options(**JSON_OPTIONS)
    if keep_corrupt:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        return reader.schema(with_corrupt_column(schema)).json(path)
    return reader.schema(schema).json(path)


def bronze(df: DataFrame, entity: str, ingested_at: str | Column | None = None) -> DataFrame:
    return add_ingestion_metadata(df, C.SOURCE_SYSTEMS[entity], ingested_at)
