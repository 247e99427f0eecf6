"""Literal rows for tests."""

from datetime import datetime

from pyspark.sql.types import StructField, StructType

from marquee import contracts as C


def ts(value: str) -> datetime:
    return datetime.fromisoformat(value)


def rows(spark, entity: str, records: list[dict], extra: dict | None = None):
    """A frame with ``entity``'s contract; unspecified fields are NULL."""
    # landed files relax declared non-null fields, so fixtures may hold NULL keys
    schema = StructType([StructField(f.name, f.dataType, True) for f in C.CONTRACTS[entity].fields])
    data = [tuple(r.get(f.name) for f in schema.fields) for r in records]
    return spark.createDataFrame(data, schema)
