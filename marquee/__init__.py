"""marquee: a Spark-native medallion library for event-driven ticketing data.

Bronze ingest (batch or incremental file stream) against declared contracts,
last-write-wins CDC, named data-quality gates with quarantine, SCD Type 2
dimensions, facts, marts and a masked user view. Every operator is a plain
function from DataFrames to a DataFrame built from Spark SQL expressions, so
Catalyst and AQE do the planning.
"""

__version__ = "0.1.0"
