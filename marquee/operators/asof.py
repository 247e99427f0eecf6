"""As-of join: every event with the version of its dimension row that was valid
when the event took place.

A version is valid from its start, included, to its end, excluded; an open one
has no end. The versions of a key become one sorted array, so the join itself
is a plain equi-join with one row per key on the dimension's side: no range
condition, no row multiplied, and nothing that could become a nested loop. The
version is then picked inside the row. A merge opens at most one version of a
key, so an array is as long as the number of runs at most.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.skew import lookup_join

_FROM, _TO, _HISTORY = "_from", "_to", "_history"


def histories(
    versions: DataFrame, key: str, carried: Mapping[str, str], start: str = "effective_start", end: str = "effective_end"
) -> DataFrame:
    """One row per key: its versions in order of their start, each with the
    ``carried`` fields (name -> SQL over the version)."""
    fields = [F.col(start).alias(_FROM), F.col(end).alias(_TO), *[F.expr(sql).alias(name) for name, sql in carried.items()]]
    kept = versions.where(F.col(key).isNotNull() & F.col(start).isNotNull())
    return kept.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias(_HISTORY))


def asof_join(
    events: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    carried: Mapping[str, str],
    start: str = "effective_start",
    end: str = "effective_end",
    hot: DataFrame | None = None,
) -> DataFrame:
    """``events`` with the ``carried`` fields of the version of ``key`` that was
    valid at the time in column ``at``; NULL where none was, where the key has
    no version, and where key or time is NULL. If versions overlap, the one that
    started last counts. ``hot``: see ``skew.lookup_join``."""
    joined = lookup_join(events, histories(versions, key, carried, start, end), key, hot)
    valid = f"filter({_HISTORY}, v -> v.{_FROM} <= `{at}` AND (v.{_TO} IS NULL OR `{at}` < v.{_TO}))"
    picked = joined.withColumn("_valid", F.expr(f"try_element_at({valid}, -1)"))
    return picked.select(*events.columns, *[F.col(f"_valid.`{name}`").alias(name) for name in carried])
