"""Slowly changing dimensions, Type 2.

A dimension is its source columns plus ``effective_start``,
``effective_end`` (NULL while open) and ``is_current``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCD2_COLUMNS = ("effective_start", "effective_end", "is_current")


def _as_of(as_of: str | Column) -> Column:
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    return F.lit(as_of).cast("timestamp_ntz")


def bootstrap(source: DataFrame, as_of: str | Column) -> DataFrame:
    """First load: every row is an open, current version starting at ``as_of``."""
    return source.withColumns(
        {
            "effective_start": _as_of(as_of),
            "effective_end": F.lit(None).cast("timestamp_ntz"),
            "is_current": F.lit(True),
        }
    )


def merge(
    current_dim: DataFrame,
    new_source: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of: str | Column,
    on_missing: str = "keep",
) -> DataFrame:
    """Merge a new full snapshot of the source into an SCD2 dimension.

    One full outer join of the open versions with the snapshot on ``key``;
    each joined row emits its output versions through ``explode`` (keep,
    close + open, or open). Closed history does not take part in the join and
    is appended unchanged. A change is a null-safe inequality on any tracked
    column; untracked changes keep the open version as it is.

    A snapshot has one row per key. Rows without a key are ignored; a key on
    several rows fails the job, as either answer would be arbitrary and two
    open versions would multiply every later join.

    ``on_missing`` decides open versions whose key is absent from the
    snapshot: ``"keep"`` leaves them open, ``"close"`` ends them at ``as_of``.
    The output has ``current_dim``'s column order; snapshot columns missing
    from the dimension are ignored and dimension columns missing from the
    snapshot fail analysis.
    """
    open_rows = current_dim.filter(F.col("is_current"))
    closed_rows = current_dim.filter(~F.col("is_current"))
    merged = changes(open_rows, new_source, key, tracked, as_of, on_missing)
    return merged.unionByName(closed_rows)


def changes(
    open_rows: DataFrame,
    new_source: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of: str | Column,
    on_missing: str = "keep",
) -> DataFrame:
    """Open versions after the snapshot and the versions that it closes: what a
    store has to write; closed history is left alone."""
    if on_missing not in ("keep", "close"):
        raise ValueError(f"unknown on_missing mode: {on_missing}")
    cols = open_rows.columns
    data_cols = [c for c in cols if c not in SCD2_COLUMNS]
    ts = _as_of(as_of)

    cur = open_rows.select(F.col(key).alias("_k"), F.struct(*[F.col(c) for c in cols]).alias("cur"))
    # counted next to the join, on the join's own partitioning
    row = F.struct(*[F.col(c) for c in data_cols])
    counted = new_source.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(
        F.max(row).alias("new"), F.count(F.lit(1)).alias("n")
    )
    twice = F.raise_error(F.concat(F.lit(f"several rows for {key} "), F.col("_k").cast("string")))
    new = counted.select("_k", F.when(F.col("n") > 1, twice.cast(counted.schema["new"].dataType)).otherwise(F.col("new")).alias("new"))
    joined = cur.join(new, "_k", "full_outer")

    changed = reduce(
        lambda a, b: a | b,
        [~F.col(f"cur.{c}").eqNullSafe(F.col(f"new.{c}")) for c in tracked],
        F.lit(False),
    )

    def version(side: str, start: Column, end: Column, current: Column) -> Column:
        fields = {c: F.col(f"{side}.{c}") for c in data_cols}
        fields.update({"effective_start": start, "effective_end": end, "is_current": current})
        return F.struct(*[fields[c].alias(c) for c in cols])

    keep = F.col("cur")
    close = version("cur", F.col("cur.effective_start"), ts, F.lit(False))
    opened = version("new", ts, F.lit(None).cast("timestamp_ntz"), F.lit(True))
    missing = F.array(close) if on_missing == "close" else F.array(keep)

    emitted = (
        F.when(F.col("cur").isNull(), F.array(opened))
        .when(F.col("new").isNull(), missing)
        .when(changed, F.array(close, opened))
        .otherwise(F.array(keep))
    )
    return joined.select(F.explode(emitted).alias("v")).select("v.*")


def current(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("is_current"))


def duplicate_current_keys(dim: DataFrame, key: str) -> DataFrame:
    """Keys with more than one current version (must be empty)."""
    return current(dim).groupBy(key).count().filter(F.col("count") > 1)

