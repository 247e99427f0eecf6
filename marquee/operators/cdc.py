"""Change-data-capture helpers: last write wins per business key."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def keys_present(keys: Sequence[str]) -> Column:
    return F.expr(" AND ".join(f"{_q(k)} IS NOT NULL" for k in keys))


def _orderable(dtype: DataType) -> bool:
    if isinstance(dtype, (MapType, VariantType)):
        return False
    if isinstance(dtype, ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return True


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str],
    null_keys: str = "bypass",
    method: str = "auto",
) -> DataFrame:
    """Keep the newest row per key; ``order_cols`` are compared newest first
    (descending, NULLs last), then the remaining columns break exact ties.

    ``method="aggregate"`` (the default when every column is orderable) is
    ``max(struct(order_cols..., other columns...))`` per key: a partial
    aggregation before the exchange leaves at most one row per key and map
    task, so a key holding a third of all rows costs one row per task in the
    shuffle, and the sorts are on the key alone. ``method="window"`` is
    ``row_number() = 1``, which Spark plans with a partial WindowGroupLimit
    with the same effect; it also handles columns that cannot be ordered.

    Rows with a NULL key are not versions of one entity. ``null_keys="bypass"``
    passes them through untouched (a gate downstream quarantines them) instead
    of collapsing them into one group; ``"drop"`` removes them; ``"group"``
    treats NULL as one key, as plain ``partitionBy`` does.
    """
    if not order_cols:
        raise ValueError("latest_by_key needs at least one order column")
    if method == "auto":
        method = "aggregate" if all(_orderable(f.dataType) for f in df.schema.fields) else "window"
    cols = df.columns
    rest = [c for c in cols if c not in keys and c not in order_cols]

    def by_aggregate(frame: DataFrame) -> DataFrame:
        # struct comparison is field by field with NULL lowest, so max() is
        # "newest first, NULLs last" on the order columns
        newest = F.expr(f"max(struct({', '.join(_q(c) for c in [*order_cols, *rest])}))").alias("_v")
        return frame.groupBy(*keys).agg(newest).selectExpr(*[_q(c) if c in keys else f"_v.{_q(c)}" for c in cols])

    def by_window(frame: DataFrame) -> DataFrame:
        types = {f.name: f.dataType for f in frame.schema.fields}
        ties = [c for c in rest if _orderable(types[c])]  # unorderable columns cannot break ties
        window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in [*order_cols, *ties]])
        return frame.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") == 1).drop("_rn")

    if method not in ("aggregate", "window"):
        raise ValueError(f"unknown dedup method: {method}")
    dedup = by_aggregate if method == "aggregate" else by_window

    if null_keys == "group":
        return dedup(df)
    present = keys_present(keys)
    keyed = dedup(df.filter(present))
    if null_keys == "drop":
        return keyed
    if null_keys != "bypass":
        raise ValueError(f"unknown null_keys mode: {null_keys}")
    return keyed.unionByName(df.filter(~present))


def drop_tombstones(df: DataFrame, flag: str = "is_deleted") -> DataFrame:
    """Remove rows whose latest version is a delete; NULL means not deleted."""
    return df.filter(F.col(flag).isNull() | ~F.col(flag))
