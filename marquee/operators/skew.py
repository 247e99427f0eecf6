"""Joins that a hot key cannot turn into one long task.

AQE splits a skewed side only where both sides of a sort-merge join are shuffle
stages of their own. A fact that is a bucketed scan, or that keeps the
partitioning of an earlier step, is none. Here the hot keys are known before
the join: their rows meet the few rows of the other side that have these keys
by a broadcast, and everything else takes the usual join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: rows of one key that are still one task's work
HOT_ROWS = 5_000_000
#: most keys that are taken out; the key that comes next then has less than one
#: in so many of all rows
MAX_HOT = 10_000


#: groups of keys that are counted before the keys are
SLOTS = 65_536


def hot_keys(
    rows: DataFrame, key: str, hot_rows: int = HOT_ROWS, most: int = MAX_HOT, slots: int = SLOTS
) -> DataFrame | None:
    """The keys with ``hot_rows`` rows or more, commonest first, as a frame of at
    most ``most`` rows; None if there is none.

    Keys are hashed into ``slots``, whose rows are counted first: a slot with
    fewer rows holds no such key. Then the keys of the other slots are counted,
    so the mass of rare keys is not shuffled to find that they are rare.
    """
    present = rows.where(F.col(key).isNotNull()).select(key, F.pmod(F.xxhash64(key), F.lit(slots)).alias("_slot"))
    full = present.groupBy("_slot").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= hot_rows).select("_slot")
    held = full.collect()  # at most ``slots`` numbers
    if not held:
        return None
    kept = present.join(F.broadcast(rows.sparkSession.createDataFrame(held, full.schema)), "_slot", "left_semi")
    counted = kept.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    found = counted.where(F.col("n") >= hot_rows).orderBy(F.desc("n"), key).limit(most).select(key)
    keys = found.collect()
    return rows.sparkSession.createDataFrame(keys, found.schema) if keys else None


def lookup_join(rows: DataFrame, side: DataFrame, key: str, hot: DataFrame | None = None) -> DataFrame:
    """``rows`` left-joined to ``side``, which has one row per key.

    Rows of ``hot`` keys never travel: the matching rows of ``side``, one per
    hot key and so ``MAX_HOT`` at most, are broadcast to them.
    """
    if hot is None:
        return rows.join(side, key, "left")
    hot = F.broadcast(hot)
    few = F.broadcast(side.join(hot, key, "left_semi"))
    return rows.join(hot, key, "left_semi").join(few, key, "left").unionByName(
        rows.join(hot, key, "left_anti").join(side, key, "left")
    )
