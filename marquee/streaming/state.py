"""Latest state per key, maintained from a stream with ``foreachBatch``.

Window dedup is not allowed on a streaming frame, so each micro-batch is
merged into a state table by hand:

1. the batch's valid rows are reduced to the newest row per key (a hot key
   is collapsed map-side by the partial aggregation);
2. the state is a bucketed table (``sources.buckets``): only the buckets the
   batch touches are read, reduced again together with the batch (at most two
   rows per key) and written as a new version;
3. aggregates that are declared on the state (``Live``) change by what the
   touched keys contributed before and contribute now;
4. one manifest makes state and aggregates the new ones, together.

Nothing that can be read is ever overwritten: a batch that breaks off before
its commit leaves the state as it was, and its replay starts the version anew.
A batch whose commit is there is not applied again. The number of buckets is
the state's for good: a later run that asks for another number gets the stored
one, so a key never has two homes.

The cost of a batch follows the batch, not the size or the age of the state:
its buckets are found by path, the manifest has one number per bucket, and what
a batch replaces is deleted by the next but one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators.cdc import latest_by_key
from marquee.operators.quality import Rule, gate
from marquee.plans.silver import split_parsed
from marquee.sources.buckets import BUCKET, BucketStore, buckets_for
from marquee.sources.landing import CORRUPT

__all__ = ["LatestStateSink", "Live", "buckets_for"]

STATE = "data"


@dataclass(frozen=True)
class Live:
    """A sum over the state per ``by`` that is kept up with every batch."""

    name: str
    by: str
    #: SQL over a state row: what it adds, a whole number
    adds: str
    buckets: int = 8


class LatestStateSink:
    def __init__(
        self,
        spark: SparkSession,
        state_dir: str,
        quarantine_dir: str,
        keys: Sequence[str],
        order_cols: Sequence[str],
        rules: Sequence[Rule],
        buckets: int = 32,
        live: Sequence[Live] = (),
    ) -> None:
        """``buckets`` counts only for a state that does not exist yet, and
        ``live`` has to be the same from the state's first batch on."""
        self.spark = spark
        self.store = BucketStore(spark, state_dir)
        self.quarantine_dir = quarantine_dir
        self.keys = list(keys)
        self.order_cols = list(order_cols)
        self.rules = list(rules)
        self.requested = buckets
        self.live = list(live)

    def committed(self) -> tuple[int, int, int, dict[int, int]]:
        """(last batch, last version, number of buckets, version per bucket)."""
        m = self.store.manifest()
        return m.note, m.commit, m.buckets(STATE) or self.requested, m.versions(STATE)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        change = self.store.change()
        if batch_id <= change.before.note:
            return  # replayed after its commit
        parsed, malformed = split_parsed(batch)
        valid, quarantined = gate(parsed, self.rules)
        if malformed is not None:
            valid, quarantined = valid.drop(CORRUPT), quarantined.unionByName(malformed)
        static = {"partitionOverwriteMode": "static"}
        quarantined.write.mode("overwrite").options(**static).parquet(f"{self.quarantine_dir}/batch={batch_id}")

        newest = latest_by_key(valid, self.keys, self.order_cols, null_keys="drop").persist()
        try:
            old, new = change.merge(
                STATE, newest, self.keys,
                lambda both: latest_by_key(both, [BUCKET, *self.keys], self.order_cols, null_keys="drop"), self.requested,
            )
            for live in self.live:
                self._follow(change, live, old, new, newest)
            change.commit(batch_id)
        finally:
            newest.unpersist()

    def _follow(self, change, live: Live, old: DataFrame, new: DataFrame, newest: DataFrame) -> None:
        """Add to the touched groups what the batch's keys add now, less what
        they added before."""
        touched = newest.select(*self.keys)

        def added(rows: DataFrame, sign: str) -> DataFrame:
            mine = rows.join(touched, self.keys, "left_semi")
            return mine.select(live.by, F.expr(f"{sign}CAST({live.adds} AS BIGINT)").alias("n"))

        moved = added(new, "").unionByName(added(old, "-")).groupBy(live.by).agg(F.sum("n").alias("n"))
        moved = moved.where("n <> 0").persist()
        try:
            change.merge(
                live.name, moved, [live.by],
                lambda both: both.groupBy(BUCKET, live.by).agg(F.sum("n").alias("n")), live.buckets,
            )
        finally:
            moved.unpersist()

    def read(self) -> DataFrame:
        """The committed state."""
        return self.store.read(STATE)

    def read_live(self, name: str) -> DataFrame:
        """The committed sums of a ``Live``: its group and ``n``."""
        return self.store.read(name)

    def superseded(self) -> list[str]:
        """Folders that the last commit replaced; the next one deletes them."""
        return self.store.manifest().replaced

    def read_quarantine(self) -> DataFrame:
        return self.spark.read.parquet(self.quarantine_dir).drop("batch")
