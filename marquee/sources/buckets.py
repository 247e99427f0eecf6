"""Keyed tables that change in place at the cost of the change.

A table's keys are hashed into a fixed number of buckets. A change reads and
rewrites the buckets that its keys fall into, as files of a new version next to
the old ones; one manifest then names the version of every bucket of every
table, so several tables change together or not at all. Manifests are numbered;
the highest is the state. What a manifest replaced is deleted by the commit
after the next read could still have wanted it, that is one commit later, so a
reader that has just opened the previous state can finish.

A manifest has one number per bucket, and two manifests are kept: what a commit
reads, lists and writes besides the buckets doesn't grow with the number of
commits made.

One writer per store. ``BUCKET_BYTES`` is what one bucket should hold; a hot
key is one row here, since a key has one row.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee.session import TABLE_OPTIONS
from marquee.sources import files

BUCKET = "state_bucket"
VERSION = "state_version"
BUCKET_BYTES = 256 << 20


def buckets_for(table_bytes: int) -> int:
    return max(1, -(-table_bytes // BUCKET_BYTES))


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


@dataclass
class Manifest:
    """State of a store: of each table its number of buckets, its columns and
    the version of each bucket that has rows."""

    commit: int = 0
    #: what the writer says about its last change, e.g. the batch it came from
    note: int = -1
    tables: dict[str, dict] = field(default_factory=dict)
    #: folders that this commit replaced
    replaced: list[str] = field(default_factory=list)

    def buckets(self, table: str) -> int | None:
        return self.tables[table]["buckets"] if table in self.tables else None

    def versions(self, table: str) -> dict[int, int]:
        return {int(b): v for b, v in self.tables.get(table, {}).get("held", {}).items()}


class BucketStore:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    @property
    def _manifests(self) -> str:
        return f"{self.root}/manifests"

    def manifest(self) -> Manifest:
        """The state as it is now: one small file."""
        found = [n for n in files.names(self.spark, self._manifests) if n.endswith(".json") and not n.startswith(".")]
        if not found:
            return Manifest()
        return Manifest(**json.loads(files.read_text(self.spark, f"{self._manifests}/{found[-1]}")))

    def _folder(self, table: str, version: int, bucket: int) -> str:
        return f"{self.root}/{table}/{VERSION}={version}/{BUCKET}={bucket}"

    def read(self, table: str, manifest: Manifest | None = None, buckets: Iterable[int] | None = None) -> DataFrame | None:
        """The rows of a table, or of some of its buckets: exactly the folders
        that hold them are listed. None if the table was never written."""
        manifest = manifest or self.manifest()
        if table not in manifest.tables:
            return None
        schema = StructType.fromJson(manifest.tables[table]["columns"])
        versions = manifest.versions(table)
        wanted = versions if buckets is None else [b for b in buckets if b in versions]
        paths = [self._folder(table, versions[b], b) for b in wanted]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def change(self) -> Change:
        return Change(self)


class Change:
    """One commit in the making, over one or several tables."""

    def __init__(self, store: BucketStore) -> None:
        self.store = store
        self.before = store.manifest()
        self.commit_no = self.before.commit + 1
        self.tables = json.loads(json.dumps(self.before.tables))
        self.replaced: list[str] = []

    def merge(
        self,
        table: str,
        rows: DataFrame,
        keys: Sequence[str],
        combine: Callable[[DataFrame], DataFrame],
        buckets: int,
    ) -> tuple[DataFrame, DataFrame]:
        """Bring ``rows`` into ``table``: the rows that the touched buckets hold,
        together with the new ones, go through ``combine`` (which has to leave
        one row per bucket and key) and are the buckets' new version. ``rows``
        are read twice, the first time for their keys alone. A bucket's rows
        stay with the tasks that combined them, a file for each. ``buckets``
        counts only for a table that isn't there yet. Returns the touched
        buckets' rows before and after."""
        spark, store = self.store.spark, self.store
        count = self.before.buckets(table) or buckets
        placed = rows.withColumn(BUCKET, bucket_of(keys, count))
        # small ints, one per bucket at most
        touched = sorted(r[0] for r in placed.select(BUCKET).distinct().collect())
        held = self.before.versions(table)
        old = store.read(table, self.before, touched)
        if old is None:
            old = spark.createDataFrame([], rows.schema)
        if touched:
            both = old.withColumn(BUCKET, bucket_of(keys, count)).unionByName(placed)
            folder = f"{store.root}/{table}/{VERSION}={self.commit_no}"
            # a folder that an attempt without commit left is cleared as a whole
            writer = combine(both).write.mode("overwrite").option("partitionOverwriteMode", "static")
            writer.options(**TABLE_OPTIONS).partitionBy(BUCKET).parquet(folder)
        entry = self.tables.setdefault(table, {"buckets": count, "held": {}, "columns": json.loads(rows.schema.json())})
        self.replaced += [store._folder(table, held[b], b) for b in touched if b in held]
        entry["held"].update({str(b): self.commit_no for b in touched})
        made = [store._folder(table, self.commit_no, b) for b in touched]
        return old, spark.read.schema(rows.schema).parquet(*made) if made else spark.createDataFrame([], rows.schema)

    def commit(self, note: int = -1) -> Manifest:
        """Make the change the store's state, and delete what the commit before
        it replaced."""
        store = self.store
        self._clear(self.before.replaced)
        done = Manifest(self.commit_no, note, self.tables, self.replaced)
        files.publish_text(store.spark, f"{store._manifests}/{self.commit_no:012d}.json", json.dumps(done.__dict__))
        old = [n for n in files.names(store.spark, store._manifests) if n.endswith(".json") and not n.startswith(".")][:-2]
        for name in old:
            files.delete(store.spark, f"{store._manifests}/{name}")
        return done

    def _clear(self, folders: list[str]) -> None:
        spark = self.store.spark
        for folder in folders:
            files.delete(spark, folder)
        for parent in {f.rpartition("/")[0] for f in folders}:
            if not any(n.startswith(f"{BUCKET}=") for n in files.names(spark, parent)):
                files.delete(spark, parent)
