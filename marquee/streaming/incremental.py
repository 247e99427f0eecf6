"""Bronze and silver that follow the deliveries.

A run picks up the files that have landed since the last one, entity by
entity, each as a triggered file stream. Of every micro-batch

* the lines are appended to bronze, in folders by ingest date, source system and
  batch; a batch that is tried again replaces its own folders;
* rows that are no version of any key go to the entity's rejects;
* the newest version of every key the batch touches is brought into a bucketed
  table, so only the buckets of these keys are rewritten.

Silver is the bucketed table seen through the entity's rules; it is never
recomputed from bronze. One manifest per entity says which batches are in, and
a batch that is in isn't applied again.
"""

from __future__ import annotations

import threading
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee import contracts as C
from marquee.operators.cdc import keys_present, latest_by_key
from marquee.operators.quality import FAILURES
from marquee.plans import silver
from marquee.plans.catalog import ENTITIES
from marquee.session import TABLE_OPTIONS, drop_shuffles, open_writers
from marquee.sources import files
from marquee.sources.buckets import BucketStore
from marquee.sources.landing import CORRUPT, add_ingestion_metadata
from marquee.streaming.bronze import read_landing_stream

#: bronze's folders, outermost first
BY = ("_ingest_date", "_source_system", "_batch")
PARALLEL = 9
#: bytes of a batch in bronze from which it is merged while no other such batch is: one shuffle lies on disk, not many
LARGE_BATCH = 32 << 20


class Incremental:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 8) -> None:
        """``buckets`` of each entity's table, for tables that aren't there yet
        (``sources.buckets.buckets_for`` of the size that is expected)."""
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self._large = threading.Lock()

    def store(self, entity: str) -> BucketStore:
        return BucketStore(self.spark, f"{self.root}/latest/{entity}")

    def _bronze(self, entity: str) -> str:
        return f"{self.root}/bronze/{entity}"

    def _rejects(self, entity: str) -> str:
        return f"{self.root}/rejects/{entity}"

    def _batch_folders(self, entity: str, batch_id: int) -> list[str]:
        """Bronze's folders of one batch."""
        root, mine = self._bronze(entity), f"{BY[2]}={batch_id}"
        outer = [f"{root}/{date}/{system}" for date in files.names(self.spark, root) if "=" in date
                 for system in files.names(self.spark, f"{root}/{date}")]
        return [f"{folder}/{mine}" for folder in outer if mine in files.names(self.spark, folder)]

    def _written(self, entity: str, batch_id: int, schema: StructType) -> DataFrame:
        """The rows of a batch as bronze has them: what follows reads columns
        of these files, and the landed lines are parsed once."""
        folders = self._batch_folders(entity, batch_id)
        if not folders:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", self._bronze(entity)).parquet(*folders)
        return rows.select(*schema.names)

    def _apply(self, entity: str, batch: DataFrame, batch_id: int) -> None:
        change = self.store(entity).change()
        if batch_id <= change.before.note:
            return
        for folder in self._batch_folders(entity, batch_id):  # an attempt without commit, perhaps on another date
            files.delete(self.spark, folder)
        landed = batch.withColumns({BY[0]: F.to_date("_ingested_at"), BY[2]: F.lit(batch_id)})
        appended = landed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**TABLE_OPTIONS)
        with open_writers(batch.sparkSession, 1):  # a batch mostly has one date and one source
            appended.partitionBy(*BY).parquet(self._bronze(entity))
        rows = self._written(entity, batch_id, batch.schema)
        own = silver.alone(rows, entity)
        rejected = silver.judged(rows.where(own), entity).write.mode("overwrite").option("partitionOverwriteMode", "static")
        rejected.options(**TABLE_OPTIONS).parquet(f"{self._rejects(entity)}/batch={batch_id}")
        keys, order = C.KEYS[entity], C.version_order(entity)
        keyed = rows.where(~own & keys_present(keys)).drop(CORRUPT)
        size = sum(files.state(self.spark, folder)[1] for folder in self._batch_folders(entity, batch_id))
        with self._large if size >= LARGE_BATCH else nullcontext():
            # the merge leaves the newest of the batch's and the held versions; a key has
            # one bucket, so rows are sorted by the key alone, which tells them apart at once
            change.merge("newest", keyed, keys, lambda both: latest_by_key(both, keys, order, null_keys="drop"), self.buckets)
            change.commit(batch_id)
            drop_shuffles(self.spark)

    def ingest(self, landing: str, entity: str, ingested_at: str | None = None) -> None:
        """What has landed under ``<landing>/<entity>/`` since the last run."""
        stream = add_ingestion_metadata(
            read_landing_stream(self.spark, f"{landing}/{entity}/*", entity), C.SOURCE_SYSTEMS[entity], ingested_at
        )
        query = (
            stream.writeStream.foreachBatch(lambda batch, batch_id: self._apply(entity, batch, batch_id))
            .option("checkpointLocation", f"{self.root}/checkpoints/{entity}")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()

    def run(self, landing: str, ingested_at: str | None = None, entities: Sequence[str] = ENTITIES) -> None:
        """All entities; they are independent streams."""
        with ThreadPoolExecutor(min(PARALLEL, len(entities))) as pool:
            list(pool.map(lambda entity: self.ingest(landing, entity, ingested_at), entities))

    def bronze(self, entity: str, ingest_date: str | None = None) -> DataFrame:
        """Every landed line, or those of one ingest date: then only that
        date's folders are listed and read."""
        rows = self.spark.read.parquet(self._bronze(entity))
        if ingest_date:
            rows = rows.where(F.col("_ingest_date") == F.lit(ingest_date).cast("date"))
        return rows.drop("_ingest_date", "_batch")

    def _newest(self, entity: str) -> DataFrame:
        return silver.judged(self.store(entity).read("newest"), entity)

    def silver(self, entity: str) -> DataFrame:
        return self._newest(entity).where(F.col(FAILURES).isNull()).drop(FAILURES)

    def rejects(self, entity: str) -> DataFrame:
        """Rejected rows of all deliveries."""
        return self.spark.read.parquet(self._rejects(entity)).drop("batch")

    def quarantine(self, entity: str) -> DataFrame:
        """Rejected rows of all deliveries, and keys whose newest version fails."""
        failing = self._newest(entity).where(F.col(FAILURES).isNotNull())
        return self.rejects(entity).unionByName(failing, allowMissingColumns=True)

    def bucket_folders(self, entity: str) -> list[str]:
        """The folders that hold an entity's newest versions."""
        store = self.store(entity)
        held = store.manifest().versions("newest")
        return [store._folder("newest", v, b) for b, v in sorted(held.items())]

    def old_folders(self, entity: str) -> list[str]:
        """Versions on disk, whether they are still held or not."""
        return files.names(self.spark, f"{self.store(entity).root}/newest")


def row_counts(lake: Incremental) -> DataFrame:
    """layer, table_name and row_count of bronze and silver. The newest versions
    are read once for both of their outcomes."""
    counted = []
    for entity in ENTITIES:
        silver_table, quarantine = f"silver_{entity}", f"quarantine_{entity.removeprefix('promotion_')}"
        for rows, tables in (
            (lake.bronze(entity), {f"bronze_{entity}": "true"}),
            (lake._newest(entity), {silver_table: f"{FAILURES} IS NULL", quarantine: f"{FAILURES} IS NOT NULL"}),
            (lake.rejects(entity), {quarantine: "true"}),
        ):
            counts = rows.agg(*[F.expr(f"count_if({which})").alias(name) for name, which in tables.items()])
            each = ", ".join(f"struct('{name.partition('_')[0]}' AS layer, '{name}' AS table_name, {name} AS row_count)" for name in tables)
            counted.append(counts.selectExpr(f"inline(array({each}))"))
    rows = reduce(DataFrame.unionByName, counted).groupBy("layer", "table_name").agg(F.sum("row_count").alias("row_count"))
    return rows.withColumn("layer", F.when(F.col("layer") == "bronze", "bronze").otherwise("silver"))
