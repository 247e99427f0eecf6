"""Layered runs: the incremental SCD2 upsert and a full bronze -> silver -> gold build.

Each layer is written as a snapshot and the next layer is built from what
was read back, so a run never re-derives bronze from the landing files for
every table, and lineage stays one layer deep.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Collection
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marquee.operators import scd2
from marquee.operators.quality import FAILURES
from marquee.operators.skew import HOT_ROWS
from marquee.plans import silver
from marquee.plans.catalog import DIM_AS_OF, DIMENSIONS, ENTITIES, LAYER_TABLES, MERGE_AS_OF, Tables
from marquee.session import drop_shuffles, open_writers, run_folder
from marquee.sources import files
from marquee.sources.landing import CORRUPT, read_json, write_json
from marquee.sources.landing import bronze as add_bronze_metadata
from marquee.sources.snapshots import SnapshotStore


DIM_PARTITIONS = {"is_current": "boolean"}

#: versions of a dimension after which its closed rows are brought together
COMPACT_EVERY = 50

#: bytes of bronze from which a table is made when no other such table is
LARGE_TABLE = 32 << 20

# independent tables of one layer are built as concurrent Spark jobs
PARALLEL_TABLES = 9


def next_dim_version(
    store: SnapshotStore, table: str, silver_df: DataFrame, key: str, tracked: list[str], as_of: str,
    on_missing: str = "keep",
) -> DataFrame:
    """What the next version has to hold: all rows at the first load, else the
    open rows after the merge and the rows it closes. Closed history stays in
    the versions that closed it, so a run costs the open rows, not the history."""
    held = store.read_history(table)
    if held is None:
        return scd2.bootstrap(silver_df, as_of)
    return scd2.changes(scd2.current(held), silver_df, key, tracked, as_of, on_missing)


def upsert_scd2_dim(
    store: SnapshotStore,
    table: str,
    silver_df: DataFrame,
    key: str,
    tracked: list[str],
    as_of: str,
    on_missing: str = "keep",
) -> DataFrame:
    """Build the next dimension version, publish it and read it back.

    Versions are partitioned by ``is_current``: the next merge reads only the
    open partition of the latest one.
    """
    result = next_dim_version(store, table, silver_df, key, tracked, as_of, on_missing)
    return store.read_history(table, store.write(result, table, partition_by=list(DIM_PARTITIONS)))


def incremental_dim_venue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs against one store: batch 1 bootstraps, batch 2 merges."""
    store = SnapshotStore(spark, run_folder(spark, "incremental"), fresh=True)
    tables = Tables(spark, sf_dir)
    _, key, tracked = DIMENSIONS["dim_venue"]
    upsert_scd2_dim(store, "dim_venue", tables.silver_venues, key, tracked, DIM_AS_OF)
    return upsert_scd2_dim(store, "dim_venue", tables.venues_next_snapshot, key, tracked, MERGE_AS_OF)


def dim_venue_after_failed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``incremental_dim_venue``, but an attempt at the second run stages
    other rows, open and closed, and never commits; a new store then retries."""
    root = run_folder(spark, "failed-run")
    store = SnapshotStore(spark, root, fresh=True)
    tables = Tables(spark, sf_dir)
    _, key, tracked = DIMENSIONS["dim_venue"]
    first = upsert_scd2_dim(store, "dim_venue", tables.silver_venues, key, tracked, DIM_AS_OF)
    junk = first.unionByName(first.withColumns({"is_current": F.lit(False), "venue_id": F.col("venue_id") + 7_000_000}))
    store.stage(junk, "dim_venue", list(DIM_PARTITIONS))
    return upsert_scd2_dim(SnapshotStore(spark, root), "dim_venue", tables.venues_next_snapshot, key, tracked, MERGE_AS_OF)


VALID_FLAG = "_dq_valid"
CHECKED_PARTITIONS = {VALID_FLAG: "boolean"}

# one written table holds both outcomes of an entity's gate: entity, valid rows, the others
GATED = {
    "checked_bookings": ("bookings", "silver_bookings", "quarantine_bookings"),
    "checked_payments": ("payments", "silver_payments", "quarantine_payments"),
    "checked_redemptions": ("promotion_redemptions", "silver_promotion_redemptions", "quarantine_redemptions"),
    "checked_seat_holds": ("seat_holds", "silver_seat_holds", "quarantine_seat_holds"),
    "checked_promotions": ("promotions", "silver_promotions", "quarantine_promotions"),
    **{f"checked_{e}": (e, f"silver_{e}", f"quarantine_{e}") for e in ("users", "venues", "movies", "shows")},
}


def checked_table(bronze: DataFrame, entity: str) -> DataFrame:
    """``silver.checked`` with the flag that the written table is partitioned by."""
    return silver.checked(bronze, entity).withColumn(VALID_FLAG, F.col(FAILURES).isNull())


class _LayerWriter:
    """Stages tables concurrently, observes their row counts while writing,
    and commits a whole layer at once."""

    def __init__(self, store: SnapshotStore) -> None:
        self.store = store
        self.pending: dict[str, int] = {}
        self.rows: dict[str, int] = {}
        self.valid_rows: dict[str, int] = {}

    def stage(
        self,
        frames: dict[str, Callable[[], DataFrame]],
        partitions: dict[str, dict[str, str]] | None = None,
        buckets: dict[str, tuple[int, str]] | None = None,
        in_buckets: Collection[str] = (),
        in_turn: Collection[str] = (),
    ) -> dict[str, DataFrame]:
        """``frames`` maps each table to a function building its plan; plans are
        built in the worker threads, so building one overlaps running another.
        The rows of the bucketed tables ``in_buckets`` lie in their buckets as
        they come. Tables that are shuffled whole are made ``in_turn``, beside
        the others, so one's shuffle files are gone before the next one's come."""
        partitions = partitions or {}
        buckets = buckets or {}

        def one(name: str) -> tuple[str, int, int, int | None]:
            parts = partitions.get(name, {})
            metrics = [F.count(F.lit(1)).alias("rows")]
            if VALID_FLAG in parts:
                metrics.append(F.count_if(F.col(VALID_FLAG)).alias("valid"))
            obs = Observation(name)
            version = self.store.stage(frames[name]().observe(obs, *metrics), name, list(parts),
                                       bucket_by=buckets.get(name), deal=name not in in_buckets)
            try:
                got = obs.get
            except Py4JJavaError:  # a plan known to be empty is not run, and observes nothing
                got = {"rows": 0, "valid": 0 if VALID_FLAG in parts else None}
            return name, version, got["rows"], got.get("valid")

        def in_order(names: list[str]) -> list[tuple[str, int, int, int | None]]:
            out = []
            for name in names:
                out.append(one(name))
                if name in in_turn:
                    drop_shuffles(self.store.spark)
            return out

        groups = [[n for n in frames if n in in_turn], *([n] for n in frames if n not in in_turn)]
        with ThreadPoolExecutor(max_workers=max(1, min(PARALLEL_TABLES, len(frames)))) as pool:
            done = [x for group in pool.map(in_order, groups) for x in group]
        drop_shuffles(self.store.spark)
        out = {}
        for name, version, rows, valid in done:
            self.pending[name], self.rows[name] = version, rows
            if valid is not None:
                self.valid_rows[name] = valid
            history = partitions.get(name) == DIM_PARTITIONS
            out[name] = (
                self.store.read_history(name, version) if history
                else self.store.read(name, version, partition_types=partitions.get(name))
            )
        return out

    def commit(self) -> dict[str, int]:
        self.store.commit(self.pending)
        published, self.pending = self.pending, {}
        return published


#: Spark's own limit (spark.sql.sources.bucketing.maxBuckets) is 100,000
MAX_FACT_BUCKETS = 65_536


def bucket_count(spark: SparkSession, most: int = MAX_FACT_BUCKETS) -> int:
    """Buckets of the largest fact: as many as the session shuffles into, up to
    a bound that Spark accepts."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), most)


def shuffled_into(spark: SparkSession, buckets: int) -> bool:
    """Whether an aggregation on a key leaves its rows in so many buckets of the
    key. Spark takes the same hash for both, and NULLs don't change it, so
    further grouping columns that are NULL don't either."""
    first = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return {spark.conf.get("spark.sql.shuffle.partitions"), first or str(buckets)} == {str(buckets)}


def run_layers(
    spark: SparkSession,
    sf_dir: str,
    root: str | None = None,
    ingested_at: str | None = None,
    as_of: str = DIM_AS_OF,
    landing: str | None = None,
    hot_rows: int = HOT_ROWS,
) -> dict[str, tuple[str, int, int]]:
    """Full bronze -> silver -> gold build into a snapshot store.

    Each table is written once and the next layer is built from what was
    read back, so lineage stays one layer deep and a lost executor re-runs
    only tasks of the layer being built. The tables of a layer are built
    concurrently and published by one commit; a gated domain's valid and
    quarantined rows are one table partitioned by ``_dq_valid``. Dimensions
    bootstrap on the first run and SCD2-merge on later runs against the same
    ``root``; ``as_of`` is the run's change time (pass a later one per run).
    With ``landing`` bronze is read from the JSON files landed under
    ``<landing>/<entity>/``, malformed lines included; else it is derived from
    the test tables. Of entries below ``<landing>/<entity>/`` that the last
    version of bronze has, and that are as they were, the rows are taken from
    there, with the time they were ingested at; only the others are parsed.
    Keys with ``hot_rows`` bookings, payments or redemptions
    are joined apart. At the end, versions that newer ones have replaced are
    deleted, and long histories of dimensions compacted.
    Returns ``{table: (layer, version, rows)}``.
    """
    with open_writers(spark, 2):  # a gated table and a dimension have two partitions
        store = SnapshotStore(spark, root) if root else SnapshotStore(spark, run_folder(spark, "lakehouse"), fresh=True)
        return _run_layers(spark, store, Tables(spark, sf_dir, ingested_at=ingested_at), ingested_at, as_of, landing, hot_rows)


def _run_layers(
    spark: SparkSession, store: SnapshotStore, source: Tables, ingested_at: str | None, as_of: str,
    landing: str | None, hot_rows: int,
) -> dict[str, tuple[str, int, int]]:
    layers = {name: layer for layer, name in LAYER_TABLES}
    writer = _LayerWriter(store)
    versions: dict[str, int] = {}
    report: dict[str, tuple[str, int, int]] = {}

    landed = {e: landed_entries(spark, landing, e) for e in ENTITIES if landing}
    bronze_of = (lambda e: landed_bronze(spark, store, landing, landed[e], ingested_at, e)) if landing else source.bronze
    bronze = writer.stage({f"bronze_{e}": partial(bronze_of, e) for e in ENTITIES})
    for entity, entries in landed.items():
        note_landed(spark, store, entity, writer.pending[f"bronze_{entity}"], entries)
    versions.update(writer.commit())

    held = {e: files.state(spark, store.path(f"bronze_{e}", versions[f"bronze_{e}"]))[1] for e in ENTITIES}
    large = [e for e, size in held.items() if size >= LARGE_TABLE]
    layer = Tables(spark, bronze_frames={e: bronze[f"bronze_{e}"] for e in ENTITIES})
    frames = {checked: partial(lambda e: checked_table(layer.bronze(e), e), entity) for checked, (entity, _, _) in GATED.items()}
    # fact_bookings is joined on booking_id by the payment and redemption facts:
    # buckets spare both joins a shuffle of the largest fact. The dedup leaves
    # the bookings in these buckets, so silver has them and the fact keeps them
    buckets = bucket_count(spark)
    in_buckets = ["checked_bookings"] if shuffled_into(spark, buckets) else []
    written = writer.stage(frames, partitions={checked: CHECKED_PARTITIONS for checked in GATED},
                           buckets={checked: (buckets, "booking_id") for checked in in_buckets}, in_buckets=in_buckets,
                           in_turn=[checked for checked, (entity, _, _) in GATED.items() if entity in large])
    cleaned: dict[str, DataFrame] = {}
    for checked, (_, valid_name, quarantine_name) in GATED.items():
        both = written[checked]
        cleaned[valid_name] = both.filter(F.col(VALID_FLAG)).drop(VALID_FLAG, FAILURES, CORRUPT)
        cleaned[quarantine_name] = both.filter(~F.col(VALID_FLAG)).drop(VALID_FLAG)
    versions.update(writer.commit())

    dims = writer.stage(
        {name: partial(next_dim_version, store, name, cleaned[f"silver_{entity}"], key, tracked, as_of)
         for name, (entity, key, tracked) in DIMENSIONS.items()},
        partitions={name: DIM_PARTITIONS for name in DIMENSIONS},
    )
    gold = Tables(spark, prebuilt={**cleaned, **dims}, hot_rows=hot_rows)
    fact_buckets = {"fact_bookings": (buckets, "booking_id")}
    for wave in (("fact_bookings", "fact_seat_occupancy"),
                 ("fact_payments", "gold_daily_revenue", "fact_promotion_redemptions", "gold_user_booking_summary"),
                 ("gold_promotion_performance",)):
        gold.__dict__.update(writer.stage({name: partial(getattr, gold, name) for name in wave}, buckets=fact_buckets,
                                          in_turn=[f"fact_{entity}" for entity in large]))
    versions.update(writer.commit())

    for name, version in versions.items():
        if name in DIMENSIONS and version % COMPACT_EVERY == 0:
            store.compact_history(name)
    store.vacuum()

    for name, version in versions.items():
        if name in GATED:
            _, valid_name, quarantine_name = GATED[name]
            valid = writer.valid_rows[name]
            report[valid_name] = (layers[valid_name], version, valid)
            report[quarantine_name] = (layers[quarantine_name], version, writer.rows[name] - valid)
        else:
            report[name] = (layers[name], version, writer.rows[name])
    return report


def landed_entries(spark: SparkSession, landing: str, entity: str) -> dict[str, list[int]]:
    """What lies directly below an entity's landing folder, by path, and its
    state; hidden entries don't count, as for Spark."""
    folder = f"{landing}/{entity}"
    return {f"{folder}/{n}": files.state(spark, f"{folder}/{n}") for n in files.names(spark, folder) if n[0] not in "._"}


def _landed_note(store: SnapshotStore, entity: str, version: int) -> str:
    return f"{store.root}/_landed/{entity}/{version:08d}.json"


def note_landed(spark: SparkSession, store: SnapshotStore, entity: str, version: int, entries: dict[str, list[int]]) -> None:
    """Keep beside a version of bronze which entries it has. A note counts once
    its version is committed; those of replaced versions go."""
    for old in files.names(spark, f"{store.root}/_landed/{entity}"):
        if not old.startswith(f"{version - 1:08d}"):
            files.delete(spark, f"{store.root}/_landed/{entity}/{old}")
    files.publish_text(spark, _landed_note(store, entity, version), json.dumps(entries))


def landed_bronze(
    spark: SparkSession, store: SnapshotStore, landing: str, entries: dict[str, list[int]], ingested_at: str | None, entity: str
) -> DataFrame:
    """Bronze of the lines of all landed ``entries``. Those that the last version
    has and that nobody has touched since are not parsed again: it is read
    instead."""
    table, known = f"bronze_{entity}", {}
    version = store.latest_version(table)
    if version and (note := _landed_note(store, entity, version)).rpartition("/")[2] in files.names(spark, note.rpartition("/")[0]):
        known = json.loads(files.read_text(spark, note))
    if any(entries.get(path) != state for path, state in known.items()):
        known = {}  # something was replaced or deleted
    new = [path for path in entries if path not in known]
    held = store.read(table) if known else None
    if held is not None and not new:
        return held
    paths = [re.sub(r"([][{}*?\\])", r"\\\1", path) for path in (entries if held is None else new)]
    lines = read_json(spark, paths or f"{landing}/{entity}/*", entity, keep_corrupt=True)
    rows = add_bronze_metadata(lines, entity, ingested_at)
    return rows if held is None else held.unionByName(rows)


def _row_counts(spark: SparkSession, report: dict[str, tuple[str, int, int]]) -> DataFrame:
    data = [(layer, name, rows) for name, (layer, _, rows) in report.items()]
    return spark.createDataFrame(data, "layer string, table_name string, row_count bigint")


def layer_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the layered build and report the rows written per table (K4)."""
    return _row_counts(spark, run_layers(spark, sf_dir))


# what lands first: the rows of an entity that are older than this
DELIVERY_SPLIT = {
    "users": "2024-01-02 00:00:00", "venues": "2024-01-02 00:00:00", "shows": "2024-01-02 00:00:00",
    "movies": "2024-01-01 00:30:00", "promotions": "2024-01-01 00:30:00", "seat_holds": "2024-01-16 00:00:00",
    "bookings": "1998-06-01 00:00:00", "payments": "1998-06-01 00:00:00", "promotion_redemptions": "1998-06-01 00:00:00",
}


def land_delivery(spark: SparkSession, sf_dir: str, entity: str, landing: str, delivery: int) -> None:
    """Land the older (1) or the newer (2) rows of an entity as JSON files."""
    older = F.coalesce(F.col("updated_at") < F.lit(DELIVERY_SPLIT[entity]).cast("timestamp_ntz"), F.lit(True))
    rows = Tables(spark, sf_dir).landed(entity).filter(older if delivery == 1 else ~older)
    write_json(rows, f"{landing}/{entity}/delivery-{delivery}")


def incremental_layer_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze to gold from landed files in two deliveries into one store: the
    second run sees late versions, dedups them against the first delivery and
    merges all three dimensions. Reports the rows that the tables then hold."""
    root = run_folder(spark, "two-deliveries")
    report: dict[str, tuple[str, int, int]] = {}
    for delivery, as_of in ((1, DIM_AS_OF), (2, MERGE_AS_OF)):
        with ThreadPoolExecutor(PARALLEL_TABLES) as pool:
            list(pool.map(lambda e: land_delivery(spark, sf_dir, e, f"{root}/landing", delivery), ENTITIES))
        report = run_layers(spark, sf_dir, f"{root}/store", as_of=as_of, landing=f"{root}/landing")
    # a dimension's version holds what its run changed: count what can be read
    store = SnapshotStore(spark, f"{root}/store")
    for dim in DIMENSIONS:
        layer, version, _ = report[dim]
        report[dim] = (layer, version, store.read_history(dim).count())
    return _row_counts(spark, report)
