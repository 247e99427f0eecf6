import os
import tempfile

import pytest
from pyspark.sql import functions as F

from lake_rows import rows, ts
from marquee.plans.catalog import INGESTED_AT, Tables
from marquee.plans.layered import incremental_dim_venue, upsert_scd2_dim
from marquee.session import run_folder
from marquee.sources import conform, files
from marquee.sources.landing import CORRUPT, read_json, write_json, write_with_cut_lines
from marquee.sources.snapshots import SnapshotStore
from marquee.streaming import runs

SF = "/root/testdata/sf0.001"


def _sorted(df, cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


def test_json_landing_round_trip_keeps_microseconds(spark):
    df = rows(spark, "seat_holds", [dict(hold_id=1, show_id=1, seat_no="A1", hold_status="HELD",
                                         updated_at=ts("2026-01-01T00:00:00.123456"))])
    path = run_folder(spark, "test-json")
    write_json(df, path)
    back = read_json(spark, path, "seat_holds").collect()[0]
    assert back.updated_at == ts("2026-01-01T00:00:00.123456")


@pytest.mark.parametrize("land", [write_json, lambda df, path: write_with_cut_lines(df, path, "payments")])
def test_landed_files_are_small_and_short(spark, land):
    path, plain = run_folder(spark, "test-size"), run_folder(spark, "test-plain")
    df = conform.landed(spark, SF, "payments").repartition(1)
    land(df, path)
    df.write.json(plain)
    size = lambda folder: sum(os.path.getsize(f"{folder}/{n}") for n in os.listdir(folder))
    assert size(path) * 4 < size(plain)
    assert sum(r[CORRUPT] is None for r in read_json(spark, path, "payments").collect()) == df.count()
    # a compressed file is one task's work, so it ends after so many lines
    many = run_folder(spark, "test-many")
    land(df.limit(3).crossJoin(spark.range(100_000).select()).coalesce(1), many)
    assert len([n for n in os.listdir(many) if n.startswith("part-")]) >= 2


def test_malformed_json_line_is_kept_as_corrupt_record(spark):
    folder = tempfile.mkdtemp(prefix="marquee-json-")
    with open(os.path.join(folder, "batch.json"), "w") as fh:
        fh.write('{"hold_id": 1, "show_id": 2, "seat_no": "A1", "hold_status": "HELD"}\n')
        fh.write('{"hold_id": 2, "show_id": \n')
        fh.write('{"hold_id": "x", "show_id": 3, "seat_no": "A2", "hold_status": "HELD"}\n')
    df = read_json(spark, folder, "seat_holds", keep_corrupt=True).cache()
    assert df.count() == 3
    assert df.filter(F.col(CORRUPT).isNotNull()).count() == 2  # malformed line and wrongly typed field
    # without the corrupt column the bad rows are silent
    plain = read_json(spark, folder, "seat_holds", keep_corrupt=False)
    assert plain.count() == 3
    assert plain.filter(F.col("seat_no").isNull()).count() == 1


def test_snapshot_store_versions(spark):
    store = SnapshotStore(spark, run_folder(spark, "test-store"))
    assert store.read("t") is None
    assert store.write(spark.range(3), "t") == 1
    assert store.write(spark.range(5), "t") == 2
    assert store.read("t").count() == 5
    assert store.read("t", 1).count() == 3


def test_incremental_dim_is_idempotent(spark):
    store = SnapshotStore(spark, run_folder(spark, "test-dim"))
    t = Tables(spark, SF)
    first = upsert_scd2_dim(store, "dim_venue", t.silver_venues, "venue_id", ["capacity"], "2024-06-01 00:00:00")
    second = upsert_scd2_dim(store, "dim_venue", t.venues_next_snapshot, "venue_id", ["capacity"], "2024-07-01 00:00:00")
    third = upsert_scd2_dim(store, "dim_venue", t.venues_next_snapshot, "venue_id", ["capacity"], "2024-08-01 00:00:00")
    assert first.count() == t.silver_venues.count()
    cols = second.columns
    assert _sorted(second, cols) == _sorted(third, cols)


def test_incremental_dim_equals_one_shot_merge(spark):
    cols = Tables(spark, SF).merged_dim("dim_venue").columns
    assert _sorted(incremental_dim_venue(spark, SF), cols) == _sorted(Tables(spark, SF).merged_dim("dim_venue"), cols)


def test_stream_state_equals_batch_silver(spark):
    state, quarantined = runs.stream_seat_state(spark, SF, INGESTED_AT, buckets=(3, 7))
    t = Tables(spark, SF)
    cols = t.silver_seat_holds.columns
    assert _sorted(state, cols) == _sorted(t.silver_seat_holds, cols)
    assert quarantined.count() == t.quarantine_seat_holds.count()


def test_stream_bronze_equals_batch_bronze(spark):
    bronze = runs.stream_bronze(spark, SF, "seat_holds", INGESTED_AT)
    batch = Tables(spark, SF).bronze("seat_holds")
    assert _sorted(bronze, batch.columns) == _sorted(batch, batch.columns)


def test_state_sink_batch_replay_is_idempotent(spark):
    from marquee import contracts as C
    from marquee.plans import silver
    from marquee.streaming.state import LatestStateSink

    root = run_folder(spark, "test-sink")
    sink = LatestStateSink(spark, f"{root}/state", f"{root}/q", C.KEYS["seat_holds"],
                           C.version_order("seat_holds"), silver.SEAT_HOLD_RULES, buckets=4)
    b0 = rows(spark, "seat_holds", [
        dict(hold_id=1, show_id=1, seat_no="A1", hold_status="HELD", updated_at=ts("2026-01-01T00:00:00")),
        dict(hold_id=2, show_id=1, seat_no="A1", hold_status="BOOKED", updated_at=ts("2026-01-01T00:01:00")),
        dict(hold_id=3, show_id=2, seat_no="B1", hold_status="HELD", updated_at=ts("2026-01-01T00:00:00")),
        dict(hold_id=4, show_id=None, seat_no="B2", hold_status="HELD", updated_at=ts("2026-01-01T00:00:00")),
    ])
    b1 = rows(spark, "seat_holds", [
        dict(hold_id=5, show_id=1, seat_no="A1", hold_status="RELEASED", updated_at=ts("2026-01-01T00:00:30")),
        dict(hold_id=6, show_id=2, seat_no="B1", hold_status="EXPIRED", updated_at=ts("2026-01-02T00:00:00")),
    ])
    sink(b0, 0)
    sink(b1, 1)
    first = _sorted(sink.read(), ["show_id", "seat_no", "hold_status"])
    sink(b1, 1)  # replayed after its commit
    assert _sorted(sink.read(), ["show_id", "seat_no", "hold_status"]) == first
    # an attempt that wrote a bucket and never committed: not read, and cleared by the replay
    _, version, _, _ = sink.committed()
    junk = spark.createDataFrame([(9, 9, "Z9", 1, "BOOKED", None, None, 0)],
                                 "hold_id long, show_id long, seat_no string, user_id long, hold_status string, "
                                 "held_at timestamp_ntz, updated_at timestamp_ntz, state_bucket int")
    junk.write.partitionBy("state_bucket").parquet(f"{root}/state/data/state_version={version + 1}")
    assert _sorted(sink.read(), ["show_id", "seat_no", "hold_status"]) == first
    b2 = rows(spark, "seat_holds", [dict(hold_id=7, show_id=3, seat_no="C1", hold_status="HELD", updated_at=ts("2026-01-03T00:00:00"))])
    resized = LatestStateSink(spark, f"{root}/state", f"{root}/q", C.KEYS["seat_holds"],
                              C.version_order("seat_holds"), silver.SEAT_HOLD_RULES, buckets=9)
    resized(b2, 2)
    assert resized.committed()[2] == 4  # the stored number of buckets
    assert _sorted(resized.read(), ["show_id", "seat_no", "hold_status"]) == sorted([*first, (3, "C1", "HELD")], key=str)
    assert first == [(1, "A1", "BOOKED"), (2, "B1", "EXPIRED")]
    assert sink.read_quarantine().count() == 1


def test_second_run_without_new_data_changes_no_dimension(spark):
    from marquee.plans.layered import run_layers

    root = run_folder(spark, "test-two-runs")
    first = run_layers(spark, SF, root)
    second = run_layers(spark, SF, root, as_of="2024-07-01 00:00:00")
    assert first == {k: (layer, v - 1, n) for k, (layer, v, n) in second.items()}  # same rows, next version
    store = SnapshotStore(spark, root)
    for dim in ("dim_venue", "dim_show", "dim_user"):
        v1, v2 = store.read_history(dim, 1), store.read_history(dim, 2)
        cols = [c for c in v1.columns if c != "_ingested_at"]
        assert _sorted(v1, cols) == _sorted(v2, cols)


def test_malformed_lines_are_quarantined_not_deduped(spark):
    from marquee.plans import silver

    folder = tempfile.mkdtemp(prefix="marquee-json-")
    with open(os.path.join(folder, "batch.json"), "w") as fh:
        fh.write('{"hold_id": 1, "show_id": 2, "seat_no": "A1", "hold_status": "HELD", '
                 '"updated_at": "2026-01-01T00:00:00.000000"}\n')
        fh.write('{"hold_id": 2, "show_id": 2, "seat_no": "A1", "hold_status": "RELEA\n')
    df = read_json(spark, folder, "seat_holds", keep_corrupt=True)
    latest, quarantined = silver.clean_seat_holds(df)
    assert [r.hold_status for r in latest.collect()] == ["HELD"]
    assert CORRUPT not in latest.columns
    q = quarantined.collect()
    assert len(q) == 1 and q[0]._dq_failures == "record_parsed" and q[0][CORRUPT].startswith('{"hold_id": 2')


def test_a_shared_folder_is_asked_for_on_a_cluster(monkeypatch, spark):
    from marquee import session

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(type("Session", (), {"sparkContext": Context()})())


def test_staged_leftovers_of_a_failed_attempt_are_not_published(spark):
    root = run_folder(spark, "test-stage")
    frame = spark.createDataFrame([(1, True), (2, False)], "k long, is_current boolean")
    SnapshotStore(spark, root).stage(frame, "t", ["is_current"])
    store = SnapshotStore(spark, root)
    store.write(frame.where("is_current"), "t", ["is_current"])
    assert [r.k for r in SnapshotStore(spark, root).read("t").collect()] == [1]


def test_vacuum_keeps_two_versions_and_all_history(spark):
    store = SnapshotStore(spark, run_folder(spark, "test-vacuum"))
    for n in range(1, 5):
        store.write(spark.createDataFrame([(n,)], "k long"), "t")
        # every version closes the row that the one before had open
        closed = [(n - 1, False)] if n > 1 else []
        store.write(spark.createDataFrame([*closed, (n, True)], "k long, is_current boolean"), "dim", ["is_current"])
    store.vacuum()
    again = SnapshotStore(spark, store.root)
    assert [r.k for r in again.read("t").collect()] == [4] and [r.k for r in again.read("t", 3).collect()] == [3]
    assert [n for n in files.names(spark, f"{store.root}/t") if n.startswith("v=")] == ["v=00000003", "v=00000004"]
    history = sorted((r.k, r.is_current) for r in again.read_history("dim").collect())
    assert history == [(1, False), (2, False), (3, False), (4, True)]
    # brought together: earlier versions are read no more, and go
    version = again.compact_history("dim")
    for store_ in (again, SnapshotStore(spark, store.root)):
        assert sorted((r.k, r.is_current) for r in store_.read_history("dim").collect()) == history
    again.vacuum(keep=1)
    assert [n for n in files.names(spark, f"{store.root}/dim") if n.startswith("v=")] == [f"v={version:08d}"]
    again.write(spark.createDataFrame([(4, False), (5, True)], "k long, is_current boolean"), "dim", ["is_current"])
    later = SnapshotStore(spark, store.root).read_history("dim").collect()
    assert sorted((r.k, r.is_current) for r in later) == [*history[:3], (4, False), (5, True)]


def test_many_commit_records_become_one(spark, monkeypatch):
    from marquee.sources import snapshots

    monkeypatch.setattr(snapshots, "LOG_FILES", 3)
    store = SnapshotStore(spark, run_folder(spark, "test-log"))
    for n in range(5):
        store.write(spark.createDataFrame([(n,)], "k long"), f"t{n % 2}")
    store.vacuum()
    assert len([n for n in files.names(spark, f"{store.root}/_log") if n.endswith(".parquet")]) == 1
    again = SnapshotStore(spark, store.root)
    assert [again.latest_version(t) for t in ("t0", "t1")] == [3, 2] and [r.k for r in again.read("t0").collect()] == [4]
