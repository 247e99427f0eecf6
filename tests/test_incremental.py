"""Tables that change in place: bucketed upserts, live counts, deliveries."""

from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from lake_rows import rows, ts
from marquee.plans import layered
from marquee.plans.catalog import INGESTED_AT, Tables
from marquee.session import run_folder
from marquee.sources import files
from marquee.sources.buckets import BucketStore
from marquee.sources.landing import CORRUPT, write_json
from marquee.sources.snapshots import SnapshotStore
from marquee.streaming import runs
from marquee.streaming.incremental import Incremental

SF = "/root/testdata/sf0.001"


def sums(both):
    return both.groupBy("state_bucket", "k").agg(F.sum("n").alias("n"))


def put(spark, store, data, note=-1, table="t"):
    change = store.change()
    frame = spark.createDataFrame(data, "k long, n long")
    old, new = change.merge(table, frame, ["k"], sums, 4)
    return old, new, change.commit(note)


def as_dict(df):
    return {r.k: r.n for r in df.collect()}


# --- the bucketed tables ----------------------------------------------------------


def test_merge_rewrites_touched_buckets_only(spark):
    store = BucketStore(spark, run_folder(spark, "test-buckets"))
    assert store.read("t") is None
    put(spark, store, [(k, 1) for k in range(20)])
    first = store.manifest()
    old, new, second = put(spark, store, [(3, 5)])
    assert as_dict(old).items() <= {k: 1 for k in range(20)}.items() and as_dict(new)[3] == 6
    moved = {b for b, v in second.versions("t").items() if v != first.versions("t")[b]}
    assert len(moved) == 1 and len(first.versions("t")) == 4
    assert as_dict(store.read("t")) == {k: 6 if k == 3 else 1 for k in range(20)}


def test_nothing_grows_with_the_number_of_commits(spark):
    store = BucketStore(spark, run_folder(spark, "test-age"))
    put(spark, store, [(k, 1) for k in range(20)])
    for n in range(6):
        put(spark, store, [(3, 1)], note=n)
    assert as_dict(store.read("t"))[3] == 7
    assert len([n for n in files.names(spark, f"{store.root}/manifests") if n.endswith(".json")]) == 2
    # the first version's other buckets, what the last commit replaced, and what it wrote
    assert len(files.names(spark, f"{store.root}/t")) == 3
    held = store.manifest()
    kept = {f"{store.root}/t/state_version={v}/state_bucket={b}" for b, v in held.versions("t").items()} | set(held.replaced)
    on_disk = {f"{store.root}/t/{v}/{b}" for v in files.names(spark, f"{store.root}/t")
               for b in files.names(spark, f"{store.root}/t/{v}") if b.startswith("state_bucket")}
    assert on_disk == kept


def test_the_previous_state_stays_readable_for_one_commit(spark):
    store = BucketStore(spark, run_folder(spark, "test-grace"))
    put(spark, store, [(1, 1)])
    before = store.read("t")
    put(spark, store, [(1, 1)])
    assert as_dict(before) == {1: 1} and as_dict(store.read("t")) == {1: 2}


def test_a_change_without_commit_is_not_seen_and_its_leftovers_go(spark):
    store = BucketStore(spark, run_folder(spark, "test-broken"))
    put(spark, store, [(1, 1)])
    broken = store.change()
    broken.merge("t", spark.createDataFrame([(1, 50), (2, 60)], "k long, n long"), ["k"], sums, 4)
    broken.merge("u", spark.createDataFrame([(9, 9)], "k long, n long"), ["k"], sums, 4)
    assert as_dict(store.read("t")) == {1: 1} and store.read("u") is None
    put(spark, store, [(1, 2)])
    assert as_dict(store.read("t")) == {1: 3}


def test_tables_of_one_change_appear_together(spark):
    store = BucketStore(spark, run_folder(spark, "test-both"))
    change = store.change()
    for table in ("t", "u"):
        change.merge(table, spark.createDataFrame([(1, 1)], "k long, n long"), ["k"], sums, 2)
    change.commit()
    assert as_dict(store.read("t")) == as_dict(store.read("u")) == {1: 1}


def test_a_change_without_rows_changes_nothing(spark):
    store = BucketStore(spark, run_folder(spark, "test-empty"))
    put(spark, store, [])
    assert store.read("t").count() == 0
    put(spark, store, [(1, 1)])
    _, _, last = put(spark, store, [], note=7)
    assert as_dict(store.read("t")) == {1: 1} and last.note == 7


def test_two_writers_cannot_both_commit(spark):
    store = BucketStore(spark, run_folder(spark, "test-race"))
    one, two = store.change(), store.change()
    one.commit()
    with pytest.raises(FileExistsError):
        two.commit()


# --- live occupancy ---------------------------------------------------------------


def hold(i, show, seat, status, minute):
    return dict(hold_id=i, show_id=show, seat_no=seat, hold_status=status, updated_at=ts(f"2026-01-01T00:{minute:02}:00"))


def test_live_counts_follow_every_batch(spark):
    sink = runs.seat_sink(spark, run_folder(spark, "test-live"), buckets=4)
    seen = []
    batches = [
        [hold(1, 1, "A", "HELD", 1), hold(2, 1, "B", "BOOKED", 1), hold(3, 2, "A", "HELD", 1), hold(4, 3, "A", "RELEASED", 1)],
        # released, rebooked late, an old event that changes nothing, an unknown status
        [hold(5, 1, "A", "RELEASED", 3), hold(6, 3, "A", "BOOKED", 2), hold(7, 2, "A", "EXPIRED", 0), hold(8, 2, "B", "WHAT", 9)],
        [hold(9, 1, "A", "HELD", 2), hold(10, 2, "A", "EXPIRED", 5), hold(11, 2, "A", "EXPIRED", 5)],
        [],
    ]
    for i, batch in enumerate(batches):
        seen += batch
        sink(rows(spark, "seat_holds", batch), i)
        sink(rows(spark, "seat_holds", batch), i)  # delivered again
        state = sink.read()
        want = {r.show_id: r.n for r in state.groupBy("show_id").agg(
            F.count_if(F.col("hold_status").isin("HELD", "BOOKED")).alias("n")).collect() if r.n}
        got = {r.show_id: r.n for r in sink.read_live("occupancy").collect() if r.n}
        assert got == want
    assert got == {1: 1, 3: 1}


def test_live_occupancy_equals_the_batch_fact_after_each_delivery(spark):
    root = run_folder(spark, "test-occupancy")
    sink, tables = runs.seat_sink(spark, root), Tables(spark, SF)
    landed = None
    for i, part in enumerate(runs.deliveries(tables.landed("seat_holds"))):
        landed = part if landed is None else landed.unionByName(part)
        write_json(part, f"{root}/landing/delivery-{i}")
        runs.run_seat_stream(spark, root, sink, INGESTED_AT)
        batch = Tables(spark, SF, bronze_frames={"seat_holds": landed.withColumns(
            {"_ingested_at": F.lit(INGESTED_AT).cast("timestamp_ntz"), "_source_system": F.lit("seat_lock_service")})})
        want = batch.fact_seat_occupancy
        got = runs.live_occupancy(sink, tables.dim_show, tables.dim_venue)
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


# --- deliveries -------------------------------------------------------------------


def test_silver_follows_a_small_delivery_at_its_cost(spark):
    root = run_folder(spark, "test-lake")
    lake = Incremental(spark, root, buckets=16)
    layered.land_delivery(spark, SF, "payments", f"{root}/landing", 1)
    lake.run(f"{root}/landing", INGESTED_AT, ["payments"])
    before = set(lake.bucket_folders("payments"))
    # one payment changes: one bucket is written, the others stay where they are
    newest = lake.silver("payments").orderBy("payment_id").limit(1).collect()[0]
    changed = rows(spark, "payments", [dict(newest.asDict(), amount=1.25, payment_status=" refunded ", updated_at=ts("2030-01-01T00:00:00"))])
    write_json(changed, f"{root}/landing/payments/delivery-9")
    lake.run(f"{root}/landing", "2024-06-02 00:00:00", ["payments"])
    after = set(lake.bucket_folders("payments"))
    assert len(before) == 16 and len(before - after) == 1
    (row,) = lake.silver("payments").where(f"payment_id = {newest.payment_id}").collect()
    assert (row.amount, row.payment_status) == (1.25, "REFUNDED")
    # a run without new files changes nothing
    lake.run(f"{root}/landing", "2024-06-03 00:00:00", ["payments"])
    assert set(lake.bucket_folders("payments")) == after
    # bronze has every line, by ingest date, and reads one date's folders only
    assert lake.bronze("payments").count() == Tables(spark, SF).landed("payments").where("updated_at < '1998-06-01'").count() + 1
    one_day = lake.bronze("payments", "2024-06-02")
    assert [r.amount for r in one_day.collect()] == [1.25]
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_ingest_date" in plan and "_ingest_date#" in plan


def test_a_batch_is_parsed_once_and_held_nowhere(spark):
    """An attempt that breaks off, and its repetition on the next day."""
    root = run_folder(spark, "test-attempts")
    lake = Incremental(spark, root, buckets=2)
    lines = [dict(payment_id=i % 3, booking_id=1, amount=float(i), payment_status="paid", updated_at=ts(f"2024-01-01T00:00:{i:02d}"))
             for i in range(9)] + [dict(payment_id=None, amount=1.0, updated_at=ts("2024-01-01T00:00:00"))]
    parsed = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(amount):
        parsed.add(1)
        return amount

    batch = rows(spark, "payments", lines).withColumns({"amount": counted.asNondeterministic()("amount"), CORRUPT: F.lit(None).cast("string"),
                                                        "_source_system": F.lit("007")})
    store, held = lake.store("payments"), len(spark.sparkContext._jsc.getPersistentRDDs())
    lake.store = lambda _: Broken(store)
    with pytest.raises(RuntimeError):
        lake._apply("payments", batch.withColumn("_ingested_at", F.lit("2024-06-01").cast("timestamp_ntz")), 0)
    del lake.store
    assert parsed.value == len(lines)
    lake._apply("payments", batch.withColumn("_ingested_at", F.lit("2024-06-02").cast("timestamp_ntz")), 0)
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == held
    assert lake.bronze("payments").count() == len(lines) and lake.quarantine("payments").count() == 1
    assert {(r.payment_id, r.amount, r._source_system) for r in lake.silver("payments").collect()} == {(0, 6.0, "007"), (1, 7.0, "007"), (2, 8.0, "007")}


class Broken:
    """A store whose changes are never committed."""

    def __init__(self, store):
        self.store = store

    def change(self):
        change = self.store.change()

        def commit(note):
            raise RuntimeError("broken off")

        change.commit = commit
        return change


def test_a_bucket_is_the_work_of_many_tasks(spark):
    store = BucketStore(spark, run_folder(spark, "test-tasks"))
    aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        change = store.change()
        change.merge("t", spark.range(1000).selectExpr("id AS k", "id AS n"), ["k"], sums, 1)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", aqe)
    change.commit()
    (folder,) = [store._folder("t", v, b) for b, v in store.manifest().versions("t").items()]
    assert len([n for n in files.names(spark, folder) if n.endswith(".parquet")]) > 1
    assert as_dict(store.read("t")) == {k: k for k in range(1000)}


@pytest.mark.parametrize("entity", ["bookings", "seat_holds", "users"])
def test_two_deliveries_give_what_one_pass_gives(spark, entity):
    root = run_folder(spark, "test-two")
    lake = Incremental(spark, root, buckets=3)
    for n in (2, 1):  # the newer rows first
        layered.land_delivery(spark, SF, entity, f"{root}/landing", n)
        lake.run(f"{root}/landing", INGESTED_AT, [entity])
    tables = Tables(spark, SF)
    silver, quarantine = tables.table(f"silver_{entity}"), tables.table(f"quarantine_{entity}")
    assert sorted(map(str, lake.silver(entity).select(*silver.columns).collect())) == sorted(map(str, silver.collect()))
    got = lake.quarantine(entity).select(*quarantine.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, quarantine.collect()))


def test_malformed_lines_are_rejects_and_stay_in_bronze(spark):
    root = run_folder(spark, "test-rejects")
    line = '{"user_id": 1, "name": "n", "updated_at": "2026-01-01T00:00:00.000000"}'
    spark.createDataFrame([(line,), (line[:40],), (line.replace("1,", "null,", 1),)], "value string").write.text(f"{root}/landing/users/d1")
    lake = Incremental(spark, root)
    lake.run(f"{root}/landing", INGESTED_AT, ["users"])
    assert lake.bronze("users").count() == 3 and lake.silver("users").count() == 1
    rejected = {r._dq_failures: r[CORRUPT] for r in lake.quarantine("users").collect()}
    assert rejected == {"record_parsed": line[:40], "user_id_present": None}


# --- layered runs -----------------------------------------------------------------


def test_a_merge_is_sorted_by_the_key_alone(spark):
    """A key has one bucket; sorted by bucket first, rows would be compared whole."""
    lake, seen = Incremental(spark, run_folder(spark, "test-sort"), buckets=4), []
    store = lake.store("payments")

    class Watched:
        def change(self):
            change = store.change()
            merge = change.merge

            def watched(table, rows, keys, combine, buckets):
                def kept(both):
                    seen.append(combine(both))
                    return seen[-1]

                return merge(table, rows, keys, kept, buckets)

            change.merge = watched
            return change

    lake.store = lambda _: Watched()
    batch = rows(spark, "payments", [dict(payment_id=i % 3, amount=float(i), updated_at=ts(f"2024-01-01T00:00:{i:02d}")) for i in range(9)])
    batch = batch.withColumns({CORRUPT: F.lit(None).cast("string"), "_source_system": F.lit("s"), "_ingested_at": F.lit("2024-06-01").cast("timestamp_ntz")})
    lake._apply("payments", batch, 0)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "Sort [payment_id" in plan and "Sort [state_bucket" not in plan
    assert sorted((r.payment_id, r.amount) for r in store.read("newest").collect()) == [(0, 6.0), (1, 7.0), (2, 8.0)]


def test_landed_entries_are_parsed_once(spark):
    """Bronze of a later run reads the last version and the new entries; all of
    them if one has changed."""
    root = run_folder(spark, "test-landed")
    line = lambda i, day: dict(user_id=i, name=f"n{i}", updated_at=ts(f"2024-01-{day:02}T00:00:00"))
    store = SnapshotStore(spark, f"{root}/store")

    def run():
        entries = layered.landed_entries(spark, f"{root}/landing", "users")
        bronze = layered.landed_bronze(spark, store, f"{root}/landing", entries, None, "users")
        parsed = {unquote(name).rpartition("/")[0].rpartition("/")[2] for name in bronze.inputFiles() if ".json" in name}
        version = store.stage(bronze, "bronze_users")
        layered.note_landed(spark, store, "users", version, entries)
        store.commit({"bronze_users": version})
        return parsed, sorted((r.user_id, r.name) for r in store.read("bronze_users").collect())

    write_json(rows(spark, "users", [line(1, 1), line(2, 1)]), f"{root}/landing/users/delivery-1")
    assert run() == ({"delivery-1"}, [(1, "n1"), (2, "n2")])
    write_json(rows(spark, "users", [line(1, 2)]), f"{root}/landing/users/delivery [2]")
    assert run() == ({"delivery [2]"}, [(1, "n1"), (1, "n1"), (2, "n2")])
    assert run() == (set(), [(1, "n1"), (1, "n1"), (2, "n2")])
    files.delete(spark, f"{root}/landing/users/delivery-1")
    write_json(rows(spark, "users", [line(3, 1)]), f"{root}/landing/users/delivery-1")
    assert run() == ({"delivery-1", "delivery [2]"}, [(1, "n1"), (3, "n3")])
    # an attempt that was never committed leaves nothing that counts
    entries = layered.landed_entries(spark, f"{root}/landing", "users")
    write_json(rows(spark, "users", [line(4, 1)]), f"{root}/landing/users/delivery-3")
    layered.note_landed(spark, store, "users", 5, layered.landed_entries(spark, f"{root}/landing", "users"))
    again = layered.landed_bronze(spark, SnapshotStore(spark, f"{root}/store"), f"{root}/landing",
                                  layered.landed_entries(spark, f"{root}/landing", "users"), None, "users")
    assert again.count() == 3 and len(entries) == 2


def test_bookings_are_dealt_to_their_buckets_by_the_dedup(spark):
    """Silver's bookings lie in the buckets that fact_bookings has, one file
    each, so neither table is shuffled for them; another store finds them."""
    root = run_folder(spark, "test-dealt")
    report = layered.run_layers(spark, SF, root)
    n = layered.bucket_count(spark)
    for folder in ("checked_bookings/v=00000001/_dq_valid=true", "fact_bookings/v=00000001"):
        assert 1 < len([f for f in files.names(spark, f"{root}/{folder}") if f.endswith(".parquet")]) <= n
    key = "spark.sql.maxConcurrentOutputFileWriters"
    assert spark.conf.get(key, "0") == "0"  # as it was
    # as another process would open it: the catalog doesn't know the table
    spark.sql(f"DROP TABLE {SnapshotStore(spark, root)._name('checked_bookings', 1)}")
    held = SnapshotStore(spark, root).read("checked_bookings", partition_types=layered.CHECKED_PARTITIONS)
    assert held.where("_dq_valid").count() == report["silver_bookings"][2]
    assert held.where("NOT _dq_valid").count() == report["quarantine_bookings"][2] > 0
    want = layered.checked_table(Tables(spark, SF).bronze("bookings"), "bookings")
    columns = [c for c in want.columns if c != "_ingested_at"]
    assert sorted(map(str, held.select(*columns).collect())) == sorted(map(str, want.select(*columns).collect()))
