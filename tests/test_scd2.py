import pytest
from pyspark.sql import functions as F

from marquee.operators import scd2

T1, T2, T3 = "2026-01-01 00:00:00", "2026-02-01 00:00:00", "2026-03-01 00:00:00"


def _venues(spark, data):
    return spark.createDataFrame(data, "venue_id long, venue_name string, capacity int")


def _by_key(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.venue_id, []).append(r)
    return out


def test_bootstrap_sets_current_flag(spark):
    r = scd2.bootstrap(spark.createDataFrame([(1, "Alice")], "user_id long, name string"), T1).collect()[0]
    assert r.is_current is True and r.effective_end is None and str(r.effective_start) == "2026-01-01 00:00:00"


def test_a_tracked_change_ends_one_version_and_opens_another(spark):
    dim = scd2.bootstrap(_venues(spark, [(41, "Odeon", 320), (42, "Rex", 75), (43, "Lux", 60)]), T1)
    merged = scd2.merge(dim, _venues(spark, [(43, "Lux", 60), (42, "Rex Royal", 75), (41, "Odeon", 290)]), "venue_id",
                        ["capacity", "venue_name"], T2)
    spans = {k: sorted((str(r.effective_start)[:7], str(r.effective_end)[:7], r.capacity, r.venue_name, r.is_current) for r in v)
             for k, v in _by_key(merged).items()}
    assert spans == {
        41: [("2026-01", "2026-02", 320, "Odeon", False), ("2026-02", "None", 290, "Odeon", True)],
        42: [("2026-01", "2026-02", 75, "Rex", False), ("2026-02", "None", 75, "Rex Royal", True)],
        43: [("2026-01", "None", 60, "Lux", True)],
    }
    assert merged.columns == dim.columns


def test_a_snapshot_with_a_key_twice_fails_and_rows_without_key_are_ignored(spark):
    dim = scd2.bootstrap(_venues(spark, [(41, "Odeon", 320)]), T1)
    with pytest.raises(Exception, match="several rows for venue_id 41"):
        scd2.merge(dim, _venues(spark, [(41, "Odeon", 1), (41, "Odeon", 2)]), "venue_id", ["capacity"], T2).collect()
    out = scd2.merge(dim, _venues(spark, [(41, "Odeon", 320), (None, "Ghost", 5)]), "venue_id", ["capacity"], T2)
    assert [r.venue_id for r in out.collect()] == [41]


def test_absent_keys_are_kept_or_closed(spark):
    dim = scd2.bootstrap(_venues(spark, [(1, "A", 100), (2, "B", 200)]), T1)
    src = _venues(spark, [(1, "A", 100), (3, "C", 300)])
    kept = _by_key(scd2.merge(dim, src, "venue_id", ["capacity"], T2))
    assert kept[2][0].is_current and kept[3][0].is_current
    closed = _by_key(scd2.merge(dim, src, "venue_id", ["capacity"], T2, on_missing="close"))
    assert not closed[2][0].is_current and str(closed[2][0].effective_end) == "2026-02-01 00:00:00"


def test_null_tracked_values_compare_null_safe(spark):
    dim = scd2.bootstrap(_venues(spark, [(1, None, None)]), T1)
    same = scd2.merge(dim, _venues(spark, [(1, None, None)]), "venue_id", ["capacity", "venue_name"], T2)
    assert same.count() == 1
    changed = scd2.merge(dim, _venues(spark, [(1, None, 5)]), "venue_id", ["capacity", "venue_name"], T2)
    assert changed.count() == 2


def test_untracked_change_keeps_open_version(spark):
    dim = scd2.bootstrap(_venues(spark, [(1, "Old name", 100)]), T1)
    out = scd2.merge(dim, _venues(spark, [(1, "New name", 100)]), "venue_id", ["capacity"], T2).collect()
    assert [(r.venue_name, r.is_current) for r in out] == [("Old name", True)]


def test_remerge_is_idempotent_and_history_is_sound(spark):
    dim = scd2.bootstrap(_venues(spark, [(i, f"V{i}", 100) for i in range(20)]), T1)
    snap2 = _venues(spark, [(i, f"V{i}", 100 + (60 if i % 3 == 0 else 0)) for i in range(20)])
    m2 = scd2.merge(dim, snap2, "venue_id", ["capacity"], T2)
    again = scd2.merge(m2, snap2, "venue_id", ["capacity"], T3)
    cols = m2.columns
    assert sorted(map(tuple, again.select(cols).collect()), key=str) == sorted(map(tuple, m2.collect()), key=str)
    assert scd2.duplicate_current_keys(again, "venue_id").count() == 0
    # versions of one key do not overlap
    a, b = again.alias("a"), again.alias("b")
    overlaps = a.join(b, (F.col("a.venue_id") == F.col("b.venue_id")) & (F.col("a.effective_start") < F.col("b.effective_start"))
                      & (F.col("a.effective_end").isNull() | (F.col("a.effective_end") > F.col("b.effective_start"))))
    assert overlaps.count() == 0


def test_merge_uses_one_join(spark, capsys):
    dim = scd2.bootstrap(_venues(spark, [(1, "A", 100)]), T1)
    scd2.merge(dim, _venues(spark, [(1, "A", 160)]), "venue_id", ["capacity"], T2).explain()
    plan = capsys.readouterr().out
    assert plan.count("FullOuter") == 1
