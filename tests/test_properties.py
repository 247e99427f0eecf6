"""Property checks against small pure-Python models on generated rows."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from marquee.operators import scd2
from marquee.operators.cdc import latest_by_key
from marquee.operators.quality import Rule, gate

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.one_of(st.none(), st.integers(0, 4))
small = st.one_of(st.none(), st.integers(0, 3))
version_rows = st.lists(st.tuples(keys, small, small), max_size=25)


def _desc_nulls_last(v):
    return (v is not None, v if v is not None else 0)


@SETTINGS
@given(version_rows, st.sampled_from(["aggregate", "window"]))
def test_latest_by_key_matches_model(spark, data, method):
    df = spark.createDataFrame(data, "k int, t int, v int")
    got = sorted(map(tuple, latest_by_key(df, ["k"], ["t", "v"], null_keys="bypass", method=method).collect()),
                 key=str)
    best = {}
    for k, t, v in data:
        if k is None:
            continue
        if k not in best or (_desc_nulls_last(t), _desc_nulls_last(v)) > (_desc_nulls_last(best[k][1]), _desc_nulls_last(best[k][2])):
            best[k] = (k, t, v)
    expected = sorted(list(best.values()) + [r for r in data if r[0] is None], key=str)
    assert got == expected


@SETTINGS
@given(st.lists(st.tuples(small, small), max_size=25))
def test_gate_partitions_every_row(spark, data):
    df = spark.createDataFrame(data, "a int, b int")
    rules = [Rule("a_positive", "a > 0"), Rule("b_present", "b IS NOT NULL")]
    valid, quarantined = gate(df, rules)
    got_valid = sorted(map(tuple, valid.collect()), key=str)
    got_q = sorted(((r.a, r.b, r._dq_failures) for r in quarantined.collect()), key=str)
    exp_valid, exp_q = [], []
    for a, b in data:
        fails = [n for n, ok in (("a_positive", a is not None and a > 0), ("b_present", b is not None)) if not ok]
        (exp_q.append((a, b, ",".join(fails))) if fails else exp_valid.append((a, b)))
    assert got_valid == sorted(exp_valid, key=str)
    assert got_q == sorted(exp_q, key=str)


snapshots = st.dictionaries(st.integers(0, 6), st.one_of(st.none(), st.integers(0, 2)), max_size=6)


@SETTINGS
@given(snapshots, snapshots, st.sampled_from(["keep", "close"]))
def test_scd2_merge_matches_model(spark, first, second, on_missing):
    t1, t2 = "2026-01-01 00:00:00", "2026-02-01 00:00:00"
    schema = "id int, cap int"
    dim = scd2.bootstrap(spark.createDataFrame(sorted(first.items()), schema), t1)
    merged = scd2.merge(dim, spark.createDataFrame(sorted(second.items()), schema), "id", ["cap"], t2, on_missing)
    got = sorted(((r.id, r.cap, str(r.effective_start), str(r.effective_end) if r.effective_end else None,
                   r.is_current) for r in merged.collect()), key=str)
    s1, s2 = "2026-01-01 00:00:00", "2026-02-01 00:00:00"
    expected = []
    for k, cap in first.items():
        if k not in second:
            expected.append((k, cap, s1, s2, False) if on_missing == "close" else (k, cap, s1, None, True))
        elif second[k] != cap:
            expected += [(k, cap, s1, s2, False), (k, second[k], s2, None, True)]
        else:
            expected.append((k, cap, s1, None, True))
    expected += [(k, cap, s2, None, True) for k, cap in second.items() if k not in first]
    assert got == sorted(expected, key=str)
    assert scd2.duplicate_current_keys(merged, "id").count() == 0
