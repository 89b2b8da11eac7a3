from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orelake.operators.history import (
    apply_changes,
    empty_history,
    scd2_apply,
    scd2_from_log,
    table_changes,
    upsert,
)

STATE = "K long, V string, N long"
FEED = STATE + ", _action string, _is_update boolean"
T = [datetime(2024, 1, d) for d in range(1, 9)]
OPEN = datetime(9999, 12, 31)


def versions(history):
    got = [(r.K, r.V, r.EFFECTIVE_FROM, r.EFFECTIVE_TO, r.IS_CURRENT, r.DML_TYPE) for r in history.collect()]
    return sorted(got, key=lambda v: (v[0], v[2], v[3]))


def run(spark, *batches):
    h = empty_history(spark.createDataFrame([], STATE))
    for at, rows in zip(T, batches):
        feed = spark.createDataFrame(rows, FEED + (", _commit long" if rows and len(rows[0]) == 6 else ""))
        h = scd2_apply(h, feed, "K", at)
    return h


def numbered(commits):
    return [(*image, n) for n, images in enumerate(commits) for image in images]


def ins(k, v, n=0):
    return (k, v, n, "INSERT", False)


def upd(k, old, new):
    return [(k, old, 0, "DELETE", True), (k, new, 0, "INSERT", True)]


def dele(k, v):
    return (k, v, 0, "DELETE", False)


def test_changes_between_states(spark, collect):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, None, None)], STATE)
    new = spark.createDataFrame([(2, "b", 2), (3, None, None), (4, "d", 4)], STATE)
    feed = table_changes(old, new, "K")
    assert collect(feed) == [
        (1, "a", 1, "DELETE", False), (2, "b", None, "DELETE", True), (2, "b", 2, "INSERT", True), (4, "d", 4, "INSERT", False),
    ]
    assert collect(apply_changes(old, feed, "K")) == collect(new)
    assert table_changes(old.limit(0), new, "K", initial_rows=False).count() == 0
    assert table_changes(old.limit(0), new, "K").count() == 3


def test_insert_update_delete(spark):
    h = run(spark, [ins(1, "a"), ins(2, "b")], upd(1, "a", "A"), [dele(2, "b")])
    assert versions(h) == [
        (1, "a", T[0], T[1], False, "INSERT"),
        (1, "A", T[1], OPEN, True, "UPDATE"),
        (2, "b", T[0], T[2], False, "DELETE"),
    ]
    ids = [r.SURROGATE_KEY for r in h.collect()]
    assert len(set(ids)) == 3 and min(ids) >= 1
    first = [r.SURROGATE_KEY for r in h.filter("DML_TYPE = 'INSERT' OR DML_TYPE = 'DELETE'").collect()]
    assert max(first) < max(ids)  # later versions count on


def test_replaying_a_batch_changes_nothing(spark):
    once = run(spark, [ins(1, "a")], upd(1, "a", "A"))
    again = run(spark, [ins(1, "a")], upd(1, "a", "A"), upd(1, "a", "A"))
    assert versions(once) == versions(again)
    assert versions(run(spark, [ins(1, "a")], [ins(1, "a")])) == versions(run(spark, [ins(1, "a")]))


def test_unknown_keys_and_several_changes_in_one_batch(spark):
    assert versions(run(spark, [dele(7, "x")])) == []
    assert versions(run(spark, upd(7, "x", "y"))) == [(7, "y", T[0], OPEN, True, "UPDATE")]
    both = numbered([upd(1, "a", "A"), [dele(1, "A")]])  # gone in the end, whatever it was in between
    assert versions(run(spark, [ins(1, "a")], both)) == [(1, "a", T[0], T[1], False, "DELETE")]
    there_and_gone = numbered([[ins(2, "b")], [dele(2, "b")]])
    assert versions(run(spark, [ins(1, "a")], there_and_gone)) == [(1, "a", T[0], OPEN, True, "INSERT")]
    twice = numbered([upd(1, "a", "z"), upd(1, "z", "b")])
    assert versions(run(spark, [ins(1, "a")], twice))[-1] == (1, "b", T[1], OPEN, True, "UPDATE")
    again = numbered([[dele(1, "a")], [ins(1, "c")]])
    assert versions(run(spark, [ins(1, "a")], again))[-1] == (1, "c", T[1], OPEN, True, "UPDATE")
    back = run(spark, [ins(1, "a")], [dele(1, "a")], [ins(1, "b")])
    assert versions(back) == [(1, "a", T[0], T[1], False, "DELETE"), (1, "b", T[2], OPEN, True, "INSERT")]


events = st.lists(
    st.lists(
        st.tuples(st.integers(1, 3), st.sampled_from("ab"), st.sampled_from(["I", "U", "D"])), min_size=1, max_size=3,
        unique_by=lambda e: e[0],
    ),
    min_size=1,
    max_size=4,
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(events)
def test_log_and_table_forms_agree(spark, batches):
    def feed(batch):
        out = []
        for k, v, kind in batch:
            out += {"I": [ins(k, v)], "U": upd(k, "?", v), "D": [dele(k, v)]}[kind]
        return out

    log = None
    for i, batch in enumerate(batches):
        part = spark.createDataFrame(feed(batch), FEED).withColumns(
            {"_commit": F.lit(i), "_committed_at": F.lit(T[i]).cast("timestamp_ntz")}
        )
        log = part if log is None else log.unionByName(part)
    table = versions(run(spark, *map(feed, batches)))
    assert table == versions(scd2_from_log(log, "K"))
    current = [v[0] for v in table if v[4]]
    assert len(current) == len(set(current))
    for a, b in zip(table, table[1:]):
        assert a[0] != b[0] or a[3] <= b[2]  # versions of a key do not overlap


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(1, 3), st.sampled_from("abc")), min_size=1, max_size=9), st.data())
def test_current_rows_do_not_depend_on_how_commits_are_cut(spark, steps, data):
    """A key given a value is inserted or updated; given the value it has, deleted."""
    state, commits = {}, []
    for k, v in steps:
        old = state.get(k)
        if old == v:
            commits.append([dele(k, v)])
            del state[k]
        else:
            commits.append(upd(k, old, v) if old else [ins(k, v)])
            state[k] = v
    images = numbered(commits)
    ends = sorted(data.draw(st.sets(st.integers(1, len(commits)), max_size=3)) | {len(commits)})
    batches = [[i for i in images if a <= i[-1] < b] for a, b in zip([0, *ends], ends)]
    h = empty_history(spark.createDataFrame([], STATE))
    for at, batch in zip(T, batches):
        h = scd2_apply(h, spark.createDataFrame(batch, FEED + ", _commit long"), "K", at)
    assert {v[0]: v[1] for v in versions(h) if v[4]} == state
    log = spark.createDataFrame(images, FEED + ", _commit long").withColumn(
        "_committed_at", F.lit(T[0]).cast("timestamp_ntz") + F.make_dt_interval(F.col("_commit").cast("int"))
    )
    assert {v[0]: v[1] for v in versions(scd2_from_log(log, "K")) if v[4]} == state


@pytest.mark.parametrize("null_safe, expected", [(False, 5), (True, 4)])
def test_upsert(spark, null_safe, expected):
    ddl = "R string, C string, N long, UPDATED_AT timestamp_ntz"
    target = spark.createDataFrame([("a", "x", 1, T[0]), ("b", "x", 2, T[0]), (None, "x", 3, T[0])], ddl)
    source = spark.createDataFrame([("a", "x", 10), ("c", "x", 30), (None, "x", 40)], "R string, C string, N long")
    got = upsert(target, source, ["R", "C"], T[1], null_safe=null_safe)
    rows = {(r.R, r.N): r.UPDATED_AT for r in got.collect()}
    assert len(rows) == expected
    assert rows["a", 10] == T[1] and rows["b", 2] == T[0] and rows["c", 30] == T[1]
    assert ((None, 3) in rows) is not null_safe
    if null_safe:
        twice = upsert(got, source, ["R", "C"], T[1], null_safe=True)
        assert sorted(map(str, twice.collect())) == sorted(map(str, got.collect()))
