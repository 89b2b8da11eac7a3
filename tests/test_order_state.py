import json
import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from orelake.operators.history import scd2_from_log, table_changes
from orelake.plans.metrics import daily_order_metrics, order_images
from orelake.sources import bronze
from orelake.streaming import jobs, order_state

DAY = 86_400_000_000


def commits_of(draw, n):
    """The commits of one key: (number, time, inserts, updates, image)."""
    out, there = [], False
    for number in range(n):
        kind = draw.choice(["ins", "upd", "del"])
        if kind == "ins" and there or kind != "ins" and not there:
            kind = draw.choice(["upd", "del"]) if there else "ins"
        there = kind != "del"
        out.append((number, number * DAY, kind != "del", kind == "upd", draw.choice("abc")))
    return out


def versions_of(parts):
    held = {}
    for sign, v in parts:
        held[v] = held.get(v, 0) + sign
    return sorted((v for v, n in held.items() if n > 0), key=str)


def test_order_of_arrival_and_repetition_do_not_matter():
    draw = random.Random(4)
    for _ in range(400):
        commits = commits_of(draw, draw.randrange(1, 8))
        want = versions_of(order_state.step(order_state.Order(), commits, 0))
        shuffled = commits + draw.choices(commits, k=3)
        draw.shuffle(shuffled)
        order, found = order_state.Order(), []
        while shuffled:
            some, shuffled = shuffled[:2], shuffled[2:]
            order = order_state.Order.unpacked(order.packed())
            found += order_state.step(order, some, 0)
        assert versions_of(found) == want and not any(s == 0 for s, _ in found)


def test_what_the_watermark_has_passed_is_final():
    draw = random.Random(5)
    for _ in range(200):
        commits = commits_of(draw, 8)
        want = versions_of(order_state.step(order_state.Order(), commits, 0))
        order, found, seen = order_state.Order(), [], 0
        arriving = [*commits[:1], *[c for pair in zip(commits[2::2], commits[1::2]) for c in pair], commits[7]]
        for c in arriving:  # neighbours change places; the watermark follows two days behind
            found += order_state.step(order, [c], seen - 2 * DAY)
            seen = max(seen, c[1])
        assert versions_of(found) == want and len(order.pending) <= 5
        assert order_state.step(order, [commits[0]], seen) == [(0, (commits[0][4], 0, None, "INSERT"))]


@pytest.fixture(scope="module")
def feed(spark, small):
    """Four commits of order changes."""
    before, after = bronze.orders_before(spark, small), bronze.orders_after(spark, small)
    third = after.filter("ORDER_ID % 5 != 0").withColumn("TOTAL_AMOUNT", (F.col("TOTAL_AMOUNT") + 3).cast("decimal(12,2)"))
    states = [before.limit(0), before, after, third, after]
    out = []
    for n, (old, new) in enumerate(zip(states, states[1:])):
        at = datetime(2001, 1, 1) + timedelta(hours=6 * n)
        out.append(
            table_changes(old, new, "ORDER_ID").withColumns({
                "_commit": F.lit(n).cast("long"), "_committed_at": F.lit(at.isoformat(" ")).cast("timestamp_ntz"),
            }).cache()
        )
    return out


def as_rows(df):
    return sorted((tuple(map(str, r)) for r in df.collect()), key=str)


@pytest.mark.parametrize("arrival", [[[0], [1, 2, 3]], [[1, 0], [3], [0, 2, 1]]])
def test_stream_equals_history_from_the_whole_log(spark, feed, tmp_path, arrival):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for batch in arrival:
        for n in batch:
            feed[n].write.mode("append").parquet(src)
        source = jobs.change_source(spark, src, feed[0].schema)
        order_state.order_state_stream(source, out, str(tmp_path / "checkpoint"))
    log = feed[0].unionByName(feed[1]).unionByName(feed[2]).unionByName(feed[3])
    history = scd2_from_log(order_images(log), "ORDER_ID")
    got = order_state.read_history(spark, out)
    assert as_rows(got.select(*history.columns)) == as_rows(history)
    daily = daily_order_metrics(history)
    found = order_state.read_daily_state(spark, out)
    assert as_rows(found.select(*daily.columns)) == as_rows(daily)
    assert order_state.read_late(spark, out).count() == 0


def test_few_entries_hold_many_neighbours(spark, feed, tmp_path):
    src = str(tmp_path / "in")
    feed[0].write.parquet(src)
    source = jobs.change_source(spark, src, feed[0].schema)
    query = order_state.order_state_stream(source, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    entries = sum(o["numRowsTotal"] for o in query.lastProgress["stateOperators"])
    assert 0 < entries <= feed[0].agg(F.max("ORDER_ID")).first()[0] // 1000 + 1


class Held:
    """A state entry as ``_update`` sees it."""

    def __init__(self):
        self.get = None

    exists = property(lambda self: self.get is not None)

    def update(self, value):
        self.get = value

    def getCurrentWatermarkMs(self):
        return 0


def test_entries_are_compressed_and_count_as_output_by_their_size():
    n = 1 << order_state.BLOCK_BITS
    image = [f'{{"ORDER_ID":{i},"REGION":"Europe","CHANNEL":"Partner","SOURCE_SYSTEM":"NATIVE"}}' for i in range(n)]
    commits = pd.DataFrame({"ORDER_ID": range(n), "_commit": 0, "at": DAY, "inserts": True, "updates": False, "image": image})
    state = Held()
    (found,) = order_state._update((0,), iter([commits]), state)
    assert found["SIGN"].tolist() == [1] * n
    assert len(state.get[0]) * 3 < sum(map(len, image))
    held = order_state.entry_orders(state.get[0])
    assert held["7"] == [None, False, None, [[0, DAY, True, False, image[7]]]]
    (again,) = order_state._update((0,), iter([commits]), state)  # changes nothing, but counts
    assert len(again) == len(state.get[0]) // order_state.FILL + 1 and again["SIGN"].isna().all()
    assert order_state.entry_orders(state.get[0]) == held


def test_state_lies_in_rocksdb(spark, feed, tmp_path):
    src = str(tmp_path / "in")
    feed[0].filter("ORDER_ID < 40").write.parquet(src)
    source = jobs.change_source(spark, src, feed[0].schema)
    before = {k: spark.conf.get(k, None) for k in order_state.SETTINGS}
    query = order_state.order_state_stream(source, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    (store,) = query.lastProgress["stateOperators"]
    assert "rocksdbPutCount" in store["customMetrics"]
    assert {k: spark.conf.get(k, None) for k in order_state.SETTINGS} == before


def test_checkpoint_made_before_goes_on(spark, feed, tmp_path, monkeypatch):
    src, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
    first, second = (changes.filter("ORDER_ID < 40") for changes in feed[:2])
    first.write.parquet(src)
    source = jobs.change_source(spark, src, feed[0].schema)
    with monkeypatch.context() as m:  # entries in the executor's memory, as plain text
        m.setattr(order_state, "SETTINGS", {})
        m.setattr(order_state, "entry_text", lambda held: json.dumps({k: json.dumps(v) for k, v in held.items()}))
        order_state.order_state_stream(source, out, checkpoint)
    second.write.mode("append").parquet(src)
    order_state.order_state_stream(jobs.change_source(spark, src, feed[0].schema), out, checkpoint)
    history = scd2_from_log(order_images(first.unionByName(second)), "ORDER_ID")
    assert as_rows(order_state.read_history(spark, out).select(*history.columns)) == as_rows(history)
