"""Streams reach the same states as their batch forms."""

import datetime

import pandas as pd

from tabulon.streaming.state import OrphanStream, breaker, circuit_breaker, orphan_changes

DAY = datetime.datetime(2024, 3, 1)


def test_orphan_stream(spark, tmp_path):
    schema = "kind string, id long, key string, time timestamp, deleted boolean"
    t = lambda n: DAY + datetime.timedelta(days=n)
    steps = [
        [("ref", 1, "a", t(5), None), ("ref", 2, "b", t(5), None)],
        [("parent", 10, "a", t(1), False), ("parent", 11, "b", t(9), False)],
        [("parent", 12, "b", t(2), False)],
        [("parent", 10, "a", t(1), True), ("ref", 3, "a", t(6), None)],
    ]
    want = [{1, 2}, {2}, set(), {1, 3}]
    for i, rows in enumerate(steps):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/{i}.parquet"))
    sink = OrphanStream()
    for i, w in enumerate(want):
        batch = spark.read.schema(schema).parquet(str(tmp_path / f"in/{i}.parquet"))
        sink(batch, i)
        sink(batch, i)  # delivered again
        assert {r.row_id for r in sink.state.orphans().collect()} == w
    assert [e for e, _ in sink.snapshots] == [0, 1, 2, 3] and sink.snapshots[-1][1] == [("2024-03", 2)]
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    other = OrphanStream()
    q = stream.writeStream.foreachBatch(other).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert {r.row_id for r in other.state.orphans().collect()} == {1, 3}


def test_orphans_in_the_state_store_survive_a_restart(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    schema = "kind string, id long, key string, time timestamp, deleted boolean"
    t = lambda n: DAY + datetime.timedelta(days=n)
    steps = [
        [("ref", 1, "a", t(5), None), ("ref", 2, "b", t(5), None), ("ref", 2, "b", t(5), None), ("ref", 7, None, t(5), None), ("ref", 8, "", t(5), None), ("ref", 9, "n", None, None)],
        [("parent", 10, "a", t(1), False), ("parent", 11, "b", t(9), False), ("parent", 13, "n", t(1), False)],
        [("parent", 12, "b", t(2), False), ("parent", 14, "c", t(1), True), ("parent", 14, "c", t(1), False), ("ref", 5, "c", t(2), None)],
        [("parent", 10, "a", t(1), True), ("ref", 3, "a", t(6), None)],
    ]
    want = [{1: 1, 2: 2, 9: 1}, {2: 2, 9: 1}, {5: 1, 9: 1}, {1: 1, 3: 1, 5: 1, 9: 1}]
    waiting: dict[int, int] = {}
    for i, (rows, w) in enumerate(zip(steps, want)):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/{i}.parquet"))
        # a new query for every batch: the state comes from the checkpoint
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in/*"))
        q = orphan_changes(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        got: dict[int, int] = {}
        for r in spark.read.parquet(str(tmp_path / "out")).collect():
            got[r.row_id] = got.get(r.row_id, 0) + (r.n if r.waits else -r.n)
        waiting = {k: n for k, n in got.items() if n}
        assert waiting == w


def test_an_insert_and_a_delete_in_one_increment(spark, monkeypatch):
    from tabulon.operators import orphans
    from tabulon.operators.orphans import OrphanState, advance

    monkeypatch.setattr(orphans, "PARTS", 3)

    ref = spark.createDataFrame([(1, "a", DAY)], "row_id long, key string, time timestamp")
    parents = spark.createDataFrame([(10, "a", DAY, False), (10, "a", DAY, True)], "parent_id long, key string, time timestamp, deleted boolean")
    alone = advance(OrphanState(), ref)
    assert [r.row_id for r in alone.orphans().collect()] == [1]
    seen = advance(alone, None, parents.limit(0))
    assert [r.row_id for r in advance(seen, None, parents).orphans().collect()] == [1]
    assert advance(seen, None, parents.where("not deleted")).orphans().count() == 0
    state = seen.kept()
    for n in range(4):  # parts are merged on the way
        state = advance(state, ref.selectExpr(f"row_id + {n + 1} as row_id", "key", "time"), parents.where("deleted" if n % 2 else "not deleted")).kept()
        assert state.orphans().count() == (n + 2 if n % 2 else 0)
    assert len(state.ref_log.parts) < 4


class State:
    exists, get = False, None

    def update(self, value):
        self.exists, self.get = True, value


def test_breaker_rules():
    s, step = State(), breaker()

    def feed(*rows):
        return pd.concat(step(("o",), iter([pd.DataFrame(rows, columns=["seq", "at", "outcome", "retry_after"])]), s)).iloc[-1]

    assert feed((1, 100, "failed", None)).deferred_until == 0
    assert feed((2, 110, "ignored", None)).failures == 1
    assert feed((3, 120, "failed", 5000)).deferred_until == 5120
    assert feed((4, 6000, "ok", None)).failures == 0
    assert feed((5, 7000, "refused", None)).deferred_until == 7900


def test_breaker_stream(spark, tmp_path):
    schema = "origin string, seq long, at long, outcome string, retry_after long"
    for i, rows in enumerate([[("a", 1, 10, "failed", None), ("b", 1, 10, "ok", None)], [("a", 2, 20, "failed", None)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/{i}.parquet"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    q = circuit_breaker(stream).writeStream.format("memory").queryName("breaker").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(90)
    got = {(r.origin, r.seq): (r.failures, r.deferred_until) for r in spark.sql("select * from breaker").collect()}
    assert got[("b", 1)] == (0, 0)
    assert {got[("a", 1)], got[("a", 2)]} == {(1, 0), (2, 920)} or {got[("a", 1)], got[("a", 2)]} == {(1, 0), (2, 910)}
