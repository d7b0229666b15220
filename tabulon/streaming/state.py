"""Streams: orphan references kept up to date batch by batch, and a circuit breaker with keyed state."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.orphans import OrphanState, advance, snapshot


@dataclass
class OrphanStream:
    """A ``foreachBatch`` sink that advances an ``OrphanState``.

    The stream carries references and parents alike: (kind 'ref' or 'parent',
    id, key, time, deleted). After every batch the state is written to the
    shared folder, so a lost executor costs nothing and the lineage stays
    short; every ``every`` batches the counts are snapshot. A batch that is
    delivered again is skipped.
    """

    every: int = 1
    state: OrphanState = field(default_factory=OrphanState)  # each batch adds parts to it; see ``orphan_changes`` for a state that outlives the driver
    done: int = -1
    snapshots: list[tuple[int, list]] = field(default_factory=list)

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        if epoch <= self.done:
            return
        refs = batch.where("kind = 'ref'").selectExpr("id as row_id", "key", "time")
        parents = batch.where("kind = 'parent'").selectExpr("id as parent_id", "key", "time", "deleted")
        self.state = advance(self.state, refs, parents).kept()
        self.done = epoch
        if (epoch + 1) % self.every == 0:
            self.snapshots.append((epoch, sorted((r.period, r.orphans) for r in snapshot(self.state.orphans()).collect())))


class OrphanKeys(StatefulProcessor):
    """The references and parents of one key, in the state store.

    Parents are kept by their id, the last row of each; references by their id
    and time with how often they came. Only when the earliest living parent
    changes are the references looked at again, one by one.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", "time long")
        self.parents = handle.getMapState("parents", "parent_id long", "time long, deleted boolean")
        self.refs = handle.getMapState("refs", "row_id long, time long", "n long, waits boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        news = pd.concat(list(rows))
        old = self.first.get()[0] if self.first.exists() else None
        parents = news[news["kind"] == "parent"].sort_values(["deleted", "at"], kind="stable")  # within a batch a deletion follows the insertion
        for p in parents.itertuples():
            self.parents.updateValue((int(p.id),), (_whole(p.at), bool(p.deleted)))
        first = old
        if len(parents):
            alive = [t for t, gone in (v for _, v in self.parents.iterator()) if not gone and t is not None]
            first = min(alive) if alive else None
            self.first.update((first,))
        out: list[tuple] = []
        if first != old:
            flips = [(k, v) for k, v in self.refs.iterator() if v[1] != _waits(first, k[1])]
            for (row, at), (n, waits) in flips:
                self.refs.updateValue((row, at), (n, not waits))
                out.append((key[0], row, at, not waits, n))
        for r in news[news["kind"] == "ref"].itertuples():
            at = _whole(r.at)
            place = (int(r.id), at)
            n = self.refs.getValue(place)[0] if self.refs.containsKey(place) else 0
            self.refs.updateValue(place, (n + 1, _waits(first, at)))
            if _waits(first, at):
                out.append((key[0], int(r.id), at, True, 1))
        yield pd.DataFrame(out, columns=["key", "row_id", "at", "waits", "n"])

    def close(self) -> None:
        pass


def _whole(x) -> int | None:
    return None if pd.isna(x) else int(x)


def _waits(first: int | None, at: int | None) -> bool:
    return first is None or at is None or first > at


def orphan_changes(events: DataFrame) -> DataFrame:
    """Streaming (key, row_id, at, waits, n): references that began or ceased to wait, ``n`` rows at once.

    ``events``: (kind 'ref' or 'parent', id, key, time, deleted). The state is
    keyed by the reference key and lives in the state store, so the cost of a
    batch is that of its keys and a restart goes on where it stopped. The sum
    of ``n``, negative where ``waits`` is false, is the number of orphans at
    any time; by month of ``at`` it is the snapshot of ``snapshot``. Null and
    empty keys are no references. Needs the RocksDB state store.
    """
    rows = events.where("key is not null and key <> ''").select("kind", "id", "key", F.unix_micros(F.col("time").cast("timestamp")).alias("at"), F.coalesce("deleted", F.lit(False)).alias("deleted"))
    return rows.groupBy("key").transformWithStateInPandas(OrphanKeys(), "key string, row_id long, at long, waits boolean, n long", "Append", "None")


def breaker(threshold: int = 2, cooldown: int = 900) -> Callable:
    """State function of a circuit breaker for ``applyInPandasWithState``.

    Attempts of one origin come as (seq, at, outcome, retry_after), outcome
    'ok', 'failed', 'refused' or 'ignored'. ``threshold`` failures in a row or
    one refusal defer the origin by ``cooldown`` seconds, or by retry_after if
    that is longer; a success resets; an ignored attempt changes nothing.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        failures, until = state.get if state.exists else (0, 0)
        rows = pd.concat(list(batches)).sort_values(["seq"], kind="stable")
        out = []
        for r in rows.itertuples():
            if r.outcome == "ok":
                failures, until = 0, 0
            elif r.outcome in ("failed", "refused"):
                failures += 1
                if failures >= threshold or r.outcome == "refused":
                    wait = 0 if pd.isna(r.retry_after) else int(r.retry_after)
                    until = int(r.at) + max(cooldown, wait)
            out.append((key[0], int(r.seq), failures, until))
        state.update((failures, until))
        yield pd.DataFrame(out, columns=["origin", "seq", "failures", "deferred_until"])

    return step


def circuit_breaker(attempts: DataFrame, threshold: int = 2, cooldown: int = 900) -> DataFrame:
    """Streaming (origin, seq, failures, deferred_until) of a stream of (origin, seq, at, outcome, retry_after)."""
    return attempts.groupBy("origin").applyInPandasWithState(
        breaker(threshold, cooldown), "origin string, seq long, failures long, deferred_until long", "failures long, deferred_until long", "append", GroupStateTimeout.NoTimeout
    )
