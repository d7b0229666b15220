"""References to records that do not exist, kept up to date increment by increment.

The state has an index of the parents and all references with a flag that says
whether they wait. An increment brings references, parents and deletions: new
references probe the index; references that wait for a key whose parents
changed are looked at again, so arriving parents resolve them and deletions
reopen them. References of other keys are left alone, and so is where they are
stored: an increment adds a part, and outdates rows of older parts by the keys
it touched; parts are merged when there are ``PARTS``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.skew import join_unique
from ..tables import written

#: Parts of a state that are merged into one.
PARTS = 8


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class Log:
    """Rows in parts, oldest first; each part comes with the values of ``by`` that it outdates in the parts before it, its own if none are given."""

    by: str
    parts: tuple[tuple[DataFrame, DataFrame | None], ...] = ()

    def view(self) -> DataFrame | None:
        """The rows that no later part outdates."""
        out: list[DataFrame] = []
        for i, (rows, _) in enumerate(self.parts):
            later = [new.select(self.by) if gone is None else gone for new, gone in self.parts[i + 1 :]]
            out.append(rows.join(_union(later).distinct(), self.by, "left_anti").select(rows.columns) if later else rows)
        return _union(out) if out else None

    def add(self, rows: DataFrame, gone: DataFrame | None) -> Log:
        return Log(self.by, (*self.parts, (rows, gone)))

    def kept(self, name: str) -> Log:
        """The last part as a table in the shared folder; all parts as one if there are ``PARTS``."""
        if not self.parts:
            return self
        if len(self.parts) >= PARTS:
            return Log(self.by, ((written(self.view(), name), None),))
        rows, gone = self.parts[-1]
        return Log(self.by, (*self.parts[:-1], (written(rows, name), None if gone is None else written(gone, f"{name}-gone"))))


@dataclass(frozen=True)
class OrphanState:
    """The parents (parent_id, key, time, deleted) and the references (row_id, key, time, waits) seen so far."""

    parent_log: Log = Log("parent_id")
    ref_log: Log = Log("key")

    @property
    def parents(self) -> DataFrame | None:
        return self.parent_log.view()

    @property
    def refs(self) -> DataFrame | None:
        return self.ref_log.view()

    def orphans(self) -> DataFrame:
        """The references that wait: (row_id, key, time)."""
        return self.refs.where("waits").drop("waits")

    def kept(self) -> OrphanState:
        """The state with what the last increment added written to the shared folder, so that it survives lost executors and has no lineage."""
        return OrphanState(self.parent_log.kept("parents"), self.ref_log.kept("refs"))


def last_of_each(parents: DataFrame) -> DataFrame:
    """One row a parent of an increment: a deletion if there is one, else the latest."""
    best = F.max(F.struct("deleted", "time", "key")).alias("b")
    return parents.groupBy("parent_id").agg(best).select("parent_id", "b.key", "b.time", "b.deleted")


def first_alive(parents: DataFrame) -> DataFrame:
    """(key, first): the earliest time of a parent that is not deleted. Combined before the shuffle."""
    return parents.where(~F.col("deleted") & F.col("key").isNotNull()).groupBy("key").agg(F.min("time").alias("first"))


def probe(refs: DataFrame, parents: DataFrame) -> DataFrame:
    """``refs`` with ``waits``: whether no living parent with the key is as early as the reference."""
    met = join_unique(refs, first_alive(parents), "key")
    return met.select("row_id", "key", "time", (~F.coalesce(F.col("first") <= F.col("time"), F.lit(False))).alias("waits"))


def advance(state: OrphanState, refs: DataFrame | None = None, parents: DataFrame | None = None) -> OrphanState:
    """The state after an increment.

    ``refs``: (row_id, key, time); ``parents``: (parent_id, key, time,
    deleted), where a known ``parent_id`` replaces the older row (a deletion
    is such a row; within an increment it follows the insertion). Null and
    empty keys are no references. A reference without a time waits, since no
    parent is known to be as early; a parent without a time resolves nothing.
    Repeated rows stay repeated. Keys are compared as written. The first
    increment takes parents as unique by their id.
    """
    old_parents, old_refs = state.parents, state.refs
    parent_log = state.parent_log
    index, again, touched = old_parents, None, None
    if parents is not None and old_parents is None:
        parent_log = parent_log.add(parents, None)
        index = parents
    elif parents is not None:
        parents = last_of_each(parents)
        ids = parents.select("parent_id")
        gone = old_parents.join(ids, "parent_id", "left_semi")
        touched = parents.select("key").unionByName(gone.select("key")).where("key is not null").distinct()
        parent_log = parent_log.add(parents, None)
        index = old_parents.join(ids, "parent_id", "left_anti").unionByName(parents)
    if old_refs is not None and parents is not None:
        again = old_refs.drop("waits")
        if touched is not None:
            again = again.join(touched, "key", "left_semi").select("row_id", "key", "time")
        else:  # the first parents at all
            touched = old_refs.select("key").distinct()
    look = [again] if again is not None else []
    if refs is not None:
        look.append(refs.where("key is not null and key <> ''").select("row_id", "key", "time"))
    if not look:
        return OrphanState(parent_log, state.ref_log)
    look = _union(look)
    found = look.withColumn("waits", F.lit(True)) if index is None else probe(look, index)
    # new references alone outdate nothing: no key is named
    return OrphanState(parent_log, state.ref_log.add(found, touched if again is not None else found.select("key").limit(0)))


def snapshot(found: DataFrame, time: str = "time") -> DataFrame:
    """(period, orphans): how many references wait, by month of the referring row."""
    return found.groupBy(F.date_format(time, "yyyy-MM").alias("period")).agg(F.count("*").alias("orphans"))


#: Referring table, its id, field and time, and the table and fields it refers to.
REFERENCES = (
    ("reviews", "review_id", "record_id", "reviewed_at", "candidates", "row_id", "id", "extracted_at", "withdrawn_at"),
    ("candidates", "row_id", "capture_manifest", "extracted_at", "captures", "capture_id", "manifest", "retrieved_at", "deleted_at"),
    ("candidates", "row_id", "file", "extracted_at", "captures", "capture_id", "file", "retrieved_at", "deleted_at"),
)


def statistical_orphans(spark: SparkSession, read) -> DataFrame:
    """(ref_field, period, row_id) of the orphans of all ``REFERENCES``; ``read`` gives a table by its name."""
    out = None
    for table, row_id, field, time, target, parent_id, key, at, gone in REFERENCES:
        refs = read(table).select(F.col(row_id).alias("row_id"), F.col(field).alias("key"), F.col(time).alias("time"))
        parents = read(target).select(F.col(parent_id).alias("parent_id"), F.col(key).alias("key"), F.col(at).alias("time"), F.col(gone).isNotNull().alias("deleted"))
        found = advance(OrphanState(), refs, parents).orphans()
        one = found.select(F.lit(f"{table}.{field}").alias("ref_field"), F.date_format("time", "yyyy-MM").alias("period"), "row_id")
        out = one if out is None else out.unionByName(one)
    return out


#: Where an increment ends in ``orphan_snapshots``; the last one takes everything that is left.
CUTOFFS = ("2024-10-01", "2025-04-01", "9999-01-01")
#: When rows of a table arrive.
ARRIVALS = {"reviews": "reviewed_at", "candidates": "loaded_at", "captures": "retrieved_at"}


def orphan_snapshots(spark: SparkSession, read, cutoffs: Sequence[str] = CUTOFFS) -> DataFrame:
    """(ref_field, cutoff, period, orphans): how many references wait at the end of each increment, by month of the referring row.

    References, parents and deletions come with the increment in which they
    arrived; each state is advanced from the one before.
    """
    out = []
    for table, row_id, field, time, target, parent_id, key, at, gone in REFERENCES:
        refs = read(table).select(F.col(row_id).alias("row_id"), F.col(field).alias("key"), F.col(time).alias("time"), F.col(ARRIVALS[table]).alias("_came"))
        parents = read(target).select(F.col(parent_id).alias("parent_id"), F.col(key).alias("key"), F.col(at).alias("time"), F.col(ARRIVALS[target]).alias("_came"), F.col(gone).alias("_gone"))
        state, start = OrphanState(), "0001-01-01"
        for end in cutoffs:
            now = F.col("_came").between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz") - F.expr("interval 1 microsecond"))
            deleted = F.coalesce(F.col("_gone") < F.lit(end).cast("timestamp_ntz"), F.lit(False))
            news = parents.where(now | ((F.col("_came") < F.lit(start).cast("timestamp_ntz")) & deleted & (F.col("_gone") >= F.lit(start).cast("timestamp_ntz"))))
            state = advance(state, refs.where(now).drop("_came"), news.select("parent_id", "key", "time", deleted.alias("deleted"))).kept()
            out.append(snapshot(state.orphans()).select(F.lit(f"{table}.{field}").alias("ref_field"), F.lit(end).alias("cutoff"), "period", "orphans"))
            start = end
    return _union(out)
