"""Long verbatim spans shared between records.

Documents meet through winnowed k-grams: any shared span of the threshold
length holds a kept k-gram (an anchor) of both. The texts around the
occurrences of one anchor form a reference shard. Over each shard stands a
suffix automaton in which the anchor, common to all its texts, is one symbol;
the texts are streamed through it, and a state of at least the threshold
length that several texts reach is a shared span.

The shards are distributed by their anchor rather than broadcast, since the
reference is the corpus itself and has no size bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..tables import written
from .winnow import chunks, kept, points

#: Shards of more texts than this are not given to one task but split by their windows.
SHARD = 64


def _sizes(min_chars: int) -> tuple[int, int]:
    """k-gram length and window whose guarantee is ``min_chars``."""
    w = min_chars // 2
    return min_chars - w + 1, w


def _signature(data: bytes) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(data)
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)


def _anchors(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """One row for each text of at least ``min_chars``: its signature, and its anchors with their places."""
    k, w = _sizes(min_chars)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in chunks(texts):
                part = [t if t and len(t) >= min_chars else "" for t in texts[a:b]]
                lengths = np.array([len(t) for t in part])
                h, doc, at = kept(points("".join(part)), lengths, k, w)
                long = np.flatnonzero(lengths >= min_chars)
                if not len(long):
                    continue
                ends = np.concatenate([[0], np.searchsorted(doc, long, side="right")]).astype(np.int32)
                s = [_signature(part[i].encode("utf-8", "surrogatepass")) for i in long]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(long + a)),
                        pa.array([x for x, _ in s], pa.int64()),
                        pa.array([x for _, x in s], pa.int64()),
                        pa.array(lengths[long], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(h)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(at.astype(np.int32))),
                    ],
                    names=["doc", "s1", "s2", "n", "hs", "ats"],
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).where(F.length("text") >= min_chars).mapInArrow(run, f"doc {kind}, s1 long, s2 long, n long, hs array<long>, ats array<int>")


class Automaton:
    """Generalised suffix automaton; symbols weigh one, the anchor more."""

    def __init__(self):
        self.step: list[dict] = [{}]
        self.link, self.size = [-1], [0]
        self.last = 0

    def add(self, symbol, weight: int) -> int:
        """Appends a symbol to the current text; returns its state."""
        step, link, size, p = self.step, self.link, self.size, self.last
        q = step[p].get(symbol)
        if q is not None:
            if size[q] == size[p] + weight:
                self.last = q
                return q
            self.last = self._split(p, q, symbol, weight)
            return self.last
        cur = len(step)
        step.append({})
        size.append(size[p] + weight)
        link.append(0)
        while p >= 0 and symbol not in step[p]:
            step[p][symbol] = cur
            p = link[p]
        if p >= 0:
            q = step[p][symbol]
            link[cur] = q if size[q] == size[p] + weight else self._split(p, q, symbol, weight)
        self.last = cur
        return cur

    def _split(self, p: int, q: int, symbol, weight: int) -> int:
        step, link, size = self.step, self.link, self.size
        new = len(step)
        step.append(dict(step[q]))
        size.append(size[p] + weight)
        link.append(link[q])
        link[q] = new
        while p >= 0 and step[p].get(symbol) == q:
            step[p][symbol] = new
            p = link[p]
        return new


def shared_in_shard(texts: list[tuple[str, int]], k: int, min_chars: int, held: list[tuple] | None = None) -> tuple[set[tuple[int, ...]], dict[int, list[tuple[int, int]]]]:
    """Which texts of a shard share ``min_chars`` characters around the anchor, and where.

    ``texts``: (text, place of the anchor). Returns the groups of indices that
    share a span, each group once, and for each index the spans, as (start,
    end), that another text holds. ``held``: the least and greatest record of
    each text; what one record alone holds, at two of its places, is then not
    shared. Texts whose anchors have different characters, which only their
    hash has in common, share nothing.
    """
    groups: set[tuple[int, ...]] = set()
    spans: dict[int, list[tuple[int, int]]] = {}
    by_anchor: dict[str, list[int]] = {}
    for n, (text, off) in enumerate(texts):
        by_anchor.setdefault(text[off : off + k], []).append(n)
    for same in by_anchor.values():
        if len(same) > 1:
            _shared_around([(n, *texts[n]) for n in same], k, min_chars, held, groups, spans)
    return groups, spans


def _shared_around(texts: list[tuple[int, str, int]], k: int, min_chars: int, held: list[tuple] | None, groups: set[tuple[int, ...]], spans: dict[int, list[tuple[int, int]]]) -> None:
    """As ``shared_in_shard`` for texts (index, text, place) with one anchor; adds to ``groups`` and ``spans``."""
    sam, ends = Automaton(), []
    for n, text, off in texts:
        sam.last = 0
        for c in text[:off]:
            sam.add(c, 1)
        mine = [(sam.add(None, k), off + k)]
        for i in range(off + k, len(text)):
            mine.append((sam.add(text[i], 1), i + 1))
        ends.append((n, mine))
    link, size = sam.link, sam.size
    reached: dict[int, list[tuple[int, int]]] = {}
    for n, mine in ends:
        for state, end in mine:
            if end < min_chars:
                continue
            while size[link[state]] >= min_chars:
                state = link[state]
            if size[state] >= min_chars:
                reached.setdefault(state, []).append((n, end))
    for hits in reached.values():
        who = sorted({n for n, _ in hits})
        if len(who) < 2 or held is not None and min(held[n][0] for n in who) == max(held[n][1] for n in who):
            continue
        groups.add(tuple(who))
        for n, end in hits:
            mine = spans.setdefault(n, [])
            if mine and mine[-1][1] >= end - min_chars:
                mine[-1] = (min(mine[-1][0], end - min_chars), max(end, mine[-1][1]))
            else:
                mine.append((end - min_chars, end))


class SharedSpans:
    """Shared spans of a corpus; the results are views of the same tables.

    Null texts and texts under ``min_chars`` share nothing. Exact copies are
    one class, represented by its least id, and are compared once. Repeated
    ids are taken as one record. Empty tables give empty results; other
    columns are not read. Texts of any length are taken whole.
    """

    def __init__(self, docs: DataFrame, doc_id: str, text: str = "text", min_chars: int = 200):
        self.docs, self.doc_id, self.text, self.min_chars = docs, doc_id, text, min_chars
        self.k, self.w = _sizes(min_chars)
        self.anchors = written(_anchors(docs, doc_id, text, min_chars), "anchors")
        same = self.anchors.groupBy("s1", "s2").agg(F.min("doc").alias("rep"), F.max("doc").alias("top")).where("rep < top")
        #: (doc, rep) of every record that has a copy, representatives included.
        self.copies = written(self.anchors.select("doc", "s1", "s2", "n").join(same, ["s1", "s2"]).select("doc", "rep", "n").distinct(), "copies")
        self.contexts = written(self._contexts(), "contexts")
        self._compare()

    def _contexts(self) -> DataFrame:
        """The text around each anchor that two different texts hold."""
        k, reach = self.k, self.min_chars - self.k
        each = self.anchors.select("doc", "s1", "s2", F.explode(F.arrays_zip("hs", "ats")).alias("a")).select("doc", "s1", "s2", F.col("a.hs").alias("h"), F.col("a.ats").alias("at"))
        common = each.groupBy("h").agg(F.min("s1").alias("a"), F.max("s1").alias("b"), F.min("s2").alias("c"), F.max("s2").alias("d")).where("a < b or c < d").select("h")
        common = written(common, "common")  # its size is then known, and a hot anchor's side can be split
        found = each.select("doc", "h", "at").join(common, "h").join(self.copies.where("doc <> rep").select("doc"), "doc", "left_anti")
        by_doc = found.groupBy("doc").agg(F.collect_set(F.struct("h", "at")).alias("found"))
        texts = self.docs.select(F.col(self.doc_id).alias("doc"), F.col(self.text).alias("text")).where(F.length("text") >= self.min_chars)

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                row, hs, starts, offs, around, c1, c2 = [], [], [], [], [], [], []
                for n, (text, found) in enumerate(zip(batch.column("text").to_pylist(), batch.column("found").to_pylist())):
                    for f in found:
                        at = f["at"]
                        start = max(0, at - reach)
                        part = text[start : at + k + reach]
                        x, y = _signature(f"{at - start} {part}".encode("utf-8", "surrogatepass"))
                        row.append(n), hs.append(f["h"]), starts.append(start), offs.append(at - start), around.append(part), c1.append(x), c2.append(y)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc").take(pa.array(row, pa.int64())), pa.array(hs, pa.int64()), pa.array(starts, pa.int32()), pa.array(offs, pa.int32()), pa.array(around, pa.string()), pa.array(c1, pa.int64()), pa.array(c2, pa.int64())],
                    names=["doc", "h", "start", "off", "around", "c1", "c2"],
                )

        kind = self.docs.schema[self.doc_id].dataType.simpleString()
        return texts.join(by_doc, "doc").dropDuplicates(["doc"]).mapInArrow(cut, f"doc {kind}, h long, start int, off int, around string, c1 long, c2 long")

    def _compare(self) -> None:
        k, least, size = self.k, self.min_chars, self.min_chars
        doc = self.docs.schema[self.doc_id].dataType.simpleString()
        kinds = self.contexts.groupBy("h", "c1", "c2").agg(F.first("around").alias("around"), F.first("off").alias("off"), F.min("doc").alias("p"), F.max("doc").alias("q"))
        many = kinds.groupBy("h").count().where("count > 1")
        kinds = kinds.join(many, "h").withColumn("large", F.col("count") > SHARD).drop("count")

        def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def flush(h, rows):
                groups, spans = shared_in_shard([(r["around"], r["off"]) for r in rows], k, least, [(r["p"], r["q"]) for r in rows])
                for g, who in enumerate(sorted(groups)):
                    out.extend((h, rows[n]["c1"], rows[n]["c2"], g, None, None) for n in who)
                for n, mine in spans.items():
                    out.extend((h, rows[n]["c1"], rows[n]["c2"], None, a, b) for a, b in mine)

            def emit():
                cols = list(zip(*out)) if out else [()] * 6
                got = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 3 + [pa.int32()] * 3)], names=["h", "a1", "a2", "g", "x", "y"])
                out.clear()
                return got

            out: list[tuple] = []
            now, rows = None, []
            for batch in batches:
                for r in batch.to_pylist():
                    if r["h"] != now:
                        if len(rows) > 1:
                            flush(now, rows)
                        now, rows = r["h"], []
                    rows.append(r)
                if len(out) > 10_000:
                    yield emit()
            if len(rows) > 1:
                flush(now, rows)
            yield emit()

        small = kinds.where("not large").select("h", "c1", "c2", "around", "off", "p", "q").repartition("h").sortWithinPartitions("h").mapInArrow(shards, "h long, a1 long, a2 long, g int, x int, y int")

        def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cols: list[list] = [[] for _ in range(8)]
                for r in batch.to_pylist():
                    for x in range(max(0, r["off"] + k - size), min(r["off"], len(r["around"]) - size) + 1):
                        w1, w2 = _signature(r["around"][x : x + size].encode("utf-8", "surrogatepass"))
                        for c, v in zip(cols, (r["h"], r["c1"], r["c2"], w1, w2, x, r["p"], r["q"])):
                            c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 5 + [pa.int32()] + [batch.schema.field("p").type] * 2)], names=["h", "a1", "a2", "w1", "w2", "x", "p", "q"])

        cut = kinds.where("large").select("h", "c1", "c2", "around", "off", "p", "q").mapInArrow(windows, f"h long, a1 long, a2 long, w1 long, w2 long, x int, p {doc}, q {doc}")
        # a window counts if two texts and two records hold it, as in the smaller shards
        kind = F.struct("a1", "a2")
        again = cut.groupBy("h", "w1", "w2").agg(F.min(kind).alias("a"), F.max(kind).alias("b"), F.min("p").alias("p"), F.max("q").alias("q")).where("a < b and p < q").select("h", "w1", "w2")
        #: (h, a1, a2, w1, w2, x): the shared windows of large shards, and (h, a1, a2, g): the sharing groups of small ones.
        self.windows = written(cut.drop("p", "q").join(again, ["h", "w1", "w2"]), "windows")
        small = written(small, "shards")
        self.groups = small.where("g is not null").select("h", "a1", "a2", "g")
        self.kind_spans = small.where("x is not null").select("h", "a1", "a2", "x", "y").unionByName(self.windows.select("h", "a1", "a2", "x", (F.col("x") + size).alias("y")))

    def links(self) -> DataFrame:
        """``a, b`` (a < b): representatives whose texts share a span, each pair once. As many as there are pairs: see ``degrees`` for counts."""

        def met(kinds: DataFrame, on: list[str]) -> DataFrame:
            other = kinds.select(*on, F.col("a1").alias("b1"), F.col("a2").alias("b2"))
            return kinds.join(other, on).where("a1 < b1 or (a1 = b1 and a2 < b2)").select("h", "a1", "a2", "b1", "b2")

        pairs = met(self.groups, ["h", "g"]).unionByName(met(self.windows.select("h", "a1", "a2", "w1", "w2"), ["h", "w1", "w2"])).distinct()
        m = self.contexts.select("h", "c1", "c2", "doc")
        left = m.select("h", F.col("c1").alias("a1"), F.col("c2").alias("a2"), F.col("doc").alias("a"))
        right = m.select("h", F.col("c1").alias("b1"), F.col("c2").alias("b2"), F.col("doc").alias("b"))
        across = pairs.join(left, ["h", "a1", "a2"]).join(right, ["h", "b1", "b2"]).select("a", "b")
        full = self.contexts.where(F.length("around") >= self.min_chars).select("h", "c1", "c2", "doc")
        inside = full.select("h", "c1", "c2", F.col("doc").alias("a")).join(full.select("h", "c1", "c2", F.col("doc").alias("b")), ["h", "c1", "c2"]).select("a", "b")
        return across.unionByName(inside).where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def classes(self) -> DataFrame:
        """``doc, span``: the representatives that hold each shared span, spans with the same holders once.

        A span is known by its holders: their number and the sum of their
        hashes. Linear in the places where spans are shared.
        """
        kind = self.contexts.select("h", F.col("c1").alias("a1"), F.col("c2").alias("a2"), "doc", F.length("around").alias("n"))
        one = F.lit(0).cast("long")
        groups = self.groups.join(kind, ["h", "a1", "a2"]).select(F.lit(0).alias("t"), "h", F.col("g").cast("long").alias("u"), one.alias("v"), "doc")
        windows = self.windows.select("h", "a1", "a2", "w1", "w2").join(kind, ["h", "a1", "a2"]).select(F.lit(1).alias("t"), one.alias("h"), F.col("w1").alias("u"), F.col("w2").alias("v"), "doc")
        whole = kind.where(F.col("n") >= self.min_chars).select(F.lit(2).alias("t"), "h", F.col("a1").alias("u"), F.col("a2").alias("v"), "doc")
        held = written(groups.unionByName(windows).unionByName(whole).distinct(), "held")
        span = F.struct(F.count("*").alias("n"), F.sum(F.xxhash64("doc").cast("decimal(20,0)")).cast("string").alias("s"))
        known = held.groupBy("t", "h", "u", "v").agg(span.alias("span")).where("span.n > 1")
        return written(held.join(known, ["t", "h", "u", "v"]).select("doc", "span").distinct(), "classes")

    def degrees(self) -> DataFrame:
        """``doc, links``: with how many other representatives each one shares a span.

        Spans of up to ``SHARD`` holders are expanded into pairs. Of those with
        more, the holders are counted: representatives with the same set of
        such spans are one combination, and a representative is linked to all
        of every combination that has a span of its own. So no pairs are made
        within a large class.
        """
        classes = self.classes()
        often = classes.where(F.col("span.n") > SHARD).groupBy("doc").agg(F.array_sort(F.collect_set("span")).alias("set"))
        often = written(often, "often")
        combos = often.groupBy("set").agg(F.count("*").alias("m"))
        each = combos.select("set", "m", F.explode("set").alias("span"))
        near = each.select(F.col("set"), "span").join(each.select(F.col("set").alias("other"), "m", "span"), "span").select("set", "other", "m").distinct()
        many = often.join(near.groupBy("set").agg((F.sum("m") - 1).alias("many")), "set").select("doc", "many")
        few = classes.where(F.col("span.n") <= SHARD)
        pairs = few.join(few.withColumnRenamed("doc", "other"), "span").where("doc <> other").select("doc", "other").distinct()
        pairs = pairs.join(often.select("doc", "set"), "doc", "left").join(often.select(F.col("doc").alias("other"), F.col("set").alias("set2")), "other", "left")
        apart = ~F.coalesce(F.arrays_overlap("set", "set2"), F.lit(False))
        some = pairs.where(apart).groupBy("doc").agg(F.count("*").alias("some"))
        return many.join(some, "doc", "full").select("doc", (F.coalesce("many", F.lit(0)) + F.coalesce("some", F.lit(0))).alias("links"))

    def pairs(self) -> DataFrame:
        """``doc_id_a, doc_id_b``: all pairs of records, copies expanded."""
        m = self.copies.select("doc", "rep")
        a, b = m.select(F.col("rep").alias("a"), F.col("doc").alias("x")), m.select(F.col("rep").alias("b"), F.col("doc").alias("y"))
        across = self.links().join(a, "a", "left").join(b, "b", "left").select(F.coalesce("x", "a").alias("x"), F.coalesce("y", "b").alias("y"))
        copies = m.select("rep", F.col("doc").alias("x")).join(m.select("rep", F.col("doc").alias("y")), "rep").where("x < y").select("x", "y")
        return across.unionByName(copies).select(F.least("x", "y").alias("doc_id_a"), F.greatest("x", "y").alias("doc_id_b"))

    def shared(self) -> DataFrame:
        """``doc, rep, shared_chars, links``: a record's class, its characters that stand in another record, and the other texts it shares with.

        One row for every record that shares a span or has a copy; the whole
        text of a record with a copy is shared. The spans of a record are at
        most as many as its characters.
        """
        m = self.contexts.select("h", F.col("c1").alias("a1"), F.col("c2").alias("a2"), "doc", "start", F.length("around").alias("n"))
        twice = m.groupBy("h", "a1", "a2").agg(F.min("doc").alias("p"), F.max("doc").alias("q")).where("p < q").select("h", "a1", "a2")
        spans = self.kind_spans.join(m, ["h", "a1", "a2"]).select("doc", (F.col("start") + F.col("x")).alias("x"), (F.col("start") + F.col("y")).alias("y"))
        whole = m.where(F.col("n") >= self.min_chars).join(twice, ["h", "a1", "a2"], "left_semi").select("doc", F.col("start").alias("x"), (F.col("start") + F.col("n")).alias("y"))
        length = F.aggregate(
            F.array_sort(F.collect_set(F.struct("x", "y"))),
            F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")),
            lambda acc, s: F.struct(F.greatest(acc["upto"], s["y"]).alias("upto"), (acc["n"] + F.greatest(F.lit(0), s["y"] - F.greatest(acc["upto"], s["x"]))).alias("n")),
            lambda acc: acc["n"],
        )
        covered = spans.unionByName(whole).groupBy("doc").agg(length.cast("long").alias("covered"))
        degree = self.degrees()
        reps = covered.join(degree, "doc", "full")
        return (
            reps.withColumnRenamed("doc", "rep")
            .join(self.copies, "rep", "full")
            .select(F.coalesce("doc", "rep").alias("doc"), "rep", F.when(F.col("n").isNotNull(), F.col("n")).otherwise(F.col("covered")).alias("shared_chars"), F.coalesce("links", F.lit(0)).cast("long").alias("links"))
        )
