"""Held-out test passages inside a corpus, by winnowed fingerprints."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .winnow import chunks, kept, points

#: Test fingerprints up to this number go to the executors as a filter (8 bytes each); more are only joined.
FILTER_BOUND = 1_000_000
#: Characters carried on either side of a hit, so that it can be extended.
AROUND = 400

_FOLD: list[np.ndarray] = []


def _fold() -> np.ndarray:
    """For every code point what it counts as: 0 if it doesn't count."""
    if not _FOLD:
        out = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if unicodedata.category(ch) in ("Lu", "Ll", "Lt", "Lm", "Lo", "Nd"):
                half = unicodedata.normalize("NFKC", ch)
                low = (half if len(half) == 1 else ch).lower()
                out[c] = ord(low) if len(low) == 1 else c
        _FOLD.append(out)
    return _FOLD[0]


def counted(text: str) -> np.ndarray:
    """The characters of a text that count, as code points: letters, digits and Chinese characters, half-width and lower case."""
    x = _fold()[points(text)]
    return x[x > 0]


def _text(codes: np.ndarray) -> str:
    return codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


_PRINTS = "key {0}, h long, at int, off int, around string"


def _prints(df: DataFrame, key: str, text: str, k: int, w: int, only: np.ndarray | None) -> DataFrame:
    """Fingerprints of each text with the text around them; ``only``: sorted hashes to which they are restricted."""
    spark = df.sparkSession
    wanted = spark.sparkContext.broadcast(only) if only is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = wanted.value if wanted is not None else None
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in chunks(texts):
                codes = [counted(t) if t else np.empty(0, np.uint32) for t in texts[a:b]]
                lengths = np.array([len(c) for c in codes])
                h, doc, at = kept(np.concatenate(codes), lengths, k, w)
                if keep is not None and len(h):
                    i = np.searchsorted(keep, h)
                    i[i == len(keep)] = 0
                    hit = keep[i] == h if len(keep) else np.zeros(len(h), bool)
                    h, doc, at = h[hit], doc[hit], at[hit]
                if not len(h):
                    continue
                off = np.minimum(at, AROUND)
                around = [_text(codes[d][p - o : p + k + AROUND]) for d, p, o in zip(doc, at, off)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(doc + a)), pa.array(h), pa.array(at.astype(np.int32)), pa.array(off.astype(np.int32)), pa.array(around, pa.string())],
                    names=["key", "h", "at", "off", "around"],
                )

    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text is not null").mapInArrow(run, _PRINTS.format(df.schema[key].dataType.simpleString()))


def _same(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def leaked_spans(docs: DataFrame, items: DataFrame, doc_id: str, item_id: str, text: str = "text", item_text: str = "text", min_chars: int = 40) -> DataFrame:
    """Spans of at least ``min_chars`` counted characters that a document shares with a test item.

    Only letters, digits and Chinese characters count; full-width forms equal
    half-width ones, case is ignored. Returns ``doc_id, item_id, item_start,
    item_end`` (positions among the counted characters of the item); one row
    for each fingerprint that lies in such a span, so a span may occur more
    than once. A row's span reaches at most ``AROUND`` characters beyond its
    fingerprint; longer ones come out in overlapping pieces.

    Null, empty and short texts have no spans. Repeated documents and items
    each count. Empty tables give no rows. Other columns are not read.

    The fingerprints of the items go to the executors as a filter when there
    are at most ``FILTER_BOUND``; the result does not depend on it.
    """
    w = min_chars // 2
    k = min_chars - w + 1
    ours = _prints(items, item_id, item_text, k, w, None)
    only = None
    if ours.select("h").distinct().count() <= FILTER_BOUND:
        only = np.sort(np.array([r.h for r in ours.select("h").distinct().collect()], np.int64))
    theirs = _prints(docs, doc_id, text, k, w, only)
    both = theirs.select(F.col("key").alias("d"), "h", "off", "around").join(ours.select(F.col("key").alias("i"), "h", F.col("at").alias("at"), F.col("off").alias("off_i"), F.col("around").alias("around_i")), "h")

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            take, start, end = [], [], []
            for n, (off, x, at, off_i, y) in enumerate(zip(rows["off"], rows["around"], rows["at"], rows["off_i"], rows["around_i"])):
                if x[off : off + k] != y[off_i : off_i + k]:
                    continue
                left = _same(x[:off][::-1], y[:off_i][::-1])
                right = _same(x[off:], y[off_i:])
                if left + right >= min_chars:
                    take.append(n)
                    start.append(at - left)
                    end.append(at + right)
            picked = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("d").take(picked), batch.column("i").take(picked), pa.array(start, pa.int32()), pa.array(end, pa.int32())], names=[doc_id, item_id, "item_start", "item_end"])

    schema = T.StructType([T.StructField(doc_id, docs.schema[doc_id].dataType), T.StructField(item_id, items.schema[item_id].dataType), T.StructField("item_start", T.IntegerType()), T.StructField("item_end", T.IntegerType())])
    return both.select("d", "i", "off", "around", "at", "off_i", "around_i").mapInArrow(extend, schema)


def leak_report(spans: DataFrame, doc_id: str, item_id: str) -> DataFrame:
    """``doc_id, item_id, leaked_chars``: counted characters of the item that occur in the document, overlaps once.

    The distinct spans of a pair are at most as many as the item has characters.
    """
    covered = F.aggregate(
        F.array_sort(F.collect_set(F.struct("item_start", "item_end"))),
        F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["upto"], s["item_end"]).alias("upto"),
            (acc["n"] + F.greatest(F.lit(0), s["item_end"] - F.greatest(acc["upto"], s["item_start"]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )
    return spans.groupBy(doc_id, item_id).agg(covered.alias("leaked_chars"))
