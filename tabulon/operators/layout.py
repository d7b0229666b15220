"""Recognised words of pages: row bands, literal groups, columns by intervals, repeated words of overlapping tiles."""

from __future__ import annotations

import statistics
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.text import number, stripped

PAGE = ("source_sha256", "page")


def by_group(df: DataFrame, key: Sequence[str], order: Sequence[str], fn, columns: Sequence[str], schema: str) -> DataFrame:
    """Applies ``fn`` (list of rows of one group, in order) to every group of ``key`` and yields its rows.

    Groups are streamed out of sorted partitions, so there is no cost for each
    group beyond the function's; a group is a page of words, which is bounded.
    """
    names = [f.name for f in T._parse_datatype_string(schema).fields] if hasattr(T, "_parse_datatype_string") else None
    target = df.sparkSession.createDataFrame([], schema).schema
    names = names or target.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(target)

        def pack(rows):
            return pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=arrow)

        now, group, out = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                k = tuple(row[c] for c in key)
                if k != now:
                    if group:
                        out.extend(fn(group))
                    now, group = k, []
                group.append(row)
            if len(out) > 20_000:
                yield pack(out)
                out = []
        if group:
            out.extend(fn(group))
        yield pack(out)

    return df.select(*columns).repartition(*key).sortWithinPartitions(*key, *order).mapInArrow(run, target)


class _Band:
    """A row of words: its middle is the median of the middles of those words that are not small beside the newest."""

    __slots__ = ("heights", "middle", "middles", "number", "tall")

    def __init__(self, number: int):
        self.number, self.middle, self.tall = number, 0.0, 0.0
        self.middles: list[float] = []
        self.heights: list[float] = []

    def reach(self, height: float) -> float:
        """How far from the middle a word of this height may lie."""
        return max(12.0, min(40.0, 0.55 * max(height, self.tall)))

    def take(self, middle: float, height: float) -> None:
        self.middles.append(middle)
        self.heights.append(height)
        self.tall = max(self.tall, height)
        self.middle = statistics.median(m for m, h in zip(self.middles, self.heights) if h >= 0.6 * height)


def bands_of(words: list[dict]) -> list[tuple[int, int, float, float]]:
    """(word_id, band, middle, tall) of the words of one page; middle and height are those of the finished band.

    Words go down the page by the middle of their height; one joins the first
    of the last five bands whose middle is near, within 0.55 of the greater
    height but 12 at least and 40 at most. Words without a place have no band.
    """
    placed = sorted((w["y"] + w["h"] / 2, w["word_id"], w["h"]) for w in words if w["y"] is not None and w["h"] is not None)
    bands: list[_Band] = []
    of: list[tuple[int, _Band]] = []
    for middle, word, height in placed:
        near = (b for b in bands[-5:] if abs(b.middle - middle) <= b.reach(height))
        band = next(near, None)
        if band is None:
            band = _Band(len(bands))
            bands.append(band)
        band.take(middle, height)
        of.append((word, band))
    return [(word, band.number, band.middle, band.tall) for word, band in of]


def row_bands(words: DataFrame) -> DataFrame:
    """(word_id, band, middle, tall) of every word with a place; repeated recognitions of a page are banded together.

    The words of a page are gathered in one task: a page holds what was
    printed on it, however large the corpus is.
    """
    return by_group(words, PAGE, ("word_id",), bands_of, ["word_id", *PAGE, "y", "h"], "word_id long, band int, middle double, tall double")


def undoubled(words: list[dict]) -> list[tuple[int]]:
    """word_id of the words kept when a later one with the same text within 5 points of a kept one is dropped."""
    kept: list[dict] = []
    for w in words:
        if not any(k["text"] == w["text"] and abs(k["x"] - w["x"]) < 5 and abs(k["y"] - w["y"]) < 5 for k in kept if None not in (k["x"], k["y"], w["x"], w["y"])):
            kept.append(w)
    return [(w["word_id"],) for w in kept]


def without_tile_copies(words: DataFrame) -> DataFrame:
    """(word_id) of the words left when repeated ones of overlapping tiles are dropped, greedily in page order."""
    return by_group(words, (*PAGE, "text"), ("word_index", "word_id"), undoubled, ["word_id", *PAGE, "text", "word_index", "x", "y"], "word_id long")


def literal_text(c: Column) -> Column:
    """Text with full-width points, commas and percent signs made half-width, and without spaces at its ends."""
    return F.translate(stripped(c), "．，％", ".,%")


def with_literals(words: DataFrame, line: Sequence[str]) -> DataFrame:
    """(line, literal, first_word, c, lo, hi): the numbers of each line, put together from neighbouring words of digits and signs.

    Words in order of x are one literal while the gap to the word before stays
    under max(10, 0.7 of the lesser height); what then reads as no number is
    left out. ``c`` is the mean of the words' centres, ``lo`` and ``hi`` the
    ends, as parts of the page's width.
    """
    groups = literal_groups(words, line)
    width = F.first("page_width")
    found = groups.groupBy(*line, "literal").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x", "word_id", "bare"))), lambda s: s["bare"]), "").alias("t"),
        F.min(F.struct("x", "word_id"))["word_id"].alias("first_word"),
        (F.avg(F.col("x") + F.col("w") / 2) / width).alias("c"),
        (F.min("x") / width).alias("lo"),
        (F.max(F.col("x") + F.col("w")) / width).alias("hi"),
    )
    return found.where(number(F.col("t")).isNotNull()).select(*line, F.col("t").alias("literal"), "first_word", "c", "lo", "hi")


def literal_groups(words: DataFrame, line: Sequence[str]) -> DataFrame:
    """Words of digits and signs with ``bare``, their text, and ``literal``, the number of their group in the line."""
    w = Window.partitionBy(*line).orderBy("x", "word_id")
    some = words.withColumn("bare", literal_text(F.col("text"))).where(F.col("bare").rlike(r"^[0-9.,+\-%]+\z") & F.col("x").isNotNull() & F.col("w").isNotNull() & F.col("h").isNotNull())
    gap = F.col("x") - F.lag(F.col("x") + F.col("w")).over(w)
    wide = F.when(gap.isNull() | (gap >= F.greatest(F.lit(10.0), 0.7 * F.least("h", F.lag("h").over(w)))), 1).otherwise(0)
    return some.withColumn("wide", wide).withColumn("literal", F.sum("wide").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).drop("wide")


def in_columns(words: DataFrame, bounds: Sequence[tuple[str, float, float]]) -> DataFrame:
    """(word_id, col, hits): the column whose half-open interval holds the word's centre, and how many columns do.

    Few bounds compile into expressions; no join is needed.
    """
    centre = (F.col("x") + F.col("w") / 2) / F.col("page_width")
    tests = [(centre >= lo) & (centre < hi) for _, lo, hi in bounds]
    hits = sum((F.coalesce(t, F.lit(False)).cast("int") for t in tests), F.lit(0))
    first = F.coalesce(*[F.when(t, F.lit(name)) for (name, _, _), t in zip(bounds, tests)])
    return words.select("word_id", F.when(hits == 1, first).alias("col"), hits.alias("hits"))


def boundary_codes(words: DataFrame) -> DataFrame:
    """(source_sha256, pages, labels, code): why a source's layout can't be read as one page of one city, if so."""
    label = F.regexp_extract("text", r"^#?([一-鿿]{2,}(?:自治州|地区|市|县|区|盟|旗))[①-⑤*]*$", 1)
    generic = ("城市", "全市", "地区", "市辖区", "全区", "全县")
    named = F.when((label != "") & ~label.isin(*generic), label)
    got = words.groupBy("source_sha256").agg(F.count_distinct("page").alias("pages"), F.count_distinct(named).alias("labels"))
    return got.withColumn("code", F.when(F.col("pages") > 1, "MULTIPAGE_LAYOUT_NOT_VALIDATED").when(F.col("labels") > 1, "MULTICITY_SCAN_LAYOUT_NOT_VALIDATED").otherwise("OK"))
