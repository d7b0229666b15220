"""Checks of records against their sources: first failing test, repeated identities, hashes, replays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import number


def first_failure(tests: Sequence[tuple[Column, str]]) -> Column:
    """Name of the first test that fails, null if all hold; a null test fails. Later tests aren't evaluated."""
    out = None
    for test, name in tests:
        failed = ~F.coalesce(test, F.lit(False))
        out = F.when(failed, name) if out is None else out.when(failed, name)
    return out


def record_tests(indicators: Sequence[str], first: int, last: int) -> list[tuple[Column, str]]:
    """The ordered tests of a table candidate."""
    c = F.col
    return [
        (c("year").between(first, last), "YEAR_OUTSIDE_WINDOW"),
        (c("indicator").isin(list(indicators)), "INDICATOR_NOT_KEPT"),
        (c("value").isNotNull() & ~F.isnan("value"), "VALUE_NOT_FINITE"),
        (~c("is_derived"), "DERIVED_VALUE"),
        (F.length("id") == 24, "IDENTITY_MALFORMED"),
        (c("file").isNotNull() & (c("file") != "") & (F.length("sha256") == 64), "EVIDENCE_MISSING"),
        (number(c("value_text")).isNull() | (number(c("value_text")) == c("value")), "CELL_VALUE_DIFFERS"),
        (c("city").isNotNull() & (c("city") != ""), "CITY_MISSING"),
        (c("edition") >= c("year"), "EDITION_BEFORE_YEAR"),
        (c("source_class").isin("yearbook", "communique", "government_document"), "CLASS_UNKNOWN"),
        (F.length("source_row_id") == 24, "ROW_IDENTITY_MALFORMED"),
        (c("capture_manifest").isNotNull() & (c("capture_manifest") != ""), "CAPTURE_MISSING"),
    ]


def repeated(df: DataFrame, key: str) -> DataFrame:
    """(key, rows) of the keys that occur more than once, nulls aside."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows")).where("rows > 1")


def hash_status(records: DataFrame, captures: DataFrame) -> DataFrame:
    """(row_id, status): whether a living capture of the record's file has its hash.

    'matched', 'mismatch' (captured, other hash), 'uncaptured'. Captures are
    reduced to one row for each (file, hash) before the join, and to one for
    each file with a hash.
    """
    pairs = captures.where("deleted_at is null and file is not null and sha256 is not null").select("file", "sha256").distinct()
    met = records.select("row_id", "file", "sha256").join(pairs.withColumn("same", F.lit(True)), ["file", "sha256"], "left")
    met = met.join(pairs.select("file").distinct().withColumn("there", F.lit(True)), "file", "left")
    return met.select("row_id", F.when(F.col("there").isNull(), "uncaptured").when(F.col("same"), "matched").otherwise("mismatch").alias("status"))


def replay_mismatch(records: DataFrame) -> DataFrame:
    """(row_id, field): the first field in which a record differs from the value read again from its cell.

    Cells that hold no plain number can't be replayed and are left out.
    """
    again = number(F.col("value_text"))
    field = F.when(F.col("value").isNull(), "value").when(again != F.col("value"), "value")
    return records.where(again.isNotNull()).select("row_id", field.alias("field")).where("field is not null")


def digest(*columns: str) -> Column:
    """SHA-256 of the columns, nulls marked, as a key for caches."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]), 256)
