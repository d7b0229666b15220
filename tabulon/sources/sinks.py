"""Writing results: long and wide CSV, JSON lines, and a cache of results by digest."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.audit import digest

LONG = ("research_id", "city", "year", "indicator", "geographic_scope", "unit", "value", "source_class", "edition", "id")


def write_long(df: DataFrame, path: str, columns: Sequence[str] = LONG) -> None:
    """Selected records as CSV with a header; the job's commit is atomic. An empty selection is refused."""
    if df.isEmpty():
        raise ValueError("NO_PANEL_ROWS")
    df.select(*columns).write.mode("overwrite").option("header", True).csv(path)


def write_panel(df: DataFrame, path: str, keys: Sequence[str] = ("research_id", "year")) -> None:
    """A wide panel as CSV, sorted by its keys, missing cells empty."""
    if df.isEmpty():
        raise ValueError("NO_PANEL_ROWS")
    df.orderBy(*keys).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """Rows as JSON lines; null fields are kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def append_events(df: DataFrame, path: str) -> None:
    """Events added to a ledger."""
    df.write.mode("append").parquet(path)


def through_cache(spark: SparkSession, df: DataFrame, path: str, columns: Sequence[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Results of ``work`` for every row of ``df``, done only for rows whose digest over ``columns`` is not in the cache yet.

    ``work`` keeps the column ``digest``. Repeated rows are done once; any
    change of a column makes a new digest. New results are appended in one job.
    """
    keyed = df.withColumn("digest", digest(*columns))
    try:
        known = spark.read.parquet(path)
    except Exception as e:  # nothing cached so far
        if "PATH_NOT_FOUND" not in str(e):
            raise
        known = None
    new = keyed.dropDuplicates(["digest"])
    if known is not None:
        new = new.join(known.select("digest"), "digest", "left_anti")
    work(new).write.mode("append").parquet(path)
    return spark.read.parquet(path).join(keyed.select("digest").distinct(), "digest", "left_semi")
