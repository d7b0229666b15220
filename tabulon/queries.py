"""All queries outside ``llm`` by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import orphans, units
from .plans import evidence, publication  # noqa: F401 - registers its queries with those of evidence
from .tables import table


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans.statistical_orphans(spark, lambda name: table(spark, sf_dir, name))


def p3_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_found(spark, sf_dir).groupBy("ref_field", "period").agg(F.count("*").alias("orphans"))


def p3_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans.orphan_snapshots(spark, lambda name: table(spark, sf_dir, name))


def _values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "candidates").select("row_id", "unit", "value", "value_text", "file", "table_index", "indicator", "year")
    return units.common_values(rows, table(spark, sf_dir, "table_mapping"), table(spark, sf_dir, "unit_catalog"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units.uncommon_units(_values(spark, sf_dir), table(spark, sf_dir, "unit_catalog"))


def p5_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _values(spark, sf_dir).select("row_id", "unit_code", "unit_source", "common_value", "posterior", "uncertain")


_ORPHANS = """
SELECT '{t}.{f}' AS ref_field, strftime(r.{time}, '%Y-%m') AS period, r.{rid} AS row_id
FROM {t} r
LEFT JOIN (SELECT {key} AS k, min({at}) AS first FROM {target} WHERE {gone} IS NULL AND {key} IS NOT NULL GROUP BY 1) p ON p.k = r.{f}
WHERE r.{f} IS NOT NULL AND r.{f} <> '' AND NOT coalesce(p.first <= r.{time}, false)
"""
_P3 = " UNION ALL ".join(_ORPHANS.format(t=t, rid=rid, f=f, time=time, target=target, key=key, at=at, gone=gone) for t, rid, f, time, target, _, key, at, gone in orphans.REFERENCES)

_SNAPSHOTS = """
SELECT '{t}.{f}' AS ref_field, '{end}' AS cutoff, strftime(r.{time}, '%Y-%m') AS period, count(*) AS orphans
FROM (SELECT * FROM {t} WHERE {came} < '{end}') r
LEFT JOIN (SELECT {key} AS k, min({at}) AS first FROM {target} WHERE {there} < '{end}' AND NOT coalesce({gone} < '{end}', false) AND {key} IS NOT NULL GROUP BY 1) p ON p.k = r.{f}
WHERE r.{f} IS NOT NULL AND r.{f} <> '' AND NOT coalesce(p.first <= r.{time}, false) GROUP BY 1, 2, 3
"""
_P3_SNAPSHOTS = " UNION ALL ".join(
    _SNAPSHOTS.format(t=t, f=f, time=time, target=target, key=key, at=at, gone=gone, came=orphans.ARRIVALS[t], there=orphans.ARRIVALS[target], end=end)
    for t, rid, f, time, target, _, key, at, gone in orphans.REFERENCES
    for end in orphans.CUTOFFS
)

QUERIES: dict[str, Callable] = {f.__name__: f for f in (p3_found, p3_counts, p3_snapshots, p5_found, p5_values)} | evidence.QUERIES
SQL: dict[str, str] = evidence.SQL | {
    "p3_found": _P3,
    "p3_snapshots": _P3_SNAPSHOTS,
    "p3_counts": f"SELECT ref_field, period, count(*) AS orphans FROM ({_P3}) GROUP BY 1, 2",
}
