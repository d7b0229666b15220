"""The queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.skew import join_unique
from ..tables import table, written
from .canonical import canonical_values
from .forms import consistent_forms, frequencies
from .leaks import leak_report, leaked_spans
from .mojibake import garbled_rows
from .representatives import Representatives
from .spans import SharedSpans
from .tokenize import encode_corpus


def p1_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return garbled_rows(table(spark, sf_dir, "captures"), "capture_id", "document_title")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_titles(spark, sf_dir).select("capture_id")


#: Fields that come in one consistent form: table, id and field.
FORMS = (("layout", "word_id", "text"), ("candidates", "row_id", "city"), ("candidates", "row_id", "value_text"))


def p2_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = None
    for name, _, field in FORMS:
        one = table(spark, sf_dir, name).select(F.col(field).alias("text"))
        texts = one if texts is None else texts.unionByName(one)
    counts = frequencies(texts, "text")  # one count, so that all fields come in one form
    out = None
    for name, key, field in FORMS:
        one = consistent_forms(table(spark, sf_dir, name), [key], field, counts)
        one = one.select(F.lit(f"{name}.{field}").alias("field"), F.col(key).alias("row_id"), "form", "changed")
        out = one if out is None else out.unionByName(one)
    return out


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_forms(spark, sf_dir).where("changed").select("field", "row_id")


def p4_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct city typed without an id, and the entry it means."""
    rows, catalog = table(spark, sf_dir, "candidates"), table(spark, sf_dir, "city_catalog")
    names = catalog.select(F.col("research_id").alias("entry"), F.explode(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("spelling"))
    seen = rows.where("research_id is not null and city is not null").select(F.col("research_id").alias("entry"), F.col("city").alias("spelling")).join(catalog.select(F.col("research_id").alias("entry")), "entry", "left_semi")
    provinces = [r.province for r in catalog.select("province").distinct().collect()]
    return canonical_values(rows.where("research_id is null"), "city", names.unionByName(seen), provinces)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "candidates").where("research_id is null and city is not null").select("row_id", "city")
    meant = written(p4_values(spark, sf_dir).select(F.col("value").alias("city"), F.col("entry").alias("research_id")), "meant")
    return join_unique(rows, meant, "city").select("row_id", "research_id")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Representatives(table(spark, sf_dir, "candidates")).survivors().select("row_id")


def p6_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Representatives(table(spark, sf_dir, "candidates")).trusted()


def p6_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Representatives(table(spark, sf_dir, "candidates")).values()


def p6_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the quality model is fitted on: the patterns of sources that state a value or leave it out."""
    return Representatives(table(spark, sf_dir, "candidates")).patterns()


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(table(spark, sf_dir, "documents"), "doc_id")


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), "doc_id", "item_id")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir).select("doc_id", "item_id").distinct()


def p8_leaked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak_report(_leaks(spark, sf_dir), "doc_id", "item_id")


def _spans(spark: SparkSession, sf_dir: str) -> SharedSpans:
    return SharedSpans(table(spark, sf_dir, "documents"), "doc_id")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spans(spark, sf_dir).pairs()


def p9_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spans(spark, sf_dir).shared().select(F.col("doc").alias("doc_id"), F.col("rep").alias("class_id"), "shared_chars", "links")


QUERIES = {f.__name__: f for f in (p1_titles, p1_found, p2_forms, p2_found, p4_values, p4_found, p6_found, p6_records, p6_values, p6_patterns, p7_ids, p8_found, p8_leaked, p9_found, p9_shared)}

_BIT = "CASE source_class WHEN 'yearbook' THEN 1 WHEN 'communique' THEN 2 WHEN 'government_document' THEN 4 ELSE 8 END"

SQL: dict[str, str] = {
    "p6_patterns": f"""
WITH m AS (SELECT batch_id, research_id, year, indicator, geographic_scope, value, {_BIT} AS b FROM candidates WHERE research_id IS NOT NULL AND withdrawn_at IS NULL),
g AS (SELECT batch_id, research_id, year, indicator, geographic_scope, bit_or(b) AS everyone, count(*) AS n FROM m GROUP BY ALL),
s AS (SELECT batch_id, research_id, year, indicator, geographic_scope, value, bit_or(b) AS says FROM m WHERE value IS NOT NULL GROUP BY ALL)
SELECT says, everyone & ~says AS lacks, count(*) AS values FROM s JOIN g ON s.batch_id IS NOT DISTINCT FROM g.batch_id AND s.research_id = g.research_id AND s.year IS NOT DISTINCT FROM g.year
AND s.indicator IS NOT DISTINCT FROM g.indicator AND s.geographic_scope IS NOT DISTINCT FROM g.geographic_scope WHERE n > 1 GROUP BY 1, 2
""",
    "p6_found": """
SELECT row_id FROM (
  SELECT row_id, value,
    count(*) OVER (PARTITION BY batch_id, research_id, year, indicator, geographic_scope) AS n,
    row_number() OVER (
      PARTITION BY batch_id, research_id, year, indicator, geographic_scope
      ORDER BY value IS NULL,
        CASE source_class WHEN 'yearbook' THEN 0 WHEN 'communique' THEN 1 WHEN 'government_document' THEN 2 ELSE 3 END,
        edition DESC NULLS LAST,
        (city IS NULL)::INT + (unit IS NULL)::INT + (value_text IS NULL)::INT + (capture_manifest IS NULL)::INT,
        extracted_at DESC NULLS LAST, row_id) AS rn
  FROM candidates WHERE research_id IS NOT NULL AND withdrawn_at IS NULL
) WHERE n > 1 AND rn = 1 AND value IS NOT NULL
""",
}
