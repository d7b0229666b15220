"""What to acquire next: gaps, documented gaps, yields, ranking, and the gate before export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..tables import written

KEY = ("research_id", "year", "indicator")


def expected_keys(catalog: DataFrame, first: int, last: int, indicators: Sequence[str]) -> DataFrame:
    """One row for each entry, year and indicator; made by exploding two short arrays."""
    years = F.explode(F.sequence(F.lit(first), F.lit(last))).alias("year")
    names = F.explode(F.array(*map(F.lit, indicators))).alias("indicator")
    return catalog.select("research_id", years).select("research_id", "year", names)


def gaps(expected: DataFrame, present: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Expected keys without a present row."""
    return expected.join(present.select(*key).distinct(), list(key), "left_anti")


def documented(missing: DataFrame, checks: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Missing keys for which a check names a reason and a source, with status missing, unavailable or scope_mismatch."""
    good = checks.where(F.col("status").isin("missing", "unavailable", "scope_mismatch") & (F.coalesce("reason", F.lit("")) != "") & (F.coalesce(F.size("source_refs"), F.lit(0)) > 0))
    return missing.join(good.select(*key).distinct(), list(key), "left_semi")


def table_yields(mapping: DataFrame, present: DataFrame) -> DataFrame:
    """(file, table_index, expected, missing, density) of every mapped table.

    Expected are the (indicator, year) of its columns; missing those without
    a present row of the same file and table. Density is null without any.
    """
    want = mapping.where("file is not null").select("file", "table_index", F.explode("columns").alias("c")).select("file", "table_index", "c.indicator", "c.year").distinct()
    have = present.where("file is not null and file <> ''").select("file", "table_index", "indicator", "year", F.lit(1).alias("got")).distinct()
    met = want.join(have, ["file", "table_index", "indicator", "year"], "left")
    out = met.groupBy("file", "table_index").agg(F.count("*").alias("expected"), F.count(F.when(F.col("got").isNull(), 1)).alias("missing"))
    return out.withColumn("density", F.round(F.col("missing") / F.expr("nullif(expected, 0)"), 6))


def table_action(tables: DataFrame, level: str = "level", reviewed: str = "reviewed") -> DataFrame:
    """``tables`` with ``action``: from expected, missing and reviewed, then overridden by the level, in this order."""
    base = (
        F.when(F.col("expected") == 0, "inspect_unknown_coverage")
        .when((F.col("missing") == 0) & F.col(reviewed), "reuse_reviewed_table")
        .otherwise("acquire_or_reuse_table")
    )
    action = (
        F.when(F.col(level).isin("county", "district", "national"), "exclude_outside_province_city_collection_levels")
        .when((F.col(level) == "city") & (F.col("unlocked") == 0), "defer_lower_yearbook_until_documented_upper_gaps")
        .when(F.col(level).isNull() & (F.col("expected") > 0) & (base != "reuse_reviewed_table"), "inspect_publication_level_metadata_only")
        .otherwise(base)
    )
    return tables.withColumn("action", action)


def acquisition_order(tables: DataFrame) -> list:
    """Sort keys: deferred and excluded last; unknown level, province, city, others; then density, missing and edition, all descending."""
    late = F.col("action").rlike("^(defer|exclude)").cast("int")
    level = F.when(F.col("level").isNull(), 0).when(F.col("level") == "province", 1).when(F.col("level") == "city", 2).otherwise(9)
    return [late, level, F.desc("density"), F.desc("missing"), F.desc("edition"), F.asc("file"), F.asc("table_index")]


def placed(rows: DataFrame, order: Sequence) -> DataFrame:
    """``rows`` with ``place``, their number from 1 in ``order``, which must be total.

    Sorted by range partitions, which are written with their number, since
    ranges are sampled anew in each run. A place is the row's number within
    its partition plus the rows of the partitions before it.
    """
    parts = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()), "placed")
    # one row for each partition
    before = F.sum("rows").over(Window.partitionBy(F.lit(1)).orderBy("part")) - F.col("rows")
    offsets = parts.groupBy("part").agg(F.count("*").alias("rows")).select("part", before.alias("before"))
    within = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return parts.withColumn("n", within).join(F.broadcast(offsets), "part").withColumn("place", F.col("before") + F.col("n")).drop("part", "before", "n")


def city_actions(catalog: DataFrame, unlocked: DataFrame) -> DataFrame:
    """(research_id, action): municipalities reuse the province layer, others wait until a gap is documented."""
    met = catalog.join(unlocked.select("research_id").distinct().withColumn("open", F.lit(True)), "research_id", "left")
    action = F.when(F.col("city_level") == "municipality", "reuse_province_layer").when(F.col("open").isNull(), "defer_until_provincial_gap_checked").otherwise("use_supplied_city_url")
    return met.select("research_id", action.alias("action"))


def export_gate(outcomes: DataFrame, key: str) -> DataFrame:
    """(key, selected, unresolved, ready): a batch is ready if it selects something and nothing is pending or in conflict."""
    n = lambda *names: F.count(F.when(F.col("outcome").isin(*names), 1))
    got = outcomes.groupBy(key).agg(n("selected").alias("selected"), n("pending", "conflict").alias("unresolved"))
    return got.withColumn("ready", (F.col("selected") > 0) & (F.col("unresolved") == 0))


def traverse(edges: DataFrame, seeds: DataFrame, depth: int) -> DataFrame:
    """(node, depth) of the nodes reached within ``depth`` steps, each at its least depth.

    ``edges``: (src, dst); ``seeds``: (node). One join for each step, against
    the new nodes only.
    """
    seen = seeds.select("node").distinct().withColumn("depth", F.lit(0))
    front = seen
    for d in range(1, depth + 1):
        step = edges.join(front.select(F.col("node").alias("src")), "src").select(F.col("dst").alias("node")).where("node is not null").distinct()
        front = step.join(seen, "node", "left_anti").withColumn("depth", F.lit(d))
        seen = seen.unionByName(front)
    return seen
