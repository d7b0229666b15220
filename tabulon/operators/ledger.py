"""Time ledgers: totals, covered time, pairing of starts and ends, and a circuit breaker over attempts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def phase_totals(df: DataFrame, phases: Sequence[str], phase: str, seconds: str) -> DataFrame:
    """(phase, events, seconds) for every phase, those without events included."""
    all_ = df.sparkSession.createDataFrame([(p,) for p in phases], "phase string")
    got = df.groupBy(F.col(phase).alias("phase")).agg(F.count("*").alias("events"), F.sum(F.col(seconds).cast("decimal(20,6)")).alias("seconds"))
    return all_.join(F.broadcast(got), "phase", "left").select("phase", F.coalesce("events", F.lit(0)).alias("events"), F.coalesce("seconds", F.lit(0).cast("decimal(30,6)")).cast("double").alias("seconds"))


def covered_time(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """(key, islands, covered): length of the union of the closed intervals of each key.

    Intervals that touch are one. The events of one key are sorted together.
    """
    w = Window.partitionBy(key).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    steps = df.select(key, F.col(start).alias("s"), F.col(end).alias("e"), reach.alias("reach"))
    added = F.when(F.col("reach").isNull() | (F.col("s") > F.col("reach")), F.col("e") - F.col("s")).when(F.col("e") > F.col("reach"), F.col("e") - F.col("reach")).otherwise(0)
    island = F.when(F.col("reach").isNull() | (F.col("s") > F.col("reach")), 1).otherwise(0)
    return steps.groupBy(key).agg(F.sum(island).cast("long").alias("islands"), F.sum(added).cast("long").alias("covered"))


def streaks(df: DataFrame, key: str, order: Sequence[str], failed: str, ignored: str, limit: int = 2) -> DataFrame:
    """Every attempt with ``streak`` (failures in a row up to it) and ``open`` (whether they reach ``limit``).

    ``failed`` and ``ignored`` are boolean columns; an attempt that is neither
    is a success and ends the streak, an ignored one leaves it.
    """
    w = Window.partitionBy(key).orderBy(*order)
    run = F.sum(F.when(~F.col(failed) & ~F.col(ignored), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    df = df.withColumn("run", run)
    streak = F.sum(F.when(F.col(failed) & ~F.col(ignored), 1).otherwise(0)).over(Window.partitionBy(key, "run").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("streak", streak.cast("long")).withColumn("open", F.col("streak") >= limit).drop("run")


def pairs(df: DataFrame, label: str, order: Sequence[str], kind: str, start: str, end: str) -> DataFrame:
    """Starts with the end that follows them, if one does before the next start of the label; open ones have none."""
    w = Window.partitionBy(label).orderBy(*order)
    both = df.where(F.col(kind).isin(start, end)).withColumn("next_kind", F.lead(kind).over(w)).withColumn("next_at", F.lead(order[0]).over(w))
    return both.where(F.col(kind) == start).withColumn("ended_at", F.when(F.col("next_kind") == end, F.col("next_at"))).drop("next_kind", "next_at")


def sessions(df: DataFrame, key: str, order: Sequence[str], idle: int) -> DataFrame:
    """(key, sessions, longest): sessions of each key, ended by more than ``idle`` without an event, and the most events of one."""
    w = Window.partitionBy(key).orderBy(*order)
    gap = F.col(order[0]) - F.lag(order[0]).over(w)
    rows = df.withColumn("_new", F.when(gap.isNull() | (gap > idle), 1).otherwise(0))
    rows = rows.withColumn("_session", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(key, "_session").agg(F.count("*").alias("n")).groupBy(key).agg(F.max("_session").alias("sessions"), F.max("n").alias("longest"))
