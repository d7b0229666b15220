"""From candidates to a panel: eligibility, review gate, source priority, best version, conflicts, pivot.

Order of the tests: membership, scope, documented rejection, approval, rank,
grouping. Every row keeps an outcome; nothing is dropped silently.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

KEY = ("research_id", "year", "indicator", "geographic_scope")


def filled(c: str) -> Column:
    """Neither null nor empty."""
    return F.coalesce(F.col(c), F.lit("")) != ""


def in_window(df: DataFrame, indicators: Sequence[str], first: int, last: int) -> DataFrame:
    """Rows of the wanted indicators and years; both tests reach the scan."""
    return df.where(F.col("indicator").isin(list(indicators)) & F.col("year").between(first, last))


def priority_rank(rules: Sequence[dict]) -> Column:
    """Rank by the first rule that matches: number of rules minus its index, 0 if none does.

    A rule is a mapping from column to wanted value; the empty rule matches
    all. Few rules compile into one CASE, so no join is needed.
    """
    out = F.lit(0)
    for i, rule in reversed(list(enumerate(rules))):
        test = F.lit(True)
        for c, v in rule.items():
            test = test & F.coalesce(F.col(c) == F.lit(v), F.lit(False))
        out = F.when(test, len(rules) - i).otherwise(out)
    return out


def scope_allowed(rules: dict[str, Sequence[str] | None], default: Sequence[str] | None) -> Column:
    """Whether the scope fits the indicator's rule, else the default; no list allows everything."""

    def test(scopes):
        return F.lit(True) if scopes is None else F.coalesce(F.col("geographic_scope").isin(list(scopes)), F.lit(False))

    out = test(default)
    for indicator, scopes in rules.items():
        out = F.when(F.col("indicator") == indicator, test(scopes)).otherwise(out)
    return out


def decisions(reviews: DataFrame, *also: str) -> DataFrame:
    """One row for each record_id: its decision (with the columns ``also``) if there is one decision, and how many different ones.

    The same decision repeated is one. Combined before the shuffle; several
    decisions leave ``n_decisions`` above one and no decision counts.
    """
    same = F.struct("decision", "source_sha256", "reviewer", "reason", *also)
    return (
        reviews.where("record_id is not null and record_id <> ''")
        .groupBy("record_id")
        .agg(F.min(same).alias("lo"), F.max(same).alias("hi"))
        .select("record_id", (F.when(F.col("lo") == F.col("hi"), 1).otherwise(2)).alias("n_decisions"), "lo.*")
        .withColumnRenamed("source_sha256", "review_sha256")
    )


def review_gate(records: DataFrame, reviews: DataFrame) -> DataFrame:
    """``records`` with ``gate``: 'rejected', 'approved', 'ambiguous' (several decisions) or 'pending'.

    A decision counts only if it names the record's hash, a reviewer and a reason.
    """
    met = records.join(decisions(reviews), records["id"] == F.col("record_id"), "left")
    bound = F.coalesce(F.col("review_sha256") == F.col("sha256"), F.lit(False)) & filled("reviewer") & filled("reason")
    gate = (
        F.when(F.col("n_decisions") > 1, "ambiguous")
        .when(bound & (F.col("decision") == "reject"), "rejected")
        .when(bound & (F.col("decision") == "approve"), "approved")
        .otherwise("pending")
    )
    return met.withColumn("gate", gate).select(*records.columns, "gate")


def best_versions(df: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Rows that share the highest (rank, edition) of their key; ties stay.

    The best of a key is aggregated with partial results and joined back, so
    no key is gathered in one task for sorting.
    """
    keys = list(key)
    order = F.struct("rank", F.coalesce("edition", F.lit(-1)).alias("edition"))
    best = df.groupBy(*keys).agg(F.max(order).alias("best"))
    on = [df[k].eqNullSafe(best[k]) for k in keys]
    test = on[0]
    for x in on[1:]:
        test = test & x
    return df.join(best, test).where((df["rank"] == F.col("best.rank")) & (F.coalesce(df["edition"], F.lit(-1)) == F.col("best.edition"))).select(df["*"])


def versions(df: DataFrame, key: Sequence[str] = KEY, order: str = "row_id") -> DataFrame:
    """For each key: how many best rows, whether they disagree in (value, unit), and the first of them by ``order``."""
    stated = F.struct("value", "unit")
    return best_versions(df, key).groupBy(*key).agg(F.count("*").alias("best_rows"), (F.min(stated) != F.max(stated)).alias("conflict"), F.min(order).alias("first_row"))


def outcomes(df: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """``row_id, outcome`` of every row of ``df``.

    ``df`` has membership ``member``, ``scope_ok``, ``gate`` and ``rank``.
    Outcomes: 'excluded' (not a member, wrong scope or rejected), 'pending'
    (not approved or no rank), 'superseded' (a better version or an equal one
    before it), 'conflict' (best versions disagree), 'selected'.
    """
    early = (
        F.when(~F.col("member") | ~F.col("scope_ok") | (F.col("gate") == "rejected"), "excluded")
        .when((F.col("gate") != "approved") | (F.col("rank") == 0), "pending")
    )
    df = df.withColumn("early", early)
    live = df.where("early is null")
    best = best_versions(live, key).select("row_id", *key)
    groups = versions(live, key)
    on = [best[k].eqNullSafe(groups[k]) for k in key]
    test = on[0]
    for x in on[1:]:
        test = test & x
    late = best.join(groups, test).select("row_id", F.when(F.col("conflict"), "conflict").when(F.col("row_id") == F.col("first_row"), "selected").otherwise("superseded").alias("late"))
    return df.join(late, "row_id", "left").select("row_id", F.coalesce("early", "late", F.lit("superseded")).alias("outcome"))


def panel(df: DataFrame, rows: Sequence[str], label: str, value: str, labels: Sequence[str]) -> DataFrame:
    """Wide table: one row for each of ``rows``, one column for each label; missing stays null.

    Where rows disagree the cell stays null too: see ``panel_conflicts``.
    """
    cells = [F.min(F.when(F.col(label) == x, F.col(value))).alias(f"lo{i}") for i, x in enumerate(labels)]
    tops = [F.max(F.when(F.col(label) == x, F.col(value))).alias(f"hi{i}") for i, x in enumerate(labels)]
    wide = df.groupBy(*rows).agg(*cells, *tops)
    return wide.select(*rows, *[F.when(F.col(f"lo{i}") == F.col(f"hi{i}"), F.col(f"lo{i}")).alias(x) for i, x in enumerate(labels)])


def panel_conflicts(df: DataFrame, rows: Sequence[str], label: str, value: str) -> DataFrame:
    """Cells of the panel whose rows disagree."""
    return df.groupBy(*rows, label).agg(F.min(value).alias("least"), F.max(value).alias("most")).where("least <> most")


def numbered(df: DataFrame, key: Sequence[str], order: Sequence[Column], name: str = "n") -> DataFrame:
    """Rows numbered within their key."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
