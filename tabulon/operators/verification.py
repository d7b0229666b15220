"""Checks of observations against their publications: authority, capture, titles, paths, and the gate that needs them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.skew import join_unique
from ..functions.text import norm
from .audit import first_failure
from .selection import decisions, filled

# Words of a title that a class of publication needs, and the modes of a capture over the network.
CLASS_WORDS = {"yearbook": ("年鉴", "Yearbook"), "communique": ("公报", "Communiqué", "Communique")}
NETWORK = ("network", "browser_network")
# Reports of an extraction that must not be verified any further.
UNFINISHED = ("unparsed", "empty_or_error", "partial_pending")


def supported(context: Column, *tokens: Column) -> Column:
    """Whether every token stands in the context, whitespace aside; null and empty tokens have no support."""
    out = F.lit(True)
    for t in tokens:
        bare = norm(t.cast("string"))
        out = out & F.coalesce((bare != "") & F.contains(norm(context), bare), F.lit(False))
    return out


def class_supported(source_class: Column, title: Column) -> Column:
    """Whether a title has a word of its class; classes without fixed words need none."""
    out = F.lit(True)
    for name, words in CLASS_WORDS.items():
        has = F.lit(False)
        for w in words:
            has = has | F.coalesce(F.contains(title, F.lit(w)), F.lit(False))
        out = F.when(source_class == name, has).otherwise(out)
    return out


def confined(path: Column) -> Column:
    """Whether a path is relative and stays inside its root, each step taken in order."""
    depth = F.aggregate(
        F.split(path, "/"),
        F.struct(F.lit(0).alias("at"), F.lit(0).alias("low")),
        lambda a, p: F.struct((a["at"] + F.when(p == "..", -1).when(p.isin("", "."), 0).otherwise(1)).alias("at"), F.least(a["low"], a["at"] + F.when(p == "..", -1).otherwise(0)).alias("low")),
        lambda a: a["low"],
    )
    return F.coalesce((path != "") & ~path.startswith("/") & ~path.rlike(r"^[A-Za-z]:") & (depth >= 0), F.lit(False))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, "^https?://(?:[^/@]*@)?([^/:?#]+)", 1))


def authorities(captures: DataFrame, registry: DataFrame) -> DataFrame:
    """(capture_id, authority): 'matched' if a network capture's host is registered, verified and of the captured publisher.

    ``registry``: (host, publisher, evidence_url, verified); entries without a
    publisher or an evidence address, or not verified, don't count; of several
    for a host the least publisher counts. 'offline' captures need no
    authority, 'unregistered' hosts and 'other_publisher' have none.
    """
    good = registry.where(F.col("verified") & filled("publisher") & filled("evidence_url")).groupBy("host").agg(F.min("publisher").alias("registered"))
    rows = captures.select("capture_id", "publisher", "capture_mode", host_of(F.col("final_url")).alias("host"))
    met = rows.join(good, "host", "left")
    state = (
        F.when(~F.coalesce(F.col("capture_mode").isin(*NETWORK), F.lit(False)), "offline")
        .when(F.col("registered").isNull(), "unregistered")
        .when(~F.col("publisher").eqNullSafe(F.col("registered")), "other_publisher")
        .otherwise("matched")
    )
    return met.select("capture_id", state.alias("authority"))


def last_captures(captures: DataFrame) -> DataFrame:
    """The latest living capture of each manifest."""
    best = F.max(F.struct("retrieved_at", "capture_id", "sha256", "file", "final_url", "document_title")).alias("b")
    return captures.where("manifest is not null and manifest <> '' and deleted_at is null").groupBy("manifest").agg(best).select("manifest", "b.*")


def chain(indicators: Sequence[str], first: int, last: int) -> list[tuple[Column, str]]:
    """The tests of a record that has met its catalogue name, its capture and its cell, in order; the first that fails counts."""
    c = F.col
    return [
        (c("year").between(first, last), "YEAR_OUTSIDE_WINDOW"),
        (c("indicator").isin(list(indicators)), "INDICATOR_NOT_KEPT"),
        (c("value").isNotNull() & ~F.isnan("value"), "VALUE_NOT_FINITE"),
        (~c("is_derived"), "DERIVED_VALUE"),
        (c("research_id").isNull() | (c("known_name") == c("city")), "IDENTITY_NOT_IN_CATALOG"),
        (filled("file") & confined(c("file")) & (F.length("sha256") == 64), "EVIDENCE_MISSING"),
        (c("cell").isNull() | (c("cell") == c("value")), "CELL_VALUE_DIFFERS"),
        (filled("city"), "CITY_MISSING"),
        (c("edition") >= c("year"), "EDITION_BEFORE_YEAR"),
        (c("source_class").isin("yearbook", "communique", "government_document"), "CLASS_UNKNOWN"),
        (c("capture_sha256").isNull() | (c("capture_sha256") == c("sha256")), "CAPTURE_INCONSISTENT"),
        (~c("authority").isin("unregistered", "other_publisher") | c("authority").isNull(), "CAPTURE_WITHOUT_AUTHORITY"),
    ]


def audited(records: DataFrame, captures: DataFrame, catalog: DataFrame, registry: DataFrame, cell: Column, indicators: Sequence[str], first: int, last: int) -> DataFrame:
    """(row_id, failure, capture_matched): the first failing test of every record, and whether a network capture of authority backs it.

    ``cell`` is the number its cell holds, null where it holds none. An id that
    several records have fails as DUPLICATE_IDENTITY if nothing else does.
    Captures, catalogue and ids are one row a key; hot manifests and ids meet
    them by broadcast.
    """
    last_one = last_captures(captures).join(authorities(captures, registry), "capture_id")
    last_one = last_one.select(F.col("manifest").alias("capture_manifest"), F.col("sha256").alias("capture_sha256"), "authority")
    cols = ("row_id", "id", "research_id", "city", "year", "indicator", "value", "is_derived", "file", "sha256", "edition", "source_class", "capture_manifest")
    rows = records.select(*cols, cell.alias("cell"))
    rows = rows.join(F.broadcast(catalog.select("research_id", F.col("name").alias("known_name"))), "research_id", "left")  # the catalogue is a fixed list
    rows = join_unique(rows, last_one, "capture_manifest")
    repeated = records.where("id is not null").groupBy("id").agg(F.count("*").alias("n")).where("n > 1")
    rows = join_unique(rows, repeated, "id")
    failure = F.coalesce(first_failure(chain(indicators, first, last)), F.when(F.col("n") > 1, "DUPLICATE_IDENTITY"))
    return rows.select("row_id", failure.alias("failure"), F.coalesce(F.col("authority") == "matched", F.lit(False)).alias("capture_matched"))


def approvals(records: DataFrame, audit: DataFrame, reviews: DataFrame) -> DataFrame:
    """(row_id, gate): 'rejected', 'approved', 'ambiguous' or 'pending' of every record, by its audit and its review.

    A rejection counts if it names the record's hash, a reviewer and a reason.
    An approval must also have a passed audit, a matched capture and, for page
    matrices, the hash of the plan; several different decisions decide nothing.
    ``records`` has id, sha256, kind and plan_sha256.
    """
    met = records.select("row_id", "id", "sha256", "kind", "plan_sha256").join(audit, "row_id", "left")
    met = join_unique(met, decisions(reviews, "plan_sha256").withColumnRenamed("plan_sha256", "review_plan").withColumnRenamed("record_id", "id"), "id")
    bound = F.coalesce(F.col("review_sha256") == F.col("sha256"), F.lit(False)) & filled("reviewer") & filled("reason")
    plan = ~F.coalesce(F.col("kind") == "ocr_matrix", F.lit(False)) | F.col("plan_sha256").eqNullSafe(F.col("review_plan"))
    passed = F.col("failure").isNull() & F.coalesce("capture_matched", F.lit(False))
    gate = (
        F.when(F.col("n_decisions") > 1, "ambiguous")
        .when(bound & (F.col("decision") == "reject"), "rejected")
        .when(bound & passed & plan & (F.col("decision") == "approve"), "approved")
        .otherwise("pending")
    )
    return met.select("row_id", gate.alias("gate"))


def upstream_gate(reports: DataFrame, key: str) -> DataFrame:
    """(key, ready, records): whether an extraction's output may be verified: it finished and has records."""
    done = ~F.coalesce(F.col("status").isin(*UNFINISHED), F.lit(False)) & (F.coalesce("records", F.lit(0)) > 0)
    return reports.select(key, done.alias("ready"), "records")
