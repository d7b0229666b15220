"""Finding publications: what a link is, bounded visits, what a title states, and identities of what was found."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Parts a key is split into before its first rows are taken.
SALT = 64


def yearbook_role(links: DataFrame, book_context: Column) -> DataFrame:
    """``links`` with ``edition`` and ``role``: 'entry', 'pending', 'queue' or 'drop'.

    A link that names a yearbook and a year is an entry; a bare year is one
    only in a book's context and outside searches, else it is pending. Other
    yearbook links and frames are queued. A page's link to itself (``own``) is
    dropped unless it is the title of the page itself that names the book.
    """
    title = F.col("text")
    book = title.contains("年鉴") | title.contains("Yearbook")
    year = F.regexp_extract(title, "((?:19|20)[0-9]{2})", 1)
    bare = title.rlike(r"^ *(?:19|20)[0-9]{2} *(?:年|版)? *\z")
    search = F.lower("url").contains("search")
    role = (
        F.when(F.coalesce("own", F.lit(False)) & ~book, "drop")
        .when(bare & (~book_context | search), "pending")
        .when((year != "") & (book | (book_context & bare)), "entry")
        .when(book | F.col("is_catalog_frame"), "queue")
        .otherwise("drop")
    )
    return links.withColumn("edition", year.try_cast("int")).withColumn("role", role)


def first_of_each(rows: DataFrame, key: str, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each key in ``order``, which must be total.

    Taken first within ``SALT`` parts of each key, then among their firsts, so
    a hot key is never sorted whole in one task.
    """
    part = F.pmod(F.xxhash64(*rows.columns), F.lit(SALT))
    salted = rows.withColumn("_part", part)
    few = salted.withColumn("_n", F.row_number().over(Window.partitionBy(key, "_part").orderBy(*order))).where(F.col("_n") <= k)
    best = few.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("_n") <= k)
    return best.drop("_n", "_part")


def title_context(rows: DataFrame, title: str, names: Sequence[tuple[str, str]]) -> DataFrame:
    """``rows`` with the research_id, year and class that a title states, and ``status``.

    ``names``: (research_id, name or alias), a fixed list that becomes part of
    the expression. The id is given only if one entry is named. A title with
    the word for a bulletin is a communique, else one with that for a yearbook
    is a yearbook, else a government document.
    """
    listed = F.array(*[F.struct(F.lit(i).alias("id"), F.lit(n).alias("name")) for i, n in names]) if names else F.array().cast("array<struct<id:string,name:string>>")
    found = F.array_distinct(F.transform(F.filter(listed, lambda s: F.contains(F.col(title), s["name"])), lambda s: s["id"]))
    got = rows.withColumn("_ids", found).withColumn("year", F.regexp_extract(title, "(20[0-9]{2})年", 1).try_cast("int"))
    kind = F.when(F.col(title).contains("公报"), "communique").when(F.col(title).contains("年鉴"), "yearbook").otherwise("government_document")
    one = F.size("_ids") == 1
    status = F.when(~one, "CITY_AMBIGUOUS").when(F.col("year").isNull(), "YEAR_UNSUPPORTED").otherwise("inferred_requires_review")
    return got.withColumn("research_id", F.when(one, F.get("_ids", 0))).withColumn("source_class", kind).withColumn("status", status).drop("_ids")


def canonical_digest(*columns: str) -> Column:
    """SHA-256 of the columns as a JSON object with sorted keys and no spaces; nulls are left out."""
    return F.sha2(F.to_json(F.struct(*sorted(columns))), 256)


def same_keys(want: DataFrame, have: DataFrame, key: Sequence[str], group: str) -> DataFrame:
    """(group, both, only_mapped, only_read, equal): how the sets of keys of two tables compare; keys with nulls are left out."""
    whole = " and ".join(f"{k} is not null" for k in key)
    a = want.select(*key).where(whole).distinct().withColumn("_w", F.lit(True))
    b = have.select(*key).where(whole).distinct().withColumn("_h", F.lit(True))
    met = a.join(b, list(key), "full")
    w, h = F.col("_w").isNotNull(), F.col("_h").isNotNull()
    return met.groupBy(group).agg(F.count(F.when(w & h, 1)).alias("both"), F.count(F.when(w & ~h, 1)).alias("only_mapped"), F.count(F.when(h & ~w, 1)).alias("only_read"), F.min(w & h).alias("equal"))
