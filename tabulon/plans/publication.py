"""Queries about publications: authority, audit and approval, titles, links, discovery, sessions, and sources read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text
from ..functions.skew import join_unique
from ..operators import discovery, failures, layout, ledger, planning, selection, verification
from ..sources import pages, sinks, tables
from ..tables import shared_folder, table
from .evidence import _BEST, _GAPS, _WHITE, FIRST, KEPT, LAST, _gaps, _ranked, listed, number_sql, query, strip_sql

_HOST = "lower(regexp_extract({c}, '^https?://(?:[^/@]*@)?([^/:?#]+)', 1))"
_REGISTRY = f"""(SELECT {_HOST.format(c='final_url')} AS host, min(publisher) AS registered FROM captures
WHERE publisher <> '' AND {_HOST.format(c='final_url')} IN (SELECT source FROM documents) GROUP BY 1)"""
_AUTHORITY = f"""(SELECT capture_id, CASE WHEN NOT coalesce(capture_mode IN ('network', 'browser_network'), false) THEN 'offline' WHEN r.registered IS NULL THEN 'unregistered'
WHEN publisher IS DISTINCT FROM r.registered THEN 'other_publisher' ELSE 'matched' END AS authority FROM captures c LEFT JOIN {_REGISTRY} r ON r.host = {_HOST.format(c='c.final_url')})"""


def _registry(spark, sf):
    """The hosts of the documents with the least publisher captured from each."""
    known = table(spark, sf, "documents").where("source is not null").select(F.col("source").alias("host")).distinct()
    seen = table(spark, sf, "captures").where("publisher <> ''").groupBy(verification.host_of(F.col("final_url")).alias("host")).agg(F.min("publisher").alias("publisher"))
    return seen.join(known, "host", "left_semi").select("host", "publisher", F.concat(F.lit("https://"), "host").alias("evidence_url"), F.lit(True).alias("verified"))


@query(f"SELECT * FROM {_AUTHORITY}")
def capture_authority(spark, sf):
    return verification.authorities(table(spark, sf, "captures"), _registry(spark, sf))


_LAST = f"""(SELECT manifest, capture_id, sha256, document_title, authority FROM (SELECT *, row_number() OVER (PARTITION BY manifest ORDER BY retrieved_at DESC NULLS LAST, capture_id DESC) AS n
FROM captures WHERE manifest <> '' AND deleted_at IS NULL) JOIN {_AUTHORITY} USING (capture_id) WHERE n = 1)"""
_AUDITED = f"""(SELECT c.*, coalesce(l.authority = 'matched', false) AS capture_matched, coalesce(CASE WHEN NOT coalesce(year BETWEEN {FIRST} AND {LAST}, false) THEN 'YEAR_OUTSIDE_WINDOW'
WHEN NOT coalesce(indicator IN ({listed(KEPT)}), false) THEN 'INDICATOR_NOT_KEPT' WHEN value IS NULL OR isnan(value) THEN 'VALUE_NOT_FINITE' WHEN coalesce(is_derived, true) THEN 'DERIVED_VALUE'
WHEN c.research_id IS NOT NULL AND NOT coalesce(k.name = c.city, false) THEN 'IDENTITY_NOT_IN_CATALOG'
WHEN NOT coalesce(file <> '' AND NOT starts_with(file, '/') AND NOT regexp_matches(file, '(^|/)[.][.](/|$)') AND length(c.sha256) = 64, false) THEN 'EVIDENCE_MISSING'
WHEN ({number_sql('value_text')}) IS NOT NULL AND ({number_sql('value_text')}) <> value THEN 'CELL_VALUE_DIFFERS' WHEN coalesce(city, '') = '' THEN 'CITY_MISSING'
WHEN NOT coalesce(edition >= year, false) THEN 'EDITION_BEFORE_YEAR' WHEN NOT coalesce(source_class IN ('yearbook', 'communique', 'government_document'), false) THEN 'CLASS_UNKNOWN'
WHEN l.sha256 IS NOT NULL AND NOT coalesce(l.sha256 = c.sha256, false) THEN 'CAPTURE_INCONSISTENT' WHEN l.authority IN ('unregistered', 'other_publisher') THEN 'CAPTURE_WITHOUT_AUTHORITY' END,
CASE WHEN d.n > 1 THEN 'DUPLICATE_IDENTITY' END) AS failure
FROM candidates c LEFT JOIN city_catalog k USING (research_id) LEFT JOIN {_LAST} l ON l.manifest = c.capture_manifest
LEFT JOIN (SELECT id, count(*) AS n FROM candidates WHERE id IS NOT NULL GROUP BY 1) d ON d.id = c.id)"""


def _audited(spark, sf):
    cell = text.number(F.col("value_text"))
    return verification.audited(table(spark, sf, "candidates"), table(spark, sf, "captures"), table(spark, sf, "city_catalog"), _registry(spark, sf), cell, KEPT, FIRST, LAST)


@query(f"SELECT row_id, failure, capture_matched FROM {_AUDITED}")
def audited_chain(spark, sf):
    return _audited(spark, sf)


@query(f"""SELECT row_id, CASE WHEN d.n > 1 THEN 'ambiguous' WHEN ok AND d.decision = 'reject' THEN 'rejected'
WHEN ok AND failure IS NULL AND capture_matched AND (coalesce(kind, '') <> 'ocr_matrix' OR d.plan IS NULL) AND d.decision = 'approve' THEN 'approved' ELSE 'pending' END AS gate
FROM (SELECT c.*, d, coalesce(d.sha = c.sha256, false) AND coalesce(d.reviewer, '') <> '' AND coalesce(d.reason, '') <> '' AS ok FROM {_AUDITED} c LEFT JOIN (
  SELECT record_id, count(DISTINCT row(decision, source_sha256, reviewer, reason, plan_sha256)) AS n, any_value(source_sha256) AS sha, any_value(reviewer) AS reviewer, any_value(reason) AS reason, any_value(decision) AS decision, any_value(plan_sha256) AS plan
  FROM reviews WHERE record_id <> '' GROUP BY 1) d ON d.record_id = c.id)""")
def audited_gate(spark, sf):
    """The gate that needs audit, capture, plan and review; the candidates here carry no plan, so a review of a matrix must name none."""
    records = table(spark, sf, "candidates").withColumn("plan_sha256", F.lit(None).cast("string"))
    return verification.approvals(records, _audited(spark, sf), table(spark, sf, "reviews"))


def norm_title(c: str) -> str:
    return f"regexp_replace({c}, '{_WHITE}+', '', 'g')"


@query(f"""SELECT row_id, CASE source_class WHEN 'yearbook' THEN coalesce(contains(t, '年鉴') OR contains(t, 'Yearbook'), false)
WHEN 'communique' THEN coalesce(contains(t, '公报') OR contains(t, 'Communiqué') OR contains(t, 'Communique'), false) ELSE true END AS class_ok,
coalesce(contains({norm_title('t')}, edition::VARCHAR), false) AS edition_ok
FROM (SELECT c.row_id, c.source_class, c.edition, l.document_title AS t FROM candidates c LEFT JOIN {_LAST} l ON l.manifest = c.capture_manifest)""")
def title_support(spark, sf):
    """Whether the title of a record's last living capture has a word of its class and its edition."""
    last = verification.last_captures(table(spark, sf, "captures")).select(F.col("manifest").alias("capture_manifest"), "document_title")
    rows = join_unique(table(spark, sf, "candidates").select("row_id", "source_class", "edition", "capture_manifest"), last, "capture_manifest")
    title = F.col("document_title")
    return rows.select("row_id", verification.class_supported(F.col("source_class"), title).alias("class_ok"), verification.supported(title, F.col("edition")).alias("edition_ok"))


@query("SELECT capture_id, coalesce(file <> '' AND NOT starts_with(file, '/') AND NOT regexp_matches(file, '^[A-Za-z]:') AND NOT regexp_matches(file, '(^|/)[.][.](/|$)'), false) AS confined FROM captures")
def path_confinement(spark, sf):
    return table(spark, sf, "captures").select("capture_id", verification.confined(F.col("file")).alias("confined"))


@query("""SELECT batch_id, NOT (records = 0 OR status IN ('unparsed', 'empty_or_error', 'partial_pending')) AS ready, records
FROM (SELECT batch_id, count(value) AS records, CASE WHEN count(value) = 0 THEN 'empty_or_error' WHEN count(value) < count(*) / 2 THEN 'partial_pending' ELSE 'extracted' END AS status FROM candidates GROUP BY 1)""")
def upstream_ready(spark, sf):
    """Whether a batch may be verified: it has values, and not fewer than half of its rows lack one."""
    n, rows = F.count("value"), F.count("*")
    status = F.when(n == 0, "empty_or_error").when(n < rows / 2, "partial_pending").otherwise("extracted")
    return verification.upstream_gate(table(spark, sf, "candidates").groupBy("batch_id").agg(n.alias("records"), status.alias("status")), "batch_id")


_TITLE = "coalesce(document_title, '')"
_BOOK = f"(contains({_TITLE}, '年鉴') OR contains({_TITLE}, 'Yearbook'))"


@query(f"""SELECT capture_id, try_cast(nullif(regexp_extract({_TITLE}, '((?:19|20)[0-9]{{2}})', 1), '') AS INT) AS edition,
CASE WHEN split_part(url, '#', 1) = split_part(final_url, '#', 1) AND NOT {_BOOK} THEN 'drop' WHEN regexp_full_match({_TITLE}, ' *(19|20)[0-9]{{2}} *(年|版)? *') THEN 'pending'
WHEN regexp_matches({_TITLE}, '(19|20)[0-9]{{2}}') AND {_BOOK} THEN 'entry' WHEN {_BOOK} THEN 'queue' ELSE 'drop' END AS role FROM captures""")
def yearbook_links(spark, sf):
    """What a captured address with its title is to the discovery of yearbooks."""
    title = F.coalesce("document_title", F.lit(""))
    links = table(spark, sf, "captures").select("capture_id", "url", title.alias("text"), F.lit(False).alias("is_catalog_frame"), (F.substring_index("url", "#", 1) == F.substring_index("final_url", "#", 1)).alias("own"))
    found = discovery.yearbook_role(links, F.lit(False))
    return found.select("capture_id", "edition", "role")


@query(f"""SELECT host, count(*) FILTER (n <= 4) AS visited, count(*) FILTER (n > 4) AS leftover, max(CASE WHEN n <= 4 THEN capture_id END) AS last_visited
FROM (SELECT {_HOST.format(c='url')} AS host, capture_id, row_number() OVER (PARTITION BY {_HOST.format(c='url')} ORDER BY retrieved_at NULLS FIRST, capture_id) AS n FROM captures WHERE url IS NOT NULL) GROUP BY 1""")
def bounded_discovery(spark, sf):
    """The first four addresses of each host are visited, the others are counted as left over."""
    rows = table(spark, sf, "captures").where("url is not null").select(verification.host_of(F.col("url")).alias("host"), "capture_id", "retrieved_at")
    first = discovery.first_of_each(rows, "host", (F.col("retrieved_at").asc_nulls_first(), F.col("capture_id")), 4)
    visited = first.groupBy("host").agg(F.count("*").alias("visited"), F.max("capture_id").alias("last_visited"))
    return rows.groupBy("host").agg(F.count("*").alias("n")).join(visited, "host").select("host", "visited", (F.col("n") - F.col("visited")).alias("leftover"), "last_visited")


@query("""SELECT capture_id, CASE WHEN len(ids) = 1 THEN ids[1] END AS research_id, year, source_class,
CASE WHEN len(ids) <> 1 THEN 'CITY_AMBIGUOUS' WHEN year IS NULL THEN 'YEAR_UNSUPPORTED' ELSE 'inferred_requires_review' END AS status
FROM (SELECT c.capture_id, try_cast(nullif(regexp_extract(t, '(20[0-9]{2})年', 1), '') AS INT) AS year, CASE WHEN contains(t, '公报') THEN 'communique' WHEN contains(t, '年鉴') THEN 'yearbook' ELSE 'government_document' END AS source_class,
  coalesce((SELECT list(DISTINCT k.research_id) FROM (SELECT research_id, unnest(list_concat([name], coalesce(aliases, []))) AS a FROM city_catalog) k WHERE k.a <> '' AND contains(c.t, k.a)), []) AS ids
  FROM (SELECT capture_id, coalesce(document_title, '') AS t FROM captures) c)""")
def document_context(spark, sf):
    """City, year and class that a title states; the city only if exactly one of the catalogue is named."""
    catalog = table(spark, sf, "city_catalog").select("research_id", F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>"))).alias("names")).collect()  # a fixed list
    names = [(r.research_id, n) for r in catalog for n in r.names if n]
    rows = table(spark, sf, "captures").select("capture_id", F.coalesce("document_title", F.lit("")).alias("title"))
    return discovery.title_context(rows, "title", names).select("capture_id", "research_id", "year", "source_class", "status")


@query("""SELECT capture_id, CASE WHEN regexp_matches(url, '(19|20)[0-9]{2}') THEN try_cast(regexp_extract(url, '((?:19|20)[0-9]{2})', 1) AS INT) END AS edition FROM captures""")
def edition_of_url(spark, sf):
    return table(spark, sf, "captures").select("capture_id", F.regexp_extract("url", "((?:19|20)[0-9]{2})", 1).try_cast("int").alias("edition"))


@query("""SELECT province, sha256('{"decision":"province_complete","province":"' || province || '","selected_sha256":"' || sha256(string_agg(research_id, ',' ORDER BY research_id)) || '"}') AS export_key FROM city_catalog GROUP BY 1""")
def export_keys(spark, sf):
    """Identity of each province's export, over what is selected for it."""
    ids = F.array_join(F.array_sort(F.collect_list("research_id")), ",")  # the cities of one province
    rows = table(spark, sf, "city_catalog").groupBy("province").agg(F.sha2(ids, 256).alias("selected_sha256")).withColumn("decision", F.lit("province_complete"))
    return rows.select("province", discovery.canonical_digest("decision", "province", "selected_sha256").alias("export_key"))


@query("SELECT coalesce(research_id, city) AS place, year, indicator, coalesce(geographic_scope, 'full_city') AS scope, count(*) AS rows FROM candidates GROUP BY 1, 2, 3, 4")
def key_tuples(spark, sf):
    key = (F.coalesce("research_id", "city").alias("place"), "year", "indicator", F.coalesce("geographic_scope", F.lit("full_city")).alias("scope"))
    return table(spark, sf, "candidates").groupBy(*key).agg(F.count("*").alias("rows"))


@query("""SELECT file, count(*) FILTER (w AND h) AS both, count(*) FILTER (w AND NOT h) AS only_mapped, count(*) FILTER (h AND NOT w) AS only_read, bool_and(w AND h) AS equal FROM (
SELECT coalesce(m.file, c.file) AS file, m.file IS NOT NULL AS w, c.file IS NOT NULL AS h FROM
(SELECT DISTINCT file, table_index, u.indicator AS indicator, u.year AS year FROM (SELECT file, table_index, unnest(columns) AS u FROM table_mapping) WHERE file IS NOT NULL AND table_index IS NOT NULL AND u.indicator IS NOT NULL AND u.year IS NOT NULL) m
FULL JOIN (SELECT DISTINCT file, table_index, indicator, year FROM candidates WHERE file <> '' AND table_index IS NOT NULL AND indicator IS NOT NULL AND year IS NOT NULL) c USING (file, table_index, indicator, year)) GROUP BY 1""")
def key_set_equality(spark, sf):
    """Whether the keys that a file's mapping promises are those that were read from it."""
    key = ["file", "table_index", "indicator", "year"]
    want = table(spark, sf, "table_mapping").select("file", "table_index", F.explode("columns").alias("c")).select("file", "table_index", "c.indicator", "c.year")
    return discovery.same_keys(want, table(spark, sf, "candidates").where("file <> ''"), key, "file")


@query("""SELECT c.capture_id FROM captures c WHERE EXISTS (SELECT 1 FROM captures p WHERE p.final_url = c.url AND p.capture_id <> c.capture_id)""")
def parent_captures(spark, sf):
    """Captures of an address that another capture ended at."""
    c = table(spark, sf, "captures").select("capture_id", "url", "final_url")
    ends = c.where("final_url is not null").groupBy(F.col("final_url").alias("url")).agg(F.min("capture_id").alias("lo"), F.max("capture_id").alias("hi"))
    return c.join(ends, "url").where("lo <> capture_id or hi <> capture_id").select("capture_id")


@query("SELECT word_id, row_number() OVER (PARTITION BY source_sha256, page ORDER BY y, x, word_id) AS place FROM layout WHERE x IS NOT NULL AND y IS NOT NULL AND h IS NOT NULL")
def reading_order(spark, sf):
    """Words of each page down its rows and across; a page is what one task sorts."""
    words = table(spark, sf, "layout").where("x is not null and y is not null and h is not null")
    rows = words.select("word_id", "source_sha256", "page", "x").join(layout.row_bands(words).select("word_id", "band"), "word_id")
    return rows.select("word_id", F.row_number().over(Window.partitionBy("source_sha256", "page").orderBy("band", "x", "word_id")).alias("place"))


@query("SELECT file, count(DISTINCT city) AS labels, count(*) AS rows, count(DISTINCT table_index) AS tables FROM candidates WHERE kind = 'ocr_matrix' GROUP BY 1")
def matrix_labels(spark, sf):
    """Distinct labels and rows of each file read as a matrix."""
    return table(spark, sf, "candidates").where("kind = 'ocr_matrix'").groupBy("file").agg(F.count_distinct("city").alias("labels"), F.count("*").alias("rows"), F.count_distinct("table_index").alias("tables"))


@query("SELECT word_id FROM layout WHERE (y + h / 2) / page_height BETWEEN 0.2 AND 0.9")
def body_words(spark, sf):
    return table(spark, sf, "layout").where("(y + h / 2) / page_height between 0.2 and 0.9").select("word_id")


@query(f"""SELECT indicator, year, count(*) AS expected, count(*) FILTER (g.research_id IS NULL) AS present, round(count(*) FILTER (g.research_id IS NULL) / count(*), 6) AS share
FROM (SELECT research_id, year, indicator FROM city_catalog, (SELECT unnest(range({FIRST}, {LAST + 1}))::INT AS year), (SELECT unnest([{listed(KEPT)}]) AS indicator)) e
LEFT JOIN {_GAPS} g USING (research_id, year, indicator) GROUP BY 1, 2""")
def coverage_report(spark, sf):
    want = planning.expected_keys(table(spark, sf, "city_catalog"), FIRST, LAST, KEPT)
    met = want.join(_gaps(spark, sf).withColumn("gap", F.lit(1)), ["research_id", "year", "indicator"], "left")
    present = F.count(F.when(F.col("gap").isNull(), 1))
    return met.groupBy("indicator", "year").agg(F.count("*").alias("expected"), present.alias("present"), F.round(present / F.count("*"), 6).alias("share"))


@query("""SELECT user_id, max(session) AS sessions, max(n) AS longest FROM (SELECT user_id, session, count(*) AS n FROM (
SELECT user_id, sum(CASE WHEN gap IS NULL OR gap > 1800000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS session
FROM (SELECT user_id, ts, event_id, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events)) GROUP BY 1, 2) GROUP BY 1""")
def idle_sessions(spark, sf):
    """Sessions of each user, ended by half an hour without an event."""
    return ledger.sessions(table(spark, sf, "events").select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), "event_id"), "user_id", ("at", "event_id"), 1_800_000_000)


_CODES = (("click", "HTTP_408"), ("view", "HTTP_404"), ("purchase", "HOST_DEFERRED"), ("signup", "TLS_CERTIFICATE_ERROR"), ("logout", "NO_STRUCTURED_TABLES"), ("search", "HTTP_501"))
_CODE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{c}'" for k, c in _CODES) + " ELSE 'HTTP_503' END"


@query(f"""SELECT event_id, code, CASE WHEN code LIKE 'HTTP_%' OR code IN ('HOST_DEFERRED', 'TLS_CERTIFICATE_ERROR') THEN 'network' ELSE 'parse' END AS category, code IN ('HTTP_408', 'HTTP_503') AS retryable
FROM (SELECT event_id, {_CODE} AS code FROM events)""")
def failure_retries(spark, sf):
    """Events as attempts that failed with a code each, and whether one may be made again."""
    code = F.lit("HTTP_503")
    for kind, c in reversed(_CODES):
        code = F.when(F.col("event_type") == kind, c).otherwise(code)
    rows = table(spark, sf, "events").select("event_id", code.alias("code"))
    return rows.withColumn("k", failures.classified(F.col("code"))).select("event_id", "code", "k.category", "k.retryable")


def _escaped(c: str):
    return F.replace(F.replace(F.replace(F.col(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def clean_sql(c: str) -> str:
    return f"regexp_replace({strip_sql(c)}, '{_WHITE}+', ' ', 'g')"


@query(f"""SELECT row_id, r AS row, c AS col, CASE WHEN c = 0 THEN {clean_sql('city')} WHEN r = 0 THEN {clean_sql('indicator')} ELSE {clean_sql('value_text')} END AS text, CASE WHEN c = 0 THEN 0 ELSE r END AS origin_row
FROM candidates, (SELECT unnest([0, 0, 1, 1]) AS r, unnest([0, 1, 0, 1]) AS c) WHERE city IS NOT NULL AND indicator IS NOT NULL AND value_text IS NOT NULL""")
def html_cells(spark, sf):
    """Every cell written as a page in GB 18030 with a spanning city, and read back from its bytes."""
    rows = table(spark, sf, "candidates").where("city is not null and indicator is not null and value_text is not null")
    page = F.concat(F.lit("<table><tr><td rowspan=2>"), _escaped("city"), F.lit("</td><th>"), _escaped("indicator"), F.lit("</th></tr><tr><td>"), _escaped("value_text"), F.lit("</td></tr></table>"))
    got = tables.read_tables(rows.select("row_id", F.encode(page, "UTF-8").alias("content"), F.lit("html").alias("format")), "row_id")
    return got.select("row_id", "row", "col", "text", "origin_row")


@query(f"""SELECT capture_id, {clean_sql('document_title')} AS text, regexp_matches(document_title, '统计|年鉴|公报') AS is_statistics_hint, regexp_matches(lower(split_part(split_part(url, '#', 1), '?', 1)), '[.](pdf|xlsx?|zip|docx?)$') AS is_attachment
FROM captures WHERE url IS NOT NULL AND document_title IS NOT NULL""")
def catalog_links(spark, sf):
    """Every captured title as a link of a page, read back with what it hints at."""
    rows = table(spark, sf, "captures").where("url is not null and document_title is not null")
    page = F.concat(F.lit('<a href="'), _escaped("url"), F.lit('">'), _escaped("document_title"), F.lit("</a>"))
    got = pages.page_links(rows.select(F.col("capture_id").cast("string").alias("src"), page.alias("html")), "src", "html")
    return got.select(F.col("src").cast("long").alias("capture_id"), "text", "is_statistics_hint", "is_attachment")


@query(f"SELECT research_id, year, indicator, geographic_scope, value FROM {_BEST} WHERE value IS NOT NULL")
def long_panel_file(spark, sf):
    """The best versions written as a long CSV file and read back."""
    rows = selection.best_versions(_ranked(spark, sf)).where("value is not null")
    path = f"{shared_folder(spark)}/tabulon-long-{uuid.uuid4().hex}"
    columns = ("research_id", "year", "indicator", "geographic_scope", "value")
    sinks.write_long(rows, path, columns)
    return spark.read.csv(path, header=True, schema="research_id string, year int, indicator string, geographic_scope string, value double")
