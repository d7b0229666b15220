"""Queries of the evidence pipeline over the project's tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text
from ..operators import audit, failures, layout, ledger, matrix, planning, prose, selection
from ..tables import table

# The indicators kept, the labels of totals, the marks of missing values.
KEPT = ("地区生产总值", "全社会用电量", "年末常住人口", "全社会能源消费总量", "常住人口城镇化率")
INDICATORS = (*KEPT, "地区生产总值增长率", "第一产业增加值", "第二产业增加值", "第三产业增加值", "工业增加值", "城镇常住人口", "人口自然增长率", "城乡居民生活用电量", "建成区面积", "一般公共预算支出", "固定资产投资增长率", "金融机构人民币贷款余额")
TOTALS = ("全省", "全国", "合计", "总计", "省合计", "Total")
MISSING = ("", "—", "–", "..", "...", "N/A", "NA", "未公布", "不详")
FIRST, LAST = 2014, 2022
RULES = ({"source_class": "yearbook", "geographic_scope": "全市"}, {"source_class": "communique"}, {"source_class": "government_document"})
# Units in the order in which they are looked for.
UNITS = ("万吨标准煤", "亿千瓦时", "万千瓦时", "万亿元", "亿元", "万元", "万人", "千瓦时", "吨标准煤", "人", "%")
PHASES = ("click", "view", "purchase", "signup", "logout", "other")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL if there is any."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def listed(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


_WHITE = r"[\t-\r \x{85}\p{Z}]"


def norm_sql(c: str) -> str:
    return f"regexp_replace({c}, '{_WHITE}+', '', 'g')"


def strip_sql(c: str) -> str:
    return f"regexp_replace({c}, '^{_WHITE}+|{_WHITE}+$', '', 'g')"


def number_sql(c: str) -> str:
    t = f"translate({strip_sql(c)}, '−０１２３４５６７８９', '-0123456789')"
    body = strip_sql(f"CASE WHEN regexp_matches({t}, '^(下降|减少)') THEN substr({t}, 3) ELSE {t} END")
    body = strip_sql(f"regexp_replace({body}, '[%‰]$', '')")
    return f"""CASE WHEN regexp_full_match({body}, '[+-]?([0-9]{{1,3}}(,[0-9]{{3}})+|[0-9]+)(\\.[0-9]+)?')
      AND NOT (regexp_matches({t}, '^(下降|减少)') AND {body} LIKE '-%')
      THEN try_cast(replace({body}, ',', '') AS DOUBLE) * CASE WHEN regexp_matches({t}, '^(下降|减少)') THEN -1 ELSE 1 END END"""


@query(f"SELECT row_id FROM candidates WHERE indicator IN ({listed(KEPT)}) AND year BETWEEN {FIRST} AND {LAST}")
def window_filter(spark, sf):
    return selection.in_window(table(spark, sf, "candidates"), KEPT, FIRST, LAST).select("row_id")


@query(f"""SELECT row_id, {norm_sql("coalesce(city, '')")} <> '' AND NOT ({' OR '.join(f"starts_with({norm_sql('city')}, '{x}')" for x in TOTALS)}) AS kept
FROM candidates WHERE city IS NOT NULL""")
def skip_aggregate_rows(spark, sf):
    name = text.norm(F.col("city"))
    total = F.lit(False)
    for x in TOTALS:
        total = total | name.startswith(x)
    return table(spark, sf, "candidates").where("city is not null").select("row_id", ((name != "") & ~total).alias("kept"))


@query(f"""SELECT row_id, CASE WHEN value_text IS NULL THEN 'absent' WHEN {norm_sql('value_text')} IN ({listed(MISSING)}) THEN 'skipped'
WHEN {number_sql('value_text')} IS NULL THEN 'error' ELSE 'number' END AS status FROM candidates""")
def missing_marker_classify(spark, sf):
    t = F.col("value_text")
    status = F.when(t.isNull(), "absent").when(text.norm(t).isin(*MISSING), "skipped").when(text.number(t).isNull(), "error").otherwise("number")
    return table(spark, sf, "candidates").select("row_id", status.alias("status"))


@query(f"SELECT row_id, {number_sql('value_text')} AS number FROM candidates")
def number_parse(spark, sf):
    return table(spark, sf, "candidates").select("row_id", text.number(F.col("value_text")).alias("number"))


@query(f"SELECT word_id, {norm_sql('text')} AS norm FROM layout")
def norm_text(spark, sf):
    return table(spark, sf, "layout").select("word_id", text.norm(F.col("text")).alias("norm"))


@query("SELECT row_id, CASE " + " ".join(f"WHEN contains(value_text, '{u}') THEN '{u}'" for u in UNITS) + " END AS unit FROM candidates")
def unit_detect(spark, sf):
    first = F.coalesce(*[F.when(F.col("value_text").contains(u), F.lit(u)) for u in UNITS])
    return table(spark, sf, "candidates").select("row_id", first.alias("unit"))


# What a part of an indicator's name asks of its unit, unless it is a rate.
COMPATIBLE = (("能源消费", ("万吨标准煤", "吨标准煤")), ("用电量", ("亿千瓦时", "万千瓦时", "千瓦时")), ("人口", ("万人", "人")))


@query("SELECT row_id, coalesce(CASE WHEN contains(indicator, '增长率') OR contains(indicator, '城镇化率') THEN unit = '%' WHEN contains(indicator, '率') THEN true " + " ".join(f"WHEN contains(indicator, '{k}') THEN unit IN ({listed(u)})" for k, u in COMPATIBLE) + """ ELSE true END, true) AS compatible
FROM candidates WHERE unit IS NOT NULL""")
def unit_compatibility(spark, sf):
    i, u = F.col("indicator"), F.col("unit")
    ok = F.when(i.contains("增长率") | i.contains("城镇化率"), u == "%").when(i.contains("率"), True)
    for part, units in COMPATIBLE:
        ok = ok.when(i.contains(part), u.isin(*units))
    return table(spark, sf, "candidates").where("unit is not null").select("row_id", F.coalesce(ok.otherwise(True), F.lit(True)).alias("compatible"))


_LABEL = r"^#?([一-鿿]{2,}(?:自治州|地区|市|县|区|盟|旗))[①-⑤*]*$"
_LABEL_SQL = r"^#?([\x{4e00}-\x{9fff}]{2,}(?:自治州|地区|市|县|区|盟|旗))[①-⑤*]*$"


@query(f"SELECT word_id, regexp_extract(text, '{_LABEL_SQL}', 1) AS label FROM layout WHERE regexp_matches(text, '{_LABEL_SQL}')")
def city_label_extract(spark, sf):
    return table(spark, sf, "layout").where(F.col("text").rlike(_LABEL)).select("word_id", F.regexp_extract("text", _LABEL, 1).alias("label"))


def _aliases(spark, sf):
    names = F.explode(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("alias")
    return table(spark, sf, "city_catalog").select("research_id", names).select("research_id", text.norm(F.col("alias")).alias("alias")).distinct()


_ALIASES = f"(SELECT DISTINCT research_id, {norm_sql('a')} AS alias FROM (SELECT research_id, unnest(list_concat([name], coalesce(aliases, []))) AS a FROM city_catalog))"


@query(f"""SELECT c.row_id, a.research_id AS matched, CASE WHEN a.research_id IS NULL THEN 'unmapped' ELSE 'matched' END AS status
FROM candidates c LEFT JOIN {_ALIASES} a ON {norm_sql('c.city')} = a.alias""")
def alias_left_join(spark, sf):
    rows = table(spark, sf, "candidates").select("row_id", text.norm(F.col("city")).alias("alias"))
    met = rows.join(_aliases(spark, sf).withColumnRenamed("research_id", "matched"), "alias", "left")
    return met.select("row_id", "matched", F.when(F.col("matched").isNull(), "unmapped").otherwise("matched").alias("status"))


@query(f"SELECT alias, count(DISTINCT research_id) AS entries FROM {_ALIASES} GROUP BY 1 HAVING count(DISTINCT research_id) > 1")
def alias_ambiguity(spark, sf):
    return _aliases(spark, sf).groupBy("alias").agg(F.count_distinct("research_id").alias("entries")).where("entries > 1")


@query("SELECT row_id, research_id IS NOT NULL AND research_id IN (SELECT research_id FROM city_catalog) AS member FROM candidates")
def sample_membership(spark, sf):
    known = table(spark, sf, "city_catalog").select("research_id", F.lit(True).alias("known"))
    return table(spark, sf, "candidates").join(known, "research_id", "left").select("row_id", F.coalesce("known", F.lit(False)).alias("member"))


_SCOPES = {"建成区面积": None, "全社会用电量": ("全市", "市辖区")}


@query("SELECT row_id, CASE indicator WHEN '建成区面积' THEN true WHEN '全社会用电量' THEN coalesce(geographic_scope IN ('全市', '市辖区'), false) ELSE coalesce(geographic_scope = '全市', false) END AS allowed FROM candidates")
def scope_eligibility(spark, sf):
    return table(spark, sf, "candidates").select("row_id", selection.scope_allowed(_SCOPES, ("全市",)).alias("allowed"))


_RANK = "CASE WHEN source_class = 'yearbook' AND geographic_scope = '全市' THEN 3 WHEN source_class = 'communique' THEN 2 WHEN source_class = 'government_document' THEN 1 ELSE 0 END"


@query(f"SELECT row_id, {_RANK} AS rank FROM candidates")
def priority_rank(spark, sf):
    return table(spark, sf, "candidates").select("row_id", selection.priority_rank(RULES).alias("rank"))


_GATE = """(SELECT c.*, CASE WHEN d.n > 1 THEN 'ambiguous'
  WHEN coalesce(d.sha = c.sha256, false) AND coalesce(d.reviewer, '') <> '' AND coalesce(d.reason, '') <> '' AND d.decision = 'reject' THEN 'rejected'
  WHEN coalesce(d.sha = c.sha256, false) AND coalesce(d.reviewer, '') <> '' AND coalesce(d.reason, '') <> '' AND d.decision = 'approve' THEN 'approved'
  ELSE 'pending' END AS gate
FROM candidates c LEFT JOIN (
  SELECT record_id, count(DISTINCT row(decision, source_sha256, reviewer, reason)) AS n, any_value(source_sha256) AS sha, any_value(reviewer) AS reviewer, any_value(reason) AS reason, any_value(decision) AS decision
  FROM reviews WHERE record_id IS NOT NULL AND record_id <> '' GROUP BY 1) d ON d.record_id = c.id)"""


@query(f"SELECT row_id, gate FROM {_GATE}")
def review_gate(spark, sf):
    return selection.review_gate(table(spark, sf, "candidates").select("row_id", "id", "sha256"), table(spark, sf, "reviews")).select("row_id", "gate")


def _ranked(spark, sf):
    cols = ("row_id", "research_id", "year", "indicator", "geographic_scope", "unit", "value", "edition", "source_class")
    return table(spark, sf, "candidates").where("research_id is not null and withdrawn_at is null").select(*cols).withColumn("rank", selection.priority_rank(RULES)).where("rank > 0")


_KEYS = "research_id, year, indicator, geographic_scope"
_BEST = f"""(SELECT * FROM (SELECT *, rank() OVER (PARTITION BY {_KEYS} ORDER BY rank DESC, coalesce(edition, -1) DESC) AS r
  FROM (SELECT *, {_RANK} AS rank FROM candidates WHERE research_id IS NOT NULL AND withdrawn_at IS NULL) WHERE rank > 0) WHERE r = 1)"""


@query(f"SELECT row_id, rank, edition FROM {_BEST}")
def best_version(spark, sf):
    return selection.best_versions(_ranked(spark, sf)).select("row_id", "rank", "edition")


@query(f"""SELECT {_KEYS}, count(*) AS best_rows, count(DISTINCT row(value, unit)) > 1 AS conflict, min(row_id) AS first_row FROM {_BEST} GROUP BY {_KEYS}""")
def version_conflicts(spark, sf):
    return selection.versions(_ranked(spark, sf))


@query(f"""WITH g AS (SELECT row_id, {_KEYS}, value, unit, edition, gate, {_RANK} AS rank,
  research_id IS NOT NULL AND research_id IN (SELECT research_id FROM city_catalog) AS member, coalesce(geographic_scope = '全市', false) AS scope_ok FROM {_GATE}),
e AS (SELECT *, CASE WHEN NOT member OR NOT scope_ok OR gate = 'rejected' THEN 'excluded' WHEN gate <> 'approved' OR rank = 0 THEN 'pending' END AS early FROM g),
b AS (SELECT *, rank() OVER (PARTITION BY {_KEYS} ORDER BY rank DESC, coalesce(edition, -1) DESC) AS r FROM e WHERE early IS NULL),
v AS (SELECT {_KEYS}, count(DISTINCT row(value, unit)) > 1 AS conflict, min(row_id) AS first_row FROM b WHERE r = 1 GROUP BY {_KEYS})
SELECT row_id, early AS outcome FROM e WHERE early IS NOT NULL
UNION ALL SELECT b.row_id, CASE WHEN r > 1 THEN 'superseded' WHEN conflict THEN 'conflict' WHEN b.row_id = first_row THEN 'selected' ELSE 'superseded' END
FROM b JOIN v USING ({_KEYS})""")
def outcome_partition(spark, sf):
    """Every candidate's outcome: selected, superseded, conflict, pending or excluded."""
    cols = ("row_id", "id", "sha256", "research_id", "year", "indicator", "geographic_scope", "unit", "value", "edition", "source_class")
    rows = selection.review_gate(table(spark, sf, "candidates").select(*cols), table(spark, sf, "reviews"))
    known = table(spark, sf, "city_catalog").select("research_id", F.lit(True).alias("known"))
    rows = rows.join(known, "research_id", "left").withColumn("member", F.coalesce("known", F.lit(False)))
    rows = rows.withColumn("scope_ok", selection.scope_allowed({}, ("全市",))).withColumn("rank", selection.priority_rank(RULES))
    return selection.outcomes(rows)


@query("SELECT id, count(*) AS rows FROM candidates WHERE id IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def duplicate_ids(spark, sf):
    return audit.repeated(table(spark, sf, "candidates"), "id")


_TESTS = f"""CASE WHEN NOT coalesce(year BETWEEN {FIRST} AND {LAST}, false) THEN 'YEAR_OUTSIDE_WINDOW' WHEN NOT coalesce(indicator IN ({listed(KEPT)}), false) THEN 'INDICATOR_NOT_KEPT'
WHEN value IS NULL THEN 'VALUE_NOT_FINITE' WHEN coalesce(is_derived, true) THEN 'DERIVED_VALUE' WHEN NOT coalesce(length(id) = 24, false) THEN 'IDENTITY_MALFORMED'
WHEN NOT coalesce(file <> '' AND length(sha256) = 64, false) THEN 'EVIDENCE_MISSING'
WHEN NOT coalesce(({number_sql('value_text')}) IS NULL OR ({number_sql('value_text')}) = value, false) THEN 'CELL_VALUE_DIFFERS'
WHEN NOT coalesce(city <> '', false) THEN 'CITY_MISSING' WHEN NOT coalesce(edition >= year, false) THEN 'EDITION_BEFORE_YEAR'
WHEN NOT coalesce(source_class IN ('yearbook', 'communique', 'government_document'), false) THEN 'CLASS_UNKNOWN'
WHEN NOT coalesce(length(source_row_id) = 24, false) THEN 'ROW_IDENTITY_MALFORMED' WHEN NOT coalesce(capture_manifest <> '', false) THEN 'CAPTURE_MISSING' END"""


def _failures(spark, sf):
    return table(spark, sf, "candidates").select("row_id", audit.first_failure(audit.record_tests(KEPT, FIRST, LAST)).alias("failure"))


@query(f"SELECT row_id, {_TESTS} AS failure FROM candidates")
def audit_first_failure(spark, sf):
    return _failures(spark, sf)


@query(f"SELECT coalesce(failure, 'PASSED') AS outcome, count(*) AS rows FROM (SELECT {_TESTS} AS failure FROM candidates) GROUP BY 1")
def audit_summary(spark, sf):
    return _failures(spark, sf).groupBy(F.coalesce("failure", F.lit("PASSED")).alias("outcome")).agg(F.count("*").alias("rows"))


@query("SELECT batch_id, count(*) AS rows, count(DISTINCT source_row_id) AS source_rows, count(DISTINCT research_id) AS cities FROM candidates GROUP BY 1")
def extraction_counters(spark, sf):
    return table(spark, sf, "candidates").groupBy("batch_id").agg(F.count("*").alias("rows"), F.count_distinct("source_row_id").alias("source_rows"), F.count_distinct("research_id").alias("cities"))


@query("""SELECT row_id, substr(sha256('["' || source_row_id || '", ' || year || ', "' || indicator || '", "' || geographic_scope || '"]'), 1, 24) AS identity FROM candidates""")
def record_identity_sha(spark, sf):
    c = F.col
    return table(spark, sf, "candidates").select("row_id", text.identity(c("source_row_id"), c("year"), c("indicator"), c("geographic_scope")).alias("identity"))


_LIVING = "(SELECT DISTINCT file, sha256 FROM captures WHERE deleted_at IS NULL AND file IS NOT NULL AND sha256 IS NOT NULL)"


@query(f"""SELECT c.row_id, CASE WHEN f.file IS NULL THEN 'uncaptured' WHEN h.file IS NOT NULL THEN 'matched' ELSE 'mismatch' END AS status
FROM candidates c LEFT JOIN {_LIVING} h ON h.file = c.file AND h.sha256 = c.sha256 LEFT JOIN (SELECT DISTINCT file FROM {_LIVING}) f ON f.file = c.file""")
def evidence_hash_join(spark, sf):
    return audit.hash_status(table(spark, sf, "candidates"), table(spark, sf, "captures"))


@query(f"SELECT row_id, 'value' AS field FROM candidates WHERE ({number_sql('value_text')}) IS NOT NULL AND (value IS NULL OR value <> ({number_sql('value_text')}))")
def replay_mismatch(spark, sf):
    return audit.replay_mismatch(table(spark, sf, "candidates"))


def _winners(spark, sf):
    rows = selection.best_versions(_ranked(spark, sf))
    return rows.where((F.col("geographic_scope") == "全市") & F.col("indicator").isin(*KEPT) & F.col("value").isNotNull())


_WIN = f"(SELECT * FROM {_BEST} WHERE geographic_scope = '全市' AND indicator IN ({listed(KEPT)}) AND value IS NOT NULL)"


@query(f"""SELECT research_id, year, {', '.join(f'''CASE WHEN min(value) FILTER (indicator = '{k}') = max(value) FILTER (indicator = '{k}') THEN min(value) FILTER (indicator = '{k}') END AS "{k}"''' for k in KEPT)}
FROM {_WIN} GROUP BY 1, 2""")
def panel_pivot(spark, sf):
    return selection.panel(_winners(spark, sf), ("research_id", "year"), "indicator", "value", KEPT)


@query(f"SELECT research_id, year, indicator, min(value) AS least, max(value) AS most FROM {_WIN} GROUP BY 1, 2, 3 HAVING min(value) <> max(value)")
def pivot_conflicts(spark, sf):
    return selection.panel_conflicts(_winners(spark, sf), ("research_id", "year"), "indicator", "value")


def _gaps(spark, sf):
    want = planning.expected_keys(table(spark, sf, "city_catalog"), FIRST, LAST, KEPT)
    have = table(spark, sf, "candidates").where("value is not null and geographic_scope = '全市' and withdrawn_at is null")
    return planning.gaps(want, have)


_GAPS = f"""(SELECT research_id, year, indicator FROM city_catalog, (SELECT unnest(range({FIRST}, {LAST + 1}))::INT AS year), (SELECT unnest([{listed(KEPT)}]) AS indicator)
EXCEPT SELECT research_id, year, indicator FROM candidates WHERE value IS NOT NULL AND geographic_scope = '全市' AND withdrawn_at IS NULL)"""


@query(f"SELECT * FROM {_GAPS}")
def gap_anti_join(spark, sf):
    return _gaps(spark, sf)


def _checks(spark, sf):
    """A candidate whose cell is a missing mark documents its gap."""
    c = table(spark, sf, "candidates").where(F.col("value").isNull() & F.col("value_text").isin("—", "–", "..", "...", "N/A", "NA", "未公布", "不详"))
    return c.select("research_id", "year", "indicator", F.lit("missing").alias("status"), F.col("value_text").alias("reason"), F.array("file").alias("source_refs"))


@query(f"""SELECT * FROM {_GAPS} INTERSECT SELECT research_id, year, indicator FROM candidates
WHERE value IS NULL AND value_text IN ('—', '–', '..', '...', 'N/A', 'NA', '未公布', '不详')""")
def documented_gap_semi(spark, sf):
    return planning.documented(_gaps(spark, sf), _checks(spark, sf))


def _yields(spark, sf):
    return planning.table_yields(table(spark, sf, "table_mapping"), table(spark, sf, "candidates"))


_YIELDS = """(SELECT w.file, w.table_index, count(*) AS expected, count(*) FILTER (h.file IS NULL) AS missing, round(count(*) FILTER (h.file IS NULL) / count(*), 6) AS density
FROM (SELECT DISTINCT file, table_index, c.indicator AS indicator, c.year AS year FROM (SELECT file, table_index, unnest(columns) AS c FROM table_mapping) WHERE file IS NOT NULL) w
LEFT JOIN (SELECT DISTINCT file, table_index, indicator, year FROM candidates WHERE file <> '') h USING (file, table_index, indicator, year) GROUP BY 1, 2)"""


@query(f"SELECT * FROM {_YIELDS}")
def table_yield(spark, sf):
    return _yields(spark, sf)


_LEVEL = "CASE source_class WHEN 'yearbook' THEN 'province' WHEN 'communique' THEN 'city' WHEN 'government_document' THEN 'county' END"
_ACTIONS = f"""(SELECT y.*, m.edition, m.level, CASE WHEN level = 'county' THEN 'exclude_outside_province_city_collection_levels'
  WHEN level = 'city' AND missing = 0 THEN 'defer_lower_yearbook_until_documented_upper_gaps'
  WHEN level IS NULL AND NOT (missing = 0 AND edition IS NOT NULL) THEN 'inspect_publication_level_metadata_only'
  WHEN missing = 0 AND edition IS NOT NULL THEN 'reuse_reviewed_table' ELSE 'acquire_or_reuse_table' END AS action
FROM {_YIELDS} y JOIN (SELECT file, table_index, max(edition) AS edition, max({_LEVEL}) AS level FROM table_mapping WHERE file IS NOT NULL GROUP BY 1, 2) m USING (file, table_index))"""


def _actions(spark, sf):
    level = F.when(F.col("source_class") == "yearbook", "province").when(F.col("source_class") == "communique", "city").when(F.col("source_class") == "government_document", "county")
    meta = table(spark, sf, "table_mapping").where("file is not null").groupBy("file", "table_index").agg(F.max("edition").alias("edition"), F.max(level).alias("level"))
    rows = _yields(spark, sf).join(meta, ["file", "table_index"]).withColumn("unlocked", F.col("missing")).withColumn("reviewed", F.col("edition").isNotNull())
    return planning.table_action(rows).drop("unlocked", "reviewed")


@query(f"SELECT file, table_index, action FROM {_ACTIONS}")
def table_actions(spark, sf):
    return _actions(spark, sf).select("file", "table_index", "action")


@query(f"""SELECT file, table_index, row_number() OVER (ORDER BY (action LIKE 'defer%' OR action LIKE 'exclude%')::INT, CASE WHEN level IS NULL THEN 0 WHEN level = 'province' THEN 1 WHEN level = 'city' THEN 2 ELSE 9 END,
density DESC NULLS LAST, missing DESC, edition DESC NULLS LAST, file, table_index) AS place FROM {_ACTIONS}""")
def acquisition_rank(spark, sf):
    """Every table with its place in the order of acquisition."""
    rows = _actions(spark, sf)
    return planning.placed(rows, planning.acquisition_order(rows)).select("file", "table_index", "place")


@query(f"""SELECT file, table_index, row_number() OVER (ORDER BY (action LIKE 'defer%' OR action LIKE 'exclude%')::INT, CASE WHEN level IS NULL THEN 0 WHEN level = 'province' THEN 1 WHEN level = 'city' THEN 2 ELSE 9 END,
density DESC NULLS LAST, missing DESC, edition DESC NULLS LAST, file, table_index) AS place FROM {_ACTIONS} QUALIFY place <= 100""")
def acquisition_top(spark, sf):
    """A report of the next hundred acquisitions, the head of ``acquisition_rank``; sorted and limited before they are numbered."""
    rows = _actions(spark, sf)
    top = rows.orderBy(*planning.acquisition_order(rows)).limit(100)
    w = Window.partitionBy(F.lit(1)).orderBy(*planning.acquisition_order(rows))
    return top.select("file", "table_index", F.row_number().over(w).alias("place"))


@query(f"""SELECT c.research_id, CASE WHEN city_level = 'municipality' THEN 'reuse_province_layer' WHEN d.research_id IS NULL THEN 'defer_until_provincial_gap_checked' ELSE 'use_supplied_city_url' END AS action
FROM city_catalog c LEFT JOIN (SELECT DISTINCT research_id FROM ({SQL['documented_gap_semi']})) d USING (research_id)""")
def city_plan(spark, sf):
    return planning.city_actions(table(spark, sf, "city_catalog"), documented_gap_semi(spark, sf))


@query(f"""SELECT batch_id, count(*) FILTER (outcome = 'selected') AS selected, count(*) FILTER (outcome IN ('pending', 'conflict')) AS unresolved,
count(*) FILTER (outcome = 'selected') > 0 AND count(*) FILTER (outcome IN ('pending', 'conflict')) = 0 AS ready
FROM ({SQL['outcome_partition']}) o JOIN candidates USING (row_id) GROUP BY 1""")
def export_gate(spark, sf):
    rows = outcome_partition(spark, sf).join(table(spark, sf, "candidates").select("row_id", "batch_id"), "row_id")
    return planning.export_gate(rows, "batch_id")


@query("""SELECT capture_id, lower(regexp_extract(url, '^https?://(?:[^/@]*@)?([^/:?#]+)', 1)) AS host,
url IS NOT NULL AND regexp_matches(url, '^https?://[^/@]+(/|$)') AND lower(regexp_extract(url, '^https?://([^/:?#]+)', 1)) IN (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL) AS registered FROM captures""")
def host_registry_join(spark, sf):
    """Whether a capture's host is one of the registered hosts (the hosts of the documents)."""
    host = F.lower(F.regexp_extract("url", "^https?://(?:[^/@]*@)?([^/:?#]+)", 1))
    registry = table(spark, sf, "documents").where("source is not null").select(F.col("source").alias("host")).distinct().withColumn("known", F.lit(True))
    rows = table(spark, sf, "captures").select("capture_id", "url", host.alias("host")).join(registry, "host", "left")
    plain = F.coalesce(F.col("url").rlike("^https?://[^/@]+(/|$)"), F.lit(False))
    return rows.select("capture_id", "host", (plain & F.coalesce("known", F.lit(False))).alias("registered"))


@query("SELECT manifest, capture_id, sha256 FROM (SELECT *, row_number() OVER (PARTITION BY manifest ORDER BY retrieved_at DESC NULLS LAST, capture_id DESC) AS n FROM captures WHERE manifest IS NOT NULL) WHERE n = 1")
def capture_last_wins(spark, sf):
    best = F.max(F.struct("retrieved_at", "capture_id", "sha256")).alias("b")
    return table(spark, sf, "captures").where("manifest is not null").groupBy("manifest").agg(best).select("manifest", "b.capture_id", "b.sha256")


@query("SELECT DISTINCT sha256 FROM captures WHERE sha256 IS NOT NULL EXCEPT SELECT sha256 FROM candidates")
def source_set_difference(spark, sf):
    return table(spark, sf, "captures").where("sha256 is not null").select("sha256").distinct().join(table(spark, sf, "candidates").select("sha256").distinct(), "sha256", "left_anti")


@query("""SELECT capture_id, coalesce(next_url = final_url, false) AS linked FROM (SELECT capture_id, final_url, lead(url) OVER (PARTITION BY manifest ORDER BY retrieved_at, capture_id) AS next_url FROM captures WHERE manifest IS NOT NULL)""")
def link_chain_check(spark, sf):
    """Whether the next capture of a manifest starts where this one ended."""
    w = Window.partitionBy("manifest").orderBy("retrieved_at", "capture_id")
    rows = table(spark, sf, "captures").where("manifest is not null").select("capture_id", "final_url", F.lead("url").over(w).alias("next_url"))
    return rows.select("capture_id", F.coalesce(F.col("next_url") == F.col("final_url"), F.lit(False)).alias("linked"))


@query("""WITH RECURSIVE e AS (SELECT o_custkey AS src, l_suppkey AS dst FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
d0 AS (SELECT DISTINCT c_custkey AS node FROM customer WHERE c_nationkey = 3),
d1 AS (SELECT DISTINCT dst AS node FROM e JOIN d0 ON src = node EXCEPT SELECT node FROM d0),
d2 AS (SELECT DISTINCT dst AS node FROM e JOIN d1 ON src = node EXCEPT (SELECT node FROM d0 UNION SELECT node FROM d1))
SELECT node, 0 AS depth FROM d0 UNION ALL SELECT node, 1 FROM d1 UNION ALL SELECT node, 2 FROM d2""")
def bounded_traversal(spark, sf):
    """Nodes within two steps, from the customers of one nation, over the edges of orders to suppliers."""
    edges = table(spark, sf, "orders").join(table(spark, sf, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("src"), F.col("l_suppkey").alias("dst"))
    seeds = table(spark, sf, "customer").where("c_nationkey = 3").select(F.col("c_custkey").alias("node"))
    return planning.traverse(edges, seeds, 2)


def _rule_sql(pattern: str) -> str:
    """Values that a rule's pattern finds, in order; a forbidden prefix is matched and left out instead."""
    p = pattern.replace("(?<!人均)", "(?:人均)?").replace(r"\s", _WHITE).replace("(?P<value>", "(")
    p = p.replace("(?P<unit>", "(?:").replace("(?P<direction>", "(?:").replace("'", "''")
    whole = f"list_filter(regexp_extract_all(text, '{p}', 0), lambda m: NOT starts_with(m, '人均'))"
    return f"list_filter(list_transform({whole}, lambda m: regexp_extract(m, '{p}', 1)), lambda v: regexp_full_match(v, '[+-]?([0-9]{{1,3}}(,[0-9]{{3}})+|[0-9]+)([.][0-9]+)?'))"


@query("SELECT doc_id, rule, len(v) AS mentions, abs(try_cast(replace(v[1], ',', '') AS DOUBLE)) AS first_size FROM (" + " UNION ALL ".join(f"SELECT doc_id, '{rule}' AS rule, {_rule_sql(pattern)} AS v FROM documents" for rule, _, pattern in prose.RULES) + ") WHERE len(v) > 0")
def prose_rules(spark, sf):
    """How often each rule matches in each document, and the size of the first value."""
    found = prose.prose_mentions(table(spark, sf, "documents"), "doc_id")
    return found.groupBy("doc_id", "rule").agg(F.count("*").alias("mentions"), F.abs(F.min(F.struct("char_start", "value"))["value"]).alias("first_size"))


@query("SELECT word_id FROM layout WHERE confidence IS NULL OR confidence < 0.85")
def low_confidence_words(spark, sf):
    return table(spark, sf, "layout").where("confidence is null or confidence < 0.85").select("word_id")


_NUMERIC = r"^[-+]?[0-9][0-9,.]*[%‰]?$"
_BARE = f"translate({strip_sql('text')}, '．，％', '.,%')"
_LITERALS = f"""(WITH s AS (SELECT *, {_BARE} AS bare, lag(x + w) OVER p AS before, lag(h) OVER p AS h0 FROM layout
WHERE coalesce(regexp_matches({_BARE}, '^[0-9.,+\\-%]+$'), false) AND x IS NOT NULL AND w IS NOT NULL AND h IS NOT NULL WINDOW p AS (PARTITION BY source_sha256, page, y ORDER BY x, word_id))
SELECT *, sum(CASE WHEN before IS NULL OR x - before >= greatest(10.0, 0.7 * least(h, h0)) THEN 1 ELSE 0 END) OVER (PARTITION BY source_sha256, page, y ORDER BY x, word_id ROWS UNBOUNDED PRECEDING)::BIGINT AS literal FROM s)"""


@query(f"SELECT word_id, literal FROM {_LITERALS}")
def ocr_literal_groups(spark, sf):
    return layout.literal_groups(table(spark, sf, "layout"), ("source_sha256", "page", "y")).select("word_id", "literal")


@query(f"""SELECT * FROM (SELECT source_sha256, page, y, string_agg(bare, '' ORDER BY x, word_id) AS literal, arg_min(word_id, row(x, word_id)) AS first_word
FROM {_LITERALS} GROUP BY source_sha256, page, y, literal) WHERE ({number_sql('literal')}) IS NOT NULL""")
def ocr_literals(spark, sf):
    """The numbers of each line of a page, put together from neighbouring words."""
    return layout.with_literals(table(spark, sf, "layout"), ("source_sha256", "page", "y")).select("source_sha256", "page", "y", "literal", "first_word")


BOUNDS = tuple((f"c{i}", i / 8, (i + 1) / 8) for i in range(8))


@query(f"""SELECT word_id, CASE {' '.join(f"WHEN c >= {lo} AND c < {hi} THEN '{n}'" for n, lo, hi in BOUNDS)} END AS col,
CASE WHEN c >= 0 AND c < 1 THEN 1 ELSE 0 END AS hits FROM (SELECT word_id, (x + w / 2) / page_width AS c FROM layout)""")
def interval_column_join(spark, sf):
    return layout.in_columns(table(spark, sf, "layout"), BOUNDS)


_BANDS = "(SELECT *, dense_rank() OVER (PARTITION BY source_sha256, page ORDER BY y) - 1 AS band FROM layout WHERE y IS NOT NULL AND h IS NOT NULL)"


@query(f"SELECT word_id, band::INT AS band FROM {_BANDS}")
def ocr_row_bands(spark, sf):
    """Rows of each page; where lines are further apart than words are high, as in these tables, they are the distinct places."""
    return layout.row_bands(table(spark, sf, "layout")).select("word_id", "band")


@query()
def ocr_tile_dedupe(spark, sf):
    return layout.without_tile_copies(table(spark, sf, "layout"))


_CITY = "regexp_extract(text, '" + _LABEL_SQL + "', 1)"


@query(f"""SELECT source_sha256, pages, labels, CASE WHEN pages > 1 THEN 'MULTIPAGE_LAYOUT_NOT_VALIDATED' WHEN labels > 1 THEN 'MULTICITY_SCAN_LAYOUT_NOT_VALIDATED' ELSE 'OK' END AS code
FROM (SELECT source_sha256, count(DISTINCT page) AS pages, count(DISTINCT CASE WHEN {_CITY} <> '' AND {_CITY} NOT IN ('城市', '全市', '地区', '市辖区', '全区', '全县') THEN {_CITY} END) AS labels FROM layout GROUP BY 1)""")
def boundary_codes(spark, sf):
    return layout.boundary_codes(table(spark, sf, "layout"))


@query("""SELECT row_id, n FROM (SELECT row_id, row_number() OVER (PARTITION BY file, table_index, city, year, indicator, geographic_scope ORDER BY row_id) AS n
FROM candidates WHERE kind = 'ocr_matrix') WHERE n > 1""")
def matrix_overlap_keys(spark, sf):
    rows = table(spark, sf, "candidates").where("kind = 'ocr_matrix'")
    return selection.numbered(rows, ("file", "table_index", "city", "year", "indicator", "geographic_scope"), (F.col("row_id"),)).where("n > 1").select("row_id", "n")


def _phases(spark, sf):
    start = F.unix_micros(F.col("ts").cast("timestamp"))
    return table(spark, sf, "events").where("value is not null").select("user_id", "event_type", start.alias("s"), (start + F.round(F.col("value") * 1_000_000).cast("long")).alias("e"), "value")


_PHASES = "(SELECT user_id, event_type, epoch_us(ts) AS s, epoch_us(ts) + round(value * 1000000)::BIGINT AS e, value FROM events WHERE value IS NOT NULL)"


@query(f"""SELECT p.phase, count(e.event_type) AS events, coalesce(sum(e.value::DECIMAL(20, 6)), 0)::DOUBLE AS seconds
FROM (SELECT unnest([{listed(PHASES)}]) AS phase) p LEFT JOIN events e ON e.event_type = p.phase AND e.value IS NOT NULL GROUP BY 1""")
def phase_totals(spark, sf):
    return ledger.phase_totals(table(spark, sf, "events").where("value is not null"), PHASES, "event_type", "value")


@query(f"""WITH o AS (SELECT user_id, s, e, max(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {_PHASES})
SELECT user_id, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END)::BIGINT AS islands,
sum(CASE WHEN reach IS NULL OR s > reach THEN e - s WHEN e > reach THEN e - reach ELSE 0 END)::BIGINT AS covered FROM o GROUP BY 1""")
def interval_union(spark, sf):
    return ledger.covered_time(_phases(spark, sf), "user_id", "s", "e")


@query(f"""WITH a AS (SELECT event_id, user_id, ts, coalesce(event_type = 'purchase', false) AS failed, coalesce(event_type = 'view', true) AS ignored FROM events),
r AS (SELECT *, sum(CASE WHEN NOT failed AND NOT ignored THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM a),
k AS (SELECT *, sum(CASE WHEN failed AND NOT ignored THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, run ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS streak FROM r)
SELECT event_id, streak, streak >= 2 AS open FROM k""")
def circuit_breaker(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "user_id", "ts", F.coalesce(F.col("event_type") == "purchase", F.lit(False)).alias("failed"), F.coalesce(F.col("event_type") == "view", F.lit(True)).alias("ignored"))
    return ledger.streaks(rows, "user_id", ("ts", "event_id"), "failed", "ignored").select("event_id", "streak", "open")


@query("""SELECT event_id, CASE WHEN nk = 'purchase' THEN epoch_us(nt) END AS ended_at FROM (SELECT event_id, event_type, lead(event_type) OVER w AS nk, lead(ts) OVER w AS nt
FROM events WHERE event_type IN ('click', 'purchase') WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE event_type = 'click'""")
def phase_pairing(spark, sf):
    got = ledger.pairs(table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type"), "user_id", ("ts", "event_id"), "event_type", "click", "purchase")
    return got.select("event_id", F.unix_micros(F.col("ended_at").cast("timestamp")).alias("ended_at"))


@query("""SELECT row_id, sha256(concat_ws(chr(31), coalesce(id, chr(1)), coalesce(sha256, chr(1)), coalesce(value_text, chr(1)))) AS digest FROM candidates""")
def cache_digest(spark, sf):
    mark = lambda c: F.coalesce(F.col(c), F.lit("\x01"))
    return table(spark, sf, "candidates").select("row_id", F.sha2(F.concat_ws("\x1f", mark("id"), mark("sha256"), mark("value_text")), 256).alias("digest"))


@query("""SELECT research_id, edition FROM (SELECT DISTINCT research_id, edition, dense_rank() OVER (PARTITION BY research_id ORDER BY edition DESC) AS n FROM candidates WHERE research_id IS NOT NULL AND edition IS NOT NULL) WHERE n <= 3""")
def edition_topk(spark, sf):
    """The three latest editions of each city."""
    rows = table(spark, sf, "candidates").where("research_id is not null and edition is not null").select("research_id", "edition").distinct()
    return selection.numbered(rows, ("research_id",), (F.desc("edition"),)).where("n <= 3").select("research_id", "edition")


@query("SELECT source_class, kind, count(*) AS rows FROM candidates GROUP BY 1, 2")
def source_union_counts(spark, sf):
    """Article, layout, matrix and table streams put together and counted."""
    rows = table(spark, sf, "candidates").select("source_class", "kind")
    parts = [rows.where("kind is null"), *[rows.where(F.col("kind") == k) for k in ("article_span", "ocr_layout", "ocr_matrix")], rows.where("kind not in ('article_span', 'ocr_layout', 'ocr_matrix')")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("source_class", "kind").agg(F.count("*").alias("rows"))


@query()
def prose_mentions(spark, sf):
    """Mentions of all rules in all documents, with their places; the year of publication is what a document is about."""
    docs = table(spark, sf, "documents").withColumn("about", F.year("published_at") - 1)
    return prose.prose_mentions(docs, "doc_id", year="about")


@query()
def prose_missing(spark, sf):
    return prose.missing_indicators(prose_mentions(spark, sf), "doc_id", KEPT)


@query()
def matrix_plan(spark, sf):
    return matrix.plan_pages(table(spark, sf, "layout"), INDICATORS)


@query()
def matrix_values(spark, sf):
    return matrix.read_pages(table(spark, sf, "layout"), INDICATORS)


@query()
def matrix_continuation(spark, sf):
    return matrix.continues(matrix_plan(spark, sf))


_CLASSES = " ".join(f"WHEN '{c}' THEN '{k}'" for c, k, _ in failures.CLASSES)
_RETRY = " ".join(f"WHEN '{c}' THEN {str(r).lower()}" for c, _, r in failures.CLASSES)


@query(f"""SELECT row_id, CASE failure {_CLASSES} ELSE 'parse' END AS category, CASE failure {_RETRY} ELSE false END AS retryable
FROM ({SQL['audit_first_failure']}) WHERE failure IS NOT NULL""")
def failure_classify(spark, sf):
    rows = _failures(spark, sf).where("failure is not null").withColumn("c", failures.classified(F.col("failure")))
    return rows.select("row_id", "c.category", "c.retryable")


@query("""SELECT source_sha256, array_to_string(list_sort(list_distinct(list_filter([1, 3, 8, (p + 1) // 2, p], lambda x: x >= 1 AND x <= p))), ',') AS sample
FROM (SELECT source_sha256, max(page) AS p FROM layout GROUP BY 1)""")
def pdf_page_sample(spark, sf):
    rows = table(spark, sf, "layout").groupBy("source_sha256").agg(F.max("page").alias("p"))
    return rows.select("source_sha256", F.array_join(failures.sampled_pages(F.col("p")).cast("array<string>"), ",").alias("sample"))


@query(f"""SELECT user_id, CASE WHEN n > 0 THEN round(covered / 10000.0 / n, 6)::DOUBLE END AS seconds_per_100
FROM ({SQL['interval_union']}) LEFT JOIN (SELECT user_id, count(*) FILTER (event_type = 'purchase') AS n FROM events GROUP BY 1) USING (user_id)""")
def seconds_per_100(spark, sf):
    """Covered time for every hundred purchases, null where there are none."""
    made = table(spark, sf, "events").groupBy("user_id").agg(F.count(F.when(F.col("event_type") == "purchase", 1)).alias("n"))
    rows = interval_union(spark, sf).join(made, "user_id", "left")
    return rows.select("user_id", F.when(F.col("n") > 0, F.round(F.col("covered") / 10000.0 / F.col("n"), 6)).alias("seconds_per_100"))


@query(f"""SELECT c.research_id, count(DISTINCT year) AS years, min(year) AS first_year, max(year) AS last_year, count(*) AS missing
FROM {_GAPS} c GROUP BY 1""")
def gap_report(spark, sf):
    return _gaps(spark, sf).groupBy("research_id").agg(F.count_distinct("year").alias("years"), F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.count("*").alias("missing"))


@query("""SELECT c.row_id FROM candidates c WHERE c.sha256 IN (SELECT source_sha256 FROM reviews WHERE source_sha256 IS NOT NULL)""")
def reviewed_source_semi(spark, sf):
    seen = table(spark, sf, "reviews").where("source_sha256 is not null").select(F.col("source_sha256").alias("sha256")).distinct()
    return table(spark, sf, "candidates").join(seen, "sha256", "left_semi").select("row_id")


@query("""SELECT reviewer, decision, count(*) AS reviews, count(DISTINCT record_id) AS records FROM reviews GROUP BY 1, 2""")
def review_counts(spark, sf):
    return table(spark, sf, "reviews").groupBy("reviewer", "decision").agg(F.count("*").alias("reviews"), F.count_distinct("record_id").alias("records"))


@query(f"""SELECT row_id, CASE WHEN value_text IS NULL OR ({number_sql('value_text')}) IS NOT NULL THEN 0 ELSE len(regexp_extract_all(value_text, '[+-]?[0-9]+(?:\\.[0-9]+)?')) END AS tokens FROM candidates""")
def numeric_token_count(spark, sf):
    t = F.col("value_text")
    tokens = F.regexp_count(t, F.lit(r"[+-]?[0-9]+(?:\.[0-9]+)?"))
    return table(spark, sf, "candidates").select("row_id", F.when(t.isNull() | text.number(t).isNotNull(), 0).otherwise(tokens).cast("long").alias("tokens"))


@query(f"""SELECT city, research_id, how FROM (SELECT t.city, a.research_id, a.how, row_number() OVER (PARTITION BY t.city ORDER BY a.how, a.research_id) AS n
FROM (SELECT DISTINCT city FROM candidates WHERE city IS NOT NULL) t JOIN (SELECT research_id, name AS k, 1 AS how FROM city_catalog
UNION ALL SELECT research_id, unnest(coalesce(aliases, [])), 2 FROM city_catalog UNION ALL SELECT research_id, research_id, 3 FROM city_catalog) a ON a.k = t.city) WHERE n = 1""")
def catalog_lookup(spark, sf):
    """Entry of every typed city: by its name, else by an alias, else by its code; three equi-joins instead of an OR."""
    c = table(spark, sf, "city_catalog")
    keys = c.select("research_id", F.col("name").alias("city"), F.lit(1).alias("how"))
    keys = keys.unionByName(c.select("research_id", F.explode("aliases").alias("city"), F.lit(2).alias("how")))
    keys = keys.unionByName(c.select("research_id", F.col("research_id").alias("city"), F.lit(3).alias("how")))
    typed = table(spark, sf, "candidates").where("city is not null").select("city").distinct()
    return typed.join(keys, "city").groupBy("city").agg(F.min(F.struct("how", "research_id")).alias("m")).select("city", "m.research_id", "m.how")


_HEAD = r"^20[0-9]{2}年?$"


@query(f"""SELECT word_id, header_id FROM (SELECT v.word_id, h.word_id AS header_id, row_number() OVER (PARTITION BY v.word_id ORDER BY abs(h.x + h.w / 2 - v.x - v.w / 2), h.y DESC, h.word_id) AS n
FROM layout v JOIN layout h ON h.source_sha256 = v.source_sha256 AND h.page = v.page AND h.y < v.y AND abs(h.x + h.w / 2 - v.x - v.w / 2) < 0.05 * v.page_width
WHERE regexp_matches(v.text, '{_NUMERIC}') AND NOT regexp_matches(v.text, '{_HEAD}') AND regexp_matches(h.text, '{_HEAD}')) WHERE n = 1""")
def header_proximity_join(spark, sf):
    """The year header nearest above each number, within a twentieth of the page's width."""
    words = table(spark, sf, "layout")
    head = words.where(F.col("text").rlike(_HEAD)).select("source_sha256", "page", F.col("word_id").alias("header_id"), (F.col("x") + F.col("w") / 2).alias("hc"), F.col("y").alias("hy"))
    number = words.where(F.col("text").rlike(_NUMERIC) & ~F.col("text").rlike(_HEAD)).select("source_sha256", "page", "word_id", (F.col("x") + F.col("w") / 2).alias("c"), "y", "page_width")
    gap = F.abs(F.col("hc") - F.col("c"))
    met = number.join(head, ["source_sha256", "page"]).where((F.col("hy") < F.col("y")) & (gap < 0.05 * F.col("page_width")))
    return met.groupBy("word_id").agg(F.min(F.struct(gap.alias("gap"), (-F.col("hy")).alias("above"), "header_id")).alias("m")).select("word_id", "m.header_id")


@query("""SELECT source_sha256, page, string_agg(text, '' ORDER BY i) AS title FROM (SELECT source_sha256, page, i, min(text) AS text
FROM (SELECT source_sha256, page, text, i FROM layout JOIN (SELECT unnest([2, 0, 1]) AS ref, unnest([0, 1, 2]) AS i) ON word_index = ref WHERE text IS NOT NULL) GROUP BY 1, 2, 3) GROUP BY 1, 2""")
def anchor_lookup(spark, sf):
    """Texts of referenced words of each page, put together in the order of the references."""
    refs = F.posexplode(F.array(F.lit(2), F.lit(0), F.lit(1))).alias("i", "ref")
    words = table(spark, sf, "layout").where("text is not null and word_index <= 2").select("source_sha256", "page", "text", "word_index", refs).where("word_index = ref")
    one = words.groupBy("source_sha256", "page", "i").agg(F.min("text").alias("text"))
    parts = F.array_sort(F.collect_list(F.struct("i", "text")))  # three at most
    return one.groupBy("source_sha256", "page").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("title"))


@query("""SELECT id, count(*) AS rows, count(DISTINCT coalesce(value::VARCHAR, '')) > 1 AS value_differs, count(DISTINCT coalesce(unit, '')) > 1 AS unit_differs, count(DISTINCT coalesce(city, '')) > 1 AS city_differs
FROM candidates GROUP BY 1 HAVING count(*) > 1""")
def identity_conflicts(spark, sf):
    """Fields in which rows of one identity differ."""
    differs = lambda c: (F.min(F.coalesce(F.col(c), F.lit(""))) != F.max(F.coalesce(F.col(c), F.lit("")))).alias(f"{c}_differs")
    rows = table(spark, sf, "candidates").select("id", F.col("value").cast("string").alias("value"), "unit", "city")
    return rows.groupBy("id").agg(F.count("*").alias("rows"), *map(differs, ("value", "unit", "city"))).where("rows > 1")


@query(f"""SELECT year, indicator, count(*) AS cities, count(DISTINCT edition) AS editions, min(value) AS least, max(value) AS most FROM {_WIN} GROUP BY 1, 2""")
def panel_coverage(spark, sf):
    return _winners(spark, sf).groupBy("year", "indicator").agg(F.count("*").alias("cities"), F.count_distinct("edition").alias("editions"), F.min("value").alias("least"), F.max("value").alias("most"))


@query("""SELECT loaded_day, count(*) AS rows, count(*) FILTER (late > 86400000000) AS late_rows, max(late) AS worst FROM (
SELECT strftime(loaded_at, '%Y-%m-%d') AS loaded_day, epoch_us(loaded_at) - epoch_us(extracted_at) AS late FROM candidates) GROUP BY 1""")
def late_arrivals(spark, sf):
    """Rows by the day they were loaded, and how many came over a day after their extraction."""
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    rows = table(spark, sf, "candidates").select(F.date_format("loaded_at", "yyyy-MM-dd").alias("loaded_day"), (micros("loaded_at") - micros("extracted_at")).alias("late"))
    return rows.groupBy("loaded_day").agg(F.count("*").alias("rows"), F.count(F.when(F.col("late") > 86_400_000_000, 1)).alias("late_rows"), F.max("late").alias("worst"))
