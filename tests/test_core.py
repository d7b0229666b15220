"""Operators outside ``llm``: named cases, brute force, nulls, empty tables, ties and repeats."""

import datetime
import glob
import io
import os
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from tabulon import queries
from tabulon.functions import skew, text
from tabulon.operators import audit, layout, ledger, orphans, planning, selection, units
from tabulon.sources import pages, tables

DAY = datetime.datetime(2024, 3, 1)


def days(n):
    return DAY + datetime.timedelta(days=n)


# -- text -------------------------------------------------------------------


def test_numeric_literals(spark):
    cases = {
        "下降7.2%": -7.2, "0": 0.0, "1,234.5": 1234.5, "": None, "—": None, "..": None, "计划100": None, "=A1+B1": None, "　 12 \n": 12.0, "１２３": 123.0,
        "−5": -5.0, "下降-3": None, "1,23": None, "+4‰": 4.0, "减少 3": -3.0, None: None, "12 %": 12.0, "1.2.3": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", text.number(F.col("t")).alias("n"))
    assert {r.t: r.n for r in df.collect()} == cases


def test_whitespace_identity_and_brackets(spark):
    import hashlib
    import json

    df = spark.createDataFrame([(" a　b\xa0", "（x)", "说\"q\"", 2019, None)], "a string, b string, c string, d int, e string")
    r = df.select(text.norm(F.col("a")).alias("n"), text.brackets_balanced(F.col("b")).alias("b"), text.identity(F.col("c"), F.col("d"), F.col("e")).alias("i"), text.numeric_tokens(F.lit("Langfang 100.2 20.5")).alias("k")).first()
    want = hashlib.sha256(json.dumps(["说\"q\"", 2019, None], ensure_ascii=False).encode()).hexdigest()[:24]
    assert (r.n, r.b, r.i, r.k) == ("ab", True, want, 2)


def test_hot_keys_and_join(spark):
    rows = [(i, "hot" if i % 3 else f"k{i}") for i in range(300)] + [(999, None)]
    left = spark.createDataFrame(rows, "i long, k string")
    right = spark.createDataFrame([("hot", 1)] + [(f"k{i}", 2) for i in range(0, 300, 6)], "k string, v int")
    assert "hot" in skew.hot_keys(left, "k")
    got = {(r.i, r.k, r.v) for r in skew.join_unique(left, right, "k").collect()}
    assert got == {(r.i, r.k, r.v) for r in left.join(right, "k", "left").collect()} and len(got) == 301
    assert skew.join_unique(left.limit(0), right, "k").count() == 0


# -- orphans ----------------------------------------------------------------


def plain_orphans(refs, parents):
    alive = {}
    for _, k, t, gone in parents:
        if not gone and t is not None and k is not None:
            alive[k] = min(t, alive.get(k, t))
    return sorted(i for i, k, t in refs if k and not (k in alive and t is not None and alive[k] <= t))


def frames(spark, refs, parents):
    return spark.createDataFrame(refs, "row_id long, key string, time timestamp"), spark.createDataFrame(parents, "parent_id long, key string, time timestamp, deleted boolean")


def test_orphans_increment_by_increment(spark):
    rng = random.Random(2)
    keys = [f"k{i}" for i in range(12)] + ["", None]
    state, all_refs, latest = orphans.OrphanState(), [], {}
    for step in range(4):
        refs = [(step * 100 + i, rng.choice(keys), rng.choice([days(rng.randint(0, 9)), None]) if i % 9 == 0 else days(rng.randint(0, 9))) for i in range(25)]
        parents = [(i, rng.choice(keys), days(rng.randint(0, 9)), rng.random() < 0.3) for i in rng.sample(range(40), 8)]
        all_refs += refs
        latest |= {p[0]: p for p in parents}
        state = orphans.advance(state, *frames(spark, refs, parents)).kept()
        assert sorted(r.row_id for r in state.orphans().collect()) == plain_orphans(all_refs, latest.values())
    once = orphans.advance(orphans.OrphanState(), *frames(spark, all_refs, list(latest.values())))
    assert sorted(r.row_id for r in once.orphans().collect()) == plain_orphans(all_refs, latest.values())
    counts = {r.period: r.orphans for r in orphans.snapshot(once.orphans()).collect()}
    assert sum(counts.values()) == len(plain_orphans(all_refs, latest.values()))


def test_orphans_of_empty_tables(spark):
    refs, parents = frames(spark, [(1, "a", DAY)], [])
    assert [r.row_id for r in orphans.advance(orphans.OrphanState(), refs, parents).orphans().collect()] == [1]
    assert orphans.advance(orphans.OrphanState(), refs.limit(0), parents).orphans().count() == 0


# -- units ------------------------------------------------------------------


def test_spellings_of_units():
    cases = {
        "亿元": ("money", 8), "（亿元）": ("money", 8), "单位：亿 元": ("money", 8), "億元": ("money", 8), "RMB 100 mn": ("money", 8), "100 million yuan": ("money", 8),
        "10 000 tons of SCE": ("energy", 4), "kgce": ("energy", -3), "'000 persons": ("people", 3), "万kW·h": ("power", 4), "1000 kWh": ("power", 3), "百万千瓦时": ("power", 6),
        "千瓦时": ("power", 0), "太瓦时": ("power", 9), "per cent": ("rate", -2), "基点": ("rate", -4), "km²": ("area", 6), "ha": ("area", 4), "(million RMB)": ("money", 6),
        "1 000 million yuan": ("money", 9), "见表头": None, "-": None, "": None, None: None, "同上": None, "计量单位": None, "仟人": ("people", 3), "元人民币": ("money", 0),
    }
    for x, y in cases.items():
        assert units.read_unit(x) == y, x
    cells = {"2576.81亿元": ("money", 8), "３，０３７．１４ 亿元": ("money", 8), "下降7.8 ‰": ("rate", -3), "178.27 ten thοusand рersοns": ("people", 4), "12.5": None, "N/A": None, "46２35О0人": ("people", 0)}
    for x, y in cells.items():
        assert units.unit_in_cell(x) == y, x


CATALOG = [("CNY8", "亿元", "money", True), ("CNY4", "万元", "money", False), ("CNY0", "元", "money", False), ("PCT", "%", "rate", True), ("PML", "‰", "rate", False)]


def test_common_values(spark):
    rng = random.Random(1)
    cat = spark.createDataFrame(CATALOG, "unit_code string, symbol string, quantity string, is_common boolean")
    rows = [
        (1, "万元", 12345.0, None, "f", 1, "gdp", 2019), (2, "见表头", 5.0, "5 亿元", "f", 1, "gdp", 2019), (3, None, 7.0, "7", "f", 1, "gdp", 2020),
        (4, None, 8.0, "8", "g", 1, "gdp", 2020), (5, "‰", 3.0, "3", None, None, "rate", 2020), (6, None, None, None, None, None, None, None), (7, "元", None, "", "", 1, "gdp", 2019), (8, None, 0.0, "0", "h", 1, "gdp", 2019),
    ]
    rows += [(100 + i, "亿元", 10 ** rng.gauss(3, 0.2), None, "z", 1, "gdp", 2018) for i in range(200)]
    rows += [(400 + i, None, 10 ** rng.gauss(7, 0.2), None, "z", 1, "gdp", 2018) for i in range(20)]
    df = spark.createDataFrame(rows, "row_id long, unit string, value double, value_text string, file string, table_index int, indicator string, year int").withColumn("posterior", F.lit("clash"))
    maps = [(1, "f", 1, [(1, "gdp", 2020, ""), (2, "gdp", 2020, "万元")]), (2, "f", 1, [(1, "gdp", 2020, "元")]), (3, None, 1, None)]
    mapping = spark.createDataFrame(maps, "mapping_id long, file string, table_index int, columns array<struct<col_index:int,indicator:string,year:int,unit:string>>")
    got = {r.row_id: r for r in units.common_values(df, mapping, cat).collect()}
    assert len(got) == len(rows)
    assert (got[1].unit_code, got[1].unit_source, round(got[1].common_value, 6)) == ("CNY4", "unit", 1.2345)
    assert (got[2].unit_code, got[2].unit_source) == ("CNY8", "value_text")
    assert (got[3].unit_code, got[3].unit_source) == ("CNY4", "mapping")
    assert got[5].unit_code == "PML" and round(got[5].common_value, 6) == 0.3
    assert got[6].unit_code is None and got[6].common_value is None
    assert got[7].unit_code == "CNY0" and got[7].common_value is None
    assert got[8].unit_code is None
    assert all(got[400 + i].unit_code == "CNY4" and got[400 + i].unit_source == "inferred" and not got[400 + i].uncertain for i in range(20))
    found = {(r.row_id, r.unit_code) for r in units.uncommon_units(units.common_values(df, mapping, cat), cat).collect()}
    assert found == {(1, "CNY4"), (3, "CNY4"), (5, "PML")}
    assert units.common_values(df.limit(0), mapping.limit(0), cat).count() == 0


# -- selection --------------------------------------------------------------


def test_priority_follows_the_first_rule(spark):
    rules = [{"publisher_id": "a"}, {"level": "province", "source_class": "yearbook"}, {}]
    rows = [("a", None, None), ("b", "province", "yearbook"), ("b", "city", "yearbook"), (None, None, None)]
    df = spark.createDataFrame(rows, "publisher_id string, level string, source_class string").withColumn("r", selection.priority_rank(rules))
    assert [r.r for r in df.collect()] == [3, 2, 1, 1]
    assert df.withColumn("r", selection.priority_rank(rules[:2])).where("r = 0").count() == 2


def test_outcomes_keep_every_row(spark):
    cols = "row_id long, research_id string, year int, indicator string, geographic_scope string, unit string, value double, edition int, member boolean, scope_ok boolean, gate string, rank int"
    base = ("c", 2020, "i", "全市", "u")
    rows = [
        (1, *base, 1.0, 2025, True, True, "approved", 2), (2, *base, 2.0, 2026, True, True, "approved", 1), (3, *base, 1.0, 2025, True, True, "approved", 2),
        (4, *base, 9.0, 2025, True, False, "approved", 3), (5, *base, 9.0, 2025, True, True, "rejected", 3), (6, *base, 9.0, 2025, True, True, "pending", 3), (7, *base, 9.0, 2025, True, True, "approved", 0),
        (8, "d", 2020, "i", "全市", "u", 1.0, None, True, True, "approved", 1), (9, "d", 2020, "i", "全市", "u", 2.0, None, True, True, "approved", 1), (10, None, None, None, None, None, None, None, False, True, "pending", 0),
    ]
    got = {r.row_id: r.outcome for r in selection.outcomes(spark.createDataFrame(rows, cols)).collect()}
    assert got == {1: "selected", 2: "superseded", 3: "superseded", 4: "excluded", 5: "excluded", 6: "pending", 7: "pending", 8: "conflict", 9: "conflict", 10: "excluded"}
    assert selection.outcomes(spark.createDataFrame([], cols)).count() == 0


def test_review_gate(spark):
    records = spark.createDataFrame([(i, f"id{i}", "h") for i in range(6)], "row_id long, id string, sha256 string")
    reviews = spark.createDataFrame(
        [("id0", "h", "approve", "r", "x"), ("id0", "h", "approve", "r", "x"), ("id1", "stale", "approve", "r", "x"), ("id2", "h", "reject", "r", "x"), ("id3", "h", "approve", "", "x"), ("id4", "h", "approve", "r", "x"), ("id4", "h", "reject", "r", "x"), (None, "h", "approve", "r", "x")],
        "record_id string, source_sha256 string, decision string, reviewer string, reason string",
    )
    got = {r.row_id: r.gate for r in selection.review_gate(records, reviews).collect()}
    assert got == {0: "approved", 1: "pending", 2: "rejected", 3: "pending", 4: "ambiguous", 5: "pending"}


def test_panel_and_conflicts(spark):
    df = spark.createDataFrame([("a", 1, "x", 1.0), ("a", 1, "y", 2.0), ("a", 1, "y", 3.0), ("b", 1, "x", None), ("a", 1, "x", 1.0)], "c string, year int, i string, v double")
    got = {r.c: (r.x, r.y) for r in selection.panel(df, ("c", "year"), "i", "v", ("x", "y")).collect()}
    assert got == {"a": (1.0, None), "b": (None, None)}
    assert [(r.c, r.least, r.most) for r in selection.panel_conflicts(df, ("c", "year"), "i", "v").collect()] == [("a", 2.0, 3.0)]


# -- audit, planning, ledger ------------------------------------------------


def test_first_failure_stops_at_the_first(spark):
    df = spark.createDataFrame([(1, None), (0, 2), (1, 2)], "a int, b int")
    tests = [(F.col("a") == 1, "A"), (F.col("b") == 2, "B")]
    assert [r.f for r in df.select(audit.first_failure(tests).alias("f")).collect()] == ["B", "A", None]


def test_every_living_hash_of_a_file_matches(spark):
    captures = [("f", h, None) for h in "abcdb"] + [("f", "z", DAY), ("g", None, None), ("h", "a", DAY), (None, "a", None)]
    records = [(i, "f", h) for i, h in enumerate(["a", "b", "c", "d", "z", None])] + [(10, "g", "a"), (11, "h", "a"), (12, None, "a"), (0, "f", "a")]
    got = audit.hash_status(spark.createDataFrame(records, "row_id long, file string, sha256 string"), spark.createDataFrame(captures, "file string, sha256 string, deleted_at timestamp")).collect()
    want = {0: "matched", 1: "matched", 2: "matched", 3: "matched", 4: "mismatch", 5: "mismatch", 10: "uncaptured", 11: "uncaptured", 12: "uncaptured"}
    assert {r.row_id: r.status for r in got} == want and len(got) == len(records)


def test_actions_in_override_order(spark):
    rows = [(0, 0, True, "province", 0), (3, 0, True, "province", 0), (3, 1, True, "province", 0), (3, 1, True, "city", 0), (3, 1, True, "city", 1), (3, 1, False, "county", 1), (3, 1, True, None, 1), (3, 0, True, None, 1)]
    df = spark.createDataFrame(rows, "expected int, missing int, reviewed boolean, level string, unlocked int")
    assert [r.action.split("_")[0] for r in planning.table_action(df).collect()] == ["inspect", "reuse", "acquire", "defer", "acquire", "exclude", "inspect", "reuse"]


def test_ranking_keeps_every_table(spark):
    rng = random.Random(3)
    rows = [(f"f{i % 40}", i // 40, rng.choice(["acquire", "defer", "exclude"]), rng.choice([None, "province", "city", "county"]), rng.choice([None, 0.0, 0.25, 1.0]), rng.randint(0, 3), rng.choice([None, 2019, 2020])) for i in range(1000)]
    df = spark.createDataFrame(rows, "file string, table_index int, action string, level string, density double, missing long, edition int")
    level = {None: 0, "province": 1, "city": 2}
    down = lambda x: (x is None, -(x or 0))
    want = sorted(rows, key=lambda r: (r[2] != "acquire", level.get(r[3], 9), down(r[4]), -r[5], down(r[6]), r[0], r[1]))
    got = planning.placed(df.repartition(7), planning.acquisition_order(df)).collect()
    assert {(r.file, r.table_index): r.place for r in got} == {(r[0], r[1]): n for n, r in enumerate(want, 1)} and len(got) == 1000
    assert planning.placed(df.limit(0), planning.acquisition_order(df)).count() == 0


def test_the_registered_ranking_has_every_mapped_table(spark):
    mapped = spark.read.parquet("/root/testdata/sf0.001/table_mapping.parquet").where("file is not null and size(columns) > 0").select("file", "table_index").distinct().count()
    places = [r.place for r in queries.QUERIES["acquisition_rank"](spark, "/root/testdata/sf0.001").collect()]
    assert mapped > 100 and sorted(places) == list(range(1, mapped + 1))


def test_gaps_and_traversal(spark):
    cat = spark.createDataFrame([("a",), ("b",)], "research_id string")
    have = spark.createDataFrame([("a", 2020, "x"), ("a", 2020, "x")], "research_id string, year int, indicator string")
    assert planning.gaps(planning.expected_keys(cat, 2020, 2021, ["x"]), have).count() == 3
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (2, 1), (1, 1)], "src int, dst int")
    got = {(r.node, r.depth) for r in planning.traverse(edges, spark.createDataFrame([(1,)], "node int"), 2).collect()}
    assert got == {(1, 0), (2, 1), (3, 2)}


def test_covered_time_counts_overlaps_once(spark):
    df = spark.createDataFrame([("a", 102, 108), ("a", 105, 110), ("a", 110, 111), ("a", 120, 121), ("b", 5, 5), ("a", 103, 104)], "k string, s long, e long")
    assert {(r.k, r.islands, r.covered) for r in ledger.covered_time(df, "k", "s", "e").collect()} == {("a", 2, 10), ("b", 1, 0)}


def test_streaks(spark):
    rows = [(1, True, False), (2, False, True), (3, True, False), (4, False, False), (5, True, False)]
    df = spark.createDataFrame([("o", *r) for r in rows], "k string, t int, f boolean, g boolean")
    assert [(r.streak, r.open) for r in ledger.streaks(df, "k", ("t",), "f", "g").orderBy("t").collect()] == [(1, False), (1, False), (2, True), (0, False), (1, False)]


# -- layout -----------------------------------------------------------------


def test_bands_follow_the_page(spark):
    words = [(i, "s", 1, x, y, 10.0, h) for i, (x, y, h) in enumerate([(0, 100, 20), (50, 104, 20), (90, 97, 22), (0, 150, 20), (40, 152, 20), (0, 400, 20)])]
    words += [(99, "s", 1, 0.0, None, 1.0, None), (100, "t", 1, 0.0, 5.0, 1.0, 10.0)]
    df = spark.createDataFrame([(i, s, p, float(x), None if y is None else float(y), w, None if h is None else float(h)) for i, s, p, x, y, w, h in words], "word_id long, source_sha256 string, page int, x double, y double, w double, h double")
    got = {r.word_id: r.band for r in layout.row_bands(df).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 1, 4: 1, 5: 2, 100: 0}
    assert layout.row_bands(df.limit(0)).count() == 0


def test_tile_copies_are_dropped_greedily(spark):
    rows = [(1, "a", 0.0), (2, "a", 4.0), (3, "a", 8.0), (4, "b", 0.0), (5, None, 0.0), (6, None, 1.0)]
    df = spark.createDataFrame([(i, "s", 1, t, i, x, 0.0) for i, t, x in rows], "word_id long, source_sha256 string, page int, text string, word_index int, x double, y double")
    assert sorted(r.word_id for r in layout.without_tile_copies(df).collect()) == [1, 3, 4, 5]


# -- sources ----------------------------------------------------------------

PAGE = """<table><caption>表 一</caption><tr><th rowspan=2>城市</th><th colspan="2">2024年</th></tr><tr><th>GDP</th><th>人口</th></tr>
<tr><td>廊坊市<script>x</script></td><td>100.2</td><td>20.5</td></tr><tr><td>衡水市</td><td>200.3<br>a</td><td></td></tr></table>"""


def workbook():
    out = io.BytesIO()
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="S" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/s.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>城市</t></si></sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {main}><numFmts><numFmt numFmtId="200" formatCode="0.0,&quot;%&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="10"/><xf numFmtId="200"/></cellXfs></styleSheet>')
        cells = '<row r="1"><c r="A1" t="s"><v>0</v></c></row><row r="2"><c r="A2" t="inlineStr"><is><t>x</t></is></c><c r="B2"><f>1+1</f><v>2</v></c></row><row r="3"><c r="B3" s="1"><v>0.5</v></c><c r="C3" s="2"><v>9</v></c></row>'
        z.writestr("xl/worksheets/s.xml", f"<worksheet {main}><sheetData>{cells}</sheetData></worksheet>")
    return out.getvalue()


def test_tables_of_sources(spark):
    rows = [
        (1, bytearray(PAGE.encode("gb18030")), "html", "gbk"), (2, bytearray("城市,GDP\n廊坊市,100.2\n衡水市,200.3\n".encode()), "csv", None), (3, bytearray(workbook()), "xlsx", None), (4, None, "html", None),
        (5, bytearray(b"<p>none</p>"), "html", None), (6, bytearray(b"<table><tr><td><table></table></td></tr></table>"), "html", None), (7, bytearray(b"junk"), "xlsx", None), (8, bytearray(b"\xff\xfe\xff"), "html", "utf-8"), (9, bytearray(b"x"), "odd", None),
    ]
    df = spark.createDataFrame(rows, "id long, content binary, format string, enc string")
    got = tables.read_tables(df, "id", encoding="enc").collect()
    fail = {r.id: r.failure for r in got if r.failure}
    assert fail == {4: "EMPTY_SOURCE", 5: "NO_STRUCTURED_TABLES", 6: "NESTED_TABLES", 7: "PARSING_OR_CONFIGURATION_ERROR", 8: "DECODING_ERROR", 9: "FORMAT_UNKNOWN"}
    html = {(r.row, r.col): r for r in got if r.id == 1}
    assert html[0, 1].text == html[0, 2].text == "2024年" and html[1, 0].text == "城市" and (html[1, 0].origin_row, html[1, 0].origin_col) == (0, 0)
    assert html[3, 1].text == "200.3 a" and html[2, 0].text == "廊坊市" and html[0, 0].label == "表 一"
    assert [r.text for r in sorted((r for r in got if r.id == 2 and r.row == 2), key=lambda r: r.col)] == ["衡水市", "200.3"]
    book = {(r.row, r.col): r for r in got if r.id == 3}
    assert book[0, 0].text == "城市" and book[1, 0].text == "x" and book[1, 1].is_formula and book[2, 1].needs_display_review and book[2, 2].needs_display_review and not book[1, 1].needs_display_review
    cols = spark.createDataFrame([(1, 1, "GDP", 2024, "亿元"), (1, 2, "人口", 2024, "万人")], "id long, col_index int, indicator string, year int, unit string")
    seen = {(r.city, r.indicator): r.value for r in tables.extract(tables.read_tables(df, "id", encoding="enc"), cols, ["id"], 0, 2).collect()}
    assert seen == {("廊坊市", "GDP"): 100.2, ("廊坊市", "人口"): 20.5, ("衡水市", "GDP"): None, ("衡水市", "人口"): None}


def test_spans_must_fit():
    with pytest.raises(tables.Unreadable):
        tables.spread([[("a", 0, 1)]])
    with pytest.raises(tables.Unreadable):
        tables.spread([[("a", 1, 1), ("b", 2, 1)], [("c", 1, 2)]])


def test_table_health(spark):
    def cells(k, rows):
        return [(k, r, c, t) for r, row in enumerate(rows) for c, t in enumerate(row)]

    rows = cells("good", [["City", "GDP"], ["a", "1"]]) + cells("wide", [["City", "GDP"], ["a"]]) + cells("many", [["City", "GDP (USD)"], ["Langfang 100.2 20.5", ""]]) + cells("head", [["GDP (USD"]])
    got = {(r.t, r.issue) for r in tables.table_health(spark.createDataFrame(rows, "t string, row int, col int, text string"), ["t"]).collect()}
    assert got == {("wide", "INCONSISTENT_COLUMNS"), ("many", "MULTIPLE_VALUES_IN_CELL"), ("head", "NO_DATA_ROWS"), ("head", "BROKEN_HEADER")}


def test_links_and_articles(spark):
    page = """<meta name="ArticleTitle" content="2025年统计公报"><meta name="PubDate" content="2026-03-01"><h1>其他</h1>
    <a href="/a/tjnj.pdf">统计年鉴 2024</a><a href="b.html">普通</a><a href="b.html">普通</a><a onclick="open('c.html')" href="#">公报</a><iframe src="list.html"></iframe>
    <script><a href="no"></a></script><p>全年地区生产总值100.2亿元。</p><p></p>"""
    df = spark.createDataFrame([("http://h.example/x/", page), ("http://g.example/", None)], "url string, html string")
    got = {(r.url, r.is_attachment, r.is_statistics_hint, r.is_catalog_frame) for r in pages.page_links(df, "url", "html").collect()}
    assert ("http://h.example/a/tjnj.pdf", True, True, False) in got and ("http://h.example/x/list.html", False, False, True) in got and ("http://h.example/x/c.html", False, True, False) in got
    assert len([x for x in got if x[0].endswith("b.html")]) == 1
    reg = spark.createDataFrame([("h.example",)], "host string")
    assert pages.followed(pages.page_links(df, "url", "html"), reg).count() == 3
    art = {r.url: r for r in pages.page_articles(df, "url", "html").collect()}
    assert art["http://h.example/x/"].title == "2025年统计公报" and art["http://h.example/x/"].text.endswith("全年地区生产总值100.2亿元。") and art["http://g.example/"].title is None


# -- queries against their SQL ---------------------------------------------

SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="the driver's tables are not here")
def test_queries_equal_their_sql(spark):
    import math

    import duckdb

    db = duckdb.connect()
    for p in glob.glob(f"{SMALL}/*.parquet"):
        db.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")

    def plain(x):
        return round(x, 6) if isinstance(x, float) and not math.isnan(x) else str(x)

    for name, sql in queries.SQL.items():
        df = queries.QUERIES[name](spark, SMALL)
        cols = sorted(df.columns)
        mine = sorted((tuple(map(plain, r)) for r in df.select(*cols).collect()), key=repr)
        other = db.sql(f"SELECT {', '.join(f'\"{c}\"' for c in cols)} FROM ({sql})").fetchall()
        assert mine == sorted((tuple(map(plain, r)) for r in other), key=repr), name
