"""Prose, matrices of scanned pages, failures and sinks."""

import pytest
from pyspark.sql import functions as F

from tabulon.operators import failures, matrix, prose
from tabulon.sources import sinks


def test_prose_mentions(spark):
    text = "全年地区生产总值100.2亿元，比上年下降7.2%。\n2023年年末常住人口50.5万人。\n全省第一产业增加值9亿元。\n全省统计，全市第二产业增加值8.5亿元。人口自然增长率-2.1‰。"
    df = spark.createDataFrame([(1, text, 2024, "x"), (2, None, 2024, "x"), (3, "", 2024, "x"), (4, "无关" * 9000, 2024, "x")], "doc_id long, text string, about int, rule string")
    got = {r.rule: r for r in prose.prose_mentions(df, "doc_id", year="about").collect()}
    assert {k: (r.value, r.unit, r.excluded) for k, r in got.items()} == {
        "gdp": (100.2, "亿元", None), "gdp_growth": (-7.2, "%", None), "population": (50.5, "万人", "OTHER_YEAR"), "primary": (9.0, "亿元", "OTHER_SUBJECT"), "secondary": (8.5, "亿元", None), "natural_growth": (-2.1, "‰", None),
    }
    assert all(text[r.char_start : r.char_end] == r.quote for r in got.values())
    left = prose.missing_indicators(prose.prose_mentions(df, "doc_id", year="about"), "doc_id", ["地区生产总值", "年末常住人口"]).collect()
    assert [(r.doc_id, r.indicator) for r in left] == [(1, "年末常住人口")]
    assert prose.prose_mentions(df.limit(0), "doc_id").count() == 0


def page(rows, sha="s", number=1, start=0):
    out = []
    for y, cells in rows:
        for x, t in cells:
            out.append((start + len(out), sha, number, 800.0, 500.0, t, float(x), float(y), 60.0, 18.0))
    return out


GRID = [(20, [(300, "地区生产总值")]), (50, [(600, "单位：亿元")]), (80, [(300, "2023年"), (500, "2024年")]), (120, [(40, "甲城市①"), (300, "1,100.5"), (500, "—")]), (150, [(40, "乙城市"), (300, "200"), (425, "7"), (520, "8")]), (180, [(40, "全省"), (300, "9"), (500, "9")])]
WORDS = "word_id long, source_sha256 string, page int, page_width double, page_height double, text string, x double, y double, w double, h double"


def test_matrix_of_a_page(spark):
    rows = page(GRID) + page(GRID[:1] + GRID[2:], "s", 2, 100) + page([(10, [(1, "x")])], "t", 1, 200)
    df = spark.createDataFrame(rows, WORDS)
    got = {(r.source_sha256, r.page, r.city, r.year): (r.value_text, r.status) for r in matrix.read_pages(df, ["地区生产总值"]).collect()}
    assert got[("s", 1, "甲城市①", 2023)] == ("1,100.5", "value") and got[("s", 1, "甲城市①", 2024)] == ("—", "skipped")
    assert got[("s", 1, "乙城市", 2023)] == ("200", "value") and got[("s", 1, "乙城市", 2024)] == ("7 8", "pending")
    assert not [k for k in got if k[2] == "全省"]
    assert got[("s", 2, None, None)][1] == "INDICATOR_OR_UNIT_NOT_UNIQUE" and got[("t", 1, None, None)][1] == "YEAR_HEADER_NOT_UNIQUE"
    again = spark.createDataFrame(page(GRID) + page(GRID, "s", 2, 100), WORDS)
    plans = matrix.plan_pages(again, ["地区生产总值"])
    assert {(r.page, r.continued) for r in matrix.continues(plans).collect()} == {(1, False), (2, True)}
    assert matrix.valid_plans(plans).count() == 2
    assert matrix.read_pages(df.limit(0), ["x"]).count() == 0


def test_bounds(spark):
    df = spark.createDataFrame([([0.3, 0.5],), ([0.2, 0.5, 0.98],)], "c array<double>")
    got = [[tuple(e) for e in r.e] for r in df.select(matrix.cuts(F.col("c")).alias("e")).collect()]
    assert got[0] == [(pytest.approx(0.2), 0.4), (0.4, pytest.approx(0.6))]
    assert got[1] == [(pytest.approx(0.05), 0.35), (0.35, 0.74), (0.74, 1.0)]


def test_cells_that_cannot_be_read_stay_pending(spark):
    grid = [*GRID[:3], (120, [(40, "甲市"), (300, "11"), (420, "22")]), (150, [(40, "甲市"), (300, "1"), (500, "2")]), (180, [(40, "乙县续表"), (300, "3")]), (210, [(40, "#丙区"), (290, "4"), (345, ".5")]), (240, [(40, "丁市")])]
    rows = [r if r[5] != "22" else (*r[:8], 150.0, r[9]) for r in page(grid)]
    values = matrix.read_pages(spark.createDataFrame(rows, WORDS), ["地区生产总值"])
    got = {(r.city, r.year, r.status): r.value_text for r in values.collect()}
    assert got[("甲市", 2023, "value")] == "11" and got[("甲市", 2024, "BOX_CROSSES_COLUMN")] == "22"
    assert got[("甲市", 2023, "OVERLAPPING_OR_CONFLICTING_ROWS")] == "1" and got[("甲市", 2024, "value")] == "2"
    assert got[("乙县", 2023, "LABEL_MIXED")] == "3" and got[("#丙区", 2023, "value")] == "4.5" and got[("#丙区", 2024, "pending")] is None
    assert {r.city for r in matrix.empty_rows(values).collect()} == {"乙县", "丁市"}


def test_failures(spark):
    df = spark.createDataFrame([("HTTP_503", 206, True, 5, 138), ("HTTP_404", 206, False, 5, 1), ("OCR_EMPTY", 200, True, 0, 4), (None, 500, True, 0, 8)], "c string, s int, v boolean, p int, n int")
    r = df.select(failures.classified(F.col("c")).alias("k"), failures.resume_decision(F.col("s"), F.col("v"), F.col("p")).alias("d"), failures.sampled_pages(F.col("n")).alias("g")).collect()
    assert [x.k and tuple(x.k) for x in r] == [("network", True), ("network", False), ("parse", False), None]
    assert [x.d for x in r] == ["append", "discard_and_fail", "restart", "fail"]
    assert [x.g for x in r] == [[1, 3, 8, 69, 138], [1], [1, 2, 3, 4], [1, 3, 4, 8]]
    with pytest.raises(ValueError, match="NO_CANDIDATES"):
        failures.require_rows(df.limit(0), "NO_CANDIDATES")


def test_sinks_and_cache(spark, tmp_path):
    df = spark.createDataFrame([("b", 2, None), ("a", 1, 1.5)], "research_id string, year int, v double")
    sinks.write_panel(df, str(tmp_path / "wide"))
    assert [r._c0 for r in spark.read.csv(str(tmp_path / "wide")).collect()] == ["research_id", "a", "b"]
    sinks.write_json(df, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 2
    with pytest.raises(ValueError):
        sinks.write_long(df.limit(0), str(tmp_path / "long"))
    calls = []

    def work(x):
        calls.append(x.count())
        return x.select("digest", (F.col("v") * 2).alias("r"))

    for _ in range(2):
        got = sinks.through_cache(spark, df.unionAll(df), str(tmp_path / "cache"), ["research_id", "year", "v"], work)
        assert sorted((r.r is None, r.r) for r in got.collect()) == [(False, 3.0), (True, None)]
    assert calls == [2, 0]


def test_scaling_formats():
    from tabulon.sources.tables import scales, spread

    assert all(scales(c) for c in ("0%", "0,", "#,##0,", '0.0,"千"', "0,;-0", "#,##0,,.0"))
    assert not any(scales(c) for c in ("0", "#,##0", '0"%"', "0\\%", "[>9%]0", "#,##0.00;(#,##0)", "", 'General "a,b"'))
    assert spread([[("a", 3, 1), ("b", 1, 1)]]) == [[("a", 0, 0), ("b", 0, 1)], [("a", 0, 0), ("", 1, 1)], [("a", 0, 0), ("", 2, 1)]]
