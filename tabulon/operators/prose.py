"""Values out of running text: named patterns with positions, signs, and mentions that speak of something else."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_N = r"(?P<value>[+-]?\d[\d,]*(?:\.\d+)?)"
_MONEY = r"\s*(?P<unit>万亿元|亿元|万元|元)"
_PEOPLE = r"\s*(?P<unit>万人|人)"
_POWER = r"\s*(?P<unit>亿千瓦时|万千瓦时|千瓦时)"
_SHARE = r"\s*(?P<unit>%)"
_THAN = r"(?:比上年|同比)(?P<direction>增长|下降)\s*"
# What a bulletin states, by rule: indicator and pattern.
RULES: tuple[tuple[str, str, str], ...] = (
    ("gdp", "地区生产总值", rf"(?<!人均)地区生产总值\s*{_N}{_MONEY}"),
    ("gdp_growth", "地区生产总值增长率", rf"(?<!人均)地区生产总值\s*\d[\d,.]*\s*(?:万亿元|亿元|万元)[^。；\n]{{0,75}}?{_THAN}{_N}{_SHARE}"),
    ("primary", "第一产业增加值", rf"第一产业增加值\s*{_N}{_MONEY}"),
    ("secondary", "第二产业增加值", rf"第二产业增加值\s*{_N}{_MONEY}"),
    ("tertiary", "第三产业增加值", rf"第三产业增加值\s*{_N}{_MONEY}"),
    ("industry", "工业增加值", rf"(?:全年(?:实现)?|全市(?:实现)?)工业增加值\s*{_N}{_MONEY}"),
    ("population", "年末常住人口", rf"年末(?:全市)?常住人口(?:\[\d+\])?\s*{_N}{_PEOPLE}"),
    ("urban_population", "城镇常住人口", rf"城镇人口\s*{_N}{_PEOPLE}"),
    ("urban_share", "常住人口城镇化率", rf"(?:城镇化率(?:为)?|占常住人口的比重为)\s*{_N}{_SHARE}"),
    ("natural_growth", "人口自然增长率", rf"人口自然增长率\s*{_N}\s*(?P<unit>‰|%)"),
    ("power", "全社会用电量", rf"全社会用电量(?:为|达到)?\s*{_N}{_POWER}"),
    ("home_power", "城乡居民生活用电量", rf"城乡居民生活用电量(?:为|达到)?\s*{_N}{_POWER}"),
    ("energy", "全社会能源消费总量", rf"(?:全市|全社会)能源消费总量(?:为)?\s*{_N}\s*(?P<unit>万吨标准煤|吨标准煤)"),
    ("budget", "地方一般公共预算支出", rf"(?:全市)?一般公共预算支出(?:完成)?\s*{_N}{_MONEY}"),
    ("all_loans", "金融机构本外币贷款余额", rf"金融机构(?:（含外资）|\(含外资\))?本外币各项贷款余额\s*{_N}{_MONEY}"),
    ("yuan_loans", "金融机构人民币贷款余额", rf"人民币各项贷款余额\s*{_N}{_MONEY}"),
    ("investment_growth", "固定资产投资增长率", rf"(?:全年)?固定资产投资(?:（不含农户）|\(不含农户\))?[^。；\n]{{0,20}}?{_THAN}{_N}{_SHARE}"),
)
#: What a text must hold for any rule to match.
ANY = ("地区生产总值", "产业增加值", "工业增加值", "常住人口", "城镇人口", "城镇化率", "人口自然增长率", "用电量", "能源消费总量", "一般公共预算支出", "各项贷款余额", "固定资产投资")
_LITERAL = re.compile(r"[+-]?(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?")
# Subjects other than the city, and what shows that the city is meant after all.
_OTHERS = re.compile("京津冀|长三角|珠三角|全国|全省")
_OWN = re.compile("全市|市(?:实现|完成)")
_YEAR = re.compile("(20[0-9]{2})年")

MENTIONS = "rule string, indicator string, value double, unit string, char_start int, char_end int, quote string, excluded string"


def mentions(text: str, rules: Sequence[tuple[str, str, re.Pattern]], year: int | None = None) -> list[tuple]:
    """Every mention of a rule in a text, in the order of ``MENTIONS``.

    A decline is negative. ``excluded`` says why a mention is not the city's:
    OTHER_SUBJECT if the last 120 characters of its paragraph before it speak
    of another region and the last 35 don't speak of the city; OTHER_YEAR if
    the last year named before it is not ``year``.
    """
    out = []
    for rule, indicator, pattern in rules:
        for m in pattern.finditer(text):
            g = m.groupdict()
            if not _LITERAL.fullmatch(g["value"]):
                continue
            value = float(g["value"].replace(",", ""))
            if g.get("direction") == "下降":
                value = -abs(value)
            before = text[text.rfind("\n", 0, m.start()) + 1 : m.start()]
            years = _YEAR.findall(before)
            why = None
            if year is not None and years and int(years[-1]) != year:
                why = "OTHER_YEAR"
            elif _OTHERS.search(before[-120:]) and not _OWN.search(before[-35:]):
                why = "OTHER_SUBJECT"
            out.append((rule, indicator, value, g["unit"], m.start(), m.end(), m[0], why))
    return sorted(out, key=lambda x: (x[4], x[5], x[0]))


def prose_mentions(docs: DataFrame, key: str, text: str = "text", rules: Sequence[tuple[str, str, str]] = RULES, year: str | None = None) -> DataFrame:
    """(``key`` and the columns of ``MENTIONS``) of every document; null and empty texts have none.

    ``year`` is the column with the year a document is about. Texts are read
    whole; a text without any of the indicators never leaves the JVM.
    """
    some = F.lit(False)
    for word in ANY if rules is RULES else ():
        some = some | F.col("t").contains(word)
    if rules is not RULES:
        some = F.lit(True)
    names = [key, *(c.split()[0] for c in MENTIONS.split(", "))]
    kinds = [pa.string(), pa.string(), pa.float64(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = [(a, b, re.compile(c)) for a, b, c in rules]
        for batch in batches:
            at, rows = [], []
            for i, (t, y) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                for m in mentions(t, ready, y):
                    at.append(i)
                    rows.append(m)
            cols = list(zip(*rows)) if rows else [()] * 8
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *[pa.array(c, k) for c, k in zip(cols, kinds)]], names=names)

    about = F.col(year).cast("int") if year else F.lit(None).cast("int")
    rows = docs.select(F.col(key), F.col(text).alias("t"), about.alias("y")).where(F.col("t").isNotNull() & some)
    return rows.mapInArrow(run, f"{key} {docs.schema[key].dataType.simpleString()}, {MENTIONS}")


def missing_indicators(found: DataFrame, key: str, wanted: Sequence[str]) -> DataFrame:
    """(key, indicator): wanted indicators that no mention of a document with mentions states."""
    docs = found.select(key).distinct().select(key, F.explode(F.array(*map(F.lit, wanted))).alias("indicator"))
    return docs.join(found.where("excluded is null").select(key, "indicator").distinct(), [key, "indicator"], "left_anti")
