"""Free-typed values mapped to the closest entry of a reference list.

Distinct values are normalised into a core (consistent form, without footnote
marks, province names and endings). An inverted index over character n-grams
finds candidate entries, weighted cosine scores them, and the best one is
accepted above a threshold and a margin to the next entry. An exact check of
the edit follows: a value differs from the entry it means by at most one typing
error, and a Chinese character typed instead of another is none that the
reference list uses itself. (A low threshold only saves checks; it is the check
that decides between a typing error and another name.)

The reference list is the catalogue with its aliases, and the spellings that
rows with a known id use; so the romanisation of a name is known where any row
shows it.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import written
from .forms import Rewriter

THRESHOLD, MARGIN = 0.1, 0.02
# Endings of the kinds of places a list like this holds, longest first; and of kinds it doesn't.
_ENDINGS = ("自治州", "地区", "市辖区", "市区", "全市", "盟", "市", "州", "府", "城")
_OTHER = ("自治县", "自治旗", "省", "区", "县", "旗", "镇", "乡", "村", "街道")
_ROMAN_ENDINGS = ("shi", "city", "prefecture", "municipality", "zizhizhou", "diqu", "meng", "zhou")
# Offices and totals named after a place.
_TAILS = re.compile("(?:人民政府|统计局|调查队|统计公报|统计年鉴|本级|合计|总计|小计|全境|境内)+$")
# What stands before or after a name without changing it.
_MARKS = re.compile(r"[①-⑳⑴-⒇㈠-㈩❶-❿*†‡#]+|\[\d+\]|[（(][^（）()]*[）)]|^(?:其中|注|备注)[：:]|^\d{4}年(?:度)?")


def _roman(text: str) -> str:
    """Latin letters without accents, in lower case; ü is v."""
    t = unicodedata.normalize("NFD", text.lower())
    t = re.sub("ü|ü|u([̀́̄̌])̈", r"v\1", t)
    t = re.sub("u[̀́̄̌]?̈", "v", t)
    return re.sub("[^a-z]", "", "".join(c for c in t if not unicodedata.combining(c)))


class Normaliser:
    """Cores of values: (kind, core, ending); kind is 'han' or 'roman'. A value has no core, one, or several readings."""

    def __init__(self, provinces: list[str], same: dict[str, str]):
        self.form = Rewriter().form
        short = {re.sub("(?:省|自治区|特别行政区)$", "", p) for p in provinces if p}
        names = sorted({p for p in provinces if p} | short, key=len, reverse=True)
        self.province = re.compile("^(?:中国)?(?:" + "|".join(map(re.escape, names)) + ")(?:省|自治区)?") if names else None
        self.same = {ord(c): r for c, r in same.items()}

    def cores(self, value: str) -> list[tuple[str, str, str]]:
        t = self.form(value)
        while (u := _MARKS.sub("", t.strip())) != t:
            t = u
        if re.search("[A-Za-z]", t) and not re.search("[一-鿿]", t):
            whole = _roman(t)
            cut = [whole[: -len(e)] for e in _ROMAN_ENDINGS if whole.endswith(e) and len(whole) - len(e) >= 3]
            return [("roman", x, "") for x in dict.fromkeys([whole, *cut]) if x]
        t = re.sub("[^㐀-鿿]", "", t).translate(self.same)
        if self.province and (m := self.province.match(t)):
            if m.end() == len(t):
                return []
            if len(t) - m.end() >= 2:
                t = t[m.end() :]
        if (u := _TAILS.sub("", t)) and len(u) >= 2:
            t = u
        for e in _ENDINGS:
            if t.endswith(e) and len(t) - len(e) >= 2:
                return [("han", t[: -len(e)], e)]
        for e in _OTHER:
            if t.endswith(e) and len(t) > len(e):
                return [("han", t[: -len(e)], e)]
        return [("han", t, "")] if t else []


def grams(kind: str, core: str) -> list[str]:
    """Character n-grams of a core: single ones, pairs and pairs with a gap for Chinese; pairs and triples for Latin."""
    if kind == "han":
        out = [f"1{c}" for c in core]
        out += [f"2{core[i : i + 2]}" for i in range(len(core) - 1)]
        out += [f"g{core[i]}{core[i + 2]}" for i in range(len(core) - 2)]
        out += [f"^{core[:1]}", f"${core[-1:]}"]
        # pairs in any order, so that a swap keeps some
        out += ["u" + "".join(sorted((core[i], core[j]))) for i in range(len(core)) for j in range(i + 1, min(i + 3, len(core)))]
    else:
        t = f"^{core}$"
        out = [f"2{t[i : i + 2]}" for i in range(len(t) - 1)] + [f"3{t[i : i + 3]}" for i in range(len(t) - 2)]
        # letters in any order, so that a swap keeps some
        out += [f"s{''.join(sorted(t[i : i + 3]))}" for i in range(len(t) - 2)]
    return sorted(set(out))


def one_edit(a: str, b: str) -> tuple[str, str] | None:
    """('same' | 'swap' | 'add' | 'drop' | 'other', the character typed) if ``a`` is ``b`` with at most one typing error, else None."""
    if a == b:
        return "same", ""
    n, m = len(a), len(b)
    if abs(n - m) > 1:
        return None
    i = 0
    while i < min(n, m) and a[i] == b[i]:
        i += 1
    if n == m:
        if a[i + 1 :] == b[i + 1 :]:
            return "other", a[i]
        if a[i : i + 2] == b[i + 1 : i + 2] + b[i : i + 1] and a[i + 2 :] == b[i + 2 :]:
            return "swap", ""
        return None
    if n > m:
        return ("add", a[i]) if a[i + 1 :] == b[i:] else None
    return ("drop", "") if a[i:] == b[i + 1 :] else None


def accept(kind: str, core: str, ending: str, entry: str, used: frozenset[str]) -> bool:
    """Whether the edit between a value's core and an entry is one typing error of a kind that keeps the name."""
    edit = one_edit(core, entry)
    if edit is None:
        # traditional or mistaken characters throughout, none of them the list's own
        odd = [x for x, y in zip(core, entry) if x != y]
        return kind == "han" and len(core) == len(entry) >= 3 and len(odd) < len(core) and ending in _ENDINGS and used.isdisjoint(odd)
    if edit[0] == "same":
        return ending not in _OTHER
    if ending in _OTHER:
        return False
    if kind == "roman":
        return len(entry) >= 4
    how, typed = edit
    if how == "other":
        return typed not in used  # else it is another name made of the list's own characters
    if how == "add":
        return typed in entry or typed not in used
    return how == "swap" or len(core) >= 2


def _in(c: str, encoding: str) -> bool:
    try:
        c.encode(encoding)
    except UnicodeEncodeError:
        return False
    return True


def traditional(cores: DataFrame) -> dict[str, str]:
    """Traditional character -> the simplified one it stands for, as the spellings (entry, core) of a list show it.

    A character outside GB 2312 that Big5 has stands for the character of GB
    2312 that most spellings of the entry have at its place; over several
    entries the one seen in most of them counts. So no typing error among
    ordinary characters makes two of them one, and nothing is united
    transitively. Characters are counted by place: no two spellings are
    compared, however many an entry has.
    """
    each = cores.select("entry", F.length("core").alias("n"), F.posexplode(F.split("core", "")).alias("at", "c")).where("c <> ''")
    seen = each.groupBy("entry", "n", "at", "c").agg(F.count("*").alias("k"))
    kinds = [(r.c, _in(r.c, "gb2312")) for r in seen.select("c").distinct().collect()]  # at most the characters there are
    if not any(simple for _, simple in kinds):
        return {}
    kinds = cores.sparkSession.createDataFrame([(c, simple) for c, simple in kinds if simple or _in(c, "big5")], "c string, simple boolean")
    seen = seen.join(F.broadcast(kinds), "c")
    place = ["entry", "n", "at"]
    usual = seen.where("simple").groupBy(*place).agg(F.max(F.struct("k", "c"))["c"].alias("usual"))
    pairs = seen.where("not simple").join(usual, place).groupBy("c", "usual").agg(F.count_distinct("entry").alias("entries"), F.sum("k").alias("k"))
    best = pairs.groupBy("c").agg(F.max(F.struct("entries", "k", "usual"))["usual"].alias("usual"))
    return {r.c: r.usual for r in best.collect()}


def canonical_values(
    df: DataFrame, value: str, reference: DataFrame, provinces: list[str], threshold: float = THRESHOLD, margin: float = MARGIN
) -> DataFrame:
    """``value, entry, score`` for every distinct non-null value of ``df``; ``entry`` is 'none' where the list doesn't hold it.

    ``reference``: (entry, spelling); an entry may have many spellings, null
    and empty ones are ignored. A spelling that several entries share decides
    nothing. Empty values mean no entry. Values of any length are normalised
    whole. An empty reference maps every value to 'none'.
    """

    def reader(same: dict[str, str], first: bool):
        def cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n = Normaliser(provinces, same)
            for b in batches:
                at, got = [], []
                for i, v in enumerate(b.column(1).to_pylist()):
                    for x in n.cores(v)[: 1 if first else None]:
                        at.append(i)
                        got.append(x)
                yield pa.RecordBatch.from_arrays(
                    [*b.take(pa.array(at, pa.int64())).columns, *[pa.array([x[i] for x in got], pa.string()) for i in range(3)], pa.array([grams(k, c) for k, c, _ in got], pa.list_(pa.string()))],
                    names=["entry", "spelling", "kind", "core", "ending", "grams"],
                )

        return cores

    schema = "entry string, spelling string, kind string, core string, ending string, grams array<string>"
    given = reference.where("spelling is not null and spelling <> ''").select("entry", "spelling").distinct()
    given = written(given, "reference")
    plain = given.mapInArrow(reader({}, True), schema).where("kind = 'han' and ending not in ('" + "','".join(_OTHER) + "')").select("entry", "core").distinct()
    same = traditional(plain)
    listed = given.mapInArrow(reader(same, True), schema)
    index = listed.groupBy("kind", "core").agg(F.min("entry").alias("entry"), F.max("entry").alias("top"), F.first("grams").alias("grams")).where("entry = top").drop("top")
    index = written(index, "index")
    every = df.select(F.col(value).alias("spelling")).where("spelling is not null").distinct()
    values = written(every.select(F.lit(None).cast("string").alias("entry"), "spelling").mapInArrow(reader(same, False), schema).drop("entry"), "values")
    typed = values.select("kind", "core", "grams").dropDuplicates(["kind", "core"])

    # weight of a gram: how few entries of the list have it
    total = index.count()
    weight = index.select("kind", "core", "entry", F.explode("grams").alias("g"))
    idf = weight.groupBy("kind", "g").agg((F.log(F.lit(1.0 + total) / F.count_distinct("entry")) ** 2).alias("w"))
    postings = weight.join(idf, ["kind", "g"])
    norms = postings.groupBy("kind", "core").agg(F.sqrt(F.sum("w")).alias("norm"))
    postings = postings.join(norms, ["kind", "core"]).select("kind", "g", F.col("core").alias("known"), "entry", "w", "norm")
    # a gram the list doesn't have weighs like the rarest
    rarest = math.log(1.0 + total) ** 2
    asked = typed.select("kind", "core", F.explode("grams").alias("g")).join(idf, ["kind", "g"], "left").withColumn("w", F.coalesce("w", F.lit(rarest)))
    asked_norm = asked.groupBy("kind", "core").agg(F.sqrt(F.sum("w")).alias("own"))
    scored = (
        asked.select("kind", "core", "g")
        .join(postings, ["kind", "g"])
        .groupBy("kind", "core", "known", "entry")
        .agg(F.sum("w").alias("dot"), F.first("norm").alias("norm"))
        .join(asked_norm, ["kind", "core"])
        .withColumn("score", F.col("dot") / (F.col("norm") * F.col("own")))
        .where(F.col("score") >= threshold)
    )
    used = frozenset(r.c for r in index.where("kind = 'han'").select(F.explode(F.split("core", "")).alias("c")).distinct().collect())

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pydict()
            ok = [accept(*x, used) for x in zip(rows["kind"], rows["core"], rows["ending"], rows["known"])]
            yield b.filter(pa.array(ok))

    pairs = values.select("spelling", "kind", "core", "ending").join(scored, ["kind", "core"]).select("spelling", "kind", "core", "ending", "known", "entry", "score")
    fits = pairs.mapInArrow(check, pairs.schema)
    best = fits.groupBy("spelling", "entry").agg(F.max(F.struct("score", (F.col("core") == F.col("known")).alias("same"))).alias("s"))
    best = written(best, "best")
    top = best.groupBy("spelling").agg(F.max(F.struct("s.same", "s.score", "entry")).alias("b"), F.count("*").alias("n"), F.sum(F.col("s.same").cast("int")).alias("exact"), F.sum("s.score").alias("all"))
    second = best.join(top.select("spelling", F.col("b.entry").alias("first")), "spelling").where("entry <> first").groupBy("spelling").agg(F.max("s.score").alias("next"))
    found = top.join(second, "spelling", "left").where(F.col("b.same") | F.col("next").isNull() | (F.col("b.score") - F.col("next") >= margin))
    found = found.select("spelling", F.col("b.entry").alias("entry"), F.col("b.score").alias("score"))
    return every.join(found, "spelling", "left").select(F.col("spelling").alias("value"), F.coalesce("entry", F.lit("none")).alias("entry"), "score")
