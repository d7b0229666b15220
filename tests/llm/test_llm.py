"""The operators of ``llm`` against brute force, round trips and held-out cases, with nulls, empty and long texts, ties, repeats and empty tables."""

import datetime
import itertools
import os
import random
import unicodedata

import numpy as np
import pytest

from tabulon.llm import canonical, forms, leaks, mojibake, representatives, spans, tokenize, winnow

RANKS = tokenize.vocabulary("byte_bpe_50k.tiktoken")


# -- encoding ---------------------------------------------------------------


def test_perfect_hash_is_minimal_and_exact():
    keys = [f"k{i}".encode() for i in range(2000)]
    h = tokenize.PerfectHash(keys)
    assert [h.find(k) for k in keys] == list(range(2000))
    assert sorted(h.values) == list(range(2000))
    assert h.find(b"absent") == -1
    assert tokenize.PerfectHash([b"one"]).find(b"one") == 0


@pytest.mark.skipif(not os.path.exists(RANKS), reason="public vocabularies are not here")
def test_encoding_equals_the_public_encoder(spark):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=tokenize.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(5)
    texts = ["蔚菱鹿市2019年", "a  b\n\n c", "don't I'll we've", "<|endoftext|>", "éé", "\U0001f600" * 5, "9" * 300, "啊" * 3000, " ", "　​"]
    texts += ["".join(rng.choice("ab c1，市年\n'st") for _ in range(rng.randint(1, 60))) for _ in range(200)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(900, None, "x"), (901, "", "x"), (0, texts[0], "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = tokenize.encode_corpus(df, "doc_id").collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r.ids for r in got}
    assert by[900] == [] and by[901] == []
    assert all(by[i] == enc.encode_ordinary(t) for i, t in enumerate(texts))
    assert tokenize.encode_corpus(df.limit(0), "doc_id").count() == 0


@pytest.mark.skipif(not os.path.exists(RANKS), reason="public vocabularies are not here")
def test_memo_is_bounded_and_does_not_change_results():
    a, b = tokenize.ByteBPE.from_ranks(RANKS), tokenize.ByteBPE.from_ranks(RANKS, memo=3)
    for t in ("one two three four five six 123456 789012", "市年" * 30):
        assert a.encode(t) == b.encode(t)
        assert len(b) <= 3


# -- winnowing --------------------------------------------------------------


def test_every_window_keeps_a_kgram():
    rng = random.Random(1)
    for trial in range(60):
        k, w = rng.choice([4, 7, 21]), rng.randint(1, 9)
        texts = ["".join(rng.choice("ab" if trial % 2 else "abcdef") for _ in range(rng.randint(0, 70))) for _ in range(4)]
        h, doc, at = winnow.kept(winnow.points("".join(texts)), np.array([len(t) for t in texts]), k, w)
        for i, t in enumerate(texts):
            mine = set(at[doc == i].tolist())
            assert all(0 <= p <= len(t) - k for p in mine)
            for j in range(len(t) - k - w + 2):
                assert mine & set(range(j, j + w))
            assert {int(x) for x in h[doc == i]} <= {int(x) for x in winnow.kgram_hashes(winnow.points(t), k).view(np.int64)} | {1}


# -- shared spans -----------------------------------------------------------


def brute_pairs(texts, least):
    grams = {i: {t[j : j + least] for j in range(len(t) - least + 1)} for i, t in texts.items() if t}
    return {(a, b) for a, b in itertools.combinations(sorted(grams), 2) if grams[a] & grams[b]}


@pytest.mark.parametrize("seed,shard", [(0, 64), (1, 2), (2, 64), (3, 2)])
def test_shared_spans_equal_brute_force(spark, seed, shard, monkeypatch):
    monkeypatch.setattr(spans, "SHARD", shard)
    rng = random.Random(seed)
    alphabet = "abcdefgh市年" if seed % 2 else "ab"
    make = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    passages = [make(rng.choice([15, 19, 20, 21, 40, 90])) for _ in range(5)]
    texts = {i: make(rng.randint(0, 30)) + rng.choice(passages) + make(rng.randint(0, 30)) for i in range(40)}
    texts |= {100: None, 101: "", 102: texts[0], 103: texts[0], 104: "short", 105: "z" * 70, 106: "z" * 20, 107: "z" * 300}
    df = spark.createDataFrame([(i, t, "extra") for i, t in texts.items()], "doc_id long, text string, h string")
    found = spans.SharedSpans(df, "doc_id", min_chars=20)
    got = [(r.doc_id_a, r.doc_id_b) for r in found.pairs().collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute_pairs(texts, 20)
    rows = {r.doc: r for r in found.shared().collect()}
    covered = {i: r.shared_chars for i, r in rows.items()}
    distinct = {t: min(i for i, x in texts.items() if x == t) for t in texts.values() if t}
    kinds = brute_pairs({i: t for t, i in distinct.items()}, 20)
    for i, t in texts.items():
        if t:
            assert (rows[i].links if i in rows else 0) == sum(distinct[t] in p for p in kinds)
    for i, t in texts.items():
        others = {x[j : j + 20] for k, x in texts.items() if k != i and x for j in range(len(x) - 19)}
        marks = set()
        for j in range(len(t or "") - 19):
            if t[j : j + 20] in others:
                marks |= set(range(j, j + 20))
        assert covered.get(i, 0) == len(marks)


def test_no_documents_share_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    found = spans.SharedSpans(df, "doc_id")
    assert found.pairs().count() == 0 and found.shared().count() == 0


def test_hot_copies_and_hot_boilerplate_stay_whole(spark):
    rng = random.Random(9)
    make = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    copy, boiler = make(60), make(18)
    rows = [(i, copy) for i in range(30)] + [(100 + i, make(30) + boiler + make(30)) for i in range(80)]
    got = {(r.doc_id_a, r.doc_id_b) for r in spans.SharedSpans(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", min_chars=20).pairs().collect()}
    assert got == brute_pairs(dict(rows), 20)


def test_links_of_a_hot_passage_are_counted_without_pairs(spark):
    rng = random.Random(12)
    make = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    hot, warm, cold = make(60), make(45), make(30)
    texts = {i: make(25) + hot + make(25) for i in range(90)} | {100 + i: make(25) + warm + make(9) + (hot if i < 3 else "") for i in range(80)} | {300 + i: make(20) + cold + make(5) + (warm if i == 0 else hot if i == 1 else "") for i in range(5)}
    found = spans.SharedSpans(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), "doc_id", min_chars=20)
    want = brute_pairs(texts, 20)
    got = {r.doc: r.links for r in found.shared().collect()}
    assert all(got.get(i, 0) == sum(i in p for p in want) for i in texts)
    assert found.degrees().count() == len({i for p in want for i in p})


def test_equal_hashes_of_different_anchors_share_nothing():
    a, b = "x" * 5 + "anchor" + "y" * 20, "x" * 5 + "ANCHOR" + "y" * 20
    assert spans.shared_in_shard([(a, 5), (b, 5)], 6, 10) == (set(), {})
    groups, found = spans.shared_in_shard([(a, 5), (a, 5), (b, 5)], 6, 10)
    assert groups == {(0, 1)} and set(found) == {0, 1}


def test_windows_repeated_in_one_text_are_not_shared(spark, monkeypatch):
    rng = random.Random(2)
    make = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    core = "xy" * 9
    texts = {i: make(12) + core + make(12) for i in range(8)} | {50: make(9) + "xy" * 40 + make(9)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    counts = []
    for shard in (64, 2):
        monkeypatch.setattr(spans, "SHARD", shard)
        found = spans.SharedSpans(df, "doc_id", min_chars=20)
        assert {(r.doc_id_a, r.doc_id_b) for r in found.pairs().collect()} == brute_pairs(texts, 20)
        counts.append({r.doc: r.shared_chars for r in found.shared().collect()})
    assert counts[0] == counts[1] and not counts[1].get(50)


# -- leaks ------------------------------------------------------------------


def plain(text):
    return "".join(c for c in unicodedata.normalize("NFKC", text).lower() if unicodedata.category(c) in ("Lu", "Ll", "Lt", "Lm", "Lo", "Nd"))


@pytest.mark.parametrize("bound", [1_000_000, 0])
def test_leaks_equal_brute_force(spark, bound, monkeypatch):
    monkeypatch.setattr(leaks, "FILTER_BOUND", bound)
    rng = random.Random(4)
    make = lambda n: "".join(rng.choice("abcdefg0123市年报") for _ in range(n))
    items = {i: make(rng.randint(30, 120)) for i in range(12)} | {90: None, 91: "", 92: "tiny"}
    items[93] = items[0]

    def noisy(t):
        return "".join(rng.choice([c, c.upper(), c + "，", c + " ", chr(ord(c) + 0xFEE0) if "!" < c < "~" else c]) for c in t)

    docs = {}
    for i in range(60):
        t = items[rng.randrange(12)]
        n = rng.choice([20, 38, 39, 40, 41, 60, 120])
        s = rng.randint(0, max(0, len(t) - n))
        docs[i] = make(rng.randint(0, 60)) + noisy(t[s : s + n]) + make(rng.randint(0, 60))
    docs |= {200: None, 201: "", 202: "x", 203: docs[0] + make(5000)}
    d = spark.createDataFrame([(i, t, 1) for i, t in docs.items()], "doc_id long, text string, item_id int")
    it = spark.createDataFrame(list(items.items()), "item_id long, text string")
    found = leaks.leaked_spans(d, it, "doc_id", "item_id")
    want = set()
    for i, t in docs.items():
        for j, x in items.items():
            if t and x and any(plain(x)[k : k + 40] in plain(t) for k in range(len(plain(x)) - 39)):
                want.add((i, j))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == want
    for r in leaks.leak_report(found, "doc_id", "item_id").collect():
        x, t = plain(items[r.item_id]), plain(docs[r.doc_id])
        marks = set()
        for k in range(len(x) - 39):
            if x[k : k + 40] in t:
                marks |= set(range(k, k + 40))
        assert r.leaked_chars == len(marks)
    assert leaks.leaked_spans(d, it.limit(0), "doc_id", "item_id").count() == 0


# -- consistent forms -------------------------------------------------------


def test_forms_of_named_cases():
    form = forms.Rewriter().form
    cases = {
        "ＧＤＰ１２．５％": "GDP12.5%", "é": "é", "ǚ": "ǚ", "​蔚﻿菱⿅市　": "蔚菱鹿市 ", "Сіty": "City", "год": "год",
        "1О,5l7.I2": "10,517.12", "－3.5": "-3.5", "−7": "-7", "—": "—", "–": "–", "..": "..", "N/A": "N/A", "单位：万元": "单位：万元", "（‰）": "（‰）",
        "①": "①", "１，２３４": "1,234", "甲，乙": "甲，乙", "億": "億", "下降O.5": "下降0.5", "": "", "Item": "Item", "5Items": "5Items", "金": "金", "km²": "km²",
        "12kWh": "12kWh", "a\tb": "a b", "СО": "CO", "Ｍｏ‍ｎ": "Mon",
    }
    for x, y in cases.items():
        assert form(x) == y, (x, form(x))
        assert form(y) == y


def test_classes_are_transitive_and_follow_frequency():
    pairs = [("甲", "乙"), ("乙", "丙")]
    assert forms.representatives(pairs, {"甲": 1, "乙": 5, "丙": 2}) == {"甲": "乙", "丙": "乙"}
    reps = forms.representatives([*forms.alike_everywhere(), *forms.alike_in_words()], {"Ａ": 10**9})
    assert reps["Ａ"] == reps["А"] == reps["Α"] == "A"


def test_consistent_forms_table(spark):
    rows = [(1, "２０１９年"), (2, None), (3, ""), (4, "x" * 50_000 + "​"), (1, "２０１９年")]
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], "row_id long, city string, form string")
    got = forms.consistent_forms(df, ["row_id"], "city").orderBy("row_id").collect()
    assert [(r.row_id, r.changed) for r in got] == [(1, True), (1, True), (2, False), (3, False), (4, True)]
    assert got[0].form == "2019年" and got[2].form is None and got[4].form == "x" * 50_000
    assert forms.consistent_forms(df.limit(0), ["row_id"], "city").count() == 0


def test_the_fast_path_skips_no_rule():
    import re

    fast, rules = forms.Rewriter(), forms.Rewriter()
    rules.odd = re.compile("")
    assert [fast.form(t) for t in ("–12.5", " —3", "—", "2019–2020")] == ["-12.5", " -3", "—", "2019–2020"]
    rng = random.Random(1)
    for _ in range(20_000):
        t = "".join(rng.choice("0123456789.,- –—+/|lOoISZBlabcxyz市年（）：；。、“”‘’①‰…·²³%") for _ in range(rng.randint(1, 6)))
        assert fast.form(t) == rules.form(t)


# -- wrong decodings --------------------------------------------------------

NAMES = ["蔚菱鹿市", "绿岭湄市", "韶珞鹿市", "菀雁蟾市", "荻绿翠自治州", "钧泠梓地区", "青梓暄市", "岑鼓溪市", "鼓里葭市", "鹿梧垣市"]
SHAPES = ["{}统计年鉴{}", "{}{}年国民经济和社会发展统计公报", "数据发布_{}统计局 {}", "Résumé statistique – année {1}", "Статистический обзор: {1} год", "Übersicht der Stadt {1}", "{}{}年统计公报？如何阅读"]


def titles():
    return sorted({s.format(n, y) for s in SHAPES for n in NAMES for y in range(2012, 2026)})


def test_held_out_chains_are_found_and_restored():
    all_ = titles()
    random.Random(0).shuffle(all_)
    model = mojibake.Classifier.fit(all_[::2])
    held = all_[1::2]
    assert not [t for t in held if model.judge(t)]
    rng = random.Random(3)
    tried = right = 0
    for t in held:
        for chain in rng.sample(mojibake.CHAINS, 4):
            bad = mojibake.garble(t, chain)
            if bad == t or bad.isascii():
                continue
            got = model.judge(bad)
            tried += 1
            right += got is not None
            if got and got[1] is not None and "�" not in bad and "?" not in bad and mojibake.invert(bad, chain) == t:
                assert got[1] == t
    assert right / tried > 0.98


def test_partly_garbled_titles_are_found():
    model = mojibake.Classifier.fit(titles())
    t = "蔚菱鹿市2019年国民经济和社会发展统计公报"
    for chain in mojibake.CHAINS[:5]:
        assert model.judge(t[:9] + mojibake.garble(t[9:], chain))
        assert model.judge(mojibake.garble(t[:9], chain) + t[9:])


def test_short_garbled_parts_of_titles_that_look_clean_are_found():
    model = mojibake.Classifier.fit(titles())
    for name in NAMES:
        t = f"{name}2019年国民经济和社会发展统计公报、{name}统计年鉴2018、数据发布_{name}统计局 2020"
        assert model.judge(t) is None
        for chain in (mojibake.CHAINS[0], mojibake.CHAINS[6], mojibake.CHAINS[7], mojibake.CHAINS[9]):
            bad = mojibake.garble(name, chain) + t[len(name) :]
            if "\ufffd" in bad or "?" in bad:
                continue
            assert model.judge(bad)[1] == t


def planted(clean, rng, n, kind, width):
    """(garbled, clean) texts with one part garbled by a chain that can be undone."""
    out = []
    while len(out) < n:
        t, chain = rng.choice(clean), rng.choice(mojibake.CHAINS)
        w = rng.randint(2, min(width, len(t) - 2))
        a = {"tail": len(t) - w, "front": 0, "middle": rng.randint(1, len(t) - w - 1)}[kind]
        part = t[a : a + w]
        bad = mojibake.garble(part, chain)
        if not part.isascii() and bad != part and "\ufffd" not in bad and mojibake.invert(bad, chain) == part:
            out.append((t[:a] + bad + t[a + w :], t))
    return out


def test_recall_of_held_out_parts_wherever_they_stand():
    all_ = titles()
    random.Random(4).shuffle(all_)
    model, held = mojibake.Classifier.fit(all_[::2]), [t for t in all_[1::2] if not t.isascii()]
    rng = random.Random(5)
    long = ["，".join(rng.sample(held, 20)) for _ in range(60)]
    assert not [t for t in long if model.judge(t)]
    for texts, width in ((held, 12), (long, 30)):
        for kind in ("tail", "front", "middle"):
            cases = planted(texts, rng, 150, kind, width)
            got = model.judged([bad for bad, _ in cases])
            assert sum(g is not None for g in got) >= 0.9 * len(cases), kind
            assert sum(g is not None and g[1] == t for g, (_, t) in zip(got, cases)) >= 0.9 * len(cases), kind


def test_labels_side_by_side_equal_those_of_each_text_alone():
    model = mojibake.Classifier.fit(titles())
    texts = ["", "a", "蔚", *titles()[:40], mojibake.garble("蔚菱鹿市2019年", mojibake.CHAINS[0]), "Statistical CommuniquÃ© of X", "�" * 3]
    assert model.labelled(texts) == [model.labelled([t])[0] for t in texts]
    assert model.judge("蔚菱�市统计年鉴2019")[1] is None
    assert mojibake.Classifier.fit([]).judge("蔚菱鹿市") is None


def test_long_titles_take_linear_time():
    import time

    model = mojibake.Classifier.fit(titles())
    clean = "。".join(titles()) * 5
    start = time.time()
    for chain in mojibake.CHAINS[:1] + mojibake.CHAINS[6:7]:
        half = len(clean) // 2
        assert model.judge(clean[:half] + mojibake.garble(clean[half:], chain))
    assert model.judge(clean) is None
    assert len(clean) > 50_000 and time.time() - start < 60


def test_garbled_titles_in_the_sample_are_not_taken_for_clean():
    twice = mojibake.garble("Jixuncui’s – 蔚菱", mojibake.CHAINS[20])
    model = mojibake.Classifier.fit(titles() + [twice] * 50 + ["Statistical CommuniquÃ© of X"] * 50 + ["Statistical Communiqué « a »"])
    assert model.judge("Statistical CommuniquÃ© of X")[1] == "Statistical Communiqué of X"
    assert model.judge(twice)[1] == "Jixuncui’s – 蔚菱"
    assert model.judge("Statistical Communiqué « a »") is None


def test_garbled_rows(spark):
    bad = mojibake.garble("蔚菱鹿市统计年鉴2019", mojibake.CHAINS[1])
    rows = [(i, t) for i, t in enumerate(titles())] + [(9000, None), (9001, ""), (9002, bad), (9003, bad), (9004, "Plain 2019")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "capture_id long, document_title string, text int")
    got = mojibake.garbled_rows(df, "capture_id", "document_title").collect()
    assert {r.capture_id for r in got} == {9002, 9003}
    assert {r.restored for r in got} == {"蔚菱鹿市统计年鉴2019"}
    assert mojibake.garbled_rows(df.limit(0), "capture_id", "document_title").count() == 0


def test_scripts_of_few_titles_in_a_large_table_are_learnt(spark):
    from pyspark.sql import functions as F

    fill = [f"{n}{y}年第{i}号统计公报" for n in NAMES for y in range(2012, 2024) for i in range(200)]
    greek = [f"Στατιστική επετηρίδα της περιφέρειας {i}" for i in range(200)]
    hashed = spark.createDataFrame([(t,) for t in fill + greek], "t string").select("t", F.xxhash64("t").alias("h")).orderBy("h").collect()
    rare = [r.t for r in hashed[12_000:] if r.t in set(greek)]  # not among the least hashes
    bad = {mojibake.garble(f"Επετηρίδα της περιφέρειας {i}", chain): f"Επετηρίδα της περιφέρειας {i}" for i, chain in enumerate([mojibake.CHAINS[1], mojibake.CHAINS[13]] * 3)}
    assert len(fill) == 24_000 and len(rare) > 50
    df = spark.createDataFrame([(t,) for t in [*fill, *rare, *bad]], "document_title string")
    assert {r.text: r.restored for r in mojibake.garbled(df, "document_title").collect()} == bad


def test_the_model_of_a_table_is_that_of_all_its_titles(spark):
    all_ = titles() + [mojibake.garble(t, chain) for t, chain in zip(titles()[::9], mojibake.CHAINS)] + ["蔚菱\ufffd市统计年鉴2019", "Plain 2019"]
    rng = random.Random(6)
    parts = [[], [], [], []]
    for t in all_:
        rng.choice(parts).append(t)
    assert (sum(map(mojibake.counts, parts)) == mojibake.counts(all_)).all()
    ends = [f"{n[:k]}{y}" for n in NAMES[:4] for k in (1, 2, 3) for y in (2, 20, 201)]
    assert (sum(mojibake.counts([t]) for t in ends) == mojibake.counts(ends)).all()
    got, want = mojibake.fitted(spark.createDataFrame([(t,) for t in set(all_)], "text string").repartition(5)), mojibake.Classifier.fit(all_)
    assert (got.weights == want.weights).all() and (got.clean.pairs == want.clean.pairs).all() and (got.clean.triples == want.clean.triples).all()


# -- reference lists --------------------------------------------------------


def test_values_find_their_entries(spark):
    ref = [("1", n) for n in ("蔚菱鹿市", "Weilinglu")] + [("2", "荻绿翠自治州"), ("2", "荻綠翠自治州"), ("3", "琅飒市"), ("3", "Lángsà"), ("4", "砚白市"), ("5", "垣峦石市"), ("5", "Yuanluanshi"), ("6", None), ("7", "")]
    means = {
        "蔚菱鹿市": "1", "蔚菱鹿①": "1", "岚北省蔚菱鹿市": "1", "蔚 菱 鹿 市": "1", "菱蔚鹿市": "1", "畏菱鹿市": "1", "菱鹿市": "1", "蔚菱菱鹿市": "1", "weilinglushi": "1",
        "WEILNGLU": "1", "Weilinglu City": "1", "荻綠翠自治州": "2", "2023年荻绿翠": "2", "其中：琅飒市": "3", "琅萨市": "3", "langas": "3", "Yuan Luan Shi": "5", "蔚菱鹿市统计局": "1",
        "白砚石市": "none", "蔚菱鹿区": "none", "岚北省": "none", "砚陵省": "none", "琅飒省": "none", "合计": "none", "": "none", "飒白市": "none", "unknown": "none", "蔚" * 4000: "none",
    }
    rows = [(v, 1) for v in means] * 2 + [(None, 1)]
    got = canonical.canonical_values(spark.createDataFrame(rows, "city string, entry int"), "city", spark.createDataFrame(ref, "entry string, spelling string"), ["岚北省", "砚陵省"]).collect()
    assert len(got) == len(means)
    assert {r.value: r.entry for r in got} == means


def test_typing_errors_make_no_characters_one(spark):
    ref = [("1", "琅飒市"), ("2", "萨白市"), ("3", "飒白市"), ("1", "琅萨市"), ("1", "琅萨市"), ("4", "钧泠梓地区"), ("4", "鈞泠梓地区"), ("5", "钧麓市"), ("5", "鈞麓市"), ("4", "鈞冷梓地区")]
    means = {"萨白市": "2", "飒白市": "3", "琅飒市": "1", "琅萨市": "1", "鈞泠梓": "4", "鈞麓": "5"}
    df = spark.createDataFrame([(v,) for v in means], "city string")
    got = canonical.canonical_values(df, "city", spark.createDataFrame(ref, "entry string, spelling string"), []).collect()
    assert {r.value: r.entry for r in got} == means
    cores = spark.createDataFrame([("1", "琅飒"), ("1", "琅萨"), ("4", "钧泠梓"), ("4", "鈞泠梓")], "entry string, core string")
    assert canonical.traditional(cores) == {"鈞": "钧"} and canonical.traditional(cores.limit(0)) == {}


def test_reference_may_be_empty(spark):
    none = spark.createDataFrame([], "entry string, spelling string")
    df = spark.createDataFrame([("蔚菱鹿市",)], "city string")
    assert [r.entry for r in canonical.canonical_values(df, "city", none, []).collect()] == ["none"]
    assert canonical.canonical_values(df.limit(0), "city", none, []).count() == 0


# -- representatives --------------------------------------------------------

SCHEMA = "row_id long, batch_id long, research_id string, year int, indicator string, geographic_scope string, value double, source_class string, edition int, city string, unit string, value_text string, capture_manifest string, extracted_at timestamp, withdrawn_at timestamp, rank int"


def random_records(n, seed):
    rng = random.Random(seed)
    t = datetime.datetime(2024, 1, 1)
    some = lambda *x: rng.choice([*x, None])
    return [
        (i, rng.randint(1, 3), some("a", "b", "b"), rng.choice([2019, None]), "x", "全市", some(1.0, 2.0, 3.0), some("yearbook", "communique", "government_document"), some(2020, 2021), some("c"), some("u"), some("v"), some("m"), some(t, t + datetime.timedelta(days=1)), rng.choice([None, None, None, t]), 7)
        for i in range(n)
    ]


def test_survivors_equal_a_plain_sort(spark):
    rows = random_records(400, 2)
    df = spark.createDataFrame(rows, SCHEMA)
    groups = {}
    for r in rows:
        if r[2] is not None and r[14] is None:
            groups.setdefault(r[1:6], []).append(r)
    rank = {"yearbook": 0, "communique": 1, "government_document": 2, None: 3}
    want = set()
    for g in groups.values():
        have = [r for r in g if r[6] is not None]
        if len(g) > 1 and have:
            have.sort(key=lambda r: (rank[r[7]], -(r[8] or -1), sum(x is None for x in r[9:13]), -(r[13].timestamp() if r[13] else -1), r[0]))
            want.add(have[0][0])
    found = representatives.Representatives(df)
    assert {r.row_id for r in found.survivors().collect()} == want
    trusted = found.trusted().collect()
    assert {r.row_id for r in trusted} == want and all(0 <= r.posterior <= 1 for r in trusted)
    values = found.values().collect()
    assert len({tuple(r)[:6] for r in values}) == len(values)
    empty = representatives.Representatives(df.limit(0))
    assert empty.survivors().count() == 0 and empty.values().count() == 0


def test_quality_model_recovers_planted_sources():
    rng = np.random.default_rng(0)
    sens, spec = [0.95, 0.8, 0.5, 0.3], [0.98, 0.95, 0.7, 0.6]
    counts = {}
    for _ in range(20_000):
        true = rng.random() < 0.4
        says = sum(1 << s for s in range(4) if rng.random() < (sens[s] if true else 1 - spec[s]))
        if says:
            counts[says, 15 & ~says] = counts.get((says, 15 & ~says), 0) + 1
    q = representatives.fit_quality([(a, b, n) for (a, b), n in counts.items()])
    assert q.posterior[15, 0] > 0.95 and q.posterior[8, 7] < 0.2
    assert q.sensitivity[0] > q.sensitivity[3]
    assert representatives.fit_quality([]).posterior == {}
