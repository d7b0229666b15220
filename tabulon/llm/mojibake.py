"""Text that was decoded with the wrong character encoding.

A multinomial classifier over hashed byte bigrams is trained on all clean
titles and on the same titles garbled by each encoding chain. It labels every
character of a text with the clean class or a chain: the labels of least cost
along the text, where each change of label costs ``SWITCH`` (Viterbi), so a
garbled part is found wherever it stands and however long the text is. The
chain predicted for a part is inverted; it counts only if its inversion decodes
strictly and the text so restored is likelier under the clean class than the
text found. The next chains are tried only if that fails, or if the classifier
holds them for as likely up to ``NEAR``.
"""

from __future__ import annotations

import codecs
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.skew import join_unique
from ..tables import written

DIMS = 1 << 15
#: Bits of the hashed trigrams.
TRIPLES = 19
#: Share of a class's probability that all bigrams have alike, seen or not.
UNSEEN = 1e-3
#: What a change of label costs, how much likelier a restored part must be, and how close chains are that the classifier doesn't tell apart, in nats.
SWITCH, GAIN, NEAR = 3.0, 2.0, 8.0
#: How far the ends of a labelled part are moved, in characters, to make its inversion strict.
SLACK = 2
#: Bytes of text labelled at once, and counted at once.
BLOCK, COUNTED = 1 << 16, 1 << 18
#: Parts whose restoration a model remembers at most, and how long they may be.
MEMO, REMEMBERED = 1 << 14, 64
#: How often the titles are judged before the classifier is fitted on those that are clean.
ROUNDS = 2

_C1 = {}
for _b in range(0x80, 0xA0):
    try:
        _C1[_b] = bytes([_b]).decode("cp1252")
    except UnicodeDecodeError:
        _C1[_b] = chr(_b)
_FROM_1252 = {ord(c): chr(b) for b, c in _C1.items() if ord(c) > 0xFF}
_ALL_1252 = "".join(_C1.get(b, chr(b)) for b in range(256))
_TO_BYTES = codecs.charmap_build(_ALL_1252)


def _decode(data: bytes, name: str, errors: str = "strict") -> str:
    """As browsers do for windows-1252: its unassigned bytes stay controls."""
    return codecs.charmap_decode(data, "strict", _ALL_1252)[0] if name == "cp1252" else data.decode(name, errors)


def _encode(text: str, name: str, errors: str = "strict") -> bytes:
    if name == "cp1252":
        try:
            return codecs.charmap_encode(text, "strict", _TO_BYTES)[0]
        except UnicodeError:  # maybe for a control that stands for itself
            pass
    return text.translate(_FROM_1252).encode("latin-1", errors) if name == "cp1252" else text.encode(name, errors)


# Fixed values: (encoding of the bytes, encoding they were wrongly read in), innermost first.
CHAINS: tuple[tuple[tuple[str, str], ...], ...] = (
    (("utf-8", "gb18030"),),
    (("utf-8", "latin-1"),),
    (("utf-8", "cp1252"),),
    (("gb18030", "latin-1"),),
    (("gb18030", "cp1252"),),
    (("gb18030", "utf-8"),),
    (("gb18030", "koi8-r"),),
    (("gb18030", "big5hkscs"),),
    (("gb18030", "cp950"),),
    (("gb18030", "cp949"),),
    (("gb18030", "shift_jis"),),
    (("gb18030", "cp1251"),),
    (("utf-8", "koi8-r"),),
    (("utf-8", "cp1251"),),
    (("utf-8", "big5hkscs"),),
    (("utf-8", "cp949"),),
    (("utf-8", "shift_jis"),),
    (("big5hkscs", "gb18030"),),
    (("big5hkscs", "latin-1"),),
    (("big5hkscs", "cp1252"),),
    (("utf-8", "cp1252"), ("utf-8", "cp1252")),
    (("utf-8", "latin-1"), ("utf-8", "latin-1")),
    (("utf-8", "gb18030"), ("utf-8", "gb18030")),
    (("gb18030", "cp1252"), ("utf-8", "cp1252")),
    (("gb18030", "latin-1"), ("utf-8", "latin-1")),
    (("gb18030", "latin-1"), ("utf-8", "cp1252")),
)


def chain_name(chain: tuple[tuple[str, str], ...]) -> str:
    return ", ".join(f"{a} as {b}" for a, b in chain)


def garble(text: str, chain: tuple[tuple[str, str], ...]) -> str:
    """The text as a chain of wrong decodings leaves it."""
    for a, b in chain:
        text = _decode(_encode(text, a, "replace"), b, "replace")
    return text


def invert(text: str, chain: tuple[tuple[str, str], ...]) -> str | None:
    """The text before the chain, if every step can be undone strictly."""
    try:
        for a, b in reversed(chain):
            text = _decode(_encode(text, b), a)
    except (UnicodeError, ValueError):
        return None
    return text


def _hashes(data: bytes) -> np.ndarray:
    """Hashed bigrams of the bytes; entry i belongs to byte i + 1."""
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    return ((b[:-1] * np.uint32(256) + b[1:]) * np.uint32(2654435761)) >> np.uint32(17)


def _marked(texts: list[str]) -> bytes:
    """The texts in UTF-8, each between two marks."""
    return b"".join(b"\x01" + t.encode("utf-8", "surrogatepass") + b"\x02" for t in texts)


def _parts(texts: list[str], size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes together."""
    start, n = 0, 0
    for i, t in enumerate(texts):
        n += 3 * len(t) + 2
        if n >= size:
            yield start, i + 1
            start, n = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _lost(text: str) -> bool:
    """Whether bytes are lost for good: the text holds replacement characters."""
    return "\ufffd" in text


class Language:
    """How likely text is as clean text: each byte given the two before it, with the one before it as a fallback.

    Counts of bigrams and hashed trigrams of the clean titles. The wider
    context knows the script, which a classifier that must generalise from
    bigrams does not.
    """

    def __init__(self, pairs: np.ndarray, triples: np.ndarray):
        self.pairs, self.triples = pairs, triples
        self.ones = pairs.reshape(256, 256).sum(axis=1)

    @staticmethod
    def keys(data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(pair, hashed triple) that ends at each byte from the third on."""
        b = np.frombuffer(data, np.uint8).astype(np.uint32)
        pair = b[:-1] * np.uint32(256) + b[1:]
        triple = ((pair[:-1] * np.uint32(256) + b[2:]) * np.uint32(2654435761)) >> np.uint32(32 - TRIPLES)
        return pair, triple

    def __call__(self, texts: list[str]) -> np.ndarray:
        """Log-probability of each text."""
        marked = [_marked([t]) for t in texts]
        starts = np.concatenate([[0], np.cumsum([len(m) for m in marked[:-1]])]).astype(np.int64)
        pair, triple = self.keys(b"".join(marked))
        short = (self.pairs[pair[1:]] + 2 / 256) / (self.ones[pair[1:] >> 8] + 2)
        each = np.zeros(len(pair) + 1)
        each[2:] = np.log((self.triples[triple] + 3 * short) / (self.pairs[pair[:-1]] + 3))
        each[starts] = each[starts + 1] = 0
        return np.add.reduceat(each, starts)


#: Entries of the counts of a half of the titles, and how many of them travel together.
SIZE, CHUNK = (len(CHAINS) + 1) * DIMS + (1 << 16) + (1 << TRIPLES), 1 << 12
_HASHED = _hashes(np.array([[p >> 8, p & 255] for p in range(1 << 16)], np.uint8).tobytes())[::2]


def _views(count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of a half as (hashed bigrams of the clean class and of each chain, pairs, hashed triples); the last two of the clean titles."""
    classes, pairs, triples = np.split(count, [(len(CHAINS) + 1) * DIMS, SIZE - (1 << TRIPLES)])
    return classes.reshape(-1, DIMS), pairs, triples


def _pairs(data: bytes) -> np.ndarray:
    """How often each pair of bytes occurs within marked texts; one that ends in the first mark spans two of them."""
    b = np.frombuffer(data, np.uint8)
    out = np.bincount(b[:-1].astype(np.uint16) * np.uint16(256) + b[1:], minlength=1 << 16)
    out[1::256] = 0
    return out


def _half(title: str) -> int:
    return zlib.crc32(title.encode("utf-8", "surrogatepass")) & 1


def _piece(title: str) -> str:
    """A piece of the title between two places that depend on nothing else."""
    h = zlib.crc32(title.encode("utf-8", "surrogatepass"))
    a, b = sorted(((h >> 1 & 0x7FFF) % (len(title) + 1), (h >> 16) % (len(title) + 1)))
    return title[a:b]


def counts(titles: list[str]) -> np.ndarray:
    """What a model is fitted on, a row for each half of the titles; see ``_views``.

    Every title that is not ASCII is garbled by each chain, whole and a piece
    of it. Counts of parts of the titles add up to those of all, however they
    are parted.
    """
    out = np.zeros((2, SIZE), np.int64)
    halves: list[list[str]] = [[], []]
    for t in titles:
        halves[_half(t)].append(t)
    for row, mine in zip(out, halves):
        classes, pairs, triples = _views(row)

        def count(label: int, seen: np.ndarray) -> None:
            classes[label] += np.bincount(_HASHED, seen, DIMS).astype(np.int64)

        for a, b in _parts(mine, COUNTED):
            data = _marked(mine[a:b])
            seen = _pairs(data)
            count(0, seen)
            pairs += seen
            b1 = np.frombuffer(data, np.uint8) == 1
            triples += np.bincount(Language.keys(data)[1][~(b1[1:-1] | b1[2:])], minlength=len(triples))
            wide = [t for t in mine[a:b] if not t.isascii()]
            # no chain takes a mark for a part of a character; the last text is followed by the mark of another, as all are
            joined = _marked(wide + [p for p in map(_piece, wide) if p]).decode("utf-8", "surrogatepass") + "\x01"
            for i, chain in enumerate(CHAINS) if wide else ():
                count(i + 1, _pairs(garble(joined, chain).encode("utf-8", "surrogatepass")))
    return out


def _clean_counts(count: Callable, suspects: Callable, titles, lost) -> np.ndarray:
    """Counts of the titles without those found garbled, by a model that is fitted anew each time.

    ``count`` gives the counts of a collection of titles, ``suspects`` those
    that are garbled by the counts of the others.
    """
    every, found = count(titles), lost
    for _ in range(ROUNDS):
        found = suspects(every - count(found))
    return every - count(found)


class Jury:
    """Tells garbled titles from clean ones while the classifier is fitted.

    A model holds what it has seen for clean, so each half of the titles is judged by a model of the other half.
    Against a single character that the other half merely lacks, a model of all titles must agree.
    """

    def __init__(self, kept: np.ndarray):
        self.others, self.every = [Classifier.of(kept[1]), Classifier.of(kept[0])], Classifier.of(kept.sum(axis=0))

    def __call__(self, titles: list[str]) -> list[str]:
        """The garbled ones of some distinct titles, and those with lost bytes."""
        found, doubtful = [t for t in titles if _lost(t)], []
        for half, model in enumerate(self.others):
            mine = [t for t in titles if _half(t) == half and not _lost(t)]
            for t, got in zip(mine, model._judged(mine)):
                if got is not None:
                    (found if got[2] > 1 else doubtful).append(t)
        return found + [t for t, got in zip(doubtful, self.every._judged(doubtful)) if got is not None]


@dataclass
class Classifier:
    """Log-probabilities of the hashed bigrams, one row a bigram; column 0 is the clean class, column i+1 ``CHAINS[i]``."""

    weights: np.ndarray
    clean: Language
    memo: dict[tuple, tuple[int, int, str, int] | None] = field(default_factory=dict)

    @classmethod
    def of(cls, count: np.ndarray) -> Classifier:
        """The model that the counts give."""
        classes, pairs, triples = _views(count)
        share = classes / np.maximum(classes.sum(axis=1, keepdims=True), 1)
        return cls(np.ascontiguousarray(np.log((1 - UNSEEN) * share + UNSEEN / DIMS).astype(np.float32).T), Language(pairs.astype(np.float32), triples.astype(np.float32)))

    @classmethod
    def fit(cls, titles: list[str]) -> Classifier:
        """The model of a list of titles: trained three times, each time without the titles found garbled before."""
        titles = list(dict.fromkeys(t for t in titles if t))
        return cls.of(_clean_counts(counts, lambda kept: Jury(kept)(titles), titles, [t for t in titles if _lost(t)]).sum(axis=0))

    def evidence(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(log-probabilities of each class for each character, first character of each text and the end of the last).

        A bigram speaks for the character of its second byte. ASCII, which
        every chain leaves as it is, speaks for no class.
        """
        data = _marked(texts)
        b = np.frombuffer(data, np.uint8)
        first = np.flatnonzero((b & 0xC0) != 0x80)
        lengths = np.array([len(t) + 2 for t in texts])
        w = np.zeros((len(data), self.weights.shape[1]), np.float32)
        np.take(self.weights, _hashes(data), axis=0, out=w[1:], mode="clip")
        sums = np.add.reduceat(w, first, axis=0)
        sums[b[first] < 0x80] = 0
        return sums, np.concatenate([[0], np.cumsum(lengths)])

    def labelled(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """For each text its parts (start, end, chain) that are labelled with a chain, in order."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
        ranked = [texts[i] for i in order]
        for a, b in _parts(ranked):
            for i, parts in zip(order[a:b], self._viterbi(ranked[a:b])):
                out[i] = parts
        return out

    def _viterbi(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """As ``labelled``, all texts side by side, one step for each place of the longest."""
        e, at = self.evidence(texts)
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        # a part with a chain costs two changes at least: where all evidence against the clean class is less, there is none
        against = np.add.reduceat(np.maximum(e[:, 1:].max(axis=1) - e[:, 0], 0), at[:-1])
        open_ = np.flatnonzero(against > 2 * SWITCH - 0.01)
        if not len(open_):
            return out
        n, k = len(open_), e.shape[1]
        lengths, at = np.diff(at)[open_] - 2, at[open_]
        longest = int(lengths.max())
        stayed = np.zeros((longest, n, k), bool)
        top = np.zeros((longest, n), np.int8)
        score = np.full((n, k), -SWITCH, np.float32)
        score[:, 0] = 0
        for t in range(longest):
            live = np.flatnonzero(lengths > t)
            s = score[live]
            best = s.argmax(axis=1)
            change = s[np.arange(len(live)), best] - np.float32(SWITCH)
            stayed[t, live] = s >= change[:, None]
            top[t, live] = best
            score[live] = np.maximum(s, change[:, None]) + e[at[live] + 1 + t]
        score[:, 1:] -= SWITCH  # a text ends as it begins, in the clean class
        for i, parts in enumerate(out[j] for j in open_):
            label, end = int(score[i].argmax()), int(lengths[i])
            if label == 0 and not (top[: lengths[i], i] != 0).any() and stayed[: lengths[i], i, 0].all():
                continue
            for t in range(end - 1, -1, -1):
                before = label if stayed[t, i, label] else int(top[t, i])
                if before != label or t == 0:
                    begin = t
                    if label:
                        parts.append((begin, end, label - 1))
                    end, label = t, before
            parts.reverse()
        return out

    def ranking(self, text: str) -> tuple[list[int], int]:
        """Chains by their likelihood for a part, the likeliest first, and how many of them are as likely up to ``NEAR``."""
        e = self.evidence([text])[0].sum(axis=0)[1:]
        order = np.argsort(-e, kind="stable")
        return order.tolist(), int((e >= e.max() - NEAR).sum())

    def _undone(self, text: str, start: int, end: int, least: int) -> tuple[int, int, str, int] | None:
        """(start, end, restored part, chain) of the part near ``start`` to ``end`` that a chain restores, None if none does.

        The chains come in the order predicted for the part. One restores it if
        its inversion is strict and makes the text likelier; the ends are moved
        by up to ``SLACK`` for that, though not before ``least``. Of the chains
        the classifier doesn't tell apart the one with the likeliest text counts.
        """
        if end <= least:
            return None
        start = max(start, least)
        lo, hi = max(least, start - SLACK), min(len(text), end + SLACK)
        part = text[max(0, lo - 1) : lo], text[lo:hi], text[hi : hi + 1], start - lo, end - lo
        if part in self.memo:
            got = self.memo[part]
        else:
            got = self._restored(*part)
            if hi - lo <= REMEMBERED:  # the same words are garbled in many titles
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                self.memo[part] = got
        return got and (lo + got[0], lo + got[1], *got[2:])

    def _restored(self, left: str, text: str, right: str, start: int, end: int) -> tuple[int, int, str, int] | None:
        """``_undone`` of a part with the characters it may be widened by, between its neighbours."""
        spans = [(a, b) for a in range(min(start + SLACK, end - 1) + 1) for b in range(max(a + 1, end - SLACK), len(text) + 1)]
        core = text[max(a for a, _ in spans) : min(b for _, b in spans)]
        order, near = self.ranking(text[start:end])
        fits: dict[str, bool] = {}
        for chains in (order[:near], order[near:]):
            tried: dict[str, tuple[int, int, str, int]] = {}
            for chain in chains:
                last = CHAINS[chain][-1][1]
                if last not in fits:
                    fits[last] = _fits(core, last)
                for a, b in spans if fits[last] else ():
                    got = invert(text[a:b], CHAINS[chain])
                    if got is not None and got != text[a:b]:
                        tried.setdefault(text[:a] + got + text[b:], (a, b, got, chain))
            if tried:
                scores = self.clean([left + new + right for new in (text, *tried)])
                best = int(scores[1:].argmax())
                if scores[best + 1] > scores[0] + GAIN + np.log(len(tried)):  # the best of many is likelier by chance
                    return list(tried.values())[best]
        return None

    def judge(self, text: str) -> tuple[str, str | None] | None:
        """``judged`` for one text."""
        return self.judged([text])[0]

    def judged(self, texts: list[str], depth: int = 3) -> list[tuple[str, str | None] | None]:
        """For each text (chain, restored text) if it is garbled, else None; the restored text is None where bytes are lost."""
        out = [got and got[:2] for got in self._judged(texts)]
        # what is still garbled had been garbled more often
        again = [i for i, got in enumerate(out) if got is not None and got[1] is not None] if depth > 1 else []
        for i, deeper in zip(again, self.judged([out[i][1] for i in again], depth - 1) if again else []):
            if deeper is not None:
                out[i] = f"{deeper[0]}, {out[i][0]}", deeper[1]
        return out

    def _judged(self, texts: list[str]) -> list[tuple[str, str | None, int] | None]:
        """(chain, text with one chain undone, length of the longest garbled part) of each garbled text."""
        out: list[tuple[str, str | None, int] | None] = []
        for text, parts in zip(texts, self.labelled(texts)):
            names, pieces, upto, lost, widest = [], [], 0, False, 0
            for group in _groups(text, parts):
                # parts that only ASCII separates may be one, labelled with chains that are alike
                got = self._undone(text, group[0][0], group[-1][1], upto) if len(group) > 1 else None
                for start, end, predicted in group if got is None else [(group[0][0], group[-1][1], group[0][2])]:
                    if _lost(text[start:end]):  # a wrong decoding left its mark, but nothing that could be inverted
                        names.append(chain_name(CHAINS[predicted]))
                        lost = True
                        continue
                    undone = got or self._undone(text, start, end, upto)
                    if undone is not None:
                        a, b, restored, chain = undone
                        pieces += [text[upto:a], restored]
                        upto, widest = b, max(widest, b - a)
                        names.append(chain_name(CHAINS[chain]))
            out.append(("; ".join(dict.fromkeys(names)), None if lost else "".join(pieces) + text[upto:], widest) if names else None)
        return out


def _fits(text: str, encoding: str) -> bool:
    try:
        _encode(text, encoding)
    except UnicodeError:
        return False
    return True


def _groups(text: str, parts: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """Neighbouring parts that at most ASCII separates."""
    group: list[tuple[int, int, int]] = []
    for part in parts:
        if group and not text[group[-1][1] : part[0]].isascii():
            yield group
            group = []
        group.append(part)
    if group:
        yield group


def _total(titles: DataFrame) -> np.ndarray:
    """``counts`` of a table of distinct titles: those of each task are added up in blocks, of which the driver gets at most ``2 * SIZE / CHUNK``."""
    schema = "block int, data binary"

    def blocks(found: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        data = [zlib.compress(x.tobytes(), 1) for x in found.values()]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(data, pa.binary())], names=["block", "data"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, SIZE), np.int64)
        for b in batches:
            total += counts(b.column(0).to_pylist())
        yield from blocks({i: x for i, x in enumerate(total.reshape(-1, CHUNK)) if x.any()})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for i, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                total[i] = total.get(i, 0) + np.frombuffer(zlib.decompress(data), np.int64)
        yield from blocks(total)

    out = np.zeros((2, SIZE), np.int64)
    for r in titles.mapInArrow(count, schema).repartition("block").mapInArrow(add, schema).collect():
        out.reshape(-1, CHUNK)[r.block] = np.frombuffer(zlib.decompress(r.data), np.int64)
    return out


def _wide() -> Column:
    return ~F.col("text").rlike(r"\A[\x00-\x7f]*\z")


def fitted(titles: DataFrame) -> Classifier:
    """``Classifier.fit`` of all titles of a table of distinct ``text``, neither null nor empty.

    Counting and judging are spread over the tasks; the driver holds counts,
    whose size does not depend on the data.
    """
    wide = titles.where(_wide())  # ASCII titles are never garbled

    def suspects(kept: np.ndarray) -> DataFrame:
        sent = titles.sparkSession.sparkContext.broadcast(kept)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            jury = Jury(sent.value)
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array(jury(b.column(0).to_pylist()), pa.string())], names=["text"])

        return written(wide.mapInArrow(run, "text string"), "suspects")

    return Classifier.of(_clean_counts(_total, suspects, titles, titles.where(F.col("text").contains("\ufffd"))).sum(axis=0))


def garbled(df: DataFrame, text: str) -> DataFrame:
    """``text, chain, restored`` for every distinct text that is wholly or partly the result of a wrong decoding.

    ``chain`` is the chain that was inverted (several for a text with several
    garbled parts); ``restored`` the original, or null where bytes are lost
    (the text holds replacement characters). The classifier is fitted on all
    distinct texts; every text is judged, whole and in time linear in its
    length. Null, empty and ASCII texts are never garbled.
    """
    distinct = written(df.select(F.col(text).alias("text")).where("text is not null and text <> ''").distinct(), "titles")
    # counting and judging are the costly parts: spread over all tasks however few bytes the texts have
    titles = distinct.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    model = fitted(titles)
    sent = df.sparkSession.sparkContext.broadcast((model.weights, model.clean.pairs, model.clean.triples))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, *counted = sent.value
        model = Classifier(weights, Language(*counted))
        for b in batches:
            texts = b.column(0).to_pylist()
            found = [(t, *got) for t, got in zip(texts, model.judged(texts)) if got is not None]
            cols = list(zip(*found)) if found else [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], names=["text", "chain", "restored"])

    return titles.where(_wide()).mapInArrow(run, "text string, chain string, restored string")


def garbled_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, text, chain, restored`` of every row whose text is garbled; repeated rows stay repeated.

    A title that holds over 2 % of the rows meets a broadcast of the at most
    50 such titles; the others are joined by shuffle.
    """
    found = written(garbled(df, text), "garbled")
    rows = df.select(key, F.col(text).alias("text"))
    return join_unique(rows, found, "text").where("chain is not null").select(key, "text", "chain", "restored")
