"""One consistent form for text that looks the same.

Strings and code points that look alike are joined into classes by
union-find, so a full-width Cyrillic letter and a plain Latin one meet through
what both resemble. Of each class one member represents it: among the members
that the consistent form admits, the most frequent in the corpus. A
multi-pattern automaton rewrites all other members, longest match first.

Letters of other scripts are rewritten only in words that otherwise read as
Latin, and letters become digits only inside numbers.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import LOOKALIKE_DIGITS, LOOKALIKE_LETTERS

# Invisible characters that are not of category Cf.
_BLANK = "͏ᅟᅠ឴឵ㅤﾠ" + "".join(map(chr, [*range(0x180B, 0x1810), *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)]))
# Percent signs, minus signs and plus signs besides ASCII's.
_PERCENT, _MINUS, _PLUS = "％﹪٪", "－﹣−‐‑‒⁃➖", "＋﹢➕"


class Classes:
    """Union-find over strings."""

    def __init__(self):
        self.up: dict[str, str] = {}

    def find(self, x: str) -> str:
        up = self.up
        root = x
        while up.setdefault(root, root) != root:
            root = up[root]
        while up[x] != root:
            up[x], x = root, up[x]
        return root

    def join(self, x: str, y: str) -> None:
        a, b = self.find(x), self.find(y)
        if a != b:
            self.up[a] = b

    def groups(self) -> list[list[str]]:
        """The classes of more than one member, each sorted."""
        out: dict[str, list[str]] = {}
        for x in self.up:
            out.setdefault(self.find(x), []).append(x)
        return [sorted(g) for g in out.values() if len(g) > 1]


def _latin(c: str) -> bool:
    return "LATIN" in unicodedata.name(c, "")


def alike_everywhere() -> Iterable[tuple[str, str]]:
    """Pairs that look alike in any context."""
    for o in range(0x80, 0x110000):
        c = chr(o)
        kind = unicodedata.category(c)
        if kind in ("Cn", "Co", "Cs"):
            continue
        if kind == "Zs":
            yield c, " "
        elif kind in ("Zl", "Zp") or c == "\x85":
            yield c, " "
        elif kind in ("Cf", "Cc") or c in _BLANK:
            yield c, ""
        elif kind == "Nd":
            yield c, str(unicodedata.digit(c))
        elif kind[0] == "L" or 0x2E80 <= o <= 0x2FDF:
            plain = unicodedata.normalize("NFKC", c)
            if plain != c and (plain.isascii() and plain.isalpha() or len(plain) == 1 and 0x3400 <= ord(plain) <= 0x3FFFF):
                yield c, plain
            # accented Latin letters and their parts, wholly or partly taken apart
            parts = unicodedata.normalize("NFD", c)
            if 1 < len(parts) and _latin(c) and unicodedata.normalize("NFC", parts) == c:
                yield parts, c
                for i in range(2, len(parts)):
                    front = unicodedata.normalize("NFC", parts[:i])
                    if len(front) == 1:
                        yield front + parts[i:], c
    for o in [*range(0x00, 0x20), 0x7F]:
        yield chr(o), " " if chr(o).isspace() else ""
    for c in _PERCENT:
        yield c, "%"


def alike_in_words() -> Iterable[tuple[str, str]]:
    """Pairs that look alike in a Latin word."""
    for latin, others in LOOKALIKE_LETTERS.items():
        for c in others:
            yield c, latin


def alike_in_numbers() -> Iterable[tuple[str, str]]:
    """Pairs that look alike in a number."""
    for digit, others in LOOKALIKE_DIGITS.items():
        for c in others:
            yield c, digit
    for c in _MINUS:
        yield c, "-"
    for c in _PLUS:
        yield c, "+"
    yield from (("，", ","), ("﹐", ","), ("．", "."), ("﹒", "."))


def admitted(x: str) -> bool:
    """Whether a member may represent its class: nothing, ASCII, one composed Latin letter or one ordinary Chinese character."""
    if x == "" or x == " ":
        return True
    if x.isascii():
        return x.isprintable()
    return len(x) == 1 and (unicodedata.normalize("NFKC", x) == x) and (_latin(x) or unicodedata.category(x) == "Lo")


def representatives(pairs: Iterable[tuple[str, str]], counts: dict[str, int], wanted: str | None = None) -> dict[str, str]:
    """Member -> representative, for all members that aren't representatives.

    The representative is an admitted member (of those in ``wanted``, if
    given), then the most frequent, then the shortest, then the least.
    """
    classes = Classes()
    for x, y in pairs:
        classes.join(x, y)
    out = {}
    for group in classes.groups():
        best = min(group, key=lambda x: (not (x in wanted if wanted is not None and x else admitted(x)), -counts.get(x, 0), len(x), x))
        out.update((x, best) for x in group if x != best)
    return out


class Rewriter:
    """Puts texts into the consistent form; one per process, since the automaton is built once."""

    def __init__(self, counts: dict[str, int] | None = None):
        counts = counts or {}
        everywhere = representatives(alike_everywhere(), counts)
        self.words = representatives(alike_in_words(), counts)
        self.numbers = representatives(alike_in_numbers(), counts, "0123456789+-.,")
        self.machine = ahocorasick.Automaton()
        for x, rep in everywhere.items():
            if x:
                self.machine.add_word(x, (len(x), rep))
        self.machine.make_automaton()
        digit = "".join(x for x, r in self.numbers.items() if r.isdigit())
        d = "[" + re.escape(digit) + "]"
        # what may need a change: anything but plain text, a letter beside a digit, or a dash that begins a number
        plain = " -~一-鿿㐀-䶿（）：；。、《》“”‘’？！①-⑳‰–—…·²³"
        self.odd = re.compile(f"[^{plain}]|[0-9.,]{d}|{d}[0-9.,]|\\||^ *[–—][0-9]")
        self.word = re.compile(r"[^\W\d_]+")
        self.alike = set(self.words)
        self.run = re.compile(f"(?<![A-Za-z])(?:[0-9]|{d})(?:[0-9]|{d}|[.,，．﹐﹒](?=[0-9]|{d}))*")
        self.digit = re.compile(d)
        self.sign = re.compile(f"(?:(?<=^)|(?<=[^0-9A-Za-z]))([{re.escape(''.join(x for x, r in self.numbers.items() if r in '+-'))}])(?= ?[0-9]| ?[.][0-9])")
        self.dash = re.compile(r"^( *)[–—](?=[0-9])")
        self.mark = re.compile(r"(?:(?<=[0-9])|(?<=[0-9] ))[，．﹐﹒](?= ?[0-9])")
        self.slash = re.compile(r"(?<=[A-Za-z0-9])／(?=[A-Za-z0-9])")

    def _sweep(self, text: str) -> str:
        """All members outside context, greedily from the left, the longest first; until nothing changes."""
        while True:
            out, at = [], 0
            for end, (size, rep) in self.machine.iter_long(text):
                start = end - size + 1
                out.append(text[at:start])
                out.append(rep)
                at = end + 1
            if not out:
                return text
            text = "".join(out) + text[at:]

    def _word(self, m: re.Match) -> str:
        word = m[0]
        if self.alike.isdisjoint(word):
            return word
        if all(c in self.alike or c.isascii() or _latin(c) or unicodedata.category(c) == "Mn" for c in word):
            return "".join(self.words.get(c, c) for c in word)
        parts = re.split(r"([一-鿿㐀-䶿]+)", word)
        return "".join(self._word(re.match(r"(?s).*", p)) for p in parts) if len(parts) > 1 else word

    def _number(self, m: re.Match) -> str:
        run, text, end = m[0], m.string, m.end()
        if not any("0" <= c <= "9" for c in run):
            return run
        stay = ""
        if end < len(text) and text[end].isascii() and text[end].isalpha():  # the letters begin a word
            body = run.rstrip("".join(c for c in run if self.digit.match(c)))
            run, stay = body, run[len(body) :]
        return "".join(self.numbers.get(c, c) for c in run) + stay

    def form(self, text: str) -> str:
        """The consistent form of a text."""
        if not self.odd.search(text) or text.isdigit() and text.isascii():
            return text
        text = self._sweep(text)
        text = self.run.sub(self._number, text)
        changed = self.word.sub(self._word, text)
        if changed != text:
            text = self._sweep(changed)
        text = self.mark.sub(lambda m: self.numbers[m[0]], text)
        text = self.sign.sub(lambda m: self.numbers[m[1]], text)
        text = self.dash.sub(r"\1-", text)
        return self.slash.sub("/", text)


_HERE: dict[str, Rewriter] = {}


def _own(name: str, sent) -> Rewriter:
    """This process's rewriter for the counts of a run."""
    if name not in _HERE:
        _HERE.clear()
        _HERE[name] = Rewriter(sent.value)
    return _HERE[name]


def _members() -> set[str]:
    """Single code points of any class; the set is fixed, so counts over it are bounded."""
    return {x for pair in (*alike_everywhere(), *alike_in_words(), *alike_in_numbers()) for x in pair if len(x) == 1 and not (x.isascii() and x.isalnum())}


_COUNTED: list[set[str]] = []


def _tally(texts: Iterable[str | None]) -> Counter:
    if not _COUNTED:
        _COUNTED.append(_members())
    members, total = _COUNTED[0], Counter()
    for t in texts:
        if t and not t.isascii():
            total.update(members.intersection(t))
    return total


def frequencies(df: DataFrame, text: str) -> dict[str, int]:
    """In how many texts each member of a class occurs, over all rows. At most as many entries as there are members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            total.update(_tally(b.column(0).to_pylist()))
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["c", "n"])

    return {r.c: r.n for r in df.select(text).mapInArrow(run, "c string, n long").groupBy("c").agg(F.sum("n").alias("n")).collect()}


def consistent_forms(df: DataFrame, key: list[str], text: str, counts: dict[str, int] | None = None) -> DataFrame:
    """``key``, ``text``, ``form`` and ``changed`` for every row of ``df``.

    ``form`` is the text in its consistent form; null stays null and is not
    changed, empty stays empty. Repeated rows stay repeated, texts of any
    length are rewritten whole, other columns are dropped. ``counts`` are the
    frequencies that choose the representatives, for fields that must come in
    the same form; without them those of this field.
    """
    counts = frequencies(df, text) if counts is None else counts
    sent, name = df.sparkSession.sparkContext.broadcast(counts), repr(sorted(counts.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form = _own(name, sent).form
        for b in batches:
            texts = b.column(len(key)).to_pylist()
            forms = [t if not t else form(t) for t in texts]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(forms, pa.string()), pa.array([x != y for x, y in zip(texts, forms)])], names=[*key, "text", "form", "changed"])

    schema = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in key)
    return df.select(*key, F.col(text).alias("text")).mapInArrow(run, f"{schema}, text string, form string, changed boolean")
