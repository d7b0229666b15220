"""Text functions: numeric literals, whitespace, labels and look-alike characters.

Column functions stay in the JVM; ``folded`` is for code that runs in Python
workers anyway.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Greek and Cyrillic letters that look like Latin ones.
LOOKALIKE_LETTERS = {
    "A": "ΑА", "B": "ΒВ", "C": "СϹ", "E": "ΕЕ", "H": "ΗН", "I": "ΙІ", "J": "ЈͿ", "K": "ΚК", "M": "ΜМ", "N": "Ν",
    "O": "ΟО", "P": "ΡР", "Q": "Ԛ", "S": "Ѕ", "T": "ΤТ", "V": "Ѵ", "W": "Ԝ", "X": "ΧХ", "Y": "ΥҮУ", "Z": "Ζ",
    "a": "аα", "c": "сϲ", "d": "ԁ", "e": "е", "g": "ɡ", "h": "һ", "i": "іι", "j": "јϳ", "k": "κ", "l": "ӏ", "n": "ո",
    "o": "оο", "p": "рρ", "q": "ԛ", "s": "ѕ", "u": "υ", "v": "νѵ", "w": "ԝ", "x": "х", "y": "уү",
}
# What stands for a digit inside a number.
LOOKALIKE_DIGITS = {"0": "OoΟοОо", "1": "IlΙІӏ|"}

_LETTER = {ord(x): k for k, v in LOOKALIKE_LETTERS.items() for x in v}
#: Letters and digits of a look-alike, spaces, and nothing for what is invisible.
_INVISIBLE = {c: None for c in (0xAD, 0x34F, 0x61C, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180E, 0x3164, 0xFFA0, 0xFEFF, *range(0x180B, 0x180E), *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2070), *range(0xFE00, 0xFE10), *range(0xE0000, 0xE0FFF))}


def folded(text: str) -> str:
    """Compatibility forms resolved, look-alike letters made Latin, invisible characters removed, every space U+0020."""
    text = unicodedata.normalize("NFKC", text.translate(_INVISIBLE)).translate(_LETTER)
    return " ".join(text.split()) if not text.isascii() or " " in text or "\t" in text or "\n" in text else text


def norm(c: Column) -> Column:
    """Text without any whitespace, Unicode's included; null stays null."""
    return F.regexp_replace(c, r"(?U)\s+", "")


def stripped(c: Column) -> Column:
    """Text without whitespace at its ends, Unicode's included."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def number(c: Column) -> Column:
    """Numeric literal as double, else null.

    A leading 下降 or 减少 negates (and refuses a number already negative); one
    trailing percent or per mille sign is dropped without scaling; thousands
    separators must be in place; U+2212 is a minus, full-width digits count.
    """
    t = F.translate(stripped(c), "−０１２３４５６７８９", "-0123456789")
    down = t.rlike("^(下降|减少)")
    body = F.when(down, stripped(F.substring(t, 3, 1 << 20))).otherwise(t)
    body = stripped(F.regexp_replace(body, r"[%‰]\z", ""))
    fits = body.rlike(r"^[+-]?([0-9]{1,3}(,[0-9]{3})+|[0-9]+)(\.[0-9]+)?\z") & ~(down & body.startswith("-"))
    value = F.regexp_replace(body, ",", "").try_cast("double")
    return F.when(fits, F.when(down, -value).otherwise(value))


def joined(words: Column) -> Column:
    """Concatenated words with full-width point, comma and percent sign made half-width."""
    return F.translate(F.array_join(words, ""), "．，％", ".,%")


def brackets_balanced(c: Column) -> Column:
    """Whether as many brackets open as close, full-width ones included."""
    t = F.translate(c, "（）", "()")
    return F.length(F.regexp_replace(t, r"[^(]", "")) == F.length(F.regexp_replace(t, r"[^)]", ""))


def numeric_tokens(c: Column) -> Column:
    """How many numbers stand in a cell."""
    return F.regexp_count(c, F.lit(r"(?<![A-Za-z0-9])[+-]?\d+(?:\.\d+)?"))


def identity(*parts: Column) -> Column:
    """First 24 hex digits of the SHA-256 of the parts as a JSON list, byte for byte as Python's ``json.dumps`` writes it.

    Strings must be free of control characters; numbers are given as columns of numeric type.
    """

    def one(p: Column) -> Column:
        text = F.to_json(F.array(p))
        return F.expr("null") if p is None else F.coalesce(F.substring(text, F.lit(2), F.length(text) - 2), F.lit("null"))

    return F.substring(F.sha2(F.concat(F.lit("["), F.concat_ws(", ", *[one(p) for p in parts]), F.lit("]")), 256), 1, 24)
