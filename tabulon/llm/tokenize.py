"""Encoding a corpus with a byte-level BPE vocabulary.

A pre-token that is a whole vocabulary entry is resolved by a minimal perfect
hash over the vocabulary. Any other pre-token is merged from its bytes: a heap
holds the adjacent pairs by rank, the bytes are a doubly linked list. In front
of both lies a memo of bounded size, since pre-tokens repeat.
"""

from __future__ import annotations

import base64
import heapq
import importlib.util
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Fixed value: the pattern that splits text before the merges of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Where the public vocabularies lie unless a path is given.
TOKENIZERS = os.environ.get("TABULON_TOKENIZERS", "/opt/tokenizers")
MEMO = 300_000
#: Bits for a position in a pre-token.
_POS = 40


def _slot(h: int, d: int, n: int) -> int:
    """Slot of a key under a displacement: mixed anew for each, so that any slot can be met."""
    x = (h + d * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 29)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    return (x ^ (x >> 32)) % n


class PerfectHash:
    """Minimal perfect hash of byte strings by bucket displacement.

    Keys fall into ``n/4`` buckets; each bucket of several keys, the largest
    first, takes the first displacement that puts all its keys into free slots
    of ``0..n-1``; a bucket of one key names one of the slots left (negative).
    """

    def __init__(self, keys: list[bytes]):
        n = max(1, len(keys))
        self.n, self.buckets = n, max(1, n // 4)
        self.shift = [0] * self.buckets
        self.slots: list[bytes | None] = [None] * n
        self.values = [-1] * n
        groups: dict[int, list[tuple[int, int, int]]] = {}
        for i, k in enumerate(keys):
            h = xxhash.xxh3_64_intdigest(k)
            groups.setdefault(h % self.buckets, []).append((h, i))
        taken = bytearray(n)
        free = 0
        for b, members in sorted(groups.items(), key=lambda g: -len(g[1])):
            if len(members) > 1:
                d = 0
                while True:
                    at = [_slot(h, d, n) for h, _ in members]
                    if len(set(at)) == len(at) and not any(taken[a] for a in at):
                        break
                    d += 1
                self.shift[b] = d
            else:
                while taken[free]:
                    free += 1
                at, self.shift[b] = [free], -free - 1
            for a, (_, i) in zip(at, members):
                taken[a], self.slots[a], self.values[a] = 1, keys[i], i

    def find(self, key: bytes) -> int:
        """Index of ``key`` in the list the hash was built from, else -1."""
        h = xxhash.xxh3_64_intdigest(key)
        d = self.shift[h % self.buckets]
        a = _slot(h, d, self.n) if d >= 0 else -d - 1
        return self.values[a] if self.slots[a] == key else -1


class ByteBPE(dict):
    """Pre-token -> its ids as packed 32-bit integers; a dict so that repeats cost one lookup."""

    def __init__(self, tokens: list[bytes], ids: list[int], memo: int = MEMO):
        super().__init__()
        self.limit = memo
        self.ids = ids
        self.hash = PerfectHash(tokens)
        rank = dict(zip(tokens, ids))
        self.single = [rank.get(bytes([b]), -1) for b in range(256)]
        if min(self.single) < 0:
            raise ValueError("the vocabulary lacks single bytes")
        self.pair: dict[int, int] = {}
        for t, i in zip(tokens, ids):
            for k in range(1, len(t)):
                a = rank.get(t[:k])
                if a is not None and (b := rank.get(t[k:])) is not None:
                    self.pair[a << 20 | b] = i
        self.split = regex.compile(PATTERN).findall

    def __reduce__(self):
        """Travels ready built, without the memo."""
        return _rebuilt, ({k: v for k, v in self.__dict__.items() if k != "split"},)

    @classmethod
    def from_ranks(cls, path: str, memo: int = MEMO) -> ByteBPE:
        """From a file of lines 'base64 rank'."""
        tokens, ids = [], []
        with open(path, "rb") as f:
            for line in f:
                if line.strip():
                    t, i = line.split()
                    tokens.append(base64.b64decode(t))
                    ids.append(int(i))
        return cls(tokens, ids, memo)

    def merge(self, data: bytes) -> list[int]:
        """Ids of a pre-token that is not in the vocabulary."""
        get = self.pair.get
        single = self.single
        ids = [single[b] for b in data]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        a = ids[0]
        for i in range(1, n):
            b = ids[i]
            r = get(a << 20 | b)
            if r is not None:
                heap.append(r << _POS | i - 1)
            a = b
        heapq.heapify(heap)
        pop, push, mask = heapq.heappop, heapq.heappush, (1 << _POS) - 1
        while heap:
            x = pop(heap)
            i = x & mask
            j = after[i]
            if j >= n or ids[i] < 0 or get(ids[i] << 20 | ids[j]) != x >> _POS:
                continue
            ids[i] = x >> _POS
            ids[j] = -1
            j = after[i] = after[j]
            if j < n:
                before[j] = i
                r = get(ids[i] << 20 | ids[j])
                if r is not None:
                    push(heap, r << _POS | i)
            p = before[i]
            if p >= 0:
                r = get(ids[p] << 20 | ids[i])
                if r is not None:
                    push(heap, r << _POS | p)
        return [x for x in ids if x >= 0]

    def __missing__(self, token: str) -> bytes:
        data = token.encode("utf-8", "surrogatepass")
        at = self.hash.find(data)
        packed = array("i", (self.ids[at],) if at >= 0 else self.merge(data)).tobytes()
        if len(token) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[token] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Packed ids of a text."""
        return b"".join(map(self.__getitem__, self.split(text)))


def _rebuilt(state: dict) -> ByteBPE:
    bpe = ByteBPE.__new__(ByteBPE)
    bpe.__dict__.update(state, split=regex.compile(PATTERN).findall)
    return bpe


def _own(name: tuple[str, int], sent) -> ByteBPE:
    """This process's encoder; a worker keeps it, and its memo, from task to task."""
    if name not in _HERE:
        _HERE[name] = sent.value
    return _HERE[name]


#: Of this process, by path and size of the vocabulary file.
_BUILT: dict[tuple[str, int], ByteBPE] = {}
_HERE: dict[tuple[str, int], ByteBPE] = {}


def vocabulary(name: str, root: str = TOKENIZERS) -> str:
    """Path of a vocabulary file: in ``root``, or in the installed package of public tokenizers."""
    path = os.path.join(root, name)
    if not os.path.exists(path) and (spec := importlib.util.find_spec("public_tokenizers")):
        path = os.path.join(os.path.dirname(spec.origin), name)
    return path


def encode_corpus(df: DataFrame, id_col: str, text_col: str = "text", ids_col: str = "ids", ranks: str | None = None) -> DataFrame:
    """One row ``(id_col, ids_col)`` for each row of ``df``.

    ``ranks`` is the path of the vocabulary; its tables are built once and
    broadcast (their size is that of the vocabulary). Empty and null
    texts get the empty list. Texts of any length are encoded whole; special
    tokens are neither added nor recognised. Repeated rows stay repeated;
    other columns of ``df`` are not read.
    """
    path = ranks or vocabulary("byte_bpe_50k.tiktoken")
    name = path, os.path.getsize(path)
    if name not in _BUILT:
        _BUILT[name] = ByteBPE.from_ranks(path)
    sent = df.sparkSession.sparkContext.broadcast(_BUILT[name])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _own(name, sent)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                packed = [bpe.encode(t) if t else b"" for t in part.column(1).to_pylist()]
                ends = np.zeros(len(packed) + 1, np.int32)
                np.cumsum([len(p) // 4 for p in packed], out=ends[1:])
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=[id_col, ids_col])

    schema = T.StructType([df.schema[id_col], T.StructField(ids_col, T.ArrayType(T.IntegerType()))])
    return df.select(id_col, text_col).mapInArrow(run, schema)
