"""Encoding of texts with a public byte-level BPE vocabulary.

Method: two-tier lookup.  A minimal perfect hash (hash and displace, one slot per token, no free slots) resolves
every pre-token that is in the vocabulary as a whole; any other is merged with a heap over its linked bytes.
Before the heap a pre-token is parted where no token of the vocabulary could span the two characters, which
cannot change the result and keeps long runs of ideographs short.  Pre-tokens already seen by a worker are kept
in a bounded memo.

The vocabulary file is read on the driver (its size is fixed, about 1 MB) and sent to the workers with the
task.  Defined results: empty and null text give an empty list; whole texts are encoded, special tokens'
strings in a text are ordinary text.
"""

from __future__ import annotations

import base64
import heapq
import os
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.session import spread

TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
#: Fixed value: the pre-token pattern that belongs to this vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
#: The same for texts without the characters of ``_OTHER``, on which the two character classifications differ.
FAST_PATTERN = re.compile(r"""'(?:[sdmt]|ll|ve|re)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+""")
_OTHER = frozenset(c for c in map(chr, range(0x110000)) if unicodedata.category(c) in ("Nl", "No") or c in "\x1c\x1d\x1e\x1f\x85")
MEMO_PIECES = 300_000


_SLOW = regex.compile(PATTERN)


class PerfectHash:
    """Minimal perfect hash from byte strings to their ids, built by hash and displace."""

    def __init__(self, ids: dict[bytes, int]):
        keys = list(ids)
        n = len(keys)
        self.n, self.buckets = n, max(1, n // 2)
        self.slots: list[bytes] = [b""] * n
        self.values = [0] * n
        self.shift = [0] * self.buckets
        groups: list[list[bytes]] = [[] for _ in range(self.buckets)]
        for k in keys:
            groups[xxhash.xxh3_64_intdigest(k) % self.buckets].append(k)
        taken = np.zeros(n, bool)
        order = sorted(range(self.buckets), key=lambda b: -len(groups[b]))
        free: Iterator[int] | None = None
        for b in order:
            group = groups[b]
            if len(group) > 1:
                d = 1
                while True:
                    at = [self._slot(xxhash.xxh3_64_intdigest(k), d) for k in group]
                    if len(set(at)) == len(at) and not taken[at].any():
                        break
                    d += 1
                self.shift[b] = d
            elif group:
                if free is None:
                    free = iter(np.flatnonzero(~taken).tolist())
                at = [next(free)]
                self.shift[b] = -at[0] - 1
            else:
                continue
            for k, s in zip(group, at):
                taken[s], self.slots[s], self.values[s] = True, k, ids[k]

    def _slot(self, h: int, d: int) -> int:
        return ((h >> 20) * (2 * d + 1) + (h & 0xFFFFF) * d) % 0xFFFFFFFFFFC5 % self.n

    def get(self, key: bytes) -> int | None:
        h = xxhash.xxh3_64_intdigest(key)
        d = self.shift[h % self.buckets]
        s = -d - 1 if d < 0 else self._slot(h, d)
        return self.values[s] if self.slots[s] == key else None


def _is_start(byte: int) -> bool:
    return byte & 0xC0 != 0x80


class Tables:
    """What an encoder looks up; this is what goes to the workers.  ``made`` is the worker's encoder of it."""

    def __init__(self, hash_: PerfectHash, spans: set[tuple[bytes, bytes]]):
        self.hash, self.spans, self.made = hash_, spans, None

    def __getstate__(self):
        return self.hash, self.spans

    def __setstate__(self, state):
        (self.hash, self.spans), self.made = state, None


class Encoder(dict):
    """Pre-token -> tuple of ids; the dictionary itself is the memo."""

    def __init__(self, ids: dict[bytes, int] | None, tables: Tables | None = None):
        super().__init__()
        self.glued: dict[str, bool] = {}
        if tables:
            self.hash, self.spans = tables.hash, tables.spans
            return
        self.hash = PerfectHash(ids)
        spans = set()
        for t in ids:
            for p in range(1, len(t)):
                if _is_start(t[p]):
                    a = p - 1
                    while a > 0 and not _is_start(t[a]):
                        a -= 1
                    b = p + 1
                    while b < len(t) and not _is_start(t[b]):
                        b += 1
                    spans.add((t[a:p], t[p:b]))
        self.spans = spans

    def tables(self) -> Tables:
        return Tables(self.hash, self.spans)

    @classmethod
    def of(cls, tables: Tables) -> Encoder:
        if tables.made is None:
            tables.made = cls(None, tables)
        return tables.made

    @staticmethod
    def find(text: str) -> list[str]:
        """The pre-tokens of a text, in order."""
        return FAST_PATTERN.findall(text) if _OTHER.isdisjoint(text) else _SLOW.findall(text)

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(self) >= MEMO_PIECES:
            self.clear()
        raw = piece.encode("utf-8", "replace")
        one = self.hash.get(raw)
        if one is not None:
            out = (one,)
        elif len(raw) == len(piece):
            out = self.merge(raw)
        else:
            parts = self.part(piece)
            out = self.merge(raw) if len(parts) == 1 else tuple(chain.from_iterable(map(self.__getitem__, parts)))
        self[piece] = out
        return out

    def part(self, piece: str) -> list[str]:
        """Split where no token can span the two characters."""
        glued, out, start = self.glued, [], 0
        for i in range(1, len(piece)):
            two = piece[i - 1 : i + 1]
            g = glued.get(two)
            if g is None:
                if len(glued) >= MEMO_PIECES:
                    glued.clear()
                g = glued[two] = self.spanned(two)
            if not g:
                out.append(piece[start:i])
                start = i
        out.append(piece[start:])
        return out

    def spanned(self, two: str) -> bool:
        a, b = (c.encode("utf-8", "replace") for c in two)
        return any((a[i:], b[:j]) in self.spans for i in range(len(a)) for j in range(1, len(b) + 1))

    def merge(self, raw: bytes) -> tuple[int, ...]:
        """Byte-pair merging with a heap over linked parts; the leftmost pair of the lowest rank goes first."""
        n, rank = len(raw), self.hash.get
        end = list(range(1, n + 1))  # where the part that begins here ends; 0: no part begins here
        prev = list(range(-1, n - 1))
        heap: list[tuple[int, int, int]] = []
        for i in range(n - 1):
            r = rank(raw[i : i + 2])
            if r is not None:
                heap.append((r, i, i + 2))
        heapq.heapify(heap)
        while heap:
            _, i, e = heapq.heappop(heap)
            mid = end[i]
            if not mid or mid >= e or end[mid] != e:
                continue  # one of the two parts has changed since
            end[i], end[mid] = e, 0
            if e < n:
                prev[e] = i
                r = rank(raw[i : end[e]])
                if r is not None:
                    heapq.heappush(heap, (r, i, end[e]))
            if i > 0:
                p = prev[i]
                r = rank(raw[p:e])
                if r is not None:
                    heapq.heappush(heap, (r, p, e))
        out, i = [], 0
        while i < n:
            out.append(rank(raw[i : end[i]]))
            i = end[i]
        return tuple(out)

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(map(self.__getitem__, self.find(text)))) if text else []

    def count(self, text: str | None) -> int:
        return sum(map(len, map(self.__getitem__, self.find(text)))) if text else 0


def read_encoder(path: str) -> Encoder:
    with open(path, "rb") as f:
        return Encoder({base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())})


_read: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, built once per process."""
    if path not in _read:
        _read[path] = read_encoder(path)
    return _read[path]


def vocabulary_path(name: str = "byte_bpe_50k", folder: str | None = None) -> str:
    return f"{folder or TOKENIZERS}/{name}.tiktoken"


def encode(df: DataFrame, key: str, text: str, path: str | None = None) -> DataFrame:
    """key, ids (list of int) of every row."""
    shared = df.sparkSession.sparkContext.broadcast(encoder(path or vocabulary_path()).tables())
    rows = spread(df.select(F.col(key), F.col(text).alias("_text")))
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder.of(shared.value)
        for b in batches:
            flat: list[int] = []
            offsets = [0]
            for t in b.column(1).to_pylist():
                if t:
                    flat.extend(chain.from_iterable(map(enc.__getitem__, enc.find(t))))
                offsets.append(len(flat))
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], names=[key, "ids"])

    return rows.mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def token_counts(df: DataFrame, key: str, text: str, path: str | None = None) -> DataFrame:
    """key, tokens: number of tokens of every row."""
    shared = df.sparkSession.sparkContext.broadcast(encoder(path or vocabulary_path()).tables())
    rows = spread(df.select(F.col(key), F.col(text).alias("_text")))
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder.of(shared.value)
        for b in batches:
            n = np.fromiter((enc.count(t) for t in b.column(1).to_pylist()), np.int64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n)], names=[key, "tokens"])

    return rows.mapInArrow(run, f"`{key}` {kind}, tokens bigint")
