"""Word shingles, their hashes, minhashes and bit sketches, computed column-wise over Arrow batches.

A text becomes the set of the 32-bit hashes of its runs of ``width`` words.  Words are runs of letters and
digits; every Chinese ideograph is a word of its own.  Whole texts are read; nothing is cut.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash

_HAN = "㐀-䶿一-鿿豈-﫿\U00020000-\U0003ffff"
WORD = re.compile(f"[{_HAN}]|[^\\W_{_HAN}]+")
#: Words whose hash a worker keeps; beyond, the memo is emptied.
MEMO_WORDS = 400_000
N_MINHASH = 128
_M32 = np.uint64(0xFFFFFFFF)


class _Memo(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_memo = _Memo()


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; the constants are those of a well-known public hash."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def shingle_sets(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets): sorted distinct 32-bit shingle hashes of each text, and where each text's begin."""
    found = [words(t) for t in texts]
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    total = int(lengths.sum())
    if total < width:
        return np.empty(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
    get = _memo.__getitem__
    flat = np.fromiter((get(w) for ws in found for w in ws), np.uint64, total)
    doc = np.repeat(np.arange(len(texts), dtype=np.int64), lengths)
    n = total - width + 1
    h = np.zeros(n, np.uint64)
    for k in range(width):
        h = mix(h * np.uint64(3) + flat[k : k + n])
    inside = doc[:n] == doc[width - 1 :]
    keyed = (doc[:n][inside].astype(np.uint64) << np.uint64(32)) | (h[inside] >> np.uint64(32))
    keyed = np.unique(keyed)
    offsets = np.searchsorted(keyed >> np.uint64(32), np.arange(len(texts) + 1, dtype=np.uint64))
    return (keyed & _M32).astype(np.uint32), offsets.astype(np.int64)


def minhashes(values: np.ndarray, offsets: np.ndarray, count: int = N_MINHASH, seed: int = 7) -> np.ndarray:
    """count x texts matrix of 32-bit minhashes; a text without shingles has the largest value throughout."""
    n = len(offsets) - 1
    out = np.full((count, n), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(offsets) > 0)
    if not len(full):
        return out
    rng = np.random.default_rng(seed)
    xor = rng.integers(0, 2**32, count, dtype=np.uint32)
    mul = rng.integers(0, 2**31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    starts = offsets[full]
    for k in range(count):
        v = (values ^ xor[k]) * mul[k]
        v ^= v >> np.uint32(15)
        v *= np.uint32(0x2C1B3C6D)
        out[k, full] = np.minimum.reduceat(v, starts)
    return out


def sketches(sig: np.ndarray, bits: int) -> np.ndarray:
    """bits/64 x texts matrix of 64-bit words, one bit of each of the first ``bits`` minhashes."""
    one = ((sig[:bits] >> np.uint32(3)) & np.uint32(1)).astype(np.uint64)
    shift = np.arange(64, dtype=np.uint64)[:, None]
    return np.stack([(one[k : k + 64] << shift).sum(0, dtype=np.uint64) for k in range(0, bits, 64)])


def combine(*rows: np.ndarray) -> np.ndarray:
    """One 32-bit hash of several minhashes."""
    h = np.zeros(rows[0].shape, np.uint64)
    for r in rows:
        h = mix(h * np.uint64(5) + r.astype(np.uint64))
    return (h >> np.uint64(32)).astype(np.uint32)


def set_ids(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit id of each set; equal sets have equal ids."""
    raw, at = values.tobytes(), (offsets * 4).tolist()
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(raw[a:b]) for a, b in zip(at, at[1:])), np.uint64, len(at) - 1)


def signed(a: np.ndarray) -> np.ndarray:
    return a.astype(np.uint64).view(np.int64)


def joined_texts(batch: pa.RecordBatch, columns: list[str]) -> list[str]:
    """The columns of each row with line breaks between; null counts as empty."""
    parts = [batch.column(c).to_pylist() for c in columns]
    return ["\n".join(x or "" for x in row) for row in zip(*parts)]


def sets_column(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int32)))
