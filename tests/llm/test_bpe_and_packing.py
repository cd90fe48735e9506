import collections
import os
import random

import pytest

from newsloom.llm import bpe, packing

need_files = pytest.mark.skipif(not os.path.exists(bpe.vocabulary_path()), reason="no tokenizer files")


@need_files
def test_equal_to_a_public_encoder():
    tiktoken = pytest.importorskip("tiktoken")
    import base64

    with open(bpe.vocabulary_path(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("own", pat_str=r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""", mergeable_ranks=ranks, special_tokens={})
    enc = bpe.encoder(bpe.vocabulary_path())
    r = random.Random(3)
    signs = "abc  \n\t'sé利滩海①½_-Ⅷ\x1c.,😀ё"
    texts = ["", " ", "<|endoftext|>", "don't stop 12345 利滩海岳 價格\r\n\r\n  x", "a" * 5000, "利" * 3000, *("".join(r.choice(signs) for _ in range(60)) for _ in range(300))]
    for t in texts:
        assert enc.encode(t) == own.encode_ordinary(t), t
        assert enc.count(t) == len(enc.encode(t))


@need_files
def test_perfect_hash_is_minimal():
    h = bpe.encoder(bpe.vocabulary_path()).hash
    assert len(set(h.slots)) == h.n and all(h.get(k) == v for k, v in zip(h.slots, h.values)) and h.get(b"no such token at all") is None


@need_files
def test_ids_of_empty_and_null(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "the end", "x"), (3, "the end", "x")], "doc_id bigint, text string, ids string")
    assert sorted((r.doc_id, len(r.ids)) for r in bpe.encode(df, "doc_id", "text").collect()) == [(1, 0), (2, 0), (3, 2), (3, 2)]
    assert bpe.encode(df.filter("doc_id > 9"), "doc_id", "text").count() == 0


def test_histogram_packing_places_everything():
    r = random.Random(1)
    for cap in (1, 7, 64, 512):
        h = collections.Counter(r.randint(1, cap) for _ in range(3000))
        got = collections.Counter()
        for n, items in packing.pack_histogram(dict(h), cap):
            assert sum(k * c for k, c in items) <= cap
            for k, c in items:
                got[k] += n * c
        assert got == h
    assert packing.pack_histogram({}, 5) == []


def test_pack_items(spark):
    r = random.Random(2)
    rows = [(k, r.choice([0, 1, 5, 5, 5, 30, 100, 257]), "z") for k in range(600)] + [(1000, None, "z"), (1001, 1000, "z"), (1001, 1000, "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, n bigint, container_id string")
    out = packing.pack(df, "doc_id", "n", {"small": 64, "big": 200}).collect()
    for name, cap in (("small", 64), ("big", 200)):
        used, docs = collections.Counter(), collections.defaultdict(list)
        for x in out:
            if x.capacity_name == name:
                used[x.container_id] += x.tokens
                docs[x.doc_id].append(x.tokens)
        assert max(used.values()) <= cap and {k: sum(v) for k, v in docs.items()} == {k: n or 0 for k, n, _ in rows}
        assert all(len(v) == max(1, -(-sum(v) // cap)) for v in docs.values())
        assert sorted(used) == list(range(len(used))) and len(used) <= 1.1 * sum(used.values()) / cap + 2
    assert packing.pack(df.filter("n < 0"), "doc_id", "n", {"small": 64}).count() == 0
    with pytest.raises(ValueError):
        packing.pack(df, "doc_id", "n", {"none": 0})
