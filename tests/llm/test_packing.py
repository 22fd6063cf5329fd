import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from copyaudit.llm import packing as p

SF = "/root/testdata/sf0.001"


def test_ids_equal_the_tokenizers(spark):
    words = p.word_ids(None)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    texts += ["", "It's ΣAΣ don''t é <|endoftext|> 12ab #'s !'s İ", "''re reagan's", "½ Ǆ ª º ß ÷×   x", "a\x1cb\x85c"]
    for t in texts:
        assert np.frombuffer(words.of_text(t), "<u4").tolist() == words.tokenizer.encode(t, add_special_tokens=False).ids


def test_the_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(p, "CACHED_WORDS", 5)
    words = p.WordIds(public_tokenizers.path(p.VOCABULARY))
    text = " ".join(f"word{i}" for i in range(40)) + " word1"
    assert np.frombuffer(words.of_text(text), "<u4").tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids
    assert len(words) <= 6 and len(words.older) <= 6


def fewest(items, capacity):
    """The fewest bins for a handful of items, by trying every set that holds the first one."""
    if not items:
        return 0
    first, rest = items[0], items[1:]
    best = len(items)
    for mask in range(1 << len(rest)):
        inside = [x for k, x in enumerate(rest) if mask >> k & 1]
        if first + sum(inside) <= capacity:
            best = min(best, 1 + fewest([x for k, x in enumerate(rest) if not mask >> k & 1], capacity))
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=8))
def test_reduction_keeps_an_optimum(items):
    counts = [0] * 21
    for x in items:
        counts[x] += 1
    fixed = p.reduce_dominated(counts, 20)
    left = [x for x in range(21) for _ in range(counts[x])]
    assert all(sum(lengths) <= 20 for lengths, _ in fixed)
    assert sum(times for _, times in fixed) + fewest(left, 20) == fewest(sorted(items, reverse=True), 20)


def test_best_fit_equals_piece_by_piece():
    rng = random.Random(4)
    for _ in range(200):
        capacity = rng.choice([10, 30, 100])
        items = sorted((rng.randint(1, capacity) for _ in range(rng.randint(0, 60))), reverse=True)
        rooms = []
        for x in items:
            at = min((i for i, r in enumerate(rooms) if r >= x), key=lambda i: rooms[i], default=None)
            if at is None:
                rooms.append(capacity - x)
            else:
                rooms[at] -= x
        counts = [items.count(x) for x in range(capacity + 1)]
        groups = p.best_fit(counts, capacity)
        assert sorted(r for lengths, n in groups for r in [capacity - sum(lengths)] * n) == sorted(rooms)


def check_places(rows, capacity):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_pieces_and_places(spark, awkward, nothing):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(awkward.select("doc_id", "text"))
    rows = p.pack_documents(docs, capacity=256).collect()
    words, expected = p.word_ids(None), []
    for r in docs.collect():
        data = words.of_text(r.text or "") + (1).to_bytes(4, "little")
        expected += [(r.doc_id, k, 256 * k, len(data[i:i + 1024]) // 4, zlib.crc32(data[i:i + 1024]))
                     for k, i in enumerate(range(0, len(data), 1024))]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted((tuple(r)[:5] for r in rows), key=key) == sorted(expected, key=key)
    assert check_places(rows, 256) <= 1.01 * sum(r.length for r in rows) / 256 + 1
    assert p.pack_documents(nothing).count() == 0


@pytest.mark.parametrize("n", [1, 3000])
def test_one_length_for_all(spark, n):
    docs = spark.createDataFrame([(i, "the cat") for i in range(n)], "doc_id long, text string")
    rows = p.pack_documents(docs, capacity=10).collect()
    assert len(rows) == n and check_places(rows, 10) == -(-n // 3)


def test_large_ids_beside_nulls_survive(spark):
    ids = [2 ** 60 + 1, None, 2 ** 60 + 3, -(2 ** 62) - 1, None, 2 ** 53 + 1]
    docs = spark.createDataFrame([(i, f"some words {k % 2}") for k, i in enumerate(ids)], "doc_id long, text string").coalesce(1)
    rows = p.pack_documents(docs, capacity=64).collect()
    assert sorted(r.doc_id or 0 for r in rows) == sorted(i or 0 for i in ids)
    check_places(rows, 64)


def test_equal_ids_are_spread_over_salts(spark):
    docs = spark.createDataFrame([(None, "the cat")] * 2000, "doc_id long, text string")
    cut = p.kept(p.pieces(docs))
    salts = cut.select(p.F.pmod(p.F.xxhash64("doc_id", "piece", p.F.monotonically_increasing_id()), p.F.lit(p.SALTS)).alias("s"))
    assert salts.distinct().count() > 200
    rows = p.pack(cut, 10).collect()
    assert len(rows) == 2000 and check_places(rows, 10) == -(-2000 // 3)
