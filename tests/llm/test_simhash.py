import random
import re
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import functions as F

from copyaudit.llm import simhash as q
from copyaudit.llm.common import components

SF = "/root/testdata/sf0.001"


def brute(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(nodes, edges):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_golay_decoder():
    code = q.Golay()
    assert len(set(code._of(code.errors).tolist())) == 2048
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 500)
    index = code.index(words)
    codewords = {int(i): int(w ^ code.errors[code._of(np.array([w]))[0]]) for i, w in zip(index, words, strict=True)}
    assert all(bin(int(w) ^ codewords[int(i)]).count("1") <= 3 for i, w in zip(index, words, strict=True))
    near = words ^ (1 << rng.integers(0, 23, 500))              # one bit off: the stored key is among the looked-up ones
    for x, y in zip(words, near, strict=True):
        keys = code.index(x ^ np.array([0, *[1 << i for i in range(23)]]))
        assert code.index(np.array([y]))[0] in keys


def test_links_against_brute_force(spark):
    rng = random.Random(8)
    fps = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        for _ in range(6):
            x = base
            for bit in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << bit
            fps.add(x)
    fps |= {0, 1, (1 << 64) - 1, (1 << 64) - 8, 7, 15}
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    got = {(r.a, r.b) for r in q.links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()}
    want = {(a, b) for a, b in combinations(signed, 2) if bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 3}
    assert got == want and len(want) > 100


def test_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 150), (5, 5)] \
        + [(rng.randrange(300, 360), rng.randrange(300, 360)) for _ in range(40)] + [(1000, i) for i in range(1001, 1400)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    assert got == smallest_reachable(nodes, [e for e in edges if e[0] != e[1]])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_whole_operator_against_brute_force(spark, awkward):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text") \
        .unionByName(awkward.where("doc_id is not null").select((F.col("doc_id") + 10 ** 6).alias("doc_id"), "text"))
    rows = q.near_duplicates(docs).collect()
    fps = {r.doc_id: brute(r.text) for r in docs.collect()}
    assert all(r.fp & ((1 << 64) - 1) == fps[r.doc_id] for r in rows)
    edges = [(a, b) for a, b in combinations(fps, 2) if bin(fps[a] ^ fps[b]).count("1") <= 3]
    assert {r.doc_id: r.component_id for r in rows} == smallest_reachable(fps, edges)


def test_one_row_of_each_group_stays(spark, awkward, nothing):
    out = q.keep_first(awkward)
    assert out.columns == awkward.columns
    groups = {(r.component_id,) for r in q.near_duplicates(awkward).collect()}
    assert out.count() == len(groups)
    assert q.keep_first(nothing).count() == 0 and q.near_duplicates(nothing).count() == 0


def test_long_text_in_slices(monkeypatch):
    text = " ".join(str(i % 977) for i in range(5000))
    whole = q.text_fingerprint(text)
    monkeypatch.setattr(q, "SLICE", 100)
    assert q.text_fingerprint(text) == whole == brute(text)
