import random
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from copyaudit.llm import collocations as c

SF = "/root/testdata/sf0.001"


def sql(least, top=c.TOP):
    return c.OP11_SQL.replace(f">= {c.LEAST}", f">= {least}").replace(f"<= {c.TOP}", f"<= {top}")


@pytest.mark.parametrize(("least", "top"), [(c.LEAST, c.TOP), (3, 150)])
def test_query_equals_sql(spark, least, top):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = c.collocations(spark.read.parquet(f"{SF}/documents.parquet"), least=least, top=top, partitions=5)
    cur = con.execute(sql(least, top))
    assert [d[0] for d in cur.description] == got.columns
    want = cur.fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want) and want


def test_awkward_rows(spark, awkward, nothing):
    texts = ["New York, new YORK city; new york. a\tb a\x1cb a\x0bb a b", "x x x x x x x", "İ é é É\n\né é", "\x00 \x00 \x00",
             "one two three four five " * 4, "one two, three four! one two"]
    docs = awkward.unionByName(spark.createDataFrame([(30 + i, t, lang) for i, t in enumerate(texts) for lang in ("en", None, "")],
                                                     "doc_id long, text string, lang string"), allowMissingColumns=True)
    table = pa.table({k: [r[k] for r in docs.collect()] for k in ("text", "lang")})
    con = duckdb.connect()
    con.register("documents", table)
    for partitions in (1, 7):
        got = c.collocations(docs, least=2, partitions=partitions)
        assert sorted(map(tuple, got.collect())) == sorted(con.execute(sql(2)).fetchall())
    assert c.collocations(nothing).count() == 0


def test_trie_counts_bursts_and_gives_whole_subtrees(monkeypatch):
    monkeypatch.setattr(c, "BURST", 4)
    rng = random.Random(2)
    trie, want = c.HatTrie(), Counter()
    for _ in range(30):
        windows = [tuple(rng.choices(range(1, 6), k=rng.randint(1, 4))) for _ in range(rng.randint(0, 40))]
        padded = [(w + (0,) * 4)[:4] for w in windows]
        want.update(padded)
        first = np.array([w[0] for w in padded], np.int64)
        rest = np.array([w[1] << 2 * c.BITS | w[2] << c.BITS | w[3] for w in padded], np.int64)
        trie.add(first, rest)
    assert trie.size == len(want) and any(isinstance(n, c.HatTrie) for n in trie.nodes.values())

    def unpacked(first, rest, n):
        mask = (1 << c.BITS) - 1
        return {(f, r >> 2 * c.BITS, r >> c.BITS & mask, r & mask): k
                for f, r, k in zip(first.tolist(), rest.tolist(), n.tolist(), strict=True)}

    assert unpacked(*trie.entries()) == want
    taken = trie.take_largest(0.5)
    gone, left = unpacked(*trie.entries(taken)), unpacked(*trie.entries())
    assert gone | left == want and not {w[0] for w in gone} & {w[0] for w in left}
    assert len(gone) >= len(want) / 2 and trie.size == len(left)


def test_small_tries_spill_often(monkeypatch):
    """Runs of many spills and partitions hold every window once per spill, with all its counts."""
    monkeypatch.setattr(c, "BURST", 8)
    bits = np.full(1 << c.TABLE_BITS - 6, 0xFFFFFFFFFFFFFFFF, np.uint64)
    rng = random.Random(3)
    texts = [" ".join(rng.choices("abcde", k=rng.randint(0, 30))).replace("e", "e.").encode() for _ in range(60)]
    windows, runs, want = c.Windows("en", "0", 64, bits), [], Counter()
    for i, t in enumerate(texts):
        windows.add(pa.array([t], pa.binary()))
        for piece in t.decode().split("."):
            w = piece.split()
            want.update(tuple((w[k:k + 4] + [""] * 4)[:4]) for k in range(len(w) - 1))
        if i % 7 == 0:
            runs += c.spilled([windows.take_largest(0.5)], 3, np.empty(0, np.uint64))
    runs += c.spilled([windows.take_largest(1)], 3, np.empty(0, np.uint64))
    names = {h - (1 << 64) if h >= 1 << 63 else h: w.decode() for w, h in zip(windows.words, windows.words.hashes[1:], strict=True)} | {0: ""}
    got, parts = Counter(), {}
    for part, data in runs:
        for batch in c.merge_runs([data]):
            for row in zip(*(batch[x].to_pylist() for x in batch.column_names), strict=True):
                key = tuple(names[h] for h in row[:4])
                got[key] += row[4]
                assert parts.setdefault(key[:2], part) == part
    assert got == want and windows.trie.size == 0


def test_names_with_a_collision_get_another_salt(spark, monkeypatch):
    words = spark.createDataFrame([("en", "a", 1), ("en", "b", 2)], "lang string, word string, f long")
    real, salts = c.F.concat, []

    def colliding(salt, word):
        salts.append(salt)
        return real(salt) if len(salts) == 1 else real(salt, word)       # the first salt gives all words one name

    monkeypatch.setattr(c.F, "concat", colliding)
    out, salt, width = c.named(words)
    assert (salt, width) == ("1", 48) and out.select("h").distinct().count() == 2
