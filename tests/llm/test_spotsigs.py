import hashlib
import random
import re

from pyspark.sql import functions as F

from copyaudit.llm import spotsigs as q
from copyaudit.llm.common import let

SF = "/root/testdata/sf0.001"


def brute(text, spark):
    """The signatures of one text with Python lists; Spark's hashes of the chains."""
    words = [w for w in re.split(r"[^\w]|_", text.lower()) if w] or text.split()
    content = [i for i, w in enumerate(words) if w not in q.COMMON] or list(range(len(words)))
    chains = [(words[i - 1] if j else None, words[i], words[content[j + 1]] if j + 1 < len(content) else None) for j, i in enumerate(content)]
    return signature_rows(spark, words, chains, content)


def signature_rows(spark, words, chains, content):
    before = [words[i - 1] if i else None for i in content]                # the word before, also before the first
    df = spark.createDataFrame([(a, *c) for a, c in zip(before, chains, strict=True)], "p string, a string, b string, c string")
    rows = df.select("a", F.hash("p", "b", "c").alias("h"), (F.pmod(F.xxhash64("a"), F.lit(q.PICKED)) == 0).alias("picked")).collect()
    return {r.h for r in rows if r.a is None or r.a in q.ANCHORS or r.picked}


def test_chains_follow_anchors_and_skip_common_words(spark):
    long = "The big house of the old tree is on a hill. " + "Zebra quartz vivid. " * 40 + "For some kind words, with care. They met at noon sharp."
    sigs = spark.createDataFrame([(long,)], "t string").select(q.fingerprint(F.col("t")).alias("s")).first().s
    chains = [("the", "big", "house"), ("the", "old", "tree"), ("a", "hill", "zebra"), ("some", "kind", "words"),
              ("with", "care", "met"), ("at", "noon", "sharp")]
    want = spark.createDataFrame(chains, "a string, b string, c string").select(F.hash("a", "b", "c").alias("h")).collect()
    assert {r.h for c, r in zip(chains, want, strict=True) if c[0] not in ("some", "a", "at")} <= set(sigs)
    assert sorted(brute(long, spark)) == sigs and all(len(brute(t, spark)) > 0 for t in ("!!! ???", "the of and", "x", "some"))


def test_neighbours_and_edits(spark, awkward):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").repartition(7)
    rows = {r.doc_id: r for r in q.with_neighbours(docs).collect()}
    texts = sorted((r.doc_id, r.text) for r in docs.collect())
    for k, (i, text) in enumerate(texts):
        assert rows[i].text == text and rows[i].next_prefix == texts[(k + 1) % len(texts)][1][:len(text) // 4]
    out = q.with_neighbours(awkward)
    assert out.count() == awkward.count()
    again = q.with_neighbours(awkward).groupBy("doc_id", "text").agg(F.countDistinct("next_prefix").alias("n"))
    assert again.where("n > 1").count() == 0                    # equal rows have one neighbour


def test_one_document_and_none(spark, nothing):
    one = spark.createDataFrame([(5, "abcdefgh")], "doc_id long, text string")
    r = q.with_neighbours(one).first()
    assert r.next_prefix == "ab"
    assert q.with_neighbours(nothing).count() == 0


def test_likeness_bounds(spark):
    df = spark.createDataFrame([([1, 2, 3], [2, 3, 4]), ([], []), ([1], []), ([1, 2], [1, 2])], "a array<long>, b array<long>")
    got = [r[0] for r in df.select(q.jaccard(F.col("a"), F.col("b"))).collect()]
    assert got == [0.5, 1.0, 0.0, 1.0]
    assert [r[0] for r in df.select(q.jaccard(F.col("a"), F.col("b"), 0.8)).collect()] == [0.5, 1.0, 0.0, 1.0]
    text = "equal texts of the same words have equal fingerprints"
    same = spark.createDataFrame([(text,), (text,)], "t string").select(let(F.col("t"), q.fingerprint).alias("s")).collect()
    assert same[0] == same[1] and same[0].s
    pairs = [("!!! ???", "*** ###"), ("the of and", "and of the"), ("", "!"), ("...", "the")]
    assert likeness_of(spark, pairs) == [0.0] * 4


def test_near_pairs_against_brute_force(spark):
    rng = random.Random(2)
    sets = []
    for i in range(60):
        base = sorted(rng.sample(range(400), rng.randint(1, 40)))
        sets.append(base)
        for _ in range(3):
            sets.append(sorted({x if rng.random() > 0.08 else rng.randrange(400) for x in base}))
    sets = [list(t) for t in sorted({tuple(s) for s in sets})] + [[]]
    df = spark.createDataFrame(list(enumerate(sets)), "id long, sigs array<long>")
    got = {(r.a, r.b): r.likeness for r in q.near_pairs(df).collect()}
    want = {}
    for i, a in enumerate(sets):
        for k, b in enumerate(sets[:i]):
            union = set(a) | set(b)
            if a and b and len(set(a) & set(b)) / len(union) >= 0.8:
                want[(k, i)] = len(set(a) & set(b)) / len(union)
    assert got == want and len(want) > 20


def test_digest_of_the_edited_text(spark):
    rows = {r.doc_id: r for r in q.op5_spotsigs(spark, SF).collect()}
    texts = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    for k, (i, text) in enumerate(texts):
        n = len(text) // 4
        edited = text[:len(text) - n] + texts[(k + 1) % len(texts)][1][:n]
        assert rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and rows[i].n_chars == len(text)


def likeness_of(spark, pairs):
    rows = spark.createDataFrame(pairs, "a string, b string").select(
        q.fingerprint(F.col("a")).alias("a"), q.fingerprint(F.col("b")).alias("b")).collect()
    return [len(set(r.a) & set(r.b)) / len(set(r.a) | set(r.b)) for r in rows]


def test_near_copies_of_any_length_and_number_of_anchors_are_near(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("bcdfghklmnprstvz") for _ in range(6))
    text = " ".join(rng.choice(("the", "of", word(), word(), word())) for _ in range(300))
    pairs = [(text[:n], text[:n - cut]) for n in range(595, 611) for cut in (1, 8, 12)]        # around 600 characters
    plain = " ".join(word() for _ in range(200))
    for anchors in range(6):                                                                 # around 4 spot signatures
        a = plain + "".join(f" the {word()} {word()}" for _ in range(anchors))
        pairs.append((a, a + f" the {word()} {word()}"))
    pairs += [("red apples grow here", "red apples grow here"), ("no", "no")]
    assert min(likeness_of(spark, pairs)) >= 0.8
    edge = spark.createDataFrame([(1, text[:605]), (2, text[:597])], "doc_id long, text string")
    sets = edge.select(F.col("doc_id").alias("id"), q.fingerprint(F.col("text")).alias("sigs"))
    assert [(r.a, r.b) for r in q.near_pairs(sets).collect()] == [(1, 2)]
    assert all(r.sigs == r.next_sigs or len(set(r.sigs) & set(r.next_sigs)) > 0.8 * len(r.sigs)
               for r in q.with_neighbours(edge).collect())
