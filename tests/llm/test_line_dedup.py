import hashlib
import random

from pyspark.sql import functions as F

from copyaudit.llm import line_dedup as q


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rng, text, edits, letters):
    out = list(text)
    for _ in range(edits):
        i, how = rng.randrange(len(out)), rng.random()
        if how < 0.4:
            out.insert(i, rng.choice(letters))
        elif how < 0.7:
            out[i] = rng.choice(letters)
        elif len(out) > 24:
            out.pop(i)
    return "".join(out)


def test_banded_distance(spark):
    rng = random.Random(3)
    for edits in (1, 2, 3):
        pairs = []
        for _ in range(400):
            a = "".join(rng.choice("abé😀") for _ in range(rng.randint(3, 12)))
            b = edited(rng, a + "ab", rng.randint(0, 5), "abé😀")[:rng.randint(3, 14)]
            pairs.append((a, b))
        rows = spark.createDataFrame(pairs, "a string, b string") \
            .select("a", "b", q.banded_distance(F.col("a"), F.col("b"), edits).alias("d")).collect()
        assert all(r.d == min(distance(r.a, r.b), edits + 1) for r in rows)


def test_near_lines_against_brute_force(spark):
    rng = random.Random(5)
    lines = set()
    for _ in range(50):
        base = "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(24, 45)))
        lines |= {base} | {edited(rng, base, rng.randint(1, 4), "ab é") for _ in range(8)}
    lines = sorted(x for x in lines if len(x) >= 24)
    frame = q.with_letters(spark.createDataFrame(list(enumerate(lines)), "id long, line string"))
    assert all(r.letters == sum(r.line.count(c) % 2 << k for k, c in enumerate(q.LETTERS)) for r in frame.collect())
    for edits in (1, 2):
        want = {(i, k) for i in range(len(lines)) for k in range(i + 1, len(lines))
                if abs(len(lines[i]) - len(lines[k])) <= edits and distance(lines[i], lines[k]) <= edits}
        assert {(r.a, r.b) for r in q.near_lines(frame.select("id", "line"), edits).collect()} == want and len(want) > 50


def test_a_line_shared_by_all(spark):
    shared = "This line stands in every one of the documents."
    rows = [(i, f"{shared}\nOwn line {hashlib.md5(str(i).encode()).hexdigest()} here.\n{shared}") for i in range(500)]
    out = {r.doc_id: r.text for r in q.drop_repeated_lines(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(out) == 500
    assert out[0].count(shared) == 1 and all(shared not in t for i, t in out.items() if i)


def test_classes_are_transitive_and_named_by_the_first(spark):
    a = "the quick brown fox jumps over the dog"
    b, c = a.replace("quick", "quack"), a.replace("quick", "quackish")
    d = c.replace("fox", "fix")
    docs = spark.createDataFrame([(4, a), (3, b), (2, f"{c}\n{d}"), (9, f"{a}\nshort")], "doc_id long, text string")
    rows = {(r.doc_id, r.line_no): (r.class_doc_id, r.class_line_no, r.n_links) for r in q.line_classes(docs).collect()}
    assert rows == {(4, 0): (3, 0, 1), (3, 0): (3, 0, 1), (9, 0): (3, 0, 1), (2, 0): (2, 0, 1), (2, 1): (2, 0, 1)}
    kept = {r.doc_id: r.text for r in q.drop_repeated_lines(docs).collect()}
    assert kept == {3: b, 2: c, 9: "short"}


def test_awkward_rows(spark, awkward, nothing):
    out = q.drop_repeated_lines(awkward)
    assert out.columns == awkward.columns
    rows = out.collect()
    assert len(rows) == awkward.count()                         # each repeated row keeps its line
    assert q.drop_repeated_lines(nothing).count() == 0 and q.line_classes(nothing).count() == 0
    assert {r.n_chars for r in rows if r.doc_id == 2} == {None}


def test_short_lines_have_exact_copies(spark):
    docs = spark.createDataFrame([(1, "And ornd.\n\nown"), (2, "And ornd.\nAnd ornt.\n "), (3, "x\nAnd ornd.\n。")],
                                 "doc_id long, text string")
    rows = {(r.doc_id, r.line_no): (r.class_doc_id, r.class_line_no, r.n_links)
            for r in q.line_classes(docs, least_chars=1).collect()}
    assert rows == {(1, 0): (1, 0, 0), (1, 2): (1, 2, 0), (2, 0): (1, 0, 0), (2, 1): (2, 1, 0), (3, 0): (3, 0, 0),
                    (3, 1): (1, 0, 0), (3, 2): (3, 2, 0)}
    kept = {r.doc_id: r.text for r in q.drop_repeated_lines(docs).collect()}
    assert kept == {1: "And ornd.\n\nown", 2: "And ornt.\n ", 3: "x\n。"}


def test_different_texts_under_one_id(spark):
    line = "a line that stands in more than one of the texts"
    own = [f"{c * 9} {c * 7} a line of its own {c * 11}" for c in "uvwxyz"]
    texts = [(None, f"{own[0]}\n{line}"), (None, f"{own[1]}\n{line}"), (4, f"{line}\n{own[2]}"), (4, f"{own[3]}\n{own[4]}"),
             (4, f"{own[3]}\n{own[4]}"), (5, f"{own[5]}\n{line}")]
    out = [r.text for r in q.drop_repeated_lines(spark.createDataFrame(texts, "doc_id long, text string")).collect()]
    lines = [x for t in out for x in t.split("\n")]
    assert sorted(lines) == sorted([*own, own[3], own[4], line])
    assert any(t in out for _, t in texts[:2])                  # the first copy is in one of the texts without an id
