"""Line dedup on a large group of lines that are near one base, and far from each other."""

import random

from pyspark.sql import functions as F

from copyaudit.llm import line_dedup as q


def group(rng, count):
    base = " ".join("".join(rng.choice("aeinorst") for _ in range(rng.randint(2, 9))) for _ in range(40))
    out = set()
    while len(out) < count:
        at = rng.randrange(len(base))
        out.add(base[:at] + "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4)) + base[at:])
    return sorted(out)


def near(a, b):
    """Whether two lines are within two edits of each other."""
    row = {0: 0, 1: 1, 2: 2}                                 # a band of the matrix around its diagonal
    for i in range(1, len(a) + 1):
        new = {}
        for k in range(max(0, i - 2), min(len(b), i + 2) + 1):
            new[k] = min(row.get(k, 9) + 1, new.get(k - 1, 9) + 1, row.get(k - 1, 9) + (a[i - 1] != b[k - 1]) if k else 9)
        row = new
    return abs(len(a) - len(b)) <= 2 and row[len(b)] <= 2


def test_pairs_of_a_large_group_are_refused_by_their_letters(spark):
    rng = random.Random(11)
    lines = group(rng, 160)
    lines += [lines[0][:-1] + "q", lines[0][:40] + lines[0][42:], lines[1] + "zz"]
    frame = spark.createDataFrame(list(enumerate(lines)), "id long, line string")
    shared = q.shared_keys(frame)
    measured = q.with_letters(frame).withColumn("n", F.length("line"))
    found = {(r.a, r.b) for r in q.candidate_pairs(shared, measured).collect()}
    want = {(i, k) for i in range(len(lines)) for k in range(i + 1, len(lines)) if near(lines[i], lines[k])}
    assert len(want) >= 3 and want <= found
    assert len(found) <= 1500                                # of 13,203; 7,762 before all letters were counted
    assert {(r.a, r.b) for r in q.near_lines(frame).collect()} == want


def test_keys_of_one_line_alone_are_not_kept(spark):
    rng = random.Random(12)
    lines = ["".join(rng.choice("abcdefgh ") for _ in range(60)) for _ in range(50)] + ["a" * 60]
    frame = spark.createDataFrame(list(enumerate([*lines, lines[7] + "x"])), "id long, line string")
    assert {r.id for r in q.shared_keys(frame).collect()} == {7, 51}
