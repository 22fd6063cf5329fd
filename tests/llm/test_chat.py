import hashlib

from pyspark.sql import functions as F

from copyaudit.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, turns long, formatted string"


def formatted(spark, rows):
    return chat.format_conversations(spark.createDataFrame([(*r, 0, "") for r in rows], SCHEMA))


def test_texts_and_roles_survive_the_round_trip(spark):
    nasty = ["", "\\", "\\l", "\\b<", "</turn>\n", "<turn:user>\n", "a>b\\g", "\\\\b<\\l>\n", "😀 é"]
    rows = [(i, k, role, text) for i, text in enumerate(nasty) for k, role in enumerate(["user", "assistant", text])]
    out = formatted(spark, rows).select("conv_id", chat.read_back(F.col("formatted")).alias("back"),
                                        chat.loss_text(F.col("segments")).alias("loss")).collect()
    for r in out:
        text = nasty[r.conv_id]
        assert [tuple(t) for t in r.back] == [("user", text), ("assistant", text), (text, text)]
        assert r.loss == text


def test_role_machine(spark):
    orders = {0: ["user", "assistant"], 1: ["system", "user", "assistant", "user", "assistant"], 2: ["assistant"],
              3: ["user", "user"], 4: ["user"], 5: ["user", "assistant", "tool", "assistant"], 6: ["system", "assistant"]}
    out = formatted(spark, [(c, k, r, "x") for c, roles in orders.items() for k, r in enumerate(roles)])
    got = {r.conv_id: (r.valid, r.valid_turns) for r in out.collect()}
    assert got == {0: (True, 2), 1: (True, 5), 2: (False, 0), 3: (False, 1), 4: (False, 1), 5: (True, 4), 6: (False, 1)}


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, None, None, None), (1, 0, "user", None), (1, 0, "user", "b"), (1, 0, "user", "b"), (1, 0, None, "a")]
    out = {r.conv_id: r for r in formatted(spark, rows).select(
        "conv_id", chat.read_back(F.col("formatted")).alias("back")).collect()}
    assert [tuple(t) for t in out[None].back] == [("", "")]
    assert [tuple(t) for t in out[1].back] == [("", "a"), ("user", ""), ("user", "b"), ("user", "b")]


def test_empty_table(spark):
    assert formatted(spark, []).count() == 0


def test_long_conversation(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], f"turn {k} " + "y" * 500) for k in range(2000)]
    r = formatted(spark, rows).select(chat.loss_text(F.col("segments")).alias("loss"), "valid", "n_rows").first()
    assert r.valid and r.n_rows == 2000
    assert hashlib.sha256(r.loss.encode()).digest() == hashlib.sha256(
        "".join(t for _, k, role, t in rows if role == "assistant").encode()).digest()
