import hashlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from copyaudit.llm import mixing as m

COLUMNS = "doc_id long, text string, lang string, source string"


def corpus(spark, sizes):
    """``{(lang, source): documents}``; every text has 1 to 7 words."""
    rows, i = [], 0
    for (lang, source), n in sizes.items():
        for _ in range(n):
            rows.append((i, " ".join(["w"] * (1 + i % 7)), lang, source))
            i += 1
    return spark.createDataFrame(rows, COLUMNS), rows


def test_budgets_of_a_tree_by_hand(spark):
    leaves = spark.createDataFrame([("d", "en", "a", 100), ("d", "en", "b", 1000), ("d", "fr", "c", 10)],
                                   "mix_domain string, mix_lang string, mix_source string, tokens long")
    mix = m.Mix(languages={"en": 1, "fr": 1}, sources={"a": 1, "b": 1}, budget_percent=50, max_epochs=1)
    got = {r.mix_source: r.budget for r in m.leaf_budgets(leaves, mix).collect()}
    # 555 tokens; fr can use 10 of its half, the rest goes to its sibling; there a is full at 100
    assert got == {"a": 100, "b": 445, "c": 10}


def test_whole_budget_is_spent_and_order_is_seeded(spark):
    docs, rows = corpus(spark, {("en", "a"): 300, ("en", "b"): 20, ("fr", "a"): 50, (None, None): 9})
    mix = m.Mix(languages={"en": 1, "fr": 3}, other=1, domain_of=lambda s: F.lit("d"), max_epochs=2)
    out = m.mix_documents(docs, mix).collect()
    tokens = {i: len(t.split()) for i, t, _, _ in rows}
    leaf = {i: (lang, source) for i, _, lang, source in rows}
    total = defaultdict(int)
    for i, n in tokens.items():
        total[leaf[i]] += n
    leaves = spark.createDataFrame([("d", *k, v) for k, v in total.items()],
                                   "mix_domain string, mix_lang string, mix_source string, tokens long")
    budgets = {(r.mix_lang, r.mix_source): r.budget for r in m.leaf_budgets(leaves, mix).collect()}
    assert sum(budgets.values()) == min(sum(tokens.values()), 2 * sum(tokens.values()))
    expected = Counter()
    for key, budget in budgets.items():
        whole, rest = divmod(budget, total[key])
        ids = [i for i in tokens if leaf[i] == key]
        for e in range(1, whole + 1):
            expected.update((i, e) for i in ids)
        run = 0
        for i in sorted(ids, key=lambda i: (hashlib.md5(f"20:{whole + 1}:{i}".encode()).hexdigest(), i)):
            run += tokens[i]
            if run > rest:
                break
            expected[(i, whole + 1)] += 1
    assert Counter((r.doc_id, r.mix_epoch) for r in out) == expected


def test_awkward_rows(spark, awkward, nothing):
    out = m.mix_documents(awkward)
    assert out.columns == [*awkward.columns, "mix_domain", "mix_tokens", "mix_epoch"]
    assert m.mix_documents(awkward, details=False).columns == awkward.columns
    assert m.mix_documents(awkward, m.Mix(budget_percent=200), details=False).count() >= awkward.where("text is not null").count()
    assert m.mix_documents(nothing).count() == 0
