"""Mixing sources to target weights: hierarchical budgets over domain / language / source, seeded epochs per leaf.

A token budget flows from the root to the leaves. Children share their parent's budget by weight, but none gets more than
its capacity (``max_epochs`` times its tokens); what a child cannot use goes to its siblings, and since a parent never gets
more than its children can hold, shortages reach ancestors only when all siblings are full. With the children of a parent
ordered by capacity over weight, the full ones are a prefix, so each level is one window over the (few) tree nodes.

A leaf with budget b and t tokens takes ``b div t`` whole epochs and, of the next epoch, the documents in seeded order
while their running token count stays within ``b mod t``. The running count is never taken over a whole leaf: documents
fall into 65,536 ranges of their order key, range totals give the one range where the budget ends, and only that range is
numbered row by row.

Tokens are words between white space. Defined cases: a null text has no tokens; a null lang or source is a value of its
own; a leaf without tokens is never chosen; a node of weight 0 gets nothing; repeated rows are rows of their own, ordered
among themselves by token count; other columns, whatever their names, are passed through; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from copyaudit.llm.common import WORD, kept, table, written

NATURAL = None            # a level whose weights are the token counts themselves


def source_domain(source: Column) -> Column:
    """The domain of a source; production rule: one of four, by checksum."""
    return F.concat(F.lit("domain"), F.crc32(F.coalesce(source, F.lit("")).cast("binary")) % 4)


@dataclass(frozen=True)
class Mix:
    """Target weights per level (a table of weights with ``other`` for the rest, or natural), budget and seed."""

    domains: dict[str, int] | None = NATURAL
    languages: dict[str, int] | None = field(default_factory=lambda: {"en": 55, "fr": 18, "de": 17, "es": 10})
    sources: dict[str, int] | None = NATURAL
    other: int = 1
    budget_percent: int = 100
    max_epochs: int = 2
    seed: int = 20
    domain_of: Callable[[Column], Column] = source_domain


MIX = Mix()
LEVELS = ("mix_domain", "mix_lang", "mix_source")


def n_tokens(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def tree_columns(documents: DataFrame, mix: Mix) -> dict[str, Column]:
    return {"mix_domain": mix.domain_of(documents["source"]), "mix_lang": documents["lang"],
            "mix_source": documents["source"]}


def weight(level: int, mix: Mix) -> Column:
    table_of = (mix.domains, mix.languages, mix.sources)[level]
    if table_of is NATURAL:
        return F.col("tokens")
    chosen = F.lit(mix.other)
    for name, value in table_of.items():
        chosen = F.when(F.col(LEVELS[level]) == name, F.lit(value)).otherwise(chosen)
    return chosen.cast("long")


def share(children: DataFrame, parent: list[str], child: str) -> DataFrame:
    """Adds ``given`` to rows with ``budget`` (the parent's), ``capacity`` and ``weight``; capacity-bound shares by weight."""
    wide = [F.col(c).cast("decimal(38,0)").alias(c) for c in ("budget", "capacity", "weight")]
    rows = children.select(*[c for c in children.columns if c not in ("budget", "capacity", "weight")], *wide) \
        .withColumn("ratio", F.col("capacity").cast("double") / F.col("weight").cast("double"))
    group = Window.partitionBy(*parent)
    before = group.orderBy("ratio", child).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("decimal(38,0)")

    def so_far(c):
        return F.coalesce(F.sum(c).over(before).cast("decimal(38,0)"), zero)

    rows = rows.withColumn("c_before", so_far("capacity")).withColumn("w_before", so_far("weight")) \
        .withColumn("w_all", F.sum("weight").over(group).cast("decimal(38,0)")) \
        .withColumn("full", F.expr("capacity * (w_all - w_before) <= weight * (budget - c_before)")) \
        .withColumn("c_full", F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(group), zero).cast("decimal(38,0)")) \
        .withColumn("w_full", F.coalesce(F.sum(F.when(F.col("full"), F.col("weight"))).over(group), zero).cast("decimal(38,0)"))
    given = F.when(F.col("full"), F.col("capacity").cast("long")).otherwise(F.expr(
        "(((w_before + weight - w_full) * (budget - c_full)) div (w_all - w_full))"
        " - (((w_before - w_full) * (budget - c_full)) div (w_all - w_full))"))
    return rows.withColumn("given", given).drop("ratio", "c_before", "w_before", "w_all", "full", "c_full", "w_full",
                                                "budget", "capacity", "weight")


def leaf_budgets(leaves: DataFrame, mix: Mix = MIX) -> DataFrame:
    """Rows per leaf (three tree columns, ``tokens``) with ``budget``: the tree pass from the root down."""
    nodes = [leaves.groupBy(*LEVELS[: k + 1]).agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
             .withColumn("weight", weight(k, mix)).where("weight > 0") for k in range(3)]
    # capacities from the leaves up, so that nodes below a refused node count for nothing
    capacity = nodes[2].withColumn("capacity", F.col("tokens") * mix.max_epochs)
    for k in (1, 0):
        sums = capacity.groupBy(*LEVELS[: k + 1]).agg(F.sum("capacity").alias("capacity"))
        nodes[k + 1] = capacity
        capacity = _matched(nodes[k], sums, LEVELS[: k + 1])
    nodes[0] = capacity
    sums = nodes[0].agg(F.sum("capacity")).first()[0] or 0                  # two numbers
    tokens = leaves.agg(F.sum("tokens")).first()[0] or 0
    budget = min(tokens * mix.budget_percent // 100, sums)
    given = share(nodes[0].withColumn("budget", F.lit(budget).cast("long")), [], LEVELS[0])
    for k in (1, 2):
        parents = given.select(*LEVELS[:k], F.col("given").alias("budget"))
        given = share(_matched(nodes[k], parents, LEVELS[:k]), list(LEVELS[:k]), LEVELS[k])
    return given.select(*LEVELS, "tokens", F.col("given").alias("budget"))


def _matched(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Inner join on keys that may be null."""
    renamed = right.select(*[F.col(c).alias(f"r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = [F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in keys]
    return left.join(renamed, on).drop(*[f"r_{c}" for c in keys])


def order_key(epoch: Column, doc_id: Column, mix: Mix) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(mix.seed)), epoch.cast("string"),
                             F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def mix_documents(documents: DataFrame, mix: Mix = MIX, details: bool = True) -> DataFrame:
    """The chosen documents: every column of ``documents``, a row for each epoch a document is chosen in.

    ``details`` adds ``mix_domain``, ``mix_tokens`` and ``mix_epoch`` (from 1).
    """
    columns = documents.columns
    text, doc_id = documents["text"], documents["doc_id"]
    tree = tree_columns(documents, mix)
    light = documents.select(*[c.alias(n) for n, c in tree.items()], doc_id.alias("id"), n_tokens(text).alias("tokens"))
    light = written(light, "mix-tokens")
    leaves = kept(light.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")))
    budgets = leaf_budgets(leaves, mix).select(
        *LEVELS, F.expr("cast(budget div tokens as int)").alias("whole"), F.expr("budget % tokens").alias("rest"))
    budgets = written(budgets, "mix-budgets")

    def ranged(epoch_key: Column) -> Column:
        return F.conv(F.substring(epoch_key, 1, 4), 16, 10).cast("int")

    # the range of order keys in which the last, partial epoch of each leaf ends
    partial = _matched(light, budgets, LEVELS).withColumn(
        "range", ranged(order_key(F.col("whole") + 1, F.col("id"), mix)))
    totals = partial.groupBy(*LEVELS, "range").agg(F.sum("tokens").alias("tokens"), F.first("rest").alias("rest"))
    upto = F.sum("tokens").over(Window.partitionBy(*LEVELS).orderBy("range"))
    ends = totals.withColumn("upto", upto).where("upto - tokens <= rest and rest < upto") \
        .select(*LEVELS, F.col("range").alias("end_range"), (F.col("rest") - F.col("upto") + F.col("tokens")).alias("left"))
    plan = written(_matched(budgets, ends, LEVELS), "mix-plan")

    named = documents.select(*[documents[c].alias(f"in_{i}") for i, c in enumerate(columns)],
                             *[c.alias(n) for n, c in tree.items()], doc_id.alias("mix_id"),
                             n_tokens(text).alias("mix_tokens"))
    rows = _matched(named, plan, LEVELS).withColumn("key", order_key(F.col("whole") + 1, F.col("mix_id"), mix)) \
        .withColumn("range", ranged(F.col("key")))
    epochs = F.expr("whole + if(range < end_range, 1, 0)")
    whole = rows.withColumn("mix_epoch", F.explode(
        F.when(epochs > 0, F.sequence(F.lit(1), epochs)).otherwise(F.array().cast("array<int>"))))
    running = F.sum("mix_tokens").over(Window.partitionBy(*LEVELS).orderBy("key", "mix_id", "mix_tokens")
                                       .rowsBetween(Window.unboundedPreceding, 0))
    last = rows.where("range = end_range").withColumn("run", running).where("run <= left") \
        .withColumn("mix_epoch", F.expr("whole + 1")).drop("run")
    added = ["mix_domain", "mix_tokens", "mix_epoch"] if details else []
    return whole.unionByName(last).select(*[F.col(f"in_{i}").alias(c) for i, c in enumerate(columns)], *added)


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mix_documents(documents).select("doc_id", F.col("mix_domain").alias("domain"), "lang", "source",
                                           F.col("mix_tokens").alias("n_tokens"),
                                           F.col("mix_epoch").cast("long").alias("epoch"))


def mix_sql(documents: str = "documents", mix: Mix = MIX) -> str:
    """DuckDB SQL for the rows of ``op8_mix_sources`` (the domain rule is the production one)."""
    keys = ("domain", "lang", "source")

    def weights(level):
        listed = (mix.domains, mix.languages, mix.sources)[level]
        if listed is NATURAL:
            return "tokens"
        cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in listed.items())
        return f"CASE {keys[level]} {cases} ELSE {mix.other} END"

    def shared(name, source, parent, child):
        by = f"PARTITION BY {', '.join(parent)}" if parent else ""
        prev = f"({by} ORDER BY capacity / CAST(w AS DOUBLE), {child} NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        return f"""
{name}a AS (SELECT *, coalesce(sum(capacity) OVER {prev}, 0) AS cb, coalesce(sum(w) OVER {prev}, 0) AS wb,
                   sum(w) OVER ({by}) AS wa FROM {source}),
{name}b AS (SELECT *, capacity * (wa - wb) <= w * (budget - cb) AS isfull FROM {name}a),
{name}c AS (SELECT *, coalesce(sum(CASE WHEN isfull THEN capacity END) OVER ({by}), 0) AS cf,
                   coalesce(sum(CASE WHEN isfull THEN w END) OVER ({by}), 0) AS wf FROM {name}b),
{name} AS (SELECT * EXCLUDE (budget), CASE WHEN isfull THEN capacity
             ELSE ((wb + w - wf) * (budget - cf)) // (wa - wf) - ((wb - wf) * (budget - cf)) // (wa - wf) END AS given
           FROM {name}c)"""

    def same(a, b, n):
        return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in keys[:n])

    return rf"""
WITH doc AS (
  SELECT doc_id, 'domain' || (crc32_of % 4) AS domain, lang, source, n_tokens FROM (
    SELECT doc_id, lang, source, {crc32_sql("coalesce(source, '')")} AS crc32_of,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens FROM {documents})),
leaf AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS HUGEINT) AS tokens FROM doc GROUP BY ALL HAVING sum(n_tokens) > 0),
n2 AS (SELECT *, CAST({weights(2)} AS HUGEINT) AS w, tokens * {mix.max_epochs} AS capacity FROM leaf),
n1 AS (SELECT *, CAST({weights(1)} AS HUGEINT) AS w FROM (
         SELECT domain, lang, CAST(sum(tokens) AS HUGEINT) AS tokens, CAST(sum(capacity) AS HUGEINT) AS capacity FROM n2 GROUP BY ALL)),
n0 AS (SELECT *, CAST({weights(0)} AS HUGEINT) AS w FROM (
         SELECT domain, CAST(sum(tokens) AS HUGEINT) AS tokens, CAST(sum(capacity) AS HUGEINT) AS capacity FROM n1 GROUP BY ALL)),
root AS (SELECT least(sum(tokens) * {mix.budget_percent} // 100, sum(capacity)) AS budget FROM n0),
i0 AS (SELECT n0.*, budget FROM n0, root),{shared("g0", "i0", [], "domain")},
i1 AS (SELECT n1.*, g0.given AS budget FROM n1 JOIN g0 ON {same("n1", "g0", 1)}),{shared("g1", "i1", ["domain"], "lang")},
i2 AS (SELECT n2.*, g1.given AS budget FROM n2 JOIN g1 ON {same("n2", "g1", 2)}),{shared("g2", "i2", ["domain", "lang"], "source")},
plan AS (SELECT domain, lang, source, given // tokens AS whole, given % tokens AS rest FROM g2),
j AS (SELECT doc.*, whole, rest,
             md5('{mix.seed}:' || CAST(whole + 1 AS VARCHAR) || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS ord
      FROM doc JOIN plan ON {same("doc", "plan", 3)}),
run AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY ord, doc_id, n_tokens
                                      ROWS UNBOUNDED PRECEDING) AS upto FROM j)
SELECT doc_id, domain, lang, source, n_tokens, CAST(epoch AS BIGINT) AS epoch
FROM (SELECT *, unnest(range(1, CAST(whole AS BIGINT) + CASE WHEN upto <= rest THEN 2 ELSE 1 END)) AS epoch FROM run)
"""


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text in DuckDB, bit by bit."""
    table_entry = "list_reduce([c] || range(8), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    entry = table_entry.replace("[c]", "[CAST(xor(acc, b) & 255 AS BIGINT)]")
    return (f"xor(list_reduce([4294967295] || list_transform(string_split({text}, ''), lambda ch: CAST(ascii(ch) AS BIGINT)), "
            f"lambda acc, b: xor(acc >> 8, {entry})), 4294967295)")


OP8_SQL = mix_sql()
