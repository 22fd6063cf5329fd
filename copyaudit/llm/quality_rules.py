"""Quality rules with thresholds learned from mergeable quantile sketches.

Each document gets integer measures (``document_measures``). A sketch holds, per (lang, source, measure), counts of
log-scaled buckets: values keep their six leading bits, so a bucket is within 1/32 of its members. Adding counts merges
sketches exactly, in any order, so one set of counts serves (lang, source), its language and the whole corpus. Each
group's sketch is merged with those of its language and of the corpus, scaled to the weight of ``PRIOR`` documents each: the
more documents a group has, the more its fences are its own, without a size at which the rule changes. The
quartiles of a sketch give fences, and documents outside the fences of their group are rejected. All of it is DataFrame
code; the sketch is a partial aggregate, so a source with a third of the rows costs the same as any other.

Defined cases: a null text has no words and fails the base rule; a null lang or source is a value of its own; other columns are ignored; repeated rows are judged one by one; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from copyaudit.llm.common import WORD, kept, let, table, words


@dataclass(frozen=True)
class Fence:
    """``spread`` quartile ranges beyond the quartiles; a range counts as ``least`` at least. ``low``: also a lower fence."""

    least: int
    spread: int = 3
    low: bool = False


# Measures, as integers: word length in hundredths, the others per thousand words, lines or characters.
FENCES = {
    "word_length": Fence(least=100, low=True),
    "symbols": Fence(least=50),
    "dup_lines": Fence(least=200),
    "repeats": Fence(least=100),
    "capitals": Fence(least=50),
}
PRIOR = 50               # documents that a language's sketch, and the corpus's, count for in each group
UNIT = 1000              # weight of a document, so that scaled counts stay whole numbers
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def repeated_window_words(tokens: Column) -> Column:
    """Words inside a 3-word window that occurs twice or more in ``tokens``, the first occurrence included."""
    n = F.size(tokens)
    windows = F.transform(F.sequence(F.lit(0), n - 3),
                          lambda i: F.xxhash64(F.get(tokens, i), F.get(tokens, i + 1), F.get(tokens, i + 2)))

    def covered(hashes):
        keyed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        starts = let(keyed, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, k: (x["h"] == F.get(s, k + 1)["h"]) | (x["h"] == F.get(s, k - 1)["h"])),
            lambda x: x["i"])))
        return let(starts, lambda s: F.aggregate(
            F.transform(s, lambda at, k: F.least(F.lit(3), F.coalesce(F.get(s, k + 1) - at, F.lit(3)))),
            F.lit(0), lambda a, b: a + b))

    counted = let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))
    return F.when(n < 3, F.lit(0)).otherwise(counted)


def document_measures(documents: DataFrame) -> DataFrame:
    """Rows ``(doc_id, lang, source)`` with the counts of each whole text and the base verdict."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))

    def counts(w):
        return F.struct(F.size(w).cast("long").alias("n_words"),
                        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                        repeated_window_words(w).cast("long").alias("n_repeat_words"))

    def line_counts(x):
        return F.struct(F.size(x).cast("long").alias("n_lines"),
                        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))

    chars = F.length(text)
    got = documents.select(
        "doc_id", "lang", "source", let(words(F.col("text")), counts).alias("w"), let(lines, line_counts).alias("x"),
        (chars - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (chars - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))).cast("long").alias("n_capitals"))
    flat = got.select("doc_id", "lang", "source", "w.n_words", "w.word_chars", "n_symbols", "x.n_dup_lines",
                      "w.n_repeat_words", "x.n_lines", "n_capitals")
    return flat.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                           | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


MEASURES = {
    "word_length": "word_chars * 100 div n_words",
    "symbols": "n_symbols * 1000 div n_words",
    "dup_lines": "n_dup_lines * 1000 div n_lines",
    "repeats": "n_repeat_words * 1000 div n_words",
    "capitals": "n_capitals * 1000 div word_chars",
}


def sketch(measured: DataFrame) -> DataFrame:
    """Counts per (lang, source, measure, bucket) over all documents with a word."""
    values = F.array(*[F.struct(F.lit(m).alias("measure"), F.expr(e).alias("v")) for m, e in MEASURES.items()])
    rows = measured.where("n_words > 0").select("lang", "source", F.explode(values).alias("x")) \
        .select("lang", "source", "x.measure", "x.v")
    low_bits = F.expr("greatest(length(bin(v)) - 6, 0)")
    return rows.withColumn("e", low_bits.cast("int")) \
        .withColumn("bucket", F.expr("shiftleft(shiftright(v, e), e)")) \
        .groupBy("lang", "source", "measure", "bucket").agg(F.count(F.lit(1)).alias("cnt"))


def scaled(sketches: DataFrame, groups: DataFrame, keys: list[str], prior: int) -> DataFrame:
    """The merged sketch of each value of ``keys``, in the weight of ``prior`` documents, for every group below it."""
    merged = sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("cnt").alias("cnt"))
    level = merged.withColumn("docs", F.sum("cnt").over(Window.partitionBy(*keys, "measure"))) \
        .select(*[F.col(k).alias(f"of_{k}") for k in [*keys, "measure"]], "bucket", "cnt", "docs")
    same = [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys] + [F.col("measure") == F.col("of_measure")]
    return groups.join(level, same).select("lang", "source", "measure", "bucket",
                                           F.expr(f"{prior * UNIT} * cnt div docs").alias("weight"))


def thresholds(sketches: DataFrame, prior: int = PRIOR, rules: dict[str, Fence] = FENCES) -> DataFrame:
    """One row per (lang, source): a low and a high column per measure."""
    groups = sketches.select("lang", "source", "measure").distinct()
    weights = sketches.select("lang", "source", "measure", "bucket", (F.col("cnt") * UNIT).alias("weight")) \
        .unionByName(scaled(sketches, groups, ["lang"], prior)).unionByName(scaled(sketches, groups, [], prior)) \
        .groupBy("lang", "source", "measure", "bucket").agg(F.sum("weight").alias("weight"))
    group = Window.partitionBy("lang", "source", "measure")
    ranked = weights.withColumn("upto", F.sum("weight").over(group.orderBy("bucket"))) \
        .withColumn("whole", F.sum("weight").over(group))
    quartile = {q: F.min(F.when(4 * F.col("upto") >= q * F.col("whole"), F.col("bucket"))) for q in (1, 3)}
    out = ranked.groupBy("lang", "source", "measure").agg(quartile[1].alias("q1"), quartile[3].alias("q3"))
    names = list(rules)
    pick = {f: F.element_at(F.create_map(*[F.lit(x) for m in names for x in (m, getattr(rules[m], f))]), F.col("measure"))
            for f in ("least", "spread", "low")}
    reach = pick["spread"] * F.greatest(F.col("q3") - F.col("q1"), pick["least"])
    flat = out.select("lang", "source", "measure", (F.col("q3") + reach).alias("high"),
                      F.when(pick["low"], F.col("q1") - reach).otherwise(F.lit(-1)).alias("low"))
    return flat.groupBy("lang", "source").agg(*[
        F.max(F.when(F.col("measure") == m, F.col(side))).alias(f"{m}_{side}") for m in rules for side in ("low", "high")])


def judge(documents: DataFrame, prior: int = PRIOR) -> DataFrame:
    """Every document with its counts, the base verdict, ``kept`` and the rules it failed."""
    measured = kept(document_measures(documents))
    limits = thresholds(kept(sketch(measured)), prior).withColumnRenamed("lang", "t_lang") \
        .withColumnRenamed("source", "t_source")
    joined = measured.join(limits, measured.lang.eqNullSafe(F.col("t_lang"))
                           & measured.source.eqNullSafe(F.col("t_source")), "left")
    failed = F.concat_ws(",", *[
        F.when(~F.expr(e).between(F.col(f"{m}_low"), F.col(f"{m}_high")), F.lit(m)) for m, e in MEASURES.items()])
    return joined.withColumn("failed_rules", F.when(F.col("n_words") > 0, failed).otherwise(F.lit(""))) \
        .withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == ""))


OP1_COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
               "failed_rules"]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(*OP1_COLUMNS)


def _sql() -> str:
    sql = {m: e.replace(" div ", " // ") for m, e in MEASURES.items()}
    least = " ".join(f"WHEN '{m}' THEN {f.least}" for m, f in FENCES.items())
    low = ", ".join(f"'{m}'" for m, f in FENCES.items() if f.low)
    parts = f"""
m1 AS (SELECT *, sum(cnt) OVER (PARTITION BY lang, measure) AS docs
       FROM (SELECT lang, measure, bucket, sum(cnt) AS cnt FROM sk GROUP BY ALL)),
m2 AS (SELECT *, sum(cnt) OVER (PARTITION BY measure) AS docs
       FROM (SELECT measure, bucket, sum(cnt) AS cnt FROM sk GROUP BY ALL)),
grp AS (SELECT DISTINCT lang, source, measure FROM sk),
m0 AS (SELECT lang, source, measure, bucket, sum(weight) AS weight FROM (
         SELECT lang, source, measure, bucket, cnt * {UNIT} AS weight FROM sk
         UNION ALL SELECT g.lang, g.source, g.measure, bucket, {PRIOR * UNIT} * cnt // docs
         FROM grp g JOIN m1 ON g.lang IS NOT DISTINCT FROM m1.lang AND g.measure = m1.measure
         UNION ALL SELECT g.lang, g.source, g.measure, bucket, {PRIOR * UNIT} * cnt // docs
         FROM grp g JOIN m2 ON g.measure = m2.measure) GROUP BY ALL),
r0 AS (SELECT *, sum(weight) OVER (PARTITION BY lang, source, measure ORDER BY bucket) AS upto,
              sum(weight) OVER (PARTITION BY lang, source, measure) AS whole FROM m0),
q0 AS (SELECT lang, source, measure, min(CASE WHEN 4 * upto >= whole THEN bucket END) AS q1,
              min(CASE WHEN 4 * upto >= 3 * whole THEN bucket END) AS q3 FROM r0 GROUP BY ALL),
f0 AS (SELECT *, q3 + 3 * greatest(q3 - q1, CASE measure {least} END) AS high,
              CASE WHEN measure IN ({low}) THEN q1 - 3 * greatest(q3 - q1, CASE measure {least} END) ELSE -1 END AS low
       FROM q0)"""
    return rf"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text,
                  list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
           FROM documents),
n AS (SELECT *, row_number() OVER () AS rid FROM d),
w AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS k
      FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM n WHERE len(ws) >= 3)),
g AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM w) WHERE c > 1),
rep AS (SELECT rid, sum(least(3, coalesce(nxt - i, 3))) AS n_repeat_words
        FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM g) GROUP BY rid),
b AS (SELECT n.rid, doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(len(ls) AS BIGINT) AS n_lines,
             CAST(length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g')) AS BIGINT) AS n_capitals
      FROM n LEFT JOIN rep ON n.rid = rep.rid),
x AS ({" UNION ALL ".join(f"SELECT rid, lang, source, '{m}' AS measure, {e} AS v FROM b WHERE n_words > 0" for m, e in sql.items())}),
sk AS (SELECT lang, source, measure,
              (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS bucket, count(*) AS cnt
       FROM x GROUP BY ALL),{parts},
bad AS (SELECT x.rid, x.measure FROM x
        JOIN f0 ON x.lang IS NOT DISTINCT FROM f0.lang AND x.source IS NOT DISTINCT FROM f0.source AND x.measure = f0.measure
        WHERE v > f0.high OR v < f0.low),
rules AS (SELECT rid, string_agg(measure, ',' ORDER BY list_position({list(FENCES)}, measure)) AS failed_rules
          FROM bad GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AND failed_rules IS NULL AS kept,
       coalesce(failed_rules, '') AS failed_rules
FROM b LEFT JOIN rules ON b.rid = rules.rid
"""


OP1_SQL = _sql()
