import re
from collections import Counter

from pyspark.sql import functions as F

from copyaudit.llm import quality_rules as q
from copyaudit.llm.common import table, words

SF = "/root/testdata/sf0.001"


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = {g for g, n in Counter(grams).items() if n > 1}
    covered = {i + k for i, g in enumerate(grams) if g in often for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_measures_against_brute_force(spark, awkward):
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang", "source") \
        .unionByName(awkward.select("doc_id", "text", "lang", "source"))
    rows = q.document_measures(docs).select("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted(map(tuple, rows.collect())) == sorted(brute(r.text) for r in docs.select("text").collect())


def test_sketches_merge_by_addition(spark):
    measured = q.document_measures(table(spark, SF, "documents"))
    whole = {(r.measure, r.bucket): r.cnt for r in q.sketch(measured).groupBy("measure", "bucket")
             .agg(F.sum("cnt").alias("cnt")).collect()}
    parts = [q.sketch(measured.where(F.col("doc_id") % 3 == k)) for k in range(3)]
    merged = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("measure", "bucket").agg(F.sum("cnt").alias("cnt"))
    assert whole == {(r.measure, r.bucket): r.cnt for r in merged.collect()}


def test_bucket_is_close_to_the_value(spark):
    for v, bucket in [(0, 0), (1, 1), (63, 63), (64, 64), (65, 64), (1000, 992), (10 ** 9, 989855744)]:
        low = max(v.bit_length() - 6, 0)
        assert (v >> low) << low == bucket and v - bucket <= v / 32


def test_thresholds_follow_the_source(spark):
    clean = [(i, " ".join(f"word{i}x{k}" for k in range(60)), "en", "plain") for i in range(150)]
    signs = [(1000 + i, " ".join(f"a{i}x{k} # #" for k in range(60)), "en", "signs") for i in range(150)]
    odd = [(5000, " ".join(f"b{k} # #" for k in range(60)), "en", "plain")]
    docs = spark.createDataFrame(clean + signs + odd, "doc_id long, text string, lang string, source string")
    refused = {r.doc_id for r in q.judge(docs).where("not kept").collect()}
    assert refused == {5000}                    # signs are usual in one source and odd in the other


def test_awkward_rows(spark, awkward, nothing):
    rows = q.judge(awkward).collect()
    assert len(rows) == awkward.count() and all(r.kept is not None for r in rows)
    assert all(r.base_failed and r.n_words == 0 for r in rows if r.doc_id in (2, 3, 4))
    assert q.judge(nothing).count() == 0
    assert awkward.where("doc_id = 2").select(F.size(words(F.col("text")))).first()[0] == 0


def brute_fences(values, lang, source, measure):
    """Quartiles of the weighted buckets of one group, merged with its language and the corpus, with Python numbers."""
    rule, weights = q.FENCES[measure], Counter()
    for part, weight in ((values[lang, source], None), (sum((v for k, v in values.items() if k[0] == lang), []), q.PRIOR),
                         (sum(values.values(), []), q.PRIOR)):
        counts = Counter((v >> max(v.bit_length() - 6, 0)) << max(v.bit_length() - 6, 0) for v in part)
        for bucket, n in counts.items():
            weights[bucket] += n * q.UNIT if weight is None else weight * q.UNIT * n // len(part)
    upto, quartile = 0, {}
    for bucket in sorted(weights):
        upto += weights[bucket]
        for k in (1, 3):
            if 4 * upto >= k * sum(weights.values()):
                quartile.setdefault(k, bucket)
    reach = rule.spread * max(quartile[3] - quartile[1], rule.least)
    return quartile[1] - reach if rule.low else -1, quartile[3] + reach


def test_fences_of_groups_of_every_size_against_brute_force(spark):
    import random
    rng, rows = random.Random(4), []
    sizes = {("en", "a"): 1, ("en", "b"): 99, ("en", "c"): 100, ("en", "d"): 700, ("fr", "a"): 3, (None, None): 2}
    for (lang, source), n in sizes.items():
        usual = rng.randint(1, 30)
        rows += [(len(rows) + i, " ".join(["w#" * rng.randint(1, usual) for _ in range(rng.randint(1, 20))]), lang, source) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    measured = q.document_measures(docs)
    values = {}
    for r in measured.select("lang", "source", F.expr(q.MEASURES["symbols"]).alias("v")).collect():
        values.setdefault((r.lang, r.source), []).append(r.v)
    limits = {(r.lang, r.source): (r.symbols_low, r.symbols_high) for r in q.thresholds(q.sketch(measured)).collect()}
    assert limits == {k: brute_fences(values, *k, "symbols") for k in sizes}
    assert len(set(limits.values())) > 3
