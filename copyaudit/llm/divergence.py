"""Source divergence audit by single-pass in-memory indexing.

1. Each task builds postings (term -> group, occurrences, documents) of a block of texts in memory. When the block is full, it
   is spilled as runs sorted by term, one per hash shard of (lang, source, term); then the next block begins.
2. Each shard merges its runs through a heap into one row per (lang, source, term).
3. Terms in enough documents of their language are kept; counts become smoothed shares ``p`` (``SCALE`` = 1) of each group.
4. Pairs of sources: a term absent from one source has that source's least share there, so sums over such terms come from
   a histogram of shares per source. Only terms that both sources hold need a correction, which is streamed term by term
   and summed per pair. No term is ever compared for a pair that lacks it.
5. Terms that a source uses more than its language: the best ``TOP`` by value through a window with a limit before its shuffle.

All numbers are exact: shares by 38-digit decimals, the rest in 64-bit integers, which the sums fit.

Defined cases: null texts, languages and sources are empty strings; every row is a document, repeated rows too; a text
without terms still makes its group occur; a language without kept terms gives pairs of value 0 and no terms; ties go to
the smaller item by bytes; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from copyaudit.llm.common import kept, table
from copyaudit.llm.runs import (LOWER, RUN_COLUMNS, Numbering, by_shard, byte_table, encode_run, merge_runs, merged_lanes, run_frame,
                                runs_of_shards, split_words, sum_by_key, summed, text_slices, translated)

MIN_DOCS = 3             # documents of its language that a kept term is in
SCALE = 1_000_000_000
TOP = 200
POSTINGS = 2_000_000     # of a block in memory
TERMS = 400_000          # of a block's dictionary
PAIRS = 1 << 20          # pairs of sources corrected at a time

# Letters and all characters above ASCII make up terms; every other byte ends one.
TERM_BYTES = byte_table({b: 32 for b in range(128) if not chr(b).isalpha()} | LOWER)


KEYS = ["term", "lang", "source"]


class Block:
    """Postings of (lang, source) groups and terms: occurrences and documents."""

    def __init__(self):
        self.terms = Numbering()
        self.groups = Numbering()
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, texts: pa.Array, groups: list[tuple[str, str]]) -> None:
        document, words = split_words(translated(texts, TERM_BYTES))
        ids = self.terms.of(words)
        key, count = sum_by_key(document << 32 | ids, np.ones(len(ids), np.int64))
        group = np.array([self.groups[g] for g in groups], np.int64)
        self.parts.append(sum_by_key(group[key >> 32] << 32 | key & 0xFFFFFFFF, count, np.ones(len(key), np.int64)))
        self.size += len(self.parts[-1][0])

    def full(self) -> bool:
        if self.size > POSTINGS:
            self.parts = [sum_by_key(*map(np.concatenate, zip(*self.parts, strict=True)))]
            self.size = len(self.parts[0][0])
        return self.size > POSTINGS // 2 or len(self.terms) > TERMS

    def runs(self, shards: int) -> Iterator[tuple[int, bytes]]:
        """``(shard, run)``: rows (term, lang, source, n, docs) in this order."""
        if not self.parts:
            return
        key, count, documents = sum_by_key(*map(np.concatenate, zip(*self.parts, strict=True)))
        terms, groups = list(self.terms), list(self.groups)
        seeds = np.array([zlib.crc32("\n".join(g).encode()) for g in groups], np.int64)
        hashes = np.array([zlib.crc32(t) for t in terms], np.int64)
        group, term = key >> 32, key & 0xFFFFFFFF
        shard = (hashes[term] * 31 + seeds[group]) % shards
        rank = np.empty(len(terms), np.int64)
        rank[np.array(sorted(range(len(terms)), key=terms.__getitem__), np.int64)] = np.arange(len(terms))
        group_rank = np.empty(len(groups), np.int64)
        group_rank[np.array(sorted(range(len(groups)), key=groups.__getitem__), np.int64)] = np.arange(len(groups))
        order = np.lexsort((group_rank[group], rank[term], shard))
        words = pa.array(terms, pa.binary())
        names = [pa.array([g[i] for g in groups], pa.string()) for i in (0, 1)]
        for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1) if len(order) else []:
            where = pa.array(group[part])
            yield int(shard[part[0]]), encode_run(pa.table({
                "term": words.take(pa.array(term[part])), "lang": names[0].take(where), "source": names[1].take(where),
                "n": count[part], "docs": documents[part]}))


def spilled_runs(documents: DataFrame, shards: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane = TaskContext.get().partitionId()
        block = Block()
        for batch in batches:
            groups = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True))
            for at, texts in text_slices(batch, "text"):
                block.add(texts, groups[at:at + len(texts)])
                if block.full():
                    yield from run_frame((shard, lane, data) for shard, data in block.runs(shards))
                    block = Block()
        yield from run_frame((shard, lane, data) for shard, data in block.runs(shards))

    return documents.mapInArrow(run, RUN_COLUMNS)


def merged_runs(runs: DataFrame) -> DataFrame:
    """Rows ``(term, lang, source, n, docs)``: the runs of each shard merged through a heap."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for *_, blobs in runs_of_shards(batches):
            for rows in (summed(r, KEYS) for r in merge_runs(blobs)):
                rows = rows.set_column(0, "term", rows["term"].combine_chunks().view(pa.string()))
                yield from rows.combine_chunks().to_batches()

    return by_shard(runs).mapInArrow(merge, "term string, lang string, source string, n long, docs long")


def frequencies(documents: DataFrame, shards: int | None = None, min_docs: int = MIN_DOCS) -> DataFrame:
    """Rows ``(lang, source, term, n, total, sources, head)`` of kept terms and the sources that hold them.

    ``total``: occurrences in the language; ``sources``: how many hold the term; ``head``: one row of each term.
    """
    texts = documents.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")),
                             F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    tasks = texts.rdd.getNumPartitions()
    if shards is None:                                           # a shard holds about as much as an input partition
        shards = max(tasks, int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    of_term = Window.partitionBy("lang", "term")
    return merged_runs(merged_lanes(spilled_runs(texts, shards), tasks, KEYS)).select(
        "lang", "source", "term", "n", F.sum("n").over(of_term).alias("total"), F.sum("docs").over(of_term).alias("in_docs"),
        F.count(F.lit(1)).over(of_term).alias("sources"), (F.min("source").over(of_term) == F.col("source")).alias("head")) \
        .where(F.col("in_docs") >= min_docs).drop("in_docs")


def share(n: Column, all_n: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (n + 1) / (all_n + terms))``."""
    wide = (n + F.lit(1)).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", wide, (all_n + terms).cast("decimal(19,0)")).cast("long") + F.lit(1)


def distance(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / q)``; within 64 bits, as shares are at most SCALE + 1."""
    return F.call_function("div", (p - q) * (p - q), q)


def numpy_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def corrections(shares: DataFrame) -> DataFrame:
    """Rows ``(lang, s, t, value)``: what terms that both sources hold add to sums made from least shares."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: list[pa.RecordBatch] = []
        for batch in batches:
            rows = pa.Table.from_batches([*carried, batch])
            size = rows["sources"].to_numpy()
            whole, at = 0, 0
            while at < len(size) and at + size[at] <= len(size):  # once per term
                at += int(size[at])
                whole = at
            yield from corrected(rows.slice(0, whole).combine_chunks())
            carried = rows.slice(whole).combine_chunks().to_batches()

    def corrected(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        if not len(rows):
            return
        lang, source = (rows[c].combine_chunks().dictionary_encode() for c in ("lang", "source"))
        p, least, size = (rows[c].to_numpy() for c in ("p", "least", "sources"))
        where, names = source.indices.to_numpy().astype(np.int64), len(source.dictionary)
        tongue = lang.indices.to_numpy().astype(np.int64)
        heads = np.zeros(len(rows), np.int64)
        at = 0
        while at < len(rows):
            heads[at:at + size[at]] = at
            at += int(size[at])
        ends = np.cumsum(size)
        first = 0
        while first < len(rows):
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + PAIRS, side="right")))
            i = np.repeat(np.arange(first, last), size[first:last])
            j = heads[i] + np.arange(len(i)) - np.repeat(np.cumsum(size[first:last]) - size[first:last], size[first:last])
            value = numpy_distance(p[i], p[j]) - numpy_distance(p[i], least[j]) \
                - numpy_distance(least[i], p[j]) + numpy_distance(least[i], least[j])
            other = i != j
            key, total = sum_by_key(((tongue[i] * names + where[i]) * names + where[j])[other], value[other])
            yield pa.RecordBatch.from_arrays(
                [lang.dictionary.take(pa.array(key // names // names)), source.dictionary.take(pa.array(key // names % names)),
                 source.dictionary.take(pa.array(key % names)), pa.array(total)], names=["lang", "s", "t", "value"])
            first = last

    return shares.where("sources > 1").select("lang", "term", "source", "p", "least", "sources") \
        .repartition("lang", "term").sortWithinPartitions("lang", "term").drop("term") \
        .mapInArrow(run, "lang string, s string, t string, value long")


def divergences(documents: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, shards: int | None = None) -> DataFrame:
    """Rows ``(lang, source, part, item, value, rank)``: other sources by divergence, and terms by contribution."""
    found = kept(frequencies(documents, shards, min_docs))
    occurring = documents.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    of_lang = found.where("head").groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_n"))
    of_group = found.groupBy("lang", "source").agg(F.sum("n").alias("group_n"), F.count(F.lit(1)).alias("held"))
    groups = kept(occurring.join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left").select(
        "lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("group_n", "held", "terms", "lang_n")))
        .withColumn("least", F.when(F.col("terms") > 0, share(F.lit(0), F.col("group_n"), F.col("terms")))))
    shares = kept(found.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "sources", "least", share(F.col("n"), F.col("group_n"), F.col("terms")).alias("p"),
        share(F.col("total"), F.col("lang_n"), F.col("terms")).alias("q")))

    more = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    by_term = more.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top) \
        .select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")

    wide = lambda c: c.cast("decimal(38,0)").alias("value")
    own = groups.select("lang", F.col("source").alias("s"), F.col("least").alias("s_least"), F.col("held").alias("s_held"), "terms")
    other = groups.select("lang", F.col("source").alias("t"), F.col("least").alias("t_least"), F.col("held").alias("t_held"))
    absent = own.join(other, "lang").where("s <> t").select(
        "lang", "s", "t", wide(F.coalesce((F.col("terms") - F.col("s_held") - F.col("t_held")).cast("decimal(19,0)")
                                          * distance(F.col("s_least"), F.col("t_least")).cast("decimal(19,0)"), F.lit(0))))
    histogram = shares.groupBy("lang", F.col("source").alias("s"), "p").agg(F.count(F.lit(1)).alias("m"))
    one_sided = histogram.join(other.where("t_least IS NOT NULL"), "lang").where("s <> t").groupBy("lang", "s", "t").agg(
        *(F.sum(F.col("m").cast("decimal(19,0)") * d.cast("decimal(19,0)")).alias(name)
          for name, d in (("there", distance(F.col("p"), F.col("t_least"))), ("back", distance(F.col("t_least"), F.col("p"))))))
    sums = absent.unionByName(one_sided.select("lang", "s", "t", wide(F.col("there")))) \
        .unionByName(one_sided.select("lang", F.col("t").alias("s"), F.col("s").alias("t"), wide(F.col("back")))) \
        .unionByName(corrections(shares).select("lang", "s", "t", wide(F.col("value"))))
    pairs = sums.groupBy("lang", F.col("s").alias("source"), F.col("t").alias("item")).agg(F.sum("value").cast("long").alias("value"))
    by_pair = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return by_pair.unionByName(by_term)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergences(table(spark, sf_dir, "documents"))


OP12_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
occurrences AS (
  SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
terms AS (
  SELECT lang, term, count(*) AS n FROM occurrences GROUP BY lang, term HAVING count(DISTINCT id) >= {MIN_DOCS}),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM terms GROUP BY lang),
grps AS (SELECT DISTINCT lang, source FROM docs),
counts AS (
  SELECT lang, source, term, count(*) AS n FROM occurrences SEMI JOIN terms USING (lang, term) GROUP BY ALL),
sizes AS (
  SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS n FROM grps LEFT JOIN counts USING (lang, source) GROUP BY lang, source),
shares AS (
  SELECT s.lang, s.source, t.term, coalesce(c.n, 0) AS n,
         1 + ({SCALE}::HUGEINT * (coalesce(c.n, 0) + 1)) // (s.n + l.v) AS p, 1 + ({SCALE}::HUGEINT * (t.n + 1)) // (l.n + l.v) AS q
  FROM sizes s JOIN langs l USING (lang) JOIN terms t USING (lang)
  LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = t.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value
  FROM grps a JOIN grps b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
             FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
             GROUP BY ALL) x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
