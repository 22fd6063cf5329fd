"""Phrase collocations counted in HAT-tries.

1. Words are counted per language. Every word gets a hash of its language and itself; its salt and width (48 bits if they
   do, else 64) are such that all words of the corpus get different values, so the hashes are exact names.
2. Each task walks the whole texts. At each word the window of up to four words that follow within its piece goes into a
   trie: a shallow trie over word numbers whose leaves are hash containers of the rest of the window; a container that
   grows too large bursts into a node with smaller containers. A window counts all phrases that begin it, so a phrase's
   frequency is the sum below its trie node. When the trie is full, its largest subtrees are spilled whole as sorted runs,
   one per prefix partition.
3. Each partition merges its runs, sums every level of the prefix tree and keeps what is frequent enough.
4. Cuts, the drop of phrases inside longer ones and the ranks are joins and windows on the frequent phrases.

A window ends before a word that is too rare to be in any phrase. The words are looked up in a bit table of fixed size,
which may let rare words pass and so costs time at most. A prefix partition holds the phrases of the same first two words;
prefixes of two very frequent words are dealt by three words, and their two-word counts summed afterwards.

Defined cases: a null text is empty, a null language is ``und``; repeated rows count each; ties go by score, frequency and
the phrase's bytes; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import count as numbers_from

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from copyaudit.llm.common import kept, table
from copyaudit.llm.runs import (LOWER, RUN_COLUMNS, Numbering, by_shard, byte_table, encode_run, merge_runs, merged_lanes, run_frame,
                                runs_of_shards, split_words, sum_by_key, text_slices, translated)

LEAST = 30               # occurrences of a phrase
LONGEST = 4              # words of a phrase; a window is packed into ``BITS`` bits a word
TOP = 2_000
COVER = 80               # per cent of a phrase's occurrences that lie in a longer one, to drop it
UNKNOWN = "und"
BITS = 21
BURST = 1 << 15          # entries of a container
ENTRIES = 500_000        # entries of a task's tries
WORDS = 400_000          # words a task numbers; below 2 ** BITS
TABLE_BITS = 25          # bits, as a power of two, of the table of frequent words
HOT = 4                  # a word is hot with one in HOT * partitions of all words
HASH_SEED = 42
WIDTHS = (48, 48, 64)    # bits of a word's name, tried one after the other; the last one with ever new salts

# A piece ends at . , ; : ! ? and line breaks; words are between spaces and tabs.
PIECE_BYTES = byte_table({b: 10 for b in b".,;:!?\n\x0b\x0c\r"} | {9: 32} | LOWER)


def piece_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words in order, and for each the number of its piece."""
    pieces = pc.split_pattern(translated(texts, PIECE_BYTES), b"\n").flatten()
    return split_words(pieces)


def lang_slices(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
    """Texts of one language, a bounded number of bytes at a time."""
    langs = batch.column("lang")
    for lang in langs.unique().to_pylist():
        of_lang = batch.filter(pc.equal(langs, lang))
        for _, texts in text_slices(of_lang, "text"):
            yield lang, texts


def word_counts(texts: DataFrame) -> DataFrame:
    """Rows ``(lang, word, f)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, words in counts.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(words), pa.string()), pa.array(list(words), pa.binary()).view(pa.string()),
                     pa.array(list(words.values()), pa.int64())], names=["lang", "word", "f"])
            counts.clear()

        for batch in batches:
            for lang, texts in lang_slices(batch):
                _, words = piece_words(texts)
                found = words.value_counts()
                of_lang = counts.setdefault(lang, Counter())
                for word, n in zip(found.field("values").to_pylist(), found.field("counts").to_pylist(), strict=True):
                    of_lang[word] += n
                if sum(map(len, counts.values())) > WORDS:
                    yield from out()
        yield from out()

    return texts.mapInArrow(run, "lang string, word string, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))


class HatTrie:
    """Counts of windows: a trie over word numbers whose leaves are hash containers of what follows.

    A window is its first word and the rest packed into ``bits`` bits, ``BITS`` a word, zero where it ends.
    """

    def __init__(self, bits: int = (LONGEST - 1) * BITS):
        self.bits = bits
        self.nodes: dict[int, Counter | HatTrie] = {}
        self.size = 0

    def add(self, first: np.ndarray, rest: np.ndarray, counts: np.ndarray | None = None) -> None:
        if not len(first):
            return
        order = np.argsort(first, kind="stable")
        first, rest = first[order], rest[order]
        heads = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
        ends = np.append(heads[1:], len(first))
        keys = rest.tolist()
        values = None if counts is None else counts[order]
        for word, a, b in zip(first[heads].tolist(), heads.tolist(), ends.tolist(), strict=True):
            node = self.nodes.get(word)
            if node is None:
                node = self.nodes[word] = Counter()
            self.size -= node_size(node)
            if isinstance(node, HatTrie):
                node.add_packed(rest[a:b], None if values is None else values[a:b])
            else:
                node.update(keys[a:b] if values is None else dict(zip(keys[a:b], values[a:b].tolist(), strict=True)))
                if len(node) > BURST and self.bits > BITS:
                    node = self.nodes[word] = self.burst(node)
            self.size += node_size(node)

    def add_packed(self, windows: np.ndarray, counts: np.ndarray | None = None) -> None:
        self.add(windows >> self.bits, windows & ((1 << self.bits) - 1), counts)

    def burst(self, container: Counter) -> HatTrie:
        node = HatTrie(self.bits - BITS)
        node.add_packed(np.fromiter(container, np.int64, len(container)), np.fromiter(container.values(), np.int64, len(container)))
        return node

    def entries(self, nodes: list[tuple[int, Counter | HatTrie]] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First words, packed rests and counts of all windows, or of those below the given nodes."""
        firsts, rests, counts = [], [], []
        for word, node in self.nodes.items() if nodes is None else nodes:
            if isinstance(node, HatTrie):
                first, rest, n = node.entries()
                rest = first << node.bits | rest
            else:
                rest, n = np.fromiter(node, np.int64, len(node)), np.fromiter(node.values(), np.int64, len(node))
            firsts.append(np.full(len(rest), word, np.int64))
            rests.append(rest)
            counts.append(n)
        return tuple(np.concatenate(x) if x else np.empty(0, np.int64) for x in (firsts, rests, counts))

    def take_largest(self, share: float) -> list[tuple[int, Counter | HatTrie]]:
        """Removes whole subtrees, the largest first, that hold at least ``share`` of all entries."""
        taken, goal = [], share * self.size
        for word in sorted(self.nodes, key=lambda w: -node_size(self.nodes[w])):
            if goal <= 0:
                break
            node = self.nodes.pop(word)
            goal -= node_size(node)
            self.size -= node_size(node)
            taken.append((word, node))
        return taken


def node_size(node: Counter | HatTrie) -> int:
    return node.size if isinstance(node, HatTrie) else len(node)


class Frequent(dict):
    """Numbers a language's words whose bit is set in the table; 0 for the others. ``hashes[number]`` names the word."""

    def __init__(self, lang: str, salt: str, width: int, bits: np.ndarray):
        self.seed, self.salt, self.bits = xxhash.xxh64_intdigest(lang, HASH_SEED), salt.encode(), bits
        self.mask = (1 << width) - 1
        self.hashes = [0]

    def __missing__(self, word: bytes) -> int:
        name = xxhash.xxh64_intdigest(self.salt + word, self.seed) & self.mask
        at = name & ((1 << TABLE_BITS) - 1)
        known = self.bits[at >> 6] >> np.uint64(at & 63) & np.uint64(1)
        if known:
            self.hashes.append(name)
        self[word] = n = len(self.hashes) - 1 if known else 0
        return n

    of = Numbering.of


class Windows:
    """One language's words and trie in a task."""

    def __init__(self, lang: str, salt: str, width: int, bits: np.ndarray):
        self.words = Frequent(lang, salt, width, bits)
        self.trie = HatTrie()

    def add(self, texts: pa.Array) -> None:
        piece, words = piece_words(texts)
        ids = self.words.of(words)
        after = []                                               # the words that follow, 0 from the window's end on
        inside = ids > 0
        for k in range(1, LONGEST):
            nxt = np.zeros(len(ids), np.int64)
            nxt[:-k] = np.where(piece[k:] == piece[:-k], ids[k:], 0) if len(ids) > k else 0
            nxt[~inside] = 0
            inside = nxt > 0
            after.append(nxt)
        two = (ids > 0) & (after[0] > 0)                         # one word alone is no phrase
        rest = np.zeros(int(two.sum()), np.int64)
        for nxt in after:
            rest = rest << BITS | nxt[two]
        self.trie.add(ids[two], rest)

    def take_largest(self, share: float) -> list[np.ndarray]:
        """Removes the largest subtrees: the names of the windows' words, column by column, and the counts."""
        first, rest, n = self.trie.entries(self.trie.take_largest(share))
        names, mask = np.array(self.words.hashes, np.uint64), (1 << BITS) - 1
        return [names[first], *(names[rest >> BITS * k & mask] for k in reversed(range(LONGEST - 1))), n]


def spilled(taken: list[list[np.ndarray]], partitions: int, hot: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """``(prefix partition, run)`` of the subtrees taken from the tries of all languages, rows sorted by the words' names."""
    *h, n = (np.concatenate(x) for x in zip(*taken, strict=True))
    deeper = np.where(is_hot(h, hot), h[2] * np.uint64(17), np.uint64(0))
    part = (h[0] * np.uint64(31) + h[1] + deeper >> np.uint64(8)) % np.uint64(partitions)
    signed = [x.view(np.int64) for x in h]
    order = np.lexsort((signed[1], signed[0], part))
    for rows in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
        if len(rows):
            yield int(part[rows[0]]), encode_run(pa.table({c: x[rows] for c, x in zip(NAMES, signed, strict=True)} | {"n": n[rows]}))


NAMES = [f"h{k + 1}" for k in range(LONGEST)]


def is_hot(h: list[np.ndarray], hot: np.ndarray) -> np.ndarray:
    return np.isin(h[0], hot) & np.isin(h[1], hot)


def spilled_runs(texts: DataFrame, salt: str, width: int, bits, hot, partitions: int) -> DataFrame:
    """``bits``, ``hot``: broadcast arrays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane = TaskContext.get().partitionId()
        found: dict[str, Windows] = {}

        def spill(tries: list[Windows], share: float) -> Iterator[pa.RecordBatch]:
            if tries:
                yield from run_frame((part, lane, data) for part, data
                                     in spilled([w.take_largest(share) for w in tries], partitions, hot.value))

        for batch in batches:
            for lang, part in lang_slices(batch):
                if lang not in found:
                    found[lang] = Windows(lang, salt, width, bits.value)
                windows = found[lang]
                windows.add(part)
                if sum(w.trie.size for w in found.values()) > ENTRIES:
                    yield from spill(list(found.values()), 0.5)
                if len(windows.words) > WORDS:                   # numbers are used up: begin anew
                    yield from spill([windows], 1)
                    del found[lang]
        yield from spill(list(found.values()), 1)

    return texts.mapInArrow(run, RUN_COLUMNS)


PHRASES = ", ".join(f"{c} long" for c in NAMES) + ", a long, whole boolean"


def counted_phrases(runs: DataFrame, hot, least: int) -> DataFrame:
    """Rows ``(h1 .. h4, a, whole)``: phrases of two words or more; those that are not whole are parts of one count."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for *_, blobs in runs_of_shards(batches):
            for rows in merge_runs(blobs):
                h, n = [rows[c].to_numpy() for c in NAMES], rows["n"].to_numpy()
                for words in range(2, LONGEST + 1):
                    there = h[words - 1] != 0
                    order = np.lexsort([x[there] for x in reversed(h[:words])])
                    h, n = [x[there][order] for x in h], n[there][order]
                    if not len(n):
                        break
                    new = np.zeros(len(n), bool)
                    new[0] = True
                    for x in h[:words]:
                        new[1:] |= x[1:] != x[:-1]
                    heads = np.flatnonzero(new)
                    total = np.add.reduceat(n, heads)
                    split = is_hot([x[heads].view(np.uint64) for x in h[:2]], hot.value) & (words == 2)
                    out = heads[(total >= least) | split]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x[out] if k < words else np.zeros(len(out), np.int64)) for k, x in enumerate(h)]
                        + [pa.array(total[(total >= least) | split]), pa.array(~split[(total >= least) | split])],
                        names=[*NAMES, "a", "whole"])
                    # longer phrases of a rare prefix are rare
                    left = np.repeat((total >= least) | split, np.diff(np.append(heads, len(n))))
                    h, n = [x[left] for x in h], n[left]

    found = kept(by_shard(runs).mapInArrow(merge, PHRASES))
    parts = found.where("NOT whole").groupBy(*NAMES).agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    return found.where("whole").drop("whole").unionByName(parts)


def named(words: DataFrame) -> tuple[DataFrame, str, int]:
    """The words with ``h``, their different names, and the salt and width of the names."""
    for attempt in numbers_from():
        salt, width = str(attempt), WIDTHS[min(attempt, len(WIDTHS) - 1)]
        name = F.xxhash64("lang", F.concat(F.lit(salt), "word"))
        out = words.withColumn("h", name if width == 64 else name.bitwiseAND(F.lit((1 << width) - 1)))
        if out.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR h = 0").isEmpty():
            return out, salt, width


def shifted(first: int, size: int) -> list:
    """The names of ``size`` words of a phrase from the ``first`` on, filled up with zeros."""
    return [F.col(NAMES[first + k]) if k < size else F.lit(0).cast("long") for k in range(LONGEST)]


def keyed(columns: list, prefix: str) -> list:
    return [c.alias(f"{prefix}{k + 1}") for k, c in enumerate(columns)]


def phrase_scores(phrases: DataFrame, words: DataFrame, cover: int) -> DataFrame:
    """Phrases that no longer one covers, with their lowest-scoring cut: ``(h1 .. h4, size, a, l, r, score)``."""
    sized = phrases.withColumn("size", sum((F.col(c) != 0).cast("int") for c in NAMES))
    inner = None
    for size in range(3, LONGEST + 1):
        for part in range(2, size):
            for first in range(size - part + 1):
                rows = sized.where(F.col("size") == size).select(*keyed(shifted(first, part), "h"), "a")
                inner = rows if inner is None else inner.unionByName(rows)
    longer = inner.groupBy(*NAMES).agg(F.max("a").alias("longer"))
    left = sized.join(longer, NAMES, "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * cover))

    zero = F.lit(0).cast("long")
    known = phrases.unionByName(words.select(F.col("h").alias("h1"), *(zero.alias(c) for c in NAMES[1:]), F.col("f").alias("a")))
    cuts = None
    for size in range(2, LONGEST + 1):
        for k in range(1, size):
            rows = left.where(F.col("size") == size).select(*NAMES, "size", "a", F.lit(k).alias("k"), *keyed(shifted(0, k), "x"),
                                                            *keyed(shifted(k, size - k), "y"))
            cuts = rows if cuts is None else cuts.unionByName(rows)
    for side, name in (("x", "l"), ("y", "r")):
        counts = known.select(*(F.col(c).alias(f"{side}{i + 1}") for i, c in enumerate(NAMES)), F.col("a").alias(name))
        cuts = cuts.join(counts, [f"{side}{i + 1}" for i in range(LONGEST)])
    wide = F.col("a").cast("decimal(19,0)") * F.lit(2_000_000).cast("decimal(10,0)")
    score = F.call_function("div", wide, (F.col("l") + F.col("r")).cast("decimal(19,0)")).cast("long")
    best = cuts.groupBy(*NAMES, "size", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best"))
    return best.select(*NAMES, "size", "a", "best.l", "best.r", "best.score")


def collocations(documents: DataFrame, least: int = LEAST, top: int = TOP, cover: int = COVER,
                 partitions: int | None = None) -> DataFrame:
    """Rows ``(lang, rank, phrase, a, l, r, n, score)``."""
    spark = documents.sparkSession
    texts = documents.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"),
                             F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    tasks = texts.rdd.getNumPartitions()
    if partitions is None:                                       # one holds about as much as an input partition
        partitions = max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions")))
    words, salt, width = named(kept(word_counts(texts)))
    often = words.where(F.col("f") >= least)
    all_n = words.groupBy("lang").agg(F.sum("f").alias("n"))

    # both have a fixed size: 2 ** TABLE_BITS bits, and at most HOT * partitions words
    slots = often.groupBy(F.shiftright(F.col("h").bitwiseAND(F.lit((1 << TABLE_BITS) - 1)), 6).cast("int").alias("at"))         .agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 AS int))")).alias("bits")).toPandas()
    table_bits = np.zeros(1 << TABLE_BITS - 6, np.uint64)
    table_bits[slots["at"].to_numpy(np.int64)] = slots["bits"].to_numpy(np.int64).view(np.uint64)
    total = words.agg(F.sum("f")).first()[0] or 0
    hot = np.array([r.h for r in often.where(F.col("f") * (HOT * partitions) >= total).select("h").collect()], np.int64)
    hot = spark.sparkContext.broadcast(hot.view(np.uint64))

    runs = merged_lanes(spilled_runs(texts, salt, width, spark.sparkContext.broadcast(table_bits), hot, partitions), tasks, NAMES)
    phrases = counted_phrases(runs, hot, least)
    scored = phrase_scores(phrases, often, cover)
    # the best by score and frequency get their words; ties at the last rank are all kept until the bytes decide
    first = scored.join(often.select(F.col("h").alias("h1"), "lang"), "h1")
    best = first.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))))         .where(F.col("place") <= top)
    place = F.posexplode(F.slice(F.array(*NAMES), 1, F.col("size"))).alias("at", "h")
    spelled = best.select("lang", *NAMES, "a", "l", "r", "score", place).join(often.select("h", "word"), "h")         .groupBy("lang", *NAMES, "a", "l", "r", "score").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))         .withColumn("phrase", F.array_join(F.col("words.word"), " "))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return spelled.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)         .join(all_n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = rf"""
WITH docs AS (
  SELECT coalesce(lang, '{UNKNOWN}') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (
  SELECT row_number() OVER () AS id, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs)),
tokens AS (SELECT id, lang, unnest(w) AS w, unnest(range(len(w))) AS i FROM pieces),
windows AS (
  SELECT lang, [w, lead(w) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o] AS w FROM tokens
  WINDOW o AS (PARTITION BY id ORDER BY i)),
grams AS (
  SELECT lang, size, w[1:size] AS w FROM windows, (SELECT unnest(range(1, {LONGEST + 1})) AS size) WHERE w[size] IS NOT NULL),
f AS (SELECT lang, size, w, count(*) AS a FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
often AS (SELECT * FROM f WHERE a >= {LEAST}),
candidates AS (SELECT * FROM often WHERE size >= 2),
inner_phrases AS (
  SELECT lang, w[i:i + part - 1] AS w, max(a) AS longer
  FROM (SELECT lang, w, a, part, unnest(range(1, size - part + 2)) AS i
        FROM candidates, (SELECT unnest(range(2, {LONGEST})) AS part) WHERE part < size) GROUP BY ALL),
remaining AS (
  SELECT c.* FROM candidates c LEFT JOIN inner_phrases p USING (lang, w) WHERE p.longer IS NULL OR 100 * p.longer < {COVER} * c.a),
cuts AS (
  SELECT c.lang, c.w, c.a, c.k, x.a AS l, y.a AS r, (2000000::HUGEINT * c.a) // (x.a + y.a) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM remaining) c
  JOIN often x ON x.lang = c.lang AND x.w = c.w[1:c.k] JOIN often y ON y.lang = c.lang AND y.w = c.w[c.k + 1:c.size]),
lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, w ORDER BY score, k) AS nth FROM cuts),
ranked AS (
  SELECT lang, array_to_string(w, ' ') AS phrase, a, l, r, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(w, ' ')) AS rank
  FROM lowest WHERE nth = 1)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= {TOP}
"""
