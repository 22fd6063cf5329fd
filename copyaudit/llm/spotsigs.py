"""SpotSigs fingerprints: chains of content words that follow common-word anchors, compared by pruned Jaccard.

A spot signature is the hash of an anchor and the ``CHAIN`` content words after it (common words in between are skipped).
Anchors are common words and, for texts with few of them, the words that a hash picks (one in ``PICKED``) and the start of
the text. A document's fingerprint is the sorted set of its spot signatures, by one rule for texts of every length.

* ``with_neighbours`` pairs every document with the next one by doc_id. Order is found on ids alone (range partitions,
  numbered, then stitched at their ends); texts move once; to its neighbour goes a text's fingerprint and the prefix that
  the neighbour's edit needs.
* ``near_pairs`` joins fingerprints: sets are partitioned by length so that only sets of the same or the next partition
  can reach the threshold, each set is looked up by its rarest signatures (prefix filter on corpus counts), and the
  Jaccard value is computed only where lengths allow it.

Defined cases: a null text is empty; in a text without letters and digits the runs between white space are its words, and in
one without content words every word is one, so only texts of white space have the empty fingerprint, like 1 to another
empty one and 0 to any other; a null doc_id comes first in order (the least long is read as null); equal rows are one document (each gets the same result row), rows that
share a doc_id follow each other by the hash of their text; a single document is its own neighbour; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from copyaudit.llm.common import GAP, kept, let, table

# Anchors and the other common words that chains skip, in English, French, German and Spanish.
ANCHORS = ("the of and to in is that for it with as was on be at by this from are or an "
           "de la le et les des en un une du que est pour qui dans par sur pas au "
           "der die und das den von zu mit sich auf für ist im dem nicht ein eine als auch es "
           "el los y del las por con no para se su una al lo").split()
COMMON = sorted({*ANCHORS, *(
    "a he she they we you i not his her its have has had but which one all there their what when who will more if out so "
    "were been can would other about into than them these two may some only then also any "
    "il elle ils ne ce se son sa ses plus ou avec tout nous vous mais comme je on leur y été être a sont "
    "sie er ich wir wird sind war hat aus bei nach wie einer um am haben nur oder aber vor zur bis mehr durch man noch "
    "sus como más pero le ya o este sí porque esta entre cuando muy sin sobre también me hasta hay donde").split()})
CHAIN = 2
PICKED = 4
THRESHOLD = 0.8


def _tokens(text: Column) -> Column:
    def some(separator):
        return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), separator), lambda w: w != "")

    return let(some(r"[^\p{L}\p{N}]+"), lambda words: F.when(F.size(words) > 0, words).otherwise(some(GAP)))


def _chains(words: Column) -> Column:
    """Hashes of the chains that follow anchors, repeated ones too."""
    numbered = F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    content = let(F.filter(numbered, lambda x: ~x["w"].isin(*COMMON)), lambda c: F.when(F.size(c) > 0, c).otherwise(numbered))

    def following(c):
        """Per content word: the hash of the word before it and of the chain it starts."""
        return F.transform(c, lambda x, j: F.struct(
            F.when(j > 0, F.get(words, x["i"] - 1)).alias("anchor"),
            F.hash(F.get(words, x["i"] - 1), x["w"], *[F.get(c, j + k)["w"] for k in range(1, CHAIN)]).alias("h")))

    def anchored(s):
        """After the start of the text, a common word or a picked one."""
        return s["anchor"].isNull() | s["anchor"].isin(*ANCHORS) | (F.pmod(F.xxhash64(s["anchor"]), F.lit(PICKED)) == 0)

    return let(content, lambda c: F.transform(F.filter(following(c), anchored), lambda s: s["h"]))


def fingerprint(text: Column) -> Column:
    """The sorted set of a text's spot signatures (array<int>)."""
    return F.sort_array(F.array_distinct(let(_tokens(text), _chains)))


def jaccard(a: Column, b: Column, threshold: float = 0.0) -> Column:
    """Jaccard likeness of two sets; 0 without comparing them where their lengths rule ``threshold`` out."""
    shared = F.size(F.array_intersect(a, b))
    value = F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(shared / (F.size(a) + F.size(b) - shared))
    if not threshold:
        return value
    return F.when(F.least(F.size(a), F.size(b)) < threshold * F.greatest(F.size(a), F.size(b)), F.lit(0.0)).otherwise(value)


def length_partition(size: Column, threshold: float = THRESHOLD) -> Column:
    """Partition of a set by its length: sets two partitions apart cannot reach ``threshold``."""
    return F.floor(F.log(F.greatest(size, F.lit(1)).cast("double")) / F.lit(-log(threshold)) + F.lit(1e-9)).cast("int")


def near_pairs(sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs ``(a, b, likeness)``, a below b, of rows ``(id, sigs)`` with likeness ``threshold`` or more; ids are unique.

    Rows with equal sets should be one row. Signatures are ordered from rare to common over all rows; two sets that reach
    the threshold share one of their first ``size - ceil(threshold * size) + 1``, so only those are joined.
    """
    sets = sets.where(F.size("sigs") > 0)
    rows = sets.select("id", F.size("sigs").alias("size"), F.explode("sigs").alias("sig"))
    counts = rows.groupBy("sig").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")   # a lone signature joins nothing
    rarest = rows.join(counts, "sig", "left").groupBy("id", "size").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("rows", F.lit(1)).alias("rows"), "sig"))).alias("ranked"))
    prefix = F.expr(f"slice(ranked, 1, size - cast(ceil({threshold} * size - 1e-9) as int) + 1)")
    keys = kept(rarest.select("id", "size", length_partition(F.col("size"), threshold).alias("part"),
                              F.explode(prefix).alias("p")).where("p.rows > 1").select("id", "size", "part", "p.sig"))
    probes = keys.select(F.col("id").alias("a"), F.col("size").alias("size_a"), "sig",
                         F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"))
    stored = keys.select(F.col("id").alias("b"), F.col("size").alias("size_b"), "sig", "part")
    allowed = (F.col("size_a") < F.col("size_b")) | ((F.col("size_a") == F.col("size_b")) & (F.col("a") < F.col("b")))
    candidates = probes.join(stored, ["sig", "part"]).where(allowed & (F.col("size_a") >= threshold * F.col("size_b"))) \
        .select("a", "b").distinct()
    compared = candidates.join(sets.select(F.col("id").alias("a"), F.col("sigs").alias("sigs_a")), "a") \
        .join(sets.select(F.col("id").alias("b"), F.col("sigs").alias("sigs_b")), "b") \
        .withColumn("likeness", jaccard(F.col("sigs_a"), F.col("sigs_b"), threshold)).where(F.col("likeness") >= threshold)
    return compared.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "likeness")


LEAST_ID = -(1 << 63)     # stands for a null doc_id


def neighbours(ids: DataFrame) -> DataFrame:
    """Rows ``(id, h, prev_id, prev_h, need)`` of distinct ``(id, h, n_chars)``: the document before each one, cyclic.

    ``need`` is a quarter of that document's length. Only ids are ordered: range partitions are fixed by a checkpoint,
    linked inside by a window, and the first row of each takes the last row of the partition before it.
    """
    ranged = kept(ids.repartitionByRange("id", "h").withColumn("part", F.spark_partition_id()))
    inside = Window.partitionBy("part").orderBy("id", "h")
    row = F.struct("id", "h", "n_chars")
    linked = ranged.withColumn("prev", F.lag(row).over(inside))
    lasts = ranged.groupBy("part").agg(F.max(row).alias("last"))            # one row per partition
    whole = Window.orderBy("part")
    before = lasts.select("part", F.coalesce(
        F.lag("last").over(whole), F.last("last").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ).alias("before"))
    joined = linked.join(before, "part").withColumn("prev", F.coalesce("prev", "before"))
    return joined.select("id", "h", F.col("prev.id").alias("prev_id"), F.col("prev.h").alias("prev_h"),
                         F.floor(F.col("prev.n_chars") / 4).cast("int").alias("need"))


def with_neighbours(documents: DataFrame) -> DataFrame:
    """Rows ``(doc_id, text, sigs, next_prefix, next_sigs)``, the prefix of the next text as long as the edit needs."""
    text = F.coalesce(F.col("text"), F.lit(""))
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID)).alias("id")
    # both uses below need exactly these columns, so Spark shuffles the texts once and reads that twice
    own = documents.select(place, text.alias("text")).select("id", F.xxhash64("text").alias("h"), "text")
    counted = kept(documents.select(place, F.xxhash64(text).alias("h"), F.length(text).alias("n_chars"))
                   .groupBy("id", "h", "n_chars").agg(F.count(F.lit(1)).alias("copies")))
    order = kept(neighbours(counted.select("id", "h", "n_chars")))
    moved = own.join(order, ["id", "h"]).select(
        F.col("prev_id").alias("id"), F.col("prev_h").alias("h"), fingerprint(F.col("text")).alias("next_sigs"),
        F.substring(F.col("text"), F.lit(1), F.col("need")).alias("next_prefix"))
    if counted.where("copies > 1").first():                                 # equal rows send equal texts: keep one
        moved = moved.dropDuplicates(["id", "h"])
    doc_id = F.when(F.col("id") != LEAST_ID, F.col("id")).alias("doc_id")
    return own.join(moved, ["id", "h"]).select(doc_id, "text", fingerprint(F.col("text")).alias("sigs"), "next_prefix", "next_sigs")


def spelled(sigs: Column) -> Column:
    """A fingerprint as text: the signatures in hex, in order."""
    low = F.lit(0xFFFFFFFF)
    return F.array_join(F.transform(sigs, lambda s: F.lpad(F.hex(s.cast("long").bitwiseAND(low)), 8, "0")), "")


def op5_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = with_neighbours(table(spark, sf_dir, "documents"))
    n = F.length("text")
    edited = pairs.withColumn("edited", F.concat(
        F.substring(F.col("text"), F.lit(1), (n - F.floor(n / 4)).cast("int")), "next_prefix"))
    marked = edited.withColumn("edited_sigs", let(F.col("edited"), fingerprint))
    return marked.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        spelled(F.col("sigs")).alias("fingerprint"), spelled(F.col("edited_sigs")).alias("edited_fingerprint"),
        jaccard(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        jaccard(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
        length_partition(F.size("sigs")).alias("length_partition"))
