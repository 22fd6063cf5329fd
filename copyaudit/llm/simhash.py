"""SimHash near-duplicates found through Golay-code fuzzy hashing.

Fingerprints: 64 majority bits over the XXH64 hashes (seed 42) of a text's word shingles, repeats included. Two texts link
when their fingerprints differ in at most three bits.

Candidates: the perfect Golay code (23, 12) maps every 23-bit word to one codeword within three bits. A word's keys are
the codeword indices of all words within one bit of it (six keys or one), and a word within one bit of it decodes to one
of them. Of four 16-bit blocks, three errors leave one block exact; the other 48 bits hold two 23-bit segments, of
which one has at most one error. So each fingerprint is stored under 8 keys (exact block + codeword index of a segment)
and looks up at most 48, and every pair within three bits meets. Equal fingerprints are one node throughout, the
distance is checked inside the join, and links join into components through repeated equi-joins.

Defined cases: a null text has no words, and no words give fingerprint 0, linked like any other; repeated rows and equal
texts share a fingerprint; a null doc_id counts as larger than any other when a component is named; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from copyaudit.llm.common import components, kept, table

SHINGLE = 3
MAX_BITS = 3
SEED = 42
SLICE = 1 << 15          # shingles counted at a time


def text_fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text as an unsigned number."""
    tokens = (text or "").encode("utf-8", "replace").lower().split()   # bytes: A-Z only, white space of ASCII only
    if not tokens:
        return 0
    spans = [tokens[i:] for i in range(shingle)] if len(tokens) >= shingle else [[t] for t in tokens]
    grams = map(b" ".join, zip(*spans, strict=False))
    total, votes = 0, np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    hashes = [digest(g, SEED) for g in grams]
    for at in range(0, len(hashes), SLICE):
        part = np.array(hashes[at:at + SLICE], dtype="<u8")
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(part)
    return int(np.packbits(2 * votes > total, bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Rows ``(doc_id, h, fp)``: ``h`` is a hash of the text, ``fp`` the 64 bits as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([text_fingerprint(t, shingle) for t in batch.column(2).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))],
                                             names=["doc_id", "h", "fp"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(documents).alias("h"), "text") \
        .mapInArrow(run, "doc_id long, h long, fp long")


def text_hash(documents: DataFrame) -> Column:
    return F.xxhash64(F.coalesce(documents["text"], F.lit("")))


class Golay:
    """Decoder of the (23, 12) code with generator x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 to 12-bit codeword indices."""

    GENERATOR = 0b110001110101

    def __init__(self):
        units = np.array([self._remainder(1 << i) for i in range(23)], dtype=np.int32)
        self.syndromes = []                                     # of each byte value at each of three places
        for place in range(3):
            values = np.arange(256)
            bits = units[8 * place:8 * place + 8]
            out = np.zeros(256, dtype=np.int32)
            for i, unit in enumerate(bits):
                out ^= np.where(values >> i & 1, unit, 0).astype(np.int32)
            self.syndromes.append(out)
        self.errors = np.zeros(2048, dtype=np.int32)            # every pattern of up to three errors, by its syndrome
        singles = [0] + [1 << i for i in range(23)]
        for a in singles:
            for b in singles:
                for c in singles:
                    pattern = a | b | c
                    self.errors[self._of(np.array([pattern]))] = pattern

    def _remainder(self, word: int) -> int:
        for i in range(22, 10, -1):
            if word >> i & 1:
                word ^= self.GENERATOR << (i - 11)
        return word

    def _of(self, words: np.ndarray) -> np.ndarray:
        one, two, three = self.syndromes
        return one[words & 255] ^ two[words >> 8 & 255] ^ three[words >> 16 & 255]

    def index(self, words: np.ndarray) -> np.ndarray:
        return (words ^ self.errors[self._of(words)]) >> 11


def segment_words(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per fingerprint (unsigned) 8 prefixes (block number, segment number, block bits) and the 23-bit segments."""
    prefixes, words = [], []
    for block in range(4):
        shift = np.uint64(16 * block)
        exact = (fps >> shift).astype(np.int64) & 0xFFFF
        low = fps & ((np.uint64(1) << shift) - np.uint64(1))
        high = (fps >> shift >> np.uint64(16)) << shift
        rest = (low | high).astype(np.int64)                    # the other 48 bits
        for segment in range(2):
            prefixes.append(((block * 2 + segment) << 16 | exact) << 12)
            words.append((rest >> (23 * segment)) & 0x7FFFFF)
    return np.stack(prefixes, 1), np.stack(words, 1)


def golay_keys(distinct: DataFrame, probe: bool) -> DataFrame:
    """Rows ``(key, fp)`` of fingerprints: the stored key of each segment, or all the keys it looks up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Golay()
        flips = np.array([0] + ([1 << i for i in range(23)] if probe else []), dtype=np.int64)
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(fps), 4096):
                part = fps[at:at + 4096]
                prefixes, segments = segment_words(part.view(np.uint64))
                keys = np.sort(code.index(segments[:, :, None] ^ flips), axis=2)
                new = np.ones(keys.shape, dtype=bool)
                new[:, :, 1:] = keys[:, :, 1:] != keys[:, :, :-1]
                full = (prefixes[:, :, None] | keys)[new]
                owner = np.broadcast_to(part[:, None, None], keys.shape)[new]
                yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(owner)], names=["key", "fp"])

    return distinct.select("fp").mapInArrow(run, "key long, fp long")


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs ``(a, b)``, a below b, of different fingerprints within ``max_bits`` (3 at most) bits."""
    if max_bits > MAX_BITS:
        raise ValueError("the keys guarantee pairs within three bits only")
    stored = golay_keys(distinct, False).withColumnRenamed("fp", "b")
    looked = golay_keys(distinct, True).withColumnRenamed("fp", "a")
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    return looked.join(stored, "key").where(near).select("a", "b").distinct()


def groups(documents: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Rows ``(doc_id, h, fp, group)``: ``group`` is one fingerprint of all that are linked, directly or not."""
    marked = kept(fingerprints(documents, shingle))
    distinct = kept(marked.select("fp").distinct())
    linked = components(links(distinct, max_bits)).select(F.col("node").alias("fp"), F.col("component").alias("group"))
    return marked.join(linked, "fp", "left").select("doc_id", "h", "fp", F.coalesce("group", "fp").alias("group"))


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Rows ``(doc_id, fp, component_id)``: the smallest doc_id reachable over links, its own included."""
    grouped = groups(documents, shingle, max_bits)
    least = grouped.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    return grouped.join(least, "group").select("doc_id", "fp", "component_id")


def keep_first(documents: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component, the one with the smallest doc_id (then text hash); all its columns.

    Of equal rows one stays.
    """
    rows = groups(documents, shingle, max_bits).groupBy("group", "doc_id", "h").agg(F.count(F.lit(1)).alias("copies"))
    first = rows.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "h", "copies")).alias("first"))
    chosen = kept(first.select(F.col("first.doc_id").alias("kept_id"), F.col("first.h").alias("kept_h"),
                               F.col("first.copies").alias("copies")))

    def rows_of(ids: DataFrame) -> DataFrame:
        same = documents["doc_id"].cast("long").eqNullSafe(ids["kept_id"]) & (text_hash(documents) == ids["kept_h"])
        return documents.join(ids, same, "left_semi")

    return rows_of(chosen.where("copies = 1")).unionByName(
        rows_of(chosen.where("copies > 1")).dropDuplicates(["doc_id", "text"]))


def op7_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
