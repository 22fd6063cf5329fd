"""Best-fit packing of token sequences after Martello-Toth dominance reduction.

Only lengths matter for packing, and a piece has one of ``capacity`` lengths, so the whole corpus is an instance of at
most ``capacity`` numbers: how many pieces have each length. The instance is solved on those counts (bounded, whatever
the corpus): dominance fixes sets of one or two pieces that no other choice beats, the rest is packed best-fit
decreasing, bins of equal content being handled together. The plan is a bounded table of slot ranges per length; Spark
numbers the pieces of each length and each takes its slot.

* Tokens: Arrow batches of whole texts in Python workers, ids per word kept in a bounded cache.
* Numbering: pieces of one length are split by a hash salt, counted, and numbered within (length, salt), so a length
  that a third of the pieces share is spread over ``SALTS`` windows.

Defined cases: a null or empty text is the single token ``END_ID``; repeated rows are packed one by one; ties between
equal lengths are broken by doc_id, piece and checksum; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from copyaudit.llm.common import kept, table

CAPACITY = 4096
END_ID = 1
SALTS = 256
VOCABULARY = "word_bpe_49k.json"
CACHED_WORDS = 120_000    # per generation; a worker holds two, about 50 MB

# Texts of these characters only need no normalising beyond lower case, and white space always separates their tokens.
PLAIN = regex.compile(r"[\x09-\x0d\x20-\x7e¡-įı-ɏ]*")
# Fixed value: how the vocabulary's tokenizer splits a word (its pattern, as the file states it).
PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others for the letters from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds(dict):
    """Token ids (little-endian unsigned 32-bit) of lower-case words; a bounded cache of two generations."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = [v for _, v in sorted(_byte_letters().items())]
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        got = self.older.get(word)
        if got is None:
            parts = PRETOKEN.findall(word)
            if len(parts) == 1:
                spelled = word if word.isascii() else "".join(map(self.letters.__getitem__, word.encode()))
                got = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(spelled)])
            else:
                got = b"".join(map(self.__getitem__, parts))
        if len(self) >= CACHED_WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = got
        return got

    def of_text(self, text: str) -> bytes:
        if PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return b"".join(map(self.__getitem__, text.lower().split()))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@cache
def word_ids(path: str | None) -> WordIds:
    """One per worker. ``path`` None: the installed vocabulary files."""
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(VOCABULARY)
    return WordIds(path)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PIECE_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
PIECE_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]


def pieces(documents: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Each document's ids and the end id, cut into pieces of ``capacity``; the checksum of each piece's ids."""
    end = np.array([END_ID], "<u4").tobytes()
    step = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = word_ids(vocabulary)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = ids.of_text(text.as_py() or "") + end
                out += [(doc_id, k, at // 4, min(step, len(data) - at) // 4, zlib.crc32(data[at:at + step]))
                        for k, at in enumerate(range(0, len(data), step))]
            columns = list(zip(*out, strict=True)) or [()] * len(PIECE_NAMES)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, PIECE_TYPES, strict=True)], names=PIECE_NAMES)

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def reduce_dominated(counts: list[int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Fixes sets that dominate every other set with the same longest piece; takes them out of ``counts``.

    ``counts[w]`` is the number of pieces of length w. With w the piece and k the longest piece that fits beside it:
    nothing fits: {w}; w + k fills the bin, or no second companion fits, or k is at least as long as the best two
    companions and no third fits: {w, k}. Repeated until a pass fixes nothing.
    """
    fixed: list[tuple[tuple[int, ...], int]] = []
    changed = True
    while changed:
        changed = False
        present = [w for w in range(1, capacity + 1) if counts[w]]
        for w in reversed(present):
            while counts[w]:
                counts[w] -= 1                                  # the piece itself; companions come from the others
                room = capacity - w
                fit = bisect_left(present, room + 1) - 1
                while fit >= 0 and not counts[present[fit]]:
                    fit -= 1
                k = present[fit] if fit >= 0 else 0
                small: list[int] = []
                for x in present:
                    small += [x] * min(3, counts[x])
                    if len(small) >= 3:
                        break
                dominates = not k or w + k == capacity or len(small) < 2 or sum(small[:2]) > room or (
                    (len(small) < 3 or sum(small[:3]) > room) and k >= _best_pair(present, counts, room))
                counts[w] += 1
                if not dominates:
                    break
                if not k:
                    times, chosen = counts[w], (w,)
                else:
                    times, chosen = (counts[w] // 2 if k == w else min(counts[w], counts[k])), (w, k)
                for x in chosen:
                    counts[x] -= times
                fixed.append((chosen, times))
                changed = True
    return fixed


def _best_pair(present: list[int], counts: list[int], room: int) -> int:
    """The longest two pieces together that fit into ``room``."""
    left = [x for x in present if counts[x] and x <= room]
    best, i, j = 0, 0, len(left) - 1
    while i <= j:
        total = left[i] + left[j]
        if total > room or (i == j and counts[left[i]] < 2):
            j -= 1
        else:
            best = max(best, total)
            i += 1
    return best


def best_fit(counts: list[int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: bins of equal content are one group; ``(lengths, copies)`` of every group."""
    groups: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []                                       # sorted; the free space of open groups

    def put(lengths: tuple[int, ...], copies: int) -> None:
        if copies:
            room = capacity - sum(lengths)
            if room not in groups:
                insort(rooms, room)
                groups[room] = []
            groups[room].append((lengths, copies))

    for w in range(capacity, 0, -1):
        n = counts[w]
        while n:
            at = bisect_left(rooms, w)
            if at < len(rooms):
                room = rooms[at]
                lengths, copies = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                room, lengths, copies = capacity, (), -(-n // (capacity // w))
            each = room // w                                    # a bin keeps taking w while it has the least room
            whole = min(copies, n // each)
            put(lengths + (w,) * each, whole)
            n -= whole * each
            copies -= whole
            if n and copies:                                    # fewer than ``each`` left: one more bin, partly
                put(lengths + (w,) * n, 1)
                copies -= 1
                n = 0
            put(lengths, copies)
    return [g for room in rooms for g in groups[room]]


def slot_table(groups: list[tuple[tuple[int, ...], int]], capacity: int) -> np.ndarray:
    """Rows (length, first slot, slots per bin, first bin, offset), sorted by length and first slot."""
    taken = [0] * (capacity + 1)
    rows, first_bin = [], 0
    for lengths, copies in groups:
        offset = 0
        for w in dict.fromkeys(lengths):
            each = lengths.count(w)
            rows.append((w, taken[w], each, first_bin, offset))
            taken[w] += each * copies
            offset += each * w
        first_bin += copies
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces (columns of ``PIECES``); ``cut`` is read several times, so it is stored."""
    spark = cut.sparkSession
    # the place among the stored rows spreads even equal ids
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(SALTS)).cast("int"))
    # at most capacity * SALTS rows, whatever the corpus
    tally = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")).toPandas()
    per_salt = np.zeros((capacity + 1, SALTS), dtype=np.int64)
    per_salt[tally["length"].to_numpy(np.int64), tally["salt"].to_numpy(np.int64)] = tally["n"].to_numpy(np.int64)
    counts = per_salt.sum(axis=1).tolist()
    groups = reduce_dominated(counts, capacity)
    groups += best_fit(counts, capacity)
    before = np.cumsum(per_salt, axis=1) - per_salt
    shared = spark.sparkContext.broadcast((before, slot_table(groups, capacity)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, slots = shared.value
        big = 1 << 45
        keys = slots[:, 0] * big + slots[:, 1]
        for batch in batches:
            w = batch.column("length").to_numpy()
            rank = before[w, batch.column("salt").to_numpy()] + batch.column("nth").to_numpy() - 1
            row = slots[np.searchsorted(keys, w * big + rank, side="right") - 1]
            at = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in PIECE_NAMES), pa.array(row[:, 3] + at // row[:, 2]), pa.array(row[:, 4] + at % row[:, 2] * w)],
                names=[*PIECE_NAMES, "sequence_id", "offset"])

    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    return salted.withColumn("nth", F.row_number().over(order)) \
        .mapInArrow(place, PIECES + ", sequence_id long, offset long")


def pack_documents(documents: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    return pack(kept(pieces(documents, vocabulary, capacity)), capacity)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
