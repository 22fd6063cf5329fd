"""Words of whole texts as numbers, and sorted runs as compressed Arrow blobs, for operators that spill and merge."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE = 1 << 21          # bytes of text whose words are held at a time
RUN_ROWS = 1 << 14       # rows of a run that a merge decodes at a time
FAN_IN = 64              # runs of a shard that one merge takes


class Numbering(dict):
    """Numbers values in the order in which they come."""

    def __missing__(self, value) -> int:
        self[value] = n = len(self)
        return n

    def of(self, values: pa.Array) -> np.ndarray:
        """The numbers of the values of an array; each distinct value is looked up once."""
        encoded = values.dictionary_encode()
        names = encoded.dictionary.to_pylist()
        numbers = np.fromiter(map(self.__getitem__, names), np.int64, len(names))
        return numbers[encoded.indices.to_numpy(zero_copy_only=False)] if len(names) else np.empty(0, np.int64)


def byte_table(mapping: dict[int, int]) -> bytes:
    return bytes(mapping.get(b, b) for b in range(256))


LOWER = {b: b + 32 for b in range(0x41, 0x5B)}          # A-Z only


def text_slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, pa.Array]]:
    """``(first row, texts)`` of a batch, about ``SLICE`` bytes at a time."""
    texts = batch.column(column)
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + SLICE, side="right")))
        yield at, texts[at:stop]
        at = stop


def translated(texts: pa.Array, mapping: bytes) -> pa.Array:
    """Binary values with every byte replaced by the table."""
    texts = pa.concat_arrays([texts])                            # a slice of its own
    _, offsets, data = texts.buffers()
    changed = (data.to_pybytes() if data else b"").translate(mapping)
    return pa.Array.from_buffers(texts.type, len(texts), [None, offsets, pa.py_buffer(changed)], offset=texts.offset)


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The words between white space, and for each the number of the text it is in."""
    lists = pc.ascii_split_whitespace(texts.view(pa.string()))
    words = lists.flatten().view(pa.binary())
    owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    some = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    return owner[some], words.filter(pa.array(some))


def sum_by_key(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order and the sum of each value array over the rows of a key."""
    if not len(key):
        return key, *values
    order = np.argsort(key, kind="stable")
    key = key[order]
    heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[heads], *(np.add.reduceat(v[order], heads) for v in values)


def encode_run(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(rows, max_chunksize=RUN_ROWS)
    return sink.getvalue().to_pybytes()


def decode_run(run: bytes) -> Iterator[pa.RecordBatch]:
    with pa.ipc.open_stream(run) as source:
        yield from (b for b in source if len(b))


def _cut(values: pa.Array, pivot, at: int) -> int:
    """First row from ``at`` on whose value is above ``pivot``."""
    low, high = at, len(values)
    while low < high:
        middle = (low + high) // 2
        if values[middle].as_py() <= pivot:
            low = middle + 1
        else:
            high = middle
    return low


def merge_runs(runs: list[bytes]) -> Iterator[pa.Table]:
    """Merges runs sorted by their first column: tables of rows, in no order among themselves, each above the one before.

    A heap holds the last value of the decoded rows of each run. All rows up to the least of them are complete: they are
    taken from every run, and the run that ends there decodes its next rows. Equal first values are in one table.
    """
    sources = [decode_run(r) for r in runs]
    open_rows: dict[int, tuple[pa.RecordBatch, int]] = {}
    heap: list[tuple] = []

    def load(i: int) -> None:
        batch = next(sources[i], None)
        if batch is None:
            open_rows.pop(i, None)
        else:
            open_rows[i] = (batch, 0)
            heapq.heappush(heap, (batch.column(0)[-1].as_py(), i))

    for i in range(len(sources)):
        load(i)
    while heap:
        pivot = heap[0][0]
        parts = []
        while heap and heap[0][0] == pivot:                      # runs that end here, decoded further while they continue it
            _, i = heapq.heappop(heap)
            batch, at = open_rows[i]
            parts.append(batch.slice(at))
            load(i)
        for i, (batch, at) in list(open_rows.items()):
            stop = _cut(batch.column(0), pivot, at)
            if stop > at:
                parts.append(batch.slice(at, stop - at))
                open_rows[i] = (batch, stop)
        yield pa.Table.from_batches(parts)


def summed(rows: pa.Table, keys: list[str]) -> pa.Table:
    """One row per key, the other columns summed; the same columns."""
    others = [c for c in rows.column_names if c not in keys]
    out = rows.group_by(keys).aggregate([(c, "sum") for c in others])
    return out.rename_columns([c.removesuffix("_sum") if c not in keys else c for c in out.column_names]).select(rows.column_names)


def run_frame(rows: Iterator[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    """``(shard, lane, run)`` rows, one batch each, so that only one run is held as rows."""
    for shard, lane, data in rows:
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([lane], pa.int32()), pa.array([data], pa.binary())],
                                         names=["shard", "lane", "run"])


RUN_COLUMNS = "shard int, lane int, run binary"


def runs_of_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[bytes]]]:
    """``(shard, lane, runs)`` of rows sorted by shard and lane."""
    key, runs = None, []
    for batch in batches:
        for *now, run in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if key is not None and now != key:
                yield *key, runs
                runs = []
            key = now
            runs.append(run)
    if key is not None:
        yield *key, runs


def by_shard(runs: DataFrame) -> DataFrame:
    return runs.repartition("shard", "lane").sortWithinPartitions("shard", "lane")


def merged_lanes(runs: DataFrame, tasks: int, keys: list[str]) -> DataFrame:
    """Merges runs among each other until a shard has at most about ``FAN_IN``; ``tasks``: how many tasks spilled them."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, lane, blobs in runs_of_shards(batches):
            merged = pa.concat_tables(summed(rows, keys) for rows in merge_runs(blobs)).sort_by(first)
            yield from run_frame([(shard, lane // FAN_IN, encode_run(merged))])

    first = keys[0]
    while tasks > FAN_IN:
        tasks = -(-tasks // FAN_IN)
        runs = by_shard(runs.withColumn("lane", F.col("lane") % tasks)).mapInArrow(merge, RUN_COLUMNS)
    return runs.withColumn("lane", F.lit(0))
