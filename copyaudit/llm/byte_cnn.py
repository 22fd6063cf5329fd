"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into halves of ``HALF`` bytes; two neighbouring halves form a chunk, so chunks overlap by half
and cover the whole text. Bytes are embedded, learned filters of ``WIDTH`` bytes slide over every position, their
responses are max-pooled per chunk, a hidden layer turns the pooled vector into a chunk value, and the least and the mean
chunk value are combined into one probability that the text is good.

Training (Adam, on the driver) uses a bounded sample: at most ``MAX_PER_CLASS`` labelled documents of each class in hash
order, and of each at most ``TRAIN_CHUNKS`` chunks spread evenly over the text; a short cut of one of its chunks is a
sample of its own, so that short texts are learned. Scoring uses whole texts, in Arrow batches
and slices of a fixed number of halves, so memory does not grow with a text.

Defined cases: a null text is empty; an empty text is one half of padding and gets a score like any other; labels without
a quality are ignored, of several labels of a document the larger counts; without labels of both classes every score is
0.5; repeated rows are scored one by one; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from copyaudit.llm.common import table

HALF = 128
WIDTH = 6
EMBEDDING = 8
FILTERS = 32
HIDDEN = 16
SLICE = 1024              # halves computed at a time
ROWS = 512                # texts of an Arrow batch held as Python objects at a time
MAX_PER_CLASS = 900
TRAIN_CHUNKS = 14
EPOCHS = 14
BATCH = 48
RATE = 4e-3
SEED = 7
KEEP_SCORE = 0.7
SPAN = HALF + WIDTH - 1   # bytes that one half reads


@dataclass
class Network:
    """Weights; ``halves`` and the layers above are the forward pass."""

    embed: np.ndarray     # 256 x EMBEDDING
    filters: np.ndarray   # WIDTH * EMBEDDING x FILTERS
    bias: np.ndarray
    hidden: np.ndarray    # FILTERS x HIDDEN
    hidden_bias: np.ndarray
    out: np.ndarray       # HIDDEN
    combine: np.ndarray   # least, mean, constant

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Network:
        def normal(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        return cls(normal(256, EMBEDDING, scale=0.5), normal(WIDTH * EMBEDDING, FILTERS, scale=0.3),
                   np.zeros(FILTERS, np.float32), normal(FILTERS, HIDDEN, scale=0.25), np.zeros(HIDDEN, np.float32),
                   normal(HIDDEN, scale=0.25), np.array([0.5, 0.5, 0.0], np.float32))

    def arrays(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.hidden, self.hidden_bias, self.out, self.combine]

    def responses(self, windows: np.ndarray) -> np.ndarray:
        """Filter responses (n x HALF x FILTERS) of byte windows (n x SPAN)."""
        at = self.embed[windows]                                # n x SPAN x EMBEDDING
        patches = np.lib.stride_tricks.sliding_window_view(at, WIDTH, axis=1).transpose(0, 1, 3, 2)
        return patches.reshape(-1, WIDTH * EMBEDDING).dot(self.filters).reshape(len(windows), HALF, FILTERS)

    def pooled_halves(self, windows: np.ndarray) -> np.ndarray:
        parts = [self.responses(windows[i:i + SLICE]).max(axis=1) for i in range(0, len(windows), SLICE)]
        return np.concatenate(parts)

    def chunk_values(self, pooled: np.ndarray) -> np.ndarray:
        active = np.maximum(pooled + self.bias, 0)
        return np.maximum(active @ self.hidden + self.hidden_bias, 0) @ self.out


def text_windows(data: bytes) -> np.ndarray:
    """The halves of a text as rows of ``SPAN`` bytes; the last bytes of a row repeat in the next one."""
    n = max(1, -(-len(data) // HALF))
    buffer = np.zeros(n * HALF + WIDTH - 1, np.uint8)
    buffer[:len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.as_strided(buffer, (n, SPAN), (HALF, 1))


def _chunks_of(pooled: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunk vectors (maximum of neighbouring halves) of texts with ``counts`` halves, and each text's first chunk."""
    last = np.cumsum(counts) - 1
    joined = pooled.copy()
    joined[:-1] = np.maximum(pooled[:-1], pooled[1:])
    keep = np.ones(len(pooled), bool)
    keep[last[counts > 1]] = False
    joined[last[counts == 1]] = pooled[last[counts == 1]]
    chunks = np.where(counts > 1, counts - 1, 1)
    return joined[keep], np.cumsum(chunks) - chunks


def text_scores(network: Network, texts: list[bytes]) -> np.ndarray:
    """Probability of each text. Halves are pooled in bounded groups of texts; a long text is a group of its own."""
    scores = np.empty(len(texts))
    group, size = [], 0

    def flush():
        windows = [text_windows(texts[i]) for i in group]
        counts = np.array([len(w) for w in windows])
        pooled = network.pooled_halves(np.concatenate(windows) if len(windows) > 1 else windows[0])
        vectors, starts = _chunks_of(pooled, counts)
        values = network.chunk_values(vectors)
        least = np.minimum.reduceat(values, starts)
        mean = np.add.reduceat(values, starts) / np.where(counts > 1, counts - 1, 1)
        a, b, c = network.combine
        scores[group] = 1 / (1 + np.exp(-np.clip(a * least + b * mean + c, -30, 30)))

    for i, data in enumerate(texts):
        group.append(i)
        size += len(data) + HALF
        if size >= SLICE * HALF:
            flush()
            group, size = [], 0
    if group:
        flush()
    return scores


def _short(chunk: np.ndarray, length: int) -> np.ndarray:
    """A short text as a training sample: the first bytes of a chunk, as the single half of a text of that length."""
    half = np.zeros(SPAN, np.uint8)
    half[:length] = chunk[:length]
    return np.concatenate([half[:HALF], half])[None, :]


def batch_scores(network: Network, texts: pa.Array) -> np.ndarray:
    """Scores of an Arrow column of texts, a bounded number of them as Python objects at a time."""
    parts = [text_scores(network, [(t or "").encode("utf-8", "replace") for t in texts.slice(at, ROWS).to_pylist()])
             for at in range(0, len(texts), ROWS)]
    return np.concatenate(parts) if parts else np.empty(0)


def train(samples: list[tuple[bytes, int]], epochs: int = EPOCHS, seed: int = SEED) -> Network | None:
    """Fits a network to chunk samples: each is the chunk bytes (n chunks of ``HALF + SPAN`` bytes) and the label."""
    labels = np.array([y for _, y in samples])
    if not len(labels) or labels.min() == labels.max():
        return None
    rng = np.random.default_rng(seed)
    net = Network.fresh(rng)
    weights = net.arrays()
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    width = HALF + SPAN
    data = [np.frombuffer(x, np.uint8).reshape(-1, width) for x, _ in samples]
    data += [_short(x[rng.integers(len(x))], int(rng.integers(12, HALF))) for x in data]
    labels = np.concatenate([labels, labels])
    balance = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    step = 0
    total = epochs * -(-len(data) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for at in range(0, len(order), BATCH):
            step += 1
            rate = RATE * (1 - step / (total + 1))
            grads = _gradients(net, [data[i] for i in order[at:at + BATCH]], labels[order[at:at + BATCH]],
                               balance[order[at:at + BATCH]])
            for w, g, (m, v) in zip(weights, grads, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return net


def _gradients(net: Network, texts: list[np.ndarray], labels: np.ndarray, balance: np.ndarray) -> list[np.ndarray]:
    """Gradients of the weighted log loss; through the max-pools they reach only the winning positions."""
    counts = np.array([len(t) for t in texts])
    starts = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(texts)), counts)
    windows = np.concatenate(texts)
    rows = np.arange(len(windows))
    first = net.responses(windows[:, :SPAN])
    second = net.responses(windows[:, HALF:])
    both = np.concatenate([first, second], axis=1)
    place = both.argmax(axis=1)                                 # chunk x filter
    pooled = np.take_along_axis(both, place[:, None, :], axis=1)[:, 0] + net.bias
    active = np.maximum(pooled, 0)
    before = active @ net.hidden + net.hidden_bias
    hidden = np.maximum(before, 0)
    values = hidden @ net.out
    least = np.minimum.reduceat(values, starts)
    mean = np.add.reduceat(values, starts) / counts
    a, b, c = net.combine
    prob = 1 / (1 + np.exp(-np.clip(a * least + b * mean + c, -30, 30)))
    loss = ((prob - labels) * balance / len(texts)).astype(np.float32)
    lowest = values == least[owner]
    ties = np.add.reduceat(lowest.astype(np.float32), starts)
    d_values = loss[owner] * (a * lowest / ties[owner] + b / counts[owner]).astype(np.float32)
    d_combine = np.array([loss @ least, loss @ mean, loss.sum()], np.float32)
    d_before = d_values[:, None] * net.out * (before > 0)
    d_pooled = (d_before @ net.hidden.T) * (pooled > 0)
    d_filters, d_embed = np.zeros_like(net.filters), np.zeros_like(net.embed)
    where = place[:, :, None] + np.arange(WIDTH)                # bytes of the winning patch
    patch_bytes = windows[rows[:, None, None], where]           # chunk x filter x WIDTH
    patches = net.embed[patch_bytes].reshape(len(windows), FILTERS, -1)
    d_filters += np.einsum("cf,cfk->kf", d_pooled, patches)
    d_patch = (d_pooled[:, :, None] * net.filters.T).reshape(-1, EMBEDDING)
    for e in range(EMBEDDING):
        d_embed[:, e] = np.bincount(patch_bytes.ravel(), d_patch[:, e], 256)
    return [d_embed, d_filters, d_pooled.sum(0), active.T @ d_before, d_before.sum(0), hidden.T @ d_values, d_combine]


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def chunk_samples(documents: DataFrame, labels: DataFrame, per_class: int = MAX_PER_CLASS) -> list[tuple[bytes, int]]:
    """Training chunks of a bounded sample of labelled documents that are not held out, in order of doc_id."""
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    ids = []
    for value in (0, 1):                                        # each list is bounded by the parameter
        ids += usable.where(F.col("quality") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) \
            .select("doc_id", "quality").collect()
    if not ids:
        return []
    spark = documents.sparkSession
    chosen = spark.createDataFrame([(int(r[0]), int(r[1])) for r in ids], "train_id long, quality int")
    texts = documents.select(F.col("doc_id").cast("long").alias("train_id"), "text") \
        .join(F.broadcast(chosen), "train_id").select("train_id", "quality", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks = []
            for text in batch.column(2).to_pylist():
                halves = text_windows((text or "").encode("utf-8", "replace"))
                if len(halves) == 1:
                    chunks.append(np.concatenate([halves[0][:HALF], halves[0]]).tobytes())
                    continue
                at = np.unique(np.linspace(0, len(halves) - 2, min(TRAIN_CHUNKS, len(halves) - 1)).round().astype(int))
                chunks.append(np.concatenate([halves[at][:, :HALF], halves[at + 1]], axis=1).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(chunks, pa.binary())],
                                             names=["train_id", "quality", "chunks"])

    got = texts.mapInArrow(cut, "train_id long, quality int, chunks binary").collect()
    return [(bytes(r["chunks"]), r["quality"]) for r in sorted(got, key=lambda r: (r["train_id"], bytes(r["chunks"])))]


def score(documents: DataFrame, network: Network | None) -> DataFrame:
    """Rows ``(doc_id, score)`` of whole texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch_scores(network, batch.column(1)) if network else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64())], names=["doc_id", "score"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def fit(documents: DataFrame, labels: DataFrame) -> Network | None:
    return train(chunk_samples(documents, labels))


def keep_good(documents: DataFrame, network: Network | None, least: float = KEEP_SCORE) -> DataFrame:
    """The documents whose score reaches ``least``, all their columns; a network without training keeps all."""
    if network is None:
        return documents
    names = documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for batch in batches:
            yield batch.filter(pa.array(batch_scores(network, batch.column(at)) >= least))

    return documents.mapInArrow(run, documents.schema)


def op2_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scored = score(documents, fit(documents, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"))
