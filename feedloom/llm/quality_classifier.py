"""Quality of whole texts by a byte-level convolutional network in numpy.

Each byte is an embedding and one repeat channel: whether the four bytes from here stand in the
bytes just before. Learned filters slide over the text; every overlapping chunk keeps each filter's
highest response, a linear layer turns that into the chunk's log-odds, and the mean over the chunks,
which cover the whole text, is the document's. The network is fitted on a bounded sample of labelled
documents; scoring is one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import batch_of, text_buffer

#: Labelled documents of each class that the network is fitted on, at most.
SAMPLE_DOCS = 1_500
#: Longer texts are scored like all others but not drawn for fitting.
SAMPLE_CHARS = 50_000
EMBEDDING = 7
WIDTH = 8
STRIDE = 4
FILTERS = 24
#: Half a chunk: chunks are two blocks long and begin at every block.
BLOCK = 128
REPEAT_FROM, REPEAT_TO = 2, 24
CHUNK_BYTES = 2_000_000
PER_BLOCK = BLOCK // STRIDE


@dataclass
class Network:
    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray


def laid_out(data: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts in blocks, each followed by at least ``WIDTH`` zero bytes; and the first block of each."""
    sizes = np.diff(limits)
    blocks = (sizes + WIDTH + BLOCK - 1) // BLOCK
    first = np.concatenate([[0], np.cumsum(blocks)])
    out = np.zeros(first[-1] * BLOCK + WIDTH, np.uint8)
    out[np.arange(len(data)) + np.repeat(first[:-1] * BLOCK - limits[:-1], sizes)] = data
    return out, first


def repeats(data: np.ndarray) -> np.ndarray:
    """Whether the four bytes from each place equal those that begin shortly before; 0 in the padding."""
    found = np.zeros(len(data), bool)
    if len(data) >= 4:
        wide = data.astype(np.uint32)
        four = wide[:-3] | wide[1:-2] << np.uint32(8) | wide[2:-1] << np.uint32(16) | wide[3:] << np.uint32(24)
        for d in range(REPEAT_FROM, REPEAT_TO + 1):
            found[d : len(four)] |= four[d:] == four[:-d]
    return found & (data != 0)


def inputs(net: Network, data: np.ndarray) -> np.ndarray:
    x = np.empty((len(data), EMBEDDING + 1), np.float32)
    x[:, :EMBEDDING] = net.embedding[data]
    x[:, EMBEDDING] = repeats(data)
    return x


def windows(x: np.ndarray) -> np.ndarray:
    n = (len(x) - WIDTH) // STRIDE
    step = x.strides[0]
    return np.lib.stride_tricks.as_strided(x, (n, WIDTH * x.shape[1]), (STRIDE * step, x.strides[1]))


def chunk_rows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both blocks of every chunk and its document; a document of one block has one chunk."""
    blocks = np.diff(first)
    chunks = np.maximum(blocks - 1, 1)
    doc = np.repeat(np.arange(len(blocks)), chunks)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(chunks) - chunks, chunks) + first[doc]
    return at, np.minimum(at + 1, first[doc + 1] - 1), doc


def _own(found: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Responses by block; the last window of a document reaches into the next one and does not count."""
    found = found.reshape(-1, PER_BLOCK, FILTERS)
    found[first[1:] - 1, -1] = found[first[1:] - 1, -2]
    return found


def log_odds(net: Network, data: np.ndarray, first: np.ndarray) -> np.ndarray:
    found = _own(np.ascontiguousarray(windows(inputs(net, data))) @ net.filters, first)
    highest = np.maximum(found.max(axis=1) + net.bias, 0)
    one, two, doc = chunk_rows(first)
    odds = np.maximum(highest[one], highest[two]) @ net.weights + net.offset[0]
    return np.bincount(doc, odds, len(first) - 1) / np.bincount(doc, minlength=len(first) - 1)


def _step(net: Network, data: np.ndarray, first: np.ndarray, y: np.ndarray) -> Network:
    """The gradient of the mean logistic loss."""
    view = np.ascontiguousarray(windows(inputs(net, data)))
    found = _own(view @ net.filters + net.bias, first)
    place = found.argmax(axis=1)
    highest = np.take_along_axis(found, place[:, None, :], axis=1)[:, 0]
    one, two, doc = chunk_rows(first)
    takes = highest[one] >= highest[two]
    pooled = np.maximum(np.where(takes, highest[one], highest[two]), 0)
    chunks = np.bincount(doc, minlength=len(y))
    odds = np.bincount(doc, pooled @ net.weights + net.offset[0], len(y)) / chunks
    slope = ((1 / (1 + np.exp(-odds)) - y) / len(y) / chunks).astype(np.float32)[doc]
    back = slope[:, None] * net.weights * (pooled > 0)
    block = np.where(takes, one[:, None], two[:, None])
    row = block * PER_BLOCK + np.take_along_axis(place, block, axis=0)
    filters = np.zeros_like(net.filters)
    embedding = np.zeros((256, EMBEDDING))
    depth = EMBEDDING + 1
    for f in range(FILTERS):
        seen = view[row[:, f]]
        filters[:, f] = back[:, f] @ seen
        for w in range(WIDTH):
            byte = data[row[:, f] * STRIDE + w]
            mass = np.bincount(byte, back[:, f], 256)
            embedding += mass[:, None] * net.filters[w * depth : w * depth + EMBEDDING, f]
    return Network(embedding.astype(np.float32), filters, back.sum(axis=0), slope @ pooled, np.array([slope.sum()], np.float32))


def fit_network(texts: pa.Array, y: np.ndarray, epochs: int = 5, batch: int = 48, rate: float = 0.01, seed: int = 8) -> Network:
    """Adam over shuffled batches; equal inputs give an equal network."""
    draw = np.random.default_rng(seed)
    depth = WIDTH * (EMBEDDING + 1)
    net = Network(
        draw.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
        draw.normal(0, 1 / np.sqrt(depth), (depth, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32), draw.normal(0, 0.1, FILTERS).astype(np.float32), np.zeros(1, np.float32),
    )
    names = [f.name for f in fields(Network)]
    first = {n: np.zeros_like(getattr(net, n)) for n in names}
    second = {n: np.zeros_like(getattr(net, n)) for n in names}
    t = 0
    for _ in range(epochs):
        order = draw.permutation(len(y))
        for k in range(0, len(order), batch):
            rows = order[k : k + batch]
            grad = _step(net, *laid_out(*text_buffer(texts.take(pa.array(rows)))), y[rows])
            t += 1
            for n in names:
                g = getattr(grad, n)
                first[n] = 0.9 * first[n] + 0.1 * g
                second[n] = 0.99 * second[n] + 0.01 * g * g
                step = rate * (first[n] / (1 - 0.9**t)) / (np.sqrt(second[n] / (1 - 0.99**t)) + 1e-8)
                setattr(net, n, (getattr(net, n) - step).astype(np.float32))
    return net


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> Network | float:
    """A network from the documents that ``labels`` marks 0 or 1, or the share of 1 where one class is missing.

    Of each class the ``sample_docs`` labels with the lowest hashes of the id are drawn, so the sample is
    bounded and the join with the texts broadcasts that many ids at most.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).filter("doc_id IS NOT NULL AND label IN (0, 1)")
    drawn = [marked.filter(F.col("label") == v).orderBy(F.xxhash64("doc_id", F.lit(8)), "doc_id").limit(sample_docs) for v in (0, 1)]
    sample = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .filter(F.length("text") <= sample_chars)
        .join(F.broadcast(drawn[0].union(drawn[1])), "doc_id").toArrow().sort_by([("doc_id", "ascending"), ("label", "ascending"), ("text", "ascending")])
    )
    y = np.array(sample.column("label").to_pylist(), np.float64)
    if len(np.unique(y)) < 2:
        return float(y.mean()) if len(y) else 0.5
    weight = fit_network(sample.column("text").combine_chunks(), y)
    return weight


def scored(docs: DataFrame, model: Network | float, least: float = 0.7) -> DataFrame:
    """``(doc_id, score, predicted)`` of every row.

    A null text counts as empty, and an empty one is scored as one chunk of padding. Repeated rows are
    scored each, null ids stay null, other columns are ignored, an empty table gives an empty result.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.full(batch.num_rows, model if isinstance(model, float) else 0.0)
            if isinstance(model, Network):
                data, limits = text_buffer(batch.column(1))
                begin = 0
                while begin < batch.num_rows:
                    end = max(begin + 1, int(np.searchsorted(limits, limits[begin] + CHUNK_BYTES, side="right")) - 1)
                    laid = laid_out(data[limits[begin] : limits[end]], limits[begin : end + 1] - limits[begin])
                    score[begin:end] = 1 / (1 + np.exp(-np.clip(log_odds(model, *laid), -30, 30)))
                    begin = end
            yield batch_of(doc_id=batch.column(0), score=score)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(work, "doc_id long, score double")
    return rows.withColumn("predicted", (F.col("score") >= least).cast("int"))


def classify(docs: DataFrame, labels: DataFrame, training: Column | None = None, **bounds) -> DataFrame:
    """Learn from the labels for whose rows ``training`` holds, then score every document."""
    return scored(docs, fit(docs, labels if training is None else labels.filter(training), **bounds))
