"""Quality classifier: a convolutional network over bytes, trained and applied with numpy.

Bytes are embedded; learned filters of WIDTH bytes slide over the whole text in steps of STRIDE. Chunks of two
segments overlap by one segment and cover the text; each filter's response is max-pooled in a chunk. The largest and the
mean response over all chunks are combined into one probability.

A filter is applied as one matrix product of non-overlapping STRIDE-byte blocks with all its parts at once; the parts
are then added with shifts, so no window is ever copied.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cluster import SLICE_BYTES, column_bytes, slices, text_of
from .labelled import held_out, training_rows

DIM, WIDTH, STRIDE, FILTERS = 8, 16, 4, 16
SEGMENT = 256
PARTS = WIDTH // STRIDE
#: At most so many training rows of each class, of at most so many characters.
PER_CLASS, LONGEST = 1500, 16_000
#: Training: epochs, rows in a step, segments of a row that an epoch looks at (a run at a random place), rate.
EPOCHS, STEP_ROWS, RUN, RATE = 14, 64, 8, 0.02


class Net(NamedTuple):
    embed: np.ndarray  # (256, DIM)
    filters: np.ndarray  # (STRIDE * DIM, PARTS * FILTERS)
    bias: np.ndarray  # (FILTERS,)
    out: np.ndarray  # (2 * FILTERS,): for the largest, then for the mean responses
    out_bias: np.ndarray  # (1,)


def layout(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First segment of each text (and the end), with a window's room behind it; an empty text has one segment."""
    n = np.maximum(1, -(-(lengths + WIDTH) // SEGMENT))
    return np.concatenate(([0], np.cumsum(n))), n


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with every text moved to a segment's start and zeros behind it, first segments, lengths."""
    lengths = np.diff(offsets)
    first, _ = layout(lengths)
    out = np.zeros(first[-1] * SEGMENT, np.uint8)
    if len(data):
        out[np.arange(len(data)) + np.repeat(first[:-1] * SEGMENT - offsets[:-1], lengths)] = data
    return out, first, lengths


def responses(net: Net, x: np.ndarray, first: np.ndarray | None = None) -> np.ndarray:
    """(segments, STRIDE-blocks, filters) before pooling. With the texts' first segments, the windows that would go on
    into the next text (they start in the room behind a text, in its last PARTS - 1 blocks) have no response."""
    blocks = net.embed[x].reshape(-1, STRIDE * DIM)
    y = blocks @ net.filters
    r = y[:, :FILTERS].copy()
    for k in range(1, PARTS):
        r[:-k] += y[k:, k * FILTERS : (k + 1) * FILTERS]
    r = r.reshape(-1, SEGMENT // STRIDE, FILTERS)
    if first is not None:
        r[first[1:] - 1, 1 - PARTS :] = -np.inf
    return r


def chunk_starts(first: np.ndarray) -> np.ndarray:
    """Second segment of each chunk: the next one, or itself at a text's end."""
    i = np.arange(first[-1])
    nxt = i + 1
    nxt[first[1:] - 1] = first[1:] - 1
    return nxt


def pooled(net: Net, x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Segment responses, rectified maxima."""
    return np.maximum(responses(net, x, first).max(axis=1) + net.bias, 0)


def long_pooled(net: Net, data: np.ndarray, limit: int = SLICE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """``pooled`` of one text, of about ``limit`` bytes at a time, and its first segment and end."""
    first, _ = layout(np.array([len(data)]))
    out = np.empty((first[-1], FILTERS), np.float32)
    step = max(1, limit // SEGMENT)
    for lo in range(0, len(out), step):
        hi = min(len(out), lo + step)
        x = np.zeros((hi - lo + 1) * SEGMENT, np.uint8)  # with the segment behind, into which windows reach
        part = data[lo * SEGMENT : (hi + 1) * SEGMENT]
        x[: len(part)] = part
        end = np.array([0, hi - lo]) if hi == len(out) else None
        out[lo:hi] = np.maximum(responses(net, x, end)[: hi - lo].max(axis=1) + net.bias, 0)
    return out, first


def combined(net: Net, seg: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Logits of texts from their segments' responses."""
    chunk = np.maximum(seg, seg[chunk_starts(first)])
    most = np.maximum.reduceat(chunk, first[:-1])
    mean = np.add.reduceat(chunk, first[:-1]) / np.diff(first)[:, None]
    return np.concatenate((most, mean), axis=1) @ net.out + net.out_bias


def logits(net: Net, x: np.ndarray, first: np.ndarray) -> np.ndarray:
    return combined(net, pooled(net, x, first), first)


def start_net(seed: int = 5) -> Net:
    r = np.random.default_rng(seed)
    f = lambda *s, scale: (r.standard_normal(s) * scale).astype(np.float32)
    return Net(f(256, DIM, scale=0.5), f(STRIDE * DIM, PARTS * FILTERS, scale=0.15), np.zeros(FILTERS, np.float32), f(2 * FILTERS, scale=0.1), np.zeros(1, np.float32))


def gradients(net: Net, x: np.ndarray, first: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """Of the weighted mean log loss, for each part of the network."""
    r = responses(net, x, first)
    at = r.argmax(axis=1)
    top = np.take_along_axis(r, at[:, None], axis=1)[:, 0] + net.bias
    seg = np.maximum(top, 0)
    nxt = chunk_starts(first)
    second = seg[nxt] > seg
    chunk = np.where(second, seg[nxt], seg)
    n, docs = np.diff(first), np.repeat(np.arange(len(y)), np.diff(first))
    most = np.maximum.reduceat(chunk, first[:-1])
    mean = np.add.reduceat(chunk, first[:-1]) / n[:, None]
    feature = np.concatenate((most, mean), axis=1)
    g = (1 / (1 + np.exp(-(feature @ net.out + net.out_bias))) - y) * weight / len(y)
    width = FILTERS
    is_most = chunk == most[docs]
    ties = np.add.reduceat(is_most.astype(np.float32), first[:-1])
    g_chunk = g[docs, None] * (net.out[:width] * is_most / ties[docs] + net.out[width:] / n[docs, None])
    g_seg = np.where(second, 0, g_chunk)
    np.add.at(g_seg, nxt, np.where(second, g_chunk, 0))
    g_top = g_seg * (top > 0)
    # Only the window of each maximum carries a gradient.
    g_filters, g_embed = np.zeros_like(net.filters), np.zeros_like(net.embed)
    blocks = np.concatenate((net.embed[x].reshape(-1, STRIDE * DIM), np.zeros((PARTS, STRIDE * DIM), np.float32)))
    bytes_of = np.concatenate((x, np.zeros(WIDTH, np.uint8))).reshape(-1, STRIDE)
    base = np.arange(len(seg)) * (SEGMENT // STRIDE)
    for f in range(FILTERS):
        live = np.flatnonzero(g_top[:, f])
        if not len(live):
            continue
        window = base[live] + at[live, f]
        for k in range(PARTS):
            c = k * FILTERS + f
            g_filters[:, c] += g_top[live, f] @ blocks[window + k]
            inside = window + k < len(seg) * (SEGMENT // STRIDE)  # a window at the very end has no more parts
            back = np.outer(g_top[live, f] * inside, net.filters[:, c]).reshape(-1, DIM)
            code = bytes_of[window + k].ravel()
            for d in range(DIM):
                g_embed[:, d] += np.bincount(code, weights=back[:, d], minlength=256)
    return [g_embed, g_filters, g_top.sum(axis=0), feature.T @ g, g.sum(keepdims=True)]


def train(texts: list[str], y: np.ndarray, weight: np.ndarray, seed: int = 5) -> Net:
    """Fit by Adam. Without rows of both classes the network answers with the class there is, or 0.5."""
    net = start_net(seed)
    if len(set(y.tolist())) < 2:
        return net._replace(out=net.out * 0, out_bias=np.array([0.0 if not len(y) else 4.0 if y[0] else -4.0], np.float32))
    data, offsets = column_bytes(pa.array(texts, pa.string()))
    r = np.random.default_rng(seed)
    first_moment, second_moment, step = [np.zeros_like(p) for p in net], [np.zeros_like(p) for p in net], 0
    steps = max(EPOCHS * -(-len(y) // STEP_ROWS), 250)  # small samples are seen more often
    order = np.zeros(0, np.int64)
    while step < steps:
        if len(order) < min(STEP_ROWS, len(y)):
            order = np.concatenate((order, r.permutation(len(y))))
        rows, order = order[:STEP_ROWS], order[STEP_ROWS:]
        room = np.maximum(0, np.diff(offsets)[rows] - RUN * SEGMENT)
        start = offsets[rows] + (r.random(len(rows)) * (room + 1)).astype(np.int64)
        end = np.minimum(start + RUN * SEGMENT - WIDTH, offsets[rows + 1])
        part = np.concatenate([data[a:b] for a, b in zip(start, end, strict=True)])
        x, first, _ = padded(part, np.concatenate(([0], np.cumsum(end - start))))
        step += 1
        rate = RATE * min(1, 2 * (1 - step / (steps + 1)))
        new = []
        for p, g, m, v in zip(net, gradients(net, x, first, y[rows], weight[rows]), first_moment, second_moment, strict=True):
            g = g.astype(np.float32) + 1e-4 * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            new.append(p - np.float32(rate) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + np.float32(1e-6)))
        net = Net(*new)
    return net


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, longest: int = LONGEST) -> Net:
    return train(*training_rows(docs, labels, "quality", per_class, longest))


def scored(docs: DataFrame, net: Net, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (probability of quality 1), predicted.

    Every byte of a text is in some window. A null or empty text is one empty chunk, so its score is the network's answer
    to no evidence. Equal rows are scored alike; other columns are ignored; an empty table gives an empty one. A text of any
    length is read whole, about a MB at a time.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            data, offsets = column_bytes(batch.column(2))
            for lo, hi in slices(offsets):
                text = data[offsets[lo] : offsets[hi]]
                if hi - lo == 1:
                    z = combined(net, *long_pooled(net, text))
                else:
                    z = logits(net, *padded(text, offsets[lo : hi + 1] - offsets[lo])[:2])
                score = 1 / (1 + np.exp(-z.astype(np.float64)))
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], batch.column(1)[lo:hi], pa.array(score), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
