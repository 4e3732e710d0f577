"""Toxicity by multiple-instance learning: only documents are labelled, sentences are scored.

A sentence's score is a logistic function of its features; a document's is the noisy-or of its sentences',
1 - prod(1 - s). Training follows the gradient of the document likelihood through the noisy-or, so sentences learn from
document labels and then tell where the offence is.

Features of a word are its hash and the hashes of its first 4 to 9 bytes (word stems). Words are runs of bytes other
than ASCII punctuation and white space, with A-Z lower-cased.
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
from .words import Words, cuts

#: At most so many training rows of each class, of at most so many characters.
PER_CLASS, LONGEST = 3000, 16_000
STEMS = (4, 5, 6, 7, 8, 9)
#: A feature is kept if this many toxic training documents hold it and its odds there are this many times the others'.
LEAST_TOXIC, LEAST_ODDS = 3, 4.0
#: Prior weight of a sentence without known features, and the ridge penalty.
BIAS, RIDGE, STEPS, RATE = -7.0, 0.02, 300, 0.15
_BITS = 20

_APART = np.ones(256, bool)
_APART[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_STOPS = np.zeros(256, bool)
_STOPS[list(b".!?\n")] = True


class Sentences(NamedTuple):
    doc: np.ndarray  # text of each sentence that has a word
    start: np.ndarray  # byte positions of its first and behind its last word
    end: np.ndarray
    owner: np.ndarray  # sentence of each feature
    key: np.ndarray  # 64-bit feature


class Model(NamedTuple):
    keys: np.ndarray
    weights: np.ndarray
    bias: float
    slots: np.ndarray  # low bits of a key -> its place among ``keys``; the full key is compared
    others: np.ndarray  # places of the keys whose slot another one holds, in order of the keys


def sentences(data: np.ndarray, offsets: np.ndarray) -> Sentences:
    """Sentences (up to . ! ? or a line's end) of texts, with their features."""
    w = Words(data, offsets, separates=_APART)
    if not len(w.start):
        none = np.zeros(0, np.int64)
        return Sentences(none, none, none, none, none.astype(np.uint64))
    cuts = np.flatnonzero(_STOPS[w.data])
    part = np.searchsorted(cuts, w.start)
    new = np.ones(len(part), bool)
    new[1:] = (part[1:] != part[:-1]) | (w.doc[1:] != w.doc[:-1])
    first = np.flatnonzero(new)
    of = np.cumsum(new) - 1
    owners, keys = [of], [w.hashes()]
    size = w.end - w.start
    for n in STEMS:
        long = np.flatnonzero(size > n)
        owners.append(of[long])
        keys.append(w.spans(w.start[long], w.start[long] + n) ^ np.uint64(0x5BD1E9955BD1E995 + n))
    last = np.append(first[1:], len(part)) - 1
    return Sentences(w.doc[first], w.start[first], w.end[last], np.concatenate(owners), np.concatenate(keys))


def make_model(keys: np.ndarray, weights: np.ndarray, bias: float) -> Model:
    slots = np.full(1 << _BITS, -1, np.int32)
    at = (keys & np.uint64((1 << _BITS) - 1)).astype(np.int64)
    free = np.unique(at, return_index=True)[1]
    slots[at[free]] = free
    others = np.setdiff1d(np.arange(len(keys)), free)
    return Model(keys, weights.astype(np.float32), bias, slots, others[np.argsort(keys[others])])


def places(model: Model, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the features that the model knows, their places in it)."""
    if not len(model.keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = model.slots[(key & np.uint64((1 << _BITS) - 1)).astype(np.int64)]
    hit = np.flatnonzero(at >= 0)
    own = model.keys[at[hit]] == key[hit]
    found, place = hit[own], at[hit[own]]
    if len(model.others):
        rest = hit[~own]
        more, there = _known(key[rest], model.keys[model.others])
        found, place = np.concatenate((found, rest[more])), np.concatenate((place, model.others[there]))
    return found, place


def logits(model: Model, s: Sentences) -> np.ndarray:
    hit, at = places(model, s.key)
    return np.bincount(s.owner[hit], weights=model.weights[at], minlength=len(s.doc)) + model.bias


def sentence_scores(model: Model, s: Sentences) -> np.ndarray:
    return 1 / (1 + np.exp(-logits(model, s)))


def noisy_or(scores: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    return -np.expm1(np.bincount(doc, weights=np.log1p(-np.minimum(scores, 1 - 1e-12)), minlength=n))


def long_text(model: Model, data: np.ndarray, limit: int = SLICE_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (bytes) and score of the sentences of one text, a piece of about ``limit`` bytes at a time.

    A sentence that goes on behind a piece, however often, adds up what its parts have. Only a single word is never cut.
    """
    places = cuts(data, _APART, limit)
    starts, ends, sums = [], [], []
    for lo, hi in zip(places[:-1], places[1:], strict=True):
        s = sentences(data[lo:hi], np.array([0, hi - lo]))
        if not len(s.doc):
            continue
        z, start, end = logits(model, s), s.start + np.int64(lo), s.end + np.int64(lo)
        if sums and not _STOPS[data[ends[-1][-1] : start[0]]].any():
            sums[-1][-1] += z[0] - model.bias
            ends[-1][-1] = end[0]
            z, start, end = z[1:], start[1:], end[1:]
        if len(z):
            starts.append(start)
            ends.append(end)
            sums.append(z)
    if not sums:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0)
    return np.concatenate(starts), np.concatenate(ends), 1 / (1 + np.exp(-np.concatenate(sums)))


def _parts(texts: list[str], rows: np.ndarray) -> Iterator[tuple[np.ndarray, Sentences]]:
    """Sentences of the texts numbered ``rows``, a slice at a time, with those numbers; features are never held for all texts."""
    data, offsets = column_bytes(pa.array([texts[i] for i in rows], pa.string()))
    for lo, hi in slices(offsets):
        yield rows[lo:hi], sentences(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])


def _known(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the keys that are in the sorted ``wanted``, their places there)."""
    at = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
    hit = np.flatnonzero(wanted[at] == keys)
    return hit, at[hit]


def train(texts: list[str], y: np.ndarray, weight: np.ndarray) -> Model:
    """Fit the noisy-or model to document labels. Without rows of both classes every sentence gets the prior."""
    nothing = make_model(np.zeros(0, np.uint64), np.zeros(0), BIAS)
    if not len(texts) or len(set(y.tolist())) < 2:
        return nothing
    # Features of enough toxic documents, then their document frequency among the others.
    toxic, clean = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    seen = []
    for rows, s in _parts(texts, toxic):
        keys, code = np.unique(s.key, return_inverse=True)
        seen.append(keys[np.unique(code.astype(np.int64) * len(rows) + s.doc[s.owner]) // len(rows)])
    keys, pos = np.unique(np.concatenate(seen), return_counts=True)
    keys, pos = keys[pos >= LEAST_TOXIC], pos[pos >= LEAST_TOXIC]
    if not len(keys):
        return nothing
    neg = np.zeros(len(keys), np.int64)
    for rows, s in _parts(texts, clean):
        hit, at = _known(s.key, keys)
        neg += np.bincount(np.unique(at * len(rows) + s.doc[s.owner[hit]]) // len(rows), minlength=len(keys))
    keys = keys[((pos + 0.5) / len(toxic)) / ((neg + 0.5) / len(clean)) >= LEAST_ODDS]
    if not len(keys):
        return nothing
    docs, owners, features, n = [], [], [], 0
    for rows, s in _parts(texts, np.arange(len(texts))):
        hit, at = _known(s.key, keys)
        docs.append(rows[s.doc])
        owners.append(s.owner[hit] + n)
        features.append(at)
        n += len(s.doc)
    doc, owner, feature, kept = np.concatenate(docs), np.concatenate(owners), np.concatenate(features), keys
    v, bias = np.zeros(len(kept)), BIAS
    m1, m2 = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(owner, weights=v[feature], minlength=n) + bias
        score = 1 / (1 + np.exp(-z))
        p = np.clip(noisy_or(score, doc, len(texts)), 1e-9, 1 - 1e-9)
        pull = np.where(y == 1, (1 - p) / p, -1.0) * weight
        g = pull[doc] * score
        grad = np.append(np.bincount(feature, weights=g[owner], minlength=len(kept)) - RIDGE * v, g.sum() - len(texts) * RIDGE * (bias - BIAS))
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad**2
        move = RATE * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
        v, bias = v + move[:-1], bias + move[-1]
    return make_model(keys, v, float(bias))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, longest: int = LONGEST) -> Model:
    return train(*training_rows(docs, labels, "toxic", per_class, longest))


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, n_sentences, offending.

    ``offending``: spans (start, end; code points) and scores of the sentences that score 0.5 or more, in order. A null
    or empty text, or one without a word, has no sentence and the score 0. Equal rows are scored alike; other columns
    are ignored; an empty table gives an empty one. A text of any length is scored whole, about a MB at a time.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            data, offsets = column_bytes(batch.column(2))
            for lo, hi in slices(offsets):
                text, part = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                if hi - lo == 1:
                    start, end, score = long_text(model, text)
                    doc = np.zeros(len(score), np.int64)
                else:
                    s = sentences(text, part)
                    doc, start, end, score = s.doc, s.start, s.end, sentence_scores(model, s)
                total = noisy_or(score, doc, hi - lo)
                found: list[list[dict]] = [[] for _ in range(hi - lo)]
                for i in np.flatnonzero(score >= 0.5):
                    before, inside = text[part[doc[i]] : start[i]], text[start[i] : end[i]]
                    first = int(np.count_nonzero((before & 0xC0) != 0x80))
                    found[doc[i]].append({"start": first, "end": first + int(np.count_nonzero((inside & 0xC0) != 0x80)), "score": score[i]})
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], batch.column(1)[lo:hi], pa.array(total), pa.array((total >= 0.5).astype(np.int32)), pa.array(np.bincount(doc, minlength=hi - lo)), pa.array(found, pa.list_(span))],
                    ["doc_id", "held_out", "score", "predicted", "n_sentences", "offending"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, n_sentences long, offending array<struct<start: long, end: long, score: double>>")
