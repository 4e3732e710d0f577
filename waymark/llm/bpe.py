"""Byte-level BPE encoding in overlapping chunks, and decoding.

Pre-tokens are matches of a pattern that covers every character and looks only ahead, so a match depends on nothing
left of its start. A long text is cut into chunks that overlap; each is matched on its own, from whatever place it
starts. A border at which the sequence so far and the next chunk agree is a point where they have resynchronised: from
there on the next chunk's borders are the true ones. Matches that touch a chunk's end may be cut short, and one that ends
within the pattern's look-ahead of it may have missed a longer alternative ("'" of "'ll"); neither is used. Where an overlap has no common border (a run of letters longer than the overlap) matching goes on from the last
true border until it meets one. Pieces between borders are then merged by rank, each on its own; decoding concatenates
the raw bytes of the ids.

Chunks of a long text are matched by several threads at once (the pattern engine lets go of the interpreter's lock), a few
chunks ahead of the stitching, and go on to digests or bytes one by one: no list of a long text's pieces is ever held.
"""

from __future__ import annotations

import base64
import hashlib
from collections import deque
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache

import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cluster import held, text_of

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: ``\s`` is spelled out, as the library's pattern engine and this one may differ on control characters.
_SPACE = r"\x09-\x0D\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
CHUNK, OVERLAP = 1 << 14, 1 << 8
#: A match that ends at least so many characters before a chunk's end is the whole text's: the longest fixed alternatives
#: ("'ll") have three characters, all others look one character past their end.
AHEAD = 3
#: Distinct pieces whose ids a worker remembers.
REMEMBERED = 400_000
#: Threads that match the chunks of one text, and the chunks from which on they do.
THREADS, SPREAD = 4, 4


@lru_cache(maxsize=1)
def pattern() -> regex.Pattern:
    p = public_tokenizers.PATTERN.replace(r"[^\s", f"[^{_SPACE}").replace(r"\S", f"[^{_SPACE}]").replace(r"\s", f"[{_SPACE}]")
    return regex.compile(p)


def _borders(text: str, lo: int, hi: int) -> list[int]:
    """Ends of the matches in text[lo:hi], by place in the text."""
    out, at = [], lo
    for piece in pattern().findall(text, lo, hi, concurrent=True):
        at += len(piece)
        out.append(at)
    return out


def _parts(text: str, spans: list[tuple[int, int]], threads: int) -> Iterator[list[int]]:
    """The borders of each span, in order; with threads, matched a little ahead."""
    if threads < 2:
        yield from (_borders(text, *s) for s in spans)
        return
    with ThreadPoolExecutor(threads) as pool:
        waiting: deque = deque()
        for s in spans:
            waiting.append(pool.submit(_borders, text, *s))
            if len(waiting) > 2 * threads:
                yield waiting.popleft().result()
        while waiting:
            yield waiting.popleft().result()


def runs(text: str, chunk: int = CHUNK, overlap: int = OVERLAP, threads: int = 1) -> Iterator[list[str]]:
    """The pre-tokens of ``text``, a chunk's at a time; together the same for every chunk size and overlap of at least one character."""
    n = len(text)
    if n <= chunk + overlap:
        yield pattern().findall(text)
        return
    spans = [(lo, min(n, lo + chunk + overlap)) for lo in range(0, n, chunk)]
    last = 0
    for (lo, hi), ends in zip(spans, _parts(text, spans, threads), strict=True):
        if hi <= last:
            continue
        true, known = [last], set(ends)
        if lo == 0:
            known.add(0)
        # Go on from the last true border to a border of this chunk; a bridge is needed only if the two never agreed.
        while true[-1] not in known and true[-1] < hi:
            at = true[-1]
            reach = hi + overlap
            step = pattern().match(text, at, min(n, reach))
            while step.end() > reach - AHEAD and reach < n:
                reach = min(n, 2 * reach - at)
                step = pattern().match(text, at, reach)
            true.append(step.end())
        last = true[-1]
        true.extend(e for e in ends if e > last and (e <= hi - AHEAD or hi == n))
        last = true[-1]
        yield [text[a:b] for a, b in zip(true[:-1], true[1:], strict=True)]


def pretokens(text: str, chunk: int = CHUNK, overlap: int = OVERLAP, threads: int = 1) -> list[str]:
    return [piece for run in runs(text, chunk, overlap, threads) for piece in run]


class Codec:
    """Encoder and decoder for one file of ranks."""

    def __init__(self, path: str = RANKS):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        # Takes what it is given as one piece, as pieces are cut here.
        self.merge = tiktoken.Encoding("ranks", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.raw = [b""] * (max(ranks.values()) + 1)
        for piece, i in ranks.items():
            self.raw[i] = piece
        self.names = [str(i) for i in range(len(self.raw))]
        self.seen: dict[str, list[int]] = {}

    def blocks(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Iterator[list[int]]:
        """The ids of ``text``, a chunk's at a time."""
        seen, merge = self.seen, self.merge
        for run in runs(text, chunk, overlap, THREADS if len(text) >= SPREAD * chunk else 1):
            out: list[int] = []
            for piece in run:
                ids = seen.get(piece)
                if ids is None:
                    ids = merge(piece)
                    if len(piece) <= 64:
                        if len(seen) >= REMEMBERED:
                            seen.clear()
                        seen[piece] = ids
                out += ids
            yield out

    def encode(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
        return [i for ids in self.blocks(text, chunk, overlap) for i in ids]

    def decode(self, ids: list[int]) -> bytes:
        raw = self.raw
        return b"".join([raw[i] for i in ids])

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the decimal ids joined by commas, SHA-256 of the decoded bytes."""
        n, listed, decoded, names = 0, hashlib.sha256(), hashlib.sha256(), self.names
        for ids in self.blocks(text):
            if ids:
                listed.update((b"," if n else b"") + ",".join([names[i] for i in ids]).encode())
                decoded.update(self.decode(ids))
                n += len(ids)
        return n, listed.hexdigest(), decoded.hexdigest()


def codec(path: str = RANKS) -> Codec:
    return held(f"bpe {path}", lambda: Codec(path))


def encoded(docs: DataFrame, path: str = RANKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every row; a null or empty text has no ids. Other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                ids = [c.encode(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, path: str = RANKS) -> DataFrame:
    """(doc_id, bytes binary) of the rows of ``encoded``; null ids decode to no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([c.decode(x or []) for x in part.column(1).to_pylist()], pa.binary())], ["doc_id", "bytes"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def round_trips(docs: DataFrame, path: str = RANKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, then decode, each whole text in one pass and return digests: doc_id, n_tokens, ids_sha256, decoded_sha256.

    A null or empty text has no tokens and the digests of nothing. One row per row; equal rows give equal rows; an
    empty table gives an empty one; other columns are ignored. Beside a text only a few of its chunks are held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            out = [c.digests(text.as_py()) for text in batch.column(1)]
            n, a, b = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
