"""Packing documents into sequences of a fixed capacity: dominance reduction, then best fit.

A document becomes tokens and an end token, and is cut only if it is longer than the capacity. Only the lengths of the
pieces matter for packing, and there are at most ``capacity`` of them, so the instance is a histogram of bounded size
however many documents there are. The plan is made for that histogram:

* Martello-Toth reduction. For the largest remaining length j the sets that fill a bin together with it are compared.
  A set F dominates another if that one can be split into parts of which each fits in the place of an item of F; if F
  dominates all sets with j, an optimal packing exists with the bin F, and it is fixed for good. Sets of up to three
  items are tried, and a fixed pattern is repeated as long as its lengths last, as removing items never weakens it.
* Best-fit decreasing packs what remains, a length and a group of equally full bins at a time.

Pieces then find their places by rank among the pieces of their length: ranks are counted within each task, made
global by a window over task totals, and looked up in the plan, whose size is bounded by the capacity as well.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import chain
from itertools import count as numbers
from struct import pack

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .cluster import frozen, held, text_of

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
CAPACITY = 4096
END = 1
#: Distinct pre-tokens whose ids a worker remembers.
REMEMBERED = 600_000
#: Characters of a text that are encoded at once.
AT_ONCE = 1 << 20


_BLANK = re.compile(r"[ \t-\r]+")
#: Letters that are the same in every version of Unicode, need no NFC, and whose lower case is among them: with ASCII, the plain characters.
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u017f"
_PLAIN = re.compile(r"[\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]*")
#: The tokenizer's own pre-tokens, for lower-cased plain text; runs of letters are tried first, as none of the others begins with one.
_PRETOKEN = re.compile(rf"[{_LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^ \t-\r{_LETTERS}0-9]+")


class WordCodec:
    """Ids of whole texts, from remembered ids of their pre-tokens.

    The tokenizer drops white space and merges within pre-tokens only. For texts of plain characters (ASCII and Latin
    letters) they are cut here; any other text is cut at ASCII white space, across which neither NFC nor lower-casing
    acts, and its words are given to the tokenizer as they are. Unknown pre-tokens of plain text go to the tokenizer's model
    in the alphabet of its byte-level step, as the steps before it leave them as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        tokenizer = Tokenizer.from_file(path)
        self.tokenizer = tokenizer
        self.merge = tokenizer.model.tokenize
        as_bytes = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.alphabet = {i: as_bytes(chr(i))[0][0] for i in range(0x180) if chr(i) not in " \t\n\v\f\r"}
        self.plain: dict[str, bytes] = {}
        self.other: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids of pre-tokens of plain text."""
        merge, alphabet, out = self.merge, self.alphabet, {}
        for w in words:
            ids = [t.id for t in merge(w if w.isascii() and w.isprintable() else w.translate(alphabet))]
            out[w] = pack(f"<{len(ids)}I", *ids)
        return out

    def encode(self, texts: list[str], end: int | None = None) -> list[bytes]:
        """Little-endian 32-bit ids of each text, with ``end`` after them if given."""
        last = b"" if end is None else np.array([end], "<u4").tobytes()
        plain, parts = self.plain, []
        for text in texts:
            if _PLAIN.fullmatch(text) and "<|" not in text:
                parts.append((plain, _PRETOKEN.findall(text.lower())))
            else:
                parts.append((self.other, _BLANK.split(text)))
        words = set(chain.from_iterable(ws for known, ws in parts if known is plain))
        if len(plain) + len(words) > REMEMBERED:
            plain.clear()
        plain.update(self._learn(words.difference(plain)))
        if len(self.other) > REMEMBERED // 4:
            self.other.clear()
        for known, ws in parts:
            if known is self.other:
                for w in ws:
                    if w not in known:
                        known[w] = self._ids(w).tobytes()
        return [b"".join(map(known.__getitem__, ws)) + last for known, ws in parts]


def parts(text: str, limit: int = AT_ONCE) -> Iterator[str]:
    """A text in parts whose ids add up to the whole text's: cut at ASCII white space, which no pre-token holds."""
    at = 0
    while len(text) - at > limit:
        cut = _BLANK.search(text, at + limit)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def cut_ids(ids: Iterator[bytes], capacity: int) -> Iterator[bytes]:
    """The ids of a text, given in parts, in pieces of ``capacity``; the last may be shorter."""
    rest = b""
    for part in ids:
        part = rest + part
        whole = len(part) - len(part) % (4 * capacity)
        for at in range(0, whole, 4 * capacity):
            yield part[at : at + 4 * capacity]
        rest = part[whole:]
    if rest:
        yield rest


def word_codec(path: str = TOKENIZER) -> WordCodec:
    return held(f"words {path}", lambda: WordCodec(path))


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str = TOKENIZER, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, task, rank): the pieces of every row; ``rank`` counts the earlier
    pieces of the same length in the same task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, task, ranks = word_codec(path), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        last = np.array([end], "<u4").tobytes()
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                out = []
                part = batch.slice(lo, 128)
                texts = part.column(1).to_pylist()
                short = iter(codec.encode([t for t in texts if len(t) <= AT_ONCE], end))
                for doc, text in zip(part.column(0).to_pylist(), texts, strict=True):
                    ids = iter([next(short)]) if len(text) <= AT_ONCE else chain((codec.encode([p])[0] for p in parts(text)), [last])
                    for piece, own in enumerate(cut_ids(ids, capacity)):
                        n = len(own) // 4
                        out.append((doc, piece, piece * capacity, n, zlib.crc32(own), task, int(ranks[n])))
                        ranks[n] += 1
                columns = zip(*out, strict=True)
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long")


Pattern = tuple[tuple[tuple[int, int], ...], int]  # ((length, times), ...), bins


def _third(sizes: list[int], left: dict[int, int], room: int) -> tuple[int, int] | None:
    """The largest sum a + b <= room of two remaining items, a >= b; ``sizes`` ascending. Among equal sums the one with the largest a."""
    best, lo, hi = None, 0, len(sizes) - 1
    while lo <= hi:
        b, a = sizes[lo], sizes[hi]
        if a + b > room or (lo == hi and left[a] < 2):
            hi -= 1
            continue
        if best is None or a + b > sum(best):
            best = (a, b)
        lo += 1
    return best


def reduce_instance(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Bins fixed by dominance, and the counts that remain."""
    left = {s: n for s, n in counts.items() if n > 0}
    sizes = sorted(left)
    fixed: list[Pattern] = []

    def take(pattern: dict[int, int], bins: int) -> None:
        fixed.append((tuple(sorted(pattern.items(), reverse=True)), bins))
        for s, times in pattern.items():
            left[s] -= times * bins
            if not left[s]:
                del left[s]
                sizes.pop(bisect_left(sizes, s))

    def smallest(k: int, above: int = 0) -> list[int]:
        out: list[int] = []
        for s in sizes[bisect_left(sizes, above + 1) :]:
            out += [s] * min(k - len(out), left[s])
            if len(out) == k:
                break
        return out

    for j in sorted(counts, reverse=True):
        while j in left:
            room = capacity - j
            left[j] -= 1  # the item itself is not among its partners
            if not left[j]:
                del left[j]
                sizes.pop(bisect_left(sizes, j))
            at = bisect_left(sizes, room + 1) - 1
            few = smallest(3)
            pattern = None
            if at < 0:
                pattern = {j: 1}
            else:
                k = sizes[at]
                if k == room or sum(few[:2]) > room or len(few) < 2:
                    pattern = [j, k]
                elif len(few) < 3 or sum(few) > room:
                    pair = _third(sizes, left, room)
                    if pair is None or k >= sum(pair):
                        pattern = [j, k]
                    elif pair[0] == k:
                        bigger = smallest(2, pair[1])
                        if len(bigger) < 2 or sum(bigger) > room:
                            pattern = [j, *pair]
                if pattern is not None:
                    pattern = {s: pattern.count(s) for s in pattern}
            if j not in left:
                left[j] = 0
                insort(sizes, j)
            left[j] += 1
            if pattern is None:
                break
            take(pattern, min(left[s] // times for s, times in pattern.items()))
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing, for groups of equal items and equal bins at once."""
    open_bins: dict[int, list[Pattern]] = {}
    rooms: list[int] = []

    def put(room: int, pattern: Pattern) -> None:
        if room not in open_bins:
            open_bins[room] = []
            insort(rooms, room)
        open_bins[room].append(pattern)

    for s in sorted(counts, reverse=True):
        m = counts[s]
        while m:
            at = bisect_left(rooms, s)
            if at == len(rooms):
                each = capacity // s
                if full := m // each:
                    put(capacity - each * s, (((s, each),), full))
                if rest := m % each:
                    put(capacity - rest * s, (((s, rest),), 1))
                break
            room = rooms[at]
            items, bins = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room], rooms[at]
            each = room // s
            full = min(bins, m // each)
            rest = min(m - full * each, each) if full < bins else 0
            if full:
                put(room - each * s, ((*items, (s, each)), full))
            if rest:
                put(room - rest * s, ((*items, (s, rest)), 1))
            if bins - full - bool(rest):
                put(room, (items, bins - full - bool(rest)))
            m -= full * each + rest
    return [p for ps in open_bins.values() for p in ps]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns whose items are exactly ``counts``."""
    if counts and not 0 < min(counts) <= max(counts) <= capacity:
        raise ValueError("a length is not between 1 and the capacity")
    fixed, left = reduce_instance(counts, capacity)
    return fixed + best_fit(left, capacity)


def segments(patterns: list[Pattern], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (first rank, first sequence, offset, times, length), ordered by length and rank."""
    rows, ranks, sequence = [], np.zeros(capacity + 2, np.int64), 0
    order = numbers()
    for items, bins in patterns:
        offset = 0
        for s, times in items:
            rows.append((s, next(order), int(ranks[s]), sequence, offset, times))
            ranks[s] += bins * times
            offset += s * times
        sequence += bins
    rows.sort()
    return np.array([(r, q, o, t, s) for s, _, r, q, o, t in rows], np.int64).reshape(-1, 5)


def packed(docs: DataFrame, capacity: int = CAPACITY, path: str = TOKENIZER, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Sequences are gapless from offset 0 and hold at most ``capacity`` tokens. A null or empty text is its end token
    alone. Rows with the same or a null id are packed each on its own. Other columns are ignored. An empty table gives
    an empty one.
    """
    spark = docs.sparkSession
    rows = frozen(pieces(docs, capacity, path, end, id_col, text_col))
    totals = rows.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    totals = frozen(totals.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))))
    counts = {r[0]: r[1] for r in totals.groupBy("length").agg(F.sum("n")).collect()}  # at most ``capacity`` rows
    table = spark.sparkContext.broadcast(segments(plan(counts, capacity), capacity))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = table.value
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            # Ranks of one length are below 2**48, so length and rank order as one number.
            at = np.searchsorted((rows[:, 4] << 48) + rows[:, 0], (length << 48) + rank, "right") - 1
            first, sequence, offset, times = rows[at, :4].T
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["doc_id", "piece", "start", "length", "ids_crc32"]).columns, pa.array(sequence + (rank - first) // times), pa.array(offset + (rank - first) % times * length)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    ranked = rows.join(totals.select("task", "length", "base"), ["task", "length"]).withColumn("rank", F.col("rank") + F.col("base"))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
