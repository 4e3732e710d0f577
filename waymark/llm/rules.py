"""Quality rules: base counts of each text, then the fertility of public tokenizers on it.

Text that is unlike what a vocabulary was made for costs more tokens for the same characters, falls back to single
bytes, or repeats few tokens. Three figures are taken over the whole text: characters per token and token entropy
(bits) with a byte-level BPE, and the share of byte-fallback tokens with a piece vocabulary. A document is rejected
when a figure leaves the band of its language, or of its script where the language has no band. Bands come from all
labelled good documents: ``measured`` takes every row's figures once, ``bands_of`` ranks those of the good ones exactly, and
``judged`` and ``verdict`` apply the bands to what was kept, so no text is read twice. Scripts and languages without enough
of them keep the wide bands below.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cluster import column_bytes, frozen, held, slices, text_of
from .labelled import held_out
from .ranks import at_ranks
from .words import Words, mix

BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Characters of a text that the tokenizers are given at once.
AT_ONCE = 1 << 20
#: Fitting: good documents that a language or script needs, the share of them that may leave a figure's band, and the room beyond.
ENOUGH, OUTSIDE, ROOM = 40, 0.005, 0.03


class Band(NamedTuple):
    """Accepted: characters per token in [low, high], byte-fallback share at most ``fallback``, and an entropy of at least
    ``entropy`` bits or of at least ``evenness`` of what as many different tokens would have (a short text cannot have many bits)."""

    low: float
    high: float
    fallback: float
    entropy: float
    evenness: float

    def accepts(self, rate: float, share: float, bits: float, evenness: float) -> bool:
        return self.low <= rate <= self.high and share <= self.fallback and (bits >= self.entropy or evenness >= self.evenness)


SCRIPTS = ("latin", "greek", "cyrillic", "arabic", "cjk", "other")
#: By script, where nothing is fitted: wide enough for ordinary prose of any language in it.
BANDS = {
    "latin": Band(1.9, 8.0, 0.2, 5.0, 0.7),
    "greek": Band(0.7, 8.0, 0.8, 4.5, 0.7),
    "cyrillic": Band(1.0, 8.0, 0.3, 4.5, 0.7),
    "arabic": Band(0.7, 8.0, 0.8, 4.5, 0.7),
    "cjk": Band(0.4, 5.0, 0.8, 4.5, 0.7),
    "other": Band(0.25, 8.0, 0.9, 4.0, 0.7),
}
#: Script of a letter by the first byte of its UTF-8 form; 0 is none of them.
_SCRIPT = np.zeros(256, np.uint8)
for _code, _first in enumerate((("AZ", "az", (0xC3, 0xC9)), ((0xCE, 0xCF),), ((0xD0, 0xD3),), ((0xD8, 0xDB),), ((0xE3, 0xED),), ((0xD4, 0xD7), (0xDC, 0xE2))), 1):
    for _lo, _hi in _first:
        _SCRIPT[(ord(_lo) if isinstance(_lo, str) else _lo) : (ord(_hi) if isinstance(_hi, str) else _hi) + 1] = _code
_CUT = re.compile(r"(?<=\S) (?=[^\W\d_])")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
#: First bytes of characters other than white space.
_IN_WORD = np.ones(256, bool)
_IN_WORD[[0x20, *range(0x09, 0x0E), *range(0x80, 0xC0)]] = False


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text; case counts."""
    w, n = Words(data, offsets, lower=False), len(offsets) - 1
    docs = np.arange(n)

    def per_text(where: np.ndarray) -> np.ndarray:
        """How many bytes of each text the table ``where`` marks."""
        if n == 1:
            return np.array([sum(int(np.count_nonzero(where[data[at : at + AT_ONCE]])) for at in range(0, len(data), AT_ONCE))])
        return np.diff(np.searchsorted(np.flatnonzero(where[data]), offsets))

    out = {"n_words": w.count, "word_chars": per_text(_IN_WORD), "n_symbols": per_text(_SYMBOL)}

    # Lines: cut at \n and at text borders; those with a word count, each distinct one once.
    cuts = np.unique(np.concatenate((offsets, np.flatnonzero(data == 0x0A) + 1)))
    start, end = cuts[:-1], cuts[1:].copy()
    if len(end):
        end[data[end - 1] == 0x0A] -= 1
    has = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    start, end = start[has], end[has]
    doc = np.searchsorted(offsets, start, "right") - 1
    line = mix(w.spans(start, end) ^ mix(doc.astype(np.uint64)))
    # Texts without bytes share an offset with the next one; searchsorted "right" gives the last of them, which has the line.
    out["n_dup_lines"] = np.bincount(doc, minlength=n) - np.bincount(doc[np.unique(line, return_index=True)[1]], minlength=n)

    window, doc = w.windows(3, whole=False)
    at = np.flatnonzero(w.doc[: max(0, len(w.doc) - 2)] == w.doc[2:]) if n > 1 else None
    if n > 1:
        window = mix(window ^ mix(doc.astype(np.uint64)))
    order = np.sort(window)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    del order
    cover = np.zeros(len(w.start) + 1, np.int32)
    for lo in range(0, len(window) if len(twice) else 0, AT_ONCE):
        part = window[lo : lo + AT_ONCE]
        again = np.flatnonzero(twice[np.minimum(np.searchsorted(twice, part), len(twice) - 1)] == part) + lo
        if at is not None:
            again = at[again]
        np.add.at(cover, again, 1)
        np.add.at(cover, again + 3, -1)
    covered = np.cumsum(cover, dtype=np.int32)[:-1] > 0
    out["n_repeat_words"] = np.bincount(w.doc[covered], minlength=n) if len(covered) else np.zeros(len(docs), np.int64)
    return out


def parts(text: str, limit: int = AT_ONCE) -> Iterator[tuple[str, str]]:
    """A text in parts for the BPE and for the pieces, whose tokens add up to the whole text's: cut before a space between a
    character and a letter, where a match of the BPE's pattern begins, and which the pieces put before every text by themselves."""
    at = 0
    while at < len(text):
        cut = _CUT.search(text, at + limit) if len(text) - at > limit else None
        end = cut.start() if cut else len(text)
        yield text[at:end], text[at + (at > 0) : end]
        at = end


class Fertility:
    """Token figures of texts, from the tokenizers' own tokens of the whole text."""

    def __init__(self, bpe: str = BPE, pieces: str = PIECES):
        with open(bpe, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode = tiktoken.Encoding("bands", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.byte = np.array([self.pieces.is_byte(i) for i in range(self.pieces.get_piece_size())])

    def figures(self, texts: list[str]) -> tuple[list[float], list[float], list[float], list[float]]:
        """Characters per token, byte-fallback share, entropy and its share of the most possible, of each text; zeros where it
        has no tokens."""
        rate, share, bits, even = [], [], [], []
        for text in texts:
            seen, n, single, n_pieces = None, 0, 0, 0
            for part, piece in parts(text):
                ids = np.array(self.encode(part), np.uint16)
                split = np.array(self.pieces.encode(piece), np.uint16)
                n, n_pieces = n + len(ids), n_pieces + len(split)
                single += int(np.count_nonzero(self.byte[split]))
                if len(part) == len(text):
                    seen = np.unique(ids, return_counts=True)[1]
                else:
                    seen = np.bincount(ids, minlength=1 << 16) + (0 if seen is None else seen)
            share_of = seen[seen > 0] / n if n else np.zeros(0)
            rate.append(len(text) / n if n else 0.0)
            share.append(single / n_pieces if n_pieces else 0.0)
            bits.append(float(-(share_of * np.log2(share_of)).sum()) if n else 0.0)
            even.append(bits[-1] / np.log2(n) if n > 1 else 0.0)
        return rate, share, bits, even


def fertility() -> Fertility:
    return held("fertility", Fertility)


def scripts_of(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    """The script of most letters of each text; of equal ones the first named, without letters "other"."""
    out = []
    for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        counts = np.zeros(len(SCRIPTS) + 1, np.int64)
        for at in range(lo, hi, 1 << 20):
            counts += np.bincount(_SCRIPT[data[at : min(hi, at + (1 << 20))]], minlength=len(counts))
        out.append(SCRIPTS[int(counts[1:].argmax())] if counts[1:].any() else "other")
    return out


Figures = tuple[list[float], list[float], list[float], list[float]]


def _figures(texts: pa.Array) -> Iterator[tuple[int, int, dict[str, np.ndarray], np.ndarray, list[str], Figures]]:
    """For runs of rows [lo, hi): base counts, base_failed, script and the four figures."""
    data, offsets = column_bytes(texts)
    meter = fertility()
    for lo, hi in slices(offsets):
        own, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        c = base_counts(own, at)
        failed = (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
        yield lo, hi, c, failed, scripts_of(own, at), meter.figures([t or "" for t in texts[lo:hi].to_pylist()])


def judge(texts: pa.Array, langs: list[str | None], bands: dict[str, Band] = BANDS) -> Iterator[tuple[int, int, dict[str, np.ndarray], np.ndarray, list[bool], Figures]]:
    """For runs of rows [lo, hi): base counts, base_failed, kept and the four figures; as ``verdict``, without Spark."""
    for lo, hi, c, failed, scripts, figures in _figures(texts):
        chosen = [bands.get(x) or bands[y] for x, y in zip(langs[lo:hi], scripts, strict=True)]
        kept = [not f and b.accepts(*x) for f, b, *x in zip(failed.tolist(), chosen, *figures, strict=True)]
        yield lo, hi, c, failed, kept, figures


def band(least: Sequence[float], most: Sequence[float]) -> Band:
    """The band with some room around the least and the most (rate, fallback, bits, evenness) that it is to hold."""
    return Band(float(least[0] * (1 - ROOM)), float(most[0] * (1 + ROOM)), float(most[1] * (1 + ROOM) + 0.01), float(least[2] * (1 - ROOM)), float(least[3] * (1 - ROOM)))


def band_of(figures: np.ndarray) -> Band:
    """The band that leaves out a share of at most OUTSIDE of the rows (rate, fallback, bits, evenness) per figure."""
    return band(np.quantile(figures, OUTSIDE, axis=0), np.quantile(figures, 1 - OUTSIDE, axis=0))


def lang_of(docs: DataFrame, lang_col: str = "lang") -> Column:
    """The language of a row, null where the table tells none."""
    return (F.col(f"`{lang_col}`") if lang_col in docs.columns else F.lit(None)).cast("string")


COUNTS, FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), ("chars_per_token", "fallback_share", "token_entropy", "token_evenness")
MEASURES = pa.struct([*((c, pa.int64()) for c in COUNTS), ("base_failed", pa.bool_()), ("script", pa.string()), *((c, pa.float64()) for c in FIGURES)])
MEASURES_DDL = f"struct<{', '.join(f'{c}: long' for c in COUNTS)}, base_failed: boolean, script: string, {', '.join(f'{c}: double' for c in FIGURES)}>"


def measures(text_col: str = "text") -> Column:
    """Base counts, base_failed, script and figures of a text, whole; null is empty."""

    def run(texts: pa.Array) -> pa.Array:
        out = [
            pa.StructArray.from_arrays([*(pa.array(c[k].astype(np.int64)) for k in COUNTS), pa.array(failed), pa.array(scripts, pa.string()), *(pa.array(x, pa.float64()) for x in figures)], fields=list(MEASURES))
            for _, _, c, failed, scripts, figures in _figures(texts)
        ]
        return pa.concat_arrays(out) if out else pa.array([], MEASURES)

    return F.arrow_udf(run, MEASURES_DDL)(text_of(f"`{text_col}`"))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang and ``m``, its ``measures``."""
    lang = lang_of(docs) if lang is None else lang.cast("string")
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), lang.alias("lang"), measures(text_col).alias("m"))


def bands_of(found: DataFrame, labels: DataFrame) -> dict[str, Band]:
    """BANDS, and a band of their own for each language and script with ENOUGH documents that pass the base rules among all
    rows of ``found`` (doc_id, lang and m of ``measured``; best stored) whose label says good. Rows that are held out are not
    used, an id counts once. Quantiles are exact; the driver gets counts and bounds a language, no rows. No labels, no
    good rows or no rows: BANDS."""
    good = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y")).filter("doc_id is not null and y in (0, 1)").filter(~held_out())
    good = good.groupBy("doc_id").agg(F.min("y").alias("y")).filter("y = 1").select("doc_id")
    rows = found.filter("doc_id is not null and not m.base_failed").select("doc_id", "lang", "m.script", *(f"m.{c}" for c in FIGURES))
    once = rows.groupBy("doc_id").agg(F.min(F.struct("lang", "script", *FIGURES)).alias("f")).join(good, "doc_id", "left_semi").select("f.*")
    of = F.explode(F.array(*(F.struct(F.lit(c).alias("of"), F.col(c).alias("group")) for c in ("script", "lang"))))
    each = frozen(once.select(of.alias("g"), *FIGURES).select("g.*", *FIGURES).filter("group <> ''"))
    enough = each.groupBy("of", "group").count().filter(F.col("count") >= ENOUGH).select("of", "group")
    name = F.concat_ws(" ", "figure", "of", "group")
    figure = F.explode(F.array(*(F.struct(F.lit(c).alias("figure"), F.col(c).alias("x")) for c in FIGURES)))
    values = each.join(enough, ["of", "group"], "left_semi").select("of", "group", figure.alias("v")).select("of", "group", "v.*").select(name.alias("name"), "x")

    def around(share: float, n: int) -> tuple[int, int, float]:
        """Ranks beside the quantile and how far it lies between them."""
        at = share * (n - 1)
        return int(at), min(int(at) + 1, n - 1), at - int(at)

    ranked = at_ranks(values, lambda _, n: [rank for share in (OUTSIDE, 1 - OUTSIDE) for rank in around(share, n)[:2]])

    def quantile(figure: str, of: str, share: float) -> float:
        n, at = ranked[f"{figure} {of}"]
        lo, hi, way = around(share, n)
        return at[lo] + (at[hi] - at[lo]) * way

    out = dict(BANDS)
    for kind in ("script", "lang"):
        first = f"{FIGURES[0]} {kind} "
        for group in sorted(name.removeprefix(first) for name in ranked if name.startswith(first)):
            out[group] = band(*([quantile(figure, f"{kind} {group}", share) for figure in FIGURES] for share in (OUTSIDE, 1 - OUTSIDE)))
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict[str, Band]:
    """The bands that all labelled good rows of ``docs`` give. What judges the same rows as well keeps ``measured`` instead, which
    this reads the texts for."""
    return bands_of(frozen(measured(docs, id_col, text_col)), labels)


def verdict(bands: dict[str, Band] = BANDS) -> Column:
    """Whether a row of ``measured`` is kept: it passes the base rules and lies in the band of its language, else its script."""
    known = F.create_map(*(x for k, b in bands.items() for x in (F.lit(k), F.struct(*(F.lit(v).alias(f) for f, v in b._asdict().items())))))
    b = F.coalesce(F.try_element_at(known, F.col("lang")), F.try_element_at(known, F.col("m.script")))
    rate, share, bits, even = (F.col(f"m.{c}") for c in FIGURES)
    return ~F.col("m.base_failed") & rate.between(b["low"], b["high"]) & (share <= b["fallback"]) & ((bits >= b["entropy"]) | (even >= b["evenness"]))


def passing(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep with the bands of its own labelled rows, with all their columns; a null text
    fails. A table without languages is judged by script. Rows are stored with their figures, so texts are read once."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    found = frozen(docs.select(row, F.col(f"`{id_col}`").cast("long").alias("doc_id"), lang_of(docs).alias("lang"), measures(text_col).alias("m")))
    return found.filter(verdict(bands_of(found.select("doc_id", "lang", "m"), labels))).select("row.*")


def judged(found: DataFrame, bands: dict[str, Band] = BANDS) -> DataFrame:
    """The columns of ``quality_rules`` for rows of ``measured``."""
    return found.select("doc_id", *(f"m.{c}" for c in COUNTS), "m.base_failed", verdict(bands).alias("kept"), *(f"m.{c}" for c in FIGURES))


def quality_rules(docs: DataFrame, bands: dict[str, Band] = BANDS, id_col: str = "doc_id", text_col: str = "text", lang: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, chars_per_token, fallback_share, token_entropy, token_evenness.

    ``lang`` (default: the column of that name if there is one) chooses the band. A null or empty text has zero counts
    and fails the base rules. Rows are judged each on its own, repeats alike; other columns are ignored; an empty table
    gives an empty one. A text of any length is judged whole; its counts take some tens of bytes a word, its tokens are
    made about a MB at a time.
    """
    return judged(measured(docs, id_col, text_col, lang), bands)
