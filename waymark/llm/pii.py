"""Personal data: exact rules, and a character-level bidirectional LSTM with CRF transitions beside them.

The rules find e-mail and IP addresses, card and phone numbers as stated in ``base_spans``. The tagger is trained in
numpy from labelled spans: the rules' own on a bounded sample of documents, and written variants that the rules do not
cover (spelled, spaced or bracketed addresses, phone numbers without a plus or in words, cards with other separators), put
into text of the same sample. It reads every character of every text in overlapping windows. A position's scores come
from the window in whose middle it lies best, and one CRF decoding runs over the scores of the whole text, so a span
across windows is found once; the network reads by an ONNX graph, which bends values several times faster than numpy.
Decoding is exact but skips stretches in which a bound shows that no tag can gain.

A span of the tagger is added if its margin (its score less that of no span in its place) passes the threshold of its
kind, if its numbers pass the check of its kind, and if it overlaps no span of the rules; the rules' spans always stay.
Thresholds come from all texts: ``candidates`` keeps every span with its margin, ``least_margins`` ranks the margins of all
texts, and ``listed`` and ``replaced`` apply the thresholds to what was kept, so no text is read twice.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import graphs
from .cluster import frozen, held, text_of
from .ranks import at_ranks

KINDS = ("email", "ip", "card", "phone")
#: Window length and step between windows when tagging; windows of training are shorter.
WINDOW, STEP, TRAINED = 256, 208, 96
DIM, HIDDEN = 8, 12
#: Documents of the sample with a digit or an @, and as many of any kind; the characters of one that are used.
SAMPLE, SAMPLE_CHARS = 300, 20_000
#: Training windows, steps, windows in a step, rate.
WINDOWS, STEPS, BATCH, RATE = 5000, 600, 96, 0.03
#: Of all different texts this share may get a span that is none of the rules' and no planted one; least margin of any span.
STRAY, LEAST_MARGIN = 0.004, 2.0
#: Windows that are read at once, and characters of texts that a task holds spans of.
READ, HELD_CHARS = 768, 1 << 20

_EMAIL_LEFT = re.compile(r"[A-Za-z0-9._%+-]")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: A match that begins inside a run of digits would begin at the run's start as well, so no other start is tried. The digit
#: stands before the look behind it: a search skips to characters of a set only if the pattern begins with the set.
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")
_AT = re.compile(r"[@＠]|(?<![a-z0-9])at(?![a-z0-9])", re.I)
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_WORD_CHARS = _LOCAL_CHARS - frozenset("._%+-")
SPELLED = {"zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}
_NUMBER = re.compile(r"[0-9]|(?<![a-z])(?:" + "|".join(SPELLED) + r")(?![a-z])", re.I)

Span = tuple[str, int, int]


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def octet(number: str) -> bool:
    """At most 255, however many zeros stand before it."""
    number = number.lstrip("0") or "0"
    return len(number) <= 3 and int(number) <= 255


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the e-mail pattern, found from each @ instead of from each letter before it."""
    free, at = 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > free and _EMAIL_LEFT.match(text, lo - 1):
            lo -= 1
        m = _EMAIL.match(text, lo) if lo < at else None
        if m:
            yield m.span()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[Span]:
    """The rules' spans, leftmost and non-overlapping per kind; matches that fail the check of their kind are dropped."""
    out: list[Span] = []
    if "@" in text:
        out += [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(octet(p) for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        number = digits(m[0])
        if 14 <= len(number) <= 19 and luhn(number):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out, key=order)


def order(s: Span) -> tuple[int, int, int]:
    return s[1], KINDS.index(s[0]), s[2]


def plausible(kind: str, text: str) -> bool:
    """The check that a tagger's span of this kind must pass: of its numbers (digits may be spelled), or that it has an "at"."""
    number = "".join(SPELLED.get(x.lower(), x) for x in _NUMBER.findall(text))
    if kind == "card":
        return 14 <= len(number) <= 19 and luhn(number)
    if kind == "phone":
        return 10 <= len(number) <= 15
    if kind == "ip":
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(octet(p) for p in parts)
    return _AT.search(text) is not None


# Characters: ASCII each by itself, other letters, other characters, and what lies outside a text.
LETTER, OTHER, OUTSIDE, ALPHABET = 128, 129, 130, 131
TAGS = 1 + 2 * len(KINDS)
ALLOWED = np.ones((TAGS, TAGS), bool)
ALLOWED[1:, 1:] = False  # a span begins behind a place without a tag
for _k in range(len(KINDS)):  # an inner tag follows only the first or an inner tag of its kind
    ALLOWED[:, 2 + 2 * _k] = False
    ALLOWED[[1 + 2 * _k, 2 + 2 * _k], 2 + 2 * _k] = True
FIRST = np.array([t == 0 or t % 2 == 1 for t in range(TAGS)])
NEVER = -1e4


@cache
def _code_of() -> np.ndarray:
    """The code of every code point."""
    return np.array([i if i < 128 else LETTER if chr(i).isalpha() else OTHER for i in range(sys.maxunicode + 1)], np.uint8)


def codes(text: str) -> np.ndarray:
    return _code_of()[np.frombuffer(text.encode("utf-32-le"), "<u4")]


class Tagger(NamedTuple):
    embed: np.ndarray  # (ALPHABET, DIM)
    left: np.ndarray  # (DIM + HIDDEN + 1, 4 * HIDDEN), the last row is the bias; gates: input, forget, output, new
    right: np.ndarray
    out: np.ndarray  # (2 * HIDDEN + 1, TAGS)
    move: np.ndarray  # (TAGS, TAGS)
    least: np.ndarray  # (KINDS,): margins above which spans count; learned after the rest


def start_tagger(seed: int = 11) -> Tagger:
    r = np.random.default_rng(seed)
    f = lambda *s: (r.standard_normal(s) * 0.25).astype(np.float32)
    t = Tagger(f(ALPHABET, DIM), f(DIM + HIDDEN + 1, 4 * HIDDEN), f(DIM + HIDDEN + 1, 4 * HIDDEN), f(2 * HIDDEN + 1, TAGS), f(TAGS, TAGS) * 0.1, np.full(len(KINDS), LEAST_MARGIN, np.float32))
    for w in (t.left, t.right):
        w[-1] = 0
        w[-1, HIDDEN : 2 * HIDDEN] = 1
    t.out[-1] = 0
    t.out[-1, 0] = 2
    return t


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


def lstm(x: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, tuple]:
    """States (time, 2, rows, HIDDEN) for inputs (time, 2, rows, DIM) of two networks, and what the backward pass needs."""
    steps, two, rows, _ = x.shape
    h, c = np.zeros((two, rows, HIDDEN), x.dtype), np.zeros((two, rows, HIDDEN), x.dtype)
    given, turn = x @ w[:, :DIM] + w[:, -1:], np.ascontiguousarray(w[:, DIM:-1])
    hs, cs, gates = (np.empty((steps, two, rows, n), x.dtype) for n in (HIDDEN, HIDDEN, 4 * HIDDEN))
    for t in range(steps):
        z = np.matmul(h, turn, out=gates[t])
        z += given[t]
        z[..., : 3 * HIDDEN] = _sigmoid(z[..., : 3 * HIDDEN])
        np.tanh(z[..., 3 * HIDDEN :], out=z[..., 3 * HIDDEN :])
        c = np.multiply(z[..., HIDDEN : 2 * HIDDEN], c, out=cs[t])
        c += z[..., :HIDDEN] * z[..., 3 * HIDDEN :]
        h = np.tanh(c, out=hs[t])
        h *= z[..., 2 * HIDDEN : 3 * HIDDEN]
    return hs, (x, hs, cs, gates)


def lstm_back(grad: np.ndarray, cache: tuple, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of inputs and weights from those of the states."""
    x, hs, cs, gates = cache
    steps, two, rows, _ = x.shape
    i, f, o, g = np.split(gates, 4, axis=3)
    th = np.tanh(cs)
    prior_c, prior_h = (np.concatenate((np.zeros((1, two, rows, HIDDEN), x.dtype), v[:-1])) for v in (cs, hs))
    # Per step only two factors are new: the gradients of cell and state.
    by_c = np.concatenate((g * i * (1 - i), prior_c * f * (1 - f), i * (1 - g * g)), axis=3)
    by_h, through = th * o * (1 - o), o * (1 - th * th)
    gz, turn = np.empty_like(gates), np.ascontiguousarray(w[:, DIM:-1].transpose(0, 2, 1))
    gh, gc = np.zeros((two, rows, HIDDEN), x.dtype), np.zeros((two, rows, HIDDEN), x.dtype)
    for t in range(steps - 1, -1, -1):
        gh += grad[t]
        gc += gh * through[t]
        z = gz[t]
        z[..., :HIDDEN] = gc * by_c[t, ..., :HIDDEN]
        z[..., HIDDEN : 2 * HIDDEN] = gc * by_c[t, ..., HIDDEN : 2 * HIDDEN]
        z[..., 2 * HIDDEN : 3 * HIDDEN] = gh * by_h[t]
        z[..., 3 * HIDDEN :] = gc * by_c[t, ..., 2 * HIDDEN :]
        gc *= f[t]
        gh = z @ turn
    flat = gz.transpose(1, 0, 2, 3).reshape(two, steps * rows, -1)
    sides = [v.transpose(1, 3, 0, 2).reshape(two, -1, steps * rows) for v in (x, prior_h)]
    gw = np.concatenate((*(v @ flat for v in sides), flat.sum(axis=1, keepdims=True)), axis=1)
    return gz @ w[:, :DIM].transpose(0, 2, 1), gw


def emissions(t: Tagger, window: np.ndarray) -> tuple[np.ndarray, tuple]:
    """(time, rows, TAGS) for windows (rows, time)."""
    x = t.embed[window.T]
    hs, cache = lstm(np.stack((x, x[::-1]), axis=1), np.stack((t.left, t.right)))
    both = np.concatenate((hs[:, 0], hs[::-1, 1]), axis=2)
    return both @ t.out[:-1] + t.out[-1], (both, cache)


def crf(e: np.ndarray, move: np.ndarray, gold: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log likelihood of the tags ``gold`` (time, rows), with gradients of emissions and moves.

    Sums over paths are kept as probabilities, scaled to 1 at every step."""
    steps, rows, _ = e.shape
    top = e.max(axis=2, keepdims=True)
    x, m = np.exp((e - top).astype(np.float64)), np.where(ALLOWED, np.exp(move.astype(np.float64)), 0)
    fore, back, size = x.copy(), np.ones_like(x), np.empty((steps, rows, 1))
    fore[0] *= FIRST
    for t in range(steps):
        if t:
            fore[t] *= fore[t - 1] @ m
        size[t] = fore[t].sum(axis=1, keepdims=True)
        fore[t] /= size[t]
    x /= size
    turn = m.T.copy()
    for t in range(steps - 1, 0, -1):
        np.matmul(x[t] * back[t], turn, out=back[t - 1])
    ge = fore * back
    gm = m * (fore[:-1].reshape(-1, TAGS).T @ (x[1:] * back[1:]).reshape(-1, TAGS))
    at, col = np.arange(steps)[:, None], np.arange(rows)
    score = e[at, col, gold].sum() + move[gold[:-1], gold[1:]].sum()
    ge[at, col, gold] -= 1
    np.add.at(gm, (gold[:-1], gold[1:]), -1)
    return float((np.log(size).sum() + top.sum() - score) / rows), ge / rows, gm / rows


def gradients(t: Tagger, window: np.ndarray, gold: np.ndarray) -> tuple[float, list[np.ndarray]]:
    e, (both, cache) = emissions(t, window)
    loss, ge, gm = crf(e, t.move, gold.T)
    ge = ge.astype(e.dtype)
    flat = ge.reshape(-1, TAGS)
    g_both = ge @ t.out[:-1].T
    g_in, (gl, gr) = lstm_back(np.stack((g_both[:, :, :HIDDEN], g_both[::-1, :, HIDDEN:]), axis=1), cache, np.stack((t.left, t.right)))
    gx = (g_in[:, 0] + g_in[::-1, 1]).reshape(-1, DIM)
    code = window.T.ravel()
    g_embed = np.stack([np.bincount(code, weights=gx[:, d], minlength=ALPHABET) for d in range(DIM)], axis=1)
    g_out = np.concatenate((both.reshape(-1, 2 * HIDDEN).T @ flat, flat.sum(axis=0, keepdims=True)))
    return loss, [g_embed, gl, gr, g_out, gm]


def _variants(r: np.random.Generator) -> tuple[str, str]:
    """A written span that the rules may not cover, and its kind; kind "" is a look-alike that is nothing."""
    d = lambda n: "".join(map(str, r.integers(10, size=n)))
    of = lambda *x: x[int(r.integers(len(x)))]
    word = lambda: "".join(r.choice(list("abcdefghijklmnoprstuvw"), int(r.integers(2, 11))))
    say = lambda number, sep: sep.join(list(SPELLED)[int(c)] for c in number)
    octets = [str(x) for x in r.integers(256, size=4)]
    kind = int(r.integers(15))
    if kind < 5:
        # "at" and "dot" as words, in brackets or between marks, with or without blanks; or as signs with blanks around.
        left, right = of("[]", "()", "{}", "<>", "--", "__", "**", "  ", "  ", "  ", "  ", "  ")
        blank = " " if r.random() < 0.5 or left == " " else ""
        around = lambda w: f"{blank}{left}{w}{right}{blank}".replace("   ", " ").replace("  ", " ")
        if r.random() < 0.15:
            at, dot = of((" @ ", " . "), ("@", "."), (" @ ", "."), ("＠", "."), (" ＠ ", " . "))
        else:
            at, dot = around("at"), around("dot") if r.random() < 0.65 else "."
        inner = dot if "dot" in dot and r.random() < 0.3 else None
        many = lambda seps: "".join((inner or of(*seps) if i else "") + word() for i in range(int(r.integers(2, 9)) if r.random() < 0.5 else 1))
        name = many("._-") + (of("", ".") + d(2) if r.random() < 0.4 else "")
        ending = of("com", "org", "net", "de", "info", "com", "org", "io", "fr", "es", f"co{dot}uk", f"ac{dot}at")
        text = f"{name}{at}{many('-')}{dot}{word() + dot if r.random() < 0.2 else ''}{ending}"
        case = r.random()
        return (text.title() if case < 0.08 else text.upper() if case < 0.2 else text), "email"
    if kind < 8:
        number = d(10) if r.random() < 0.7 else d(11)
        pairs = lambda n: (d(2) for _ in range(n))
        return of(
            f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}", f"{d(3)} {d(3)} {d(4)}", f"+{d(2)} {d(3)} {d(7)}", f"+1 ({d(3)}) {d(3)}-{d(4)}",
            f"0{d(3)} / {d(7)}", f"00{d(2)} {d(3)} {d(6)}", f"({d(3)}) {d(3)} {d(4)}", say(number, " "), say(number, "-"), f"plus {say(number, ' ')}", say(number, " "),
            f"0{d(1)} {' '.join(pairs(4))}", f"0{d(1)}{of('.', '-')}{of('.', '-').join(pairs(4))}", f"0{d(2)}{of('/', ' / ', '-', ' ')}{d(int(r.integers(7, 9)))}", f"00{d(2)} {d(2)} {d(6)}", f"0 {d(3)} {d(3)} {' '.join(pairs(2))}", f"(0{d(3)}) {d(3)} {' '.join(pairs(2))}",
        ), "phone"
    if kind < 10:
        n = d(15)
        n += next(c for c in "0123456789" if luhn(n + c))
        mark = of("", " ", "-", ".", "/", "_", ",")
        return of(mark, mark, f" {mark} ", "  ").join(n[i : i + 4] for i in range(0, 16, 4)), "card"
    if kind < 11:
        left, right = of("[]", "()", "{}")
        return of(".", " . ", f"{left}.{right}", f"{left}dot{right}", " dot ", f" {left}dot{right} ").join(octets), "ip"
    token = "".join(r.choice(list("0123456789abcdef"), 40))
    verb, the = of("looked", "stared", "arrived", "meet", "aimed", "shouted", "stay", "laughed", "is", "worked"), of("the", "this", "a", "every", "one", "our", "last", "any")
    return of(
        " ".join(f"{d(2)}-{d(2)}" for _ in range(int(r.integers(2, 5)))), " ".join(f"{d(1)}-{d(1)}" for _ in range(int(r.integers(3, 7)))), f"{verb} at {the} dot {of('com', 'org', 'net', word())}", f"{verb} at {the} {word()}", f"{verb} at {the} {word()}.", f"{d(4)}-{d(4)}", f"{d(4)}/{d(4)}",
        f"at {the} {word()} {word()}", f"{say(d(int(r.integers(1, 6))), ' ')}",
        f'token = "{token}"', token, d(4), d(6), d(9), d(12), d(20), f"{d(4)}-{d(2)}-{d(2)}", f"{d(2)}.{d(1)}", f"{d(1)},{d(3)},{d(3)}", f"{d(2)}:{d(2)}", f"page {d(3)}", f"{d(1)}.{d(1)}.{d(2)}",
        f"978-{d(1)}-{d(3)}-{d(5)}-{d(1)}", " ".join(d(2) for _ in range(8)), f"{d(1)}.{d(2)} {d(1)}.{d(2)} {d(1)}.{d(2)}", f"{d(4)}-{d(2)}-{d(2)} {d(2)}:{d(2)}:{d(2)}", f"meet at {word()}", f"{word()} at {word()}",
        f"{word()} at the {word()} dot", f"a dot {word()}", f"{word()} (at {word()})", f"one {word()} two {word()}", f"{say(d(3), ' ')}", f"{word()}@{word()}", f"{word()}.{word()}", f"[{word()}]", f"({word()}) {word()}",
        f"${d(2)}.{d(2)}", f"{d(2)}%", f"#{d(5)}", f"v{d(1)}.{d(1)}.{d(1)}", f"{d(1)} / {d(2)}", f"({d(4)})", f"{word()}-{word()}_{word()}", " ".join([word()] * int(r.integers(4, 30))), " ".join([word().title()] * int(r.integers(4, 30))),
        ". ".join([word().title()] * int(r.integers(3, 20))), f"{d(1)} ".join(word() for _ in range(8)),
    ), ""


def _tags(n: int, spans: list[Span]) -> np.ndarray:
    out = np.zeros(n, np.int8)
    for kind, a, b in spans:
        k = 1 + 2 * KINDS.index(kind)
        if not out[max(0, a - 1) : b + 1].any():
            out[a] = k
            out[a + 1 : b] = k + 1
    return out


def planted(r: np.random.Generator, text: str) -> tuple[str, list[Span], int]:
    """A stretch of ``text``, a short one now and then, with a written span put in between two words, its spans, and the middle of the new one."""
    reach = 2 * TRAINED if r.random() < 0.85 else int(r.integers(60))
    at = int(r.integers(len(text) + 1))
    while 0 < at < len(text) and not text[at].isspace():
        at -= 1
    before, after = text[max(0, at - reach) : at], text[at : at + reach]
    piece, kind = _variants(r)
    body = f"{before}{' ' if r.random() < 0.9 else chr(10)}{piece}"
    a, b = len(body) - len(piece), len(body)
    end = ("", "", ".", ",", "###", "&&&")[int(r.integers(6))]
    spans = [*base_spans(before), *((k, s + b + len(end), e + b + len(end)) for k, s, e in base_spans(after))]
    return body + end + after, sorted([*spans, (kind, a, b)] if kind else spans, key=order), (a + b) // 2


def labelled_windows(texts: list[str], windows: int = WINDOWS, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Windows and tags: stretches of the texts as they are, with the rules' spans, and stretches with a planted one."""
    r = np.random.default_rng(seed)
    xs, ys = [], []

    def add(text: str, spans: list[Span], middle: int) -> None:
        lo = middle - int(r.integers(TRAINED // 4, 3 * TRAINED // 4))
        x = np.full(TRAINED, OUTSIDE, np.uint8)
        a, b = max(lo, 0), min(lo + TRAINED, len(text))
        x[a - lo : b - lo] = codes(text[a:b])
        inside = [(k, max(s, a) - lo, min(e, b) - lo) for k, s, e in spans if s < b and e > a]
        xs.append(x)
        ys.append(_tags(TRAINED, inside))

    texts = [t for t in texts if t] or ["The quick brown fox jumps over the lazy dog and then it sleeps again. " * 4]
    for t in texts:
        spans = base_spans(t)
        places = [m.start() for m in _TRIGGER.finditer(t)]
        for at in [*places[:: max(1, len(places) // 2)][:2], int(r.integers(len(t) + 1))]:
            if len(xs) < windows // 3:
                add(t, spans, at)
    while len(xs) < windows:
        add(*planted(r, texts[int(r.integers(len(texts)))]))
    return np.stack(xs[:windows]), np.stack(ys[:windows])


def train(texts: list[str], windows: int = WINDOWS, steps: int = STEPS, seed: int = 11, ranked: bool = True) -> Tagger:
    """A tagger trained on windows of ``texts``, with the thresholds that they give if ``ranked``, else the least ones."""
    x, y = labelled_windows(texts, windows, seed)
    r, t = np.random.default_rng(seed), start_tagger(seed)
    m1, m2 = [np.zeros_like(p) for p in t[:-1]], [np.zeros_like(p) for p in t[:-1]]
    for step in range(1, steps + 1):
        rows = r.integers(len(x), size=BATCH)
        _, grads = gradients(t, x[rows], y[rows])
        norm = np.sqrt(sum(float((g**2).sum()) for g in grads))
        rate, new = RATE * min(1.0, 2 * (1 - step / (steps + 1))), []
        for p, g, a, b in zip(t[:-1], grads, m1, m2, strict=True):
            g = (g * min(1.0, 5 / max(norm, 1e-9))).astype(np.float32)
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            new.append(p - np.float32(rate) * (a / np.float32(1 - 0.9**step)) / (np.sqrt(b / np.float32(1 - 0.99**step)) + np.float32(1e-6)))
        t = Tagger(*new, t.least)
    return t._replace(least=thresholds(t, texts)) if ranked else t


def threshold(highest: float) -> float:
    """The margin above which spans count where this is the highest that may not."""
    return max(highest + 0.5, LEAST_MARGIN)


def thresholds(t: Tagger, texts: list[str]) -> np.ndarray:
    """For each kind the margin above which at most the share STRAY of ``texts`` has a span that is none of the rules'."""
    highest = np.zeros((len(KINDS), max(1, len(texts))))
    for n, (base, found) in enumerate(zip(map(base_spans, texts), tagged_spans(t, texts), strict=True)):
        for kind, _, _, margin in beside(base, found):
            k = KINDS.index(kind)
            highest[k, n] = max(highest[k, n], margin)
    rank = int(STRAY * len(texts))
    return np.array([threshold(x) for x in np.sort(highest, axis=1)[:, ::-1][:, min(rank, highest.shape[1] - 1)]], np.float32)


def trained(docs: DataFrame, sample: int = SAMPLE, text_col: str = "text") -> Tagger:
    """A tagger whose weights are trained on stretches of at most ``sample`` documents with a digit or an @ and as many of any kind, chosen by a hash of
    their text; a document gives one stretch of at most SAMPLE_CHARS characters, around its first digit or @ if it has
    one. Two copies of a text count once; null and empty texts are not used; no text at all gives a tagger of the written
    variants alone. Its thresholds are the least ones. At most 2 * sample * SAMPLE_CHARS characters come to the driver."""
    text = text_of(text_col)
    place = F.greatest(F.lit(1), F.length(F.regexp_extract("text", r"^[^0-9@]*", 0)) - SAMPLE_CHARS // 2)
    place = F.when(F.col("text").rlike("[0-9@]"), place).otherwise(1)
    rows = docs.select(text.alias("text"), F.xxhash64(text).alias("h")).filter("text <> ''")
    some = rows.filter(F.col("text").rlike("[0-9@]")).select("h").distinct().orderBy("h").limit(sample)
    chosen = frozen(some.union(rows.select("h").distinct().orderBy(F.xxhash64("h")).limit(sample)).distinct())
    texts = rows.join(F.broadcast(chosen), "h").select("h", F.substring("text", place, F.lit(SAMPLE_CHARS)).alias("text")).groupBy("h").agg(F.min("text").alias("text"))
    return train([r.text for r in texts.orderBy("h").collect()], ranked=False)


def fit(docs: DataFrame, sample: int = SAMPLE, text_col: str = "text") -> Tagger:
    """A trained tagger with the thresholds that all texts of ``docs`` give. What uses their spans as well keeps ``candidates``
    instead, which this reads the texts for."""
    t = trained(docs, sample, text_col)
    return t._replace(least=least_margins(frozen(candidates(docs, t, text_col).select("text_hash", "spans"))))


def _graph(t: Tagger) -> bytes:
    """Scores (time, 2, rows, TAGS) of both networks as one ONNX graph, each in its own order of time, for codes (time, both
    networks' rows); a code of the second is ALPHABET higher. What an input does to the gates is one row of a table."""
    table = np.concatenate([t.embed @ w[:DIM] + w[-1] for w in (t.left, t.right)])
    constants = {
        "table": table,
        "turn": np.stack((t.left[DIM:-1], t.right[DIM:-1])),
        "out": np.stack((t.out[:HIDDEN], t.out[HIDDEN:-1])),
        "shape": np.array([2, -1, 4 * HIDDEN]),
        "gate": np.array([HIDDEN] * 4),
    }
    state = lambda name: graphs.value(name, graphs.FLOAT, 2, "rows", HIDDEN)
    step = [
        graphs.node("Gather", "table code", "flat"),
        graphs.node("Reshape", "flat shape", "given"),
        graphs.node("MatMul", "h turn", "turned"),
        graphs.node("Add", "turned given", "z"),
        graphs.node("Split", "z gate", "zi zf zo zn", axis=2),
        *(graphs.node("Sigmoid", f"z{gate}", gate) for gate in "ifo"),
        graphs.node("Tanh", "zn", "new"),
        graphs.node("Mul", "i new", "gained"),
        graphs.node("Mul", "f c", "stayed"),
        graphs.node("Add", "gained stayed", "cell"),
        graphs.node("Tanh", "cell", "bent"),
        graphs.node("Mul", "o bent", "state"),
        graphs.node("MatMul", "state out", "score"),
    ]
    body = graphs.graph(step, [state("h"), state("c"), graphs.value("code", graphs.INT32, "both")], [state("state"), state("cell"), graphs.value("score", graphs.FLOAT, 2, "rows", TAGS)])
    return graphs.graph(
        [graphs.node("Scan", "h0 c0 codes", "h1 c1 scores", body=body, num_scan_inputs=1)],
        [state("h0"), state("c0"), graphs.value("codes", graphs.INT32, "time", "both")],
        [graphs.value("scores", graphs.FLOAT, "time", 2, "rows", TAGS)],
        tuple(graphs.constant(k, v) for k, v in constants.items()),
    )


def _session(t: Tagger):
    """The session of a tagger, which a worker keeps until another tagger comes."""
    kept = held("tagger", dict)
    if kept.get("of") is not t:
        kept["of"], kept["session"] = t, graphs.session(_graph(t))
    return kept["session"]


def _window_scores(t: Tagger, window: np.ndarray) -> np.ndarray:
    """(time, rows, TAGS) for windows (rows, time); as ``emissions`` without what training needs."""
    code = window.T
    both = np.empty((len(code), 2, code.shape[1]), np.int32)
    both[:, 0] = code
    both[:, 1] = code[::-1]
    both[:, 1] += ALPHABET
    start = np.zeros((2, code.shape[1], HIDDEN), np.float32)
    (scores,) = _session(t).run(None, {"h0": start, "c0": start, "codes": both.reshape(len(code), -1)})
    out = scores[:, 0]
    out += scores[::-1, 1]
    out += t.out[-1]
    return out


def _scores(t: Tagger, texts: list[str]) -> Iterator[np.ndarray]:
    """The scores (TAGS, positions) of the texts one after another, each with one more position behind it that is outside
    of every span, in pieces of at most READ windows. No more than a piece is held."""
    windows, takes = [], []

    def flush() -> np.ndarray:
        scores, taken = _window_scores(t, np.stack(windows)), np.concatenate(takes)
        last = np.flatnonzero(taken[:, 2])
        scores[taken[last, 1] - 1, last] = np.where(np.arange(TAGS) == 0, 0, NEVER)
        windows.clear()
        takes.clear()
        ends = np.cumsum(taken[:, 1] - taken[:, 0])
        out = np.empty((TAGS, int(ends[-1])), np.float32)
        for i, ((lo, hi, _), end) in enumerate(zip(taken.tolist(), ends.tolist(), strict=True)):
            out[:, end - hi + lo : end] = scores[lo:hi, i].T
        return out

    edge = (WINDOW - STEP) // 2
    for text in texts:
        n = max(1, -(-(len(text) + 1 - 2 * edge) // STEP))
        at = 0
        while at < n:
            some = min(n - at, READ - len(windows))
            piece = codes(text[at * STEP : (at + some - 1) * STEP + WINDOW])
            padded = np.full((some - 1) * STEP + WINDOW, OUTSIDE, np.uint8)
            padded[: len(piece)] = piece
            windows.extend(sliding_window_view(padded, WINDOW)[::STEP])
            number = np.arange(at, at + some)
            end = np.where(number == n - 1, len(text) + 1 - number * STEP, STEP + edge)
            takes.append(np.stack((np.where(number > 0, edge, 0), end, number == n - 1), axis=1))
            at += some
            if len(windows) == READ:
                yield flush()
    if windows:
        yield flush()


def _decode(move: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best tags of stretches (rows, time, TAGS), with no span before and behind each, and their back pointers' scores."""
    rows, steps, _ = scores.shape
    m = np.where(ALLOWED, move, NEVER).astype(np.float32)
    best, came = m[0] + scores[:, 0], np.zeros((steps, rows, TAGS), np.int8)
    for t in range(1, steps):
        way = best[:, :, None] + m
        came[t] = way.argmax(axis=1)
        best = way.max(axis=1) + scores[:, t]
    out = np.empty((rows, steps), np.int8)
    out[:, -1] = (best + m[:, 0]).argmax(axis=1)
    for t in range(steps - 1, 0, -1):
        out[:, t - 1] = came[t][np.arange(rows), out[:, t]]
    return out, m


def _tagged(t: Tagger, blocks: Iterator[np.ndarray]) -> Iterator[tuple[str, int, int, float]]:
    """(kind, start, end, margin) of every span on the best path over all positions of ``blocks``, in order of start.

    What a span can have over no tag is at most what its first tag has (``begin``, with the moves into and out of the
    span) and what its inner tags have (``inner``). Places in no span whose sum is positive are without a tag on the best
    path, and each stretch between them is decoded by itself. What lies behind the last place that no span across
    it can pay for, even one that begins for nothing, waits for the next block.
    """
    m = np.where(ALLOWED, t.move, NEVER).astype(np.float32)
    first, more = np.arange(1, TAGS, 2), np.arange(2, TAGS, 2)
    out_of = np.maximum(m[first, 0], m[more, 0]) - m[0, 0]
    into, on = m[0, first] + out_of - m[0, 0], np.maximum(m[first, more], m[more, more]) - m[0, 0]
    room: dict[str, np.ndarray] = {}

    def scratch(name: str, n: int, kind: type = np.float64) -> np.ndarray:
        """An array that serves block after block: the workers' allocator gives pieces of this size back at once, and they
        would be paged in again for every step."""
        if len(room.get(name, ())) < n:
            room[name] = np.empty(n, kind)
        return room[name][:n]

    def best(name: str, rows: np.ndarray, moves: np.ndarray, none: np.ndarray) -> np.ndarray:
        """The largest of ``rows`` with their moves, over no tag."""
        out, other = (scratch(x, len(none), np.float32) for x in (name, "other"))
        np.add(rows[0], moves[0], out=out)
        for row, move in zip(rows[1:], moves[1:], strict=True):
            np.maximum(out, np.add(row, move, out=other), out=out)
        return np.subtract(out, none, out=out)

    done, left = 0, np.zeros((TAGS, 0), np.float32)
    blocks = iter(blocks)
    while True:
        block = next(blocks, None)
        scores = left if block is None else np.concatenate((left, block), axis=1) if left.shape[1] else block
        if n := scores.shape[1]:
            begin, inner = best("begin", scores[1::2], into, scores[0]), best("inner", scores[2::2], on, scores[0])
            end, total = n, scratch("total", n + 1)
            if block is not None:
                total[0] = 0
                np.cumsum(np.maximum(begin, inner, out=scratch("other", n, np.float32)), dtype=np.float64, out=total[1:])
                end -= int(total[::-1].argmin())  # the last of the least
            if end:
                total, begun, still, live = np.cumsum(inner[:end], dtype=np.float64, out=total[:end]), scratch("begun", end), scratch("still", end), scratch("live", end + 2, np.bool_)
                np.maximum.accumulate(np.subtract(begin[:end], total, out=still), out=begun)
                begun += np.maximum.accumulate(total[::-1], out=still)[::-1]
                live[0] = live[-1] = False
                np.greater(begun, 0, out=live[1:-1])
                edges = np.flatnonzero(np.not_equal(live[1:], live[:-1], out=scratch("edge", end + 1, np.bool_)))
                yield from _spans(t, m, scores, edges[::2], edges[1::2], done)
            done, left = done + end, scores[:, end:]
        if block is None:
            return


def _spans(t: Tagger, m: np.ndarray, scores: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> Iterator[tuple[str, int, int, float]]:
    found = []
    order_ = np.argsort(end - start, kind="stable")
    at = 0
    while at < len(order_):
        upto = at + 1  # stretches of like lengths go together
        while upto < len(order_) and upto - at < 512 and (end - start)[order_[upto]] <= 2 * (end - start)[order_[at]] + 8:
            upto += 1
        rows = order_[at:upto]
        size = (end - start)[rows]
        part = np.full((len(rows), int(size.max()), TAGS), NEVER, np.float32)
        part[:, :, 0] = 0
        inside = np.arange(part.shape[1]) < size[:, None]
        part[inside] = np.concatenate([scores[:, start[i] : end[i]].T for i in rows])
        tags = _decode(t.move, part)[0]
        row, first = np.nonzero(tags % 2 == 1)
        for j, k in zip(row.tolist(), first.tolist(), strict=True):
            i, n, tag = rows[j], int(size[j]), tags[j]
            others = np.flatnonzero(tag[k + 1 : n] != tag[k] + 1)
            stop = k + 1 + int(others[0]) if len(others) else n
            own, y = scores[:, start[i] + k : start[i] + stop].T, np.concatenate((tag[k - 1 : k] if k else [0], tag[k:stop], tag[stop : stop + 1] if stop < n else [0])).astype(int)
            with_tag = own[np.arange(stop - k), y[1:-1]].sum() + m[y[:-1], y[1:]].sum()
            without = own[:, 0].sum() + m[y[0], 0] + m[0, y[-1]] + (stop - k - 1) * m[0, 0]
            found.append((KINDS[tag[k] // 2], base + int(start[i]) + k, base + int(start[i]) + stop, float(with_tag - without)))
        at = upto
    yield from sorted(found, key=lambda s: s[1])


def whole_words(kind: str, text: str, a: int, b: int) -> tuple[int, int]:
    """A span without blanks and marks at its ends, and with the rest of the words (of an e-mail address: of the local
    part) in which it begins and ends."""
    while a < b and not (text[a].isalnum() or kind == "phone" and text[a] in "+("):
        a += 1
    while a < b and not text[b - 1].isalnum():
        b -= 1
    if a < b:
        chars = _LOCAL_CHARS if kind == "email" else _WORD_CHARS
        while a and text[a] in chars and text[a - 1] in chars:
            a -= 1
        while b < len(text) and text[b - 1] in _WORD_CHARS and text[b] in _WORD_CHARS:
            b += 1
    return a, b


Found = tuple[str, int, int, float]


def likely_spans(t: Tagger, texts: list[str]) -> list[list[Found]]:
    """(kind, start, end, margin) of the tagger's spans of each text, in order, that pass the check of their kind and the least
    threshold of all kinds."""
    out: list[list[Found]] = [[] for _ in texts]
    first, least = np.concatenate(([0], np.cumsum([len(x) + 1 for x in texts]))), t.least.min()
    for kind, a, b, margin in _tagged(t, _scores(t, texts)):
        if margin > least:
            n = int(np.searchsorted(first, a, "right")) - 1
            a, b = whole_words(kind, texts[n], a - int(first[n]), b - int(first[n]))
            if a < b and plausible(kind, texts[n][a:b]):
                out[n].append((kind, a, b, margin))
    return out


def counted(found: list[Found], least: np.ndarray) -> list[Found]:
    """Spans above the thresholds; of overlapping ones the first."""
    out: list[Found] = []
    for s in found:
        if s[3] > least[KINDS.index(s[0])] and (not out or out[-1][2] <= s[1]):
            out.append(s)
    return out


def beside(base: list[Span], found: list[Found]) -> list[Found]:
    """Spans that overlap none of the rules'."""
    return [s for s in found if all(s[2] <= a or s[1] >= b for _, a, b in base)]


def tagged_spans(t: Tagger, texts: list[str]) -> list[list[Found]]:
    """(kind, start, end, margin) of the tagger's spans of each text that pass their threshold and the check of their kind."""
    return [counted(found, t.least) for found in likely_spans(t, texts)]


def joint_spans(base: list[Span], found: list[Found], least: np.ndarray) -> list[Span]:
    """The rules' spans and those of the tagger that count beside them."""
    return sorted([*base, *(s[:3] for s in beside(base, counted(found, least)))], key=order)


def all_spans(tagger: Tagger, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """(spans of the rules, all spans) of each text."""
    return [(base, joint_spans(base, found, tagger.least)) for base, found in zip(map(base_spans, texts), likely_spans(tagger, texts), strict=True)]


def groups(texts: list[str | None], most: int = HELD_CHARS) -> Iterator[list[str]]:
    """Runs of texts of about ``most`` characters; a longer one is a run of its own. Nulls are empty."""
    run, size = [], 0
    for text in texts:
        text = text or ""
        if run and size + len(text) > most:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


#: Spans of a text: the rules' without a margin, then the tagger's in their order.
SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("margin", pa.float64())]))
SPANS_DDL = "array<struct<kind: string, start: int, end: int, margin: double>>"


def _dicts(spans: list[tuple]) -> list[dict]:
    return [{"kind": k, "start": a, "end": b, "margin": margin[0] if margin else None} for k, a, b, *margin in spans]


def candidates(docs: DataFrame, tagger: Tagger, text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``row`` (its columns), ``text_hash`` (null where there is no text) and ``spans``, the rules' and
    all of the tagger's above its thresholds, whatever counts in the end.

    A null or empty text has none. A text of any length is read whole, READ windows at a time; beside the text only its
    spans and a stretch that is still open are held.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    def run(texts: pa.Array) -> pa.Array:
        out = []
        for part in groups(texts.to_pylist()):
            for base, found in zip(map(base_spans, part), likely_spans(shared.value, part), strict=True):
                out.append(_dicts([*base, *found]))
        return pa.array(out, SPANS)

    text = text_of(f"`{text_col}`")
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.when(text != "", F.xxhash64(text)).alias("text_hash"), F.arrow_udf(run, SPANS_DDL)(text).alias("spans"))


def parted(spans: list[dict]) -> tuple[list[Span], list[Found]]:
    """A text's ``spans`` as the rules' and the tagger's."""
    base = [(s["kind"], s["start"], s["end"]) for s in spans if s["margin"] is None]
    return base, [(s["kind"], s["start"], s["end"], s["margin"]) for s in spans if s["margin"] is not None]


def least_margins(found: DataFrame) -> np.ndarray:
    """For each kind the margin above which at most the share STRAY of all different texts has a span that is none of the rules'.
    ``found``: text_hash and spans of ``candidates``, stored."""

    def strays(spans: pa.Array) -> pa.Array:
        none = np.full(len(KINDS), -np.inf)
        return pa.array([_dicts(beside(base, counted(more, none))) for base, more in map(parted, spans.to_pylist())], SPANS)

    some = found.filter("text_hash is not null and exists(spans, s -> s.margin is not null)")
    each = some.select("text_hash", F.explode(F.arrow_udf(strays, SPANS_DDL)("spans")).alias("s"))
    highest = frozen(each.groupBy("text_hash", F.col("s.kind").alias("name")).agg(F.max("s.margin").alias("x")).select("name", "x"))
    rank = int(STRAY * found.agg(F.count_distinct("text_hash")).first()[0])
    ranked = at_ranks(highest, lambda _, n: [n - 1 - rank])
    return np.array([threshold(next(iter(ranked[k][1].values()), 0.0) if k in ranked else 0.0) for k in KINDS], np.float32)


def listed(found: DataFrame, least: np.ndarray) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of each row of ``found`` (doc_id and the spans of ``candidates``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [parted(s) for s in batch.column(1).to_pylist()]
            counts = [pa.array([sum(k == kind for k, _, _ in base) for base, _ in parts], pa.int64()) for kind in KINDS]
            digest = [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in parts]
            spans = [written(joint_spans(base, more, least)) for base, more in parts]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array(digest, pa.string()), pa.array(spans, pa.string())], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return found.select("doc_id", "spans").mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def spans_of(docs: DataFrame, tagger: Tagger, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash and the spans of ``candidates``, without the texts."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return candidates(rows, tagger).select("row.doc_id", "text_hash", "spans")


def detected(docs: DataFrame, tagger: Tagger, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Counts and digest are of the rules' spans, ``spans`` lists all; places are code points. A null or empty text has
    none. Equal rows have equal results; other columns are ignored; an empty table gives an empty one.
    """
    return listed(spans_of(docs, tagger, id_col, text_col), tagger.least)


def redacted_text(text: str, spans: list[Span]) -> str:
    """``text`` with every span replaced by its kind in brackets; of overlapping spans the whole stretch, by the first's kind."""
    out, at = [], 0
    for kind, a, b in spans:
        if a < at:
            if b > at:
                at = b
            continue
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join(out) + text[at:]


def replaced(found: DataFrame, least: np.ndarray, text_col: str = "text") -> DataFrame:
    """The rows of ``found`` (``row`` and ``spans`` of ``candidates``) with all spans that count replaced in ``text_col``."""

    def run(texts: pa.Array, spans: pa.Array) -> pa.Array:
        parts = map(parted, spans.to_pylist())
        return pa.array([None if t is None else redacted_text(t, joint_spans(base, more, least)) for t, (base, more) in zip(texts.to_pylist(), parts, strict=True)], pa.string())

    field = F.col("row").getField
    text = F.arrow_udf(run, "string")(field(text_col), F.col("spans"))
    return found.select(*[(text if c == text_col else field(c)).alias(c) for c in found.schema["row"].dataType.names])


def redacted(docs: DataFrame, tagger: Tagger, text_col: str = "text") -> DataFrame:
    """``docs`` with all spans in ``text_col`` replaced; null texts stay null, empty ones empty, other columns as they are,
    whatever their names. Equal texts have equal results; an empty table gives an empty one."""
    return replaced(candidates(docs, tagger, text_col), tagger.least, text_col)
