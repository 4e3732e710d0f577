"""The tagger on variants written by hand, which its generator of training spans does not make, in prose of the tables."""

import random

import pyarrow.parquet as pq
import pytest

from waymark.llm import pii

WRITTEN = {
    "email": [
        "JSMITH AT MAIL DOT COM", "anna -at- posteo -dot- de", "kim<at>example<dot>org", "peter＠beispiel.de", "john at acme.co.uk", "maria.lopez (at) correo (dot) es", "sales [ at ] widgets [ dot ] com", "Tom.Reed at uni-graz.ac.at",
        "info AT shop.example.com", "write.me at gmail dot com", "bob _at_ home _dot_ net", "lena{at}firma{dot}de", "office at nowhere dot co dot uk", "j.doe[at]lab.example.edu", "Carlos dot Ruiz at empresa dot es",
    ],
    "phone": [
        "01 23 45 67 89", "(0171) 555 20 28", "555-867-5309", "0049 30 901820", "+49.30.901820", "five five five one two one two three four five", "020 7946 0958", "(212) 555-0147", "212.555.0188", "+33 (0)1 42 68 53 00", "0 800 123 45 67",
    ],
    "card": ["4111 - 1111 - 1111 - 1111", "5500.0000.0000.0004", "4012_8888_8888_1881", "4111/1111/1111/1111", "4242  4242  4242  4242"],
    "ip": ["192 dot 168 dot 0 dot 1", "10[.]0[.]0[.]254", "172 . 16 . 254 . 1", "8[dot]8[dot]8[dot]8"],
}
NOTHING = [
    "look at that dot com bubble", "21-19 21-18 22-20", "meet me at noon on the dot", "he looked at it", "chapter 3.2.1.4", "12/24/2019 10:30", "ISBN 978-3-16-148410-0", "1,234,567.89", "one two three four", "at the end of the day",
    "version 10.4.2", "pages 120-134", "a ratio of 16:9", "order #4521-88", "the years 1914-1918 and 1939-1945", "at 5 dot 30", "won 6-4 3-6 7-6 6-2", "room 12, floor 3", "score at half time 45 to 38", "born 04.05.1986",
]


@pytest.fixture(scope="module")
def texts():
    return [t for t in pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist() if t]


@pytest.fixture(scope="module")
def tagger(texts):
    return pii.train([t[: pii.SAMPLE_CHARS] for t in texts[:500]])


def placed(texts, pieces):
    rng = random.Random(5)
    for i, piece in enumerate(pieces):
        words = texts[600 + i % 300].split()[:120]
        at = rng.randint(0, len(words))
        before = " ".join([*words[:at], ""])
        yield piece, before + " ".join([piece, *words[at:]]), len(before), len(before) + len(piece)


def test_variants_by_hand(texts, tagger):
    met, asked = 0, 0
    for kind, pieces in WRITTEN.items():
        cases = list(placed(texts, pieces * 2))
        for (_, _, a, b), (_, found) in zip(cases, pii.all_spans(tagger, [c[1] for c in cases]), strict=True):
            met += any(k == kind and min(b, y) - max(a, x) >= 0.8 * (b - a) for k, x, y in found)
            asked += 1
    assert met >= 0.8 * asked


def test_look_alikes_by_hand(texts, tagger):
    cases = list(placed(texts, NOTHING * 2))
    taken = {c[0] for c, (base, found) in zip(cases, pii.all_spans(tagger, [c[1] for c in cases]), strict=True) if any(s[1] < c[3] and s[2] > c[2] for s in found if s not in base)}
    assert len(taken) <= 1


def test_texts_as_they_are_have_nothing_more(texts, tagger):
    more = sum(len(found) - len(base) for base, found in pii.all_spans(tagger, [t[:20_000] for t in texts[600:]]))
    assert more <= 1
