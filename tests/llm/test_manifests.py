"""License scans, whitening and Merkle manifests against plain versions, on awkward tables."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from waymark.llm import licenses, merkle, queries, whitening
from waymark.llm.licenses import Found

from .test_kernels import lower

LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(40_000)) + " Released under the MIT License."


def rows(df):
    return [r.asDict() for r in df.collect()]


# Licenses ---------------------------------------------------------------------------------------------------------


def plain_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    places = []
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), sorted(places)


TEXTS = [
    None, "", " \n\t", "MIT License", "mit licence", "émit license", "cc by cc by cc by", "CC-BY-NC 4.0", "Apache License, Version 2.0", "apache\nlicense", LONG,
    "GNU General Public License, version 3", "the gnu\ngeneral public license mit license cc by apache license", "x" * 5000, "\x00cc\x00by\x7f", "ccby", "cc by sa", "😀 cc by 😀",
]


def test_license_base_places(spark):
    schema = "doc_id long, text string, label string, base string, start int, detections string"
    table = [(i % 15, t, "a", "b", 1, "c") for i, t in enumerate(TEXTS)] + [(None, "cc by", "a", "b", 1, "c")]
    got = rows(licenses.licenses(spark.createDataFrame(table, schema).repartition(3)))
    want = collections.Counter((i, *map(str, plain_base(t))) for i, t, *_ in table)
    assert collections.Counter((r["doc_id"], str(r["n_words"]), str([(b["start"], b["label"]) for b in r["base"]])) for r in got) == want
    assert all((r["score"] > 0) >= bool(r["base"]) and 0 <= r["score"] <= 1 for r in got)
    assert rows(licenses.licenses(spark.createDataFrame([], schema))) == []


def test_license_query(spark, sf_dir):
    got = {r["doc_id"]: r for r in rows(queries.queries()["op11_licenses"](spark, sf_dir))}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        n, places = plain_base(d["text"])
        r = got[d["doc_id"]]
        first, last = (places[0][0], places[-1][0]) if places else (None, None)
        base = ",".join(sorted({label for _, label in places}))
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (n, len(places), first, last, base)
        labels = [x for x in r["labels"].split(",") if x]
        assert labels == sorted(set(labels)) and set(filter(None, base.split(","))) <= set(labels)


@pytest.mark.parametrize(
    "text, labels",
    [
        ("This work is licensed under the GNU General Public License, version 3.", {"gpl-3.0"}),
        ("SPDX-License-Identifier: GPL-2.0-or-later", {"gpl-2.0"}),
        ("GNU Lesser General Public Licence v2.1", {"lgpl-2.1"}),
        ("https://www.apache.org/licenses/LICENSE-2.0.txt", {"apache-2.0"}),
        ("Licensed under CC BY-NC 4.0.", {"cc-by-nc-4.0"}),
        ("Creative Commons Attribution-ShareAlike 4.0 International", {"cc-by-sa-4.0"}),
        ("Creative Commons Attribution", {"cc-by"}),
        ("the 3-Clause BSD license", {"bsd-3-clause"}),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy\n of this software and associated documentation files (the \"Software\")", {"mit"}),
        ("This is free and unencumbered software released into the public domain.", {"unlicense"}),
        ("Copyright (c) 2020 A. All rights reserved.", {"commercial", "copyright"}),
        ("We spoke about the general public and a driving test.", set()),
        ("a mit of a license", set()),
    ],
)
def test_license_rules(text, labels):
    _, found = licenses.Scanner().scan(licenses.worded(text.encode()))
    assert {f.label for f in found} == labels


def test_license_rules_are_hundreds_and_gated_rightly():
    """The keywords of a rule are in all its matches: without the gate nothing more is found in texts made of rules' own words."""
    scan, rng = licenses.Scanner(), random.Random(4)
    assert len(scan.rules) > 300
    vocabulary = sorted({w for r in scan.rules for w in re.findall("[a-z0-9]+", r.pattern.pattern)}) + ["2", "3", "0", "licence", "licences"]
    lines = [line.split(" ", 1)[1] for level in licenses.LEVELS for line in level.strip().splitlines()]
    for _ in range(600):
        parts = [re.sub(r"[^a-z0-9 ]", " ", rng.choice(lines).replace("{v}", rng.choice(["2", "3 0", "2 1"])).replace("VER", "version ").replace("GRANT", "licensed under the")) if rng.random() < 0.7 else rng.choice(vocabulary) for _ in range(6)]
        words = licenses.worded(" ".join(parts).encode())
        spelled = words.replace(" licence", " license")
        plain = {(i, m.start()) for i, r in enumerate(scan.rules) for m in r.pattern.finditer(spelled)}
        seen = {w for _, w in scan.automaton.iter(spelled)}
        assert all(f" {scan.rules[i].keyword} " in seen and all(w in spelled for w in scan.rules[i].needs) for i, _ in plain)


@given(st.lists(st.tuples(st.integers(0, 12), st.integers(1, 6), st.integers(0, 4), st.integers(0, 9)), max_size=14))
@settings(max_examples=300, deadline=None)
def test_settled_intervals(spans):
    found = [Found(s, s + n, level, rule, f"r{rule}") for s, n, level, rule in spans]
    inside = lambda a, b: b.start <= a.start and a.end <= b.end
    stand = []
    for f in sorted(found, key=lambda f: (f.level, f.start - f.end, f.rule, f.start)):
        if not any(inside(f, g) or (inside(g, f) and g.level < f.level) for g in stand):
            stand.append(f)
    key = lambda f: (f.start, f.end, f.level)
    assert sorted(map(key, licenses.settle(found))) == sorted(map(key, stand))


# Whitening --------------------------------------------------------------------------------------------------------


def plain_whitening(vectors):
    x = np.floor(1024 * np.array(vectors, np.float64)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    centred = x - s / n
    v = centred.T @ centred / n
    values, axes = np.linalg.eigh(v)
    order = np.argsort(-values)[:8]
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s, strict=True)) for r in x]
    return n, deviation, values[order], axes[:, order], centred, np.trace(v)


def test_whitening_equals_a_plain_version(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(300, 12)) * np.linspace(3, 0.2, 12) + 5
    vectors = vectors.astype(np.float32)
    inf, nan = float("inf"), float("nan")
    table = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(7, vectors[7].tolist()), (None, vectors[0].tolist())]
    odd = [(900, None), (901, [None] + [0.0] * 11), (902, [nan] * 12), (903, [0.0] * 11 + [-inf]), (904, [1.0, 2.0]), (905, [])]
    schema = "vec_id long, embedding array<float>, label int, n string, component string, whitened string"
    frame = spark.createDataFrame([(*r, 1, "n", "c", "w") for r in table + odd], schema).repartition(5)
    got = rows(whitening.components(frame))
    n, deviation, values, axes, centred, trace = plain_whitening([v for _, v in table])
    want = collections.defaultdict(list)
    for (i, _), d, c in zip(table, deviation, centred, strict=True):
        want[i].append((d, c @ axes / np.sqrt(values)))
    assert len(got) == 8 * n and {r["n"] for r in got} == {n}
    signs = {}
    for r in got:
        k = r["component"] - 1
        near = min(abs(abs(w[k]) - abs(r["whitened"])) for d, w in want[r["vec_id"]] if d == r["deviation"])
        assert near < 1e-8
        assert r["explained"] == pytest.approx(values[k] / trace, rel=1e-9) and r["identity_error"] < 1e-9
        for _, w in want[r["vec_id"]]:
            if abs(w[k]) > 1e-6:
                signs.setdefault(k, set()).add(np.sign(w[k]) * np.sign(r["whitened"]))
    assert all(len(s) == 1 for s in signs.values())


def test_whitening_of_odd_tables(spark):
    schema = "vec_id long, embedding array<double>"
    assert rows(whitening.components(spark.createDataFrame([], schema))) == []
    assert rows(whitening.components(spark.createDataFrame([(1, None), (2, [None]), (3, [])], schema))) == []
    same = rows(whitening.components(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)))
    assert len(same) == 4 and all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 for r in same)
    line = rows(whitening.components(spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(5)], schema)))
    assert [r["whitened"] is None for r in sorted(line, key=lambda r: (r["vec_id"], r["component"]))] == [False, True, True] * 5 and line[0]["identity_error"] < 1e-9
    far = rows(whitening.components(spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 2.0])], schema)))
    assert len(far) == 6 and {r["deviation"] for r in far if r["vec_id"] == 1} == {None}


def test_deviations_near_the_end_of_a_long():
    for n, spread in ((3, 10), (5_000_000, 400), (60_000_000, 40), (1 << 33, 1 << 20)):
        x = np.random.default_rng(n % 97).integers(-spread, spread, size=(50, 4))
        fit = whitening.Moments(n, np.array([n // 3, -n // 5, 7, 0], object), np.zeros((4, 4)))
        got = whitening.Whitening(fit, np.ones(4), np.eye(4), 4.0).deviations(x)
        exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, fit.sums, strict=True)) for r in x]
        assert got == [e if e < 1 << 63 else None for e in exact]


@given(st.lists(st.integers(1, 40), min_size=1, max_size=6), st.integers(0, 1000))
@settings(max_examples=40, deadline=None)
def test_merged_moments_equal_those_of_all(sizes, seed):
    rng = np.random.default_rng(seed)
    parts = [rng.integers(-1000, 1000, size=(n, 5)) + rng.integers(-10**9, 10**9) for n in sizes]
    total = whitening.Moments.of(parts[0])
    for p in parts[1:]:
        total = total.merged(whitening.Moments.of(p))
    x = np.concatenate(parts)
    assert total.n == len(x) and total.sums.tolist() == x.sum(axis=0).tolist()
    centred = x - np.array([int(s) / len(x) for s in x.sum(axis=0)])
    assert np.allclose(total.scatter, centred.T @ centred, rtol=1e-9, atol=1e-3)


# Merkle -----------------------------------------------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(digests):
    """(root, proofs): of each leaf its levels of siblings (before, after)."""
    proofs, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for leaf, i in enumerate(at):
            lo = i // 8 * 8
            proofs[leaf].append(("".join(level[lo:i]), "".join(level[i + 1 : lo + 8])))
            at[leaf] = i // 8
        level = [sha(*level[i : i + 8]) for i in range(0, len(level), 8)]
    return level[0], proofs


def plain_manifest(leaves):
    """{(tree, key, digest): proofs} with subroots and the root, of (tree, key, digest) rows."""
    first = lambda v: (v is not None, v if v is not None else 0)
    trees = collections.defaultdict(list)
    for tree, key, digest in leaves:
        trees[tree].append((first(key), digest, key))
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    made = {t: plain_tree([d for _, d, _ in sorted(trees[t])]) for t in names}
    root, tops = plain_tree([made[t][0] for t in names])
    out = collections.Counter()
    for t, top in zip(names, tops, strict=True):
        for (_, digest, key), proof in zip(sorted(trees[t]), made[t][1], strict=True):
            out[(t, key, digest, made[t][0], tuple(proof + top))] += 1
    return root, out


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 8, None: 9}, {"a": 512}, {"a": 513, "b": 1, "ä": 64}, {"big": 4700, "x": 3, "": 65}, {f"t{i}": 1 + i % 3 for i in range(600)}])
def test_manifest_equals_a_plain_tree(spark, sizes):
    leaves = [(t, k % 4000 if k else None, sha(str(t), str(k % 4500))) for t, n in sizes.items() for k in range(n)]
    random.Random(1).shuffle(leaves)
    made = merkle.manifest(spark.createDataFrame(leaves, "tree string, key long, digest string").repartition(7))
    got = rows(made.proofs())
    root, want = plain_manifest(leaves)
    assert made.root == root and {r["root"] for r in got} == {root}
    assert collections.Counter((r["tree"], r["key"], r["digest"], r["subroot"], tuple((s["before"], s["after"]) for s in r["steps"])) for r in got) == want


def test_manifest_of_nothing(spark):
    made = merkle.manifest(spark.createDataFrame([], "tree string, key long, digest string"))
    assert made.root is None and rows(made.proofs()) == []


ODD = [
    (1, "A text", "en", "s", 6), (1, "A text", "en", "s", 6), (1, "another", "en", None, None), (None, None, None, None, None), (None, "X", None, "s", 1), (3, "", "", "", 0), (6, "ÀB", "é", "1:", -5), (9, LONG, "en", "s", 7),
    *((i, f"Row {i}", "de", "s", 5) for i in range(40, 140)), (5, "alone", "zz", "s", 5), (2, "ABC", "one", "s", 3),
]


def test_merkle_query_and_its_sql(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, tree string, key string, digest string, claimed string, block int, idx int, steps string, root string"
    spark.createDataFrame([(*r, *["t", "k", "d", "c", 1, 2, "s", "r"]) for r in ODD], schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = rows(queries.queries()["op13_merkle"](spark, str(tmp_path)))
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda i, text, lang, source, n: sha(*map(part, (i, source, lang, n, text)))
    root, want = plain_manifest([(r[2], r[0], leaf(*r)) for r in ODD])
    claims = {(r[2], r[0], leaf(*r)): leaf(r[0], lower(r[1]) if r[1] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 else r[1], *r[2:]) for r in ODD}
    expected = collections.Counter()
    for (tree, key, digest, subroot, proof), n in want.items():
        folded = claims[(tree, key, digest)]
        for before, after in proof:
            folded = sha(before, folded, after)
        expected[(key, digest, subroot, root, sha(*(b + a for b, a in proof)), folded, folded == root)] += n
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert collections.Counter(tuple(r[c] for c in names) for r in got) == expected
    assert {r["verified"] for r in got} == {True, False}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert collections.Counter(con.sql(f"SELECT {', '.join(names)} FROM ({queries.OP13_SQL.strip()})").fetchall()) == expected


def test_folding_detects_any_change(spark):
    leaves = spark.range(70).select(F.lit("a").alias("tree"), F.col("id").alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    proofs = merkle.manifest(leaves).proofs()
    told = proofs.select(merkle.folded(F.col("digest"), F.col("steps")).alias("own"), merkle.folded(F.sha2(F.lit("x"), 256), F.col("steps")).alias("other"), "root")
    assert all(r["own"] == r["root"] != r["other"] for r in told.collect())
