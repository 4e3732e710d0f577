"""Joins of hot keys and bitmaps, against plain joins."""

import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from waymark.llm import exact, minhash, skew
from waymark.llm.components import components

from .test_operators import brute_components, brute_exact, lower


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def hot(spark):
    """Half of the rows have key 7, some a null one, the others few each."""
    return spark.createDataFrame([(i, 7 if i % 2 else None if i % 10 == 0 else i % 23) for i in range(3000)], "id long, k long").repartition(5)


@pytest.mark.parametrize("share", [2, 30, 2000])
def test_skew_join_is_the_join(hot, monkeypatch, share):
    monkeypatch.setattr(skew, "HEAVY", share)
    table = hot.filter("k is not null and k <> 4").groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    assert rows(skew.skew_join(hot, table, ["k"], "n", 3000).select("id", "k", "n", "top")) == rows(hot.join(table, "k").select("id", "k", "n", "top"))
    assert rows(skew.skew_join(hot.limit(0), table, ["k"], "n", 3000)) == []


def test_heavy_keys_are_few(hot):
    table = hot.groupBy("k").agg(F.count("*").alias("n"))
    assert skew.heavy(table, "n", 3000).count() <= skew.HEAVY


@pytest.mark.parametrize("share", [2, 30, 2000])
def test_salted_pairs_meet_their_texts_once(spark, hot, monkeypatch, share):
    monkeypatch.setattr(skew, "HEAVY", share)
    pairs = hot.filter("k is not null").select(F.col("id").alias("a"), F.col("k").alias("b"))
    texts = spark.createDataFrame([(i, f"text {i}") for i in range(23)], "b long, t string")
    total = pairs.count()
    dealt, spread = skew.salted(pairs, texts, total)
    assert rows(dealt.join(spread, ["b", "salt"]).select("a", "b", "t")) == rows(pairs.join(texts, "b").select("a", "b", "t"))
    assert spread.count() <= 23 + 2 * share


@pytest.mark.parametrize("most", [64, 1 << 12, 1 << 27])
def test_bitmaps_of_any_size_give_the_same_rows(spark, monkeypatch, most):
    monkeypatch.setattr(skew, "MOST_BITS", most)
    monkeypatch.setattr(skew, "LEAST_BITS", 64)
    docs = spark.createDataFrame([(i if i % 50 else None, f"text {i}", i) for i in range(500)], "doc_id long, text string, word long")
    ids = spark.createDataFrame([(i,) for i in range(0, 700, 3)], "doc_id long")
    n = ids.count()
    assert rows(skew.texts_for(docs, ids, n)) == rows(docs.join(ids, "doc_id").select("doc_id", "text"))
    assert rows(skew.without(docs, ids, n)) == rows(docs.join(ids, "doc_id", "left_anti"))
    assert rows(skew.without(docs, ids.limit(0), 0)) == rows(docs)


@pytest.mark.parametrize("most", [64, 1 << 27])
def test_deduplicated_with_repeated_and_null_ids(spark, monkeypatch, most):
    """Ids with kept and dropped rows, null ids, and equal rows; bitmaps that tell nothing or nearly everything."""
    monkeypatch.setattr(skew, "MOST_BITS", most)
    monkeypatch.setattr(skew, "LEAST_BITS", 64)
    table = [(i % 90 if i % 7 else None, f"{'TEXT' if i % 2 else 'text'} {i % 60 if i % 5 else i}", i) for i in range(600)] + [(1, None, 0), (None, "", 1), (3, "text 12", 2), (3, "text 12", 3)]
    docs = spark.createDataFrame(table, "doc_id long, text string, kept long")
    got = [tuple(r) for r in exact.deduplicated(docs).collect()]
    want = brute_exact((i, t) for i, t, _ in table)
    assert collections.Counter(lower(t or "") for _, t, _ in got) == dict.fromkeys(want, 1)
    assert all(i == want[lower(t or "")][0] for i, t, _ in got) and set(got) <= set(table)


def test_components_of_a_hub(spark, monkeypatch):
    monkeypatch.setattr(skew, "HEAVY", 3)
    edges = [(0, i) for i in range(1, 400)] + [(1000, i) for i in range(399, 500)] + [(i, i + 1) for i in range(2000, 2040)] + [(5000, i) for i in range(3000, 3050)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 0 for i in (*range(500), 1000)} | {i: 2000 for i in range(2000, 2041)} | {i: 3000 for i in (*range(3000, 3050), 5000)}
    assert got == want


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_no_link_of_a_table_is_lost(spark, k, percent):
    """All pairs of the documents of sf0.01, by brute force: recall of links is 1 there."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    given = [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(table, k, percent).collect()}
    assert got == brute_components(given, k, percent)


def test_stages_give_their_rows_at_any_bitmap(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    whole = rows(corpus_pipeline.near(spark, docs, "").select("doc_id"))
    monkeypatch.setattr(skew, "MOST_BITS", 64)
    monkeypatch.setattr(skew, "LEAST_BITS", 64)
    assert rows(corpus_pipeline.near(spark, docs, "").select("doc_id")) == whole
