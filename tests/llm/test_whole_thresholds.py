"""Thresholds and bands come from all rows, not from a sample of them."""

import functools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from waymark.llm import pii, rules
from waymark.llm.ranks import at_ranks


@pytest.mark.parametrize("spread", [1.0, 1e-300, 1e12])
def test_values_at_ranks_are_those_of_a_sort(spark, spread):
    r = np.random.default_rng(3)
    x = {"a": r.normal(size=700) ** 5 * spread, "b": np.repeat([0.25, 1e9, -3.0], [200, 1, 40]), "c": np.array([7.5])}
    table = spark.createDataFrame([(k, float(v)) for k, vs in x.items() for v in vs], "name string, x double").cache()
    got = at_ranks(table, lambda _, n: [0, n // 200, n // 2, n - 1, n, -1])
    assert got == {k: (len(v), {i: float(np.sort(v)[i]) for i in (0, len(v) // 200, len(v) // 2, len(v) - 1)}) for k, v in x.items()}
    assert at_ranks(table.limit(0), lambda _, n: [0]) == {}


@pytest.fixture(scope="module")
def written():
    r = np.random.default_rng(8)
    prose = "The river runs slowly past the old mill and every child knows its stones in summer . ".split()
    texts = [" ".join(r.choice(prose, 60)) for _ in range(400)]
    return [pii.planted(r, t)[0] if i % 4 == 0 else t for i, t in enumerate(texts)]


def test_thresholds_are_those_of_all_texts(spark, written, monkeypatch):
    monkeypatch.setattr(pii, "train", functools.partial(pii.train, windows=1500, steps=150))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*written, *written[:50], "", None])], "doc_id long, text string").repartition(5)
    learned = pii.fit(docs, sample=5)
    whole = pii.thresholds(learned._replace(least=np.full(len(pii.KINDS), pii.LEAST_MARGIN, np.float32)), sorted(set(written)))
    assert np.allclose(learned.least, whole, atol=1e-3)
    assert (whole > pii.LEAST_MARGIN).any()


def test_spans_kept_once_give_what_reading_again_gives(spark, written, monkeypatch):
    monkeypatch.setattr(pii, "train", functools.partial(pii.train, windows=1500, steps=150))
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate([*written[:80], "", None])], "doc_id long, text string, `a.b` int")
    t = pii.trained(docs, sample=20)
    high = t._replace(least=np.full(len(pii.KINDS), 6, np.float32))
    kept = pii.candidates(docs, t)
    assert pii.replaced(kept, high.least).orderBy("doc_id").collect() == pii.redacted(docs, high).orderBy("doc_id").collect()
    assert pii.replaced(kept, high.least).columns == docs.columns
    listed = pii.listed(pii.spans_of(docs, t), high.least).orderBy("doc_id").collect()
    assert listed == pii.detected(docs, high).orderBy("doc_id").collect()
    assert [r.spans for r in listed] == [pii.written(all_) for _, all_ in pii.all_spans(high, [*written[:80], "", ""])]
    assert pii.candidates(docs, t).filter(F.size("spans") > 0).count() > 5


def test_bands_are_those_of_all_labelled_rows(spark):
    """A few good rows with many digits, beyond the first 4,000 by the hash that chose a sample, belong to the band as well."""
    r = np.random.default_rng(4)
    n, prose = 6000, np.array("The river runs slowly past the old mill and every child knows its stones in summer .".split())
    ids = spark.range(n).select("id", F.xxhash64("id", F.lit(23)).alias("h"), (F.crc32(F.col("id").cast("string")) % 5 == 0).alias("out")).filter("not out").orderBy("h").collect()
    late = {x.id for x in ids[4000:4100]}
    texts = [" ".join(r.choice(prose, 55) if i not in late else map(str, r.integers(10**6, size=55))) for i in range(n)]
    docs = spark.createDataFrame([(i, "xx", t) for i, t in enumerate(texts)], "doc_id long, lang string, text string").repartition(6)
    known = spark.createDataFrame([(i, 1) for i in range(n)], "doc_id long, quality int")
    bands = rules.fit(docs, known)
    figures = np.array(rules.fertility().figures([texts[x.id] for x in ids])).T
    passed = rules.base_counts(*rules.column_bytes(pa.array([texts[x.id] for x in ids])))
    figures = figures[2 * passed["n_repeat_words"] <= passed["n_words"]]
    assert np.allclose(bands["xx"], rules.band_of(figures)) and len(figures) > 4000
    assert rules.quality_rules(docs, bands).filter(F.col("doc_id").isin(sorted(late)) & F.col("kept")).count() > 60
    assert rules.passing(docs, known).count() == rules.quality_rules(docs, bands).filter("kept").count()
    assert rules.passing(docs, known).columns == docs.columns
