"""Operators and pipeline stages on awkward tables and against brute force."""

import collections
import hashlib
import zlib
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from waymark.llm import bpe, bytecnn, exact, labelled, minhash, packing, pagetext, pii, queries, rules, toxicity, urls
from waymark.llm.components import components

from .test_kernels import lower, plain_spans, shingles, words

LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(30_000))
NEAR = [" ".join(f"w{i}" if i != j else "changed" for i in range(120)) for j in (200, 0, 60, 119)]
#: Null ids and texts, empty and blank texts, one very long, ties, repeated rows; columns named like the operators' own.
ROWS = [
    (1, None), (2, ""), (3, " \n\t"), (4, "Hello"), (5, "hello"), (6, LONG), (6, LONG), (7, LONG), (None, "hello"), (None, None), (8, "a b"), (9, "A B"),
    *((10 + i, t) for i, t in enumerate(NEAR)), (20, "mail a@b.co, +1 (171) 555-2028. idiot! " * 30), (21, "\x00\x1c é ́ 😀 <|endoftext|>"), (22, NEAR[0].upper()),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, row string, kept int, rep int, word string, set_key int, y int, task int, band int, component string, h string, twins string, r string, hit int"


@pytest.fixture(scope="module")
def docs(spark):
    extra = [(i, t, None if i == 4 else "en", "s", None if t is None else len(t), *["x", "y", 1, 2, "w", 3, 1, 0, 5, "c", "h", "t", "r", 6]) for i, t in ROWS]
    return spark.createDataFrame(extra, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def rows(df):
    return [r.asDict() for r in df.collect()]


def brute_exact(pairs):
    groups = collections.defaultdict(list)
    for i, t in pairs:
        groups[lower(t or "")].append(i)
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


@pytest.mark.parametrize("support", [1 / 2000, 0.15, 0.5])
def test_exact_duplicates(docs, empty, support):
    got = rows(exact.exact_duplicates(exact.keyed(docs), support))
    want = brute_exact(ROWS)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in want.items()}
    assert len(got) == len(ROWS)
    assert all((r["keep_id"], r["group_size"]) == by_sha[r["text_sha256"]] for r in got)
    assert collections.Counter(r["text_sha256"] for r in got if r["kept"]) == dict.fromkeys(by_sha, 1)
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])
    assert rows(exact.exact_duplicates(exact.keyed(empty), support)) == []


def test_exact_stage_keeps_one_row_and_all_columns(spark, docs, empty):
    out = corpus_pipeline.exact(spark, docs, "")
    assert out.columns == docs.columns
    kept = rows(out)
    assert len(kept) == len(brute_exact(ROWS)) and {lower(r["text"] or "") for r in kept} == set(brute_exact(ROWS))
    assert corpus_pipeline.exact(spark, empty, "").count() == 0


def brute_components(pairs, k, percent):
    ids = sorted({i for i, _ in pairs if i is not None})
    sets = {i: shingles(t or "", k) for i, t in pairs if i is not None}
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            same = len(sets[a] & sets[b])
            if same and 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_near_duplicates(docs, empty, k, percent):
    got = rows(minhash.near_duplicates(docs, k, percent))
    want = brute_components(ROWS, k, percent)
    assert len(got) == len(ROWS)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"])
    assert rows(minhash.near_duplicates(empty, k, percent)) == []


def test_links_through_a_chain_of_near_copies(spark, monkeypatch):
    """Many variants of one text, most pairs below the threshold: only complete search finds all links."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = np.random.default_rng(5)
    base = [f"t{i}" for i in range(100)]
    table = []
    for i in range(150):
        w = list(base)
        for j in rng.choice(100, size=int(rng.integers(0, 5)), replace=False):
            w[j] = f"x{i}_{j}"
        table.append((i, " ".join(w)))
    df = spark.createDataFrame(table, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(minhash.near_duplicates(df, 3, 85))}
    assert got == brute_components(table, 3, 85)


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, 9), (9, 5), (7, 7), (3, 9)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 5: 3, 9: 3, 3: 3}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_round_trips(docs, empty):
    got = rows(bpe.round_trips(docs))
    assert sorted((r["doc_id"] or -1, r["decoded_sha256"]) for r in got) == sorted((i or -1, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in ROWS)
    assert all(r["n_tokens"] == 0 and r["ids_sha256"] == hashlib.sha256(b"").hexdigest() for r in got if r["doc_id"] in (1, 2))
    assert rows(bpe.round_trips(empty)) == []
    ids = bpe.encoded(docs.filter("doc_id in (4, 21)"))
    assert {bytes(r["bytes"]).decode() for r in rows(bpe.decoded(ids))} == {"Hello", ROWS[-2][1]}


def check_packing(got, texts):
    whole = Tokenizer.from_file(packing.TOKENIZER)
    lengths = collections.Counter()
    for t in texts:
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 1]
        for at in range(0, len(ids), 4096):
            lengths[at // 4096, at, len(ids[at : at + 4096]), zlib.crc32(np.array(ids[at : at + 4096], "<u4").tobytes())] += 1
    assert collections.Counter((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == lengths
    bins = collections.defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 4096
    return len(bins), -(-sum(r["length"] for r in got) // 4096)


def test_packed(docs, empty):
    n, least = check_packing(rows(packing.packed(docs)), [t for _, t in ROWS])
    assert n == least
    assert rows(packing.packed(empty)) == []


def test_quality_rules(docs, empty):
    got = rows(rules.quality_rules(docs))
    assert len(got) == len(ROWS)
    assert all(r["base_failed"] and not r["kept"] and r["n_words"] == 0 for r in got if r["doc_id"] in (1, 2, 3))
    assert rows(rules.quality_rules(empty)) == []
    assert rows(rules.quality_rules(docs.drop("lang"))) and all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) for r in got)


def test_personal_data(docs, empty):
    tagger = pii.train([])
    got = rows(pii.detected(docs, tagger))
    texts = collections.Counter(pii.written(plain_spans(t or "")) for _, t in ROWS)
    assert collections.Counter(r["base_sha256"] for r in got) == {hashlib.sha256(k.encode()).hexdigest(): n for k, n in texts.items()}
    twenty = next(r for r in got if r["doc_id"] == 20)
    assert (twenty["n_email"], twenty["n_phone"]) == (30, 30)
    assert rows(pii.detected(empty, tagger)) == [] and pii.fit(empty) is not None
    out = pii.redacted(docs, tagger)
    assert out.columns == docs.columns and "a@b.co" not in out.filter("doc_id = 20").first().text and out.filter("doc_id = 1").first().text is None


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (bytecnn, "quality")])
def test_classifiers(spark, docs, empty, module, label):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(4, 23)] + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    model = module.fit(docs, labels)
    got = rows(module.scored(docs, model))
    assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    limit = 0.5 if label == "toxic" else 0.3
    assert all(r["predicted"] == (r["score"] >= limit) for r in got)
    assert rows(module.scored(empty, module.fit(empty, labels))) == []
    module.fit(docs, labels.limit(0))


def test_pages(spark):
    schema = "page_id long, url string, html string, text string, host string"
    table = [(1, None, None, "x", "y"), (2, "u", "", "x", "y"), (None, "u", "<p>Hi, you.</p>", "x", "y"), (3, "u", "<article>" + "<p>Some, words. </p>" * 5000, "x", "y"), (3, "u", "<article>" + "<p>Some, words. </p>" * 5000, "x", "y")]
    df = spark.createDataFrame(table, schema)
    got = rows(pagetext.extracted(df))
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in got) == [(0, 8), (1, 0), (2, 0), (3, 64_999), (3, 64_999)]
    assert rows(pagetext.extracted(df.limit(0))) == []


def test_url_rules(spark):
    cases = {
        "http://a.com/en/1": ("com/en/", "block"), "http://x.Example.com/en/7?q": ("example.com/en/7", "allow"), "https://example.net/de/8": ("example.net/de/8", "block"),
        "https://a.net/de/8": ("net/de/", "allow"), "http://org/es/": ("org/es/", "block"), "http://notcom/en/": (None, "allow"), "http://m.spam-farm.example.com/fr/": (None, "block"),
        "http://xspam-farm.example.com/fr/": (None, "allow"), "nonsense": (None, "allow"), None: (None, "allow"), "http://a.com/en": (None, "allow"), "": (None, "allow"),
    }
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(cases)], "page_id long, url string, host string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in rows(urls.judge_urls(df))}
    assert got == dict(enumerate(cases.values()))
    assert rows(urls.judge_urls(df.limit(0))) == []


@pytest.mark.parametrize(
    "url, want",
    [(None, ("", "")), ("x", ("", "")), ("http://A.b/C?d#e", ("a.b", "/C")), ("a://b://c", ("b:", "//c")), ("http://É.Com", ("É.com", "")), ("http://a?b/c", ("a", "")), ("h://", ("", "")), ("h://a\nb/c\n?", ("a\nb", "/c\n"))],
)
def test_split_url(spark, url, want):
    df = spark.createDataFrame([(1, url)], "page_id long, url string")
    assert [(r["host"], r["path"], r["verdict"]) for r in rows(urls.judge_urls(df))] == [(*want, "allow")]


def test_block_list_is_an_input(spark, sf_dir, tmp_path):
    """A list from a file or table, and not the words, decides where no rule fits."""
    text, table = tmp_path / "hosts.txt", str(tmp_path / "hosts.parquet")
    text.write_text("# source: test\n\nFree-Bets.example.net  # a host\nhttp://adult-x.example.net./x\n")
    spark.createDataFrame([("free-bets.example.net",), ("adult-x.example.net",), (None,)], "host string").write.parquet(table)
    for path in (str(text), table):
        spark.conf.set(urls.BLOCK_LIST, path)
        try:
            got = rows(queries.queries()["op9_url_filters"](spark, sf_dir))
        finally:
            spark.conf.unset(urls.BLOCK_LIST)
        bad = [r for r in got if r["rule"] is None and r["host"].endswith(("free-bets.example.net", "adult-x.example.net"))]
        assert bad and all(r["verdict"] == "block" for r in bad)
        assert all(r["verdict"] == "allow" for r in got if r["rule"] is None and r not in bad)


def test_a_large_index_is_built_from_a_table(spark, monkeypatch):
    monkeypatch.setattr(urls, "RANGE", 1 << 17)
    entries = spark.range(1_000_000).select(F.concat(F.lit("host"), "id", F.lit(".example.org")).alias("host"))
    asked = spark.range(0, 2_000_000, 997).select("id", F.concat(F.lit("http://www.host"), "id", F.lit(".example.org/x")).alias("url"))
    got = {r["page_id"]: r["verdict"] for r in rows(urls.judge_urls(asked, blocked=entries, id_col="id"))}
    assert got == {i: "block" if i < 1_000_000 else "allow" for i in range(0, 2_000_000, 997)}
    with pytest.raises(ValueError):
        urls.distribute(spark.createDataFrame([("a", "block"), ("a", "allow")], "entry string, verdict string"))
    empty = entries.limit(0)
    assert rows(urls.judge_urls(asked.limit(3), blocked=empty, id_col="id"))[0]["verdict"] == "allow"


def test_small_lists_are_packed_as_large_ones_are_built(spark, monkeypatch):
    entries = ["example.org", "é.example", "*bet", "a.b.c.example/x/é", "*😀", "single", "example.org", None]
    listed = spark.createDataFrame([(e,) for e in entries], "host string")
    urls_ = ["http://www.example.org/a", "http://é.example", "http://x-bet-y.de", "http://q.a.b.c.example/x/é1", "http://a.b.c.example/x/", "http://single/", "http://1😀2.de", "x", None, "http://example.orgs/", "http://example.net/de/8?a://b"] * 2
    asked = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(urls_)], "page_id long, url string, host string, path string")
    small = rows(urls.judge_urls(asked, blocked=listed))
    monkeypatch.setattr(urls, "FEW", -1)
    assert sorted(map(str, rows(urls.judge_urls(asked, blocked=listed)))) == sorted(map(str, small))
    assert [r["listed"] for r in sorted(small, key=lambda r: r["page_id"])] == [True, True, True, True, False, True, False, False, False, False, False] * 2


def test_very_long_urls(spark):
    long = "http://" + "a." * 20_000 + "example.com/en/7" + "/x" * 100_000
    got = rows(urls.judge_urls(spark.createDataFrame([(1, long), (1, long)], "page_id long, url string")))
    assert [(r["rule"], r["verdict"]) for r in got] == [("example.com/en/7", "allow")] * 2


def test_stages(spark, docs, empty, sf_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "exact dedup", "near dedup", "pii", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns
        assert stage(spark, empty, sf_dir).count() == 0
    assert corpus_pipeline.near(spark, docs, sf_dir).filter("doc_id is null").count() == 2


def plain_verdict(text, lang, bands):
    """kept, by counting words and by the tokenizers on the whole text."""
    text = text or ""
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    many = {x for x, n in collections.Counter(windows).items() if n > 1}
    again = {j for i, x in enumerate(windows) if x in many for j in range(i, i + 3)}
    if len(w) < 50 or 100 * len(again) > 50 * len(w):
        return False
    meter = rules.fertility()
    ids, pieces = meter.encode(text), meter.pieces.encode(text)
    n = collections.Counter(ids)
    bits = -sum(c / len(ids) * np.log2(c / len(ids)) for c in n.values())
    script = rules.scripts_of(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))[0]
    band = bands.get(lang) or bands[script]
    fallback = sum(meter.pieces.is_byte(p) for p in pieces) / len(pieces)
    return band.low <= len(text) / len(ids) <= band.high and fallback <= band.fallback and (bits >= band.entropy or bits / np.log2(len(ids)) >= band.evenness)


def test_quality_rules_against_plain_figures(spark):
    sf = "/root/testdata/sf0.01"
    table, known = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    bands = rules.fit(table, known)
    assert set(bands) > set(rules.BANDS) and bands["latin"] != rules.BANDS["latin"]
    kept = {r["doc_id"]: r["kept"] for r in rows(queries.queries()["op6_quality_rules"](spark, sf))}
    assert kept == {r.doc_id: plain_verdict(r.text, r.lang, bands) for r in table.collect()}
    assert rules.fit(table.limit(0), known) == rules.fit(table, known.limit(0)) == rules.BANDS
    doubled = rules.fit(table.unionByName(table), known.unionByName(known))
    assert set(doubled) == set(bands)


def test_training_rows_are_bounded_whatever_is_repeated(spark):
    docs = spark.createDataFrame([(i % 7, "ab" * (i % 9)) for i in range(500)] + [(None, "x")], "doc_id long, text string")
    known = spark.createDataFrame([(i % 10, int(i % 10 > 3)) for i in range(100)] + [(6, 0), (None, 1)], "doc_id long, quality int")
    texts, y, weight = labelled.training_rows(docs, known, "quality", 3, 12)
    assert len(texts) == len(y) == len(weight) <= 6 and all(0 < len(t) <= 12 for t in texts)
    assert len(labelled.training_rows(docs, known.limit(0), "quality", 3, 12)[0]) == 0


def test_pipeline_against_a_plain_version(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bands = rules.fit(table, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    left = {r.doc_id: r.text for r in table.collect() if plain_verdict(r.text, r.lang, bands)}
    left = {i: t for i, t in left.items() if brute_exact(left.items())[lower(t)][0] == i}
    group = brute_components(left.items(), 5, 80)
    left = {i: t for i, t in left.items() if group[i][1] == i}
    frame = spark.createDataFrame(list(left.items()), "doc_id long, text string")
    tagger = pii.fit(frame)
    clean = {i: pii.redacted_text(t, pii.all_spans(tagger, [t])[0][1]) for i, t in left.items()}
    got = rows(corpus_pipeline.run(spark, sf_dir))
    assert {r["doc_id"] for r in got} == set(clean)
    n, least = check_packing(got, clean.values())
    assert n <= least + 1


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    for name, label, least in (("op1_toxicity", "toxic", 0.85), ("op7_quality_cnn", "quality", 0.95)):
        got = queries.queries()[name](spark, sf).filter("held_out").join(labels, "doc_id")
        hit, said, true, n = got.agg(F.sum((F.col("predicted") == 1).cast("int") * F.col(label)), F.sum("predicted"), F.sum(label), F.count("*")).first()
        assert n > 700 and hit / true >= least and hit / said >= least


class PlainArticle(HTMLParser):
    """Text inside <article>, by the standard library's parser; inline tags do not separate."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.silent, self.out = 0, 0, []

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        self.silent += tag in ("script", "style")
        if tag not in pagetext.INLINE:
            self.out.append(" ")

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        self.silent -= tag in ("script", "style")
        if tag not in pagetext.INLINE:
            self.out.append(" ")

    def handle_data(self, data):
        if self.depth and not self.silent:
            self.out.append(data)


def test_pages_are_their_articles(spark):
    """Every page of the table marks its article, so a plain parser gives the text that the ratios must find without."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r for r in rows(queries.queries()["op5_html"](spark, "/root/testdata/sf0.01"))}
    assert len(got) == pages.count()
    for r in pages.collect():
        plain = PlainArticle()
        plain.feed((r.html or "").replace("<article>", "<article> "))
        plain.close()
        want = " ".join("".join(plain.out).split())
        assert (got[r.page_id]["text"], got[r.page_id]["n_chars"], got[r.page_id]["url"]) == (want, len(want), r.url)
    # And without the mark: the ratios alone.
    bare = pages.select("page_id", "url", F.regexp_replace("html", "(</?)article", "$1div").alias("html"))
    same = sum(r["text"] == got[r["page_id"]]["text"] for r in rows(pagetext.extracted(bare)))
    assert same >= 0.98 * len(got)
