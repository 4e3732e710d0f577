"""Titles that were cut inside a character reference keep what is left of it, as the SQL of the queries has it."""

import pytest

from waymark.plans import pages
from waymark.sources import selectors

TITLE = "A &amp; B &lt;b&gt; &#38; &#x26; &amp"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("pages"))
    html = f"<html><body><nav><ul><li><a href='/'>x &amp y</a></li></ul></nav><article><h1>{TITLE}</h1></article></body></html>"
    spark.createDataFrame([(1, "https://a.example.com/", html), (2, "https://a.example.com/2", None)], "page_id long, url string, html string").write.parquet(f"{at}/pages.parquet")
    return at


def title(query, spark, folder):
    return query(spark, folder).filter("page_id = 1").first()["title"]


def test_t24_headings(spark, folder):
    assert title(pages.headings, spark, folder) == "A & B <b> & & &amp"


def test_u01_fallback_selectors(spark, folder):
    assert title(pages.fallback_selectors, spark, folder) == "A & B <b> & & &amp"


def test_u01_selectors(spark, folder):
    assert title(pages.selectors, spark, folder) == "A & B <b> & & &amp"


def test_scripts_are_left_alone():
    page = "<script>a && b &amp</script><p>a && b &amp;&lt &#38 &#x26;</p><style>&"
    assert selectors.closed_only(page) == "<script>a && b &amp</script><p>a &amp;&amp; b &amp;&amp;lt &amp;#38 &#x26;</p><style>&"
