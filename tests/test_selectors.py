"""The selector engine against a plain matcher over the same tree, on pages with awkward markup."""

import random
import time

import pytest
from pyspark.sql import functions as F

from waymark.sources import selectors as css

PAGE = (
    '<div role="main" id=m><h1 class="DUwDvf x">Blue <b>Door</b></h1><ul><li>a<li class=k>b<li>c</ul><p>one<p>two<a href="/maps/place/1?x">go</a><br>'
    '<button data-item-id="phone:tel:017" aria-label="ACCEPT all">Call</button></div><p>out<script>var a = "<p>no</p>";</script>'
)


@pytest.mark.parametrize(
    "selector, texts",
    [
        ("h1.DUwDvf", ["Blue Door"]),
        ('h1[class*="DUwDvf"]', ["Blue Door"]),
        ('div[role="main"] h1', ["Blue Door"]),
        ('a[href*="/maps/place/"]', ["go"]),
        ('button[data-item-id^="phone:tel:"]', ["Call"]),
        ('button[aria-label*="Accept all" i]', ["Call"]),
        ('button[aria-label*="Accept all"]', []),
        ("#m > ul > li:nth-of-type(2)", ["b"]),
        ("li + li", ["b", "c"]),
        ("li ~ li", ["b", "c"]),
        ("li:not(.k)", ["a", "c"]),
        ("li:nth-child(2n+1)", ["a", "c"]),
        ("li:nth-child(-n+2)", ["a", "b"]),
        ('p:has-text("TWO")', ["twogoCall"]),
        ("div p , h1", ["Blue Door", "one", "twogoCall"]),
        ("div > p", ["one", "twogoCall"]),
        ("ul>li:first-child", ["a"]),
        ("p", ["one", "twogoCall", "out"]),
        ("script", ['var a = "<p>no</p>";']),
        ("span", []),
    ],
)
def test_forms_of_selectors(selector, texts):
    assert [f.text for f in css.Program([selector]).run(PAGE)] == texts


@pytest.mark.parametrize("selector", ["", "a >", "a:hover", "a[", "p:nth-child(x)", 'b:has-text("x") i', "a:not(:has-text(x))", "..a"])
def test_selectors_that_cannot_be_read(selector):
    with pytest.raises(ValueError):
        css.Program([selector])


TAGS = ("div", "span", "b", "section")


def grown(rng, depth=0):
    """A random tree: (tag, attributes, children)."""
    kids = [grown(rng, depth + 1) for _ in range(rng.randint(0, 4 if depth < 5 else 0))]
    return rng.choice(TAGS), {k: rng.choice("xyz") for k in ("id", "class", "t") if rng.random() < 0.5}, kids


def shown(node):
    tag, attributes, kids = node
    return f"<{tag}{''.join(f' {k}={v}' for k, v in attributes.items())}>{''.join(map(shown, kids))}</{tag}>"


def fits(node, part):
    tag, attributes, place, of_type = node
    return all((tag == a if k == "tag" else place == a if k == "nth-child" else of_type == a if k == "nth-of-type" else attributes.get(k) == a) for k, a in part)


def plain(tree, steps):
    """Places of the elements that a selector finds: every element is compared with all that could stand for each step."""
    flat = []  # node, parent's place, earlier siblings' places

    def walk(node, parent, earlier, place, of_type):
        at = len(flat)
        flat.append(((node[0], node[1], place, of_type), parent, list(earlier)))
        seen, kinds = [], {}
        for i, kid in enumerate(node[2], 1):
            kinds[kid[0]] = kinds.get(kid[0], 0) + 1
            seen.append(walk(kid, at, seen, i, kinds[kid[0]]))
        return at

    walk(tree, None, [], 1, 1)

    def ok(at, k):
        node, parent, earlier = flat[at]
        if not fits(node, steps[k][1]):
            return False
        if k == 0:
            return True
        how = steps[k][0]
        if how == ">":
            return parent is not None and ok(parent, k - 1)
        if how == "+":
            return bool(earlier) and ok(earlier[-1], k - 1)
        if how == "~":
            return any(ok(e, k - 1) for e in earlier)
        while parent is not None:
            if ok(parent, k - 1):
                return True
            parent = flat[parent][1]
        return False

    return [at for at in range(len(flat)) if ok(at, len(steps) - 1)]


def test_random_selectors_on_random_trees():
    rng = random.Random(11)
    for _ in range(300):
        tree, programs, wanted = grown(rng), [], []
        for _ in range(6):
            steps, source = [], ""
            for k in range(rng.randint(1, 4)):
                part = [("tag", rng.choice(TAGS))] if rng.random() < 0.6 else []
                if rng.random() < 0.4 or not part:
                    key = rng.choice(("class", "id", "t", "nth-child", "nth-of-type"))
                    part.append((key, rng.choice("xyz") if len(key) < 6 else rng.randint(1, 3)))
                how = rng.choice((" ", ">", "+", "~")) if k else ""
                steps.append((how, part))
                source += {"": "", " ": " ", ">": " > ", "+": "+", "~": " ~ "}[how]
                source += "".join(a if t == "tag" else f".{a}" if t == "class" else f"#{a}" if t == "id" else f"[t={a}]" if t == "t" else f":{t}({a})" for t, a in part)
            programs.append(source)
            wanted.append(plain(tree, steps))
        got = css.Program(programs).run(shown(tree))
        assert [[f.pos for f in got if f.selector == i] for i in range(6)] == wanted


def test_a_page_costs_its_tags():
    began = time.process_time()
    found = css.Program(["div b", "b > i + i", "p"]).run("<div><b>" * 30_000 + "<i></i>" * 1000 + "</p>" * 30_000)
    assert len(found) == 30_000 + 999 and time.process_time() - began < 20


def test_columns_and_sql(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, ""), (4, "<p>x")], "k int, html string")
    found = {r[0]: r[1:] for r in df.select("k", css.first_texts(F.col("html"), {"a": ["h2", "h1.x"], "b": ["p"]}, 2).alias("f")).select("k", "f.*").collect()}
    assert found == {1: ("Blue Door", "one"), 2: (None, None), 3: (None, None), 4: (None, None)}
    css.register(spark)
    sql = spark.sql("SELECT k, e.selector, e.pos, e.text, e.attributes['class'] AS c FROM {df} d, LATERAL css_select(d.html, 'li.k', 'p') e", df=df)
    assert sorted(map(tuple, sql.collect()), key=str) == sorted([(1, 0, 5, "b", "k"), (1, 1, 7, "one", None), (1, 1, 8, "twogoCall", None), (1, 1, 12, "out", None), (4, 1, 0, "x", None)], key=str)
