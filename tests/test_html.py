"""Dropped elements and main content against plain stacks, on broken HTML."""

import random
import re

import pytest

from newsfold import constants as K
from newsfold.functions.html import NAME_RE, RAW_RE, TAG_RE, html_text, main_content, strip_dropped_elements

TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)[^>]*?(/?)>")


def walk(html):
    """(kind, name, text after the tag) of a page without comments and scripts."""
    at, kind, name = 0, "", ""
    for m in TAG.finditer(html):
        yield kind, name, html[at : m.start()]
        at, name = m.end(), m[2].lower()
        kind = "end" if m[1] else "" if m[3] or name in K.VOID_ELEMENTS else "start"
    yield kind, name, html[at:]


def text_by_hand(html):
    stack, out = [], []
    for kind, name, text in walk(html):
        if kind == "start":
            stack.append(name)
        elif kind == "end" and name in stack:
            while stack.pop() != name:
                pass
        if not set(stack) & set(K.DROPPED_ELEMENTS):
            out.append(text)
    return " ".join(" ".join(out).split())


def main_by_hand(html):
    """The text of the element with the greatest sum; of equals the one that ends first, the inner one before the outer."""
    root = {"name": "", "score": 0, "texts": []}
    stack, done, linked = [root], [], False
    for kind, name, text in walk(html):
        if kind == "start" and name in K.BLOCK_ELEMENTS:
            stack.append({"name": name, "score": 0, "texts": []})
        elif kind == "end" and name in [e["name"] for e in stack]:
            while True:
                done.append(stack.pop())
                if done[-1]["name"] == name:
                    break
        if name == "a":
            linked = kind == "start"
        words = len(text.split())
        for element, weight in zip(reversed(stack), (2, 2, 1)):
            element["score"] += weight * (-words if linked else words)
        for element in stack:
            element["texts"].append(text)
    done += reversed(stack)
    best = max(done, key=lambda e: e["score"])
    return " ".join(" ".join(best["texts"]).split()) if best["score"] >= 2 * K.MAIN_MIN_WORDS else ""


def soup(seed: int) -> str:
    r = random.Random(seed)
    names = ["nav", "NAV", "header", "footer", "svg", "noscript", "div", "p", "section", "article", "b", "a", "br", "li", "custom-nav", "h1"]
    parts = []
    for _ in range(r.randrange(60)):
        name = r.choice(names)
        tag = r.choice([f"<{name}>", f"<{name}>", f"<{name} class='x'>", f"</{name}>", f"</{name} >", f"<{name}/>"])
        parts += [tag, " ".join(f"w{r.randrange(50)}" for _ in range(r.choice([0, 0, 1, 3, 12])))]
    return " ".join(parts)


def rows_of(spark, column, pages):
    return [r[0] for r in spark.createDataFrame([(p,) for p in pages], "h string").select(column).collect()]


def test_dropped_elements_on_tag_soup(spark):
    pages = [soup(i) for i in range(300)]
    got = rows_of(spark, html_text(strip_dropped_elements("h")), pages)
    expected = [text_by_hand(p) for p in pages]
    assert got == expected and sum(map(bool, expected)) > 150


def test_main_content_on_tag_soup(spark):
    pages = [soup(1000 + i) for i in range(300)]
    got = rows_of(spark, main_content("h"), pages)
    expected = [main_by_hand(p) for p in pages]
    assert got == expected and 100 < sum(map(bool, expected)) < 300


@pytest.mark.parametrize(
    "page, text",
    [
        ("<nav>a<nav>b</nav>tail</nav>kept", "kept"),
        ("<div><nav>open<p>menu</div>kept", "kept"),
        ("before<nav>never closed <p>x</p>", "before"),
        ("</nav>stray <footer><div>a</footer>b</div>c", "stray b c"),
        ("<svg/>kept<br><nav/>too", "kept too"),
        ("x<script>if (a<b) '</p><nav>'</script>y<style>never closed", "x y"),
        ("<!-- <script> -->k<script><!-- </script>v<!-- open", "k v"),
        ("<header>" * 300 + "in" + "</header>" * 299 + "still in</header>out", "out"),
        (None, ""),
    ],
)
def test_dropped_elements(spark, page, text):
    assert rows_of(spark, html_text(strip_dropped_elements("h")), [page]) == [text]


def test_blocks_judged_together(spark):
    """Short paragraphs that no block length would keep make up the content; a long block of links and a longer single one beside do not."""
    story = "".join(f"<p>short line {i}</p>" for i in range(20))
    page = f"<body><div><a>{'link ' * 60}</a></div><div id=story>{story}</div><div><p>{'aside ' * 25}</p></div></body>"
    (got,) = rows_of(spark, main_content("h"), [page])
    assert got == " ".join(f"short line {i}" for i in range(20))


def test_long_pages(spark):
    page = "<nav>x" * 3 + "<p>word " * 3000 + "</nav>" * 3 + "<p>some words</p>" * 3000
    assert rows_of(spark, html_text(strip_dropped_elements("h")), [page]) == [" ".join(["some words"] * 3000)]


def test_tags_are_named_once(spark):
    """The tags of a page are read once for the fold and the names it carries; a pattern tests a character once for '<'."""
    plan = spark.createDataFrame([("<p>",)], "h string").select(strip_dropped_elements("h").alias("c"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(NAME_RE) == 1
    for pattern in (TAG_RE, RAW_RE.removeprefix("(?is)")):
        assert pattern.startswith("<(?:") and pattern.endswith(")")


@pytest.mark.parametrize(
    "page, text",
    [
        ("a < b <p title='x>y' c=\"z>\">d", "a d"),
        ("a <p title='open>b", "a b"),
        ("<!-- x <script> --> y <SCRIPT>z</script > w <style/>v", "y w"),
        ("<scripted>kept</scripted> 1 << 2 <>", "kept 1"),
    ],
)
def test_edges_of_tags(spark, page, text):
    assert rows_of(spark, html_text(strip_dropped_elements("h")), [page]) == [text]
