from __future__ import annotations

import html
import math
import os
import random
import re
import time
from collections import defaultdict

import pytest

from mergelens.llm.page_text import Element, Page, extract_pages, main_text, path_scores
from tests.conftest import SF_SMALL


def test_generated_pages(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = {r.page_id: r for r in extract_pages(pages, ["page_id", "url"], "html").collect()}
    for page in pages.collect():
        article = re.search(r"<article>(.*?)</article>", page.html, re.S)[1]
        blocks = re.split(r"</?(?:h1|p|br)>", re.sub(r"</?b>", "", article))
        expected = " ".join(" ".join(html.unescape(b).split()) for b in blocks if b.strip())
        assert got[page.page_id].text == expected
        assert got[page.page_id].n_chars == len(expected)
        assert got[page.page_id].url == page.url


def test_parts_that_are_not_the_article():
    body = "<p>First line, with <i>marks</i>.</p><ul><li>one<li>two</ul><p>Last&nbsp;&amp; least.</p>"
    expected = "Title First line, with marks. one two Last & least."
    around = (
        "<html><head><title>x</title><style>p{}</style></head><body class='with-sidebar'>"
        "<header><h2>Site</h2></header><nav><a>menu, one. two.</a></nav><script>if (a<b) '</p>'</script>"
        "<div id=cookie-notice>We use cookies, ok. Yes.</div>{}<aside>more, more.</aside>"
        "<section class='reader comments'><p>I like it, very much. Really, very, very much so.</p></section>"
        "<form><p>Mail, please. Now.</p></form><footer>&copy; all, of it.</footer></body></html>"
    )
    for holder in (
        "<article><h1>Title</h1>{}</article>",
        "<main><article><header><h1>Title</h1></header>{}<footer>by me</footer></article></main>",
        "<div class='content with-sidebar'><h1>Title</h1>{}<div class=sidebar>side, text.</div></div>",
        "<div><div><h1>Title</h1>{}<div class='ad-box ad'>buy, now.</div></div></div>",
    ):
        assert main_text(around.replace("{}", holder.replace("{}", body))) == expected


def test_odd_pages(spark):
    deep = "<div>" * 3000 + "deep, text." + "</div>" * 3000
    cases = {
        "": "", "   ": "", "plain &lt; text": "plain < text", "<p>a<p>b": "a b", "<p": "<p",
        "<script>x": "", "<!-- <p>no</p> -->": "", "</div></p>end": "end", "a<br>b": "a b", "a<b>b</b>c": "abc",
        deep: "deep, text.", "<article></article>": "", "<ARTICLE><P>Up</P></ARTICLE>": "Up",
        "<p hidden>no</p><p>yes</p>": "yes", "x" * 100_000: "x" * 100_000,
    }
    for source, expected in cases.items():
        assert main_text(source) == expected, source[:50]
    rows = [(1, None, "u", "t", 5), (1, "<p>same</p>", None, "t", 5), (1, "<p>same</p>", None, "t", 5)]
    df = spark.createDataFrame(rows, "page_id long, html string, url string, text string, n_chars int")
    got = extract_pages(df, ["page_id", "url"], "html").collect()
    assert sorted((r.text, r.n_chars) for r in got) == [("", 0), ("same", 4), ("same", 4)]
    assert extract_pages(df.limit(0), ["page_id", "url"], "html").count() == 0


def test_content_in_several_containers():
    """All high-scored text stays, whatever elements it is split over, with the headings between."""
    long = [f"Part {i} tells a story, slowly; it has words, marks, and an end. " * 3 for i in range(20)]
    lines = [" ".join(t.split()) for t in long]
    around = "<html><body><nav><a>one</a> <a>two</a></nav>{}<footer>all rights</footer></body></html>"
    for first in (17, 12, 10):
        for one, two in (
            ("div", "div"), ("div", "section"), ("article", "article"), ("main", "article"),
            ("article", "div"), ("div", "article"),
        ):
            parts = [
                f"<{name}><h2>Head {i}</h2>" + "".join(f"<p>{t}</p>" for t in texts) + f"</{name}>"
                for i, (name, texts) in enumerate(((one, long[:first]), (two, long[first:])))
            ]
            expected = " ".join(["Head 0", *lines[:first], "Head 1", *lines[first:]])
            assert main_text(around.replace("{}", "".join(parts))) == expected, (first, one, two)
    cells = "".join(f"<td><p>{t}</p></td>" for t in long)
    assert main_text(around.replace("{}", f"<table><tr>{cells}</tr></table>")) == " ".join(lines)
    after = f"<article><p>{long[0]}</p></article><span>x</span><p>{long[1]}</p>"
    assert main_text(around.replace("{}", after)) == " ".join(lines[:2])


def test_icons_formulas_and_fallback_texts():
    """Only script, style and the like are raw; nothing after an icon or a formula is lost."""
    page = "<article><p>Start, with {} in it.</p><p>And an end, of it.</p></article><svg><a>x</a></svg>"
    cases = {
        "<svg class=i />": "", "<svg/>": "", "<svg viewBox='0 0 1 1'><path d='M0 0'/></svg>": "", "<math/>": "",
        "<svg><title>Icon</title><style>a{}</style><g><text>no</text></g></svg>": "", "<svg><title/><g/></svg>": "",
        "<math><mi>a</mi><mo>+</mo><mi>b</mi></math>": "a+b", "<template>no</template>": "", "<template/>": "",
        "<math><semantics><mi>x</mi><annotation>\\x</annotation></semantics></math>": "x",
        "<object data=x>fall <b>back</b></object>": "fall back", "<object/>": "", "<iframe src=x />": "",
        "<noscript>plain <i>form</i></noscript>": "plain form", "<noscript/>": "", "<iframe src=x></iframe>": "",
        "<xmp><b>&amp;</b></xmp>": "<b>&amp;</b>", "<script>'<p>'</script>": "", "<style>p{}</style>": "",
        "<object data=x>": "", "<noscript>": "", "<iframe src=x>": "", "<math>": "",
        "<textarea>no</textarea>": "",
    }
    for source, shown in cases.items():
        expected = f"Start, with {shown} in it. And an end, of it."
        assert main_text(page.replace("{}", source)) == " ".join(expected.split()), source
    for source in ("<svg>", "<svg><path d='M0 0'>", "<template>", "<title>", "<svg><title>", "<textarea>"):
        got = main_text(page.replace("{}", source))
        assert got.startswith("Start, with") and got.endswith("And an end, of it."), source
        assert main_text(page.replace("{}", f"<b>{source}</b>")).endswith("And an end, of it."), source


def test_names_do_not_remove_most_of_the_text():
    """An element with most of the text stays, whatever its name is; small named ones go."""
    text = "".join(f"<p>Part {i} tells a story, slowly; it has marks, and an end.</p>" for i in range(9))
    shown = " ".join(re.findall(r"<p>(.*?)</p>", text))
    side = "<div class=sidebar><p>More, of it.</p></div><div class=comments><p>I like it, much.</p></div>"
    page = "<body><div class=menu>" + "<a>far away, and so on</a> " * 99 + "</div>{}" + side + "</body>"
    for names in (
        "content no-sidebar", "post with-comments", "hasShare main", "search-result", "related", "comments",
        "page has-header", "popup modal", "sidebar",
    ):
        for holder in (
            f"<div class='{names}'>{text}</div>", f"<div class='{names}'><h2>Two</h2>{text}</div>",
            f"<article class='{names}'>{text}</article>", f"<div id='{names}'><div role=search>{text}</div></div>",
            f"<form class='{names}'><input>{text}<label>Send, please.</label></form>",
        ):
            for title in ("", "<h1>Title</h1>"):
                got = main_text(page.replace("{}", title + holder))
                assert got.removeprefix("Title ") == ("Two " if "h2" in holder else "") + shown, (names, holder[:30])
    assert main_text(f"<form action=x>{page.replace('{}', text)}</form>") == shown
    results = "".join(f"<div class='search-result'>{p}</div>" for p in text.split("\n"))
    assert main_text(page.replace("{}", results)) == shown
    replies = "<div class=comments><article class=comment><p>I like it, very, very much.</p></article></div>"
    for one in ("<article>{}</article>", "<main>{}</main>"):
        assert main_text(one.replace("{}", text) + 40 * replies) == shown
    inner = f"<article><h1>Title</h1><p>It starts, slowly; it has marks.</p><div class=related>{text}</div></article>"
    assert main_text(inner) == f"Title It starts, slowly; it has marks. {shown}"


HOSTILE = {
    "tags without end": "<a " * 60_000,
    "quoted ends": '<a ">" ' * 30_000,
    "mixed quotes": "<a \"'>' " * 30_000,
    "declarations": "<!" * 100_000,
    "distinct paths": "".join(f"<x{i}>text, a.</x{i}>" for i in range(10_000)),
    "open elements": "<div>" * 80_000 + "text.",
    "closing tags of an element far above": "<x><div>" + "<b>" * 20_000 + "</x>" * 20_000,
    "a path of distinct names": "".join(f"<y{i}>t." for i in range(10_000)),
}


@pytest.mark.parametrize("name", HOSTILE)
def test_hostile_pages_cost_no_more_than_their_length(name):
    page = "<article><p>The story, in full.</p></article>"
    began = time.process_time()
    text = main_text(page + HOSTILE[name])
    # A few tenths of a second; with work that grows with the square, minutes.
    assert time.process_time() - began < 10
    assert "The story, in full." in text


def test_scores_equal_those_of_all_pairs():
    draw = random.Random(5)
    for _ in range(50):
        page = Page([Element("", -1, 0)])
        for i in range(60):
            parent, name = draw.randrange(len(page.elements)), draw.choice("abcd")
            page.elements.append(Element(name, parent, page.below(parent, name)))
            page.texts.append((i + 1, 0, "x" * draw.randrange(1, 9) + "," * draw.randrange(3)))
        own = defaultdict(list)
        for element, _, text in page.texts:
            steps, at = (), element
            while at:
                steps, at = (page.elements[at].name, *steps), page.elements[at].parent
            own[steps, page.elements[element].path].append(text)
        assert len(own) == len({steps for steps, _ in own})
        found = path_scores(page, page.texts)
        for (steps, number), _ in own.items():
            weights = texted = marked = 0.0
            for (other, _), texts in own.items():
                shared = len(os.path.commonprefix([steps, other]))
                distance = len(steps) + len(other) - 2 * shared
                if distance <= 4:
                    weight = math.exp(-(distance**2) / 2)
                    weights += weight
                    texted += weight * sum(map(len, texts)) / len(texts)
                    marked += weight * (1 + sum(t.count(",") for t in texts)) / len(texts)
            assert found[number] == pytest.approx(texted / weights * (marked / weights))
