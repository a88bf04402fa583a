from __future__ import annotations

import pytest

from reviewmill.llm import content

CHROME = (
    '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>',
    '<div class="ad">Buy this wonderful thing today and save a lot of money.</div>',
    '<aside><p>Related stories that nobody needs.</p></aside>',
    '<div id="comments"><p>First!</p><p>I disagree with all of this, at length and in detail.</p></div>',
    '<form><label>Search</label><input name="q"><button>Go</button></form>',
    '<div class="cookie-notice">We use cookies.</div>',
    '<footer>&copy; 2024 &middot; Somebody</footer>',
    "<script>var t='</p>';</script><style>p{}</style><!-- <p>hidden</p> -->",
)


def page(body):
    return f"<!DOCTYPE html><html><head><title>Title</title></head><body>{CHROME[0]}{CHROME[1]}{body}{''.join(CHROME[2:])}</body></html>"


@pytest.mark.parametrize(
    "body, text",
    [
        ("<article><h1>T</h1><p>One.</p><p>Two &amp; three.</p></article>", "T\nOne.\nTwo & three."),
        ("<article><h1>T</h1><p><b>One.<br><p>Two.</p></article>", "T\nOne.\nTwo."),
        ("<article><p>a\n\t b&nbsp;c <i>d</i>e</p> tail </article>", "a b\xa0c de\ntail"),
        ("<main><ul><li>x<li>y</ul><table><tr><td>1<td>2</table></main>", "x\ny\n1\n2"),
        ("<article><p>kept</p><div class='share'>Share it</div></article>", "kept"),
        ("<article><header><h1>Head</h1></header><p>Body</p></article>", "Head\nBody"),
        ("<article></article>", ""),
        ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"),
        ("<article class='sidebar'><p>an article whatever it is called</p></article>", "an article whatever it is called"),
    ],
)
def test_articles(body, text):
    assert content.main_text(page(body)) == text


def test_density_finds_the_article_without_a_name():
    paragraphs = [f"This is paragraph {i} of the story, with many words and hardly a link in it." for i in range(8)]
    body = "<div><div>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</div></div>"
    links = "<div>" + "".join(f'<a href="/{i}">Link number {i}</a> ' for i in range(30)) + "</div>"
    plain = f"<html><body>{links}{body}{links}</body></html>"
    assert content.main_text(plain) == "\n".join(paragraphs)


STORY = [f"This is paragraph {i} of the story, with many words and hardly a link in it." for i in range(8)]
LINKS = "<ul>" + "".join(f'<li><a href="/{i}">Another story, number {i}</a></li>' for i in range(12)) + "</ul>"
TEASERS = "".join(f'<article><h3><a href="/{i}">Teaser number {i}</a></h3><p>Read on.</p></article>' for i in range(6))


def paragraphs(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


@pytest.mark.parametrize(
    "body",
    [
        f"<div><div>{paragraphs(STORY)}</div></div><div>{TEASERS}</div>",
        f"<div>{TEASERS}</div><section>{paragraphs(STORY)}</section>{TEASERS}",
        f"<article>{paragraphs(STORY[:4])}</article><article>{paragraphs(STORY[4:])}</article>",
        f"<div><article>{paragraphs(STORY[:5])}</article><article>{paragraphs(STORY[5:])}</article></div><div>{TEASERS}</div>",
        f"<main><div>{paragraphs(STORY)}</div>{LINKS}</main>",
        f"<main>{paragraphs(STORY)}{LINKS}</main>",
        f"<main>{LINKS}<div>{LINKS}</div><article>{paragraphs(STORY)}</article></main>",
    ],
)
def test_density_decides_beside_articles_and_mains(body):
    assert content.main_text(page(body)) == "\n".join(STORY)


@pytest.mark.parametrize(
    "plain",
    [
        f"<body class='has-sidebar'><div>{paragraphs(STORY)}</div></body>",
        f"<body class='sidebar'><div>{paragraphs(STORY)}</div></body>",
        f"<body>{LINKS}<div class='content-with-sidebar'>{paragraphs(STORY)}</div></body>",
        f"<body>{LINKS}<div id='post' class='no-comments'>{paragraphs(STORY)}</div></body>",
        f"<body>{LINKS}<div class='form'><div class='comments'>{paragraphs(STORY)}</div></div></body>",
        f"<body><article>{paragraphs(STORY[:6])}<section class='related-work'>{paragraphs(STORY[6:])}</section></article></body>",
        f"<body><article>{paragraphs(STORY[:7])}<p class='notice'>{STORY[7]}</p></article></body>",
        f"<body><article>{paragraphs(STORY[:6])}<div class='long-form'>{paragraphs(STORY[6:])}</div></article></body>",
        f"<body><article>{paragraphs(STORY[:6])}<div class='notice'>{paragraphs(STORY[6:])}</div></article></body>",
        f"<body><div>{paragraphs(STORY)}</div><div class='sidebar-left'><p>Elsewhere on this site, more or less.</p></div></body>",
    ],
)
def test_names_are_evidence(plain):
    assert content.main_text(f"<html>{plain}</html>") == "\n".join(STORY)


@pytest.mark.parametrize("text", [None, "", " ", "<", "<p", "</p>", "<a href='x", "<p><p><p>", "<b></i></b>", "<script>", "<!-- x", "plain", "<p>x" * 3000])
def test_broken_pages(text):
    assert isinstance(content.main_text(text), str)


def test_deep_pages():
    assert content.main_text("<article>" + "<div>" * 5000 + "deep" + "</div>" * 5000 + "</article>") == "deep"


def test_pages(spark):
    rows = [(1, page("<article><p>x</p></article>"), "t"), (1, page("<article><p>x</p></article>"), "t"), (2, None, "t"), (3, "", None)]
    pages = spark.createDataFrame(rows, "page_id long, html string, _text string")
    found = [(r.page_id, r.text) for r in content.extract(pages).collect()]
    assert sorted(found) == [(1, "x"), (1, "x"), (2, ""), (3, "")]
    assert content.extract(pages.limit(0)).count() == 0
