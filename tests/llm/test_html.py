import random

import pytest

from sparkrec.llm import html_text
from sparkrec.llm.html_text import extract, main_text, read_page

PAGE = """<!DOCTYPE html><html><head><title>Site</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header class="top"><h1>Site name</h1><a href="/">Home</a></header><nav><ul><li><a href=x>One</a></li><li><a href=y>Two</a></ul></nav>
<div id="cookie-notice">We use cookies, please accept them all, now.</div><!-- an ad --><div class="ad">Buy this, and that, today!</div>
<div class="wrap"><div class="content"><h2>A title</h2><div class="text"><p>First paragraph, with&nbsp;words. &lt;b&gt; &amp; more<br>on the next line.
<p>Second <b>bo</b>ld   one, with more.</p><ul><li>item one<li>item two</ul><blockquote>Quoted, words.</blockquote></div>
<form><label>Name</label><input name=a><button>Send</button></form>
<section class="comments"><p>I liked it, really, a lot. Much more text than in the article, so many words, and words.</p></section></div>
<aside>Aside, text.</aside><div class="sidebar"><p>Related stuff, here. And so on.</p></div></div><footer>&copy; all</footer></body></html>"""


def test_article_of_nested_divisions():
    assert main_text(PAGE) == ("A title First paragraph, with words. <b> & more on the next line. Second bold one, with more. "
                               "item one item two Quoted, words.")


def test_article_element_with_open_inline_tags():
    page = ("<body><nav><a href=a>Menu, one</a></nav><article><h1>Head &amp; line</h1><p><b>Head line<br><p>Some text, here.</p>"
            "<p><b>x.<br><p>y &#233; z</p></article><footer>Foot, note.</footer></body>")
    assert main_text(page) == "Head & line Head line Some text, here. x. y é z"


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("<p></p>", ""), ("plain, text", "plain, text"), ("<p>a &amp b", "a & b"), ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
    ("<div>unclosed <span>text", "unclosed text"), ("</p></div>ends first", "ends first"), ("<script>never</script>", ""),
    ("<p a=\"x>y\">quoted</p>", "quoted"), ("<nav>only a menu</nav>", ""), ("<p>one</p><!-- <p>two</p> --><p>three</p>", "one three"),
])
def test_small_pages(html, text):
    assert main_text(html) == text


def test_paths_follow_blocks():
    page = read_page("<div class='b a'><p>x<p>y</div><p>z")
    assert [page.elements[b.element].path for b in page.blocks] == ["/div.a.b/p", "/div.a.b/p", "/p"]


def test_rows(spark):
    schema = "page_id long, url string, html string, text int, n_chars string"
    rows = [(1, "u", PAGE, 1, "x"), (2, None, None, None, None), (None, "v", "", 2, "y"), (1, "u", PAGE, 1, "x"), (3, "w", "<p>" + "long, text. " * 50_000, 0, "")]
    got = extract(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 5 and {len(r.text) for r in got} >= {0, len("long, text. ") * 50_000 - 1}
    assert all(r.n_chars == len(r.text) for r in got)
    assert extract(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize("name", ["content has-sidebar", "no-sidebar entry-content", "overflow-hidden article", "search-results", "related", "share"])
def test_names_on_the_main_wrapper_keep_the_article(name):
    article = "<h1>Title</h1><p>Some text, here, and more.</p>"
    foot = '<div class="sidebar"><p>Side, text.</p></div><footer>Foot, note.</footer>'
    assert main_text(f'<body><div class="{name}"><article>{article}</article></div>{foot}</body>') == "Title Some text, here, and more."
    assert main_text(f'<body><div class="{name}">{article}</div><footer>Foot, note.</footer></body>') == "Title Some text, here, and more."


def test_named_teasers_stay_out_beside_an_article():
    page = '<article><p>The article, here.</p></article><div class="related"><article><p>A longer teaser, of another text, not here.</p></article></div>'
    assert main_text(page) == "The article, here."


LONG = "A long passage, with commas, and with more of them, goes on. It ends, at last, after many words, here. " * 4


@pytest.mark.parametrize("html,text", [
    (f"<body><div class=content><p>Intro</p><blockquote>{LONG}</blockquote><p>Outro</p></div></body>", f"Intro {LONG.strip()} Outro"),
    (f"<body><div class=a><div class=b>A lead, in short.</div><div class=c><p>{LONG}</p><p>{LONG}</p></div></div></body>",
     f"A lead, in short. {LONG.strip()} {LONG.strip()}"),
    (f"<body><article><p>{LONG}</p><ul><li><a href=x>Source one</a><li><a href=y>Source two</a></ul></article></body>",
     f"{LONG.strip()} Source one Source two"),
    (f"<body><div class=c><p>{LONG}</p><ul><li><a href=x>Source one</a></ul><p>{LONG}</p></div><div class=d><a href=z>More</a></div></body>",
     f"{LONG.strip()} Source one {LONG.strip()}"),
    (f"<body><div class=m><a href=x>One</a> <a href=y>Two</a></div><p>{LONG}</p><p>{LONG}</p></body>", f"{LONG.strip()} {LONG.strip()}"),
])
def test_nothing_of_the_article_is_dropped(html, text):
    assert main_text(html) == text


def made_page(seed: int) -> tuple[str, str]:
    """A page whose elements have no telling kinds or names, and the text of its article as it was put in."""
    rng, n = random.Random(seed), iter(range(10_000))

    def words(least: int, most: int, mark: str = "") -> str:
        said = [f"w{next(n)}" for _ in range(rng.randint(least, most))]
        return " ".join(w + ("," if mark and i % 5 == 4 and i + 1 < len(said) else "") for i, w in enumerate(said)) + mark

    told: list[str] = []

    def tell(text: str) -> str:
        told.append(text)
        return text

    def passage() -> str:
        kind = rng.choice(["p", "p", "p", "quote", "list", "section", "sources"])
        if kind == "quote":
            return f"<blockquote>{tell(words(20, 60, '.'))}</blockquote>"
        if kind == "list":
            return "<ul>" + "".join(f"<li>{tell(words(3, 9, '.'))}</li>" for _ in range(3)) + "</ul>"
        if kind == "section":
            return f"<section><h3>{tell(words(2, 5))}</h3><p>{tell(words(25, 60, '.'))}</p></section>"
        if kind == "sources":
            return f"<ul><li><a href=s>{tell(words(2, 3))}</a></li></ul><p>{tell(words(25, 50, '.'))}</p>"
        return f"<p>{tell(words(25, 70, '.'))}</p>"

    menu = "".join(f"<div><a href=l>{words(1, 2)}</a></div>" for _ in range(rng.randint(4, 9)))
    body = f"<h1>{tell(words(3, 8))}</h1><p>{tell(words(25, 60, '.'))}</p>" + "".join(passage() for _ in range(rng.randint(2, 9)))
    body += f"<p>{tell(words(25, 60, '.'))}</p>"
    foot = "".join(f"<span>{words(1, 2)}</span> <a href=f>{words(1, 3)}</a> " for _ in range(3))
    for k in range(rng.randint(1, 3)):
        body = f"<div class=k{k}>{body}</div>"
    return f"<html><body><div class=x><div>{menu}</div></div>{body}<div class=y>{foot}</div><div class=z>{words(1, 4)}</div></body></html>", " ".join(told)


def test_ratios_alone_find_the_article_of_made_pages(monkeypatch):
    pages = [made_page(seed) for seed in range(200)]
    assert [main_text(html) for html, _ in pages] == [text for _, text in pages]
    monkeypatch.setattr(html_text, "path_scores", lambda page, live: {page.elements[b.element].path: 1.0 for b in live})
    assert sum(main_text(html) == text for html, text in pages) < 20  # paths of equal scores find nothing
