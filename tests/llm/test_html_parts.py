"""Operator 7: several articles, class names outside an article, and built pages whose text is known."""

import pytest
from llm_helpers import words

from wikisift.llm.html_text import main_text

LONG = "A sentence of the article that goes on for quite a while, with many words in it."


def test_every_article_is_kept():
    short = "<article><h2>Two</h2><p>Short one.</p></article>"
    page = f"<body><nav>Home News</nav><article><h1>One</h1>{f'<p>{LONG}</p>' * 8}</article>{short}<article class='teaser'><p>Read this too</p></article><footer>About</footer></body>"
    assert main_text(page) == "\n".join(["One", *[LONG] * 8, "Two", "Short one."])
    even = f"<body><div>Menu A B</div><article><p>{LONG}</p></article><article><p>{LONG} Again.</p></article></body>"
    assert main_text(even) == f"{LONG}\n{LONG} Again."


@pytest.mark.parametrize("name,kept", [("search-engines", True), ("advertising-history", True), ("social-science", True), ("notice-period", True), ("search-form", False), ("site-header", False), ("main-nav", False), ("sidebar", False),
                                       ("cookie-notice", False), ("ad-container", False), ("with-sidebar", True), ("comments", False), ("share-links", False)])
def test_names_without_an_article(name, kept):
    page = f"<body><div>{f'<p>{LONG}</p>' * 6}<div class='{name}'><p>Inner text of this part of the page.</p></div><p>{LONG}</p></div></body>"
    assert ("Inner text of this part of the page." in main_text(page)) == kept
    assert main_text(page).count(LONG) == 7


def test_built_pages_give_back_their_text(rng):
    """Pages built around known paragraphs, with and without an article element."""
    for k in range(60):
        paragraphs = [" ".join(words(rng, rng.randrange(15, 60)).split()) for _ in range(rng.randrange(4, 15))]
        inner = "".join(rng.choice(["<p>{}</p>", "<p>{}\n</p>", "<p><b>{}</b></p>", "<blockquote>{}</blockquote>"]).format(p.replace(" ", rng.choice([" ", "  ", "\n"]), 3)) for p in paragraphs)
        junk = rng.sample(["<nav><ul><li><a href=x>Home</a></li><li><a href=y>News</a></li></ul></nav>", "<header><h2>Site</h2></header>", "<aside>More stories</aside>", "<script>var x = '<p>no</p>';</script>",
                           "<div class='cookie-banner'>We use cookies</div>", "<form><input><button>Go</button></form>", "<div id=comments><p>First!</p></div>", "<footer>Imprint</footer>", "<!-- hidden -->"], 5)
        article = rng.choice(["<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>", "<article>{}</article>"]).format(inner)
        cut = rng.randrange(6)
        assert main_text(f"<html><head><title>T</title></head><body>{''.join(junk[:cut])}{article}{''.join(junk[cut:])}</body></html>") == "\n".join(paragraphs), k
