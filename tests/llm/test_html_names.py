"""Operator 7: class names and ids inside an article drop none of its text."""

import pytest

from wikisift.llm.html_text import main_text

LONG = "words of the article that go on for a while " * 8
PAGE = '<html><body><nav><a href="/">Home</a></nav><div class="alert">We moved</div>{main}<footer>f</footer></body></html>'
KEPT = [
    ('<header class="entry-header"><h1>Title</h1></header>', "Title"),
    ('<pre><code>x = 1 <span class="token comment"># one</span>\n<span class="hljs-comment">// two</span></code></pre>', "x = 1 # one // two"),
    ('<p>a <span class="search-hit">hit</span> <em class="alert">now</em></p>', "a hit now"),
    ('<p class="alert">mind this</p>', "mind this"),
    ('<section id="social-impact"><h2 id="comment">Impact</h2><p>on it</p></section>', "Impact\non it"),
    ('<div class="content with-sidebar has-comments right-sidebar"><p>all of it</p></div>', "all of it"),
    ('<section id="ad-hoc-networks" class="header search"><p>of nodes</p></section>', "of nodes"),
    ('<ul class="notices"><li>first</li></ul>', "first"),
]
GONE = ['<div class="ad">Buy</div>', '<section id="comments"><p>nice</p></section>', '<div class="post-comments">nice</div>', '<ul class="share-buttons"><li>Tell</li></ul>',
        '<div class="sidebar">More</div>', '<div class="cookie-notice">We use</div>', "<aside>More</aside>", '<div role="navigation">Next</div>']


@pytest.mark.parametrize("outer", ["article", "main"])
@pytest.mark.parametrize("part,text", KEPT)
def test_kept_inside(outer, part, text):
    assert main_text(PAGE.replace("{main}", f"<{outer}>{part}<p>{LONG}</p></{outer}>")) == f"{text}\n{LONG.strip()}"


@pytest.mark.parametrize("part", GONE)
def test_gone_inside(part):
    assert main_text(PAGE.replace("{main}", f"<article><p>{LONG}</p>{part}</article>")) == LONG.strip()


def test_inline_parts_without_an_article():
    main = f'<div id="content"><p>{LONG}<span class="search-hit">hit</span></p><pre><code>x <span class="token comment"># one</span></code></pre></div>'
    assert main_text(PAGE.replace("{main}", main)) == f"{LONG}hit\nx # one"
