"""Operator 7 on pages whose article is known."""

import numpy as np
from llm_helpers import rows_of, words

from wikisift.llm.html_text import extract, main_text, smooth, threshold

NAV = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>'


def paragraphs(rng, n):
    return [" ".join(words(rng, rng.randrange(5, 60)).split()) for _ in range(n)]


def test_article(rng):
    p = paragraphs(rng, 6)
    body = "".join(f"<p>{x}</p>" for x in p)
    frame = "<html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head><body>{nav}<!-- c --><div class=\"ad\">Buy now</div>{main}<footer>&copy; x</footer></body></html>"
    want = "\n".join(["Title", *p])
    for main in (f"<article><h1>Title</h1>{body}</article>", f"<main><h1>Title</h1>{body}</main>", f'<div id="content"><h1>Title</h1>{body}</div>',
                 f'<article><h1>Title</h1>{body}<form><p>Name</p></form><aside>More</aside><section id="comments"><p>{p[0]} nice</p></section></article>',
                 f'<div class="page-sidebar"><p>Left</p></div><article class="with-sidebar"><h1>Title</h1>{body}</article><div class="cookie-notice">We use cookies</div>'):
        assert main_text(frame.replace("{nav}", NAV).replace("{main}", main)) == want
    assert main_text(frame.replace("{nav}", "<nav><p>Menu").replace("{main}", f"<article><h1>Title</h1>{body}</article>")) == want


def test_broken_markup_and_white_space():
    assert main_text("<p><b>One  two\n three<br><p>Four &amp; &eacute;&#x41;&nbsp;x</div></i><p></p>") == "One two three\nFour & éA x"
    assert main_text("<article><p>Es.<p>Short.<p>" + "long text " * 50 + "</article><footer>f") == "Es.\nShort.\n" + ("long text " * 50).strip()
    assert main_text("plain words only") == "plain words only"
    assert main_text("<script>x</script><nav>y</nav>") == "" and main_text("") == "" and main_text("<") in ("", "<")
    assert main_text("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == "a\nb\nc\nd"


def test_ratio_helpers():
    flat = smooth(np.ones(9))
    assert np.allclose(flat, 1) and smooth(np.array([5.0]))[0] == 5
    assert 1 < threshold(np.array([1.0, 1.1, 9.0, 9.2])) < 9


def test_rows(spark, clash):
    df = spark.createDataFrame([(1, "u", None), (2, None, ""), (None, "u", "<article>é😀 x</article>"), (None, "u", "<article>é😀 x</article>"), (3, "v", "<p>" + "w " * 100_000), (4, "v", "<div>" * 3000 + "deep")], "page_id long, url string, html string")
    got = rows_of(extract(clash(df)), "page_id", "url", "text", "n_chars")
    assert got == sorted([(1, "u", "", 0), (2, None, "", 0), (None, "u", "é😀 x", 4), (None, "u", "é😀 x", 4), (3, "v", ("w " * 100_000).strip(), 199_999), (4, "v", "deep", 4)], key=repr)
    assert extract(df.where("false")).count() == 0
