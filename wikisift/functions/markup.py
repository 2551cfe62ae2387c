"""Wiki / HTML markup cleaning as Column expressions.

Each function maps a text Column to a text Column using Spark's own regex,
array and higher-order functions, so a whole cleaning chain compiles into
one projection.  Nested constructs (templates, tables, elements, links) are
resolved by one ``aggregate`` over the text split at its delimiters, with a
stack of open buffers as the state: exact at any nesting depth, linear in
the number of delimiters, and independent of other rows.

Regex conventions: Java regexes here use ``(?d)`` (only ``\\n`` ends a line)
where ``.`` must not cross a newline, matching Python's ``.``.
"""

from __future__ import annotations

import html.entities

from pyspark.sql import Column
from pyspark.sql import functions as F

from wikisift.functions.text import col_of, pystrip

# --------------------------------------------------------------------------
# Fixed values (must equal the reference's lists).
# Elements dropped with their content.
DISCARD_ELEMENTS = [
    "gallery", "timeline", "noinclude", "pre",
    "table", "tr", "td", "th", "caption", "div",
    "form", "input", "select", "option", "textarea",
    "ul", "li", "ol", "dl", "dt", "dd", "menu", "dir",
    "ref", "references", "img", "imagemap", "source", "small",
    "sub", "sup",
]
# Self-closing tags removed.
SELF_CLOSING_TAGS = ["br", "hr", "nobr", "ref", "references", "nowiki"]
# Tags removed while their content is kept ('a' too unless links are kept).
IGNORED_TAGS = [
    "abbr", "b", "big", "blockquote", "center", "cite", "em",
    "font", "h1", "h2", "h3", "h4", "hiero", "i", "kbd", "nowiki",
    "p", "plaintext", "s", "span", "strike", "strong",
    "tt", "u", "var",
]
# Link namespaces which survive in internal links.
ACCEPTED_NAMESPACES = ["w", "wiktionary", "wikt"]
# Behaviour switches deleted from the text.
SWITCHES = [
    "__NOTOC__", "__FORCETOC__", "__TOC__", "__NEWSECTIONLINK__",
    "__NONEWSECTIONLINK__", "__NOGALLERY__", "__HIDDENCAT__",
    "__NOCONTENTCONVERT__", "__NOCC__", "__NOTITLECONVERT__", "__NOTC__",
    "__START__", "__END__", "__INDEX__", "__NOINDEX__",
    "__STATICREDIRECT__", "__DISAMBIG__",
]
# URL schemes of bracketed external links.
URL_PROTOCOLS = [
    "bitcoin:", "ftp://", "ftps://", "geo:", "git://", "gopher://", "http://",
    "https://", "irc://", "ircs://", "magnet:", "mailto:", "mms://", "news:",
    "nntp://", "redis://", "sftp://", "sip:", "sips:", "sms:", "ssh://",
    "svn://", "tel:", "telnet://", "urn:", "worldwind://", "xmpp:", "//",
]
# Placeholder names of <math> and <code> elements.
PLACEHOLDERS = [("math", "formula"), ("code", "codice")]
# --------------------------------------------------------------------------

# The HTML 4 entity table comes from Python's standard library (the same
# table the reference consults), not from a hand-written list.
ENTITY_CODEPOINTS: dict[str, int] = dict(html.entities.name2codepoint)

# Marks set inside a text while it is worked on: noncharacters, which interchanged
# text does not hold, so no character of the input is taken for one.
OPEN_MARK = "\ufdd2"
CLOSE_MARK = "\ufdd3"
SEP = "\ufdd4"
LINKED = "\ufdd5"  # where a nested link stood

# What an external link, its label and an image address look like.
URL_CHAR = r"[^\]\[<>\"\x00-\x20\x7F\s]"
ANCHOR_CHAR = r"[^\]\[\x00-\x08\x0a-\x1F]"
_PROTO = "(?:" + "|".join(URL_PROTOCOLS) + ")"
# Label: anchor characters, optionally holding [[...]] links.
_LABEL = ANCHOR_CHAR + "*(?:\\[\\[" + ANCHOR_CHAR + "+\\]\\]" + ANCHOR_CHAR + "*)*"
EXT_LINK_RE = "(?i)\\[(" + _PROTO + URL_CHAR + "+)\\s*(" + _LABEL + ")\\]"
_IMAGE_LABEL = (
    "(?:http://|https://)" + URL_CHAR + "+/[A-Za-z0-9_.,~%\\-+&;#*?!=()@\\x80-\\xFF]+\\.(?:gif|png|jpg|jpeg)"
)
EXT_IMAGE_LINK_RE = "(?i)\\[(" + _PROTO + URL_CHAR + "+)\\s*(" + _IMAGE_LABEL + ")\\]"


def _pattern(p) -> Column:
    return F.lit(p) if isinstance(p, str) else p


def _when_contains(c: Column, probe_re, expr: Column) -> Column:
    """Apply ``expr`` only to rows where ``probe_re`` occurs (cheap guard)."""
    return F.when(F.regexp_like(c, _pattern(probe_re)), expr).otherwise(c)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, though used often."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _marked(c: Column, open_re, close_re, opener: tuple, closer: tuple) -> Column:
    """``c`` with text set before and behind every opener and closer."""
    for pattern, (before, behind) in ((open_re, opener), (close_re, closer)):
        c = F.regexp_replace(c, F.concat(F.lit("("), _pattern(pattern), F.lit(")")), F.lit(before + "$1" + behind))
    return c


# ---------------------------------------------------------------- nesting --
def _mark(c: Column, open_re: str, close_re: str) -> Column:
    """Split ``c`` into tokens; opener tokens start with OPEN_MARK, closers
    with CLOSE_MARK, and keep their original text after the mark."""
    return F.split(_marked(c, open_re, close_re, (SEP + OPEN_MARK, SEP), (SEP + CLOSE_MARK, SEP)), SEP)


def _append_top(stack: Column, s: Column) -> Column:
    n = F.size(stack)
    return F.concat(F.slice(stack, 1, n - 1), F.array(F.concat(F.element_at(stack, -1), s)))


def _pop(stack: Column) -> Column:
    return F.slice(stack, 1, F.size(stack) - 1)


def nested_fold(c: Column, open_re: str, close_re: str, on_close=None) -> Column:
    """Resolve nested open/close spans innermost first.

    ``on_close(inner_text)`` gives the replacement of a closed span (default:
    drop it).  An opener never closed stays as text; a closer with nothing
    open stays as text.
    """
    toks = _mark(c, open_re, close_re)
    init = F.struct(F.lit("").alias("out"), F.array().cast("array<string>").alias("st"))

    def step(acc, t):
        out, st = acc["out"], acc["st"]
        is_open = F.substring(t, 1, 1) == OPEN_MARK
        is_close = F.substring(t, 1, 1) == CLOSE_MARK
        body = F.substring(t, 2, 1 << 30)
        depth = F.size(st)
        # text to add at the current level
        if on_close is None:
            closed_val = F.lit("")
        else:
            top = F.element_at(st, -1)
            # buffer starts with the opener text; strip it before on_close
            closed_val = on_close(top)
        popped = _pop(st)
        new_out = (
            F.when(is_open, out)
            .when(is_close & (depth > 0) & (depth == 1), F.concat(out, closed_val))
            .when(is_close & (depth > 0), out)
            .when(depth == 0, F.concat(out, F.when(is_close, body).otherwise(t)))
            .otherwise(out)
        )
        new_st = (
            F.when(is_open, F.concat(st, F.array(body)))
            .when(is_close & (depth > 1), _append_top(popped, closed_val))
            .when(is_close & (depth == 1), popped)
            .when(depth == 0, st)
            .otherwise(_append_top(st, F.when(is_close, body).otherwise(t)))
        )
        return F.struct(new_out.alias("out"), new_st.alias("st"))

    res = F.aggregate(toks, init, step, lambda acc: F.concat(acc["out"], F.array_join(acc["st"], "")))
    return res


#: Rounds of plain regexes, and of the loop behind them; a row that nests deeper is folded.
FAST_ROUNDS, LOOP_ROUNDS = 4, 200
_PAIR = OPEN_MARK + "[^" + OPEN_MARK + CLOSE_MARK + "]*" + CLOSE_MARK


def _drop_innermost_rounds(c: Column, open_re: str, close_re: str, rounds: int = FAST_ROUNDS) -> Column:
    """Mark delimiters, remove innermost pairs ``rounds`` times.

    Plain regex rounds stay inside generated code and are much cheaper than the
    fold, which is only needed for rows nested deeper than ``rounds``.
    """
    m = _marked(c, open_re, close_re, (OPEN_MARK, SEP), (SEP, CLOSE_MARK))
    for _ in range(rounds):
        m = F.regexp_replace(m, OPEN_MARK + "[^" + OPEN_MARK + CLOSE_MARK + "]*" + CLOSE_MARK, "")
    return m


def _resolve_rounds(m: Column, on_close=None) -> Column:
    """Marked text with its pairs resolved innermost first, in up to ``LOOP_ROUNDS`` rounds.

    A round is one ``split`` and one ``regexp_extract_all`` over the text, so a row costs its
    length times the depth it nests to, however many spans it has.
    """
    def inner(pair):
        return F.regexp_extract(pair, "(?s)^" + OPEN_MARK + "[^" + SEP + "]*" + SEP + "(.*)" + SEP + "[^" + SEP + "]*" + CLOSE_MARK + "$", 1)

    def one_round(st, _):
        def resolve(pairs):
            if on_close is None:
                new = F.regexp_replace(st["text"], _PAIR, "")
            else:
                values = F.transform(pairs, lambda x: on_close(inner(x)))
                new = F.array_join(F.zip_with(F.split(st["text"], _PAIR, -1), values, lambda p, v: F.concat(p, F.coalesce(v, F.lit("")))), "")
            return F.struct(F.when(F.size(pairs) > 0, new).otherwise(st["text"]).alias("text"), (F.size(pairs) == 0).alias("done"))

        return F.when(st["done"], st).otherwise(_bound(F.regexp_extract_all(st["text"], F.lit(_PAIR), F.lit(0)), resolve))

    start = F.struct(m.alias("text"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(LOOP_ROUNDS)), start, one_round, lambda st: st["text"])


def _pair_left(m: Column) -> Column:
    """A pair is left iff the first opener precedes the last closer."""
    first_open = F.instr(m, OPEN_MARK)
    last_close = F.length(m) - F.instr(F.reverse(m), CLOSE_MARK) + 1
    return (first_open > 0) & (F.instr(m, CLOSE_MARK) > 0) & (first_open < last_close)


def _strip_marks(m: Column) -> Column:
    return F.regexp_replace(m, "[" + SEP + OPEN_MARK + CLOSE_MARK + "]", "")


def drop_nested(c, open_re, close_re, probe=None) -> Column:
    """Drop nested open/close spans: regex rounds, a loop of them for deeper rows and
    the exact fold beyond.  Patterns are strings or columns."""
    c = col_of(c)

    def deeper(m):
        return _bound(_resolve_rounds(m), lambda r: F.when(_pair_left(r), nested_fold(c, open_re, close_re)).otherwise(_strip_marks(r)))

    exact = _bound(_drop_innermost_rounds(c, open_re, close_re), lambda m: F.when(_pair_left(m), deeper(m)).otherwise(_strip_marks(m)))
    return _when_contains(c, probe if probe is not None else open_re, exact)


def drop_templates(c) -> Column:
    """Remove nested ``{{ ... }}``."""
    return drop_nested(c, r"\{\{", r"\}\}")


def drop_tables(c) -> Column:
    """Remove nested ``{| ... |}``."""
    return drop_nested(c, r"\{\|", r"\|\}")


TEMPLATES_STEP = drop_templates
TABLES_STEP = drop_tables


def drop_element(c, tag: str) -> Column:
    """C13 for one tag: remove ``<tag ...> ... </tag>`` with its content, nested."""
    open_re = r"(?i)<\s*" + tag + r"\b[^>/]*>"
    close_re = r"(?i)<\s*/\s*" + tag + ">"
    return drop_nested(c, open_re, close_re, probe=r"(?i)<\s*" + tag + r"\b")


def drop_elements(c, tags: list[str] | None = None) -> Column:
    """The discarded elements, one after the other in the fixed order.

    A loop over the tags inside the row (one expression, whatever their number);
    only tags that occur are worked on, and rows without any cost one test.
    """
    tags = tags or DISCARD_ELEMENTS
    c = col_of(c)

    def drop(text, tag):
        open_re = F.concat(F.lit(r"(?i)<\s*"), tag, F.lit(r"\b[^>/]*>"))
        close_re = F.concat(F.lit(r"(?i)<\s*/\s*"), tag, F.lit(">"))
        return drop_nested(text, open_re, close_re, probe=F.concat(F.lit(r"(?i)<\s*"), tag, F.lit(r"\b")))

    return _when_contains(c, r"(?i)<\s*(?:" + "|".join(tags) + r")\b", F.aggregate(F.array(*map(F.lit, tags)), c, drop))


def drop_elements_steps(tags: list[str] | None = None) -> list:
    return [lambda c: drop_elements(c, tags)]


# ---------------------------------------------------------------- links --
def link_survives(title: Column, namespaces: list[str] | None = None) -> Column:
    """P5: an internal link survives iff it has no namespace prefix, or the
    prefix (also after a leading ':') is an accepted namespace."""
    colon = F.instr(title, ":")
    prefix = F.substring_index(title, ":", 1)
    colon2 = F.locate(":", title, 2)
    middle = F.substring(title, 2, 1 << 30)
    middle = F.substring_index(middle, ":", 1)
    accepted = F.array(*[F.lit(x) for x in (ACCEPTED_NAMESPACES if namespaces is None else namespaces)])
    fails1 = (colon > 1) & ~F.array_contains(accepted, prefix)
    fails2 = (colon == 1) & (colon2 > 2) & ~F.array_contains(accepted, middle)
    return ~(fails1 | fails2)


def url_quote(c: Column) -> Column:
    """Percent-encoded UTF-8; letters, digits and ``_ . - /`` stay."""
    e = F.url_encode(c)
    for was, now in (("+", "%20"), ("%2F", "/"), ("*", "%2A")):
        e = F.replace(e, F.lit(was), F.lit(now))
    return e


def _internal_link_text(inner: Column, keep_links: bool = False, namespaces: list[str] | None = None) -> Column:
    """The text of a link whose nested links are resolved (and marked): the label
    begins after the first pipe, or after the last one before a nested link."""
    has_pipe = F.instr(inner, "|") > 0
    title = F.when(has_pipe, F.regexp_replace(F.substring_index(inner, "|", 1), r"\s+$", "")).otherwise(inner)
    nested = F.instr(inner, LINKED) > 0
    front = F.substring_index(inner, LINKED, 1)
    after_last = F.concat(F.substring_index(front, "|", -1), F.substring(inner, F.length(front) + 1, 1 << 30))
    after_first = F.substring(inner, F.instr(inner, "|") + 1, 1 << 30)
    label = F.when(has_pipe, pystrip(F.when(nested & F.contains(front, F.lit("|")), after_last).otherwise(after_first))).otherwise(inner)
    if keep_links:
        label = F.concat(F.lit('<a href="'), url_quote(F.replace(title, F.lit(LINKED), F.lit(""))), F.lit('">'), label, F.lit("</a>"))
    return F.concat(F.lit(LINKED), F.when(link_survives(title, namespaces), label).otherwise(F.lit("")))


def internal_links(c, keep_links: bool = False, namespaces: list[str] | None = None) -> Column:
    """``[[title|label]]trail`` -> label (+ trail, which stays in place).

    Links are resolved innermost first; a link failing P5 becomes ''.
    """
    c = col_of(c)
    shown = lambda inner: _internal_link_text(inner, keep_links, namespaces)
    marked = _marked(c, r"\[\[", r"\]\]", (OPEN_MARK, SEP), (SEP, CLOSE_MARK))
    resolved = _bound(_resolve_rounds(marked, shown), lambda r: F.when(_pair_left(r), nested_fold(c, r"\[\[", r"\]\]", on_close=lambda top: shown(F.substring(top, 3, 1 << 30)))).otherwise(_strip_marks(r)))
    return _when_contains(c, r"\[\[", F.replace(resolved, F.lit(LINKED), F.lit("")))


def external_links(c, keep_links: bool = False) -> Column:
    """C3 (+C4 first): ``[url label]`` -> label; an image-URL label -> ''.

    Kept links are anchors with the URL percent-encoded.
    """
    c = col_of(c)
    if not keep_links:
        return _when_contains(c, r"\[", F.regexp_replace(F.regexp_replace(c, EXT_IMAGE_LINK_RE, ""), EXT_LINK_RE, "$2"))
    both = EXT_LINK_RE
    found = F.regexp_extract_all(c, F.lit(both), F.lit(0))
    parts = F.split(c, both, -1)

    def anchor(m):
        url, label = F.regexp_extract(m, both, 1), F.regexp_extract(m, both, 2)
        image = F.concat(F.lit('<img src="'), label, F.lit('" alt="">'))
        return F.concat(F.lit('<a href="'), url_quote(url), F.lit('">'), F.when(m.rlike("^" + EXT_IMAGE_LINK_RE), image).otherwise(label), F.lit("</a>"))

    joined = F.concat(F.element_at(parts, 1), F.array_join(F.transform(found, lambda m, i: F.concat(anchor(m), F.element_at(parts, i + 2))), ""))
    return _when_contains(c, r"\[", joined)


def external_images(c, keep_links: bool = False) -> Column:
    """C4 alone: a bracketed link whose label is an image URL."""
    c = col_of(c)
    return F.regexp_replace(c, EXT_IMAGE_LINK_RE, '<img src="$2" alt="">' if keep_links else "")


# ---------------------------------------------------------------- simple --
def behaviour_switches(c) -> Column:
    """Delete ``__NOTOC__`` and the other behaviour switches."""
    return F.regexp_replace(col_of(c), "|".join(SWITCHES), "")


def syntaxhighlight_keep(c) -> Column:
    """Keep only the body of ``<syntaxhighlight ...>body</syntaxhighlight>``."""
    return F.regexp_replace(col_of(c), r"(?s)<syntaxhighlight .*?>(.*?)</syntaxhighlight>", "$1")


def emphasis(c, html_mode: bool = False) -> Column:
    """Bold / italic quotes -> plain text (or <b>/<i> in HTML mode)."""
    c = col_of(c)
    if html_mode:
        c = F.regexp_replace(c, r"(?d)'''''(.*?)'''''", "<b>$1</b>")
        c = F.regexp_replace(c, r"(?d)'''(.*?)'''", "<b>$1</b>")
        c = F.regexp_replace(c, r"(?d)''(.*?)''", "<i>$1</i>")
    else:
        c = F.regexp_replace(c, r"(?d)'''''(.*?)'''''", "$1")
        c = F.regexp_replace(c, r"(?d)'''(.*?)'''", "$1")
        c = F.regexp_replace(c, "''\"([^\"]*?)\"''", '"$1"')
        c = F.regexp_replace(c, r"(?d)''(.*?)''", '"$1"')
        c = F.regexp_replace(c, '""([^"]*?)""', '"$1"')
    return F.replace(F.replace(c, F.lit("'''"), F.lit("")), F.lit("''"), F.lit('"'))


def _tag_alt(tags):
    return "|".join(tags)


def drop_spans(c, keep_links: bool = False) -> Column:
    """C10+C11+C12 in one pass: comments, self-closing tags and ignored tags.

    One alternation regex so removal cannot create new matches (the
    reference collects all spans first, then removes them together).
    """
    ignored = IGNORED_TAGS + ([] if keep_links else ["a"])
    pat = (
        r"(?s:<!--.*?-->)"
        + r"|(?is:<\s*(?:" + _tag_alt(SELF_CLOSING_TAGS) + r")\b[^>]*/\s*>)"
        + r"|(?is:<(?:" + _tag_alt(ignored) + r")\b.*?>)"
        + r"|(?i:</\s*(?:" + _tag_alt(ignored) + r")>)"
    )
    return F.regexp_replace(col_of(c), pat, "")


def drop_comments(c) -> Column:
    """C10."""
    return F.regexp_replace(col_of(c), r"(?s)<!--.*?-->", "")


def drop_selfclosing(c) -> Column:
    """C11."""
    return F.regexp_replace(col_of(c), r"(?is)<\s*(?:" + _tag_alt(SELF_CLOSING_TAGS) + r")\b[^>]*/\s*>", "")


def drop_ignored_tags(c, keep_links: bool = False) -> Column:
    """Drop tags, keep content."""
    ignored = IGNORED_TAGS + ([] if keep_links else ["a"])
    return F.regexp_replace(
        col_of(c), r"(?is:<(?:" + _tag_alt(ignored) + r")\b.*?>)|(?i:</\s*(?:" + _tag_alt(ignored) + r")>)", ""
    )


def _codepoint_str(cp: Column) -> Column:
    """A code point as a one-character string (Spark's chr() is mod 256)."""
    return F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32")


_ENTITY_MAP = None


def _entity_map() -> Column:
    global _ENTITY_MAP
    if _ENTITY_MAP is None:
        keys = sorted(ENTITY_CODEPOINTS)
        _ENTITY_MAP = F.map_from_arrays(
            F.array(*[F.lit(k) for k in keys]), F.array(*[F.lit(chr(ENTITY_CODEPOINTS[k])) for k in keys])
        )
    return _ENTITY_MAP


def unescape_entities(c) -> Column:
    """Named (HTML 4) and numeric character references; unknown kept."""
    c = col_of(c)
    toks = F.regexp_extract_all(c, F.lit(r"&#?\w+;|[^&]+|&"), F.lit(0))

    def fix(t):
        is_ref = F.startswith(t, F.lit("&")) & F.endswith(t, F.lit(";")) & (F.length(t) > 2)
        name = F.substring(t, 2, F.length(t) - 2)
        dec = F.when(name.rlike(r"^#[0-9]+$"), F.substring(name, 2, 1 << 30).try_cast("bigint"))
        hexv = F.when(name.rlike(r"^#x[0-9a-fA-F]+$"), F.conv(F.substring(name, 3, 1 << 30), 16, 10).try_cast("bigint"))
        cp = F.coalesce(dec, hexv)
        ok_cp = cp.isNotNull() & (cp <= 0x10FFFF) & ~cp.between(0xD800, 0xDFFF)
        num = F.when(ok_cp, _codepoint_str(cp))
        named = F.when(~F.startswith(name, F.lit("#")), F.element_at(_entity_map(), name))
        return F.when(is_ref, F.coalesce(num, named, t)).otherwise(t)

    return F.when(F.instr(c, "&") > 0, F.array_join(F.transform(toks, fix), "")).otherwise(c)


def placeholder_numbering_one(c, tag: str, name: str) -> Column:
    """W6 for one tag: n-th ``<tag>`` element -> ``name_n``; a repeated
    identical element takes the number of its first occurrence."""
    c = col_of(c)
    pat = r"(?is)<\s*" + tag + r"(?:\s*| [^>]+?)>.*?<\s*/\s*" + tag + r"\s*>"
    matches = F.regexp_extract_all(c, F.lit(pat), F.lit(0))
    parts = F.split(c, pat, -1)
    rebuilt = F.concat(
        F.element_at(parts, 1),
        F.array_join(
            F.transform(
                matches,
                lambda m, i: F.concat(
                    F.lit(name + "_"), F.array_position(matches, m).cast("string"), F.element_at(parts, i + 2)
                ),
            ),
            "",
        ),
    )
    return F.when(c.rlike(r"(?i)<\s*" + tag), rebuilt).otherwise(c)


def placeholder_steps() -> list:
    """``<math>`` -> ``formula_n``, then ``<code>`` -> ``codice_n``."""
    return [lambda c, t=t, n=n: placeholder_numbering_one(c, t, n) for t, n in PLACEHOLDERS]


def guillemets(c) -> Column:
    """C14."""
    return F.replace(F.replace(col_of(c), F.lit("<<"), F.lit("«")), F.lit(">>"), F.lit("»"))


def squeeze_space(c) -> Column:
    """Tab -> space, runs of spaces -> one."""
    return F.regexp_replace(F.replace(col_of(c), F.lit("\t"), F.lit(" ")), " {2,}", " ")


def squeeze_dots(c) -> Column:
    """Four or more dots -> '...'."""
    return F.regexp_replace(col_of(c), r"\.{4,}", "...")


def punct_space(c, literal_compat: bool = False) -> Column:
    """C17: no space before , : . ) ] >> and none after [ ( <<.

    ``literal_compat`` reproduces the patterns as written in the reference,
    which only match the literal sequences ' ,:.)]>>' and '[(<< '.
    """
    c = col_of(c)
    if literal_compat:
        c = F.replace(c, F.lit(" ,:.)]»"), F.lit(",:.)]»"))
        return F.replace(c, F.lit("[(« "), F.lit("[(«"))
    c = F.regexp_replace(c, " ([,:.)\\]»])", "$1")
    return F.regexp_replace(c, "([\\[(«]) ", "$1")


def drop_punct_lines(c) -> Column:
    """Lines holding no letter, digit or underscore."""
    return F.regexp_replace(col_of(c), r"\n[^\p{L}\p{N}_]+?\n", "\n")


def fix_commas(c) -> Column:
    """C19: ',,' -> ',' then ',.' -> '.'."""
    return F.replace(F.replace(col_of(c), F.lit(",,"), F.lit(",")), F.lit(",."), F.lit("."))


def escape_doc(c) -> Column:
    """C20: escape & < > (ampersand first)."""
    c = F.replace(col_of(c), F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(c, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def apply_steps(df, col: str, steps: list):
    """Apply Column steps one projection at a time.

    Each step references its input more than once; a separate projection per
    step lets Catalyst keep the intermediate value instead of expanding the
    expression tree (it does not collapse projections that would duplicate
    non-trivial expressions).
    """
    for st in steps:
        df = df.withColumn(col, st(F.col(col)))
    return df


def clean_steps(
    keep_links: bool = False,
    html_mode: bool = False,
    escape: bool = False,
    literal_compat: bool = False,
    templates_expanded: bool = False,
    namespaces: list[str] | None = None,
) -> list:
    """C1-C20 + W6 in the reference's order (``clean``).

    With ``templates_expanded`` the caller has already replaced template
    calls (T3); otherwise remaining ``{{...}}`` are dropped (C1).
    """
    steps = []
    if not templates_expanded:
        steps.append(TEMPLATES_STEP)
    steps += [
        TABLES_STEP,
        lambda c: external_links(c, keep_links),
        lambda c: internal_links(c, keep_links, namespaces),
        behaviour_switches,
        syntaxhighlight_keep,
        lambda c: emphasis(c, html_mode),
        lambda c: drop_spans(c, keep_links),
    ]
    steps += drop_elements_steps()
    if not html_mode:
        steps.append(unescape_entities)
    steps += placeholder_steps()
    steps += [
        lambda c: fix_commas(drop_punct_lines(punct_space(squeeze_dots(squeeze_space(guillemets(c))), literal_compat)))
    ]
    if escape:
        steps.append(escape_doc)
    return steps


def clean_markup(df, col: str = "text", **flags):
    """DataFrame -> DataFrame: clean the markup of ``col`` in place."""
    return apply_steps(df, col, clean_steps(**flags))
