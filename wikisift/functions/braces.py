"""Brace structure of wiki text (T1, T2) as Column expressions.

A text is read in rounds, innermost first: a round finds every ``{{...}}`` and
``{{{...}}}`` that holds no other, notes it and leaves a numbered placeholder in
its place, so the next round finds those around it.  A round is one ``split`` and one
``regexp_extract_all``, linear in the text; there are as many as the text nests.
Three and three braces make an argument reference, else two and two a call;
what is left over of a run pairs further out or is plain text.

Text that no node can hold is cut off first (:func:`core`), so the rounds read the nodes'
text only, not the page's.

The placeholders and masks are noncharacters, which interchanged text does not hold.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from wikisift.functions.text import col_of, pystrip

# Masks: single braces; a pipe that cuts nothing; braces and pipes of a part that is not read yet.
SINGLE_OPEN, SINGLE_CLOSE, DEAD_PIPE = "\ufdd2", "\ufdd3", "\ufdd4"
QUOTED_OPEN, QUOTED_CLOSE, QUOTED_PIPE = "\ufdd5", "\ufdd6", "\ufdd7"
# A note behind an opening run: its place in the text (T1) or its frame.
NOTE_OPEN, NOTE_CLOSE = "\ufdd8", "\ufdd9"
# The placeholder of a node; the bounds of a text that is put in by a call.
HOLD_OPEN, HOLD_CLOSE, SCOPE_OPEN, SCOPE_CLOSE = "\ufdda", "\ufddb", "\ufddc", "\ufddd"
# Between texts that are read as one.
BETWEEN = "\ufde3"
# The place of a stretch of text that stands outside all nodes.
EDGE = "\ufde4"
# Brackets and pipes of links while parts are cut.
LINK_OPEN, LINK_CLOSE, LINK_PIPE, ONE_OPEN, ONE_CLOSE = "\ufdde", "\ufddf", "\ufde0", "\ufde1", "\ufde2"

_FREE = "[^{}" + SCOPE_OPEN + SCOPE_CLOSE + "]*+"
INNERMOST = r"\{\{\{" + _FREE + r"\}\}\}|\{\{" + _FREE + r"\}\}"
REFERENCE = r"\{\{\{" + _FREE + r"\}\}\}"
_LINK = r"\[\[[^\[\]]*+\]\]"
_HOLD = HOLD_OPEN + "([0-9]+)" + HOLD_CLOSE
NOTE = NOTE_OPEN + "([0-9]+)" + NOTE_CLOSE
_CALL_OF_FUNCTION = rf"^(?:{NOTE})?\s*(?:(?i:subst:|safesubst:))?+[^:]{{2,}}:"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def up_to(n: Column) -> Column:
    """0, 1, ... n - 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def put(text: Column, pattern: str, values: Column) -> Column:
    """``text`` with its matches of ``pattern`` replaced by ``values``, one after the other."""
    pieces = F.split(text, pattern, -1)
    return F.array_join(F.zip_with(pieces, values, lambda p, v: F.concat(p, F.coalesce(v, F.lit("")))), "")


def swap(text: Column, *pairs: tuple[str, str]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def hide_single(text: Column) -> Column:
    """Braces that stand alone are text."""
    return F.regexp_replace(F.regexp_replace(text, r"(?<!\{)\{(?!\{)", SINGLE_OPEN), r"(?<!\})\}(?!\})", SINGLE_CLOSE)


#: Runs of braces up to which a text is cut (a text with more is read whole).
MOST_RUNS = 4096
_RUN = r"([{}])\1+"


def _cut(text: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of (pieces, runs, outside): the text between runs of two braces or more, the
    runs, and which pieces stand outside all nodes.

    ``open`` is the most nodes that may be open: a run opens at most half as many as it has braces,
    and closes at least one, and at least a third as many as it has braces, of those that are open.
    Nothing opens before the first piece or closes behind the last.
    """
    def walk(x):
        def after(st, run):
            opened = st["open"] + F.floor(F.length(run) / 2)
            left = F.greatest(F.lit(0), st["open"] - F.greatest(F.lit(1), F.floor(F.length(run) / 3)))
            return F.struct(F.when(F.startswith(run, F.lit("{")), opened).otherwise(left).cast("int").alias("open"), F.concat(st["outside"], F.array(st["open"] == 0)).alias("outside"))

        start = F.struct(F.lit(0).alias("open"), F.array().cast("array<boolean>").alias("outside"))
        walked = F.concat(F.aggregate(x["runs"], start, after)["outside"], F.array(F.lit(True)))
        outside = F.when(F.size(x["runs"]) <= MOST_RUNS, walked).otherwise(F.transform(x["pieces"], lambda _: F.lit(False)))
        return F.struct(x["pieces"].alias("pieces"), x["runs"].alias("runs"), outside.alias("outside"))

    read = F.struct(F.split(text, _RUN, -1).alias("pieces"), F.regexp_extract_all(text, F.lit(_RUN), F.lit(0)).alias("runs"))
    return let(let(read, walk), body)


def core(text: Column) -> Column:
    """The text with an ``EDGE`` for every stretch that stands outside all nodes."""
    def joined(x):
        held = F.zip_with(x["pieces"], x["outside"], lambda p, o: F.when(o, F.lit(EDGE)).otherwise(p))
        return F.array_join(F.zip_with(held, x["runs"], lambda p, r: F.concat(p, F.coalesce(r, F.lit("")))), "")

    return _cut(text, joined)


def around(text: Column, inner: Column) -> Column:
    """What became of ``core(text)``, with the stretches of ``text`` that it left out."""
    return put(inner, EDGE, _cut(text, lambda x: F.filter(x["pieces"], lambda _, i: F.element_at(x["outside"], i + 1))))


def hide_links(text: Column) -> Column:
    """Pipes inside links masked, innermost links first."""
    def one_round(t, _):
        found = F.transform(F.regexp_extract_all(t, F.lit(_LINK), F.lit(0)), lambda x: swap(x, ("|", LINK_PIPE), ("[", LINK_OPEN), ("]", LINK_CLOSE)))
        return F.when(t.rlike(_LINK), put(t, _LINK, found)).otherwise(t)

    alone = F.regexp_replace(F.regexp_replace(text, r"(?<!\[)\[(?!\[)", ONE_OPEN), r"(?<!\])\](?!\])", ONE_CLOSE)
    rounds = F.aggregate(up_to(F.regexp_count(text, F.lit(r"\[\["))), alone, one_round)
    shown = swap(rounds, (LINK_OPEN, "["), (LINK_CLOSE, "]"), (ONE_OPEN, "["), (ONE_CLOSE, "]"))
    return F.when(F.instr(text, "[[") > 0, shown).otherwise(text)


def split_parts(content: Column) -> Column:
    """The parts of a call (its inner nodes are placeholders): cut at pipes outside
    links; the links' pipes stay ``LINK_PIPE``."""
    return F.split(hide_links(content), r"\|", -1)


def fill(text: Column, values: Column) -> Column:
    """Placeholders replaced by the values of their numbers."""
    own = F.transform(F.regexp_extract_all(text, F.lit(_HOLD), F.lit(1)), lambda k: F.element_at(values, k.cast("int") + 1))
    return F.when(F.instr(text, HOLD_OPEN) > 0, put(text, _HOLD, own)).otherwise(text)


def braces_of(node: Column) -> Column:
    """Braces on one side of a node: 3 (reference) or 2 (call)."""
    return F.when(F.startswith(node, F.lit("{{{")), 3).otherwise(2)


def content_of(node: Column) -> Column:
    k = braces_of(node)
    return F.substring(node, k + 1, F.length(node) - 2 * k)


def hold_notes(text: Column, values: Column) -> Column:
    """:func:`put` for nodes; a note moves before the placeholder where braces of its
    run are left, as they belong to a node further out."""
    nodes = F.regexp_extract_all(text, F.lit(INNERMOST), F.lit(0))
    pieces = F.split(text, INNERMOST, -1)
    notes = F.transform(nodes, lambda x: F.regexp_extract(x, r"^\{+(" + NOTE_OPEN + "[0-9]+" + NOTE_CLOSE + ")", 1))
    kept = F.zip_with(F.zip_with(pieces, notes, lambda p, n: F.when(F.endswith(p, F.lit("{")), F.coalesce(n, F.lit(""))).otherwise(F.lit(""))), values, lambda n, v: F.concat(n, F.coalesce(v, F.lit(""))))
    return F.array_join(F.zip_with(pieces, kept, lambda p, v: F.concat(p, v)), "")


def in_rounds(text: Column, fields: dict[str, tuple[str, Callable]]) -> Column:
    """Read ``text``: a struct of ``text`` (placeholders left) and one array a field.

    ``fields``: name -> (type, function of (node, state, round)); the functions see
    the arrays of the rounds before.
    """
    empty = F.struct(hide_single(text).alias("text"), F.lit(False).alias("done"), *(F.array().cast(f"array<{t}>").alias(f) for f, (t, _) in fields.items()))
    first = next(iter(fields))

    def one_round(st, k):
        def read(nodes):
            base = F.size(st[first])
            holds = F.transform(up_to(F.size(nodes)), lambda i: F.concat(F.lit(HOLD_OPEN), (base + i).cast("string"), F.lit(HOLD_CLOSE)))
            def more(f, fn):
                return F.concat(st[f], F.transform(nodes, lambda x: fn(x, st, k))).alias(f)

            after = F.struct(hide_single(hold_notes(st["text"], holds)).alias("text"), F.lit(False).alias("done"), *(more(f, fn) for f, (_, fn) in fields.items()))
            over = F.struct(st["text"].alias("text"), F.lit(True).alias("done"), *(st[f].alias(f) for f in fields))
            return F.when(F.size(nodes) > 0, after).otherwise(over)

        return F.when(st["done"], st).otherwise(let(F.regexp_extract_all(st["text"], F.lit(INNERMOST), F.lit(0)), read))

    return F.aggregate(up_to(F.regexp_count(text, F.lit(r"\{\{"))), empty, one_round)


def read_once(text: Column, fields: dict[str, tuple[str, Callable]]) -> Column:
    """:func:`in_rounds` of a text that takes work to make, made once."""
    return let(text, lambda t: in_rounds(t, fields))


def show(text: Column) -> Column:
    """All masks taken off."""
    plain = swap(text, (SINGLE_OPEN, "{"), (SINGLE_CLOSE, "}"), (DEAD_PIPE, "|"), (QUOTED_OPEN, "{"), (QUOTED_CLOSE, "}"), (QUOTED_PIPE, "|"), (LINK_PIPE, "|"), (SCOPE_OPEN, ""), (SCOPE_CLOSE, ""))
    return F.regexp_replace(plain, NOTE, "")


def calls_of(text) -> Column:
    """T1 in the row: every call of a text, as (at, round, calls, parts).

    ``at`` numbers the opening runs, ``round`` how far out a node lies, ``calls`` how
    many calls it holds, itself included.
    """
    def noted(t):
        run = r"\{\{+"
        runs = F.regexp_extract_all(t, F.lit(run), F.lit(0))
        return put(t, run, F.transform(runs, lambda r, i: F.concat(r, F.lit(NOTE_OPEN), i.cast("string"), F.lit(NOTE_CLOSE))))

    def calls(x, st, _):
        inner = F.transform(F.regexp_extract_all(x, F.lit(_HOLD), F.lit(1)), lambda k: F.element_at(st["calls"], k.cast("int") + 1))
        return F.aggregate(inner, F.when(braces_of(x) == 2, 1).otherwise(0), lambda a, b: a + b)

    def parts(x, st, _):
        own = F.transform(split_parts(F.regexp_replace(content_of(x), f"^{NOTE}", "")), lambda p: show(fill(p, st["raw"])))
        return F.when(braces_of(x) == 2, own)

    read = read_once(let(core(col_of(text)), noted), {
        "raw": ("string", lambda x, st, _: fill(x, st["raw"])),
        "at": ("int", lambda x, st, _: F.regexp_extract(x, r"^\{+" + NOTE, 1).cast("int")),
        "round": ("int", lambda x, st, k: k),
        "calls": ("int", calls),
        "parts": ("array<string>", parts),
    })
    zipped = let(read, lambda st: F.arrays_zip(st["at"].alias("at"), st["round"].alias("round"), st["calls"].alias("calls"), st["parts"].alias("parts")))
    return F.filter(zipped, lambda n: n["parts"].isNotNull())


def quoted(text: Column) -> Column:
    return swap(text, ("{", QUOTED_OPEN), ("}", QUOTED_CLOSE), ("|", QUOTED_PIPE), (SINGLE_OPEN, QUOTED_OPEN), (SINGLE_CLOSE, QUOTED_CLOSE), (LINK_PIPE, QUOTED_PIPE))


def unquoted(text: Column) -> Column:
    return swap(text, (QUOTED_OPEN, "{"), (QUOTED_CLOSE, "}"), (QUOTED_PIPE, "|"))


def _read_quoted(text: Column) -> Column:
    """A text's outermost nodes with their later parts quoted: a struct of the ``text``
    with placeholders and the nodes (``ready``) of all rounds."""
    def ready(x, st, _):
        def build(parts):
            later = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: quoted(fill(p, st["raw"])))
            lazy = F.array_join(F.concat(F.array(fill(F.element_at(parts, 1), st["ready"])), later), "|")
            eager = F.array_join(F.transform(parts, lambda p: fill(p, st["ready"])), "|")
            return F.when((braces_of(x) == 3) | F.element_at(parts, 1).rlike(_CALL_OF_FUNCTION), lazy).otherwise(eager)

        side = braces_of(x)
        body = let(split_parts(content_of(x)), build)
        return swap(F.concat(F.repeat(F.lit("{"), side), body, F.repeat(F.lit("}"), side)), (LINK_PIPE, DEAD_PIPE))

    return read_once(text, {"raw": ("string", lambda x, st, _: fill(x, st["raw"])), "ready": ("string", ready)})


def quote_later_parts(text: Column) -> Column:
    """The text with the parts quoted that are read only when they are chosen: all but
    the first of parser function calls and argument references.  Links' pipes are dead."""
    return F.when(F.instr(text, "{{") > 0, let(_read_quoted(text), lambda st: fill(st["text"], st["ready"]))).otherwise(text)


def outermost(text: Column) -> Column:
    """(frame, nodes): the text with placeholders, and its outermost nodes, later parts
    quoted, as one text (``BETWEEN`` stands between them)."""
    def cut(st):
        own = F.transform(F.regexp_extract_all(st["text"], F.lit(_HOLD), F.lit(1)), lambda k: F.element_at(st["ready"], k.cast("int") + 1))
        return F.struct(st["text"].alias("frame"), F.array_join(own, BETWEEN).alias("nodes"))

    return let(_read_quoted(text), cut)


def put_back(frame: Column, nodes: Column) -> Column:
    """The text of :func:`outermost` with what became of its nodes."""
    return show(put(frame, _HOLD, F.split(nodes, BETWEEN, -1)))


def fill_references(body: Column, params: Column) -> Column:
    """Argument references replaced, innermost first: by the parameter, else by
    the default (whose calls stay calls), else by nothing."""
    def value(x):
        parts = F.split(content_of(x), r"\|", -1)
        return F.coalesce(F.try_element_at(params, pystrip(F.get(parts, F.lit(0)))), unquoted(F.get(parts, F.lit(1))), F.lit(""))

    def one_round(t, _):
        found = F.regexp_extract_all(t, F.lit(REFERENCE), F.lit(0))
        return F.when(t.rlike(REFERENCE), hide_single(put(t, REFERENCE, F.transform(found, value)))).otherwise(t)

    rounds = F.aggregate(up_to(F.regexp_count(body, F.lit(r"\{\{\{"))), quote_later_parts(body), one_round)
    return F.when(F.instr(body, "{{{") > 0, show(rounds)).otherwise(body)
