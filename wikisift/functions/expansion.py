"""Template expansion inside the row (T3) as one Column expression.

The text is rewritten in steps.  A step takes every innermost call or reference
and puts its value in its place: a magic word, the result of a registered parser
function (``functions/templates.py``), a parameter of the frame the text belongs to,
or a template's body.  Parts that a function may not choose are quoted
until it does, so they are not expanded.  A body stands between scope marks while
calls are left in it; then its pipes are dead, so the call around it is cut where it was written.

Frames (template, parameters, frame that called it) are an array of the state;
every opening run of a body carries the number of its frame.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wikisift.functions import braces as B
from wikisift.functions import templates as TF
from wikisift.functions.text import pystrip

#: Template calls inside each other, and steps of one pass over a row (a row that
#: needs more is passed over again).
MAX_FRAMES, STEPS = 30, 80

FRAME = "struct<parent:int,depth:int,title:string,params:map<string,string>>"
STATE = f"struct<text:string,frames:array<{FRAME}>,overruns:int,title_errors:int,missing:array<string>,done:boolean>"
KNOWN = "map<string,struct<target:string,body:string>>"

_SCOPE = f"{B.SCOPE_OPEN}[^{B.SCOPE_OPEN}{B.SCOPE_CLOSE}]*+{B.SCOPE_CLOSE}"
_RUNS = r"(\{\{+|" + f"{B.QUOTED_OPEN}{{2,}})"
_NO_PARAMS = "map<string,string>"


def prepared(body: Column) -> Column:
    """A template's body as the steps read it (once, in the catalog)."""
    return B.quote_later_parts(body)


def start(nodes: Column) -> Column:
    """The state before the first step; ``nodes``: of :func:`braces.outermost`."""
    page = F.struct(F.lit(-1).alias("parent"), F.lit(0).alias("depth"), F.lit("").alias("title"), F.create_map().cast(_NO_PARAMS).alias("params"))
    return F.struct(nodes.alias("text"), F.array(page).alias("frames"), F.lit(0).alias("overruns"), F.lit(0).alias("title_errors"),
                    F.array().cast("array<string>").alias("missing"), F.lit(False).alias("done")).cast(STATE)


def _opaque(text: Column) -> Column:
    return B.swap(text, ("|", B.DEAD_PIPE), ("{", B.SINGLE_OPEN), ("}", B.SINGLE_CLOSE))


def _close_scopes(text: Column) -> Column:
    """Scopes with no node left in them end; their text cuts nothing outside."""
    def closed(x):
        inner = F.substring(x, F.lit(2), F.length(x) - 2)
        return F.when(x.rlike(B.INNERMOST), x).otherwise(_opaque(inner))

    found = F.transform(F.regexp_extract_all(text, F.lit(_SCOPE), F.lit(0)), closed)
    return F.when(F.instr(text, B.SCOPE_OPEN) > 0, B.put(text, _SCOPE, found)).otherwise(text)


def _module_params(frames: Column, frame: Column, title: Column) -> Column:
    """The numbered parameters of the outermost frame of the template ``title``."""
    walk = F.aggregate(B.up_to(F.element_at(frames, frame + 1)["depth"]), F.struct(frame.alias("at"), F.create_map().cast(_NO_PARAMS).alias("params")),
                       lambda s, _: B.let(F.element_at(frames, s["at"] + 1), lambda f: F.struct(f["parent"].alias("at"), F.when(f["title"] == title, f["params"]).otherwise(s["params"]).alias("params"))))
    return B.let(walk["params"], lambda p: F.transform(B.up_to(F.size(p)), lambda k: F.coalesce(F.try_element_at(p, (k + 1).cast("string")), F.lit(""))))


def _function(name: Column, args: Column, frames: Column, frame: Column, namespaces: list[str]) -> Column:
    """The registered function's result for its parts (the first is expanded)."""
    module = pystrip(F.coalesce(F.get(args, F.lit(0)), F.lit("")))
    wanted = pystrip(F.coalesce(F.get(args, F.lit(1)), F.lit("")))

    def invoked(params):
        out = F.lit("")
        for (m, f), build in TF.MODULES.items():
            out = F.when((module == m) & (wanted == f), build(params)).otherwise(out)
        return out

    invoke = B.let(_module_params(frames, frame, TF.qualify_template_title(module, namespaces)), invoked)
    return F.when(name == "#invoke", invoke).otherwise(TF.call_function(name, args))


#: ``part``: the text is a quoted part that was chosen; ``scope``: it stands between marks.
_VALUE = f"struct<text:string,part:boolean,scope:boolean,frame:{FRAME},overruns:int,title_errors:int,missing:string>"


def _value(text, frame=None, overruns=0, title_errors=0, missing=None, part=False, scope=False) -> Column:
    return F.struct(text.alias("text"), F.lit(part).alias("part"), F.lit(scope).alias("scope"), (F.lit(None).cast(FRAME) if frame is None else frame).alias("frame"), F.lit(overruns).alias("overruns"),
                    F.lit(title_errors).alias("title_errors"), (F.lit(None).cast("string") if missing is None else missing).alias("missing")).cast(_VALUE)


def _read(node: Column, number: Column, st: Column, known: Column, magic: Column, namespaces: list[str]) -> Column:
    """The value of one innermost node; ``number``: of the frame that it may open."""
    def of(x):
        frame, parts = x["frame"], x["parts"]

        def reference(given):
            return (F.when(frame == 0, _value(F.lit(""))).when(given.isNotNull(), _value(given))
                    .otherwise(_value(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), part=True)))

        def call(t):
            title, bare = t["title"], t["bare"]
            word = F.try_element_at(magic, F.lower(bare))
            colon = F.instr(bare, ":")
            later = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
            args = F.concat(F.array(pystrip(F.substring(bare, colon + 1, F.length(bare)))), later)
            function = F.coalesce(_function(F.substring(bare, F.lit(1), colon - 1), args, st["frames"], frame, namespaces), F.lit(""))
            depth = F.element_at(st["frames"], frame + 1)["depth"] + 1

            def template(w):
                found = F.try_element_at(known, w)
                params = TF.call_params_map(F.transform(later, lambda p: B.swap(p, (B.DEAD_PIPE, "|"))))
                opened = F.struct(frame.alias("parent"), depth.alias("depth"), found["target"].alias("title"), params.alias("params"))
                noted = F.regexp_replace(found["body"], F.lit(_RUNS), F.concat(F.lit("$1" + B.NOTE_OPEN), number.cast("string"), F.lit(B.NOTE_CLOSE)))
                return (
                    F.when(w == "", _value(F.lit(""), title_errors=1))
                    .when(found.isNull(), _value(F.lit(""), missing=w))
                    .when(found["body"].isNull(), _value(F.lit("")))
                    .when(depth >= MAX_FRAMES, _value(F.lit(""), overruns=1))
                    .otherwise(_value(noted, frame=opened, scope=True))
                )

            return (
                F.when(word.isNotNull(), _value(_opaque(word)))
                .when(colon > 2, _value(function, part=True, scope=True))  # so a namespace before a title is an unknown function
                .otherwise(B.let(TF.qualify_template_title(bare, namespaces), template))
            )

        titles = B.let(pystrip(F.get(parts, F.lit(0))), lambda t: F.struct(t.alias("title"), TF.strip_subst(t).alias("bare")))
        return F.when(B.braces_of(node) == 3, B.let(F.try_element_at(F.element_at(st["frames"], frame + 1)["params"], pystrip(F.get(parts, F.lit(0)))), reference)).otherwise(B.let(titles, call))

    content = B.content_of(node)
    frame = F.coalesce(F.regexp_extract(content, f"^{B.NOTE}", 1).try_cast("int"), F.lit(0))
    return B.let(F.struct(frame.alias("frame"), F.split(F.regexp_replace(content, f"^{B.NOTE}", ""), r"\|", -1).alias("parts")), of)


def steps(state: Column, known: Column, magic: Column, namespaces: list[str], n: int = STEPS) -> Column:
    """``state`` after at most ``n`` steps; ``done`` when no node is left."""
    def step(st, _):
        def put_in(s):
            text, nodes = s["text"], s["nodes"]

            def shown(v):
                # a chosen part: its quotes are taken off, its own later parts quoted
                text = F.when(v["part"], B.unquoted(v["text"])).otherwise(v["text"])
                text = F.when(v["part"] & (F.instr(v["text"], B.QUOTED_OPEN) > 0), B.quote_later_parts(text)).when(v["part"] & v["scope"], _opaque(text)).otherwise(text)
                return F.when(v["scope"], F.concat(F.lit(B.SCOPE_OPEN), text, F.lit(B.SCOPE_CLOSE))).otherwise(text)

            def with_values(values):
                frames = F.transform(values, lambda v: F.coalesce(v["frame"], F.lit(None).cast(FRAME)))
                return F.struct(
                    B.hold_notes(text, F.transform(values, shown)).alias("text"), F.concat(st["frames"], frames).alias("frames"),
                    F.aggregate(values, st["overruns"], lambda a, v: a + v["overruns"]).alias("overruns"),
                    F.aggregate(values, st["title_errors"], lambda a, v: a + v["title_errors"]).alias("title_errors"),
                    F.concat(st["missing"], F.filter(values["missing"], lambda m: m.isNotNull())).alias("missing"), F.lit(False).alias("done")).cast(STATE)

            opened = F.size(st["frames"])
            values = F.transform(nodes, lambda x, i: _read(x, opened + i, st, known, magic, namespaces))
            over = F.struct(text.alias("text"), st["frames"].alias("frames"), st["overruns"].alias("overruns"), st["title_errors"].alias("title_errors"), st["missing"].alias("missing"),
                            (F.instr(text, B.SCOPE_OPEN) == 0).alias("done")).cast(STATE)
            return F.when(F.size(nodes) > 0, B.let(values, with_values)).otherwise(over)

        text = _close_scopes(B.hide_single(st["text"]))
        ready = B.let(text, lambda t: F.struct(t.alias("text"), F.regexp_extract_all(t, F.lit(B.INNERMOST), F.lit(0)).alias("nodes")))
        return F.when(st["done"], st).otherwise(B.let(ready, put_in))

    return F.aggregate(F.sequence(F.lit(1), F.lit(n)), state, step)
