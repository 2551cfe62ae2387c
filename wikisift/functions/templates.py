"""Template text rules as Column expressions (N1, N3-N5, T1, T2, T4, A5, A6,
F1-F10, P10).

Call arguments are ``array<string>`` columns and parameters are
``map<string,string>`` columns, so every rule is a per-row expression over
Spark's array / map / higher-order functions.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column
from pyspark.sql import functions as F

from wikisift.functions.markup import drop_comments, unescape_entities
from wikisift.functions.text import col_of, lcfirst, lower_each, pystrip, ucfirst, upper_each

SUBST_RE = r"(?i)^(?:subst:|safesubst:)"

# ---------------------------------------------------------------- titles --
def normalize_namespace(prefix) -> Column:
    """A namespace's first letter is upper case, the rest as it stands."""
    return ucfirst(col_of(prefix))


def normalize_title(title, known_namespaces: list[str]) -> Column:
    """Trim blanks/underscores, squeeze, upper-case first letter,
    namespace aware ('Category:  Births' -> 'Category:Births')."""
    t = F.regexp_replace(col_of(title), r"^[ _]+|[ _]+$", "")
    t = F.regexp_replace(t, r"[\s_]+", " ")
    m = r"^([^:]*):(\s*)(\S.*)$"
    has = t.rlike("(?s)" + m)
    prefix = F.regexp_extract(t, "(?s)" + m, 1)
    ws = F.regexp_extract(t, "(?s)" + m, 2)
    rest = F.regexp_extract(t, "(?s)" + m, 3)
    ns = normalize_namespace(prefix)
    known = F.array(*[F.lit(x) for x in known_namespaces]) if known_namespaces else F.array().cast("array<string>")
    in_ns = F.concat(ns, F.lit(":"), ucfirst(rest))
    not_ns = F.concat(ucfirst(prefix), F.lit(":"), F.when(ws != "", F.lit(" ")).otherwise(F.lit("")), ucfirst(rest))
    return F.when(has & F.array_contains(known, ns), in_ns).when(has, not_ns).otherwise(ucfirst(t))


def qualify_template_title(title, known_namespaces: list[str], template_prefix: str = "Template:") -> Column:
    """Namespace of a transcluded title."""
    t = col_of(title)
    known = F.array(*[F.lit(x) for x in known_namespaces]) if known_namespaces else F.array().cast("array<string>")
    colon = F.instr(t, ":")
    prefix = normalize_namespace(F.substring_index(t, ":", 1))
    rest = F.substring(t, colon, 1 << 30)
    return (
        F.when(F.startswith(t, F.lit(":")), ucfirst(F.substring(t, 2, 1 << 30)))
        .when((colon > 0) & F.array_contains(known, prefix), F.concat(prefix, ucfirst(rest)))
        .when(t != "", F.concat(F.lit(template_prefix), ucfirst(t)))
        .otherwise(F.lit(""))
    )


def template_body(text) -> Column:
    """N4 (+A5): a template page's text prepared for transclusion."""
    t = unescape_entities(col_of(text))
    t = drop_comments(t)
    t = F.regexp_replace(t, r"(?s)<noinclude>.*?</noinclude>", "")
    t = F.regexp_replace(t, r"(?s)<noinclude\s*>.*$", "")
    t = F.regexp_replace(t, r"<noinclude/>", "")
    only = onlyinclude_concat(t)
    return F.when(only != "", only).otherwise(F.regexp_replace(t, r"</?includeonly>", ""))


def onlyinclude_concat(text) -> Column:
    """A5: concatenation of the ``<onlyinclude>`` parts ('' when none)."""
    return F.array_join(F.regexp_extract_all(col_of(text), F.lit(r"(?s)<onlyinclude>(.*?)</onlyinclude>"), F.lit(1)), "")


def redirect_target(text) -> Column:
    """``#REDIRECT [[target]]`` -> target ('' when not a redirect)."""
    first = F.substring_index(col_of(text), "\n", 1)
    return F.regexp_extract(first, r"(?i)^#REDIRECT.*?\[\[([^\]]*)\]\]", 1)


def strip_subst(title) -> Column:
    """T4: remove a leading subst:/safesubst:."""
    return F.regexp_replace(col_of(title), SUBST_RE, "")


def is_subst(title) -> Column:
    return col_of(title).rlike(SUBST_RE)


# ------------------------------------------------------------ parameters --
def call_params_map(params) -> Column:
    """Parameter list -> map.  ``name=value`` (name without spaces or '=')
    is named; others are numbered from 1; values are trimmed unless they
    hold ']]'; a later key wins (mapKeyDedupPolicy=LAST_WIN)."""
    p = col_of(params)
    named_re = r"(?s)^ *([^= ]*?) *=(.*)$"

    def entry(x, i):
        is_named = x.rlike(named_re)
        # number of unnamed parameters up to and including position i
        unnamed_before = F.size(F.filter(F.slice(p, 1, i + 1), lambda y: ~y.rlike(named_re)))
        key = F.when(is_named, pystrip(F.regexp_extract(x, named_re, 1))).otherwise(unnamed_before.cast("string"))
        raw = F.when(is_named, F.regexp_extract(x, named_re, 2)).otherwise(x)
        val = F.when(F.instr(raw, "]]") > 0, raw).otherwise(pystrip(raw))
        return F.struct(key.alias("key"), val.alias("value"))

    return F.when(
        F.size(p) > 0, F.map_from_entries(F.transform(p, entry))
    ).otherwise(F.create_map().cast("map<string,string>"))


# --------------------------------------------------------- parser functions --
def _arg(args: Column, i: int) -> Column:
    """1-based argument, null when absent."""
    return F.try_element_at(args, F.lit(i))


def pf_if(args) -> Column:
    """#if."""
    a = col_of(args)
    test, yes, no = _arg(a, 1), _arg(a, 2), _arg(a, 3)
    return (
        F.when(pystrip(F.coalesce(test, F.lit(""))) != "", F.coalesce(pystrip(yes), F.lit("")))
        .when(F.coalesce(no, F.lit("")) != "", pystrip(no))
        .otherwise(F.lit(""))
    )


def pf_ifeq(args) -> Column:
    """#ifeq (an empty right side always gives '')."""
    a = col_of(args)
    lv, rv, yes, no = _arg(a, 1), pystrip(_arg(a, 2)), _arg(a, 3), _arg(a, 4)
    eq = pystrip(lv) == rv
    return (
        F.when(F.size(a) < 3, F.lit(""))
        .when(rv == "", F.lit(""))
        .when(eq, F.when(F.coalesce(yes, F.lit("")) != "", pystrip(yes)).otherwise(F.lit("")))
        .when(F.coalesce(no, F.lit("")) != "", pystrip(no))
        .otherwise(F.lit(""))
    )


# Fixed value: the pattern of an error mark.
IFERROR_RE = r'^<(?:strong|span|p|div)\s(?:[^\s>]*\s+)*?class="(?:[^"\s>]*\s+)*?error(?:\s[^">]*)?"'


def pf_iferror(args) -> Column:
    """#iferror."""
    a = col_of(args)
    test, then, els = _arg(a, 1), _arg(a, 2), _arg(a, 3)
    return (
        F.when(F.size(a) < 1, F.lit(""))
        .when(test.rlike(IFERROR_RE), F.coalesce(then, F.lit("")))
        .when(els.isNull(), pystrip(test))
        .otherwise(pystrip(els))
    )


def pf_switch(args) -> Column:
    """#switch: first ``case=value`` whose case list holds the primary,
    or the value after a bare case equal to the primary; else the last
    ``#default=value``; else ''."""
    a = col_of(args)
    primary = pystrip(_arg(a, 1))
    cases = F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0)))
    has_eq = lambda p: F.instr(p, "=") > 0
    lval = lambda p: pystrip(F.substring_index(p, "=", 1))
    rval = lambda p: pystrip(F.substring(p, F.instr(p, "=") + 1, 1 << 30))
    idx = F.sequence(F.lit(1), F.greatest(F.size(cases), F.lit(1)))

    def hit(i):
        p = F.element_at(cases, i)
        alts = F.transform(F.split(lval(p), r"\|", -1), lambda v: pystrip(v))
        bare_before = F.exists(
            F.slice(cases, 1, i - 1), lambda q: ~has_eq(q) & (pystrip(q) == primary)
        )
        return has_eq(p) & (F.array_contains(alts, primary) | bare_before)

    hits = F.filter(idx, lambda i: (F.size(cases) > 0) & hit(i))
    first = F.try_element_at(hits, F.lit(1))
    defaults = F.filter(cases, lambda p: has_eq(p) & (lval(p) == "#default"))
    last_default = F.try_element_at(defaults, F.lit(-1))
    return (
        F.when(F.size(a) < 1, F.lit(""))
        .when(first.isNotNull(), rval(F.element_at(cases, first)))
        .when(last_default.isNotNull(), rval(last_default))
        .otherwise(F.lit(""))
    )


def pf_case(name: str, args) -> Column:
    """lc, uc, lcfirst, ucfirst of the first argument."""
    s = F.coalesce(_arg(col_of(args), 1), F.lit(""))
    return {"lc": lower_each(s), "uc": upper_each(s), "lcfirst": lcfirst(s), "ucfirst": ucfirst(s)}[name]


def pf_urlencode(args) -> Column:
    """percent-encode UTF-8, '/' kept, space as %20."""
    s = F.coalesce(_arg(col_of(args), 1), F.lit(""))
    e = F.url_encode(s)
    return F.replace(F.replace(F.replace(e, F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/")), F.lit("*"), F.lit("%2A"))


def pf_int(args) -> Column:
    """integer text of any size; failure gives ''."""
    s = pystrip(F.coalesce(_arg(col_of(args), 1), F.lit("")))
    digits = F.regexp_replace(s, r"^[+-]?0*(?=[0-9])", "")
    minus = F.when(F.startswith(s, F.lit("-")) & (digits != "0"), F.lit("-")).otherwise(F.lit(""))
    return F.when(s.rlike(r"^[+-]?[0-9]+$"), F.concat(minus, digits)).otherwise(F.lit(""))


def pf_invoke_convert(args) -> Column:
    """F8: module convert: ``x + ' ' + unit`` (no conversion)."""
    a = col_of(args)
    return F.when(F.size(a) >= 2, F.concat(_arg(a, 1), F.lit(" "), _arg(a, 2))).otherwise(F.lit(""))


def pf_invoke_if_empty(args) -> Column:
    """first non-empty argument, else ''."""
    return F.coalesce(F.try_element_at(F.filter(col_of(args), lambda x: x != ""), F.lit(1)), F.lit(""))


Builder = Callable[[Column], Column]
#: Parser functions by name and module functions by (module, function): what
#: ``pf_dispatch`` and the expansion (T3) call.  Each takes the argument array.
FUNCTIONS: dict[str, Builder] = {
    "#if": pf_if, "#ifeq": pf_ifeq, "#iferror": pf_iferror, "#switch": pf_switch, "urlencode": pf_urlencode, "int": pf_int,
    **{n: partial(pf_case, n) for n in ("lc", "uc", "lcfirst", "ucfirst")},
}
MODULES: dict[tuple[str, str], Builder] = {("convert", "convert"): pf_invoke_convert, ("If empty", "main"): pf_invoke_if_empty}


def register_function(name: str, build: Builder) -> None:
    """Make ``build`` (argument array -> text) the parser function ``name``."""
    FUNCTIONS[name] = build


def register_module(module: str, function: str, build: Builder) -> None:
    """Make ``build`` (numbered parameters of the module's template -> text) what
    ``{{#invoke:module|function}}`` gives."""
    MODULES[(module, function)] = build


def call_function(name: Column, args: Column) -> Column:
    """The result of the registered function ``name``; an unknown one gives ''."""
    out = F.lit("")
    for known, build in FUNCTIONS.items():
        out = F.when(name == known, build(args)).otherwise(out)
    return out


def pf_dispatch(name, args) -> Column:
    """name -> parser function; unsupported and unknown names give ''.  A
    module's name is ``#invoke:module``."""
    n, a = col_of(name), col_of(args)
    out = call_function(n, a)
    for (module, _), build in MODULES.items():
        out = F.when(n == f"#invoke:{module}", build(a)).otherwise(out)
    return out


# ------------------------------------------------------------ magic words --
def magic_words(title: Column, page_title: Column, as_of: Column) -> Column:
    """P10: value of a magic word (null when the name is none).  ``as_of``
    replaces the wall clock so results repeat."""
    n = F.lower(pystrip(title))
    return (
        F.when(n == "!", F.lit("|"))
        .when(n.isin("pagename", "fullpagename"), page_title)
        .when(n == "currentyear", F.date_format(as_of, "yyyy"))
        .when(n == "currentmonth", F.date_format(as_of, "MM"))
        .when(n == "currentday", F.date_format(as_of, "dd"))
        .when(n == "currenthour", F.date_format(as_of, "HH"))
        .when(n == "currenttime", F.date_format(as_of, "HH:mm:ss"))
    )
