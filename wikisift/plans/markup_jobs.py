"""Registered markup-cleaning jobs (C1-C20, W6, P5) over ``wikipages`` and
``pages.html``, each with a DuckDB oracle written from the rules directly
(unrolled innermost-first replacement instead of the Spark stack fold)."""

from __future__ import annotations

import html.entities

from pyspark.sql import functions as F

from wikisift.functions import markup as M
from wikisift.plans.catalog import register
from wikisift.plans.fixtures import sql_wikipages, wikipages
from wikisift.session import text_table

ROUNDS = 8  # oracle unroll depth (deeper than any nesting in the fixtures)

# ------------------------------------------------------------- oracle SQL --
SWITCH_RE = "|".join(M.SWITCHES)
PROTO = "(?:" + "|".join(M.URL_PROTOCOLS) + ")"
URLC = r"[^\]\[<>\"\x00-\x20\x7F\s]"
ANCH = r"[^\]\[\x00-\x08\x0a-\x1F]"
SQL_EXT_LINK = r"(?i)\[(" + PROTO + URLC + r"+)\s*(" + ANCH + r"*(?:\[\[" + ANCH + r"+\]\]" + ANCH + r"*)*)\]"
SQL_EXT_IMAGE = (
    r"(?i)\[(" + PROTO + URLC + r"+)\s*((?:http://|https://)" + URLC
    + r"+/[A-Za-z0-9_.,~%\-+&;#*?!=()@\x80-\xFF]+\.(?:gif|png|jpg|jpeg))\]"
)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_rr(expr: str, pat: str, rep: str) -> str:
    return f"regexp_replace({expr}, {q(pat)}, {q(rep)}, 'g')"


def sql_drop_nested(expr: str, open_re: str, close_re: str) -> str:
    e = f"regexp_replace({expr}, {q(open_re)}, chr(2) || '\\0' || chr(1), 'g')"
    e = f"regexp_replace({e}, {q(close_re)}, chr(1) || '\\0' || chr(3), 'g')"
    for _ in range(ROUNDS):
        e = f"regexp_replace({e}, '\\x02[^\\x02\\x03]*\\x03', '', 'g')"
    return f"replace(replace(replace({e}, chr(1), ''), chr(2), ''), chr(3), '')"


def sql_guard(expr: str, probe: str, inner: str) -> str:
    return f"CASE WHEN regexp_matches({expr}, {q(probe)}) THEN {inner} ELSE {expr} END"


def sql_internal_links(expr: str) -> str:
    e = f"replace(replace({expr}, '[[', chr(2)), ']]', chr(3))"
    e = sql_rr(e, "\x02(w|wiktionary|wikt):", "\x02\x04\\1:")
    e = sql_rr(e, "\x02:(w|wiktionary|wikt):", "\x02:\x04\\1:")
    for _ in range(ROUNDS):
        e = sql_rr(e, "\x02[^\x02\x03|:\x04][^\x02\x03|:]*:[^\x02\x03]*\x03", "")
        e = sql_rr(e, "\x02:[^\x02\x03|:\x04][^\x02\x03|:]*:[^\x02\x03]*\x03", "")
        e = sql_rr(e, "\x02[^\x02\x03|]*\\|\\s*([^\x02\x03]*?)\\s*\x03", "\\1")
        e = sql_rr(e, "\x02([^\x02\x03|]*)\x03", "\\1")
    return f"replace(replace(replace({e}, chr(2), '[['), chr(3), ']]'), chr(4), '')"


def sql_external_links(expr: str) -> str:
    return sql_rr(sql_rr(expr, SQL_EXT_IMAGE, ""), SQL_EXT_LINK, "\\2")


def sql_emphasis(expr: str) -> str:
    e = sql_rr(expr, "'''''(.*?)'''''", "\\1")
    e = sql_rr(e, "'''(.*?)'''", "\\1")
    e = sql_rr(e, "''\"([^\"]*?)\"''", '"\\1"')
    e = sql_rr(e, "''(.*?)''", '"\\1"')
    e = sql_rr(e, '""([^"]*?)""', '"\\1"')
    return f"replace(replace({e}, '''''''', ''), '''''', '\"')"


def sql_drop_spans(expr: str) -> str:
    ign = "|".join(M.IGNORED_TAGS + ["a"])
    sc = "|".join(M.SELF_CLOSING_TAGS)
    pat = (
        r"(?s:<!--.*?-->)|(?is:<\s*(?:" + sc + r")\b[^>]*/\s*>)|(?is:<(?:" + ign + r")\b.*?>)|(?i:</\s*(?:" + ign + r")>)"
    )
    return sql_rr(expr, pat, "")


def sql_drop_element(expr: str, tag: str) -> str:
    return sql_guard(
        expr,
        r"(?i)<\s*" + tag + r"\b",
        sql_drop_nested(expr, r"(?i)<\s*" + tag + r"\b[^>/]*>", r"(?i)<\s*/\s*" + tag + ">"),
    )


def sql_chain(base: str, key: str, fns: list, ctes: str = "") -> str:
    """Chain of CTEs, one per step, so no step repeats its input's SQL."""
    parts = [f"s0 AS ({base})"]
    for i, fn in enumerate(fns):
        parts.append(f"s{i + 1} AS (SELECT {key}, {fn('t')} AS t FROM s{i})")
    head = "WITH " + (ctes + ",\n" if ctes else "") + ",\n".join(parts)
    return f"{head}\nSELECT {key}, t AS text FROM s{len(fns)}"


def sql_entity_map() -> str:
    items = ", ".join(f"{q(k)}: {q(chr(v))}" for k, v in sorted(html.entities.name2codepoint.items()))
    return "MAP {" + items + "}"


def sql_unescape(expr: str) -> str:
    fix = (
        "CASE WHEN regexp_matches(x, '^&#[0-9]+;$') AND TRY_CAST(substr(x, 3, length(x) - 3) AS BIGINT) IS NOT NULL "
        "AND TRY_CAST(substr(x, 3, length(x) - 3) AS BIGINT) <= 1114111 "
        "AND NOT (TRY_CAST(substr(x, 3, length(x) - 3) AS BIGINT) BETWEEN 55296 AND 57343) "
        "THEN chr(CAST(substr(x, 3, length(x) - 3) AS INTEGER)) "
        "WHEN regexp_matches(x, '^&#x[0-9a-fA-F]+;$') AND TRY_CAST('0x' || substr(x, 4, length(x) - 4) AS BIGINT) IS NOT NULL "
        "AND TRY_CAST('0x' || substr(x, 4, length(x) - 4) AS BIGINT) <= 1114111 "
        "AND NOT (TRY_CAST('0x' || substr(x, 4, length(x) - 4) AS BIGINT) BETWEEN 55296 AND 57343) "
        "THEN chr(CAST(CAST('0x' || substr(x, 4, length(x) - 4) AS BIGINT) AS INTEGER)) "
        f"WHEN regexp_matches(x, '^&\\w+;$') THEN coalesce(({sql_entity_map()})[substr(x, 2, length(x) - 2)], x) "
        "ELSE x END"
    )
    return (
        f"CASE WHEN strpos({expr}, '&') > 0 THEN array_to_string(list_transform("
        f"regexp_extract_all({expr}, '&#?\\w+;|[^&]+|&'), lambda x: {fix}), '') ELSE {expr} END"
    )


def sql_placeholder(expr: str, tag: str, name: str) -> str:
    pat = r"(?is)<\s*" + tag + r"(?:\s*| [^>]+?)>.*?<\s*/\s*" + tag + r"\s*>"
    m = f"regexp_extract_all({expr}, {q(pat)})"
    p = f"regexp_split_to_array({expr}, {q(pat)})"
    body = (
        f"({p})[1] || array_to_string(list_transform({m}, lambda mm, i: '{name}_' || "
        f"list_position({m}, mm) || ({p})[i + 1]), '')"
    )
    return sql_guard(expr, r"(?i)<\s*" + tag, body)


def sql_tail_cleanup(expr: str) -> str:
    e = f"replace(replace({expr}, '<<', '«'), '>>', '»')"
    e = sql_rr(f"replace({e}, chr(9), ' ')", " {2,}", " ")
    e = sql_rr(e, r"\.{4,}", "...")
    e = sql_rr(e, " ([,:.)\\]»])", "\\1")
    e = sql_rr(e, "([\\[(«]) ", "\\1")
    return e


def sql_punct_lines(expr: str) -> str:
    return f"regexp_replace({expr}, chr(10) || '[^\\p{{L}}\\p{{N}}_]+?' || chr(10), chr(10), 'g')"


def sql_fix_commas(expr: str) -> str:
    return f"replace(replace({expr}, ',,', ','), ',.', '.')"


def sql_escape(expr: str) -> str:
    return f"replace(replace(replace({expr}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def wp_sql(body_expr: str) -> str:
    return f"WITH {sql_wikipages()} SELECT id, {body_expr} AS text FROM wikipages"


def pages_sql(body_expr: str) -> str:
    return f"SELECT page_id, {body_expr} AS text FROM (SELECT page_id, html AS t FROM pages)"


# ------------------------------------------------------------- Spark jobs --
def _wp(spark, sf_dir):
    return wikipages(spark, sf_dir).select("id", "text")


def _pages(spark, sf_dir):
    return text_table(spark, sf_dir, "pages", "page_id").select("page_id", F.col("html").alias("text"))


def _wp_job(key, step, sql_body):
    @register(key, wp_sql(sql_body))
    def job(spark, sf_dir):
        return M.apply_steps(_wp(spark, sf_dir), "text", step if isinstance(step, list) else [step])

    job.__name__ = f"q_{key}"
    return job


def _pages_job(key, step, sql_body):
    @register(key, pages_sql(sql_body))
    def job(spark, sf_dir):
        return M.apply_steps(_pages(spark, sf_dir), "text", step if isinstance(step, list) else [step])

    job.__name__ = f"q_{key}"
    return job


T = "text"
_wp_job("drop_templates", M.drop_templates, sql_guard(T, r"\{\{", sql_drop_nested(T, r"\{\{", r"\}\}")))
_wp_job("drop_tables", M.drop_tables, sql_guard(T, r"\{\|", sql_drop_nested(T, r"\{\|", r"\|\}")))
_wp_job("external_links", M.external_links, sql_guard(T, r"\[", sql_external_links(T)))
_wp_job("external_images", M.external_images, sql_rr(T, SQL_EXT_IMAGE, ""))
_wp_job("internal_links", M.internal_links, sql_guard(T, r"\[\[", sql_internal_links(T)))
_wp_job("behaviour_switches", M.behaviour_switches, sql_rr(T, SWITCH_RE, ""))
_wp_job(
    "syntaxhighlight_keep", M.syntaxhighlight_keep, sql_rr(T, r"(?s)<syntaxhighlight .*?>(.*?)</syntaxhighlight>", "\\1")
)
_wp_job("emphasis", M.emphasis, sql_emphasis(T))
_wp_job("placeholder_numbering", M.placeholder_steps(), sql_placeholder(sql_placeholder(T, "math", "formula"), "code", "codice"))
_wp_job("guillemets", M.guillemets, f"replace(replace({T}, '<<', '«'), '>>', '»')")
_wp_job("squeeze_space", M.squeeze_space, sql_rr(f"replace({T}, chr(9), ' ')", " {2,}", " "))
_wp_job("squeeze_dots", M.squeeze_dots, sql_rr(T, r"\.{4,}", "..."))
_wp_job("punct_space", M.punct_space, sql_rr(sql_rr(T, " ([,:.)\\]»])", "\\1"), "([\\[(«]) ", "\\1"))
_wp_job("fix_commas", M.fix_commas, sql_fix_commas(T))
_wp_job("escape_doc", M.escape_doc, sql_escape(T))

_pages_job("drop_comments", M.drop_comments, sql_rr("t", r"(?s)<!--.*?-->", ""))
_wp_job(
    "drop_selfclosing",
    M.drop_selfclosing,
    sql_rr(T, r"(?is)<\s*(?:" + "|".join(M.SELF_CLOSING_TAGS) + r")\b[^>]*/\s*>", ""),
)
_pages_job(
    "drop_ignored_tags",
    M.drop_ignored_tags,
    sql_rr(
        "t",
        r"(?is:<(?:" + "|".join(M.IGNORED_TAGS + ["a"]) + r")\b.*?>)|(?i:</\s*(?:" + "|".join(M.IGNORED_TAGS + ["a"]) + r")>)",
        "",
    ),
)


@register(
    "drop_elements",
    sql_chain("SELECT page_id, html AS t FROM pages", "page_id", [lambda e, t=t: sql_drop_element(e, t) for t in M.DISCARD_ELEMENTS]),
)
def q_drop_elements(spark, sf_dir):
    """C13 on real HTML pages."""
    return M.apply_steps(_pages(spark, sf_dir), "text", M.drop_elements_steps())
_pages_job("unescape_entities", M.unescape_entities, sql_unescape("t"))
_pages_job("drop_spans", lambda c: M.drop_spans(c), sql_drop_spans("t"))


_wp_job("drop_punct_lines", M.drop_punct_lines, sql_punct_lines(T))


@register(
    "link_namespace_filter",
    f"""WITH {sql_wikipages()},
links AS (SELECT id, unnest(regexp_extract_all(text, '\\[\\[([^\\[\\]|]*)', 1)) AS title FROM wikipages)
SELECT id, title,
  NOT ((strpos(title, ':') > 1 AND split_part(title, ':', 1) NOT IN ('w', 'wiktionary', 'wikt'))
    OR (strpos(title, ':') = 1 AND strpos(substr(title, 2), ':') > 1
        AND split_part(substr(title, 2), ':', 1) NOT IN ('w', 'wiktionary', 'wikt'))) AS survives
FROM links""",
)
def q_link_namespace_filter(spark, sf_dir):
    """P5: does each internal-link title survive the namespace rule."""
    links = _wp(spark, sf_dir).select(
        "id", F.explode(F.regexp_extract_all("text", F.lit(r"\[\[([^\[\]|]*)"), F.lit(1))).alias("title")
    )
    return links.select("id", "title", M.link_survives(F.col("title")).alias("survives"))
