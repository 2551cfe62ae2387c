"""Registered template jobs.

``call_args`` is derived from ``documents``: every paragraph of the whole
text becomes an argument, rewritten by position so that the branches of the
parser functions are exercised (empty tests, ``case=value`` pairs, bare
cases, ``#default``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wikisift.functions import templates as TF
from wikisift.functions.text import lcfirst, ucfirst
from wikisift.operators import templates as OT
from wikisift.plans.catalog import register
from wikisift.plans.fixtures import EXPANDED_PREFIX, MARKUP_PREFIXES, _sql_str, case_pages, case_templates, sql_case, sql_templates, sql_wikipages, templates, wikipages
from wikisift.session import text_table

KNOWN = ["Template", "Category"]
WPT = f"WITH {sql_wikipages()},\n{sql_templates()}\n"


def call_args(spark, sf_dir):
    d = text_table(spark, sf_dir, "documents", "doc_id")
    paras = F.split("text", "\n")
    first_word = lambda p: F.split(p, " ")[0]

    first = first_word(F.element_at(paras, 1))

    def rule(p, i):
        k = i % 5
        return (
            F.when((i == 0) & (F.col("doc_id") % 7 == 1), F.lit('<span class="error">x</span>'))
            .when((i == 0) & (F.col("doc_id") % 11 == 3), F.concat(F.lit(" -00"), F.col("doc_id").cast("string"), F.lit("000000000000000000000 ")))
            .when((i == 0) & (F.col("doc_id") % 3 == 0), F.lit(""))
            .when(i == 0, first_word(p))
            .when((i == 1) & (F.col("doc_id") % 5 == 2), F.concat(F.lit(" "), first, F.lit(" ")))
            .when(k == 1, F.concat(first_word(p), F.lit("="), p))
            .when((k == 2) & (F.col("doc_id") % 2 == 0), first)
            .when(k == 4, F.concat(F.lit("#default="), p))
            .otherwise(p)
        )

    return d.select("doc_id", F.transform(paras, rule).alias("args"))


SQL_CALL_ARGS = """call_args AS (
  SELECT doc_id, list_transform(string_split(text, chr(10)), lambda p, i:
    CASE WHEN i = 1 AND doc_id % 7 = 1 THEN '<span class="error">x</span>'
         WHEN i = 1 AND doc_id % 11 = 3 THEN ' -00' || doc_id || '000000000000000000000 '
         WHEN i = 1 AND doc_id % 3 = 0 THEN ''
         WHEN i = 1 THEN split_part(p, ' ', 1)
         WHEN i = 2 AND doc_id % 5 = 2 THEN ' ' || split_part(split_part(text, chr(10), 1), ' ', 1) || ' '
         WHEN (i - 1) % 5 = 1 THEN split_part(p, ' ', 1) || '=' || p
         WHEN (i - 1) % 5 = 2 AND doc_id % 2 = 0 THEN split_part(split_part(text, chr(10), 1), ' ', 1)
         WHEN (i - 1) % 5 = 4 THEN '#default=' || p
         ELSE p END) AS args
  FROM documents
)"""
WCA = f"WITH {SQL_CALL_ARGS}\n"
STRIP = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"


def st(e: str) -> str:
    return STRIP.format(e)


def _pf_job(key, fn, sql_expr=None):
    sql = (WCA + f"SELECT doc_id, {sql_expr} AS value FROM call_args") if sql_expr else None

    @register(key, sql)
    def job(spark, sf_dir):
        return call_args(spark, sf_dir).select("doc_id", fn(F.col("args")).alias("value"))

    job.__name__ = f"q_{key}"
    return job


ARG1 = "coalesce(args[1], '')"
# A character whose other case would be longer stays; of the corpus' letters that
# is sharp s alone.
UPPER = "replace(upper(replace({}, 'ß', chr(1))), chr(1), 'ß')"
PF_SQL = {
    "#if": f"""CASE WHEN {st(ARG1)} <> '' THEN coalesce({st('args[2]')}, '')
         WHEN coalesce(args[3], '') <> '' THEN {st('args[3]')} ELSE '' END""",
    "#ifeq": f"""CASE WHEN len(args) < 3 THEN '' WHEN {st('args[2]')} = '' THEN ''
         WHEN {st('args[1]')} = {st('args[2]')} THEN CASE WHEN coalesce(args[3], '') <> '' THEN {st('args[3]')} ELSE '' END
         WHEN coalesce(args[4], '') <> '' THEN {st('args[4]')} ELSE '' END""",
    "#iferror": f"""CASE WHEN starts_with({ARG1}, '<span class="error"') THEN coalesce(args[2], '')
         WHEN len(args) < 3 THEN {st(ARG1)} ELSE {st('args[3]')} END""",
    "#switch": f"""coalesce(
         list_transform(list_filter(range(2, len(args) + 1), lambda i: contains(args[i], '=') AND (
             list_contains(list_transform(string_split(split_part(args[i], '=', 1), '|'), lambda v: {st('v')}), {st('args[1]')})
             OR len(list_filter(args[2:i - 1], lambda q: NOT contains(q, '=') AND {st('q')} = {st('args[1]')})) > 0)),
           lambda i: {st("substr(args[i], strpos(args[i], '=') + 1)")})[1],
         list_transform(list_filter(args[2:], lambda q: contains(q, '=') AND {st("split_part(q, '=', 1)")} = '#default'),
           lambda q: {st("substr(q, strpos(q, '=') + 1)")})[-1], '')""",
    "lc": f"lower({ARG1})",
    "uc": UPPER.format(ARG1),
    "lcfirst": f"lower(left({ARG1}, 1)) || substr({ARG1}, 2)",
    "ucfirst": UPPER.format(f"left({ARG1}, 1)") + f" || substr({ARG1}, 2)",
    "urlencode": f"replace(replace(url_encode({ARG1}), '%2F', '/'), '~', '%7E')",
    "int": f"""CASE WHEN regexp_matches({st(ARG1)}, '^[+-]?[0-9]+$') THEN
         CASE WHEN starts_with({st(ARG1)}, '-') AND ltrim({st(ARG1)}, '+-0') <> '' THEN '-' ELSE '' END
         || CASE WHEN ltrim({st(ARG1)}, '+-0') = '' THEN '0' ELSE ltrim({st(ARG1)}, '+-0') END ELSE '' END""",
}
_pf_job("pf_if", TF.pf_if, PF_SQL["#if"])
_pf_job("pf_ifeq", TF.pf_ifeq, PF_SQL["#ifeq"])
_pf_job("pf_iferror", TF.pf_iferror, PF_SQL["#iferror"])
_pf_job("pf_switch", TF.pf_switch, PF_SQL["#switch"])
_pf_job(
    "pf_case",
    lambda a: F.concat_ws("|", TF.pf_case("lc", a), TF.pf_case("uc", a), TF.pf_case("lcfirst", a), TF.pf_case("ucfirst", a)),
    f"concat_ws('|', {PF_SQL['lc']}, {PF_SQL['uc']}, {PF_SQL['lcfirst']}, {PF_SQL['ucfirst']})",
)
_pf_job("pf_urlencode", TF.pf_urlencode, PF_SQL["urlencode"])
_pf_job("pf_int", TF.pf_int, PF_SQL["int"])
_pf_job(
    "pf_invoke_convert",
    TF.pf_invoke_convert,
    "CASE WHEN len(args) >= 2 THEN args[1] || ' ' || args[2] ELSE '' END",
)
_pf_job(
    "pf_invoke_if_empty",
    TF.pf_invoke_if_empty,
    "coalesce(list_filter(args, lambda x: x <> '')[1], '')",
)
PF_NAMES = ["#if", "#ifeq", "#iferror", "#switch", "lc", "uc", "urlencode", "int", "#time", "nosuch"]


@register(
    "pf_dispatch",
    WCA + "SELECT doc_id, " + "CASE doc_id % 10 " + " ".join(f"WHEN {k} THEN '{n}'" for k, n in enumerate(PF_NAMES)) + " END AS name, "
    + "CASE doc_id % 10 " + " ".join(f"WHEN {k} THEN {PF_SQL.get(n, repr(''))}" for k, n in enumerate(PF_NAMES)) + " END AS value FROM call_args",
)
def q_pf_dispatch(spark, sf_dir):
    """the function name comes from the document's language and id."""
    names = F.array(*[F.lit(n) for n in PF_NAMES])
    ca = call_args(spark, sf_dir).withColumn("name", F.element_at(names, (F.col("doc_id") % 10 + 1).cast("int")))
    return ca.select("doc_id", "name", TF.pf_dispatch(F.col("name"), F.col("args")).alias("value"))


# ------------------------------------------------------------ titles etc. --
@register(
    "ucfirst",
    "SELECT doc_id, upper(left(text, 1)) || substr(text, 2) AS up, lower(left(text, 1)) || substr(text, 2) AS low FROM documents",
)
def q_ucfirst(spark, sf_dir):
    """Ucfirst / lcfirst of each whole text."""
    return text_table(spark, sf_dir, "documents", "doc_id").select("doc_id", ucfirst("text").alias("up"), lcfirst("text").alias("low"))


@register(
    "normalize_title",
    "WITH " + sql_wikipages() + r""", t AS (
  SELECT id, regexp_replace(regexp_replace('  ' || lower(title) || '__', '^[ _]+|[ _]+$', '', 'g'), '[\s_]+', ' ', 'g') AS t FROM wikipages)
SELECT id, CASE WHEN regexp_matches(t, '^([^:]*):(\s*)(\S.*)$') THEN
  CASE WHEN upper(left(regexp_extract(t, '^([^:]*):', 1), 1)) || substr(regexp_extract(t, '^([^:]*):', 1), 2) IN ('Template', 'Category')
       THEN upper(left(regexp_extract(t, '^([^:]*):', 1), 1)) || substr(regexp_extract(t, '^([^:]*):', 1), 2) || ':'
            || upper(left(regexp_extract(t, '^([^:]*):(\s*)(\S.*)$', 3), 1)) || substr(regexp_extract(t, '^([^:]*):(\s*)(\S.*)$', 3), 2)
       ELSE upper(left(regexp_extract(t, '^([^:]*):', 1), 1)) || substr(regexp_extract(t, '^([^:]*):', 1), 2) || ':'
            || CASE WHEN regexp_extract(t, '^([^:]*):(\s*)', 2) <> '' THEN ' ' ELSE '' END
            || upper(left(regexp_extract(t, '^([^:]*):(\s*)(\S.*)$', 3), 1)) || substr(regexp_extract(t, '^([^:]*):(\s*)(\S.*)$', 3), 2) END
  ELSE upper(left(t, 1)) || substr(t, 2) END AS title
FROM t""",
)
def q_normalize_title(spark, sf_dir):
    """N1 over lower-cased, padded page titles."""
    w = wikipages(spark, sf_dir).select("id", F.concat(F.lit("  "), F.lower("title"), F.lit("__")).alias("raw"))
    return w.select("id", TF.normalize_title(F.col("raw"), KNOWN).alias("title"))


@register(
    "template_body",
    WPT + r"""SELECT page_num, CASE WHEN b1 LIKE '%<onlyinclude>%' AND
  array_to_string(regexp_extract_all(b1, '(?s)<onlyinclude>(.*?)</onlyinclude>', 1), '') <> ''
  THEN array_to_string(regexp_extract_all(b1, '(?s)<onlyinclude>(.*?)</onlyinclude>', 1), '')
  ELSE regexp_replace(b1, '</?includeonly>', '', 'g') END AS body
FROM (SELECT page_num, regexp_replace(regexp_replace(regexp_replace(regexp_replace(body, '(?s)<!--.*?-->', '', 'g'),
  '(?s)<noinclude>.*?</noinclude>', '', 'g'), '(?s)<noinclude\s*>.*$', '', 'g'), '<noinclude/>', '', 'g') AS b1 FROM templates)""",
)
def q_template_body(spark, sf_dir):
    """N4 (+A5)."""
    return templates(spark, sf_dir).select("page_num", TF.template_body("body").alias("body"))


@register(
    "onlyinclude_concat",
    WPT + r"SELECT page_num, array_to_string(regexp_extract_all(body, '(?s)<onlyinclude>(.*?)</onlyinclude>', 1), '') AS only FROM templates",
)
def q_onlyinclude_concat(spark, sf_dir):
    """A5."""
    return templates(spark, sf_dir).select("page_num", TF.onlyinclude_concat("body").alias("only"))


def catalog(spark, sf_dir):
    return OT.template_catalog(templates(spark, sf_dir))


@register(
    "template_catalog",
    WPT + r"""SELECT title, arg_max(body, page_num) AS body, count(*) AS definitions FROM (
  SELECT page_num, title, CASE WHEN array_to_string(regexp_extract_all(b1, '(?s)<onlyinclude>(.*?)</onlyinclude>', 1), '') <> ''
    THEN array_to_string(regexp_extract_all(b1, '(?s)<onlyinclude>(.*?)</onlyinclude>', 1), '')
    ELSE regexp_replace(b1, '</?includeonly>', '', 'g') END AS body
  FROM (SELECT page_num, title, regexp_replace(regexp_replace(regexp_replace(regexp_replace(body, '(?s)<!--.*?-->', '', 'g'),
    '(?s)<noinclude>.*?</noinclude>', '', 'g'), '(?s)<noinclude\s*>.*$', '', 'g'), '<noinclude/>', '', 'g') AS b1 FROM templates))
WHERE body <> '' GROUP BY title""",
)
def q_template_catalog(spark, sf_dir):
    """A4: later definition wins, redefinitions counted."""
    return catalog(spark, sf_dir)


def redirect_pages(spark, sf_dir):
    """Redirect pages: '#REDIRECT [[target]]' text for pages with a redirect."""
    w = wikipages(spark, sf_dir).where(F.col("redirect").isNotNull())
    return w.select("title", F.concat(F.lit("#REDIRECT [["), F.col("redirect"), F.lit("]]\n"), F.col("text")).alias("text"))


@register(
    "redirect_target",
    "WITH " + sql_wikipages() + r" SELECT title, regexp_extract('#REDIRECT [[' || redirect || ']]' || chr(10) || text, "
    r"'(?i)^#REDIRECT[^\n]*?\[\[([^\]\n]*)\]\]', 1) AS target FROM wikipages WHERE redirect IS NOT NULL",
)
def q_redirect_target(spark, sf_dir):
    """N5."""
    return OT.redirects_of(redirect_pages(spark, sf_dir))


def calls(spark, sf_dir):
    return OT.template_calls(wikipages(spark, sf_dir).select("page_num", "text"))


# The calls of the markup prefix that holds some, in order of their opening.
SQL_CALLS = """,
calls AS (
  SELECT page_num, pos, depth, title, inner_text FROM (SELECT page_num, id FROM wikipages) AS w, (VALUES
    (0, 0, 'T10', 'T10|a|k=v'), (1, 0, 'T0', 'T0|{{T20}}|k=v'), (2, 1, 'T20', 'T20'), (3, 0, 'gone', 'gone'),
    (4, 0, 'Template:T10', 'Template:T10|1'), (5, 0, 'subst:T20', 'subst:T20')) AS v(pos, depth, title, inner_text)
  WHERE id % 8 = 3
)"""


@register("template_calls", WPT + SQL_CALLS + " SELECT page_num, pos, depth, title, inner_text FROM calls")
def q_template_calls(spark, sf_dir):
    """Call edges at every depth, with their parts."""
    return calls(spark, sf_dir).select("page_num", "pos", "depth", "title", F.array_join("parts", "|").alias("inner_text"))


def qualified_calls(spark, sf_dir):
    c = calls(spark, sf_dir)
    return c.withColumn("qtitle", TF.qualify_template_title(TF.strip_subst("title"), KNOWN))


SQL_Q = r"""CASE WHEN starts_with(title, ':') THEN upper(substr(title, 2, 1)) || substr(title, 3)
  WHEN strpos(title, ':') > 0 AND upper(left(split_part(title, ':', 1), 1)) || substr(split_part(title, ':', 1), 2) IN ('Template', 'Category')
  THEN upper(left(split_part(title, ':', 1), 1)) || substr(split_part(title, ':', 1), 2) || substr(title, strpos(title, ':'))
  WHEN title <> '' THEN 'Template:' || upper(left(title, 1)) || substr(title, 2) ELSE '' END"""


@register("qualify_template_title", WPT + SQL_CALLS + f" SELECT page_num, pos, {SQL_Q} AS qtitle FROM (SELECT * REPLACE (regexp_replace(title, '^subst:', '') AS title) FROM calls)")
def q_qualify_template_title(spark, sf_dir):
    """N3."""
    return qualified_calls(spark, sf_dir).select("page_num", "pos", "qtitle")


@register(
    "subst_calls",
    WPT + SQL_CALLS + " SELECT page_num, pos, regexp_replace(title, '^subst:', '') AS title, starts_with(title, 'subst:') AS subst FROM calls",
)
def q_subst_calls(spark, sf_dir):
    """T4: subst: prefixes removed and marked."""
    c = calls(spark, sf_dir)
    return c.select("page_num", "pos", TF.strip_subst("title").alias("title"), TF.is_subst("title").alias("subst"))


SQL_CAT = r""",
catalog AS (
  SELECT title, arg_max(body, page_num) AS body FROM (
    SELECT page_num, title, CASE WHEN array_to_string(regexp_extract_all(b1, '(?s)<onlyinclude>(.*?)</onlyinclude>', 1), '') <> ''
      THEN array_to_string(regexp_extract_all(b1, '(?s)<onlyinclude>(.*?)</onlyinclude>', 1), '')
      ELSE regexp_replace(b1, '</?includeonly>', '', 'g') END AS body
    FROM (SELECT page_num, title, regexp_replace(regexp_replace(regexp_replace(regexp_replace(body, '(?s)<!--.*?-->', '', 'g'),
      '(?s)<noinclude>.*?</noinclude>', '', 'g'), '(?s)<noinclude\s*>.*$', '', 'g'), '<noinclude/>', '', 'g') AS b1 FROM templates))
  WHERE body <> '' GROUP BY title
),
qcalls AS (SELECT page_num, pos, """ + SQL_Q + """ AS qtitle FROM (SELECT * REPLACE (regexp_replace(title, '^subst:', '') AS title) FROM calls))"""


@register(
    "template_lookup",
    WPT + SQL_CALLS + SQL_CAT + " SELECT q.page_num, q.pos, q.qtitle, coalesce(c.body, '') AS body FROM qcalls q LEFT JOIN catalog c ON q.qtitle = c.title",
)
def q_template_lookup(spark, sf_dir):
    """Call title -> body, unknown -> ''."""
    return OT.lookup_templates(qualified_calls(spark, sf_dir), catalog(spark, sf_dir)).select("page_num", "pos", "qtitle", "body")


@register(
    "unresolved_templates",
    WPT + SQL_CALLS + SQL_CAT + " SELECT page_num, pos, qtitle FROM qcalls q WHERE NOT EXISTS (SELECT 1 FROM catalog c WHERE c.title = q.qtitle)",
)
def q_unresolved_templates(spark, sf_dir):
    """Calls with no definition."""
    return OT.unresolved_templates(qualified_calls(spark, sf_dir), catalog(spark, sf_dir)).select("page_num", "pos", "qtitle")


@register(
    "redirect_resolve",
    WPT + SQL_CALLS + SQL_CAT + """,
redirects AS (SELECT DISTINCT title, 'Template:T' || ((CAST(substr(title, 11) AS BIGINT) + 10) % 30) AS target FROM templates)
SELECT q.page_num, q.pos, coalesce(r.target, q.qtitle) AS qtitle FROM qcalls q LEFT JOIN redirects r ON q.qtitle = r.title""",
)
def q_redirect_resolve(spark, sf_dir):
    """One redirect hop before the catalog lookup; every template title
    T<n> redirects to T<(n+10) % 30>."""
    t = templates(spark, sf_dir).select("title").distinct()
    n = F.substring("title", 11, 1 << 30).cast("bigint")
    red = t.select("title", F.concat(F.lit("Template:T"), ((n + 10) % 30).cast("string")).alias("target"))
    return OT.resolve_redirects(qualified_calls(spark, sf_dir), red).select("page_num", "pos", "qtitle")


@register(
    "known_namespace_match",
    WPT + SQL_CALLS + """ SELECT page_num, pos, title FROM calls
WHERE strpos(title, ':') > 0 AND upper(left(split_part(title, ':', 1), 1)) || substr(split_part(title, ':', 1), 2) IN ('Template', 'Category')""",
)
def q_known_namespace_match(spark, sf_dir):
    """Semi-join of title prefixes with the known namespaces."""
    ns = spark.createDataFrame([(n,) for n in KNOWN], "name string")
    c = calls(spark, sf_dir).select("page_num", "pos", "title")
    return OT.known_namespace_match(c, ns)


@register(
    "call_params_map",
    WPT + SQL_CALLS + """ SELECT page_num, pos, CASE pos WHEN 0 THEN '1=a|k=v' WHEN 1 THEN '1={{T20}}|k=v' WHEN 4 THEN '1=1' ELSE '' END AS params FROM calls""",
)
def q_call_params_map(spark, sf_dir):
    """The whole parameter map of each call."""
    m = TF.call_params_map(F.slice("parts", 2, F.greatest(F.size("parts") - 1, F.lit(0))))
    pairs = F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return calls(spark, sf_dir).select("page_num", "pos", F.array_join(pairs, "|").alias("params"))


@register(
    "template_args",
    WPT + SQL_CALLS + """ SELECT page_num, pos, CASE pos WHEN 0 THEN 'AB' WHEN 1 THEN 'v2 Hi  v' WHEN 2 THEN 'QS' WHEN 3 THEN ''
  WHEN 4 THEN 'AB' ELSE 'QS' END AS body FROM calls""",
)
def q_template_args(spark, sf_dir):
    """Catalog bodies filled in with the call's parameters."""
    q = OT.lookup_templates(qualified_calls(spark, sf_dir), catalog(spark, sf_dir)).withColumn("page_title", F.lit(""))
    return OT.template_args(q, KNOWN).select("page_num", "pos", "body")


@register(
    "magic_word_values",
    "WITH " + sql_wikipages() + """ SELECT id, '|;' || title || ';' || title || ';2000;01;02;03;03:04:05;none' AS value FROM wikipages""",
)
def q_magic_word_values(spark, sf_dir):
    """P10: every magic word for every page (fixed as_of)."""
    as_of = F.lit("2000-01-02 03:04:05").cast("timestamp")
    words = ["!", "PAGENAME", "FullPageName", "CurrentYear", "currentmonth", "CURRENTDAY", "currenthour", "currenttime", "nosuchword"]
    values = [F.coalesce(TF.magic_words(F.lit(w), F.col("title"), as_of), F.lit("none")) for w in words]
    return wikipages(spark, sf_dir).select("id", F.concat_ws(";", *values).alias("value"))


def expansion_inputs(spark, sf_dir):
    """(pages, catalog, redirects) of the expansion jobs."""
    t = templates(spark, sf_dir).unionByName(case_templates(spark))
    return case_pages(spark, sf_dir), OT.template_catalog(t), OT.redirects_of(t.withColumnRenamed("body", "text"))


def expanded(spark, sf_dir):
    pages, catalog, redirects = expansion_inputs(spark, sf_dir)
    return OT.expand_templates(pages, catalog, redirects, KNOWN)


def sql_expanded() -> str:
    prefixes = [EXPANDED_PREFIX if "{{" in p else p for p in MARKUP_PREFIXES]
    prefix = "CASE id % 8 " + " ".join(f"WHEN {k} THEN {_sql_str(p)}" for k, p in enumerate(prefixes)) + " END"
    body = "substr(text, length(" + "CASE id % 8 " + " ".join(f"WHEN {k} THEN {_sql_str(p)}" for k, p in enumerate(MARKUP_PREFIXES)) + " END) + 1)"
    return (f"WITH {sql_wikipages()}, expanded AS (SELECT page_num, {prefix} || {body} || chr(10) || replace({sql_case(1)}, '<T>', title) AS text, "
            f"{sql_case(2)} AS overruns, {sql_case(3)} AS title_errors FROM wikipages)")


@register("expand_templates", sql_expanded() + " SELECT page_num, text, CAST(overruns AS INTEGER) AS overruns, CAST(title_errors AS INTEGER) AS title_errors FROM expanded")
def q_expand_templates(spark, sf_dir):
    """T3 over every page: nested and looping calls, defaults, redirects, modules."""
    return expanded(spark, sf_dir).select("page_num", "text", "overruns", "title_errors")


@register("template_error_counts", sql_expanded() + " SELECT page_num, CAST(overruns AS BIGINT) AS overruns, CAST(title_errors AS BIGINT) AS title_errors FROM expanded WHERE overruns > 0 OR title_errors > 0")
def q_template_error_counts(spark, sf_dir):
    """Pages with calls beyond the depth limit or without a title."""
    return OT.template_error_counts(expanded(spark, sf_dir))
