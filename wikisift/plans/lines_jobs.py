"""Registered line-rendering jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from wikisift.functions import markup as M
from wikisift.operators import lines as L
from wikisift.plans import markup_jobs as MJ
from wikisift.plans.catalog import register
from wikisift.plans.fixtures import sql_wikipages, wikipages

# ------------------------------------------------------------- oracle SQL --
# Header test without back-references: try each '=' run length, longest first.
_LEVELS = range(8, 1, -1)
SQL_LEVEL = "CASE " + " ".join(
    f"WHEN regexp_matches(line, '^={{{n}}}.*={{{n}}}') THEN {n}" for n in _LEVELS
) + " ELSE 0 END"
SQL_TITLE = "CASE " + " ".join(
    f"WHEN regexp_matches(line, '^={{{n}}}.*={{{n}}}') THEN regexp_extract(line, '^={{{n}}}\\s*(.*?)\\s*={{{n}}}', 1)"
    for n in _LEVELS
) + " END"


def sql_dot(e: str) -> str:
    return f"CASE WHEN {e} <> '' AND NOT regexp_matches({e}, '[!?]$') THEN {e} || '.' ELSE {e} END"


def sql_lines_ctes(src: str = "wikipages", text: str = "text") -> str:
    return f"""lines AS (
  SELECT page_num, i AS pos, l[i + 1] AS line
  FROM (SELECT page_num, string_split({text}, chr(10)) AS l FROM {src}) d, unnest(range(len(d.l))) AS r(i)
  WHERE l[i + 1] <> ''
),
kinds AS (
  SELECT *, CASE WHEN ({SQL_LEVEL}) > 0 THEN 'header'
                 WHEN starts_with(line, '++') THEN 'title'
                 WHEN left(line, 1) = ':' THEN 'colon'
                 WHEN left(line, 1) IN ('*', '#', ';') THEN 'list'
                 ELSE 'other' END AS kind
  FROM lines
),
ann AS (
  SELECT *,
    coalesce(last_value(CASE WHEN kind IN ('header', 'list', 'other') THEN kind END IGNORE NULLS)
      OVER (PARTITION BY page_num ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) = 'list', false) AS after_list,
    sum(CASE WHEN kind = 'header' THEN 1 ELSE 0 END)
      OVER (PARTITION BY page_num ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section,
    kind = 'other' AND (left(line, 1) IN ('{{', '|') OR right(line, 1) = '}}'
      OR (left(line, 1) = '(' AND right(line, 1) = ')') OR regexp_matches(line, '^[.\\-]*$')) AS residue
  FROM kinds
),
ann2 AS (
  SELECT *, kind = 'other' AND NOT after_list AND NOT residue AS content FROM ann
),
ann3 AS (
  SELECT *, content AND section > 0 AND pos = min(CASE WHEN content THEN pos END)
      OVER (PARTITION BY page_num, section) AS first_content
  FROM ann2
),
kept AS (
  SELECT page_num, pos,
         CASE WHEN kind = 'title' THEN {sql_dot("substr(line, 3, greatest(length(line) - 4, 0))")} ELSE line END AS line
  FROM ann3
  WHERE (kind = 'title' AND substr(line, 3, greatest(length(line) - 4, 0)) <> '')
     OR (kind = 'other' AND after_list) OR first_content OR (content AND NOT starts_with(line, ' '))
)""".replace("'{{'", "'{'").replace("'}}'", "'}'")


WITH_LINES = f"WITH {sql_wikipages()},\n{sql_lines_ctes()}\n"


# ------------------------------------------------------------- Spark jobs --
def _lines(spark, sf_dir):
    return L.to_lines(wikipages(spark, sf_dir).select("page_num", "text"))


@register(
    "section_titles",
    WITH_LINES
    + f"SELECT page_num, pos, CAST(({SQL_LEVEL}) AS INTEGER) AS level, {sql_dot(SQL_TITLE)} AS title "
    + f"FROM lines WHERE ({SQL_LEVEL}) > 0",
)
def q_section_titles(spark, sf_dir):
    """Header lines with level and dotted title."""
    ln = _lines(spark, sf_dir)
    return ln.where(F.col("line").rlike(L.SECTION_RE)).select(
        "page_num", "pos", L.section_level("line").cast("int").alias("level"), L.section_title("line").alias("title")
    )


@register(
    "page_title_lines",
    WITH_LINES
    + f"SELECT page_num, pos, {sql_dot('substr(line, 3, greatest(length(line) - 4, 0))')} AS title "
    + "FROM kinds WHERE kind = 'title'",
)
def q_page_title_lines(spark, sf_dir):
    """R2: ``++title++`` lines."""
    ln = _lines(spark, sf_dir).withColumn("kind", L.line_kind("line"))
    return ln.where(F.col("kind") == "title").select("page_num", "pos", L.page_title_line("line").alias("title"))


@register("drop_residue_lines", WITH_LINES + "SELECT page_num, pos, line FROM ann WHERE kind = 'other' AND NOT residue")
def q_drop_residue_lines(spark, sf_dir):
    """Ordinary lines that are not table/list residue."""
    a = L.annotate_lines(_lines(spark, sf_dir))
    return a.where((F.col("kind") == "other") & ~F.col("residue")).select("page_num", "pos", "line")


@register("line_after_list", WITH_LINES + "SELECT page_num, pos, kind, after_list FROM ann")
def q_line_after_list(spark, sf_dir):
    """Does the previous structural line belong to a list."""
    return L.annotate_lines(_lines(spark, sf_dir)).select("page_num", "pos", "kind", "after_list")


@register(
    "section_first_line",
    WITH_LINES + "SELECT page_num, pos, CAST(section AS INTEGER) AS section, first_content FROM ann3",
)
def q_section_first_line(spark, sf_dir):
    """Running section number and first content line of each section."""
    a = L.annotate_lines(_lines(spark, sf_dir))
    return a.select("page_num", "pos", F.col("section").cast("int").alias("section"), "first_content")


@register(
    "drop_preformatted",
    WITH_LINES + "SELECT page_num, pos, line FROM ann3 WHERE content AND (first_content OR NOT starts_with(line, ' '))",
)
def q_drop_preformatted(spark, sf_dir):
    """Content lines kept by the preformatted rule."""
    a = L.annotate_lines(_lines(spark, sf_dir))
    return a.where(F.col("content") & (F.col("first_content") | ~F.startswith(F.col("line"), F.lit(" ")))).select(
        "page_num", "pos", "line"
    )


@register("clean_lines", WITH_LINES + "SELECT page_num, pos, line FROM kept")
def q_clean_lines(spark, sf_dir):
    """The whole default line pass, as windows over the lines table."""
    return L.render_lines(_lines(spark, sf_dir))


@register(
    "reassemble_page",
    WITH_LINES + "SELECT page_num, string_agg(line, chr(10) ORDER BY pos) AS text FROM kept GROUP BY page_num",
)
def q_reassemble_page(spark, sf_dir):
    """Kept lines back into page text."""
    return L.reassemble(L.render_lines(_lines(spark, sf_dir)))


@register(
    "compact_text",
    WITH_LINES + "SELECT page_num, string_agg(line, chr(10) ORDER BY pos) AS text FROM kept GROUP BY page_num",
)
def q_compact_text(spark, sf_dir):
    """R6 as a per-row fold (no shuffle); pages with no kept line omitted."""
    p = wikipages(spark, sf_dir).select("page_num", L.compact_text("text").alias("text"))
    return p.where(F.col("text") != "")


# Results of the fixture's header and list lines, worked out by hand.
@register(
    "pending_headers",
    f"""WITH {sql_wikipages()} SELECT page_num, pos, level, title FROM (SELECT page_num, id FROM wikipages) AS w,
(VALUES (2, 2, 'H1.'), (2, 3, 'H2.'), (6, 2, 'Last.')) AS v(pos, level, title) WHERE id % 8 = 5""",
)
def q_pending_headers(spark, sf_dir):
    """The section titles shown before the first kept line of a section."""
    p = L.pending_lines(_lines(spark, sf_dir))
    return p.select("page_num", "pos", F.inline("pending")).select("page_num", "pos", "level", "title")


@register(
    "list_items_text",
    f"""WITH {sql_wikipages()} SELECT page_num, pos, line FROM (SELECT page_num, id FROM wikipages) AS w,
(VALUES (0, '- one'), (1, '- two'), (2, '1. three')) AS v(pos, line) WHERE id % 8 = 6""",
)
def q_list_items_text(spark, sf_dir):
    """List items kept as text."""
    ln = _lines(spark, sf_dir).where((L.line_kind("line") == "list") & (L.list_body("line") != ""))
    return ln.select("page_num", "pos", L.list_item_text("line").alias("line"))


@register(
    "list_items_html",
    f"""WITH {sql_wikipages()} SELECT page_num, pos, sub, line FROM (SELECT page_num, id FROM wikipages) AS w,
(VALUES (0, 0, '<ul>'), (0, 1, '<li>one</li>'), (1, 0, '<ul>'), (1, 1, '<li>two</li>'), (2, 0, '</ul>'), (2, 1, '<ol>'), (2, 2, '</ul>'),
  (2, 3, '<li>three</li>')) AS v(pos, sub, line) WHERE id % 8 = 6""",
)
def q_list_items_html(spark, sf_dir):
    """What every list line of every page gives in HTML mode: level tags and items."""
    lines = _lines(spark, sf_dir)
    lists = lines.where(L.line_kind("line") == "list").select("page_num", "pos")
    return L.render_lines(lines, html=True).join(lists, ["page_num", "pos"], "left_semi")


@register(
    "headers_html",
    f"""WITH {sql_wikipages()} SELECT page_num, pos, line FROM (SELECT page_num, id FROM wikipages) AS w,
(VALUES (0, '<h2>H1</h2>'), (1, '<h3>H2</h3>'), (4, '<h2>Empty</h2>'), (5, '<h2>Last</h2>')) AS v(pos, line) WHERE id % 8 = 5""",
)
def q_headers_html(spark, sf_dir):
    """Header lines in HTML mode."""
    ln = _lines(spark, sf_dir).where(L.line_kind("line") == "header")
    return ln.select("page_num", "pos", L.header_html("line").alias("line"))


def _sql_all_html() -> str:
    """The default result with the rows that HTML mode adds: headers, list tags
    and items, and the tags that close a list behind the line that ends it."""
    return WITH_LINES + """, extra AS (
  SELECT page_num, pos, sub, line FROM (SELECT page_num, id FROM wikipages) AS w,
  (VALUES (5, 0, 0, '<h2>H1</h2>'), (5, 1, 0, '<h3>H2</h3>'), (5, 4, 0, '<h2>Empty</h2>'), (5, 5, 0, '<h2>Last</h2>'),
    (6, 0, 0, '<ul>'), (6, 0, 1, '<li>one</li>'), (6, 1, 0, '<ul>'), (6, 1, 1, '<li>two</li>'), (6, 2, 0, '</ul>'), (6, 2, 1, '<ol>'), (6, 2, 2, '</ul>'),
    (6, 2, 3, '<li>three</li>'), (6, 4, 1, '</ol>')) AS v(r, pos, sub, line)
  WHERE id % 8 = r
)
SELECT page_num, pos, 0 AS sub, line FROM kept UNION ALL SELECT * FROM extra"""


@register("clean_lines_html", _sql_all_html())
def q_clean_lines_html(spark, sf_dir):
    """R6 in HTML mode (R4, R5): every rendered line of every page."""
    return L.render_lines(_lines(spark, sf_dir), html=True)


def _sql_all_flags() -> str:
    """The default result with the lines that the flags add: section titles and
    list items; a section opened by an item keeps no further line."""
    return WITH_LINES + """, extra AS (
  SELECT page_num, pos, sub, line FROM (SELECT page_num, id FROM wikipages) AS w,
  (VALUES (5, 2, 0, 'H1.'), (5, 2, 1, 'H2.'), (5, 6, 0, 'Last.'), (6, 0, 0, '- one'), (6, 1, 0, '- two'), (6, 2, 0, '1. three')) AS v(r, pos, sub, line)
  WHERE id % 8 = r
)
SELECT page_num, string_agg(line, chr(10) ORDER BY pos, sub) AS text
FROM (SELECT page_num, pos, 9 AS sub, line FROM kept UNION ALL SELECT * FROM extra) GROUP BY page_num"""


@register("compact_sections_lists", _sql_all_flags())
def q_compact_sections_lists(spark, sf_dir):
    """R6 with section titles and list items kept."""
    return L.reassemble(L.render_lines(_lines(spark, sf_dir), sections=True, lists=True))


# ----------------------------------------------------- whole article (R7) --
def clean_article_frame(spark, sf_dir):
    from wikisift.operators.pages import filter_articles

    pages = filter_articles(wikipages(spark, sf_dir)).select("page_num", "id", "title", "text")
    cleaned = M.clean_markup(pages, "text")
    return cleaned.select("page_num", "id", "title", L.compact_text("text").alias("text"))


def sql_clean_chain() -> list:
    steps = [
        lambda e: MJ.sql_guard(e, r"\{\{", MJ.sql_drop_nested(e, r"\{\{", r"\}\}")),
        lambda e: MJ.sql_guard(e, r"\{\|", MJ.sql_drop_nested(e, r"\{\|", r"\|\}")),
        lambda e: MJ.sql_guard(e, r"\[", MJ.sql_external_links(e)),
        lambda e: MJ.sql_guard(e, r"\[\[", MJ.sql_internal_links(e)),
        lambda e: MJ.sql_rr(e, MJ.SWITCH_RE, ""),
        lambda e: MJ.sql_rr(e, r"(?s)<syntaxhighlight .*?>(.*?)</syntaxhighlight>", "\\1"),
        MJ.sql_emphasis,
        MJ.sql_drop_spans,
    ]
    steps += [lambda e, t=t: MJ.sql_drop_element(e, t) for t in M.DISCARD_ELEMENTS]
    steps += [MJ.sql_unescape]
    steps += [lambda e: MJ.sql_placeholder(e, "math", "formula"), lambda e: MJ.sql_placeholder(e, "code", "codice")]
    steps += [MJ.sql_tail_cleanup, MJ.sql_punct_lines, MJ.sql_fix_commas]
    return steps


def _clean_article_sql() -> str:
    base = "SELECT page_num, text AS t FROM wikipages WHERE ns NOT IN (10, 828)"
    chain = MJ.sql_chain(base, "page_num", sql_clean_chain(), ctes=sql_wikipages())
    # chain ends with SELECT page_num, t AS text FROM sN -> wrap as cleaned
    head, final = chain.rsplit("\nSELECT ", 1)
    return (
        head
        + ",\ncleaned AS (SELECT "
        + final
        + "),\n"
        + sql_lines_ctes("cleaned", "text")
        + """
SELECT w.page_num, w.id, w.title, coalesce(k.text, '') AS text
FROM wikipages w LEFT JOIN (SELECT page_num, string_agg(line, chr(10) ORDER BY pos) AS text FROM kept GROUP BY page_num) k
  ON w.page_num = k.page_num
WHERE w.ns NOT IN (10, 828)"""
    )


@register("clean_article", _clean_article_sql())
def q_clean_article(spark, sf_dir):
    """R7 without templates: cleaning (C1-C19, W6), then the line pass."""
    return clean_article_frame(spark, sf_dir)


@register("clean_article_full", _clean_article_sql())
def q_clean_article_full(spark, sf_dir):
    """R7, every step (the same job; C18 was once left out of the other)."""
    return clean_article_frame(spark, sf_dir)


def _clean_expanded_sql() -> str:
    """Default mode: the expanded texts go through the same cleaning."""
    from wikisift.plans.template_jobs import sql_expanded

    expanded = sql_expanded().removeprefix("WITH ")
    base = "SELECT e.page_num, e.text AS t FROM expanded e JOIN wikipages w ON e.page_num = w.page_num WHERE w.ns NOT IN (10, 828)"
    chain = MJ.sql_chain(base, "page_num", sql_clean_chain()[1:], ctes=expanded)
    head, final = chain.rsplit("\nSELECT ", 1)
    return (head + ",\ncleaned AS (SELECT " + final + "),\n" + sql_lines_ctes("cleaned", "text") + """
SELECT w.page_num, w.title, coalesce(k.text, '') AS text
FROM wikipages w LEFT JOIN (SELECT page_num, string_agg(line, chr(10) ORDER BY pos) AS text FROM kept GROUP BY page_num) k
  ON w.page_num = k.page_num
WHERE w.ns NOT IN (10, 828)""")


@register("clean_article_expanded", _clean_expanded_sql())
def q_clean_article_expanded(spark, sf_dir):
    """R7 in default mode: templates expanded (T3), cleaned, rendered."""
    from wikisift.operators.articles import clean_articles
    from wikisift.plans.template_jobs import KNOWN, expansion_inputs

    pages, catalog, redirects = expansion_inputs(spark, sf_dir)
    pages = pages.where("ns NOT IN (10, 828)").select("page_num", "title", "text")
    return clean_articles(pages, catalog, redirects, known_namespaces=KNOWN).select("page_num", "title", "text")
