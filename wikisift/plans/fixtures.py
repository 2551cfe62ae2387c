"""Derived inputs built from the driver tables by fixed rules.

``documents`` carries no wiki markup, so the wiki jobs read ``wikipages``: one
row per document (whole text, never a prefix) with a markup prefix chosen by
``doc_id % 8``, plus page metadata derived from ``doc_id``.  The same rules
are written a second time, independently, as SQL for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wikisift.session import table, text_table

# The markup prefixes of the fixture, by doc_id % 8.
MARKUP_PREFIXES = [
    "'''Bold''' and ''it'' and '''''both'''''",
    "[[Page 3|label]]s [[Plain]] [[File:x.png|thumb|cap [[Page 4]]]]",
    "[http://a.example/b the label] [http://a.example] [http://a.example http://b.example/i.png]",
    "{{T10|a|k=v}} x {{T0|{{T20}}|k=v}} {{gone}} {{Template:T10|1}} {{subst:T20}}",
    "{| a {| b |} c |} __NOTOC__",
    "== H1 ==\n=== H2 ===\n pre line\ntext\n== Empty ==\n== Last ==\nx\n++Top++",
    "* one\n** two\n# three\n: indent\nafter list\n(paren)\n---\n|cell",
    "<!-- c --><ref>r</ref><math>x</math><code>y</code><math>x</math><br/>a....b &amp;nbsp; <<q>>  two , three\t( four ) five,,six,. <br /> <ref name=\"z\"/> <syntaxhighlight lang=\"x\">kept</syntaxhighlight>",
]

# Template bodies of the fixture, by doc_id % 30 (ns 10 rows).
TEMPLATE_BODIES = {
    0: "Hi {{{1|x}}} {{{k|}}}",
    10: "<noinclude>doc</noinclude>A<includeonly>B</includeonly>",
    20: "p<onlyinclude>Q</onlyinclude>r<onlyinclude>S</onlyinclude>",
}


# Further templates, a redirect and one call text per rule of the
# expansion, with the result worked out by hand ("<T>" is the page's title), the
# calls beyond the depth limit and the calls without a title.
CASE_TEMPLATES = {
    "D": "X{{{1|{{PAGENAME}}}}}Y",
    "I": "i({{{1}}},{{{2|none}}})",
    "N": "n[{{I|{{{1}}}|{{D}}}}]",
    "Loop": "l{{Loop}}",
    "Convert": "{{#invoke:convert|convert}}",
    "Name": "{{{a{{{1|}}}|no}}}",
    "Old": "#REDIRECT [[Template:I]]",
}
CALL_CASES = [
    ("{{D}} {{D|z}}", "X<T>Y XzY", 0, 0),
    ("{{I|a{{!}}b}}", "i(a|b,none)", 0, 0),
    ("{{I|a{b}c}} {{{x|y}}}{a}", "i(a{b}c,none) {a}", 0, 0),
    ("{{N|q}}", "n[i(q,X<T>Y)]", 0, 0),
    ("{{#if: {{D}} | yes{{I|1|2}} | no}}{{#if:|a| b }}", "yesi(1,2)b", 0, 0),
    ("{{Loop}}", "l" * 29, 1, 0),
    ("{{Convert|5|km}}{{#invoke:convert|nofunc|5|km}}", "5 km", 0, 0),
    ("{{Old|r}}", "i(r,none)", 0, 0),
    ("{{gone}}{{ }}-", "-", 0, 1),
    ("{{#switch: b | a = 1 | b | c = 3 | #default = d}}{{#ifeq: a | a | t | f}}{{lc:ABC}}{{ucfirst:x}}{{int: 007 }}", "3tabcX7", 0, 0),
    ("{{subst:I|{{PAGENAME}}}}", "i(<T>,none)", 0, 0),
    ("{{Name|x|ax=v}}{{Name|y}}{{I|[[p|q]]|b}}", "vnoi([[p|q]],b)", 0, 0),
]
EXPANDED_PREFIX = "AB x v2 Hi QS v   QS"  # of the markup prefix that holds calls


def case_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """wikipages with the document's call case as a last line."""
    cases = F.array(*[F.lit(c[0]) for c in CALL_CASES])
    case = F.element_at(cases, (F.col("id") % len(CALL_CASES) + 1).cast("int"))
    return wikipages(spark, sf_dir).select("page_num", "id", "title", "ns", F.concat("text", F.lit("\n"), case).alias("text"))


def case_templates(spark: SparkSession) -> DataFrame:
    rows = [(-k, -k, f"Template:{t}", b) for k, (t, b) in enumerate(CASE_TEMPLATES.items(), 1)]
    return spark.createDataFrame(rows, "page_num long, id long, title string, body string")


def sql_case(column: int) -> str:
    """A CASE over doc ids (column ``id``) with a column of ``CALL_CASES``."""
    show = lambda v: _sql_str(v) if isinstance(v, str) else str(v)
    return f"CASE id % {len(CALL_CASES)} " + " ".join(f"WHEN {k} THEN {show(c[column])}" for k, c in enumerate(CALL_CASES)) + " END"


def wikipages(spark: SparkSession, sf_dir: str, with_duplicates: bool = False) -> DataFrame:
    d = text_table(spark, sf_dir, "documents", "doc_id").select("doc_id", "text")
    ns = F.when(F.col("doc_id") % 10 == 0, 10).when(F.col("doc_id") % 10 == 1, 14).otherwise(0)
    prefix = F.element_at(F.array(*[F.lit(p) for p in MARKUP_PREFIXES]), (F.col("doc_id") % 8 + 1).cast("int"))
    pages = d.select(
        (F.col("doc_id") * 2).alias("page_num"),
        F.col("doc_id").alias("id"),
        F.when(ns == 10, F.concat(F.lit("Template:T"), F.col("doc_id").cast("string")))
        .otherwise(F.concat(F.lit("Page "), F.col("doc_id").cast("string")))
        .alias("title"),
        ns.cast("int").alias("ns"),
        F.when((F.col("doc_id") % 17 == 0) & (ns == 0), F.concat(F.lit("Page "), (F.col("doc_id") + 1).cast("string")))
        .alias("redirect"),
        F.concat(prefix, F.lit("\n"), F.col("text")).alias("text"),
    )
    if with_duplicates:
        dup = pages.where(F.col("id") % 7 == 0).withColumn("page_num", F.col("page_num") + 1)
        pages = pages.unionByName(dup)
    return pages


def templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ns-10 pages with a body by doc_id % 30; a redefinition (larger
    page_num) for every title with doc_id % 20 == 0."""
    p = wikipages(spark, sf_dir).where(F.col("ns") == 10)
    body = F.element_at(
        F.create_map(*[x for k, v in TEMPLATE_BODIES.items() for x in (F.lit(k), F.lit(v))]), (F.col("id") % 30).cast("int")
    )
    t = p.select("page_num", "id", "title", body.alias("body"))
    redef = t.where(F.col("id") % 20 == 0).select(
        (F.col("page_num") + 1).alias("page_num"),
        "id",
        "title",
        F.concat(F.lit("v2 "), F.col("body")).alias("body"),
    )
    return t.unionByName(redef)


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_wikipages(with_duplicates: bool = False) -> str:
    """The same fixture as DuckDB SQL (a CTE body named ``wikipages``)."""
    cases = " ".join(f"WHEN {i} THEN {_sql_str(p)}" for i, p in enumerate(MARKUP_PREFIXES))
    base = f"""
  SELECT doc_id * 2 AS page_num, doc_id AS id,
         CASE WHEN doc_id % 10 = 0 THEN 'Template:T' || doc_id ELSE 'Page ' || doc_id END AS title,
         CAST(CASE WHEN doc_id % 10 = 0 THEN 10 WHEN doc_id % 10 = 1 THEN 14 ELSE 0 END AS INTEGER) AS ns,
         CASE WHEN doc_id % 17 = 0 AND doc_id % 10 NOT IN (0, 1) THEN 'Page ' || (doc_id + 1) END AS redirect,
         (CASE doc_id % 8 {cases} END) || chr(10) || text AS text
  FROM documents"""
    if with_duplicates:
        base = f"""
  SELECT * FROM ({base}) UNION ALL
  SELECT page_num + 1, id, title, ns, redirect, text FROM ({base}) WHERE id % 7 = 0"""
    return f"wikipages AS ({base}\n)"


def sql_templates() -> str:
    cases = " ".join(f"WHEN {k} THEN {_sql_str(v)}" for k, v in TEMPLATE_BODIES.items())
    return f"""tpl_base AS (
  SELECT page_num, id, title, CASE id % 30 {cases} END AS body FROM wikipages WHERE ns = 10
),
templates AS (
  SELECT * FROM tpl_base
  UNION ALL SELECT page_num + 1, id, title, 'v2 ' || body FROM tpl_base WHERE id % 20 = 0
)"""
