"""Registered page, source and sink jobs (P1-P4, P11, W1, W5, W8, O1, O2,
U2, A9, S1-S7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wikisift.operators import pages as P
from wikisift.plans.catalog import register
from wikisift.plans.fixtures import sql_wikipages, wikipages
from wikisift.session import arriving_files, scratch_path
from wikisift.sources import dump as D
from wikisift.sources import text as TX

BASE_URL = "https://wiki.example/wiki"
WP = f"WITH {sql_wikipages()}\n"
WPD = f"WITH {sql_wikipages(with_duplicates=True)}\n"


@register("filter_articles", WP + "SELECT page_num, id, title, ns FROM wikipages WHERE ns NOT IN (10, 828)")
def q_filter_articles(spark, sf_dir):
    """P1."""
    return P.filter_articles(wikipages(spark, sf_dir)).select("page_num", "id", "title", "ns")


@register("filter_templates", WP + "SELECT page_num, id, title, ns FROM wikipages WHERE ns IN (10, 828)")
def q_filter_templates(spark, sf_dir):
    """P2."""
    return P.filter_templates(wikipages(spark, sf_dir)).select("page_num", "id", "title", "ns")


@register("filter_redirects", WP + "SELECT page_num, id, title FROM wikipages WHERE redirect IS NULL")
def q_filter_redirects(spark, sf_dir):
    """P3."""
    return P.filter_redirects(wikipages(spark, sf_dir)).select("page_num", "id", "title")


@register("page_url", WP + f"SELECT id, '{BASE_URL}' || '?curid=' || id AS url FROM wikipages")
def q_page_url(spark, sf_dir):
    """P4."""
    return wikipages(spark, sf_dir).select("id", P.page_url(F.lit(BASE_URL), F.col("id")).alias("url"))


@register(
    "dedup_consecutive_pages",
    WPD
    + """SELECT page_num, id FROM (
  SELECT page_num, id, lag(id) OVER (ORDER BY page_num) AS prev_id FROM wikipages WHERE redirect IS NULL
) WHERE prev_id IS NULL OR prev_id <> id""",
)
def q_dedup_consecutive_pages(spark, sf_dir):
    """Copies of an id are adjacent in the dump; keep the first."""
    pages = P.filter_redirects(wikipages(spark, sf_dir, with_duplicates=True))
    return P.dedup_pages(pages).select("page_num", "id")


@register(
    "stream_dedup_pages",
    WPD
    + """SELECT page_num, id FROM (
  SELECT page_num, id, lag(id) OVER (ORDER BY page_num) AS prev_id FROM wikipages WHERE redirect IS NULL
) WHERE prev_id IS NULL OR prev_id <> id""",
)
def q_stream_dedup_pages(spark, sf_dir):
    """W1 as a stream: pages arrive file by file, a page that repeats the id before it goes."""
    from wikisift.streaming.corpus_stream import read_pages_stream, run_dedup_once

    path = scratch_path(spark, "arriving")
    pages = P.filter_redirects(wikipages(spark, sf_dir, with_duplicates=True))
    files, each = arriving_files(pages)
    pages.repartitionByRange(files, "id").sortWithinPartitions("page_num").write.parquet(path)
    return run_dedup_once(read_pages_stream(spark, path, pages.schema, max_files=each)).select("page_num", "id")


@register(
    "page_sequence",
    WP + "SELECT page_num, id, row_number() OVER (ORDER BY page_num) - 1 AS seq FROM wikipages WHERE ns NOT IN (10, 828)",
)
def q_page_sequence(spark, sf_dir):
    """Dense running page number, without a single-partition window."""
    arts = P.filter_articles(wikipages(spark, sf_dir)).select("page_num", "id")
    return P.page_sequence(arts)


@register("order_by_page", WP + "SELECT page_num, title FROM wikipages ORDER BY page_num")
def q_order_by_page(spark, sf_dir):
    """O1."""
    return P.order_by_page(wikipages(spark, sf_dir).select("page_num", "title"))


@register(
    "extraction_stats",
    WP + "SELECT count(*) AS articles FROM wikipages WHERE ns NOT IN (10, 828) AND redirect IS NULL",
)
def q_extraction_stats(spark, sf_dir):
    """The articles extracted, counted while they are written (the pages a second
    are left out of the compared columns)."""
    arts = P.filter_redirects(P.filter_articles(wikipages(spark, sf_dir)))
    stats = P.write_with_stats(arts.select("page_num", "id", "title", "text"), scratch_path(spark, "extracted"))
    assert stats["seconds"] > 0 and stats["rate"] >= 0
    return spark.createDataFrame([(stats["articles"],)], "articles long")


@register(
    "format_doc",
    WP
    + f"""SELECT id, '<doc id="' || id || '" url="{BASE_URL}?curid=' || id || '" title="' || title || '">' || chr(10)
  || title || chr(10) || chr(10) || CASE WHEN text = '' THEN '' ELSE text || chr(10) END || chr(10) || '</doc>' || chr(10) AS doc
FROM wikipages""",
)
def q_format_doc(spark, sf_dir):
    """Document envelope (id, url, title; title line; text)."""
    p = wikipages(spark, sf_dir)
    return p.select("id", TX.format_doc("id", "title", "text", BASE_URL).alias("doc"))


SQL_DOC = f"""'<doc id="' || id || '" url="{BASE_URL}?curid=' || id || '" title="' || title || '">' || chr(10)
  || title || chr(10) || chr(10) || CASE WHEN text = '' THEN '' ELSE text || chr(10) END || chr(10) || '</doc>' || chr(10)"""


def sql_files(cap: int) -> str:
    """(page_num, doc, file): a walk over the documents, one after the other."""
    return (WP.replace("WITH ", "WITH RECURSIVE ", 1) + f""", d AS MATERIALIZED (
  SELECT page_num, doc, octet_length(encode(doc)) AS b, row_number() OVER (ORDER BY page_num) AS rn FROM (SELECT page_num, {SQL_DOC} AS doc FROM wikipages)
), walk AS (
  SELECT rn, b AS held, CASE WHEN b > {cap} THEN 1 ELSE 0 END AS file FROM (SELECT rn, b FROM d WHERE rn = 1)
  UNION ALL
  SELECT d.rn, CASE WHEN held + d.b > {cap} THEN d.b ELSE held + d.b END, CASE WHEN held + d.b > {cap} THEN file + 1 ELSE file END
  FROM walk JOIN d ON d.rn = walk.rn + 1
)
SELECT page_num, doc, CAST(file AS BIGINT) AS file FROM d JOIN walk USING (rn)""")


@register("shard_by_bytes", f"SELECT page_num, file FROM ({sql_files(1048576)})")
def q_shard_by_bytes(spark, sf_dir):
    """The output file of each document (1 MiB files, closed greedily)."""
    p = wikipages(spark, sf_dir)
    docs = p.select("page_num", TX.format_doc("id", "title", "text", BASE_URL).alias("doc"))
    return TX.shard_by_bytes(docs).select("page_num", "file")


@register("scan_dump_pages", WP + "SELECT id, title, ns, redirect, text FROM wikipages")
def q_scan_dump_pages(spark, sf_dir):
    """Pages written as a bzip2 XML dump, then scanned back."""
    path = scratch_path(spark, "dump")
    D.write_dump(wikipages(spark, sf_dir), path, compression="bzip2")
    return D.read_dump(spark, path).select("id", "title", "ns", "redirect", "text")


@register(
    "scan_siteinfo",
    WP
    + f"""SELECT '{BASE_URL}' AS base, ns AS key,
  CASE ns WHEN 10 THEN 'Template' WHEN 14 THEN 'Category' ELSE '' END AS name
FROM (SELECT DISTINCT ns FROM wikipages)""",
)
def q_scan_siteinfo(spark, sf_dir):
    """Site info derived from the pages' namespaces, written and read back."""
    ns = wikipages(spark, sf_dir).select("ns").distinct()
    names = F.when(F.col("ns") == 10, "Template").when(F.col("ns") == 14, "Category").otherwise("")
    site = ns.select(F.lit(BASE_URL + "/Main_Page").alias("base"), F.col("ns").alias("key"), names.alias("name"))
    path = scratch_path(spark, "siteinfo")
    D.write_siteinfo(site, path)
    return D.read_siteinfo(spark, path)


@register(
    "known_namespaces",
    WP + "SELECT DISTINCT name FROM (SELECT 'Template' AS name UNION ALL "
    "SELECT CASE ns WHEN 10 THEN 'Template' WHEN 14 THEN 'Category' ELSE '' END FROM wikipages) WHERE name <> ''",
)
def q_known_namespaces(spark, sf_dir):
    """{'Template'} union the site's namespace names."""
    ns = wikipages(spark, sf_dir).select("ns").distinct()
    names = ns.select(F.when(F.col("ns") == 10, "Template").when(F.col("ns") == 14, "Category").otherwise("").alias("name"))
    return P.known_namespaces(names)


@register("template_store", WP + "SELECT title, ns, id, text FROM wikipages WHERE ns IN (10, 828)")
def q_template_store(spark, sf_dir):
    """S5 then S4: save template pages, read the store back."""
    path = scratch_path(spark, "templates")
    D.write_template_store(wikipages(spark, sf_dir), path)
    return D.read_template_store(spark, path)


SQL_FILES = sql_files(204800)


def _text_tree(spark, sf_dir):
    p = wikipages(spark, sf_dir)
    docs = p.select("page_num", TX.format_doc("id", "title", "text", BASE_URL).alias("doc"))
    path = scratch_path(spark, "tree")
    TX.write_sharded_text(docs, path, max_bytes=TX.MIN_FILE_BYTES, compress=True)
    tree = TX.read_text_tree(spark, path)
    return tree.select("path", "value", F.regexp_extract("path", "dir=([A-Z]+)/", 1).alias("dir"), F.regexp_extract("path", "shard=(wiki_[0-9]+)/", 1).alias("shard"))


@register(
    "scan_text_tree",
    f"SELECT chr(CAST(65 + file // 2600 AS INTEGER)) || chr(CAST(65 + file // 100 % 26 AS INTEGER)) AS dir, 'wiki_' || lpad(CAST(file % 100 AS VARCHAR), 2, '0') AS shard, "
    f"unnest(string_split(doc, chr(10))) AS value FROM ({SQL_FILES})",
)
def q_scan_text_tree(spark, sf_dir):
    """S7 then S3: documents sharded into a bzip2 dir/file tree, every line of every
    file read back with its place."""
    return _text_tree(spark, sf_dir).select("dir", "shard", "value")


@register("order_by_path", f"SELECT CAST(dense_rank() OVER (ORDER BY file) - 1 AS BIGINT) AS place, count(*) AS docs FROM ({SQL_FILES}) GROUP BY file")
def q_order_by_path(spark, sf_dir):
    """O2: the files in path order, numbered, with their documents counted."""
    from wikisift.operators.ordering import dense_index

    files = _text_tree(spark, sf_dir).where(F.startswith("value", F.lit("<doc "))).groupBy("path").agg(F.count(F.lit(1)).alias("docs"))
    return dense_index(files, ["path"], "place").select("place", "docs")


def _broken_dump(spark, sf_dir) -> str:
    """The pages as hand-made XML; of every fifty, one page has a text element that
    never closes and one page lacks its end."""
    esc = lambda c: F.replace(F.replace(F.replace(F.col(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    head = F.concat(F.lit("<page>\n  <title>"), esc("title"), F.lit("</title>\n  <ns>"), F.col("ns").cast("string"), F.lit("</ns>\n  <id>"), F.col("id").cast("string"),
                    F.lit('</id>\n  <revision><id>1</id><text bytes="1" xml:space="preserve">'), esc("text"))
    tail = F.when(F.col("id") % 50 == 7, "</revision>\n</page>").when(F.col("id") % 50 == 13, "\n").otherwise("</text></revision>\n</page>")
    path = scratch_path(spark, "broken")
    wikipages(spark, sf_dir).sort("page_num").select(F.concat(head, tail).alias("value")).write.text(path)
    return path


@register("scan_broken_dump", WP + "SELECT id, title, ns, text FROM wikipages WHERE id % 50 NOT IN (7, 13)")
def q_scan_broken_dump(spark, sf_dir):
    """S1 on a dump with broken pages: all others come through whole."""
    return D.read_dump(spark, _broken_dump(spark, sf_dir)).select("id", "title", "ns", "text")


@register("quarantine_failures", WP + "SELECT id, title FROM wikipages WHERE id % 50 IN (7, 13)")
def q_quarantine_failures(spark, sf_dir):
    """The pages that could not be parsed (error side table)."""
    return D.read_dump_failures(spark, _broken_dump(spark, sf_dir)).select("id", "title")
