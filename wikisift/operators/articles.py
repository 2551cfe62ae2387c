"""Whole-article cleaning (R7): expansion, markup, lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wikisift.functions import markup as M
from wikisift.operators import lines as L
from wikisift.operators.templates import expand_templates


def clean_articles(pages: DataFrame, catalog: DataFrame | None = None, redirects: DataFrame | None = None, known_namespaces: list[str] | None = None,
                   expand: bool = True, sections: bool = False, lists: bool = False, html: bool = False, links: bool = False,
                   namespaces: list[str] | None = None, escape: bool = False, key: str = "page_num", as_of=None) -> DataFrame:
    """``pages`` (key, title, text, ...) with clean ``text``.

    By default templates are expanded: parser functions and magic words are
    evaluated even without a ``catalog``.  ``expand=False`` drops all calls.
    ``sections``, ``lists`` and ``html`` choose the line form, ``links`` keeps
    links as anchors, ``namespaces`` are the link prefixes that survive,
    ``escape`` escapes the result.
    """
    columns = pages.columns
    if expand:
        if catalog is None:
            catalog = pages.sparkSession.createDataFrame([], "title string, body string")
        pages = expand_templates(pages, catalog, redirects, known_namespaces, key, as_of).select(*columns)
    cleaned = M.clean_markup(pages, "text", keep_links=links, html_mode=html, escape=escape, templates_expanded=expand, namespaces=namespaces)
    if not (sections or lists or html):
        return cleaned.withColumn("text", L.compact_text("text")).select(*columns)
    lined = L.reassemble(L.render_lines(L.to_lines(cleaned, key), key, sections, lists, html), key).withColumnRenamed("text", "_lined")
    both = cleaned.drop("text").join(lined, key, "left").withColumn("text", F.coalesce("_lined", F.lit("")))
    return both.select(*columns)
