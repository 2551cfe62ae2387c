"""Page-level projections, filters and ordering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wikisift.functions.text import col_of
from wikisift.operators.ordering import dense_index

# Namespace keys of templates and modules.
TEMPLATE_NAMESPACE_KEYS = [10, 828]


def filter_articles(pages: DataFrame) -> DataFrame:
    """Every namespace except templates (10) and modules (828)."""
    return pages.where(~F.col("ns").isin(*TEMPLATE_NAMESPACE_KEYS))


def filter_templates(pages: DataFrame) -> DataFrame:
    """Template and module pages only."""
    return pages.where(F.col("ns").isin(*TEMPLATE_NAMESPACE_KEYS))


def filter_redirects(pages: DataFrame) -> DataFrame:
    """Drop pages carrying a redirect."""
    return pages.where(F.col("redirect").isNull())


def page_url(base, page_id) -> Column:
    """``<base>?curid=<id>``."""
    return F.concat(col_of(base), F.lit("?curid="), col_of(page_id).cast("string"))


def dedup_pages(pages: DataFrame) -> DataFrame:
    """W1 at scale: keep the first page (lowest page_num) of every id.

    The reference skips a page whose id equals the previous page's id; in a
    dump the copies of one id are adjacent, so keeping the lowest page_num
    per id gives the same rows without a single-partition ordered window.
    One shuffle by id with a partial (map-side) min.
    """
    first = pages.groupBy("id").agg(F.min("page_num").alias("page_num"))
    return pages.join(first, ["id", "page_num"], "left_semi")


def page_sequence(pages: DataFrame, order_cols=("page_num",), name: str = "seq") -> DataFrame:
    """Dense running number of pages in dump order, distributed."""
    return dense_index(pages, list(order_cols), name)


def order_by_page(df: DataFrame) -> DataFrame:
    """O1: results in page order (range-partitioned sort)."""
    return df.orderBy("page_num")


def known_namespaces(siteinfo_namespaces: DataFrame) -> DataFrame:
    """{'Template'} union the names declared in the site info."""
    spark = siteinfo_namespaces.sparkSession
    base = spark.createDataFrame([("Template",)], "name string")
    return base.union(siteinfo_namespaces.select("name").where(F.col("name") != "")).distinct()


def write_with_stats(articles: DataFrame, path: str) -> dict:
    """Write ``articles`` to ``path``; the number written, the seconds and the
    articles a second, observed in that one pass."""
    import time

    from pyspark.sql import Observation

    seen = Observation("extraction")
    began = time.monotonic()
    articles.observe(seen, F.count(F.lit(1)).alias("articles")).write.parquet(path)
    seconds = time.monotonic() - began
    return {"articles": seen.get["articles"], "seconds": seconds, "rate": seen.get["articles"] / seconds}
