"""MediaWiki XML dumps as DataFrames.

Pages are read as text records that end with a page's end tag (plain or ``.bz2``,
both of which split) and parsed by ``from_xml`` with an explicit schema of the five
fields the extractor uses; site info comes from Spark's XML source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_SCHEMA = (
    "title string, ns int, id bigint, redirect struct<_title:string>, revision struct<id:bigint,text:string>"
)
SITEINFO_SCHEMA = "base string, namespaces struct<namespace:array<struct<_VALUE:string,_key:int>>>"


def _xml(spark: SparkSession, row_tag: str, schema: str):
    return (
        spark.read.format("xml")
        .option("rowTag", row_tag)
        .option("ignoreSurroundingSpaces", "false")
        .option("mode", "PERMISSIVE")
        .schema(schema)
    )


_CORRUPT = "_corrupt_record"
_PAGE_END = "</page>"


def _scanned(spark: SparkSession, path: str) -> DataFrame:
    """(page_num, page, source): one row for each page element; page is null and
    source its text where it would not parse.

    The text is read in records that end with a page's end tag, so files (also
    bzip2) split anywhere and a broken page cannot reach beyond its record: of
    several page starts in a record all but the last lack their end.
    """
    records = spark.read.option("lineSep", _PAGE_END).text(path).select(F.monotonically_increasing_id().alias("page_num"), "value")
    starts = F.filter(F.split("value", r"(?=<page[\s>])"), lambda x: F.startswith(x, F.lit("<page")))
    pieces = records.select("page_num", F.size(starts).alias("n"), F.posexplode(starts).alias("k", "source"))
    whole = F.when(F.col("k") == F.col("n") - 1, F.concat("source", F.lit(_PAGE_END)))
    parsed = F.from_xml(whole, F.lit(f"{PAGE_SCHEMA}, {_CORRUPT} string"), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "ignoreSurroundingSpaces": "false"})
    pieces = pieces.withColumn("page", parsed)
    return pieces.select("page_num", F.when(F.col("page").isNotNull() & F.col(f"page.{_CORRUPT}").isNull(), F.col("page")).alias("page"), "source")


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """Dump -> (page_num, id, title, ns, redirect, text).

    ``page_num`` keeps dump order (increasing, unique, not dense; W5 gives a
    dense number when one is needed).  A missing ``ns`` is 0; an empty
    ``<text/>`` is ''.  Pages that would not parse are in
    :func:`read_dump_failures`.
    """
    return _scanned(spark, path).where(F.col("page").isNotNull()).select(
        "page_num",
        F.col("page.id").alias("id"),
        F.col("page.title").alias("title"),
        F.coalesce(F.col("page.ns"), F.lit(0)).alias("ns"),
        F.col("page.redirect._title").alias("redirect"),
        F.coalesce(F.col("page.revision.text"), F.lit("")).alias("text"),
    )


def read_dump_failures(spark: SparkSession, path: str) -> DataFrame:
    """(page_num, id, title, source) of the pages that would not parse; id
    and title as far as the text shows them."""
    bad = _scanned(spark, path).where(F.col("page").isNull())
    return bad.select("page_num", F.regexp_extract("source", r"<id>\s*(\d+)\s*</id>", 1).try_cast("bigint").alias("id"),
                      F.regexp_extract("source", r"<title>([^<]*)</title>", 1).alias("title"), "source")


def read_siteinfo(spark: SparkSession, path: str) -> DataFrame:
    """(base, key, name): base URL cut at the last '/', one row per namespace."""
    raw = _xml(spark, "siteinfo", SITEINFO_SCHEMA).load(path)
    return raw.select(
        F.regexp_replace("base", "/[^/]*$", "").alias("base"),
        F.explode("namespaces.namespace").alias("n"),
    ).select("base", F.col("n._key").alias("key"), F.coalesce(F.col("n._VALUE"), F.lit("")).alias("name"))


def write_dump(pages: DataFrame, path: str, compression: str | None = None) -> None:
    """Write page rows (id, title, ns, redirect, text) as ``<page>`` XML."""
    out = pages.select(
        "title",
        "ns",
        "id",
        F.when(F.col("redirect").isNotNull(), F.struct(F.col("redirect").alias("_title"))).alias("redirect"),
        F.struct(F.col("id").alias("id"), F.col("text").alias("text")).alias("revision"),
    )
    w = out.write.format("xml").option("rootTag", "mediawiki").option("rowTag", "page").mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    w.save(path)


def write_siteinfo(siteinfo: DataFrame, path: str) -> None:
    """Write (base, key, name) rows as one ``<siteinfo>`` element."""
    one = siteinfo.groupBy("base").agg(
        F.struct(
            F.array_sort(F.collect_list(F.struct(F.col("name").alias("_VALUE"), F.col("key").alias("_key")))).alias(
                "namespace"
            )
        ).alias("namespaces")
    )
    one.write.format("xml").option("rootTag", "mediawiki").option("rowTag", "siteinfo").mode("overwrite").save(path)


def read_template_store(spark: SparkSession, path: str) -> DataFrame:
    """A saved template store back to (title, ns, id, text)."""
    return spark.read.parquet(path)


def write_template_store(pages: DataFrame, path: str) -> None:
    """Save every template/module page for re-use."""
    pages.where(F.col("ns").isin(10, 828)).select("title", "ns", "id", "text").write.mode("overwrite").parquet(path)
