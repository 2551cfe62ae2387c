"""Template catalog, call edges, joins and expansion.

Expansion (T3) needs, beside a page, the bodies that it can reach.  The catalog's own
call edges (T1 over its bodies) are closed over redirects by semi-naive rounds: a
round joins only the pairs found in the last one with the edges.  A page's own
titles are joined to that closure, the bodies are gathered beside the page once, and
the page is expanded inside its row (``functions/expansion.py``) and written once.
Titles that only come to be while expanding (``{{ {{{1}}} }}``) are asked for by the
few pages that miss them; those get the closure of what they asked for and start over.

Asked titles are distinct per page, so a title on every page is one skewed join
key, which AQE splits; sides are broadcast only when Spark measures them small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wikisift.functions import braces as B
from wikisift.functions import expansion as X
from wikisift.functions import templates as TF
from wikisift.session import cut_lineage


def template_catalog(template_pages: DataFrame, text: str = "body") -> DataFrame:
    """A4: one prepared body per title, the later definition wins; redirect pages and
    empty bodies are skipped; ``definitions`` > 1 marks a redefinition."""
    prepared = template_pages.where(F.coalesce(TF.redirect_target(text), F.lit("")) == "").select("page_num", "title", TF.template_body(text).alias("body")).where(F.col("body") != "")
    return prepared.groupBy("title").agg(
        F.max_by("body", "page_num").alias("body"), F.count(F.lit(1)).alias("definitions")
    )


def redirects_of(pages: DataFrame) -> DataFrame:
    """N5 over pages: (title, target) of redirect pages."""
    t = TF.redirect_target("text")
    return pages.select("title", t.alias("target")).where(F.col("target") != "")


def template_calls(pages: DataFrame, key: str = "page_num") -> DataFrame:
    """Edge table page -> call (position, nesting depth, title, parts), calls
    inside calls included, in the order in which they open.

    Calls are found in the row; their positions and depths are running sums over the
    page's opening and closing places, one window of narrow marks and their calls.
    """
    found = pages.where(F.instr("text", "{{") > 0).select(key, F.explode(B.calls_of("text")).alias("c"))
    # of one run the outer call opens first
    opened = Window.partitionBy(key).orderBy("c.at", F.desc("c.round"))
    placed = found.select(key, (F.row_number().over(opened) - 1).alias("pos"), "c.calls", "c.parts")
    marks = F.array(F.struct(F.col("pos").alias("at"), F.lit(1).alias("way"), F.col("parts").alias("parts")),
                    F.struct((F.col("pos") + F.col("calls")).alias("at"), F.lit(-1).alias("way"), F.lit(None).cast("array<string>").alias("parts")))
    marked = placed.select(key, F.inline(marks))
    upto = Window.partitionBy(key).orderBy("at", "way").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    depths = marked.select(key, "at", "way", "parts", (F.sum("way").over(upto) - 1).cast("int").alias("depth")).where("way = 1")
    return depths.select(key, F.col("at").alias("pos"), "depth", TF.pystrip(F.get("parts", F.lit(0))).alias("title"), "parts")


def resolve_redirects(calls: DataFrame, redirects: DataFrame, col: str = "qtitle") -> DataFrame:
    """Exactly one redirect hop (left join, unmatched keeps its title)."""
    r = redirects.select(F.col("title").alias("_rt"), F.col("target").alias("_target"))
    return calls.join(r, calls[col] == r["_rt"], "left").withColumn(col, F.coalesce("_target", col)).drop("_rt", "_target")


def lookup_templates(calls: DataFrame, catalog: DataFrame, col: str = "qtitle") -> DataFrame:
    """Call title -> body; an unknown template gives ''."""
    c = catalog.select(F.col("title").alias("_ct"), F.col("body").alias("_body"))
    return calls.join(c, calls[col] == c["_ct"], "left").withColumn("body", F.coalesce("_body", F.lit(""))).drop("_ct", "_body")


def unresolved_templates(calls: DataFrame, catalog: DataFrame, col: str = "qtitle") -> DataFrame:
    """Calls with no definition (audit table)."""
    c = catalog.select(F.col("title").alias(col))
    return calls.join(c, col, "left_anti")


def known_namespace_match(titles: DataFrame, namespaces: DataFrame, col: str = "title") -> DataFrame:
    """Titles whose prefix (first letter upper) names a known namespace."""
    pref = TF.normalize_namespace(F.substring_index(F.col(col), ":", 1))
    t = titles.where(F.instr(col, ":") > 0).withColumn("_prefix", pref)
    return t.join(namespaces.select(F.col("name").alias("_prefix")), "_prefix", "left_semi").drop("_prefix")


_MAGIC = ["!", "pagename", "fullpagename", "currentyear", "currentmonth", "currentday", "currenthour", "currenttime"]


def _magic(page_title: Column, as_of: Column) -> Column:
    return F.map_from_arrays(F.array(*map(F.lit, _MAGIC)), F.array(*[F.coalesce(TF.magic_words(F.lit(w), page_title, as_of), F.lit("")) for w in _MAGIC]))


def _moment(as_of) -> Column:
    return as_of if as_of is not None else F.lit("2000-01-01 00:00:00").cast("timestamp")


def asked_titles(texts: DataFrame, key: str, known_namespaces: list[str]) -> DataFrame:
    """(key, asked): the different templates whose titles stand in a text as they are."""
    bare = TF.strip_subst(F.col("title"))
    # a title that is made by a call, or names a function, asks for no template by itself
    made = (F.instr(bare, "{") > 0) | (F.instr(bare, ":") > 2)
    named = template_calls(texts, key).where(~made).select(key, TF.qualify_template_title(bare, known_namespaces).alias("asked"))
    return named.where("asked <> ''").distinct()


def template_closure(catalog: DataFrame, known_namespaces: list[str], redirects: DataFrame | None = None) -> DataFrame:
    """(asked, reached): the titles that an asked title's expansion can ask for, itself
    included, by semi-naive rounds over the catalog's call edges.

    A round joins only the pairs that the last one found; the rounds end when none is new, so loops
    among templates end too.
    """
    edges = asked_titles(catalog.select(F.col("title").alias("caller"), F.col("body").alias("text")), "caller", known_namespaces)
    edges = cut_lineage(edges.select(F.col("caller").alias("title"), F.col("asked").alias("next")))
    names = catalog.select(F.col("title").alias("asked"))
    if redirects is not None:
        names = names.unionByName(redirects.select(F.col("title").alias("asked")))
    names = names.unionByName(edges.select(F.col("next").alias("asked"))).distinct()
    # redirects are followed on the way: what an asked title's body asks for
    target = names.withColumn("title", F.col("asked"))
    if redirects is not None:
        target = resolve_redirects(target, redirects, "title")
    step = cut_lineage(target.join(edges, "title").select(F.col("asked").alias("at"), "next").distinct())
    reached = new = cut_lineage(names.select("asked", F.col("asked").alias("reached")))
    while True:
        found = new.join(step, F.col("reached") == F.col("at")).select("asked", F.col("next").alias("reached")).distinct()
        new = cut_lineage(found.join(reached, ["asked", "reached"], "left_anti"))
        if new.isEmpty():
            return reached
        reached = cut_lineage(reached.unionByName(new))


def expand_templates(pages: DataFrame, catalog: DataFrame, redirects: DataFrame | None = None,
                     known_namespaces: list[str] | None = None, key: str = "page_num", as_of=None) -> DataFrame:
    """Pages (key, title, text, ...) with expanded ``text``, and ``overruns``
    (calls beyond the depth limit) and ``title_errors`` (calls without a title).

    ``key`` tells pages apart.  A null text stays null.
    """
    known_namespaces = known_namespaces or ["Template"]
    magic = _magic(F.col("title"), _moment(as_of))
    catalog = cut_lineage(catalog.select("title", "body"))
    redirects = None if redirects is None else cut_lineage(redirects.select("title", "target"))
    closure = template_closure(catalog, known_namespaces, redirects)
    bodies = closure.select(F.col("reached").alias("asked")).distinct().withColumn("target", F.col("asked"))
    if redirects is not None:
        bodies = resolve_redirects(bodies, redirects, "target")
    ready = catalog.select(F.col("title").alias("target"), X.prepared(F.col("body")).alias("body"))
    # every title that can be asked for, with what it stands for (no body: none)
    bodies = cut_lineage(bodies.join(ready, "target", "left").select("asked", "target", "body"))

    def given(asked: DataFrame) -> DataFrame:
        """(key, _known): the bodies that the asked titles reach, each once."""
        all_ = asked.join(closure, "asked", "left").select(key, F.coalesce("reached", "asked").alias("asked")).distinct()
        entry = F.struct("asked", F.struct(F.coalesce("target", "asked").alias("target"), "body"))
        return all_.join(bodies, "asked", "left").groupBy(key).agg(F.map_from_entries(F.collect_list(entry)).cast(X.KNOWN).alias("_known"))

    def passed(rows: DataFrame) -> DataFrame:
        return cut_lineage(rows.withColumn("_x", X.steps(F.col("_x"), F.col("_known"), magic, known_namespaces)))

    def run(rows: DataFrame) -> DataFrame:
        """``rows`` (with _known) expanded; a row is passed over again while nodes are left."""
        no_bodies = F.create_map().cast(X.KNOWN)
        opened = rows.withColumn("_known", F.coalesce("_known", no_bodies)).withColumn("_o", B.outermost(B.core(F.col("text"))))
        cur = passed(opened.withColumn("_x", X.start(F.col("_o.nodes"))))
        out = cur.where("_x.done")
        while not (left := cur.where("NOT _x.done")).isEmpty():
            cur = passed(left)
            out = out.unionByName(cur.where("_x.done"))
        return out

    def finished(rows: DataFrame) -> DataFrame:
        return rows.select(*[B.around(F.col("text"), B.put_back(F.col("_o.frame"), F.col("_x.text"))).alias("text") if c == "text" else F.col(c) for c in pages.columns],
                           F.col("_x.overruns").alias("overruns"), F.col("_x.title_errors").alias("title_errors"))

    has = F.coalesce(F.instr("text", "{{") > 0, F.lit(False))
    done = pages.where(~has).withColumns({"overruns": F.lit(0), "title_errors": F.lit(0)})
    open_ = pages.where(has)
    asked = asked_titles(open_.select(key, "text"), key, known_namespaces)
    cur = run(open_.join(given(asked), key, "left"))
    while True:
        done = done.unionByName(finished(cur.where(F.size("_x.missing") == 0)))
        short = cur.where(F.size("_x.missing") > 0)
        if short.isEmpty():
            return done
        # titles made on the way: with what they reach, the page starts over
        more = given(short.select(key, F.explode("_x.missing").alias("asked")).distinct()).withColumnRenamed("_known", "_more")
        cur = run(short.drop("_x", "_o").join(more, key).withColumn("_known", F.map_concat("_known", "_more")).drop("_more"))


def template_args(calls: DataFrame, known_namespaces: list[str], page_title: str = "page_title", as_of=None) -> DataFrame:
    """Calls (parts, body, page title) with ``body`` filled in by the call's
    parameters, which see no templates; calls in the body stay calls."""
    magic = _magic(F.col(page_title), _moment(as_of))
    # the arguments (each balanced, as they are parts) as one text, cut again behind
    later = F.slice("parts", 2, F.greatest(F.size("parts") - 1, F.lit(0)))
    filled = calls.withColumn("_o", B.outermost(F.array_join(later, B.BETWEEN)))
    filled = filled.withColumn("_x", X.steps(X.start(F.col("_o.nodes")), F.create_map().cast(X.KNOWN), magic, known_namespaces))
    args = F.when(F.size("parts") > 1, F.split(B.put_back(F.col("_o.frame"), F.col("_x.text")), B.BETWEEN, -1)).otherwise(F.array().cast("array<string>"))
    filled = filled.withColumn("_x", TF.call_params_map(args))
    return filled.withColumn("body", B.fill_references(F.coalesce("body", F.lit("")), F.col("_x"))).drop("_x", "_o")


def template_error_counts(expanded: DataFrame, key: str = "page_num") -> DataFrame:
    """Per page, depth overruns and calls without a title (only rows with one)."""
    sums = expanded.groupBy(key).agg(F.sum("overruns").alias("overruns"), F.sum("title_errors").alias("title_errors"))
    return sums.where("overruns > 0 OR title_errors > 0")
