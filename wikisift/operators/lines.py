"""Line rendering (the reference's ``compact``): R1-R7, W2-W4, P7, P8, A7.

Two equivalent forms:

* ``render_lines`` works on a ``lines`` table (page_num, pos, line) with
  window functions over ``partitionBy(page).orderBy(pos)``: section number
  (W2), "previous structural line was a list item" (W4), residue (P7) and
  preformatted (P8) tests.  It needs one shuffle by page.
* ``compact_text`` folds the same state machine over the page's own line
  array with ``aggregate``: no explode, no shuffle.  ``clean_article`` uses
  this form; tests check that both agree.

Default text mode (sections, lists and HTML off): header lines are dropped,
the first content line of a section survives even when it starts with a
space, the first ordinary line after a list is kept without the residue test.
The flag forms (W3, R3-R5) are windows over the same annotated lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wikisift.functions.text import col_of

# (==+) title (same run of '='), anchored at the line start only.
SECTION_RE = r"(?d)^(==+)\s*(.*?)\s*\1"
LIST_CHARS = "*#;:"


def _title_dot(t: Column) -> Column:
    """Terminate a title with '.' unless it ends in '!' or '?' (or is empty)."""
    return F.when((t != "") & ~t.rlike(r"[!?]$"), F.concat(t, F.lit("."))).otherwise(t)


def section_level(line) -> Column:
    """Header level (0 when the line is not a header)."""
    line = col_of(line)
    return F.length(F.regexp_extract(line, SECTION_RE, 1))


def section_title(line) -> Column:
    """Header title (with the closing dot)."""
    return _title_dot(F.regexp_extract(col_of(line), SECTION_RE, 2))


def page_title_line(line) -> Column:
    """R2: ``++title++`` -> title + '.'."""
    line = col_of(line)
    return _title_dot(F.substring(line, 3, F.greatest(F.length(line) - 4, F.lit(0))))


def line_kind(line) -> Column:
    line = col_of(line)
    first = F.substring(line, 1, 1)
    return (
        F.when(line.rlike(SECTION_RE), "header")
        .when(F.startswith(line, F.lit("++")), "title")
        .when(first == ":", "colon")
        .when(first.isin("*", "#", ";"), "list")
        .otherwise("other")
    )


def is_residue(line) -> Column:
    """table/list residue and irrelevant lines."""
    line = col_of(line)
    first = F.substring(line, 1, 1)
    last = F.substring(line, -1, 1)
    return (
        first.isin("{", "|")
        | (last == "}")
        | ((first == "(") & (last == ")"))
        | (F.regexp_replace(line, r"^[.\-]+|[.\-]+$", "") == "")
    )


def to_lines(pages: DataFrame, key: str = "page_num", text: str = "text") -> DataFrame:
    """Page text -> non-empty lines with their position."""
    return (
        pages.select(key, F.posexplode(F.split(text, "\n")).alias("pos", "line"))
        .where(F.col("line") != "")
    )


def annotate_lines(lines: DataFrame, key: str = "page_num") -> DataFrame:
    """W2 + W4 + P7 + P8 as columns over (key, pos, line)."""
    w = Window.partitionBy(key).orderBy("pos")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    kind = line_kind("line")
    df = lines.withColumn("kind", kind)
    structural = F.when(F.col("kind").isin("header", "list", "other"), F.col("kind"))
    df = df.withColumn("after_list", F.coalesce(F.last(structural, ignorenulls=True).over(before) == "list", F.lit(False)))
    df = df.withColumn("section", F.sum((F.col("kind") == "header").cast("int")).over(upto))
    df = df.withColumn("residue", (F.col("kind") == "other") & is_residue("line"))
    content = (F.col("kind") == "other") & ~F.col("after_list") & ~F.col("residue")
    df = df.withColumn("content", content)
    # rank of a content line inside its section
    first_in_section = F.min(F.when(F.col("content"), F.col("pos"))).over(
        Window.partitionBy(key, "section").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    )
    df = df.withColumn(
        "first_content", F.col("content") & (F.col("section") > 0) & (first_in_section == F.col("pos"))
    )
    return df


# HTML of list levels and items, as the output format has them.
LIST_OPEN = {"*": "<ul>", "#": "<ol>", ";": "<dl>", ":": "<dl>"}
LIST_CLOSE = {"*": "</ul>", "#": "</ol>", ";": "</dl>", ":": "</dl>"}
LIST_ITEM = {"*": ("<li>", "</li>"), "#": ("<li>", "</li>"), ";": ("<dt>", "</dt>"), ":": ("<dd>", "</dd>")}


def list_marks(line) -> Column:
    """The list characters a line begins with."""
    return F.regexp_extract(col_of(line), "^[*#;:]+", 0)


def list_body(line) -> Column:
    return F.regexp_replace(F.regexp_replace(col_of(line), "^[*#;:]+", ""), r"^\s+|\s+$", "")


def list_item_text(line) -> Column:
    """A bullet as wide as the item's level, then the item."""
    marks = list_marks(line)
    bullet = F.when(F.substring(marks, -1, 1) == "#", F.lit("1. ")).otherwise(F.lit("- "))
    return F.concat(F.rpad(bullet, F.greatest(F.length(bullet), F.length(marks)), F.lit(" ")), list_body(line))


def _by_mark(mark: Column, table: dict) -> Column:
    out = F.lit("")
    for k, v in table.items():
        out = F.when(mark == k, v).otherwise(out)
    return out


def list_item_html(line) -> Column:
    """The item in the tags of its last list character."""
    last = F.substring(list_marks(line), -1, 1)
    return F.concat(_by_mark(last, {k: v[0] for k, v in LIST_ITEM.items()}), list_body(line), _by_mark(last, {k: v[1] for k, v in LIST_ITEM.items()}))


def list_level_tags(before, marks) -> Column:
    """Tags that lead from the previous item's list characters to this one's.

    Level by level: another kind closes and opens (definition lists mix with
    any), further levels open, missing ones close.
    """
    before, marks = col_of(before), col_of(marks)

    def at(k):
        c, n = F.substr(before, k, F.lit(1)), F.substr(marks, k, F.lit(1))
        mixed = c.isin(";", ":") | n.isin(";", ":")
        tags = F.array(_by_mark(c, LIST_CLOSE), _by_mark(n, LIST_OPEN))
        return F.when((c != n) & ((c == "") | (n == "") | ~mixed), tags).otherwise(F.array().cast("array<string>"))

    levels = F.greatest(F.length(before), F.length(marks))
    steps = F.when(levels > 0, F.flatten(F.transform(F.sequence(F.lit(1), F.greatest(levels, F.lit(1))), at)))
    return F.filter(F.coalesce(steps, F.array().cast("array<string>")), lambda t: t != "")


def header_html(line) -> Column:
    """A header line as ``<hN>title</hN>``."""
    level = section_level(line).cast("string")
    return F.concat(F.lit("<h"), level, F.lit(">"), F.regexp_extract(col_of(line), SECTION_RE, 2), F.lit("</h"), level, F.lit(">"))


def pending_lines(lines: DataFrame, key: str = "page_num", lists: bool = False) -> DataFrame:
    """The annotated lines plus W3: ``pending``, the titles of the sections that
    open at this line.

    A header waits for the first line that its section keeps (with ``lists`` also
    a list item).  Waiting headers of the same or a deeper level are replaced by
    a new one, so those shown at a line have growing levels.
    """
    a = annotate_lines(lines, key)
    item = (F.col("kind") == "list") & (list_body("line") != "") if lists else F.lit(False)
    a = a.withColumn("event", F.col("content") | item)
    in_section = Window.partitionBy(key, "section")
    a = a.withColumn("first_event", F.col("event") & (F.col("section") > 0) & (F.min(F.when(F.col("event"), F.col("pos"))).over(in_section) == F.col("pos")))
    by_item = F.max(F.when(F.col("first_event"), (F.col("kind") == "list").cast("int"))).over(in_section)
    a = a.withColumn("opened_by_item", F.coalesce(by_item == 1, F.lit(False)))
    w = Window.partitionBy(key).orderBy("pos")
    a = a.withColumn("epoch", F.coalesce(F.sum(F.col("first_event").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    a = a.withColumn("level", F.when(F.col("kind") == "header", section_level("line")))
    in_epoch = Window.partitionBy(key, "epoch").orderBy("pos")
    later = F.min("level").over(in_epoch.rowsBetween(1, Window.unboundedFollowing))
    a = a.withColumn("waits", (F.col("kind") == "header") & F.coalesce(later > F.col("level"), F.lit(True)))
    title = F.when(F.col("waits"), F.struct("level", section_title("line").alias("title")))
    a = a.withColumn("held", F.collect_list(title).over(in_epoch.rowsBetween(Window.unboundedPreceding, 0)))
    return a.withColumn("pending", F.when(F.col("first_event"), F.col("held")).otherwise(F.array().cast("array<struct<level:int,title:string>>"))).drop("held", "event", "waits")


def render_lines(lines: DataFrame, key: str = "page_num", sections: bool = False, lists: bool = False, html: bool = False) -> DataFrame:
    """The kept lines, as (key, pos, line); (key, pos, sub, line) with a flag.

    ``sections`` shows the titles of filled sections (W3), ``lists`` keeps list
    items as text (R3), ``html`` marks headers and lists up (R4, R5).
    """
    if not (sections or lists or html):
        a = annotate_lines(lines, key)
        keep = (
            ((F.col("kind") == "title") & (F.substring("line", 3, F.greatest(F.length("line") - 4, F.lit(0))) != ""))
            | ((F.col("kind") == "other") & F.col("after_list"))
            | F.col("first_content")
            | (F.col("content") & ~F.startswith(F.col("line"), F.lit(" ")))
        )
        return a.where(keep).select(key, "pos", F.when(F.col("kind") == "title", page_title_line("line")).otherwise(F.col("line")).alias("line"))
    a = pending_lines(lines, key, lists)
    before = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    last_marks = F.last(F.when(F.col("kind") == "list", list_marks("line")), ignorenulls=True).over(before)
    a = a.withColumn("marks_before", F.when(F.col("after_list"), last_marks).otherwise(F.lit("")))
    none = F.array().cast("array<string>")
    titles = F.transform("pending", lambda p: p["title"])
    body, line = list_body("line"), F.col("line")
    item = none
    if lists:
        item = F.when(body != "", F.concat(titles, F.array(list_item_text("line")))).otherwise(none)
    elif html:
        item = F.when(body != "", F.array(list_item_html("line"))).otherwise(none)
    if html:
        item = F.concat(list_level_tags("marks_before", list_marks("line")), item)
    closing = F.reverse(F.transform(F.regexp_extract_all("marks_before", F.lit("."), F.lit(0)), lambda m: _by_mark(m, LIST_CLOSE))) if html else none
    kept = F.col("first_event") | (~F.startswith(line, F.lit(" ")) & ~F.col("opened_by_item"))
    page_title = page_title_line("line")
    out = (
        F.when(F.col("kind") == "header", F.array(header_html("line")) if html else none)
        .when(F.col("kind") == "title", F.when(page_title != "", F.array(page_title)).otherwise(none))
        .when(F.col("kind") == "list", item)
        .when((F.col("kind") == "other") & F.col("after_list"), F.concat(F.array(line), closing))
        .when(F.col("content") & kept, F.concat(titles if sections else none, F.array(line)))
        .otherwise(none)
    )
    return a.select(key, "pos", F.posexplode(out).alias("sub", "line"))


def reassemble(lines: DataFrame, key: str = "page_num") -> DataFrame:
    """Lines back to page text in order (one group per page)."""
    place = [c for c in ("pos", "sub") if c in lines.columns]
    return lines.groupBy(key).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct(*place, "line"))), lambda x: x["line"]), "\n"
        ).alias("text")
    )


# What a line is to the line pass, and whether it is content, as one digit.
_HEADER, _TITLE, _LIST, _COLON, _RESIDUE, _CONTENT, _PRE = range(7)


def _line_code(line: Column) -> Column:
    kind = line_kind(line)
    return (
        F.when(kind == "header", _HEADER).when(kind == "title", _TITLE).when(kind == "list", _LIST).when(kind == "colon", _COLON)
        .when(is_residue(line), _RESIDUE).when(F.startswith(line, F.lit(" ")), _PRE).otherwise(_CONTENT)
    )


def kept_flags(codes: Column) -> Column:
    """W2, W4, P7, P8 over a page's line codes: a string of 0 and 1.

    The codes are one digit a line, so the rules are patterns over a string:
    colon and title lines change no state, a list or header lasts until the
    next line that does.  Regular expressions mark the kept places; the work is
    linear in the lines.
    """
    silent = f"[{_TITLE}{_COLON}]*"
    other = f"[{_RESIDUE}{_CONTENT}{_PRE}]"
    # the ordinary line after a list is kept, whatever it holds ...
    s = F.regexp_replace(codes, f"({_LIST}{silent}){other}", "$1L")
    # ... and the first content line of a section, though it starts with a space
    s = F.regexp_replace(s, f"({_HEADER}[^{_HEADER}{_CONTENT}{_PRE}]*){_PRE}", "$1F")
    return F.translate(s, f"{_CONTENT}LF{_TITLE}{_HEADER}{_LIST}{_COLON}{_RESIDUE}{_PRE}", "111100000")


def compact_text(text) -> Column:
    """R6 without a shuffle: the page's lines become codes, patterns over the
    codes say which stay, one filter takes them."""
    lines = F.filter(F.split(col_of(text), "\n"), lambda x: x != "")
    flags = F.split(kept_flags(F.array_join(F.transform(lines, lambda x: _line_code(x).cast("string")), "")), "")
    pairs = F.arrays_zip(lines.alias("line"), flags.alias("keep"))
    kept = F.filter(pairs, lambda p: (p["keep"] == "1") & p["line"].isNotNull())
    shown = F.transform(kept, lambda p: F.when(line_kind(p["line"]) == "title", page_title_line(p["line"])).otherwise(p["line"]))
    return F.array_join(F.filter(shown, lambda x: x != ""), "\n")
