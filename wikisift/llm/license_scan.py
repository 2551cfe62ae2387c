"""Operator 4: license scan by ordered signature rules (DataFrame functions only).

A text's normal form is its words, lower case, one space between two.  Cheap
anchor words are searched for first; only texts that hold one are normalised.  Each
rule has a keyword, and only rules whose keyword the normal form holds run their
regular expression.  Detections are word intervals.  Sorted by start, longest
first, one pass drops every detection that lies inside another of at least its
priority (ties: the longer, then the rule listed first), so overlaps resolve
to the most telling signature.

Everything happens inside the row: no shuffle, no Python.  Cost beyond the
anchors is paid by texts that speak of licenses.

Defined results: null text = empty (no words, no labels, score 0); null doc_id is
kept; repeated rows each get a row; only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wikisift.llm.license_rules import rules

#: Phrases whose places are always reported, and their labels.
BASE = [("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")]

#: Every rule's keyword holds one of these words (a test checks it), or is of
#: the "cc by" family, which ``_CC`` finds.
ANCHORS = ["apache", "asl", "attribution", "bsd", "cc0", "classpath", "commons", "confidential", "creative", "developed", "domain", "endorse", "epl", "gpl",
           "identifier", "licen", "linux", "mpl", "noncommercial", "ofl", "perl", "permission", "psl", "rail", "redistribution", "reserved", "terms",
           "unauthorized", "unencumbered", "warranty", "wtfpl"]

_SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_CC = r"cc[\x00-\x2F\x3A-\x60\x7B-\x7F]+by"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Confidence of a detection by its priority.
CONFIDENCE = [0.3, 0.5, 0.7, 0.9, 1.0]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normal_form(text: Column) -> Column:
    """' w0 w1 ... ' of the text's words, A-Z in lower case."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.translate(text, _UPPER, _LOWER), _SEPARATOR, " ")), F.lit(" "))


def _spaces(s: Column) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))


def _matches(norm: Column, pattern: Column) -> Column:
    """array<struct<start, end>> in words of the pattern's matches.

    The pieces between the matches and the matches themselves are walked
    together; a match starts behind the spaces seen so far.
    """
    found = F.regexp_extract_all(norm, pattern, F.lit(0))
    pieces = F.split(norm, pattern, -1)
    none = F.array().cast("array<struct<start:int,end:int>>")
    state = F.struct(F.lit(-1).alias("at"), none.alias("out"))

    def step(s, p):
        start = s["at"] + _spaces(p["piece"])
        end = start + _spaces(p["match"])
        span = F.struct(start.cast("int").alias("start"), (end + 1).cast("int").alias("end"))
        return F.struct(end.cast("int").alias("at"), F.concat(s["out"], F.array(span)).alias("out"))

    pairs = F.filter(F.arrays_zip(pieces.alias("piece"), found.alias("match")), lambda p: p["match"].isNotNull())
    return F.aggregate(pairs, state, step, lambda s: s["out"])


def _kept(found: Column) -> Column:
    """Detections (start, end, priority, rule, label) without those contained in
    one of at least their priority."""
    order = F.array_sort(F.transform(found, lambda d: F.struct(d["start"].alias("start"), (-d["end"]).alias("neg_end"), (-d["priority"]).alias("neg_priority"),
                                                               d["rule"].alias("rule"), d["label"].alias("label"))))
    none = F.array().cast("array<struct<start:int,end:int,priority:int,label:string>>")
    # ends[p]: furthest end of a detection of priority p or more
    state = F.struct(F.array(*[F.lit(-1)] * len(CONFIDENCE)).alias("ends"), none.alias("out"))

    def step(s, d):
        end, priority = -d["neg_end"], -d["neg_priority"]
        inside = F.get(s["ends"], priority) >= end
        ends = F.transform(s["ends"], lambda e, k: F.when((k <= priority) & (e < end), end).otherwise(e))
        hit = F.struct(d["start"].alias("start"), end.alias("end"), priority.alias("priority"), d["label"].alias("label"))
        return F.struct(ends.alias("ends"), F.when(inside, s["out"]).otherwise(F.concat(s["out"], F.array(hit))).alias("out"))

    return F.aggregate(order, state, step, lambda s: s["out"])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, and detections (array of word intervals with label and priority)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.lower(text).alias("low"))
    low = F.col("low")
    gate = low.rlike(_CC)
    for a in ANCHORS:
        gate = gate | low.contains(a)
    rows = rows.select("doc_id", "text", gate.alias("gate"))
    rows = rows.select("doc_id", F.regexp_count("text", F.lit(_WORD)).cast("long").alias("n_words"), F.when(F.col("gate"), normal_form(F.col("text"))).alias("norm"))

    table = F.array(*[F.struct(F.lit(i).alias("rule"), F.lit(label).alias("label"), F.lit(p).alias("priority"), F.lit(k).alias("keyword"), F.lit(x).alias("pattern"))
                      for i, (label, p, k, x) in enumerate(rules())])
    norm = F.col("norm")
    hits = F.filter(table, lambda r: F.contains(norm, r["keyword"]))
    found = F.flatten(F.transform(hits, lambda r: F.transform(_matches(norm, r["pattern"]), lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), r["priority"].alias("priority"), r["rule"].alias("rule"), r["label"].alias("label")))))
    places = "array<struct<start:int,label:string>>"

    def base_places(label, phrase):
        spans = F.transform(_matches(norm, F.lit(f"(?<= ){phrase}(?= )")), lambda m: F.struct(m["start"].alias("start"), F.lit(label).alias("label")))
        return F.when(F.contains(norm, F.lit(f" {phrase} ")), spans).otherwise(F.array().cast(places))

    base = F.flatten(F.array(*[base_places(label, phrase) for label, phrase in BASE]))
    empty = "array<struct<start:int,end:int,priority:int,label:string>>"
    rows = rows.select("doc_id", "n_words", F.when(norm.isNotNull(), base).otherwise(F.array().cast(places)).alias("base"),
                       F.when(norm.isNotNull(), _kept(found)).otherwise(F.array().cast(empty)).alias("detections"))
    base, kept = F.col("base"), F.col("detections")
    names = lambda a: F.transform(a, lambda d: d["label"])
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    confidence = F.array(*map(F.lit, CONFIDENCE))
    return rows.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda b: b["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform(base, lambda b: b["start"])).cast("long").alias("last_word"),
        joined(names(base)).alias("base_labels"), joined(F.concat(names(base), names(kept))).alias("labels"),
        F.coalesce(F.array_max(F.transform(kept, lambda d: F.get(confidence, d["priority"]))), F.lit(0.0)).alias("score"), "detections")
