"""Operator 6: secret scan (DataFrame functions only).

Base patterns (assignments, access keys, long hex strings) give spans as they
are defined.  The method adds *entropy* spans: candidate strings are cut into
character classes, and a window of ``WINDOW`` characters slides over each while
the counts of its characters are updated by one in and one out; the entropy
follows from the running sum of  count x log2 count.  A candidate whose best
window passes its class's threshold is a span, unless an allow-list rule
(identifiers, digests named as such, alphabets, placeholders) or a
base span around it accounts for it.  What stands further before a candidate, an address
for instance, changes nothing: a key in a query string is as much a key.

Spans are in code points, end exclusive.  All of it happens inside the row.

Defined results: null text = empty (no spans; the digest of no text); null
doc_id is kept; repeated rows each get a row; an empty table gives none; very long
texts are scanned whole, in time that grows as the matches to the power 1.5 at most; spans
that start together are ordered by kind, then end; only doc_id and text are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_WORDS = ["passw", "secret", "token", "api"]
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
MIN_VALUE = 8

WINDOW = 20
#: Runs of these characters, as long as a window at least, are candidates.
CANDIDATE = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{WINDOW},}}"
#: Character classes in order: name, what the whole candidate must look like,
#: bits of entropy that its best window must reach.  A window of 20 random
#: characters has about 3.0 bits over digits, 3.4 over hex, 3.7 over [a-z], 3.9 over
#: [a-z0-9] and 4.1 over base64; no window of 20 has more than 4.32.
CLASSES = [
    ("digits", r"^[0-9]+$", 3.0),
    ("hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 3.0),
    ("alpha_one_case", r"^(?:[a-z]+|[A-Z]+|[A-Z][a-z]+)$", 3.8),
    ("alpha", r"^[A-Za-z]+$", 4.1),
    ("words", r"^[A-Za-z]*(?:[_/+=-]+[A-Za-z]*)+$", 4.1),
    ("alnum_one_case", r"^(?:[a-z0-9_=-]+|[A-Z0-9_=-]+)$", 3.6),
    ("base64", r"^.+$", 3.8),
]
#: Candidates that are no secrets, and what stands before some of them.
ALLOWED = (r"(?i)^[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}$|example|sample|dummy|placeholder|changeme|redacted|x{6,}|"
           r"0123456789|1234567890|abcdefghij|qwertyuiop|^(?:[a-z]+[/_-]){3,}[a-z0-9]*$")
ALLOWED_BEFORE = r"(?i)(?:sha-?(?:1|224|256|384|512)[-:= ]|md5[-:= ]|commit |integrity=[\"']?)$"
#: Code points of the longest of these names.
CONTEXT = 11

KINDS = ["assign", "access", "hex", "entropy"]
_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _found(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """Spans of the matches; ``keep`` (over the matched text) may refuse some."""
    found, pieces = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    # pieces and matches alternate; a span starts where the characters before it end
    lengths = F.zip_with(pieces, found, lambda p, m: F.struct(F.length(p).alias("gap"), F.coalesce(F.length(m), F.lit(0)).alias("own")))
    starts = prefix_sums(F.transform(lengths, lambda x: x["gap"] + x["own"]))
    spans = F.zip_with(F.zip_with(lengths, starts, lambda x, a: F.struct((a + x["gap"]).alias("start"), x["own"].alias("own"))), found,
                       lambda x, m: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), (x["start"] + x["own"]).alias("end"), m.alias("match")))
    kept = F.filter(spans, lambda x: x["match"].isNotNull() & (keep(x["match"]) if keep is not None else F.lit(True)))
    return F.transform(kept, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))).cast(_SPANS)


def _fold_sums(values: Column) -> Column:
    """Exclusive prefix sums by a fold, which copies what it has at each step."""
    state = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(values, state, lambda s, v: F.struct((s["sum"] + v).cast("int").alias("sum"), F.concat(s["out"], F.array(s["sum"])).alias("out")), lambda s: s["out"])


def prefix_sums(values: Column) -> Column:
    """Exclusive prefix sums of an int array: folds over blocks of the square root of its
    length and over the blocks' sums, so copies grow as length ** 1.5."""
    n = F.size(values)
    size = F.greatest(F.ceil(F.sqrt(n)).cast("int"), F.lit(1))
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(n / size).cast("int") - 1, F.lit(0))), lambda k: F.slice(values, k * size + 1, size))

    def placed(held):
        offsets = _fold_sums(F.transform(held, lambda b: F.aggregate(b, F.lit(0), lambda a, v: (a + v).cast("int"))))
        return F.flatten(F.zip_with(held, offsets, lambda b, o: F.transform(_fold_sums(b), lambda v: v + o)))

    return F.element_at(F.transform(F.array(blocks), placed), 1)


def window_entropy(s: Column, window: int = WINDOW) -> Column:
    """Largest Shannon entropy (bits a character) of the windows of an ASCII
    string; 0 when it is shorter than a window."""
    first = 33
    codes = F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.ascii(F.substr(s, i, F.lit(1))) - first)
    weigh = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    weight = lambda c: F.get(weigh, c)
    # 94 counts of up to a window, five bits each, twelve to a number: a step writes eight numbers
    zero = F.array_repeat(F.lit(0).cast("long"), 8)
    state = F.struct(zero.alias("counts"), F.lit(0.0).alias("sum"), F.lit(float(math.log2(window)) * window).alias("least"), codes.alias("codes"))
    powers = F.array(*[F.lit(1 << 5 * k).cast("long") for k in range(12)])
    one = lambda c: F.get(powers, (c % 12).cast("int"))

    def count(st, c):
        return F.call_function("shiftrightunsigned", F.get(st["counts"], (c / 12).cast("int")), (c % 12 * 5).cast("int")).bitwiseAND(31).cast("int")

    def step(st, i):
        new = F.get(st["codes"], i)
        old = F.when(i >= window, F.get(st["codes"], i - window)).otherwise(F.lit(-1))
        had = F.when(old >= 0, count(st, old)).otherwise(F.lit(0))
        left = F.when(old >= 0, st["sum"] - weight(had) + weight(had - 1)).otherwise(st["sum"])
        has = count(st, new) - F.when(old == new, 1).otherwise(0)
        total = left - weight(has) + weight(has + 1)
        counts = F.transform(st["counts"], lambda v, k: v + F.when(k == (new / 12).cast("int"), one(new)).otherwise(0) - F.when((old >= 0) & (k == (old / 12).cast("int")), one(old)).otherwise(0))
        return F.struct(counts.alias("counts"), total.alias("sum"), F.when(i >= window - 1, F.least(st["least"], total)).otherwise(st["least"]).alias("least"), st["codes"].alias("codes"))

    best = F.aggregate(F.sequence(F.lit(0), F.length(s) - 1), state, step, lambda st: F.lit(math.log2(window)) - st["least"] / window)
    return F.when(F.length(s) >= window, best).otherwise(F.lit(0.0))


def is_random(s: Column, text: Column | None = None) -> Column:
    """Whether a candidate's best window passes the threshold of its class."""
    need = F.lit(math.log2(WINDOW))
    for _, pattern, bits in reversed(CLASSES):
        need = F.when(s.rlike(pattern), F.lit(bits)).otherwise(need)
    return F.when(s.rlike(ALLOWED), F.lit(False)).otherwise(window_entropy(s) >= need)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, and found (array
    of start, kind number, end)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.lower(text).alias("low"))
    t, none = F.col("text"), F.array().cast(_SPANS)
    has_word = F.lit(False)
    for w in ASSIGN_WORDS:
        has_word = has_word | F.col("low").contains(w)
    # group 2 is what is left behind the separator, so its length is tested there
    value = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= MIN_VALUE
    rows = rows.select("doc_id", "text", F.when(has_word, _found(t, ASSIGN, 0, value)).otherwise(none).alias("assign"),
                       F.when(t.contains("AKIA"), _found(t, ACCESS, 1)).otherwise(none).alias("access"),
                       F.when(t.rlike(HEX), _found(t, HEX, 2)).otherwise(none).alias("hex"),
                       F.when(t.rlike(CANDIDATE), _found(t, CANDIDATE, 3, is_random)).otherwise(none).alias("candidates"))
    rows = rows.select("doc_id", "text", F.size("assign").cast("long").alias("n_assign"), F.size("access").cast("long").alias("n_access"), F.size("hex").cast("long").alias("n_hex"),
                       F.array_sort(F.concat("assign", "access", "hex")).alias("base"), "candidates")
    base = F.col("base")
    before = lambda c: F.substr(t, F.greatest(c["start"] - CONTEXT, F.lit(0)) + 1, F.least(c["start"], F.lit(CONTEXT)))
    own = F.filter("candidates", lambda c: ~before(c).rlike(ALLOWED_BEFORE) & ~F.exists(base, lambda b: (b["start"] <= c["start"]) & (b["end"] >= c["end"])))
    rows = rows.select("doc_id", "n_assign", "n_access", "n_hex", "base", F.array_sort(F.concat(base, own)).alias("found"))
    names = F.array(*map(F.lit, KINDS))
    shown = lambda a: F.array_join(F.transform(a, lambda d: F.concat_ws(":", F.get(names, d["kind"]), d["start"].cast("string"), d["end"].cast("string"))), ",")
    return rows.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(shown(F.col("base")), 256).alias("base_sha256"), shown(F.col("found")).alias("spans"), "found")
