"""Operator 10: base quality rules and robust multivariate outliers.

Every text gives a vector of transformed statistics.  Per language and source
a minimum-covariance-determinant (MCD) estimate of location and scatter is
computed over ALL rows by concentration steps ("C-steps"): each step keeps the
``h`` share of rows nearest in Mahalanobis distance and takes their mean and covariance.
There are three starts (medians and MADs; means and covariances of all rows; the same of the rows
within two MADs of the medians in every statistic).  After two steps each, a group goes on from the start of
the smallest determinant until no group's determinant falls any more.  A step is two hash
aggregates over the narrow statistics table (a percentile sketch and
moment sums, both combined within tasks before they shuffle; a group's parameters
come to its rows by a size-checked broadcast or a salted join, so a source with a
third of all rows fills no task).  Rows beyond ``CUTOFF`` squared
Mahalanobis distance are rejected.

Defined results: null text = no words (base rules fail, not kept); null lang or
source = a value of its own; a group with under ``MIN_GROUP`` usable rows is
pooled by language, then with all other small pools; constant statistics meet the
variance floor; very long texts are read whole; equal distances share a verdict; repeated rows
each get a row; an empty table gives none.  Only doc_id, text, lang and
source are read, so other columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wikisift.llm.common import WHITE, bounded_batches, drop_scratch, scratch
from wikisift.session import cut_lineage

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Share of a group's rows that the MCD estimate rests on, C-steps of each start, and the
#: relative fall of a determinant that is none.
H_SHARE = 0.75
START_STEPS, STILL = 2, 1e-6
#: Groups with fewer rows than this are pooled.
MIN_GROUP = 100
#: Squared robust distance beyond which a row is an outlier.  Chi-square with
#: seven degrees of freedom has its 1 - 1e-12 quantile at 71.
CUTOFF = 71.0

_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_MARKS = b"!?;:\"'()[]{}@^_~`=+\\/-"
_WHITE = WHITE.encode()

#: Transformed statistics and, for each, the smallest standard deviation that
#: the scatter estimate may take.  Most statistics are square roots of shares;
#: the floor stops a group whose statistic never varies from rejecting a
#: document for one symbol or one repeated line.  Each can reject alone: a value
#: CUTOFF ** 0.5 = 8.4 floors from the centre is in its range.
FLOORS = {
    "f_wordlen": 0.08,
    "f_symbols": 0.03,
    "f_duplines": 0.1,
    "f_repeat": 0.08,
    "f_upper": 0.04,
    "f_digits": 0.05,
    "f_marks": 0.05,
}
NAMES = list(FLOORS)
P = len(NAMES)

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks"]
STATS_TYPE = T.StructType([T.StructField(c, T.LongType(), False) for c in STATS])


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more (all copies count).

    Words become integers and windows one 63-bit key; a text with over two
    million different words numbers its word pairs first, which is as exact.
    """
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    v = len(number)
    pair = ids[:-1] * v + ids[1:]
    if v >= 2_000_000:
        pair = np.unique(pair, return_inverse=True)[1].astype(np.int64)
    key = pair[:-1] * v + ids[2:]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= twice
    return int(covered.sum())


def text_stats(raw: bytes) -> tuple[int, ...]:
    """The statistics of one text (UTF-8), in the order of ``STATS``."""
    words = raw.split()
    held = raw.translate(None, _WHITE)
    # code points = bytes that do not continue a character
    word_chars = len(held) - int(np.count_nonzero((np.frombuffer(held, np.uint8) & 0xC0) == 0x80))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    drop = lambda chars: len(held) - len(held.translate(None, chars))
    return (len(words), word_chars, drop(_SYMBOLS), len(lines) - len(set(lines)), repeated_words(words),
            len(lines), drop(_UPPER), drop(_DIGITS), drop(_MARKS))


def _stats_array(texts: pa.Array) -> pa.Array:
    rows = [text_stats(x or b"") for x in texts.cast(pa.binary()).to_pylist()]
    cols = list(zip(*rows)) if rows else [[] for _ in STATS]
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in cols], fields=[pa.field(c, pa.int64(), False) for c in STATS])


# non-deterministic to the optimizer, so that a filter on the statistics is not
# moved below them with a second copy of the function
stats_udf = F.arrow_udf(_stats_array, STATS_TYPE).asNondeterministic()


def features() -> dict[str, Column]:
    """The transformed statistics as columns over ``STATS``."""
    share = lambda a, b: F.sqrt(F.least(F.lit(1.0), F.col(a) / F.greatest(F.col(b), F.lit(1))))
    return {
        "f_wordlen": F.log(F.greatest(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)), F.lit(1.0))),
        "f_symbols": share("n_symbols", "word_chars"),
        "f_duplines": share("n_dup_lines", "n_lines"),
        "f_repeat": share("n_repeat_words", "n_words"),
        "f_upper": share("n_upper", "word_chars"),
        "f_digits": share("n_digits", "word_chars"),
        "f_marks": share("n_marks", "word_chars"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def document_stats(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, ``STATS``, base_failed and features of each row.

    base_failed rows have no say in the estimates: they are rejected anyway.
    """
    bounded_batches(docs.sparkSession)
    out = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
                      stats_udf(F.col("text").cast("string")).alias("s")).select("doc_id", "lang", "source", "s.*")
    return with_features(out)


def with_features(out: DataFrame) -> DataFrame:
    return out.withColumns({"base_failed": base_failed(), **features()})


def _key(*cols: str) -> Column:
    """A non-null string key; a null value differs from every string."""
    return F.to_json(F.array(*cols))


def _grouped(stats: DataFrame) -> DataFrame:
    """Map from (lang, source) to the group its estimate comes from.

    The map has a row per pair; small pairs pool by language, small pools
    with all other small ones.
    """
    pairs = stats.groupBy("lang", "source").agg(F.sum((~F.col("base_failed")).cast("long")).alias("n"))
    pairs = pairs.withColumn("own", F.col("n") >= MIN_GROUP)
    pools = pairs.where(~F.col("own")).groupBy("lang").agg(F.sum("n").alias("n_pool"))
    return (pairs.join(pools.withColumnRenamed("lang", "pool_lang"), F.col("lang").eqNullSafe(F.col("pool_lang")), "left")
            .select(_key("lang", "source").alias("pair"),
                    F.when(F.col("own"), _key("lang", "source")).when(F.col("n_pool") >= MIN_GROUP, _key("lang")).otherwise(F.lit("*")).alias("grp")))


def _distance() -> Column:
    """Squared Mahalanobis distance from columns mu_i and q_i_j (precision)."""
    d = [F.col(n) - F.col(f"mu_{i}") for i, n in enumerate(NAMES)]
    total = F.lit(0.0)
    for i in range(P):
        total = total + d[i] * d[i] * F.col(f"q_{i}_{i}")
        for j in range(i):
            total = total + 2.0 * d[i] * d[j] * F.col(f"q_{i}_{j}")
    return total


def _precision(frames):
    """Rows of (grp, start, mu_i, c_i_j) -> (grp, start, det, mu_i, q_i_j); floors on variances."""
    floor = np.square(np.array(list(FLOORS.values())))
    for pdf in frames:
        if len(pdf):
            cov = np.zeros((len(pdf), P, P))
            for i in range(P):
                for j in range(i + 1):
                    cov[:, i, j] = cov[:, j, i] = pdf[f"c_{i}_{j}"].to_numpy(float)
            cov += np.diag(floor)
            inv = np.linalg.inv(cov)
            pdf.insert(2, "det", np.linalg.slogdet(cov)[1])
            for i in range(P):
                for j in range(i + 1):
                    pdf[f"c_{i}_{j}"] = inv[:, i, j]
        else:
            pdf.insert(2, "det", 0.0)
        yield pdf.rename(columns={c: "q" + c[1:] for c in pdf.columns if c.startswith("c_")})


_MOMENTS = ["grp", "start", *(f"mu_{i}" for i in range(P)), *(f"c_{i}_{j}" for i in range(P) for j in range(i + 1))]
#: ``det``: logarithm of the scatter's determinant.
_PARAMS_TYPE = ", ".join(["grp string", "start int", "det double", *(f"mu_{i} double" for i in range(P)), *(f"q_{i}_{j} double" for i in range(P) for j in range(i + 1))])


def _params(moments: DataFrame) -> DataFrame:
    return cut_lineage(moments.select(*_MOMENTS).mapInPandas(_precision, _PARAMS_TYPE))


def consistency(h: float, p: int = P) -> float:
    """Factor that makes the covariance of the nearest ``h`` share of a normal
    sample estimate the whole one: h / P(chi2(p + 2) <= quantile_h(chi2(p)))."""
    from math import exp, lgamma, log

    def cdf(x, k):
        """Chi-square distribution function: the series of the incomplete gamma function."""
        term = total = exp(k / 2 * log(x / 2) - x / 2 - lgamma(k / 2 + 1)) if x > 0 else 0.0
        i = 1
        while term > 1e-17 * total:
            term *= x / 2 / (k / 2 + i)
            total += term
            i += 1
        return total

    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if cdf(mid, p) < h else (lo, mid)
    return h / cdf(lo, p + 2)


#: Groups up to which their parameters are broadcast (30 numbers each, under
#: 5 MB); beyond, rows and parameters meet in a join over ``SALTS`` shares of a group.
BROADCAST_GROUPS, SALTS = 20_000, 32


def _with_group(rows: DataFrame, per_group: DataFrame, groups: int, how: str = "inner") -> DataFrame:
    """``rows`` (with grp) joined to a table of one row a group.

    Either way no task gets a whole group, and an aggregate that follows
    combines within tasks before it shuffles.
    """
    if groups <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(per_group), "grp", how)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
    copies = per_group.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, ["grp", "salt"], how).drop("salt")


def _paired(stats: DataFrame, pair_map: DataFrame, groups: int) -> DataFrame:
    """``stats`` with grp: the map has a row a pair of language and source."""
    keyed = stats.withColumn("pair", _key("lang", "source"))
    named = pair_map.select(F.col("pair").alias("grp"), F.col("grp").alias("of"))
    return _with_group(keyed.withColumnRenamed("pair", "grp"), named, groups, "left").drop("grp").withColumnRenamed("of", "grp")


def _moments(rows: DataFrame, centre: str, where: Column | None = None) -> list[Column]:
    """Aggregates: mean (m_i) and second moments (s_i_j) of the differences from the
    columns ``centre``_i, so that large means lose no digits."""
    d = [F.col(n) - F.col(f"{centre}_{i}") for i, n in enumerate(NAMES)]
    of = (lambda c: c) if where is None else (lambda c: F.when(where, c))
    return ([F.first(f"{centre}_{i}").alias(f"old_{i}") for i in range(P)] + [F.avg(of(d[i])).alias(f"m_{i}") for i in range(P)]
            + [F.avg(of(d[i] * d[j])).alias(f"s_{i}_{j}") for i in range(P) for j in range(i + 1)])


def _moved(sums: DataFrame, factor: float) -> DataFrame:
    """Centre and scatter from :func:`_moments`."""
    return sums.select("grp", "start", *((F.col(f"old_{i}") + F.col(f"m_{i}")).alias(f"mu_{i}") for i in range(P)),
                       *((factor * (F.col(f"s_{i}_{j}") - F.col(f"m_{i}") * F.col(f"m_{j}"))).alias(f"c_{i}_{j}") for i in range(P) for j in range(i + 1)))


def _starts(rows: DataFrame, groups: int) -> DataFrame:
    """The parameters that the C-steps begin with: a row for each group and start."""
    median = lambda c: F.percentile_approx(c, 0.5, 1000)
    mid = cut_lineage(rows.groupBy("grp").agg(*(median(n).alias(f"mu_{i}") for i, n in enumerate(NAMES))))
    mad = cut_lineage(_with_group(rows, mid, groups).groupBy("grp").agg(*(F.first(f"mu_{i}").alias(f"mu_{i}") for i in range(P)),
                                                                        *(F.pow(1.4826 * median(F.abs(F.col(n) - F.col(f"mu_{i}"))), 2).alias(f"c_{i}_{i}") for i, n in enumerate(NAMES))))
    apart = mad.withColumns({f"c_{i}_{j}": F.lit(0.0) for i in range(P) for j in range(i)}).withColumn("start", F.lit(0))
    near = F.lit(True)
    for (n, floor), i in zip(FLOORS.items(), range(P)):
        near = near & (F.abs(F.col(n) - F.col(f"mu_{i}")) <= 2 * F.sqrt(F.col(f"c_{i}_{i}") + floor * floor))
    held = _with_group(rows, mad, groups)
    whole = _moved(held.groupBy("grp").agg(*_moments(held, "mu")).withColumn("start", F.lit(1)), 1.0)
    inner = _moved(held.groupBy("grp").agg(*_moments(held, "mu", near)).withColumn("start", F.lit(2)), 1.0).where("mu_0 IS NOT NULL")
    return _params(apart.select(*_MOMENTS).unionByName(whole).unionByName(inner))


def _c_step(rows: DataFrame, params: DataFrame, groups: int, factor: float) -> DataFrame:
    """The next parameters of every group and start."""
    near = _with_group(rows, params, groups).withColumn("d2", _distance())
    cut = near.groupBy("grp", "start").agg(F.percentile_approx("d2", H_SHARE, 1000).alias("cut"))
    bounded = cut_lineage(params.join(cut, ["grp", "start"]))
    kept = _with_group(rows, bounded, groups).withColumn("d2", _distance()).where("d2 <= cut")
    return _params(_moved(kept.groupBy("grp", "start").agg(*_moments(kept, "mu")), factor))


def fit(stats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pair -> grp, grp -> location and precision) over all rows of ``stats``.

    ``stats`` should be a written table: it is read by every step.  The two
    results have a row per (lang, source) and per group.
    """
    pair_map = cut_lineage(_grouped(stats))
    groups = pair_map.count()
    rows = _paired(stats.where(~F.col("base_failed")), pair_map, groups).select("grp", *NAMES)
    factor = consistency(H_SHARE)
    params = _starts(rows, groups)
    for _ in range(START_STEPS):
        params = _c_step(rows, params, groups, factor)
    best = params.groupBy("grp").agg(F.min_by("start", F.struct("det", "start")).alias("start"))
    params = cut_lineage(params.join(best, ["grp", "start"]).select(*params.columns))
    while True:
        moved = _c_step(rows, params, groups, factor)
        # a group whose determinant does not fall keeps what it has
        was = params.select("grp", F.col("det").alias("was"))
        fell = cut_lineage(moved.join(was, "grp").where(F.col("det") < F.col("was") - STILL).drop("was"))
        if fell.isEmpty():
            return pair_map, params.drop("start", "det")
        params = cut_lineage(params.join(fell.select("grp"), "grp", "left_anti").select(*fell.columns).unionByName(fell))


def judged(stats: DataFrame, pair_map: DataFrame, params: DataFrame) -> DataFrame:
    """``stats`` plus distance2 and kept.  Rows of a group without an estimate
    (all its rows failed the base rules) are judged by the base rules alone."""
    groups = pair_map.count()
    return (_with_group(_paired(stats, pair_map, groups), params, groups, "left")
            .withColumn("distance2", _distance())
            .withColumn("kept", ~F.col("base_failed") & (F.coalesce(F.col("distance2"), F.lit(0.0)) <= CUTOFF)))


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the base statistics, base_failed, kept, distance2 of every row."""
    spark = docs.sparkSession
    stats = document_stats(docs)
    path = scratch(spark, "quality-stats")
    stats.write.parquet(path)
    stats = spark.read.schema(stats.schema).parquet(path)
    return judged(stats, *fit(stats)).select("doc_id", *STATS[:5], "base_failed", "kept", "distance2")


def keep_good(docs: DataFrame) -> DataFrame:
    """``docs`` without the rejected rows, all columns as they were.

    The estimates are per (lang, source) and small; they come to the rows, so
    no text is shuffled.  Statistics are computed again beside the text instead
    of joining it to a table by an id that may repeat.
    """
    spark = docs.sparkSession
    stats = document_stats(docs)
    path = scratch(spark, "quality-stats")
    stats.write.parquet(path)
    pair_map, params = fit(spark.read.schema(stats.schema).parquet(path))
    drop_scratch(spark, path)
    row = F.struct(*(F.col(c) for c in docs.columns)).alias("row")
    own = (docs.select(row, F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
                       stats_udf(F.col("text").cast("string")).alias("s")).select("row", "lang", "source", "s.*"))
    return judged(with_features(own), pair_map, params).where("kept").select("row.*")
