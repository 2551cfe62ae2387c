"""Corpus section: paragraphs, sentences, tokens, vocabulary, statistics.

P6 strip_blank_lines, X1-X4 sentence/word split, S8/S9 sentence lines, A1
vocabulary, A2 corpus statistics, J5 vocabulary encoding, P9 language routing,
U1 corpus union.

Plan shape at scale: every step up to the vocabulary is narrow (explode and
per-row expressions on file splits).  The vocabulary is one hash aggregation
on the word with map-side partial counts, so a hot word (``the``, ``,``) is
reduced inside each task before the shuffle and never skews a reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wikisift.functions.text import (
    WHITE,
    case_fold,
    col_of,
    guard_points,
    pystrip,
    sentence_split,
    split_lines,
    word_tokenize,
)

# The language table of the reference driver (code -> dump name,
# sentence tokenizer language); anything else is routed to EN.
LANGUAGE_ROUTES = [
    ("EN", "enwiki", "english"),
    ("ES", "eswiki", "spanish"),
    ("FR", "frwiki", "french"),
    ("DE", "dewiki", "german"),
    ("IT", "itwiki", "italian"),
    ("PT", "ptwiki", "portuguese"),
]


def tokenizer_language(lang) -> Column:
    """The tokenizer language of a language code (English for others)."""
    names = F.create_map(*[x for code, _, name in LANGUAGE_ROUTES for x in (F.lit(code), F.lit(name))])
    return F.coalesce(F.try_element_at(names, F.upper(col_of(lang))), F.lit("english"))


def strip_blank_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple = ()) -> DataFrame:
    """One row per stripped, non-blank line: (key, par_no, text, *keep).

    ``par_no`` is the line's position in the original text (0-based), a
    stable paragraph key that needs no global numbering.
    """
    return (
        docs.select(key, *keep, F.posexplode(split_lines(text)).alias("par_no", "raw"))
        .select(key, "par_no", pystrip("raw").alias("text"), *keep)
        .where(F.col("text") != "")
    )


def sentences(paragraphs: DataFrame, key: str = "doc_id", ignore_case: bool = False, language=None) -> DataFrame:
    """X1+X2(+X3): (key, par_no, sent_no, tokens array<string>)."""
    s = paragraphs.select(key, "par_no", F.posexplode(sentence_split("text", language)).alias("sent_no", "sentence"))
    toks = word_tokenize("sentence")
    if ignore_case:
        toks = case_fold(toks)
    return s.select(key, "par_no", "sent_no", toks.alias("tokens"))


#: Vocabulary up to which it is broadcast to the tokens (about 20 MB).
BROADCAST_WORDS = 200_000
#: Words as the learned rule counts them: letters, points inside, at most one behind.
DOTTED = r"[\p{L}\p{M}]+(?:\.[\p{L}\p{M}]+)*\.?"
#: Score from which a word is an abbreviation.
LEARNED_SCORE = 0.3


def abbreviation_scores(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """X1, learned: (language, type, with_point, without_point, score) of every lower-cased
    word that ends in a point somewhere in the corpus.

    The score is Kiss and Strunk's (2006): how much likelier the counts are if the point
    belongs to the word (0.99) than if points fall by chance, times exp(-letters), times points, times
    letters ** -without_point.  Words are counted by one hash aggregate over the documents,
    combined in each task, so that frequent words are no hot key; a language's totals are a few rows.
    """
    language = tokenizer_language(lang) if lang in docs.columns else F.lit("english")
    words = docs.select(language.alias("language"), F.explode(F.regexp_extract_all(F.lower(text), F.lit(DOTTED), F.lit(0))).alias("word"))
    pointed = F.endswith("word", F.lit("."))
    types = words.groupBy("language", F.regexp_replace("word", r"\.$", "").alias("type")).agg(
        F.sum(pointed.cast("long")).alias("with_point"), F.sum((~pointed).cast("long")).alias("without_point"))
    totals = types.groupBy("language").agg(F.sum("with_point").alias("points"), F.sum(F.col("with_point") + F.col("without_point")).alias("words"))
    a, n = F.col("with_point").cast("double"), (F.col("with_point") + F.col("without_point")).cast("double")
    chance = F.col("points") / F.col("words")
    # where every word has its point the chance hypothesis has no other outcome
    by_chance = a * F.log(chance) + F.when(n > a, (n - a) * F.log(1 - chance)).otherwise(0.0)
    likelier = -2.0 * (by_chance - (a * F.log(F.lit(0.99)) + (n - a) * F.log(F.lit(1 - 0.99))))
    inner = F.length("type") - F.length(F.replace("type", F.lit("."), F.lit("")))
    letters = (F.length("type") - inner).cast("double")
    score = likelier * F.exp(-letters) * (inner + 1) * F.pow(letters, -F.col("without_point").cast("double"))
    return types.where("with_point > 0").join(totals, "language").select("language", "type", "with_point", "without_point", score.alias("score"))


def learn_abbreviations(docs: DataFrame, text: str = "text", lang: str = "lang", least: float = LEARNED_SCORE) -> DataFrame:
    """(language, type) of the words that the corpus shows to be abbreviations."""
    return abbreviation_scores(docs, text, lang).where(F.col("score") >= least).select("language", "type")


def _with_learned(docs: DataFrame, learned: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` (with _language) and _learned: the abbreviations that occur in the text.

    The documents' own pointed words are joined, not the other way round, so that the
    learned table may be of any size; texts do not move but in the join back.
    """
    from wikisift.session import cut_lineage

    rows = cut_lineage(docs).withColumn("_row", F.monotonically_increasing_id())
    pointed = F.filter(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(DOTTED), F.lit(0))), lambda w: F.endswith(w, F.lit(".")))
    words = rows.select("_row", F.col("_language").alias("language"), F.explode(F.transform(pointed, lambda w: F.regexp_replace(w, r"\.$", ""))).alias("type"))
    own = words.join(learned, ["language", "type"], "left_semi").groupBy("_row").agg(F.collect_set("type").alias("_learned"))
    return rows.join(own, "_row", "left").withColumn("_learned", F.coalesce("_learned", F.array().cast("array<string>"))).drop("_row")


def corpus(docs: DataFrame, key: str = "doc_id", text: str = "text", ignore_case: bool = False, lang: str = "lang", learned: DataFrame | None = None) -> DataFrame:
    """Documents -> tokenised sentences, end to end.  A ``lang`` column, where
    there is one, chooses the sentence rules; ``learned`` (:func:`learn_abbreviations`)
    adds abbreviations to the fixed ones."""
    if learned is not None:
        routed = docs.withColumn("_language", tokenizer_language(lang) if lang in docs.columns else F.lit("english"))
        known = _with_learned(routed, learned, key, text)
        paragraphs = strip_blank_lines(known, key, text, ("_language", "_learned"))
        guarded = paragraphs.withColumn("text", guard_points("text", DOTTED, F.col("_learned")))
        return sentences(guarded, key, ignore_case, F.col("_language"))
    if lang not in docs.columns:
        return sentences(strip_blank_lines(docs, key, text), key, ignore_case)
    routed = docs.withColumn("_language", tokenizer_language(lang))
    return sentences(strip_blank_lines(routed, key, text, ("_language",)), key, ignore_case, F.col("_language"))


def write_corpus(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", lang: str = "lang") -> dict:
    """Write the tokenised sentences; files, paragraphs and sentences are counted by
    observations of that one pass."""
    from pyspark.sql import Observation

    files, paragraphs, sents = Observation("files"), Observation("paragraphs"), Observation("sentences")
    count = F.count(F.lit(1)).alias("n")
    language = tokenizer_language(lang) if lang in docs.columns else F.lit("english")
    p = strip_blank_lines(docs.observe(files, count).withColumn("_language", language), key, text, ("_language",)).observe(paragraphs, count)
    sentences(p, key, language=F.col("_language")).observe(sents, count).write.parquet(path)
    return {"files": files.get["n"], "paragraphs": paragraphs.get["n"], "sentences": sents.get["n"]}


def sentence_lines(sents: DataFrame) -> DataFrame:
    """The sentence file's line: tokens joined by one space."""
    return sents.select(*[c for c in sents.columns if c != "tokens"], F.array_join("tokens", " ").alias("line"))


def parse_sentence_line(line) -> Column:
    """A sentence line back to tokens (whitespace split; blank -> [])."""
    t = pystrip(line)
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, f"[{WHITE}]+"))


def vocabulary(sents: DataFrame, min_count: int = 10, tokens: str = "tokens") -> DataFrame:
    """A1: (word, count) for tokens seen at least ``min_count`` times."""
    return (
        sents.select(F.explode(tokens).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("count"))
        .where(F.col("count") >= min_count)
    )


def vocabulary_with_ids(vocab: DataFrame) -> DataFrame:
    """Dense word ids 0..V-1, most frequent first (ties by word).

    Numbered by a range-partitioned sort plus per-partition offsets (see
    ``ordering.dense_index``), never by a single-task global window.
    """
    from wikisift.operators.ordering import dense_index

    ranked = vocab.withColumn("_neg", -F.col("count"))
    return dense_index(ranked, ["_neg", "word"], "word_id").drop("_neg").withColumn("word_id", F.col("word_id").cast("int"))


def vocab_encode(sents: DataFrame, vocab: DataFrame, key: str = "doc_id") -> DataFrame:
    """Keep in-vocabulary tokens and map them to ids.

    Exploded tokens are joined to the vocabulary on the word.  A vocabulary counted at
    up to ``BROADCAST_WORDS`` is broadcast, so that the tokens do not move (Spark does not know the
    size of a checkpointed vocabulary); a larger one is a shuffled join (AQE splits skewed words).
    """
    toks = sents.select(key, "par_no", "sent_no", F.posexplode("tokens").alias("pos", "word"))
    words = vocab.select("word", "word_id")
    if words.count() <= BROADCAST_WORDS:
        words = F.broadcast(words)
    return toks.join(words, "word", "inner")


def corpus_stats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A2: files, paragraphs, sentences and tokens in one scan.

    Per document the counts are computed with higher-order functions over the
    text's arrays (no explode, no shuffle); only the final one-row sum is an
    aggregation, done partially in every task.
    """
    paras = F.filter(F.transform(split_lines(text), lambda p: pystrip(p)), lambda p: p != "")
    language = tokenizer_language("lang") if "lang" in docs.columns else None
    per_doc = docs.select(
        F.size(paras).alias("n_par"),
        F.aggregate(paras, F.lit(0).cast("bigint"), lambda acc, p: acc + F.size(sentence_split(p, language))).alias("n_sent"),
        F.aggregate(
            paras,
            F.lit(0).cast("bigint"),
            lambda acc, p: acc
            + F.aggregate(sentence_split(p, language), F.lit(0).cast("bigint"), lambda a2, s: a2 + F.size(word_tokenize(s))),
        ).alias("n_tok"),
    )
    return per_doc.agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("n_par").cast("bigint").alias("paragraphs"),
        F.sum("n_sent").cast("bigint").alias("sentences"),
        F.sum("n_tok").cast("bigint").alias("tokens"),
    )


def language_route(df: DataFrame, lang: str = "lang") -> DataFrame:
    """Language code -> (language, dump_name, tokenizer_language).

    Six fixed routes live in a literal map expression, so the lookup is a
    per-row map access with no join at all.
    """
    code = F.upper(col_of(lang))
    known = F.create_map(*[x for r in LANGUAGE_ROUTES for x in (F.lit(r[0]), F.lit(r[0]))])
    dumps = F.create_map(*[x for r in LANGUAGE_ROUTES for x in (F.lit(r[0]), F.lit(r[1]))])
    toks = F.create_map(*[x for r in LANGUAGE_ROUTES for x in (F.lit(r[0]), F.lit(r[2]))])
    routed = F.coalesce(F.element_at(known, code), F.lit("EN"))
    return df.select(
        "*",
        routed.alias("language"),
        F.element_at(dumps, routed).alias("dump_name"),
        F.element_at(toks, routed).alias("tokenizer_language"),
    )


def concat_corpora(*frames: DataFrame) -> DataFrame:
    """Bag union of sentence corpora (by column name)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
