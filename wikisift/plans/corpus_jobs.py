"""Registered corpus jobs over ``documents`` / ``conversations``."""

from __future__ import annotations

from pyspark.sql import functions as F

from wikisift.functions.text import ABBREVIATIONS
from wikisift.operators import corpus as C
from wikisift.plans.catalog import register
from wikisift.session import arriving_files, scratch_path, table, text_table
from wikisift.sources import text as TX

# --- shared oracle fragments (DuckDB) -------------------------------------
# White space and word characters, spelled out for RE2.
SQL_WS = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
SQL_TOKENS = r"""regexp_extract_all(sentence, '[\p{L}\p{M}\p{N}_]+(?:[-''][\p{L}\p{M}\p{N}_]+)*|[^\p{L}\p{M}\p{N}_WS]')""".replace("WS", SQL_WS)


def sql_paras(name: str, source: str, key: str, extra: str = "") -> str:
    """Paragraph rows: position in the newline split, stripped, non-blank."""
    return f"""
{name} AS (
  SELECT doc_id, par_no, text{extra} FROM (
    SELECT doc_id{extra}, i AS par_no, regexp_replace(l[i + 1], '^[{SQL_WS}]+|[{SQL_WS}]+$', '', 'g') AS text
    FROM (SELECT {key} AS doc_id{extra}, string_split(text, chr(10)) AS l FROM {source}) d,
         unnest(range(len(d.l))) AS r(i)
  ) WHERE text <> ''
)"""


def sql_guard(language: str) -> str:
    """The points of abbreviations and single capitals replaced by chr(1)."""
    words = "|".join(w.replace(".", "\\.") for w in ABBREVIATIONS[language].split())
    return rf"regexp_replace(text, '(^|[^\p{{L}}\p{{M}}\p{{N}}_])({words}|\p{{Lu}})\.', '\1\2' || chr(1), 'g')"


def sql_sents(name: str, toks: str, paras: str, guarded: str) -> str:
    return f"""
{name} AS (
  SELECT doc_id, par_no, j AS sent_no, replace(s[j + 1], chr(1), '.') AS sentence FROM (
    SELECT doc_id, par_no, string_split(regexp_replace({guarded}, '([.!?])[{SQL_WS}]+', '\\1' || chr(2), 'g'), chr(2)) AS s
    FROM {paras}
  ) p, unnest(range(len(p.s))) AS r(j)
),
{toks} AS (SELECT doc_id, par_no, sent_no, {SQL_TOKENS} AS tokens FROM {name})"""


SQL_PARAS = sql_paras("paras", "documents", "doc_id", ", lang")
_BY_LANGUAGE = ("CASE upper(lang) " + " ".join(f"WHEN '{code}' THEN {sql_guard(name)}" for code, _, name in C.LANGUAGE_ROUTES[1:])
                + f" ELSE {sql_guard('english')} END")
SQL_SENTS = SQL_PARAS + "," + sql_sents("sents", "toks", "paras", _BY_LANGUAGE)


def docs(spark, sf_dir):
    return text_table(spark, sf_dir, "documents", "doc_id")


@register(
    "vocabulary",
    "WITH "
    + SQL_SENTS
    + """
SELECT word, count(*) AS count FROM (SELECT unnest(tokens) AS word FROM toks)
GROUP BY word HAVING count(*) >= 10""",
)
def q_vocabulary(spark, sf_dir):
    return C.vocabulary(C.corpus(docs(spark, sf_dir)), min_count=10)


@register(
    "strip_blank_lines",
    "WITH " + SQL_PARAS + " SELECT doc_id, par_no, text FROM paras",
)
def q_strip_blank_lines(spark, sf_dir):
    return C.strip_blank_lines(docs(spark, sf_dir))


@register(
    "sentence_split",
    "WITH " + SQL_SENTS + " SELECT doc_id, par_no, sent_no, sentence FROM sents",
)
def q_sentence_split(spark, sf_dir):
    from wikisift.functions.text import sentence_split

    p = C.strip_blank_lines(docs(spark, sf_dir).withColumn("language", C.tokenizer_language("lang")), keep=("language",))
    return p.select("doc_id", "par_no", F.posexplode(sentence_split("text", "language")).alias("sent_no", "sentence"))


SQL_ABBREVIATIONS = r"""
words AS (SELECT CASE upper(lang) ROUTES ELSE 'english' END AS language, unnest(regexp_extract_all(lower(text), '[\p{L}\p{M}]+(?:\.[\p{L}\p{M}]+)*\.?')) AS word FROM documents),
types AS (
  SELECT language, rtrim(word, '.') AS type, count(*) FILTER (WHERE word LIKE '%.') AS a, count(*) FILTER (WHERE word NOT LIKE '%.') AS b FROM words GROUP BY ALL
),
totals AS (SELECT language, sum(a) / sum(a + b) AS p FROM types GROUP BY language),
scores AS (
  SELECT language, type, a AS with_point, b AS without_point,
    -2.0 * (a * ln(p) + CASE WHEN b > 0 THEN b * ln(1 - p) ELSE 0 END - (a * ln(0.99::DOUBLE) + b * ln(1 - 0.99::DOUBLE)))
    * exp(-(length(type) - (length(type) - length(replace(type, '.', ''))))) * (length(type) - length(replace(type, '.', '')) + 1)
    * pow(length(replace(type, '.', ''))::DOUBLE, -b) AS score
  FROM types JOIN totals USING (language) WHERE a > 0
)""".replace("ROUTES", " ".join(f"WHEN '{code}' THEN '{name}'" for code, _, name in C.LANGUAGE_ROUTES))


@register("abbreviation_scores", "WITH " + SQL_ABBREVIATIONS + " SELECT language, type, with_point, without_point, round(score, 6) + 0.0 AS score FROM scores")
def q_abbreviation_scores(spark, sf_dir):
    """The learned score of every word that ends in a point somewhere."""
    scores = C.abbreviation_scores(docs(spark, sf_dir))
    return scores.withColumn("score", F.round("score", 6) + 0.0)  # no minus zero


@register("learn_abbreviations", "WITH " + SQL_ABBREVIATIONS + " SELECT language, type FROM scores WHERE score >= 0.3")
def q_learn_abbreviations(spark, sf_dir):
    """The words that the corpus shows to be abbreviations, by language."""
    return C.learn_abbreviations(docs(spark, sf_dir))


@register(
    "word_tokenize",
    "WITH "
    + SQL_SENTS
    + """
SELECT doc_id, par_no, sent_no, len(tokens) AS n_tokens, array_to_string(tokens, chr(31)) AS joined FROM toks""",
)
def q_word_tokenize(spark, sf_dir):
    s = C.corpus(docs(spark, sf_dir))
    return s.select(
        "doc_id", "par_no", "sent_no", F.size("tokens").cast("bigint").alias("n_tokens"), F.array_join("tokens", "\u001f").alias("joined")
    )


@register(
    "case_fold",
    "WITH "
    + SQL_SENTS
    + """
SELECT doc_id, par_no, sent_no, lower(array_to_string(tokens, ' ')) AS line FROM toks""",
)
def q_case_fold(spark, sf_dir):
    s = C.corpus(docs(spark, sf_dir), ignore_case=True)
    return C.sentence_lines(s)


@register(
    "corpus",
    "WITH " + SQL_SENTS + " SELECT doc_id, par_no, sent_no, array_to_string(tokens, ' ') AS line FROM toks",
)
def q_corpus(spark, sf_dir):
    return C.sentence_lines(C.corpus(docs(spark, sf_dir)))


@register(
    "sink_sentences",
    "WITH " + SQL_SENTS + " SELECT array_to_string(tokens, ' ') AS line FROM toks",
)
def q_sink_sentences(spark, sf_dir):
    """The sentence files, written and read back as lines."""
    path = scratch_path(spark, "sentences")
    TX.write_sentences(C.corpus(docs(spark, sf_dir)), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@register(
    "load_sentences",
    "WITH "
    + SQL_SENTS
    + r""",
lines AS (SELECT array_to_string(tokens, ' ') AS line FROM toks)
SELECT line, CASE WHEN trim(line) = '' THEN 0 ELSE len(string_split_regex(trim(line), '\s+')) END AS n_tokens
FROM lines""",
)
def q_load_sentences(spark, sf_dir):
    """Written sentence files parsed back into token lists."""
    path = scratch_path(spark, "sentences")
    TX.write_sentences(C.corpus(docs(spark, sf_dir)), path)
    return TX.read_sentences(spark, path).select("line", F.size("tokens").cast("bigint").alias("n_tokens"))


@register(
    "corpus_stats",
    "WITH "
    + SQL_SENTS
    + """
SELECT (SELECT count(*) FROM documents) AS files,
       (SELECT count(*) FROM paras) AS paragraphs,
       (SELECT count(*) FROM sents) AS sentences,
       (SELECT CAST(sum(len(tokens)) AS BIGINT) FROM toks) AS tokens""",
)
def q_corpus_stats(spark, sf_dir):
    return C.corpus_stats(docs(spark, sf_dir))


@register(
    "language_route",
    """
SELECT doc_id, lang,
       CASE WHEN upper(lang) IN ('EN','ES','FR','DE','IT','PT') THEN upper(lang) ELSE 'EN' END AS language,
       lower(CASE WHEN upper(lang) IN ('EN','ES','FR','DE','IT','PT') THEN upper(lang) ELSE 'EN' END) || 'wiki' AS dump_name,
       CASE CASE WHEN upper(lang) IN ('EN','ES','FR','DE','IT','PT') THEN upper(lang) ELSE 'EN' END
         WHEN 'EN' THEN 'english' WHEN 'ES' THEN 'spanish' WHEN 'FR' THEN 'french'
         WHEN 'DE' THEN 'german' WHEN 'IT' THEN 'italian' ELSE 'portuguese' END AS tokenizer_language
FROM documents""",
)
def q_language_route(spark, sf_dir):
    return C.language_route(docs(spark, sf_dir).select("doc_id", "lang"))


@register(
    "concat_corpora",
    "WITH "
    + SQL_SENTS
    + ","
    + sql_paras("conv_paras", "conversations", "conv_id * 1000 + turn")
    + ","
    + sql_sents("conv_sents", "conv_toks", "conv_paras", sql_guard("english"))
    + """
SELECT 'documents' AS corpus, doc_id, par_no, sent_no, array_to_string(tokens, ' ') AS line FROM toks
UNION ALL
SELECT 'conversations' AS corpus, doc_id, par_no, sent_no, array_to_string(tokens, ' ') AS line FROM conv_toks""",
)
def q_concat_corpora(spark, sf_dir):
    d = C.sentence_lines(C.corpus(docs(spark, sf_dir))).withColumn("corpus", F.lit("documents"))
    conv = table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), "text"
    )
    c = C.sentence_lines(C.corpus(conv)).withColumn("corpus", F.lit("conversations"))
    return C.concat_corpora(d, c)


# ------------------------------------------------------------ streaming --
def _stream_of(spark, sf_dir):
    """(folder, files a batch): the documents as a directory of several files, which arrive file by file."""
    path = scratch_path(spark, "arriving")
    d = table(spark, sf_dir, "documents")
    files, each = arriving_files(d)
    d.repartition(files).write.parquet(path)
    return path, each


@register(
    "stream_vocabulary",
    "WITH " + SQL_SENTS + """
SELECT word, count(*) AS count FROM (SELECT unnest(tokens) AS word FROM toks) GROUP BY word""",
)
def q_stream_vocabulary(spark, sf_dir):
    """A1 as a stream: running counts kept in state over the batches of a file stream."""
    from wikisift.streaming.corpus_stream import read_documents_stream, run_vocabulary_once

    path, each = _stream_of(spark, sf_dir)
    return run_vocabulary_once(read_documents_stream(spark, path, max_files=each))
