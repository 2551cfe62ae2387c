"""Registered jobs of this subpackage: one per operator.

Each job applies its operator, with production parameters, to its whole table
and derives the contract's columns.  ``ORACLE`` holds DuckDB SQL where SQL can
express the result; the other jobs are held against brute force in tests/llm.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wikisift.llm.common import read_table

JOBS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def job(fn):
    JOBS[fn.__name__] = fn
    return fn


@job
def op1_simhash_near_dedup(spark, sf_dir):
    from wikisift.llm.simhash import near_duplicates

    return near_duplicates(read_table(spark, sf_dir, "documents"))


@job
def op2_benchmark_decontamination(spark, sf_dir):
    from wikisift.llm.decontaminate import contamination

    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@job
def op3_line_dedup(spark, sf_dir):
    from wikisift.llm.line_dedup import line_dedup

    return line_dedup(read_table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


ORACLE["op3_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)
), first_holder AS (
  SELECT k, min(doc_id) AS holder FROM l WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT l.*, holder IS NOT NULL AND holder <> doc_id AS gone FROM l LEFT JOIN first_holder USING (k)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@job
def op10_quality_rules(spark, sf_dir):
    from wikisift.llm.quality_rules import quality_rules

    return quality_rules(read_table(spark, sf_dir, "documents"))


@job
def op4_license_scan(spark, sf_dir):
    from wikisift.llm.license_scan import scan_licenses

    return scan_licenses(read_table(spark, sf_dir, "documents")).drop("detections")


@job
def op5_packing(spark, sf_dir):
    from wikisift.llm.packing import pack

    return pack(read_table(spark, sf_dir, "documents"))


@job
def op6_secret_scan(spark, sf_dir):
    from wikisift.llm.secret_scan import scan_secrets

    return scan_secrets(read_table(spark, sf_dir, "documents")).drop("found")


@job
def op7_html_extraction(spark, sf_dir):
    from wikisift.llm.html_text import extract

    return extract(read_table(spark, sf_dir, "pages"))


@job
def op8_quality_classifier(spark, sf_dir):
    from wikisift.llm.quality_model import classify

    return classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@job
def op9_chat_formatting(spark, sf_dir):
    from wikisift.llm.chat import conversation_digests, format_turns

    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_digests(format_turns(rows.unionByName(extra)))


# The length of an escaped text: every control string becomes two characters.
_ESCAPED = "length(t) + length(t) - length(replace(t, chr(9243), ''))" + "".join(
    f" + (2 - {len(s)}) * ((length(t) - length(replace(t, '{s}', ''))) // {len(s)})"
    for s in ("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[/ROLE]", "[TURN]", "[/TURN]"))

ORACLE["op9_chat_formatting"] = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, {_ESCAPED} + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE 26 + length(role) END AS shown FROM c
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, role, t)) AS turns_sha256,
       (coalesce(sum(length(t)) FILTER (WHERE role = 'assistant'), 0))::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, role, t) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(shown)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


@job
def op11_merkle_manifest(spark, sf_dir):
    from wikisift.llm.manifest import audit

    return audit(read_table(spark, sf_dir, "documents"))


def _sql_field(name: str) -> str:
    text = f"CAST({name} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _sql_leaf(n_chars: str = "n_chars") -> str:
    return "sha256(" + " || ".join(map(_sql_field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


# CRC-32 of a decimal number's characters: each is taken in, then eight shifts.
_SQL_CRC = """list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
      lambda c: list_prepend(ord(c)::BIGINT, [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END)"""

ORACLE["op11_merkle_manifest"] = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_sql_leaf()} AS leaf,
         CASE WHEN xor({_SQL_CRC}, 4294967295::BIGINT) % 7 = 0 THEN {_sql_leaf("(CAST(n_chars AS HUGEINT) + 1)")} END AS tampered FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM leaves
), nodes AS (
  SELECT lang, n, 0 AS level, pos, leaf AS h FROM placed
  UNION ALL
  SELECT lang, n, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM nodes WHERE (1::BIGINT << level) < n GROUP BY lang, n, level, pos // 2
), subroots AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE pos = 0 AND (1::BIGINT << level) >= n
), tops AS (
  SELECT n, 0 AS level, pos, subroot AS h FROM subroots
  UNION ALL
  SELECT n, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM tops WHERE (1::BIGINT << level) < n GROUP BY n, level, pos // 2
), own AS (
  SELECT p.doc_id, p.lang, p.leaf, p.pos, coalesce(tampered, leaf) AS start, s.subroot, s.pos AS sub_pos, t.h AS root
  FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang, (SELECT h FROM tops WHERE (1::BIGINT << level) >= n) t
), siblings AS (
  SELECT doc_id, o.lang, o.pos, 0 AS part, k.level, k.h, (o.pos >> k.level) & 1 AS left_of
  FROM own o JOIN nodes k ON o.lang IS NOT DISTINCT FROM k.lang AND k.pos = xor(o.pos >> k.level, 1)
  UNION ALL
  SELECT doc_id, o.lang, o.pos, 1, k.level, k.h, (o.sub_pos >> k.level) & 1 FROM own o JOIN tops k ON k.pos = xor(o.sub_pos >> k.level, 1)
), has AS (
  -- a node whose run has no sibling is hashed alone
  SELECT o.lang, o.pos, 0 AS part, g AS level FROM own o JOIN (SELECT DISTINCT lang, n FROM placed) z ON o.lang IS NOT DISTINCT FROM z.lang, range(62) r(g) WHERE (1::BIGINT << g) < z.n
  UNION ALL
  SELECT o.lang, o.pos, 1, g FROM own o, (SELECT DISTINCT n FROM subroots) z, range(62) r(g) WHERE (1::BIGINT << g) < z.n
), steps AS (
  SELECT h.lang, h.pos, row_number() OVER (PARTITION BY h.lang, h.pos ORDER BY h.part, h.level) AS step, s.h, s.left_of
  FROM has h LEFT JOIN siblings s ON s.lang IS NOT DISTINCT FROM h.lang AND s.pos = h.pos AND s.part = h.part AND s.level = h.level
), folded AS (
  SELECT lang, pos, 0::BIGINT AS step, start AS h FROM own
  UNION ALL
  SELECT f.lang, f.pos, s.step, sha256(CASE WHEN s.h IS NULL THEN f.h WHEN s.left_of = 1 THEN s.h || f.h ELSE f.h || s.h END)
  FROM folded f JOIN steps s ON s.lang IS NOT DISTINCT FROM f.lang AND s.pos = f.pos AND s.step = f.step + 1
), proofs AS (
  SELECT lang, pos, sha256(coalesce(string_agg(h, '' ORDER BY step) FILTER (WHERE h IS NOT NULL), '')) AS proof_sha256, max(step) AS steps FROM steps GROUP BY lang, pos
)
SELECT o.doc_id, o.leaf, o.subroot, o.root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = o.root AS verified
FROM own o LEFT JOIN proofs p ON p.lang IS NOT DISTINCT FROM o.lang AND p.pos = o.pos
JOIN folded f ON f.lang IS NOT DISTINCT FROM o.lang AND f.pos = o.pos AND f.step = coalesce(p.steps, 0)
"""


@job
def op12_token_counts(spark, sf_dir):
    from wikisift.llm.token_counts import token_counts

    return token_counts(read_table(spark, sf_dir, "documents"))


@job
def op13_ranked_search(spark, sf_dir):
    from wikisift.llm.reversed_search import search

    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


ORACLE["op13_ranked_search"] = r"""
WITH doc_terms AS (
  SELECT row_number() OVER () AS uid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS t FROM documents
), item_terms AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term FROM benchmark
), totals AS (
  SELECT count(*)::BIGINT AS big_n, sum(len(t))::BIGINT AS big_l FROM doc_terms WHERE len(t) > 0
), counts AS (
  SELECT uid, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT uid, doc_id, len(t)::BIGINT AS n, unnest(t) AS term FROM doc_terms) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * big_n + 2) / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), totals
), scores AS (
  SELECT item_id, uid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * big_n) // big_l))))::BIGINT AS score
  FROM item_terms JOIN weights USING (term) JOIN counts USING (term), totals GROUP BY ALL
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0
) WHERE rank <= 10
"""
