"""Registered queries of the training-data operators, and SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabforge.llm import (bpe_codec, chat, fingerprints, hard_negatives, jaccard_join, lm_scoring, mixing,
                          quality_rules, secrets, shards, token_counts, warc, whitening)
from tabforge.llm.common import table

WORD_BPE, BYTE_RANKS = "word_bpe_49k.json", "byte_bpe_50k.tiktoken"


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf, "documents"), tokenizer(WORD_BPE))


def op2_bpe_codec(spark: SparkSession, sf: str) -> DataFrame:
    return bpe_codec.round_trip(table(spark, sf, "documents"), tokenizer(WORD_BPE))


def op3_shards(spark: SparkSession, sf: str) -> DataFrame:
    return shards.shard_documents(table(spark, sf, "documents"), 8)


def op4_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents"))


def op5_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf, "documents"))


def op6_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf, "documents"))


def op7_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.scan(table(spark, sf, "documents"))


# a user and an assistant who both say control strings
ODD_CONVERSATION = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op8_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame(ODD_CONVERSATION, "conv_id long, turn long, role string, text string")
    path = tokenizer(BYTE_RANKS)
    return chat.read_back(chat.format_turns(turns.unionByName(odd), path), path)


def op9_lm_scores(spark: SparkSession, sf: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf, "documents"))


def op10_order_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf, "documents"))


def op11_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.round_trip(table(spark, sf, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf, "embeddings"))


def op13_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(table(spark, sf, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_bpe_codec, op3_shards, op4_mix_sources, op5_quality_rules, op6_jaccard_join,
    op7_secret_scan, op8_chat_format, op9_lm_scores, op10_order_minhash, op11_warc,
    op12_hard_negatives, op13_whitening)}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP5_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents
), win AS (
  SELECT rid, i, list_slice(w, i, i + 7) AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1
), rep AS (
  SELECT rid, count(DISTINCT k) AS n FROM (SELECT rid, unnest(range(i, i + 8)) AS k FROM twice) GROUP BY rid
), lines AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT l) AS dup
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid
), m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines
  FROM d LEFT JOIN rep USING (rid) LEFT JOIN lines USING (rid)
), b AS (
  SELECT *, CAST((CASE WHEN n_words < 20 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END) + (CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN 2 * n_words > word_chars THEN 16 ELSE 0 END) + (CASE WHEN word_chars > 14 * n_words THEN 32 ELSE 0 END)
    AS BIGINT) AS fail_bits FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed,
       fail_bits = 0 AS kept, fail_bits, CAST(1 AS INTEGER) AS policy_version FROM b
"""

OP6_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, list_slice(w, i, i + 4) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (g)
                    WHERE x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)
), reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
"""

_CONTROLS = "|".join(c.replace("|", r"\|").replace("[", r"\[").replace("]", r"\]") for c in
                     ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>",
                      "<|endoftext|>", "<|startoftext|>", "<|turn|>", "<|says|>", "<|end|>"))


def _shown(column: str) -> str:
    # one more character for an escape character, two for a control string
    return f"length(regexp_replace(replace({column}, chr(26), 'zz'), '({_CONTROLS})', '\\1zz', 'g'))"


OP8_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(23 + {_shown('role')} + {_shown('text')}) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

# base32 of a SHA-1 from its hex digits: every 5 hex digits are 4 letters
_B32 = """list_aggregate(list_transform(range(0, 8), lambda k: list_aggregate(list_transform(range(0, 4), lambda j:
       substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(CAST('0x' || substr(h, CAST(k * 5 + 1 AS INTEGER), 5) AS BIGINT) // (32768 // (CAST(1 AS BIGINT) << CAST(5 * j AS INTEGER))) % 32 AS INTEGER) + 1, 1)),
       'string_agg', '')), 'string_agg', '')"""

OP11_SQL = f"""
WITH p AS (SELECT row_number() OVER () AS rid, page_id, url, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
r AS (SELECT *, last_value(page_id) OVER w AS top, last_value(rid) OVER w AS top_rid FROM p
      WINDOW w AS (PARTITION BY t ORDER BY page_id NULLS FIRST, rid ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes, {_B32} AS payload_digest,
       CASE WHEN rid = top_rid THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN rid <> top_rid THEN top END AS refers_to FROM r
"""

OP12_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), s AS (
  SELECT a.rid AS arid, a.vec_id AS anchor_id, b.vec_id, b.rid, a.label = b.label AS same,
         CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.rid <> b.rid WHERE a.vec_id % 100 = 0
), p AS (
  SELECT arid, anchor_id, vec_id AS positive_id, rid, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY arid ORDER BY score DESC, vec_id, rid) AS k FROM s WHERE same)
  WHERE k <= 5
), n AS (
  SELECT p.anchor_id, positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.arid, p.rid ORDER BY s.score DESC, s.vec_id, s.rid) AS INTEGER) AS rank
  FROM p JOIN s ON s.arid = p.arid AND NOT s.same
  WHERE 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

ORACLE = {"op5_quality_rules": OP5_SQL, "op6_jaccard_join": OP6_SQL, "op8_chat_format": OP8_SQL,
          "op11_warc": OP11_SQL, "op12_hard_negatives": OP12_SQL}
