"""The registered queries of this package, one per operator, with SQL where SQL can say the same."""

from __future__ import annotations

import os
import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import blocks, boosting, chat, fertility, langid, merkle, mixing, neardup, packing, pii, repair, runs, secretscan
from textloom.llm.common import ASCII_LOWER, ASCII_UPPER, stored
from textloom.plans.registry import query
from textloom.session import ensure_checkpoint_dir, table

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{os.urandom(8).hex()}"


_PROBE = "</s>[INST] ok [/INST]"
_SQL_ESCAPED = "regexp_replace(coalesce({}, ''), '" + chat.ESCAPE_PATTERN + r"', '\1\2\\\3', 'g')"

OP1_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{_PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{_PROBE}'),
marked AS (
  SELECT *, CASE WHEN lag(role) OVER w = role THEN 0 ELSE 1 END AS opens,
         length({_SQL_ESCAPED.format("role")}) AS role_chars, length({_SQL_ESCAPED.format("text")}) AS text_chars
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(text_chars + CASE WHEN opens = 1 THEN role_chars + {len(chat.START + chat.TEXT + chat.END)}
                             ELSE {len(chat.TURN)} END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""


@query("op1_chat_format", OP1_SQL)
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(_PROBE).alias("text"))
    return chat.read_digest(chat.format_chats(rows.unionByName(probe))).drop("formatted_bytes")


@query("op2_packing")
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), WORD_TOKENIZER)


@query("op4_token_shards")
def op4_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-shards")
    repair.write_shards(table(spark, sf_dir, "documents"), path, BYTE_TOKENIZER)
    return repair.read_documents(spark.read.schema(repair.SHARD_SCHEMA).parquet(path))


@query("op6_mixing")
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "rate", "copies")


OP9_SQL = f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(text) AS text_sha256
FROM t JOIN g USING (text)
"""


@query("op9_exact_dedup", OP9_SQL)
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.exact_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP8_SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END AS s FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS sh FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b USING (sh) WHERE a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
labels AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN labels ON doc_id = a
"""


@query("op8_near_dedup", OP8_SQL)
def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_groups(table(spark, sf_dir, "documents"))


@query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = langid.is_held_out()
    known = docs.filter(~held_out & F.col("doc_id").isNotNull())
    model = langid.fit(known)
    return langid.classify(docs, model, langid.fit_limits(known, model)).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "margin",
                                               "rejected")


@query("op10_secret_scan")
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.scan_documents(table(spark, sf_dir, "documents"))


@query("op5_personal_data")
def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal(table(spark, sf_dir, "documents"))


@query("op3_fertility")
def op3_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.quality(table(spark, sf_dir, "documents"), PIECE_TOKENIZER, ((BYTE_TOKENIZER, True),)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "band_group", "n_tokens", "chars_per_token", "byte_share", "token_entropy",
        "chars_per_token_byte", "entropy_off", "outside")


def periodic_tail(key: int | None, words: list) -> list:
    """Of one document in ten (by the CRC-32 of its id) the words from some place on become periodic."""
    n = len(words)
    if key is None or not n:
        return words
    h = zlib.crc32(str(key).encode())
    g = h // 10
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a:a + p]
    return words[:a] + (tail * -(-(n - a) // p))[:n - a]


@query("op13_period_runs")
def op13_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.word_runs(table(spark, sf_dir, "documents"), change=periodic_tail).drop("runs")


@query("op12_quality")
def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = stored(boosting.statistics(table(spark, sf_dir, "documents")))
    held_out = langid.is_held_out()
    forest = boosting.fit(stats, table(spark, sf_dir, "labels").filter(~held_out))
    return boosting.score(stats, forest).withColumnRenamed("id", "doc_id").select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def _sql_crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit (0xEDB88320 is the reversed polynomial)."""
    bit = "lambda x, k: xor(x >> 1, 3988292384 * (x & 1))"
    byte = f"lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], {bit})"
    codes = f"list_transform(string_split({text}, ''), lambda ch: unicode(ch)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), {byte}), 4294967295)"


def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen({f}::VARCHAR) || ':' || {f}, '-')"
                                   for f in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_LOWERED = f"translate(text, '{ASCII_UPPER}', '{ASCII_LOWER}')"
# Trees as tables of nodes (tree, level, pos, h, n nodes of the level); a leaf's path climbs one level per round.
OP11_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, {_sql_leaf("text")} AS leaf,
         CASE WHEN {_sql_crc32("doc_id::VARCHAR")} % 5 = 0 THEN {_sql_leaf(_LOWERED)} END AS other FROM documents),
base AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST, leaf) AS rid,
         dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n FROM leaves),
nodes AS (
  SELECT s, 0 AS level, pos, leaf AS h, n FROM base
  UNION ALL
  SELECT s, level + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 15) // 16)
  FROM nodes WHERE n > 1 GROUP BY s, level, pos // 16),
subroots AS (SELECT s, h AS subroot FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, s AS pos, subroot AS h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 15) // 16)
  FROM tops WHERE n > 1 GROUP BY level, pos // 16),
every AS (
  SELECT s AS tree, level, pos, h, n FROM nodes WHERE n > 1
  UNION ALL SELECT -1, level, pos, h, n FROM tops WHERE n > 1),
heights AS (SELECT tree, max(level) + 1 AS height FROM every GROUP BY tree),
climb AS (
  SELECT rid, step, CASE WHEN step < height THEN s ELSE -1 END AS tree, CASE WHEN step < height THEN step
           ELSE step - height END AS level,
         CASE WHEN step < height THEN pos // CAST(pow(16, step) AS BIGINT)
           ELSE s // CAST(pow(16, step - height) AS BIGINT) END AS pos
  FROM (SELECT rid, b.s, pos, coalesce(t.height, 0) AS height,
               unnest(range(0, coalesce(t.height, 0) + coalesce((SELECT height FROM heights WHERE tree = -1), 0))) AS step
        FROM base b LEFT JOIN heights t ON t.tree = b.s)),
steps AS (
  SELECT rid, step, string_agg(e.h, '' ORDER BY e.pos) FILTER (e.pos < c.pos) AS lefts,
         string_agg(e.h, '' ORDER BY e.pos) FILTER (e.pos > c.pos) AS rights
  FROM climb c JOIN every e ON e.tree = c.tree AND e.level = c.level AND e.pos // 16 = c.pos // 16 GROUP BY rid, step),
proofs AS (
  SELECT rid, sha256(string_agg(coalesce(lefts, '') || coalesce(rights, ''), '' ORDER BY step)) AS proof
  FROM steps GROUP BY rid),
folds AS (
  SELECT rid, 0 AS step, coalesce(other, leaf) AS value FROM base
  UNION ALL
  SELECT f.rid, f.step + 1, sha256(coalesce(lefts, '') || value || coalesce(rights, ''))
  FROM folds f JOIN steps s ON s.rid = f.rid AND s.step = f.step),
folded AS (SELECT rid, arg_max(value, step) AS folded_root FROM folds GROUP BY rid)
SELECT doc_id, leaf, subroot, h AS root, coalesce(proof, sha256('')) AS proof_sha256, folded_root,
       folded_root = h AS verified
FROM base JOIN subroots USING (s) JOIN folded USING (rid) LEFT JOIN proofs USING (rid), (SELECT h FROM tops WHERE n = 1)
"""


@query("op11_merkle_manifest", OP11_SQL)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = merkle.lower_where(F.col("text"), langid.is_held_out())
    leaves = merkle.manifest_leaves(table(spark, sf_dir, "documents"), changed={"text": tampered})
    return merkle.manifest(leaves).withColumnRenamed("id", "doc_id")
