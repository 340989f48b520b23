"""Queries of this subpackage for the driver's contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat, dimension_scan, fill_middle, importance, line_dedup, multiset, packing, sentence_pieces, simhash, suffix_dedup, tokens, toxicity,
    wrappers,
)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_wrapper_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, by its host's wrapper."""
    found = wrappers.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query
def op2_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document under log scores fitted to all of them, and whether decoding restores its text."""
    docs, path = table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model")
    return sentence_pieces.round_trip(docs, path, scores=sentence_pieces.fit(docs, path))


@query
def op3_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text."""
    return multiset.fingerprints(table(spark, sf_dir, "documents"))


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that occur earlier, with their offsets."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.transform("removed", lambda s: F.concat_ws("-", s["start"], s["stop"]))
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "text", F.size("removed").cast("long").alias("n_removed"), F.concat_ws(",", spans).alias("removed"))


ORACLES["op4_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS k, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), placed AS (
  SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS line_start
  FROM lines
), pieces AS (
  SELECT doc_id, k, line_start, generate_subscripts(u, 1) AS j, unnest(u) AS piece
  FROM (SELECT doc_id, k, line_start, regexp_extract_all(line, '[^MARKS]*[MARKS]+|[^MARKS]+') AS u FROM placed)
), units AS (
  SELECT *, line_start + coalesce(sum(length(piece)) OVER (PARTITION BY doc_id, k ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
         trim(regexp_replace(lower(regexp_replace(piece, '[MARKS]+$', '')), '\s+', ' ', 'g')) AS unit
  FROM pieces
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY unit ORDER BY doc_id, start) > 1 AS again FROM units WHERE unit <> ''
), runs AS (
  SELECT *, sum(CASE WHEN again THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY start) AS run FROM ranked
), judged AS (
  SELECT doc_id, k, j, again AND sum(CASE WHEN again THEN length(unit) + 1 ELSE 0 END) OVER (PARTITION BY doc_id, run) >= 150 AS gone FROM runs
), marked AS (
  SELECT u.doc_id, u.k, u.j, u.start, u.piece,
         coalesce(g.gone, last_value(g.gone IGNORE NULLS) OVER (PARTITION BY u.doc_id, u.k ORDER BY u.j ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                          AND first_value(g.gone IGNORE NULLS) OVER (PARTITION BY u.doc_id, u.k ORDER BY u.j ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
                  FALSE) AS gone
  FROM units u LEFT JOIN judged g ON g.doc_id = u.doc_id AND g.k = u.k AND g.j = u.j
), spans0 AS (
  SELECT *, sum(CASE WHEN gone THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, k ORDER BY j) AS part FROM marked
), spans AS (
  SELECT doc_id, min(start) AS a, max(start + length(piece)) AS b FROM spans0 WHERE gone GROUP BY doc_id, k, part
), cut AS (
  SELECT doc_id, k, bool_or(gone) AS touched, coalesce(string_agg(piece, '' ORDER BY j) FILTER (NOT gone), '') AS rest FROM marked GROUP BY doc_id, k
), texts AS (
  SELECT l.doc_id, coalesce(string_agg(coalesce(c.rest, l.line), chr(10) ORDER BY l.k)
                            FILTER (NOT (coalesce(c.touched, FALSE) AND regexp_matches(c.rest, '^\s*$'))), '') AS text
  FROM lines l LEFT JOIN cut c ON c.doc_id = l.doc_id AND c.k = l.k GROUP BY l.doc_id
)
SELECT t.doc_id, t.text, coalesce(s.n, 0) AS n_removed, coalesce(s.removed, '') AS removed
FROM texts t LEFT JOIN (SELECT doc_id, count(*) AS n, string_agg(CAST(a AS BIGINT) || '-' || CAST(b AS BIGINT), ',' ORDER BY a) AS removed
                        FROM spans GROUP BY doc_id) s ON s.doc_id = t.doc_id
""".replace("MARKS", line_dedup.MARKS)


@query
def op5_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query
def op6_dimension_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    return dimension_scan.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeated strings of 400 bytes cover."""
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return toxicity.classify(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "rejected")


@query
def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document."""
    return tokens.count_tokens(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its middle moved to the end, and the text rebuilt from that."""
    moved = fill_middle.restore(fill_middle.transform(table(spark, sf_dir, "documents")))
    return moved.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                        F.sha2("restored", 256).alias("restored_sha256"))


ORACLES["op11_fill_in_middle"] = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
         sha256('7:' || doc_id) AS h
  FROM documents
), drawn AS (
  SELECT *, len(units) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(units) + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (len(units) + 1) AS y,
         CAST('0x' || h[25:32] AS BIGINT) % 100 < 50 AS first
  FROM cut
), parts AS (
  SELECT *, array_to_string(units[1:least(x, y)], '') AS p, array_to_string(units[least(x, y) + 1:greatest(x, y)], '') AS m,
         array_to_string(units[greatest(x, y) + 1:], '') AS s,
         text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') AS plain
  FROM drawn
)
SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN first THEN 'spm' ELSE 'psm' END AS form,
       CASE WHEN NOT plain THEN length(p) END AS prefix_chars, CASE WHEN NOT plain THEN length(m) END AS middle_chars,
       sha256(CASE WHEN plain THEN text WHEN first THEN '<S>' || s || '<P>' || p || '<M>' || m
                   ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


@query
def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, and its turns and the text under the loss mask read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], rows.schema)
    turns = rows.unionByName(more).withColumn("parts", chat.text_parts(F.col("text")))
    return chat.digests(chat.conversations(chat.format_turns(turns)))


ORACLES["op12_chat_formatting"] = r"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), escaped AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '\\|<s>|</s>|\[/?INST\]|<image>|<audio>|<document>|<file>')) AS n
  FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(role) + n + CASE role WHEN 'assistant' THEN 14 ELSE 13 END) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""


@query
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight towards the benchmark, and the rank of those drawn."""
    docs, wanted = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return importance.resample(docs, wanted)
