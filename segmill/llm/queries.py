"""The registered queries of the subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmill.llm import (
    hardneg,
    hnsw,
    minhash,
    mixing,
    neardup,
    pieces,
    quality,
    rules,
    sharding,
    substrings,
    templates,
    toxicity,
    whitening,
)
from segmill.llm.base import REGISTRY, check, table
from segmill.llm.training import held_out

__all__ = ["REGISTRY"]

SHARDS = tuple(f"shard-{i:03d}" for i in range(256))


@check()
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's slot and shard."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return sharding.assign_shards(docs, "doc_id", SHARDS)


# A document is good from this score on.
QUALITY = 0.7

WORDS = r"[^\x20\x09-\x0D]+"


@check()
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, with a lexicon learned from the other folds' labels."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    kept_out = held_out("doc_id", 5, 0)
    lexicon = toxicity.learn(docs, labels, ~kept_out)
    return toxicity.score(docs, lexicon).select(
        "doc_id", kept_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


# Rare sources, languages and topics gain; half of the tokens are kept.
EXPONENTS = {"source": 0.5, "lang": 0.7, "topic": 0.5}
TOKEN_BUDGET = 0.5


@check(mixing.mix_sql(EXPONENTS, TOKEN_BUDGET))
def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's probability in the mixture, and whether it is drawn."""
    docs = table(spark, sf_dir, "documents").withColumn("topic", mixing.topic_of(F.col("text")))
    return mixing.mix(docs, EXPONENTS, TOKEN_BUDGET).select(
        "doc_id", "source", "lang", "topic", "n_tokens", F.round("probability", 6).alias("probability"), "kept"
    )


@check(rf"""
WITH w AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS ws FROM documents)
), win AS (
  SELECT doc_id, pos, count(*) OVER p AS n,
    md5(string_agg(word, chr(10)) OVER p) AS seq
  FROM w WINDOW p AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)
), later AS (
  SELECT doc_id, pos FROM (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY seq ORDER BY doc_id, pos) AS nth FROM win WHERE n = 20)
  WHERE nth > 1
), gone AS (
  SELECT DISTINCT doc_id, pos + k AS pos FROM later, (SELECT unnest(range(20)) AS k)
), rest AS (
  SELECT w.doc_id, count(*) AS n_words, count(gone.pos) AS n_removed,
    string_agg(word, ' ' ORDER BY w.pos) FILTER (WHERE gone.pos IS NULL) AS kept
  FROM w LEFT JOIN gone ON gone.doc_id = w.doc_id AND gone.pos = w.pos GROUP BY w.doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN rest USING (doc_id)
""")
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages that stand earlier."""
    docs = table(spark, sf_dir, "documents")
    return substrings.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


@check(templates.ORACLE_SQL)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without lines of recurring templates."""
    return templates.drop_templates(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256")
    )


@check()
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of near duplicates."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


# A parameter: the driver reads the model, tasks do not.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


@check()
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, and whether they decode to its text (up to the sign for a space)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocab = pieces.load(PIECES)
    encoded = pieces.encode(docs, vocab, check="round_trip")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")


@check(rf"""
WITH w AS (
  SELECT row_id, doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM (
    SELECT row_number() OVER () AS row_id, doc_id,
      regexp_extract_all(coalesce(text, ''), '{WORDS}') AS ws FROM documents)
), win AS (
  SELECT row_id, pos, word || chr(10) || lead(word, 1) OVER p || chr(10) || lead(word, 2) OVER p || chr(10)
    || lead(word, 3) OVER p || chr(10) || lead(word, 4) OVER p AS five
  FROM w WINDOW p AS (PARTITION BY row_id ORDER BY pos)
), twice AS (
  SELECT row_id, pos FROM (
    SELECT row_id, pos, count(*) OVER (PARTITION BY row_id, five) AS n FROM win WHERE five IS NOT NULL)
  WHERE n > 1
), rep AS (
  SELECT row_id, count(DISTINCT pos + k) AS n_repeat_words
  FROM twice, (SELECT unnest([0, 1, 2, 3, 4]) AS k) GROUP BY row_id
), ln AS (
  SELECT row_id, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) AS n_lines FROM (
    SELECT row_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM (
      SELECT row_number() OVER () AS row_id, text FROM documents))
  WHERE regexp_matches(line, '{WORDS}') GROUP BY row_id
), base AS (
  SELECT d.doc_id, len(regexp_extract_all(t, '{WORDS}'))::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(n_lines, 0)::BIGINT AS n_lines,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))
      - length(regexp_replace(t, '[^\x00-\x08\x0E-\x1F\x21-@\[-`\{{-\x7F]', '', 'g')) AS n_letters
  FROM (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS t FROM documents) d
  LEFT JOIN rep USING (row_id) LEFT JOIN ln USING (row_id)
), ruled AS (
  SELECT *, (n_words < 10)::BIGINT + 2 * (100 * n_repeat_words > 20 * n_words)::BIGINT
    + 4 * (10 * n_symbols > n_words)::BIGINT + 8 * (word_chars < 2 * n_words)::BIGINT
    + 16 * (word_chars > 12 * n_words)::BIGINT
    + 32 * (n_lines >= 4 AND 10 * n_dup_lines > 3 * n_lines)::BIGINT
    + 64 * (2 * n_letters < word_chars)::BIGINT AS failed_rules
  FROM base
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (failed_rules & 3) <> 0 AS base_failed, failed_rules = 0 AS kept, failed_rules
FROM ruled
""")
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of every document, with the verdict of the current policy."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rules.ledger(docs, "text").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~rules.passes(rules.BASE)).alias("base_failed"),
        rules.passes(rules.POLICIES["v2"]).alias("kept"), "failed_rules",
    )


@check()
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality, with a model learned from the other folds' positives."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    kept_out = held_out("doc_id", 4, 2)
    model = quality.learn(docs, labels, ~kept_out)
    return quality.with_score(docs.select("doc_id", "text"), model).select(
        "doc_id", kept_out.alias("held_out"), "score",
        (F.col("score") >= QUALITY).cast("int").alias("predicted"),
    )


@check()
def op10_hnsw_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth one."""
    return hnsw.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@check("""
WITH RECURSIVE v AS (
  SELECT vec_id, label, [x::DOUBLE FOR x IN embedding] AS e FROM embeddings
  WHERE label IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
), link AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (
  SELECT x, y FROM link UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x
), n AS (
  SELECT x, count(*) AS n_links FROM link GROUP BY x
), c AS (
  SELECT x, min(y) AS least FROM reach GROUP BY x
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(c.least, vec_id)) AS component_id,
  vec_id <= coalesce(c.least, vec_id) AS kept
FROM embeddings LEFT JOIN n ON n.x = vec_id LEFT JOIN c ON c.x = vec_id
""")
def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's near duplicates of its label, and their component."""
    return neardup.near_duplicates(table(spark, sf_dir, "embeddings"), 0.93)


@check()
def op12_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the 16 components of largest variance, whitened."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), 16)


@check("""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE label IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
  (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id))::INT AS rank
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
""")
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every hundredth vector, a seventh of the labels being shifted."""
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", shifted)
    return hardneg.mine(rows, F.col("vec_id") % 100 == 0)
