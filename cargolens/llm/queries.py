"""The registered queries of this package: thin readers around the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cargolens.llm import exact, fingerprints, hard_negatives, langid, link_graph, merkle, mixing, near, outliers, packing, pii, secret_scan, wavelet
from cargolens.llm.staging import table
from cargolens.session import scratch_path

ORACLE_SQL: dict[str, str] = {}


def op1_weighted_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    return near.classes(table(spark, sf_dir, "documents"))


def op2_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents into wavelet-matrix shards and read them back."""
    path = scratch_path(spark, "wavelet")
    wavelet.write(table(spark, sf_dir, "documents"), path)
    return wavelet.read_documents(spark, path)


def op3_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: rules and bootstrapped contexts."""
    return pii.report(pii.scan(table(spark, sf_dir, "documents")))


def op4_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents: base rules and robust multivariate outliers."""
    return outliers.judge(table(spark, sf_dir, "documents"))


def op5_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_heavy_hitter_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact dedup of all documents; of equal texts the largest doc_id stays."""
    return exact.mark(table(spark, sf_dir, "documents"))


ORACLE_SQL["op6_heavy_hitter_dedup"] = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS s
  FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY s) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY s) AS kept, s AS text_sha256
FROM d
"""


def op7_link_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of all page urls: rules, then trust and distrust over host links."""
    return link_graph.judge(table(spark, sf_dir, "pages"))


def op8_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents to the sources' target sizes."""
    return mixing.mix(table(spark, sf_dir, "documents")).drop("copies")


def op9_recurrent_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents by a bidirectional gated recurrent network."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op10_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents: rules and character Markov models."""
    return secret_scan.report(secret_scan.scan(table(spark, sf_dir, "documents")))


def op11_scaled_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threshold-scaled sketches of all documents and of their edited texts."""
    return fingerprints.compare(table(spark, sf_dir, "documents"))


def op12_slot_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, against all vectors."""
    return hard_negatives.mine(hard_negatives.relabelled(table(spark, sf_dir, "embeddings")))


ORACLE_SQL["op12_slot_negatives"] = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_inner_product(a.q, b.q)::BIGINT AS score  -- exact: far below 2^53
  FROM e a, e b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id)::INTEGER AS "rank",
       n.other_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT n.same
WHERE 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
QUALIFY "rank" <= 3
"""


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle leaves, proofs and roots of all documents, and what tampering does to them."""
    return merkle.manifest(table(spark, sf_dir, "documents"), merkle.without_line_breaks()).drop("source")


_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE concat(strlen({0}::VARCHAR), ':', {0}::VARCHAR) END"
_LEAF = "sha256(concat(" + ", ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars")) + ", {0}))"

ORACLE_SQL["op13_merkle_manifest"] = f"""
WITH RECURSIVE crc AS (  -- crc32 of the decimal id, bit by bit
  SELECT doc_id AS crc_id, xor(list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], list_transform(range(8), lambda i: 0::BIGINT)),
                             lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS crc
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
), hashed AS (
  SELECT doc_id, source, {_LEAF.format(_FIELD.format("text"))} AS leaf,
         {_LEAF.format(_FIELD.format("(CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END)"))} AS changed
  FROM documents LEFT JOIN crc ON doc_id = crc_id
), leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM hashed
), nodes AS (
  SELECT 0 AS lvl, s, pos, leaf AS h FROM leaves
  UNION ALL
  SELECT lvl + 1, s, pos // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY s) AS n FROM nodes) WHERE n > 1 GROUP BY lvl, s, pos // 3
), subroots AS (
  SELECT s, max_by(h, lvl) AS subroot, max(lvl) AS height FROM nodes GROUP BY s
), tops AS (
  SELECT 0 AS lvl, s AS pos, subroot AS h FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS n FROM tops) WHERE n > 1 GROUP BY lvl, pos // 3
), whole AS (
  SELECT max_by(h, lvl) AS root, max(lvl) AS height FROM tops
), folds AS (
  SELECT 0 AS step, l.s, l.pos AS leaf_pos, l.pos AS at, l.changed AS h, '' AS proof FROM leaves l
  UNION ALL
  SELECT f.step + 1, f.s, f.leaf_pos, any_value(CASE WHEN f.step + 1 = r.height THEN f.s ELSE f.at // 3 END),
         sha256(concat(coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (WHERE n.pos < f.at), ''), any_value(f.h),
                       coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (WHERE n.pos > f.at), ''))),
         concat(any_value(f.proof), coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (WHERE n.pos <> f.at), ''))
  FROM folds f JOIN subroots r ON f.s = r.s
  JOIN (SELECT n.s, lvl, pos, h FROM nodes n JOIN subroots r ON n.s = r.s WHERE lvl < r.height) n
    ON n.s = f.s AND n.lvl = f.step AND n.pos // 3 = f.at // 3
  GROUP BY f.step, f.s, f.leaf_pos
), below AS (
  SELECT f.s, leaf_pos, h, proof FROM folds f JOIN subroots r ON f.s = r.s AND f.step = r.height
), up AS (
  SELECT 0 AS step, s, leaf_pos, s AS at, h, proof FROM below
  UNION ALL
  SELECT f.step + 1, f.s, f.leaf_pos, any_value(f.at // 3),
         sha256(concat(coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (WHERE n.pos < f.at), ''), any_value(f.h),
                       coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (WHERE n.pos > f.at), ''))),
         concat(any_value(f.proof), coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (WHERE n.pos <> f.at), ''))
  FROM up f JOIN tops n ON n.lvl = f.step AND n.pos // 3 = f.at // 3
  WHERE f.step < (SELECT height FROM whole)
  GROUP BY f.step, f.s, f.leaf_pos
)
SELECT l.doc_id, l.leaf, r.subroot, w.root, sha256(u.proof) AS proof_sha256, u.h AS folded_root, u.h = w.root AS verified
FROM leaves l JOIN subroots r ON l.s = r.s JOIN up u ON u.s = l.s AND u.leaf_pos = l.pos, whole w
WHERE u.step = w.height
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_weighted_near_dedup,
        op2_wavelet_tokens,
        op3_contextual_pii,
        op4_robust_outliers,
        op5_best_two_fit,
        op6_heavy_hitter_dedup,
        op7_link_propagation,
        op8_pareto_mix,
        op9_recurrent_langid,
        op10_markov_secrets,
        op11_scaled_fingerprints,
        op12_slot_negatives,
        op13_merkle_manifest,
    )
}
