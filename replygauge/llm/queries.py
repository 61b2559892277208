"""The registered query of each operator of this subpackage, over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from replygauge.llm import decontaminate, html, jaccard, language, nbsvm, packing, pii, toxicity, warc
from replygauge.llm.bit_sliced import bit_sliced_topk
from replygauge.llm.bwt_dedup import remove_repeats
from replygauge.llm.collocations import collocations
from replygauge.llm.conversations import damaged, repair_report
from replygauge.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def op2_bit_sliced_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best partners of every vector whose id is divisible by 20, among all rows.

    Vectors that are null, empty or hold a null or non-finite component take no part. Ties go to the
    smaller id; rows that repeat an id are rows of their own; an empty table gives no rows.
    """
    return bit_sliced_topk(table(spark, folder, "embeddings").select("vec_id", "embedding"))


ORACLES["op2_bit_sliced_topk"] = """
WITH fine AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.row AS query_row, q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM fine q JOIN fine c ON q.row <> c.row AND q.vec_id % 20 = 0 AND len(q.v) = len(c.v)
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


def op10_levenshtein_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return toxicity.score_toxicity(docs, toxicity.train(docs, table(spark, folder, "labels")))


def op4_nb_support_vectors(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return nbsvm.score_quality(docs, nbsvm.train(docs, table(spark, folder, "labels")))


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return language.predict_language(docs, language.train(docs))


def op6_warc_zstd(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.roundtrip(table(spark, folder, "pages").select("page_id", "url", "html"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op6_warc_zstd"] = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), m AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < last_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < last_id THEN last_id END AS refers_to
FROM m
"""


def op3_conditional_random_field_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_pii(table(spark, folder, "documents").select("doc_id", "text"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """The vocabulary file; its folder is on the path of every executor or given by TOKENIZER_DIR."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_hierarchical_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents").select("doc_id", "text"), tokenizer_path())


def op9_consensus_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract_text(table(spark, folder, "pages").select("page_id", "url", "html"))


def op1_spaced_seed_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.overlaps(docs, table(spark, folder, "benchmark").select("item_id", "text"))
    return found.select("doc_id", "item_id", "n_matched", "n_item")


def op7_count_vector_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_classes(table(spark, folder, "documents").select("doc_id", "text"), n=4, percent=85)


def op11_bwt_merge_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of each document without repeated strings of 100 bytes; nulls, repeats and long texts as in ``remove_repeats``."""
    return remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))


def op12_four_russians_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults and cheapest repair of each damaged conversation; nulls, ties, repeats and long ones as in ``repair_report``."""
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return repair_report(damaged(conversations), known=conversations)


def op13_era_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """Each language's first 2000 phrases of two to four words; nulls, repeats and long texts as in ``collocations``."""
    return collocations(table(spark, folder, "documents").select("lang", "text"))


ORACLES["op13_era_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS ws FROM pieces
), placed AS (
  SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM worded
), grams AS (
  SELECT lang, ws[i : i + d - 1] AS p, d FROM placed, (VALUES (1), (2), (3), (4)) AS t(d) WHERE i + d - 1 <= len(ws)
), f AS (
  SELECT lang, p, d, count(*) AS f FROM grams GROUP BY ALL
), n AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE d = 1 GROUP BY lang
), often AS (
  SELECT * FROM f WHERE f >= 30
), cuts AS (
  SELECT lang, p, d, f AS a, unnest(range(1, d)) AS k FROM often WHERE d >= 2
), scored AS (
  SELECT c.lang, c.p, c.d, c.a, c.k, x.f AS l, y.f AS r, CAST((2000000::HUGEINT * c.a) // (x.f + y.f) AS BIGINT) AS score
  FROM cuts c JOIN often x ON x.lang = c.lang AND x.p = c.p[1 : c.k] JOIN often y ON y.lang = c.lang AND y.p = c.p[c.k + 1 : c.d]
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), inner_spans AS (
  SELECT o.lang, o.f, o.p[s : s + m - 1] AS p
  FROM often o, (VALUES (1), (2), (3)) AS t(s), (VALUES (2), (3)) AS u(m) WHERE m < o.d AND s + m - 1 <= o.d
), longest AS (
  SELECT lang, p, max(f) AS f FROM inner_spans GROUP BY lang, p
), kept AS (
  SELECT b.* FROM best b LEFT JOIN longest g ON g.lang = b.lang AND g.p = b.p WHERE g.f IS NULL OR 100 * g.f < 80 * b.a
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank, array_to_string(p, ' ') AS phrase, a, l, r, score FROM kept
)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""

QUERIES |= {f.__name__: f for f in [op1_spaced_seed_decontamination, op2_bit_sliced_topk, op3_conditional_random_field_pii, op4_nb_support_vectors, op5_language_id, op6_warc_zstd, op7_count_vector_join, op8_hierarchical_packing, op9_consensus_extraction, op10_levenshtein_toxicity, op11_bwt_merge_dedup, op12_four_russians_repair, op13_era_collocations]}
