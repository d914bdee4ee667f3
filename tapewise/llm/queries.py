"""Registered queries of the text operators and their DuckDB oracles, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewise.llm import decontaminate, exactdedup, htmltext, jaccard, linededup, negatives, packing, repair, sharding, simhash, \
    tokenfile, toxicity, warc
from tapewise.llm.common import scratch, table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against every benchmark item: one row per leak."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Factorization-machine score of every document."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return htmltext.extract(pages, htmltext.fit(pages))


def op4_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written to a token file and read back."""
    path = scratch(spark, "token-file")
    tokenfile.write_token_file(table(spark, sf_dir, "documents"), path)
    return tokenfile.token_file_digest(spark, path)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that an earlier document has."""
    return linededup.line_dedup(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 16 shards of nearly equal bytes."""
    found = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that stays for every document."""
    return exactdedup.exact_dedup(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page in WARC archives, read back and indexed."""
    found = warc.capture_index(table(spark, sf_dir, "pages"), scratch(spark, "warc"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 ids."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near copies of every document."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired digest of every conversation after its damage."""
    return repair.repair_report(repair.damaged(table(spark, sf_dir, "conversations")))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector and its positives; every seventh label is moved on by one first."""
    rows = negatives.usable(table(spark, sf_dir, "embeddings"))
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    found = negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_decontaminate, op2_toxicity, op3_html_text, op4_token_file, op5_line_dedup, op6_sharding,
                            op7_exact_dedup, op8_warc, op9_packing, op10_jaccard, op11_conversation_repair, op12_simhash, op13_hard_negatives)
}

_NORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"

ORACLES: dict[str, str] = {
    "op7_exact_dedup": f"""
        WITH n AS (SELECT doc_id, {_NORM} AS norm FROM documents),
             g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
        FROM n JOIN g USING (norm)""",
    "op8_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
             r AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS last FROM p)
        SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
               CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to
        FROM r""",
    "op10_jaccard": r"""
        WITH RECURSIVE w AS (
               SELECT doc_id, list_filter(regexp_split_to_array(
                 translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
               FROM documents),
             s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                          ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS g FROM w),
             t AS (SELECT doc_id, unnest(g) AS g FROM s),
             c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM t a JOIN t b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL),
             l AS (SELECT x, y FROM c JOIN s a ON a.doc_id = x JOIN s b ON b.doc_id = y WHERE 100 * n >= 80 * (len(a.g) + len(b.g) - n)),
             e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
             r AS (SELECT doc_id AS x, doc_id AS y FROM s UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y)
        SELECT doc_id, len(g) AS n_shingles, component_id
        FROM s JOIN (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x) USING (doc_id)""",
    "op13_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
                   FROM embeddings
                   WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
                          CAST(list_sum(list_transform(range(1, len(a.c) + 1), lambda i: a.c[i] * b.c[i])) AS BIGINT) AS score
                   FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
             p AS (SELECT * FROM s WHERE same
                   QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
        SELECT p.anchor_id, p.id AS positive_id,
               CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
               n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
                       AND 100 * n.score BETWEEN 30 * p.score AND 90 * p.score
        QUALIFY rank <= 10""",
}
