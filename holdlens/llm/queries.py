"""The registered queries of this subpackage and the DuckDB SQL that checks them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import attribution, bpe, exact_dedup, packing, secrets, sharding, simjoin, topk, toxicity, warc
from .common import table


def _tokenizer() -> str:
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simjoin.join(table(spark, sf_dir, "documents"))


def op3_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = warc.round_trip(table(spark, sf_dir, "pages"))
    return history.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "ts")


def op4_token_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.attribute(table(spark, sf_dir, "documents"), tokenizer_json=_tokenizer())


def op5_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shard(table(spark, sf_dir, "documents"), shards=8)
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = secrets.common_words(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    forest = secrets.train(secrets.labelled_findings(spark), dictionary=words)
    return secrets.scan(table(spark, sf_dir, "documents"), forest)


def op7_ball_tree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_json=_tokenizer())


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents"), ranks=ranks, pattern=public_tokenizers.PATTERN))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_ngram_join": op2_ngram_join,
    "op3_warc_index": op3_warc_index,
    "op4_token_attribution": op4_token_attribution,
    "op5_kd_shards": op5_kd_shards,
    "op6_secret_scan": op6_secret_scan,
    "op7_ball_tree_topk": op7_ball_tree_topk,
    "op8_packing": op8_packing,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_byte_bpe": op10_byte_bpe,
}

_NORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"
ORACLES = {
    "op2_ngram_join": r"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
             s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
             n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
             o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
             l AS (SELECT x, y FROM o JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * o >= 75 * (p.n + q.n - o)),
             e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
             r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, (SELECT min(y) FROM r WHERE x = doc_id)) AS component_id FROM d LEFT JOIN n USING (doc_id)""",
    "op3_warc_index": """
        WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest FROM pages),
             s AS (SELECT *, octet_length(encode(html)) AS n, lower(regexp_replace(coalesce(url, ''), '#.*$', '')) AS u FROM p),
             w AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY digest) ELSE page_id END AS winner,
                          regexp_replace(u, '^[a-z][a-z0-9+.-]*://', '') AS bare FROM s)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
               CASE WHEN winner = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN winner <> page_id THEN winner END AS refers_to,
               array_to_string(list_reverse(string_split(regexp_replace(regexp_extract(bare, '^([^/?]*)', 1), ':\\d+$', ''), '.')), ',') || ')'
                 || regexp_extract(bare, '^[^/?]*(.*)$', 1) AS url_key,
               strftime(make_timestamp((1700000000 + page_id % 100000000) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS ts
        FROM w""",
    "op7_ball_tree_topk": """
        WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
                     AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
             s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
                   FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)),
             r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank" FROM s)
        SELECT query_id, "rank", vec_id, score FROM r WHERE "rank" <= 5""",
    "op9_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {_NORM} AS norm FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
        FROM d""",
}
