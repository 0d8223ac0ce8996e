"""The registered queries of these operators, over whole tables, and SQL for some."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import (
    bpe, conversations, decontamination, language_id, mixing, repeats, sharding, simhash, spelling, token_counts, topk, toxicity, warc,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark, sf_dir):
    return sharding.shard(_table(spark, sf_dir, "documents"), 24)


def op2_warc(spark, sf_dir):
    folder = warc.write_archive(_table(spark, sf_dir, "pages"))
    return warc.read_archive(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_mixing(spark, sf_dir):
    # Slot -1 where nothing is taken, as a number in every client.
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("source").fillna(-1, ["first_slot"])


def op4_token_counts(spark, sf_dir):
    return token_counts.token_counts(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_repeats(spark, sf_dir):
    return repeats.remove_repeats(_table(spark, sf_dir, "documents"))


def op6_simhash(spark, sf_dir):
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_decontamination(spark, sf_dir):
    return decontamination.contained_items(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_language_id(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    return language_id.identify(documents, language_id.learn(documents)).drop("excess_bits")


def op9_topk(spark, sf_dir):
    return topk.top_products(_table(spark, sf_dir, "embeddings"))


def op10_toxicity(spark, sf_dir):
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_spelling(spark, sf_dir):
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


def op12_bpe(spark, sf_dir):
    coded = bpe.encode_and_decode(_table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", F.sha2("code", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_conversations(spark, sf_dir):
    return conversations.damaged_and_repaired(_table(spark, sf_dir, "conversations"))


QUERIES = {
    query.__name__: query
    for query in (op1_sharding, op2_warc, op3_mixing, op4_token_counts, op5_repeats, op6_simhash,
                  op7_decontamination, op8_language_id, op9_topk, op10_toxicity, op11_spelling, op12_bpe,
                  op13_conversations)
}

SQL = {
    "op2_warc": """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS d
  FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY d)
SELECT page_id, payload_bytes, p.d AS payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON f.d = p.d AND payload_bytes >= 100""",
    "op3_mixing": r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
sources AS (
  SELECT source, source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source)),
fill AS (
  SELECT 0 AS step, source, source_size, w, NULL::DOUBLE AS target FROM sources
  UNION ALL
  SELECT step + 1, source, source_size, w,
         CASE WHEN target IS NOT NULL THEN target
              WHEN share > 3 * source_size THEN (3 * source_size)::DOUBLE END
  FROM (SELECT *, (sum(source_size) OVER () - coalesce(sum(target) OVER (), 0))::DOUBLE * w
                  / sum(CASE WHEN target IS NULL THEN w END) OVER () AS share FROM fill)
  WHERE step < (SELECT count(*) FROM sources)),
targets AS (
  SELECT source, source_size, coalesce(target, share) AS target FROM (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(target) OVER (), 0))::DOUBLE * w
              / sum(CASE WHEN target IS NULL THEN w END) OVER () AS share
    FROM fill WHERE step = (SELECT count(*) FROM sources))),
plan AS (
  SELECT *, floor(target + 0.5)::BIGINT AS take, (source_size + 511) // 512 AS blocks FROM targets),
bounds AS (
  SELECT *, (sum(wanted) OVER (ORDER BY source NULLS LAST) - wanted)::BIGINT AS low,
         (sum(wanted) OVER ())::BIGINT AS total
  FROM (SELECT *, CASE WHEN source_size = 0 THEN 0
                       ELSE take // source_size * blocks + (take % source_size + 511) // 512 END AS wanted
        FROM plan)),
points AS (
  SELECT i, total, list_sum([((i >> b) & 1) << (k - 1 - b) for b in range(k)])::BIGINT AS place
  FROM (SELECT unnest(range(1::BIGINT << k)) AS i, k, total
        FROM (SELECT DISTINCT total, greatest(1, length(bin(total - 1))) AS k FROM bounds WHERE total > 0))),
slots AS (
  SELECT source, source_size, slot, rank // blocks AS pass, rank % blocks * 512 AS low, take FROM (
    SELECT b.*, slot, row_number() OVER (PARTITION BY b.source ORDER BY slot) - 1 AS rank
    FROM (SELECT place, row_number() OVER (ORDER BY i) - 1 AS slot FROM points WHERE place < total) p
    JOIN bounds b ON place >= low AND place < low + wanted)),
placed AS (
  SELECT s.*, t.source_size, t.target, t.take,
         (sum(size) OVER (PARTITION BY s.source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id
            ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
  FROM sized s JOIN plan t ON t.source IS NOT DISTINCT FROM s.source),
firsts AS (
  SELECT doc_id, min(slot) AS first_slot
  FROM placed p JOIN slots s ON s.source IS NOT DISTINCT FROM p.source AND size > 0
    AND low < start + size
    AND least(low + 512, p.source_size, s.take - pass * p.source_size) > start
  GROUP BY doc_id)
SELECT p.doc_id, size, source_size, target,
       (CASE WHEN source_size = 0 THEN 0
             ELSE take // source_size * size
                  + greatest(0, least(size, take % source_size - start)) END)::BIGINT AS taken,
       coalesce(first_slot, -1) AS first_slot
FROM placed p LEFT JOIN firsts f ON f.doc_id IS NOT DISTINCT FROM p.doc_id""",
    "op7_decontamination": r"""
WITH items AS (
  SELECT item_id, w, least(5, len(w)) AS k FROM (
    SELECT item_id, [x for x in regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+') if x <> ''] AS w
    FROM benchmark)
  WHERE len(w) > 0),
item_shingles AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM items)),
docs AS (
  SELECT doc_id, [x for x in regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+') if x <> ''] AS w
  FROM documents),
doc_shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM docs, (SELECT DISTINCT k FROM items))),
sizes AS (SELECT item_id, count(*)::INTEGER AS item_shingles FROM item_shingles GROUP BY 1)
SELECT d.doc_id, i.item_id, item_shingles, count(*)::INTEGER AS found,
       count(*) / item_shingles AS containment
FROM doc_shingles d JOIN item_shingles i USING (s) JOIN sizes USING (item_id)
GROUP BY 1, 2, 3 HAVING count(*) / item_shingles >= 0.8""",
    "op9_topk": """
WITH v AS (
  SELECT vec_id, [floor(1024 * x::DOUBLE) for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 10""",
}
