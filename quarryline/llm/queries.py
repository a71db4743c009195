"""The operators as named queries over whole tables, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.llm import (
    exact_dedup,
    langid,
    mixing,
    negatives,
    packing,
    ppm,
    sharding,
    similarity_join,
    spelling,
    spotsigs,
    token_counts,
    url_rules,
    warc,
)
from quarryline.llm.common import is_held_out
from quarryline.session import new_path

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = [f"shard-{i:02d}" for i in range(32)]
LISTED = (
    url_rules.ListedRule("block", "net", "/"),
    url_rules.ListedRule("allow", "example.net", "/en/"),
    url_rules.ListedRule("block", "example.com", "/de/"),
    url_rules.ListedRule("allow", "org", "/fr/"),
)
TOKENIZER = "word_bpe_49k.json"
TOKEN_LIMIT = 2048


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_weights(labels: DataFrame) -> DataFrame:
    """Sampling weights of labelled documents, from 1 for bad ones to 4 for good ones."""
    return labels.groupBy("doc_id").agg((1 + 3 * F.avg("quality")).alias("weight"))


def op1_byte_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = is_held_out("doc_id", 10)
    scored = ppm.score(docs, ~held_out)
    return scored.select("row.doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score").select(
        "*", held_out.alias("held_out")
    )


def op2_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = new_path(spark, "warc")
    warc.write_archives(pages, path)
    kind = pages.schema["page_id"].dataType
    return warc.read_archives(spark, path).select(
        F.col("page").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


def op3_permutation_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return sharding.place(docs, F.col("doc_id"), sharding.lookup_table(spark, SHARDS))


def op4_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.with_edits(table(spark, sf_dir, "documents")).select(
        "row.doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
        "partition",
    )


def op5_nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.filter(~is_held_out("doc_id", 5)), key="doc_id")
    named, name = langid.identify(docs.select("doc_id", "text"), model)
    return named.select(
        "doc_id",
        is_held_out("doc_id", 5).alias("held_out"),
        F.col(name)["lang"].alias("lang_pred"),
        F.col(name)["score"].alias("score"),
        F.col(name)["rejected"].alias("rejected"),
    )


def op6_grace_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = quality_weights(table(spark, sf_dir, "labels"))
    return mixing.mix(table(spark, sf_dir, "documents"), quality=weights).select(
        "row.doc_id",
        "size",
        "source_size",
        F.round("target", 6).alias("target"),
        (F.col("epochs") * F.col("size")).alias("taken"),
    )


def op8_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return packed.select(
        "row.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op9_association_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), LISTED)


def op10_partenum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_join.join_components(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "n_shingles", "component_id"
    )


def op11_pivotal_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_overlap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return counted.select(
        "row.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    )


def op13_angular_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, label = F.col("vec_id"), F.col("label")
    label = F.when(key % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), key % 100 == 0, label=label)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_byte_contexts,
        op2_segments,
        op3_permutation_table,
        op4_spot_signatures,
        op5_nearest_centroid,
        op6_grace_hash,
        op7_source_mix,
        op8_best_fit,
        op9_association_rules,
        op10_partenum,
        op11_pivotal_grams,
        op12_overlap_counts,
        op13_angular_filter,
    )
}

_SHARD_LIST = ", ".join(f"'{s}'" for s in SHARDS)
_MD5 = "('0x' || substr(md5({text}), {start}, 8))::BIGINT"
_SHARD_SQL = f"""
WITH RECURSIVE names AS (SELECT [{_SHARD_LIST}] AS names),
orders AS (
  SELECT list_transform(names, lambda s: {_MD5.format(text="s", start=1)} % {sharding.SLOTS}) AS first,
         list_transform(names, lambda s: {_MD5.format(text="s", start=9)} % {sharding.SLOTS - 1} + 1) AS step
  FROM names
),
claims AS (
  SELECT 0 AS turn, -1::BIGINT AS slot, list_transform(range({sharding.SLOTS}), lambda x: -1) AS owners
  UNION ALL
  SELECT turn + 1, slot, list_transform(owners, lambda o, i: CASE WHEN i = slot + 1 THEN turn % {len(SHARDS)} ELSE o END)
  FROM (
    SELECT turn, owners, list_filter(
             list_transform(range({sharding.SLOTS}), lambda j: (first[turn % {len(SHARDS)} + 1] + j * step[turn % {len(SHARDS)} + 1]) % {sharding.SLOTS}),
             lambda p: owners[p + 1] = -1)[1] AS slot
    FROM claims, orders WHERE turn < {sharding.SLOTS}
  )
)
SELECT doc_id, slot, shard
FROM (SELECT doc_id, ({_MD5.format(text="coalesce(doc_id::VARCHAR, '')", start=1)} % {sharding.SLOTS})::INTEGER AS slot FROM documents)
JOIN (SELECT slot, names[(turn - 1) % {len(SHARDS)} + 1] AS shard FROM claims, names WHERE turn > 0) USING (slot)
"""

_MIX_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         pow(('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT
             / {float(1 << 48)}, 1 / coalesce(1 + 3 * quality, 2.0)) AS draw
  FROM documents LEFT JOIN (SELECT doc_id, avg(quality) AS quality FROM labels GROUP BY doc_id) USING (doc_id)
),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, 1.0 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM sized GROUP BY source
),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3.0 * source_size) OVER before, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM sources
  WINDOW before AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
targets AS (
  SELECT source, source_size, least(3.0 * source_size, weight *
           max(CASE WHEN level <= 3.0 * source_size / weight THEN level END) OVER ()) AS target FROM levels
),
ranked AS (
  SELECT s.*, t.source_size, t.target::DOUBLE AS target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 1 END AS full_epochs,
         sum(size) OVER (PARTITION BY s.source ORDER BY draw DESC, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       size * (full_epochs + CASE WHEN target - full_epochs * source_size > 0
                                   AND upto - size / 2.0 <= target - full_epochs * source_size THEN 1 ELSE 0 END)::BIGINT AS taken
FROM ranked
"""

_EXACT_SQL = """
WITH normal AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS text FROM documents
),
groups AS (SELECT text, min(doc_id) AS keep_id, count(*) AS group_size FROM normal GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
FROM normal JOIN groups USING (text)
"""

# DuckDB has no base32: five bits of the hexadecimal digest at a time index the alphabet.
_WARC_SQL = """
WITH digests AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
),
named AS (
  SELECT *, min(page_id) OVER (PARTITION BY hex) AS first_page,
         array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           (((('0x' || substr(hex || '0', (i * 5 // 4 + 1)::BIGINT, 2))::BIGINT >> (3 - i * 5 % 4)) & 31) + 1)::BIGINT, 1)), '') AS payload_digest
  FROM digests
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_page THEN first_page END AS refers_to
FROM named
"""

_NEGATIVES_SQL = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS numbers
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = v.label AS same, v.vec_id,
         list_inner_product(a.numbers, v.numbers)::BIGINT AS score
  FROM vectors a JOIN vectors v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
),
fitting AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM positives JOIN scored USING (anchor_id)
  WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM fitting WHERE rank <= 5
"""

ORACLES: dict[str, str] = {
    "op2_segments": _WARC_SQL,
    "op6_grace_hash": _EXACT_SQL,
    "op3_permutation_table": _SHARD_SQL,
    "op7_source_mix": _MIX_SQL,
    "op13_angular_filter": _NEGATIVES_SQL,
}
