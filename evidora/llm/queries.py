"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidora.llm import bpe, conversation_repair, license_scan, packing, pii, quality, resampling, secret_scan, sharding, simhash, suffix_dedup, vector_dedup, whitening
from evidora.llm.common import table


def op1_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = simhash.group(table(spark, sf_dir, "documents"))
    return grouped.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), bpe.read_file(vocabulary("word_bpe_49k.json")).decode())


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"))


def op6_stratified_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = sharding.shard(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return found.select("doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"),
                        F.sha2(secret_scan.written(F.col("base")), 256).alias("base_sha256"), secret_scan.written(F.col("spans")).alias("spans"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_embedding_pq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.group(table(spark, sf_dir, "embeddings"))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with the fixed damage of the contract, by a checksum of conversation and turn; nulls read as one space."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), (F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20).alias("_damage"))
    text = F.when(F.col("_damage") == 1, "").when(F.col("_damage") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    once = rows.filter("_damage <> 0").select("conv_id", "turn", F.when(F.col("_damage") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "_damage")
    return once.withColumn("_time", F.explode(F.array_repeat(F.lit(0), F.when(F.col("_damage") == 3, 2).otherwise(1)))).drop("_damage", "_time")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair.report(damaged(conversations), among=conversations)


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{name}") for k, name in enumerate(pii.KINDS[:4])]  # noqa: B023  called at once
    return found.select("doc_id", *counts, F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"), pii.written(F.col("spans")).alias("spans"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return white.withColumn("deviation", F.col("deviation").try_cast("long"))  # null where it takes more than 63 bits


QUERIES = {f.__name__: f for f in (op1_suffix_array, op2_simhash, op3_importance_resampling, op4_best_fit_packing, op5_byte_bpe, op6_stratified_sharding, op7_secret_scan, op8_license_scan, op9_quality_rules, op10_embedding_pq, op11_conversation_repair, op12_pii, op13_whitening)}

#: The queries that SQL can express in full; the others are tested against brute force.
SQL: dict[str, str] = {
    "op9_quality_rules": r"""
        WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
        repeated_lines AS (SELECT doc_id, count(*) AS lines, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1),
        places AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d),
        windows AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM places),
        often AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
        covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM often) GROUP BY 1),
        measured AS (SELECT d.doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
            CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(repeated_lines.lines, 0) AS n_lines, CAST(coalesce(repeated_lines.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
            FROM d LEFT JOIN repeated_lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
        judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured),
        verdict_of AS (SELECT source, unnest([{'rule': 1, 'bad': n_words < 50}, {'rule': 2, 'bad': 100 * n_repeat_words > 50 * n_words}, {'rule': 3, 'bad': 100 * n_symbols > 10 * word_chars}, {'rule': 4, 'bad': 100 * n_dup_lines > 30 * n_lines}], recursive := true) FROM measured),
        hosts AS (SELECT source, rule, count(*) AS n, count(*) FILTER (WHERE bad) AS f FROM verdict_of GROUP BY 1, 2),
        corpus AS (SELECT rule, sum(f) / CAST(sum(n) AS DOUBLE) AS m, var_pop(f / CAST(n AS DOUBLE)) AS v FROM hosts GROUP BY 1),
        prior AS (SELECT rule, m, CASE WHEN v > 0 THEN greatest(1, least(1000, m * (1 - m) / v - 1)) ELSE 1000 END AS k, least(0.8, greatest(0.3, 3.0 * m)) AS host_limit FROM corpus),
        rates AS (SELECT source, n + k AS weight, (f + m * k) / (n + k) AS rate, host_limit FROM hosts JOIN prior USING (rule)),
        verdicts AS (SELECT source, bool_or(rate - 2.0 * sqrt(rate * (1 - rate) / (weight + 1)) >= host_limit) AS host_failed FROM rates GROUP BY 1)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT host_failed AS kept
        FROM judged JOIN verdicts ON judged.source IS NOT DISTINCT FROM verdicts.source""",
    "op10_embedding_pq": """
        WITH RECURSIVE usable AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        scaled AS (SELECT vec_id, label, list_transform(e, lambda x: x / list_max(list_transform(e, lambda y: abs(y)))) AS e FROM usable),
        e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM scaled a JOIN scaled b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) END >= 0.93),
        w(id, r) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT w.id, e.b FROM w JOIN e ON e.a = w.r),
        c AS (SELECT id, min(r) AS m FROM w GROUP BY 1), n AS (SELECT a, count(*) AS k FROM e GROUP BY 1)
        SELECT vec_id, coalesce(k, 0) AS n_links, m AS component_id, vec_id = m AS kept FROM embeddings JOIN c ON id = vec_id LEFT JOIN n ON a = vec_id""",
}
