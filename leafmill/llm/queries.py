"""One registered query per operator, over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leafmill.llm.clusters import K, ROUNDS, cluster_vectors
from leafmill.llm.decontaminate import contamination
from leafmill.llm.filter_audit import filter_audit
from leafmill.llm.language import identify_language, learn_languages
from leafmill.llm.line_dedup import dedup_lines
from leafmill.llm.main_text import extract_main_text, learn_weights
from leafmill.llm.near_duplicates import near_duplicate_groups
from leafmill.llm.packing import pack_documents
from leafmill.llm.personal_data import KINDS, find_personal_data, learn_personal_data, spans_text
from leafmill.llm.quality import quality
from leafmill.llm.sharding import shard_documents
from leafmill.llm.tables import Workspace
from leafmill.llm.token_counts import token_counts
from leafmill.llm.warc import assemble_captures, read_warc, write_warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under a unigram vocabulary; see ``token_counts``."""
    documents = _table(spark, sf_dir, "documents")
    return token_counts(documents, public_tokenizers.path("piece_bpe_32k.model"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, written, read back and assembled; see ``leafmill.llm.warc``."""
    work = Workspace(spark, "warc")
    archive = write_warc(_table(spark, sf_dir, "pages"), f"{work.path}/archive")
    # Digests and sizes are taken while reading; the pages themselves are not kept twice.
    main = F.col("record_type").isin("response", "revisit")
    records = read_warc(spark, archive)
    records = work.put(
        records.withColumn("payload", F.when(~main, F.col("payload"))), "records"
    )

    def page_id(told: Column) -> Column:
        text = F.get(told, F.lit(0))["payload"].cast("string")
        return F.regexp_extract(text, r"pageId: (-?\d+)", 1).try_cast("bigint")

    return assemble_captures(records).select(
        page_id(F.col("metadata")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_id(F.col("original.metadata")).alias("refers_to"),
    )


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-word shingles; see ``near_duplicate_groups``."""
    return near_duplicate_groups(_table(spark, sf_dir, "documents"), width=2)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens; see ``pack_documents``.

    The file has the same vocabulary and ids as ``byte_bpe_50k.json``.
    """
    documents = _table(spark, sf_dir, "documents")
    return pack_documents(documents, public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more; see ``dedup_lines``."""
    kept = dedup_lines(_table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page; see ``extract_main_text``."""
    pages = _table(spark, sf_dir, "pages")
    return extract_main_text(pages, learn_weights(pages))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from three quarters of the documents, by the checksum of their id."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    held_out = F.coalesce(checksum % 4 == 2, F.lit(False))
    model = learn_languages(documents.where(~held_out))
    return identify_language(documents.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and bands of tokeniser fertility; see ``quality``."""
    documents = _table(spark, sf_dir, "documents")
    judged = quality(documents, public_tokenizers.path("piece_bpe_32k.model"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of near equal bytes; see ``shard_documents``."""
    placed = shard_documents(_table(spark, sf_dir, "documents"), 8)
    return placed.select(
        "*", F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    )


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-word windows of the benchmark; see ``contamination``."""
    found = contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), width=10
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all orders, by source; see ``filter_audit``."""
    return filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patterns and a skip-chain field over all texts; see ``find_personal_data``."""
    documents = _table(spark, sf_dir, "documents")
    field = learn_personal_data(documents)
    certain = F.filter("found", lambda span: span["certain"])

    def many(kind: str) -> Column:
        return F.size(F.filter("base", lambda span: span["kind"] == kind)).cast("bigint")

    return find_personal_data(documents, field).withColumn("base", certain).select(
        "doc_id",
        *[many(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
        spans_text(F.col("found")).alias("spans"),
    )


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen centroids, three rounds; see ``cluster_vectors``."""
    return cluster_vectors(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    fn.__name__: fn
    for fn in (
        op1_token_counts,
        op2_warc,
        op3_minhash,
        op4_packing,
        op5_line_dedup,
        op6_main_text,
        op7_language,
        op8_quality,
        op9_sharding,
        op10_decontaminate,
        op11_filter_audit,
        op12_personal_data,
        op13_centroids,
    )
}

# Blanks that are cut off at the ends of a line: codes 9 to 13 and 32.
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _centroids_sql() -> str:
    """Rounds of assignment and exact floors of means, one pair of tables each."""
    distance = (
        "list_sum(list_transform(list_zip(p.v, q.v), lambda x: (x[1] - x[2]) * (x[1] - x[2])))::BIGINT"
    )
    ctes = [
        """kept AS (
          SELECT row_number() OVER () AS r, vec_id,
                 list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
          FROM embeddings
          WHERE len(embedding) = 64
            AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = 64)""",
        f"""centre0 AS (
          SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c, v FROM kept
          QUALIFY c < {K})""",
    ]
    for k in range(ROUNDS + 1):
        ctes.append(
            f"""near{k} AS (
          SELECT r, min(struct_pack(d := {distance}, c := q.c)) AS best, any_value(p.v) AS v,
                 any_value(vec_id) AS vec_id
          FROM kept p CROSS JOIN centre{k} q GROUP BY r)"""
        )
        if k < ROUNDS:
            ctes.append(
                f"""mean{k} AS (
          SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (
            SELECT c, i, sum(x) AS s, count(*) AS n FROM (
              SELECT best.c AS c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM near{k})
            GROUP BY c, i) GROUP BY c),
        centre{k + 1} AS (
          SELECT c, coalesce(mean{k}.v::BIGINT[], centre{k}.v) AS v
          FROM centre{k} LEFT JOIN mean{k} USING (c))"""
            )
    return f"""
        WITH {", ".join(ctes)}
        SELECT vec_id, best.c::INTEGER AS cluster, best.d AS distance,
               sum(best.d) OVER (PARTITION BY best.c)::BIGINT AS cluster_inertia,
               sum(best.d) OVER ()::BIGINT AS inertia,
               sha256(list_reduce(list_transform(q.v, lambda x: x::VARCHAR), lambda a, b: a || ',' || b))
                 AS centroid_sha256
        FROM near{ROUNDS} JOIN centre{ROUNDS} q ON best.c = q.c"""


SQL: dict[str, str] = {
    "op13_centroids": _centroids_sql(),
    "op11_filter_audit": """
        WITH words AS (
          SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                 regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        failing AS (
          SELECT part, len(w) < 50 AS a, 100 * list_unique(w) < 65 * len(w) AS b,
                 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS c,
                 regexp_matches(text, '[#$%&*|]') AS d,
                 doc_id > min(doc_id) OVER (PARTITION BY text) AS e,
                 doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good,
                 doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic
          FROM words),
        masks AS (
          SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask,
                 count(*) AS n, count_if(good) AS n_good, count_if(toxic) AS n_toxic
          FROM failing GROUP BY ALL),
        letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) t(l, bit)),
        orders AS (
          SELECT p.l || q.l || r.l || s.l || t.l AS filter_order,
                 [p.bit, q.bit, r.bit, s.bit, t.bit] AS bits
          FROM letters p, letters q, letters r, letters s, letters t
          WHERE p.bit | q.bit | r.bit | s.bit | t.bit = 31),
        steps AS (
          SELECT filter_order, step::INTEGER AS step, bits[step] AS bit,
                 coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
          FROM orders, range(1, 6) x(step)),
        audited AS (
          SELECT part, filter_order, step, any_value(bit) AS bit,
                 sum(n) FILTER (WHERE mask & (before | bit) = 0) AS kept,
                 sum(n) FILTER (WHERE mask & bit > 0 AND mask & before = 0) AS removed,
                 sum(n) FILTER (WHERE mask & bit > 0 AND mask & before > 0) AS redundant,
                 sum(n) FILTER (WHERE mask = bit) AS unique_fails,
                 sum(n_good) FILTER (WHERE mask & bit > 0 AND mask & before = 0) AS good_lost,
                 sum(n_toxic) FILTER (WHERE mask & bit > 0 AND mask & before = 0) AS toxic_lost
          FROM masks, steps GROUP BY part, filter_order, step)
        SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept,
               coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
               coalesce(unique_fails, 0)::BIGINT AS unique_fails,
               coalesce(good_lost, 0)::BIGINT AS good_lost,
               coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
               coalesce(sum(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley
        FROM audited""",
    "op2_warc": """
        WITH payloads AS (
          SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                 sha256(coalesce(html, '')) AS payload_digest FROM pages),
        ranked AS (
          SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM payloads)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first
                    THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
        FROM ranked""",
    "op5_line_dedup": f"""
        WITH numbered AS (
          SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
        lines AS (
          SELECT r, doc_id, generate_subscripts(parts, 1) AS i, unnest(parts) AS line
          FROM (SELECT r, doc_id, string_split(text, chr(10)) AS parts FROM numbered)),
        keyed AS (SELECT *, translate(trim(line, {_BLANKS}), {_LOWER}) AS key FROM lines),
        common AS (
          SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10)
        SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines,
               count(common.key) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i)
                               FILTER (WHERE common.key IS NULL), '')) AS kept_sha256
        FROM keyed LEFT JOIN common USING (key) GROUP BY r""",
}
