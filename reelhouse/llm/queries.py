"""The registered queries of the operators and their SQL, with production parameters."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm import align, chat, decontam, exact_dedup, html_extract, packing, pii, secrets, simhash, spelling, store, topk, toxicity, warc

# Folder of the public tokenizer files; a parameter of every function that uses one.
TOKENIZER_DIR = "/opt/tokenizers"


def tokenizer_path(name: str = "word_bpe_49k.json", folder: str = TOKENIZER_DIR) -> str:
    try:
        import public_tokenizers

        return public_tokenizers.path(name)
    except ImportError:
        return os.path.join(folder, name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(store.table(spark, sf_dir, "documents"), tokenizer_path())
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = store.new_path(spark, "warc")
    warc.write_archive(store.table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(store.table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = store.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], turns.schema)
    turns = turns.unionByName(extra).withColumn("parts", chat.text_parts("text"))
    out = chat.format_conversations(turns).withColumn("pieces", chat.read_pieces(F.col("formatted")))
    out = out.select(
        "conv_id",
        chat.read_turns(F.col("pieces")).alias("turns"),
        F.array_join(chat.loss_texts(F.col("pieces"), F.col("loss")), "").alias("learnt"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2(F.col("learnt"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(store.table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[pii.count_of(k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")],
        F.sha2(pii.span_list(base_only=True), 256).alias("base_sha256"),
        pii.span_list(base_only=False).alias("spans"),
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.score_documents(store.table(spark, sf_dir, "documents"), store.table(spark, sf_dir, "labels"))
    evidence = F.concat_ws(",", F.transform("evidence", lambda e: e["doc_id"].cast("string")))
    return found.select("doc_id", "held_out", "score", "predicted", evidence.alias("evidence"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(store.table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(store.table(spark, sf_dir, "documents"), store.table(spark, sf_dir, "benchmark"))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract_pages(store.table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(store.table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{k}") for i, k in enumerate(secrets.KINDS[:3])],
        F.sha2(secrets.span_list(base_only=True), 256).alias("base_sha256"),
        secrets.span_list(base_only=False).alias("spans"),
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(store.table(spark, sf_dir, "documents"))


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(store.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = store.table(spark, sf_dir, "documents")
    return align.align_documents(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_warc": op2_warc,
    "op3_simhash": op3_simhash,
    "op4_chat": op4_chat,
    "op5_pii": op5_pii,
    "op6_toxicity": op6_toxicity,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_html": op9_html,
    "op10_secrets": op10_secrets,
    "op11_spelling": op11_spelling,
    "op12_topk": op12_topk,
    "op13_align": op13_align,
}

ORACLE = {
    "op2_warc": r"""
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
        ), o AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS owner FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> owner THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> owner THEN owner END AS refers_to
        FROM o
    """,
    "op4_chat": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ), e AS (
            SELECT *, length(replace(replace(role, '\', '\\'), '<|', '<\|'))
                      + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + 23 AS n
            FROM t
        ), g AS (
            SELECT conv_id, count(*) AS n_turns,
                   string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS told,
                   coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS learnt,
                   sum(n)::BIGINT AS formatted_chars
            FROM e GROUP BY conv_id
        )
        SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(learnt) AS loss_chars,
               sha256(learnt) AS loss_sha256, formatted_chars
        FROM g
    """,
    "op7_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents
        ), k AS (
            SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
                   count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM d
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k
    """,
    "op8_decontamination": r"""
        WITH dw AS (
            SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents
        ), iw AS (
            SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark
        ), its AS (
            SELECT DISTINCT item_id, least(len(w), 5) AS k, array_to_string(w[p:p + least(len(w), 5) - 1], ' ') AS s
            FROM iw, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS r(p)
        ), ds AS (
            SELECT DISTINCT doc_id, k, array_to_string(w[p:p + k - 1], ' ') AS s
            FROM dw, (SELECT DISTINCT k FROM its) AS sizes, unnest(range(1, len(w) - k + 2)) AS r(p)
        ), n AS (SELECT item_id, count(*) AS item_shingles FROM its GROUP BY item_id)
        SELECT doc_id, item_id, count(*)::INT AS matched, any_value(item_shingles)::INT AS item_shingles,
               count(*)::DOUBLE / any_value(item_shingles) AS containment
        FROM ds JOIN its USING (s, k) JOIN n USING (item_id)
        GROUP BY doc_id, item_id
        HAVING count(*) * 10 >= any_value(item_shingles) * 8
    """,
    "op12_topk": r"""
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
            FROM v AS q JOIN v AS c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
        )
        SELECT query_id, (row_number() OVER w)::INT AS rank, vec_id, score FROM s
        WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
        QUALIFY rank <= 5
    """,
}
