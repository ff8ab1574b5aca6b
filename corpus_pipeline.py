"""The corpus pipeline: five stages over ``documents``, each written as Parquet and reread.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept. All but the last return the columns of ``documents``.

1. toxicity: documents predicted toxic go.
2. exact_dedup: of equal normalised texts the longest original (then the
   smallest id) stays, as the extendible-hash index tells.
3. simhash: of each component of near copies one row stays, that with the
   smallest id (nulls last; among equal ids the smallest text hash).
4. decontamination: documents that contain a benchmark item go.
5. packing: the rest is tokenised and packed into sequences.

Stages 1, 3 and 4 write their input with a row key, decide by row and drop by
that key, which no stage returns. What a decision was made from is deleted as
soon as the list of dropped rows is written. So rows with a null doc_id, or with one that
other rows share, are judged each by itself. Nulls: a null text is an empty
text; very long texts pass whole. Ties are broken as each stage says, the last
one by the row key. Extra columns are carried up to packing, whatever their
names. Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm import decontam, exact_dedup, packing, simhash, store, toxicity
from reelhouse.llm.queries import tokenizer_path
from reelhouse.session import release_scratch, scratch_paths

# SQL has no tokenizer and no XXH64, so the pipeline is tested against a brute-force version.
ORACLE_SQL = None


# Lists of dropped ids up to this size travel to the tasks; longer ones are joined by a shuffle.
BROADCAST_BYTES = 32 << 20
ID_BYTES = 16


ROW = "_row_key"


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a row key, fixed by writing it."""
    return store.write_shared(docs.withColumn(ROW, F.monotonically_increasing_id()), "keyed")


def _without(docs: DataFrame, ids: DataFrame, key: str = "doc_id", since: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` whose key is not listed (null keys are never listed).

    ``since``: the scratch folders there were when ``docs`` was written. Those
    made after it have done their work when the list is written.
    """
    listed = ids.select(F.col(key).alias("_listed")).where("_listed is not null").distinct()
    listed = store.write_shared(listed, "listed")
    if since is not None:
        made = [p for p in scratch_paths() if p not in since]
        release_scratch(docs.sparkSession, made[:-1])  # the last one is the list
    if listed.count() * ID_BYTES <= BROADCAST_BYTES:  # the documents need no shuffle then
        listed = F.broadcast(listed)
    return docs.join(listed, docs[key] == listed["_listed"], "left_anti")


def _drop_rows(keyed: DataFrame, rows: DataFrame, since: list[str]) -> DataFrame:
    """``keyed`` without the rows listed by key, and without the key."""
    return _without(keyed, rows, ROW, since).drop(ROW)


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed, since = _keyed(docs), scratch_paths()
    scored = toxicity.score_documents(keyed, store.table(spark, sf_dir, "labels"), key_col=ROW)
    return _drop_rows(keyed, scored.where("predicted = 1"), since)


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed, since = _keyed(docs), scratch_paths()
    groups = simhash.near_groups(keyed, id_col=ROW).select(F.col("doc_id").alias(ROW), "component_id")
    # Only rows of components with copies are ranked.
    linked = groups.groupBy("component_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("component_id")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("h"), ROW)
    ranked = keyed.select(ROW, rank.alias("rank")).join(groups.join(linked, "component_id"), ROW)
    ranked = store.write_shared(ranked, "near-ranked")
    kept = ranked.groupBy("component_id").agg(F.min("rank").alias("best")).select(F.col(f"best.{ROW}").alias("_kept"))
    return _drop_rows(keyed, ranked.join(kept, ranked[ROW] == kept["_kept"], "left_anti"), since)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed, since = _keyed(docs), scratch_paths()
    found = decontam.contaminated(keyed, store.table(spark, sf_dir, "benchmark"), id_col=ROW)
    return _drop_rows(keyed, found.select(F.col("doc_id").alias(ROW)), since)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", remove_toxic),
    ("exact_dedup", remove_copies),
    ("simhash", remove_near_copies),
    ("decontamination", remove_benchmark),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = store.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store.write_shared(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
