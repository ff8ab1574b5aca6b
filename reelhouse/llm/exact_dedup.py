"""Exact dedup (native): an extendible-hash index on shared files.

Texts are equal when identical after deleting every character of
``[\\x20\\x09-\\x0D]``. All steps are DataFrame work:

1. Keys: one pass normalises every text and writes its 64-bit hash, its SHA-256
   digest and the normalised text beside the row. From here on keys move, and
   texts only in step 3.
2. The directory: class counts by the top bits of the hash (``2**MAX_DEPTH``
   slots, a fixed size). Starting with one bucket, an overfull bucket splits on
   its next bit; when its local depth equals the directory's, the directory
   doubles.
3. Owner tasks: classes are range-partitioned by bucket, so a task owns a
   range of keys, and written to the shared folder sorted by (bucket, hash);
   classes sharing a hash form a chain, numbered in digest order. Where two or
   more rows share hash and digest their bytes are compared: copies are
   combined in the map tasks first, so a group holding a third of all rows
   moves as one text per task, and a text that has no copy does not move. The
   build fails if bytes differ under one digest.
4. Lookups go through slot, bucket and chain: the top bits of a row's hash give
   its slot, the directory the bucket, and in the bucket the chain of its hash
   is followed to the digest.

Nulls: a null text is an empty text, and empty texts are equal to each other.
A null ``doc_id`` comes after every other id in ties. Rows that repeat with the
same id and equal text all report the same ``keep_id``; ``deduplicate`` returns
exactly one row per class in any case. Very long texts are read whole. Extra
columns are carried untouched, whatever their names. An empty table gives an
empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelhouse.llm import store

# The characters deleted before comparing: space, \t, \n, \v, \f, \r.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
# Top hash bits the directory may use: 65,536 slots, whatever the data size.
MAX_DEPTH = 16
# Distinct texts a bucket may hold before it splits.
BUCKET_CAPACITY = 2_048
# Lists of classes or rows up to this size travel to the tasks; longer ones are joined by a shuffle.
BROADCAST_BYTES = 32 << 20
_KEY_BYTES = 100


def normalised(text: str | Column) -> Column:
    return F.regexp_replace(store.text_or_empty(text), r"[\x20\x09-\x0D]+", "")


def _keys(docs: DataFrame, id_col: str, text_col: str, carry: bool = False) -> DataFrame:
    """(_at, _id, _n, _h, text_sha256, _norm): a row number, id, code points, hash, digest, normalised text.

    ``carry``: with the whole row (_row, and a hash of its text _t) instead of the normalised text.
    """
    cols = [
        F.col(id_col).alias("_id"),
        F.length(store.text_or_empty(text_col)).alias("_n"),
        normalised(text_col).alias("_norm"),
        F.monotonically_increasing_id().alias("_at"),
    ]
    if carry:
        cols.append(F.xxhash64(F.col(text_col)).alias("_t"))
        cols.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    keys = docs.select(*cols).withColumn("_h", F.xxhash64("_norm")).withColumn("text_sha256", F.sha2(F.col("_norm"), 256))
    return keys.drop("_norm") if carry else keys


def _group(keys: DataFrame) -> DataFrame:
    """One row per (hash, digest): keep_id, group_size, and the row that stays."""
    # bitwise_not reverses the order of ids without overflow; nulls stay last.
    order = [F.col("_n"), F.bitwise_not(F.col("_id")).alias("_r")]
    if "_t" in keys.columns:
        order.append(F.col("_t"))
    order.append(F.bitwise_not(F.col("_at")).alias("_a"))
    grouped = keys.groupBy("_h", "text_sha256").agg(F.max(F.struct(*order)).alias("_best"), F.count(F.lit(1)).alias("group_size"))
    return grouped.select(
        "_h",
        "text_sha256",
        F.bitwise_not(F.col("_best._r")).alias("keep_id"),
        "group_size",
        F.bitwise_not(F.col("_best._a")).alias("keep_at"),
    )


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct normalised text: (_h, text_sha256, keep_id, group_size, keep_at)."""
    return _group(_keys(docs, id_col, text_col))


def _listed(df: DataFrame, name: str) -> DataFrame:
    """``df`` written, and broadcast where it is found to be small."""
    df = store.write_shared(df, name)
    return F.broadcast(df) if df.count() * _KEY_BYTES <= BROADCAST_BYTES else df


def _compare_bytes(keys: DataFrame, found: DataFrame, norm: Column) -> DataFrame:
    """``found`` again, when all rows of each class of two or more have the same bytes (``norm`` of the keys)."""
    copied = _listed(found.where("group_size > 1").select("_h", "text_sha256"), "exact-copied")
    texts = keys.join(copied, ["_h", "text_sha256"], "left_semi").select("_h", "text_sha256", norm.alias("_norm"))
    differing = texts.distinct().groupBy("_h", "text_sha256").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not differing.isEmpty():
        raise ValueError("texts that differ share a hash and a SHA-256 digest")
    return found


def slot_of(h: str | Column, depth: int = MAX_DEPTH) -> Column:
    """Directory slot: the top ``depth`` bits of the hash."""
    return F.shiftrightunsigned(F.col(h) if isinstance(h, str) else h, 64 - depth).cast("int")


def grow_directory(slot_counts: dict[int, int], capacity: int, max_depth: int = MAX_DEPTH) -> list[tuple[int, int, int]]:
    """Split overfull buckets until each fits or is one slot: [(first slot, slots, local depth)].

    ``slot_counts`` holds classes per slot at ``max_depth``, so its size is
    bounded by ``2**max_depth`` at any data size.
    """
    totals = [0]
    for s in range(1 << max_depth):
        totals.append(totals[-1] + slot_counts.get(s, 0))
    done, open_ = [], [(0, 0)]  # (first slot, local depth); the directory's depth is the deepest one
    while open_:
        first, depth = open_.pop()
        width = 1 << (max_depth - depth)
        if totals[first + width] - totals[first] <= capacity or depth == max_depth:
            done.append((first, width, depth))
        else:
            open_ += [(first, depth + 1), (first + width // 2, depth + 1)]
    return sorted(done)


@dataclass
class Index:
    directory: DataFrame  # slot -> bucket, depth
    entries: DataFrame  # bucket, _h, chain, text_sha256, keep_id, group_size, keep_at


def _build(keys: DataFrame, capacity: int, norm: Column) -> Index:
    spark = keys.sparkSession
    found = _compare_bytes(keys, store.write_shared(_group(keys), "exact-classes"), norm)
    counts = {r[0]: r[1] for r in found.groupBy(slot_of("_h").alias("slot")).count().collect()}
    buckets = grow_directory(counts, capacity)
    directory = store.write_shared(
        store.local_frame(
            spark,
            [(first + i, b, depth) for b, (first, width, depth) in enumerate(buckets) for i in range(width)],
            **dict.fromkeys(("slot", "bucket", "depth"), pa.int32()),
        ),
        "exact-directory",
    )
    # At most 2**MAX_DEPTH rows of 12 bytes, so the broadcast has a fixed bound.
    owned = found.withColumn("slot", slot_of("_h")).join(F.broadcast(directory), "slot")
    # Rows of a chain have one bucket, so the window needs no further exchange.
    chain = Window.partitionBy("bucket", "_h").orderBy("text_sha256")
    entries = owned.repartitionByRange("bucket", "_h").withColumn("chain", F.row_number().over(chain))
    entries = entries.select("bucket", "_h", "chain", "text_sha256", "keep_id", "group_size", "keep_at")
    return Index(directory, store.write_shared(entries, "exact-index"))


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = BUCKET_CAPACITY
) -> Index:
    return _build(store.write_shared(_keys(docs, id_col, text_col), "exact-keys"), capacity, F.col("_norm"))


def _follow(index: Index, keys: DataFrame) -> DataFrame:
    """Keys with the entry that slot, bucket and chain lead to."""
    placed = keys.withColumn("slot", slot_of("_h")).join(F.broadcast(index.directory), "slot")  # a fixed bound, see above
    # A hot class repeats on the row side only; AQE splits such a partition. The chain is
    # followed by digest; one of more than one link is rare, but is walked all the same.
    chained = index.entries.groupBy("bucket", "_h").agg(
        F.sort_array(F.collect_list(F.struct("chain", "text_sha256", "keep_id", "group_size", "keep_at"))).alias("links")
    )
    walked = placed.join(chained, ["bucket", "_h"])
    link = F.filter("links", lambda x: x["text_sha256"] == F.col("text_sha256"))
    return walked.withColumn("_link", F.get(link, F.lit(0))).select(*keys.columns, "_link.keep_id", "_link.group_size", "_link.keep_at", "_link.chain", "bucket")


def _told(index: Index, keys: DataFrame) -> DataFrame:
    return _follow(index, keys.select("_id", "_h", "text_sha256")).select(
        F.col("_id").alias("doc_id"),
        "keep_id",
        "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def lookup(index: Index, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs`` that the index holds: doc_id, keep_id, group_size, kept, text_sha256."""
    return _told(index, _keys(docs, id_col, text_col)).where("keep_id is not null or group_size is not null")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = BUCKET_CAPACITY) -> DataFrame:
    """Group every row by its normalised text through the index."""
    keys = store.write_shared(_keys(docs, id_col, text_col), "exact-keys")
    return _told(_build(keys, capacity, F.col("_norm")), keys)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = BUCKET_CAPACITY) -> DataFrame:
    """One whole row per class: most code points, then smallest id; columns of ``docs``."""
    keys = store.write_shared(_keys(docs, id_col, text_col, carry=True), "exact-keys")
    index = _build(keys, capacity, normalised(F.col("_row")[text_col]))
    told = _follow(index, keys.select("_at", "_h", "text_sha256"))
    dropped = _listed(told.where("_at <> keep_at").select("_at"), "exact-dropped")
    return keys.join(dropped, "_at", "left_anti").select("_row.*")
